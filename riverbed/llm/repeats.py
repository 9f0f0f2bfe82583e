"""Suffix-array dedup: repeated passages found by merging shard Burrows-Wheeler transforms.

Suffixes of every byte would take many times the corpus, so the transforms are
built over phrases. Winnowing picks anchors: in each window of ``WINDOW``
positions the least hash of ``GRAM`` bytes (leftmost of equals). A phrase runs
from an anchor to the end of the next anchor's gram, and its hash is a symbol.
Anchors depend only on nearby bytes: two occurrences of one string of
``length`` bytes have the same anchor for their first window, and every phrase
that begins less than :func:`reach` bytes after it is the same in both. The
number of these phrases (two at least) is the anchor's depth: the common prefix,
in phrases, that its suffix must share with another one.

1. Each shard (a bounded run of documents) sorts the phrase suffixes of its own
   documents once and keeps their Burrows-Wheeler transform.
2. The transforms are merged by interleave refinement: in round h the merged
   order is divided into blocks of suffixes that share their first h symbols.
   A block's suffixes, extended backwards by their transform symbols, give the
   blocks of round h + 1; only blocks that hold two suffixes or more, over all
   shards, are refined further. A shard reports a block once with its size, so
   a hot block costs one row per shard. Suffixes are never sorted again.
3. A suffix is settled in the round of its own depth (``ROUNDS`` at most; less
   depth only adds candidates): its block there is a repeated interval with that
   common prefix, or it has no partner. A suffix that no anchor before it needs
   any longer leaves the rounds. The anchors of repeated intervals are the candidates.
4. An exact check of the bytes around the common prefix follows: all starts that
   share an anchor are settled together if the whole range they span occurs
   elsewhere; if only the bytes common to all of them do, each start's ``length``
   bytes are compared. Both are counts of 64-bit range hashes, aggregated per
   task before the shuffle.

Documents are cut apart before anything else, so matches never cross them.

Defined results: a null or empty text has no bytes; texts under ``length``
bytes keep all; rows that repeat a text remove each other's bytes like any
copies; a null doc_id is kept as it is; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .base import CHUNK, chunks, finished, mix, prefix_hash, range_hash, written

LENGTH = 400
GRAM, WINDOW = 16, 128
#: rounds of refinement; an anchor has two to three phrases to share on average
ROUNDS = 5
#: bytes of a symbol; a chance clash of two phrases only adds a candidate
SYMBOL = 5
#: symbols per shard at most (a longer document is a shard of its own)
SHARD = 1 << 20
_U = np.uint64
_M1, _M2, _M3 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)


def reach(length: int) -> int:
    """Phrases that begin less than this after an anchor lie in all strings of its starts:
    the last window of such a string begins no earlier."""
    return length - 2 * WINDOW - GRAM + 2


def check_length(length: int) -> None:
    if reach(length) <= WINDOW:      # anchors are at most a window apart: two phrases at least
        raise ValueError("length is too short for the windows")


def depths(place: np.ndarray, doc: np.ndarray, starts: np.ndarray,
           length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per anchor of a chunk (positions in the chunk): its depth, 0 without starts, and the
    last round in which its suffix is needed, by itself or by an anchor before it."""
    n = np.arange(len(place))
    end = np.searchsorted(place, place + reach(length))
    last = np.searchsorted(doc, doc, "right") - 1       # a document's last anchor begins no phrase
    depth = np.where(starts, np.minimum(np.minimum(end, last) - n, ROUNDS), 0)
    need = np.maximum.accumulate(np.where(starts, depth + n, 0)) - n
    return depth.astype(np.uint8), np.maximum(need, 0).astype(np.uint8)


def anchors(buf: np.ndarray, off: np.ndarray, length: int = LENGTH):
    """``position, document, first start, last start`` of every anchor of a chunk.

    The starts are those strings of ``length`` bytes whose first window picks the
    anchor; last < first where there are none (near the end of a document).
    """
    none = np.zeros(0, np.int64)
    n = len(buf)
    long_docs = np.flatnonzero(np.diff(off) >= length)
    if not len(long_docs):
        return none, none, none, none
    words = np.ndarray((n - 7,), "<u8", buffer=np.ascontiguousarray(buf), strides=(1,)).copy()
    key = words[:n - GRAM + 1] * _M1
    key ^= (words[8:] * _M2) >> _U(29)
    key *= _M3
    key &= _U(0xFFFFFFFF00000000)
    key |= np.arange(len(key), dtype=np.uint64)
    wide, least = 1, key
    while wide * 2 <= WINDOW:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < WINDOW:
        least = np.minimum(least[:len(least) - (WINDOW - wide)], least[WINDOW - wide:])
    # windows that lie inside one long document
    first, last = off[long_docs], off[long_docs + 1] - GRAM - WINDOW + 1
    count = last - first + 1
    at = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
    pick = (least[at] & _U(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, pick[1:] != pick[:-1]])
    doc = np.repeat(long_docs, count)[new]
    low, high = at[new], at[np.r_[new[1:], len(at)] - 1]
    return pick[new], doc, low, np.minimum(high, off[doc + 1] - length)


def symbols(pre: np.ndarray, place: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Phrase hash from each anchor to the next; 0 for a document's last anchor."""
    out = np.zeros(len(place), np.uint64)
    go = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, int)
    out[go] = range_hash(pre, place[go], place[go + 1] + GRAM) >> _U(64 - 8 * SYMBOL) | _U(1)
    return out


def _pack(sym: np.ndarray) -> bytes:
    return np.ascontiguousarray(sym.view(np.uint8).reshape(-1, 8)[:, :SYMBOL]).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // SYMBOL, 8), np.uint8)
    out[:, :SYMBOL] = np.frombuffer(raw, np.uint8).reshape(-1, SYMBOL)
    return out.view(np.uint64).reshape(-1)


def _build(sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes (to ``ROUNDS`` symbols; end marks are 0) and their transform."""
    levels = [sym]
    for _ in range(ROUNDS - 1):
        nxt = np.append(levels[-1][1:], _U(0))
        nxt[levels[-1] == 0] = 0
        levels.append(nxt)
    order = np.lexsort(levels[::-1])
    before = np.where(order > 0, sym[order - 1], _U(0))
    return order.astype(np.int32), before


_SHARDS = ("shard long, bwt binary, pos binary, deep binary, place binary, doc_first binary, "
           "doc_ids array<{kind}>, text_hash binary")


def shard_transforms(docs: DataFrame, doc_id: str, text: str, length: int) -> DataFrame:
    """One row per shard: its transform and where each symbol lies, written once."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        part, number, held, docs_in, size = TaskContext.get().partitionId(), 0, [], 0, 0
        ids, hashes, id_type = [], [], None

        def row():
            sym, place, doc, deep = (np.concatenate(x) for x in zip(*held))
            pos, bwt = _build(sym)
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 24 | number], pa.int64()),
                 *(pa.array([x], pa.binary()) for x in (
                     _pack(bwt), pos.tobytes(), deep.tobytes(), place.astype(np.int32).tobytes(),
                     np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]).astype(np.int32).tobytes())),
                 pa.array([ids], pa.list_(id_type)),
                 pa.array([np.array(hashes, np.int64).tobytes()], pa.binary())],
                names=["shard", "bwt", "pos", "deep", "place", "doc_first", "doc_ids", "text_hash"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for lo, hi, buf, off in chunks(batch.column(1)):
                place, doc, low, high = anchors(buf, off, length)
                if not len(place):
                    continue
                sym = symbols(prefix_hash(buf), place, doc)
                depth, need = depths(place, doc, high >= low, length)
                used, doc_no = np.unique(doc, return_inverse=True)
                held.append((sym, place - off[doc], doc_no + docs_in, depth | need << 4))
                some = pa.array(used + lo)
                ids += batch.column(0).take(some).to_pylist()
                hashes += batch.column(2).take(some).to_pylist()
                docs_in, size = docs_in + len(used), size + len(sym)
                if size >= SHARD:
                    yield row()
                    number, held, docs_in, size, ids, hashes = number + 1, [], 0, 0, [], []
        if held:
            yield row()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.xxhash64(text).alias("text_hash")) \
        .where(F.octet_length("text") >= length)
    return written(rows.mapInArrow(run, _SHARDS.format(kind=kind)), "bwt-shards")


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and their counts."""
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True]) if len(key) else np.zeros(1, int)
    return key[cut[:-1]], np.diff(cut)


def _report(shard: int, keys: np.ndarray) -> pa.RecordBatch:
    """A shard's blocks: one row each, with one or (for more) two as its size."""
    block, size = _runs(np.sort(keys))
    return pa.RecordBatch.from_arrays(
        [pa.array(block.view(np.int64)), pa.array(np.full(len(block), shard, np.int64)),
         pa.array(np.minimum(size, 2).astype(np.int8))], names=["block", "shard", "n"])


def _repeated_blocks(reports: DataFrame) -> DataFrame:
    """``shard, blocks``: per shard its blocks that hold two suffixes or more over all shards.

    Reports of one block meet in one task, at most one row per shard; a shard's
    list is at most as long as the shard.
    """
    def run(batches):
        block, shard, size = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            block = np.r_[block, np.array(batch.column(0))]
            shard = np.r_[shard, np.array(batch.column(1))]
            size = np.r_[size, np.array(batch.column(2))]
            open_run = np.flatnonzero(block == block[-1])[0] if len(block) else 0
            if open_run:
                yield alive(block[:open_run], shard[:open_run], size[:open_run])
                block, shard, size = block[open_run:], shard[open_run:], size[open_run:]
        if len(block):
            yield alive(block, shard, size)

    def alive(block, shard, size):
        cut = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        total = np.add.reduceat(size, cut)
        keep = np.repeat(total > 1, np.diff(np.r_[cut, len(block)]))
        return pa.RecordBatch.from_arrays([pa.array(shard[keep]), pa.array(block[keep])],
                                          names=["shard", "block"])

    return reports.repartition("block").sortWithinPartitions("block") \
        .mapInArrow(run, "shard long, block long") \
        .groupBy("shard").agg(F.collect_list("block").alias("blocks"))


def _u8(x: bytes) -> np.ndarray:
    return np.frombuffer(x, np.uint64)


def _in(keys: np.ndarray, alive: np.ndarray) -> np.ndarray:
    alive = np.sort(alive)
    if not len(alive):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(alive, keys), len(alive) - 1)
    return alive[at] == keys


def _alive(row: dict) -> np.ndarray:
    return np.array(row["blocks"] or [], np.int64).view(np.uint64)


def _extend(symbol: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Block of the suffixes ``symbol + suffix of block``."""
    return mix(block * _M2 + symbol)


#: a shard's suffixes in a round: block, anchor number, the symbols that lead back from it
#: and the depths of the anchors these lead to (one row per further round), and the anchors
#: that are settled as candidates
_STATE = "shard long, block binary, origin binary, back binary, deep binary, found binary"


def _state_batch(shard, block, origin, back, deep, found) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int64()), *(pa.array([x], pa.binary()) for x in (
            block.tobytes(), origin.astype(np.int32).tobytes(), _pack(back.reshape(-1)),
            deep.tobytes(), found.astype(np.int32).tobytes()))],
        names=["shard", "block", "origin", "back", "deep", "found"])


def _begin(row: dict) -> pa.RecordBatch:
    """Blocks by first symbol -> suffixes of round 2: one step back through the transform."""
    bwt, pos = _unpack(row["bwt"]), np.frombuffer(row["pos"], np.int32).astype(np.int64)
    deep = np.frombuffer(row["deep"], np.uint8)
    first = np.sort(bwt)                           # sorted symbols lead the suffixes
    alive = np.flatnonzero(_in(first, _alive(row)))
    rank = np.empty(len(pos), np.int64)
    rank[pos] = np.arange(len(pos))
    back = np.zeros((ROUNDS - 1, len(alive)), np.uint64)
    deeps = np.zeros((ROUNDS, len(alive)), np.uint8)
    at, ok = pos[alive], np.ones(len(alive), bool)
    deeps[0] = deep[at]
    for i in range(ROUNDS - 1):                    # not over a document's start
        back[i] = np.where(ok, bwt[rank[at]], _U(0))
        ok &= back[i] != 0
        at = np.where(ok, at - 1, at)
        deeps[i + 1] = np.where(ok, deep[at], 0)
    return _step(row["shard"], first[alive], pos[alive], back, deeps, np.zeros(0, np.int32), 1)


def _step(shard: int, block, origin, back, deep, found, h: int) -> pa.RecordBatch:
    """Suffixes of round h, all in repeated blocks -> those of round h + 1; anchors of depth h
    are settled."""
    found = np.r_[found, origin[deep[0] & 15 == h]]
    go = np.flatnonzero((back[0] != 0) & (deep[1] >> 4 > h)) if len(back) else np.zeros(0, int)
    return _state_batch(shard, _extend(back[0][go], block[go]) if len(back) else block[go],
                        origin[go] - 1, back[1:][:, go], deep[1:][:, go], found)


def _refine(row: dict, h: int) -> pa.RecordBatch:
    block, origin = _u8(row["block"]), np.frombuffer(row["origin"], np.int32)
    back = _unpack(row["back"]).reshape(ROUNDS - h, len(block))
    deep = np.frombuffer(row["deep"], np.uint8).reshape(ROUNDS - h + 1, len(block))
    keep = np.flatnonzero(_in(block, _alive(row)))
    return _step(row["shard"], block[keep], origin[keep], back[:, keep], deep[:, keep],
                 np.frombuffer(row["found"], np.int32), h)


def _each(fn):
    """``fn`` on every row of the batches, one row at a time."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield fn(batch.slice(i, 1).to_pylist()[0])
    return run


def candidates(docs: DataFrame, doc_id: str, text: str, length: int) -> DataFrame:
    """``doc_id, text_hash, places``: candidate anchors (int32 byte offsets) per document."""
    shards = shard_transforms(docs, doc_id, text, length)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def first_report(row):
        keys = _unpack(row["bwt"])
        return _report(row["shard"], keys[keys != 0])

    report = "block long, shard long, n byte"
    alive = _repeated_blocks(shards.select("shard", "bwt").mapInArrow(_each(first_report), report))
    state = written(shards.select("shard", "bwt", "pos", "deep").join(alive, "shard")
                    .mapInArrow(_each(_begin), _STATE), "bwt-round")
    steps = [shards, state]
    for h in range(2, ROUNDS + 1):
        alive = _repeated_blocks(state.select("shard", "block").mapInArrow(
            _each(lambda row: _report(row["shard"], _u8(row["block"]))), report))
        # a shard without a repeated block keeps what it has found
        state = written(state.join(alive, "shard", "left").mapInArrow(
            _each(lambda row, h=h: _refine(row, h)), _STATE), "bwt-round")
        steps.append(state)

    def places(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = np.sort(np.frombuffer(row["found"], np.int32))
                if not len(found):
                    continue
                doc = np.searchsorted(np.frombuffer(row["doc_first"], np.int32), found, "right") - 1
                place = np.frombuffer(row["place"], np.int32)[found]
                cut = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1], True])
                own = doc[cut[:-1]].tolist()
                hashes = np.frombuffer(row["text_hash"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_ids"][d] for d in own],
                              batch.schema.field("doc_ids").type.value_type),
                     pa.array(hashes[own]),
                     pa.array([place[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                    names=["doc_id", "text_hash", "places"])

    ends = shards.select("shard", "place", "doc_first", "doc_ids", "text_hash")
    out = state.select("shard", "found").join(ends, "shard") \
        .mapInArrow(places, f"doc_id {kind}, text_hash long, places binary")
    # rows that repeat a doc_id and a text have the same anchors
    found = written(out.groupBy("doc_id", "text_hash").agg(F.max("places").alias("places")),
                    "repeat-candidates")
    del alive, out, ends
    finished(docs.sparkSession, *steps)
    return found


def _unzipped(batch: pa.RecordBatch):
    """``row numbers, bytes, offsets`` of a batch's documents (column ``z``), about
    ``CHUNK`` bytes at a time."""
    unzip, rows, parts, size = zstandard.ZstdDecompressor(), [], [], 0
    for i, z in enumerate(batch.column("z")):
        raw = z.as_py()
        if raw is None:
            continue
        rows.append(i)
        parts.append(unzip.decompress(raw))
        size += len(parts[-1])
        if size >= CHUNK:
            yield _joined(rows, parts)
            rows, parts, size = [], [], 0
    if rows:
        yield _joined(rows, parts)


def _joined(rows, parts):
    off = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return rows, np.frombuffer(b"".join(parts), np.uint8), off


def _ranges(buf, off, places: list[bytes], length: int):
    """Anchors of a chunk that are candidates and have starts: position, document, first, last."""
    place, doc, low, high = anchors(buf, off, length)
    want = np.concatenate([np.zeros(0, np.int64), *(
        np.frombuffer(p, np.int32) + off[i] for i, p in enumerate(places))])
    keep = np.flatnonzero(np.isin(place, want) & (high >= low))
    return place[keep], doc[keep], low[keep], high[keep]


def _lists(doc: np.ndarray, n: int, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list per document: the values of its entries (``doc`` ascends)."""
    at = np.searchsorted(doc, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))


def _shifted(col: list, off: np.ndarray) -> np.ndarray:
    """Byte offsets in documents (lists, may be null) as positions in a chunk."""
    return np.concatenate([np.zeros(0, np.int64), *(
        np.array(x, np.int64) + off[i] for i, x in enumerate(col) if x)])


def repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept_sha256`` per document.

    ``spans`` are the maximal byte runs ``(start, end)`` covered by a string of
    ``length`` bytes that also starts elsewhere; ``kept_sha256`` digests the rest.
    """
    check_length(length)
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    cand = candidates(docs, doc_id, text, length)
    core = length - WINDOW + 1

    # texts move once, compressed; of documents without candidates only their digest goes on
    def squeeze(batches):
        for batch in batches:
            zipped = zstandard.ZstdCompressor(level=3)
            z = [zipped.compress(x.as_py().encode()) if len(x.as_py()) * 4 >= length else None
                 for x in batch.column("text")]
            yield batch.drop_columns(["text"]).append_column("z", pa.array(z, pa.binary()))

    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                      F.xxhash64(text).alias("text_hash")) \
        .select("doc_id", "text_hash", F.octet_length("text").cast("long").alias("n_bytes"),
                F.sha2("text", 256).alias("whole"), "text") \
        .mapInArrow(squeeze, f"doc_id {kind}, text_hash long, n_bytes long, whole string, z binary")
    met = own.alias("d").join(
        cand.alias("c").hint("shuffle_hash"),
        F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_hash") == F.col("c.text_hash")),
        "left").select(
            F.monotonically_increasing_id().alias("uid"), "d.doc_id", "n_bytes", "whole", "places",
            F.when(F.col("places").isNotNull(), F.col("z")).alias("z"))

    def range_rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            places = batch.column("places").to_pylist()
            out = [pa.nulls(batch.num_rows, pa.list_(t)) for t in (pa.int32(), pa.int64(), pa.int64())]
            done = {}
            for rows, buf, off in _unzipped(batch):
                place, doc, low, high = _ranges(buf, off, [places[i] for i in rows], length)
                pre, n = prefix_hash(buf), len(rows)
                cells = (_lists(doc, n, place - off[doc], pa.int32()),
                         _lists(doc, n, range_hash(pre, low, high + length).view(np.int64), pa.int64()),
                         _lists(doc, n, range_hash(pre, place, place + core).view(np.int64), pa.int64()))
                done.update((i, (cells, k)) for k, i in enumerate(rows))
            for c in range(3):
                out[c] = pa.array([done[i][0][c][done[i][1]].as_py() if i in done else None
                                   for i in range(batch.num_rows)], out[c].type)
            full = batch
            for name, col in zip(("at", "span", "common"), out):
                full = full.append_column(name, col)
            yield full

    body = written(met.mapInArrow(range_rows, (
        f"uid long, doc_id {kind}, n_bytes long, whole string, places binary, z binary, "
        "at array<int>, span array<long>, common array<long>")), "repeat-bodies")
    del own, met
    finished(spark, cand)
    plain = body.where("places IS NULL").select(
        "doc_id", "n_bytes", F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
        F.col("whole").alias("kept_sha256"))
    hot = body.where("places IS NOT NULL").select("uid", "doc_id", "n_bytes", "places", "z")

    rows = body.where("places IS NOT NULL") \
        .select("uid", F.explode(F.arrays_zip("at", "span", "common")).alias("r")) \
        .select("uid", F.col("r.at").alias("at"), F.col("r.span").alias("span"),
                F.col("r.common").alias("common"))
    # one row per distinct range; a range that occurs twice settles all its starts
    spans = written(rows.groupBy("span").agg(
        F.count("*").alias("n"), F.min("uid").alias("uid"), F.min("common").alias("common")),
        "repeat-spans")
    settled = rows.select("uid", "at", "span") \
        .join(spans.where("n > 1").select("span"), "span") \
        .groupBy("uid").agg(F.collect_list("at").alias("settled"))
    # starts differ only where distinct ranges share their common bytes and one is unsettled;
    # then one document per distinct range shows its starts
    shared = written(spans.groupBy("common").agg(
        F.count("*").alias("ranges"), F.min("n").alias("least"))
        .where("ranges > 1 AND least = 1").select("common"), "repeat-common")
    open_spans = spans.join(shared, "common").groupBy("uid").agg(
        F.collect_list("span").alias("open"))
    # a document has at most as many marks as anchors
    marks = written(settled.join(open_spans, "uid", "full"), "repeat-marks")
    del rows, settled, open_spans
    finished(spark, spans, shared)

    def start_rows(batches):
        for batch in batches:
            places, wanted = batch.column("places").to_pylist(), batch.column("open").to_pylist()
            for took, buf, off in _unzipped(batch):
                place, doc, low, high = _ranges(buf, off, [places[i] for i in took], length)
                pre = prefix_hash(buf)
                # a range is this document's to show if its hash is on its own list
                key = mix(range_hash(pre, low, high + length) + doc.astype(np.uint64))
                mine = np.concatenate([mix(np.array(wanted[i], np.int64).view(np.uint64) + _U(k))
                                       for k, i in enumerate(took)])
                todo = np.flatnonzero(np.isin(key, mine))
                n = high[todo] - low[todo] + 1
                at = np.arange(n.sum()) + np.repeat(low[todo] - (np.cumsum(n) - n), n)
                owner, count = np.repeat(doc[todo], n), len(took)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("uid").take(pa.array(took)),
                     _lists(owner, count, at - off[owner], pa.int32()),
                     _lists(owner, count, range_hash(pre, at, at + length).view(np.int64), pa.int64())],
                    names=["uid", "at", "h"])

    starts = written(hot.select("uid", "places", "z").join(
        marks.where("open IS NOT NULL").select("uid", "open"), "uid")
        .mapInArrow(start_rows, "uid long, at array<int>, h array<long>"), "repeat-starts")
    again = written(starts.select(F.explode("h").alias("h")).groupBy("h").count()
                    .where("count > 1").select("h"), "repeat-hashes")
    single = written(starts.select("uid", F.explode(F.arrays_zip("at", "h")).alias("r"))
                     .select("uid", F.col("r.at").alias("at"), F.col("r.h").alias("h"))
                     .join(again, "h").groupBy("uid").agg(F.collect_list("at").alias("starts")),
                     "repeat-singles")
    finished(spark, starts, again)

    def cut_rows(batches):
        for batch in batches:
            places, settled, single = (
                batch.column(c).to_pylist() for c in ("places", "settled", "starts"))
            for took, buf, off in _unzipped(batch):
                place, doc, low, high = _ranges(buf, off, [places[i] for i in took], length)
                done = np.flatnonzero(np.isin(place, _shifted([settled[i] for i in took], off)))
                one = _shifted([single[i] for i in took], off)
                edge = np.zeros(len(buf) + 1, np.int64)
                np.add.at(edge, np.r_[low[done], one], 1)
                np.add.at(edge, np.r_[high[done], one] + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans_of, digests = [], []
                for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                    g = gone[a:b]
                    turn = np.flatnonzero(np.diff(np.r_[False, g, False]))
                    spans_of.append([{"start": int(x), "end": int(y)}
                                     for x, y in zip(turn[::2], turn[1::2])])
                    digests.append(hashlib.sha256(buf[a:b][~g].tobytes()).hexdigest())
                some = pa.array(took)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(some), batch.column("n_bytes").take(some),
                     pa.array(spans_of, pa.list_(pa.struct(
                         [("start", pa.int32()), ("end", pa.int32())]))), pa.array(digests)],
                    names=["doc_id", "n_bytes", "spans", "kept_sha256"])

    cut = hot.join(marks.select("uid", "settled"), "uid", "left").join(single, "uid", "left") \
        .mapInArrow(cut_rows, f"doc_id {kind}, n_bytes long, spans array<struct<start:int,end:int>>, "
                              "kept_sha256 string")
    return plain.unionByName(cut)
