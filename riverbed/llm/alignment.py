"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Every text, with a space before it, is coded by a byte-level vocabulary (A) and by a
piece model (B, which adds that space itself). Both cut the same bytes; where tokens of
both end at the same byte, a group ends. Two tokens are linked if their byte ranges
overlap. The corpus counts how many links hold each pair of ids.

*Lockstep merging.* All documents of a chunk advance together: one state vector holds
each lane's place in A and in B; a step emits the link at every lane's place, moves the
side that ends first (both at a cut), and drops the lanes that are through. A long document
is dealt into lanes of ``LANE`` bytes, so all lanes take about as many steps; a link
belongs to the lane in which its overlap begins.

Texts are tokenised once. The documents of about ``BLOCK`` bytes make one row of a
table in the shared folder: per document its figures and its distinct pairs, as places
in the block's list of distinct pairs. Only that list is joined with the corpus counts
(summed per block first, so a pair that every document holds is one row a block), and
the answers return to their block. The highest count of every B id is one row per entry of
B's vocabulary, which bounds its broadcast.

*Memory* follows a block, not the input: a worker forgets the pieces of A at ``PIECES``
(they are coded anew, with the same ids), and a block is a row group of its own, so that
its writers and readers, who hold a row group as a whole, hold one block each.

Defined results: a null or empty text, and one whose A or B tokens do not spell a space
and the text (B spells U+2581 as a space), has no tokens: zeros and an empty digest.
Repeated rows are aligned and counted each time; null ids are kept; an empty
table gives no rows; other columns are not read. A block holds a document longer than
``BLOCK`` alone.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .base import chunks, local_path, written
from .pieces import PieceCoder
from .token_files import byte_alphabet

LANE = 512
BLOCK = 4 << 20
#: bytes aligned at once: what a worker holds besides its block follows them
PART = 512 << 10
#: pieces a worker remembers, and bytes of them: it keeps them through all stages
PIECES, PIECE_BYTES = 500_000, 16 << 20
#: a pair of ids as one number: A's id times this, plus B's
WIDTH = 1 << 24


# -- the two tokenizers -------------------------------------------------------


@dataclass
class Vocabulary:
    """The bytes of every token of a vocabulary, and its id in decimal."""

    raw: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    digits: np.ndarray = field(init=False)
    n_digits: np.ndarray = field(init=False)

    def __post_init__(self):
        text = np.arange(len(self.size)).astype("S10")
        self.digits = text.view(np.uint8).reshape(len(text), 10)
        self.n_digits = (self.digits > 0).sum(1)

    @staticmethod
    def of(tokens: list[bytes]) -> Vocabulary:
        size = np.array([len(t) for t in tokens], np.int64)
        return Vocabulary(np.frombuffer(b"".join(tokens) or b"\0", np.uint8),
                          np.cumsum(size) - size, size)

    def spelled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a run of tokens, and where each token ends."""
        size = self.size[ids]
        end = np.cumsum(size)
        place = np.repeat(self.begin[ids] - end + size, size)
        place += np.arange(len(place))
        return self.raw[place], end


class ByteLevel:
    """Ids by a byte-level vocabulary file, special tokens' strings as plain text."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        path = local_path(vocabulary)
        with open(path, encoding="utf-8") as f:
            ids = json.load(f)["model"]["vocab"]
        alphabet = byte_alphabet()
        byte_of = {chr(c): b for b, c in alphabet.items()}
        tokens = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            if all(c in byte_of for c in token):
                tokens[i] = bytes(byte_of[c] for c in token)
        self.vocabulary = Vocabulary.of(tokens)
        model = Tokenizer.from_file(path).model

        def encode(piece: bytes) -> list[int]:
            return [t.id for t in model.tokenize(piece.decode("latin-1").translate(alphabet))]
        self.coder = PieceCoder(encode, PIECES, PIECE_BYTES)

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a chunk, and each document's offset among them."""
        ids, at = self.coder.chunk(buf, off)
        return ids.astype(np.int64), at


class PieceModel:
    """Ids by a piece model file; pieces spell U+2581 as a space, ``<0xHH>`` as a byte."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=local_path(model))
        n = self.model.get_piece_size()
        self.vocabulary = Vocabulary.of([
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else
            p.replace("▁", " ").encode()
            for i, p in enumerate(map(self.model.id_to_piece, range(n)))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = self.model.encode(texts, num_threads=1) if texts else []
        at = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)
        return np.fromiter((i for x in each for i in x), np.int64, int(at[-1])), at


_both: dict[tuple[str, str], tuple[ByteLevel, PieceModel]] = {}


def tokenizers(vocabulary: str, model: str) -> tuple[ByteLevel, PieceModel]:
    """One pair per worker process."""
    key = (vocabulary, model)
    if key not in _both:
        _both[key] = (ByteLevel(vocabulary), PieceModel(model))
    return _both[key]


# -- the merge ----------------------------------------------------------------


def lockstep(a_end: np.ndarray, b_end: np.ndarray, off: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links ``(i, j)`` and cuts ``(i, j)`` (the last tokens of a group) of a chunk.

    ``a_end`` and ``b_end`` are the ends of all tokens in the chunk's bytes, ``off`` the
    documents' offsets; every document ends with a token of both.
    """
    size = np.diff(off)
    lanes = -(-size // LANE)
    first = np.repeat(np.cumsum(lanes) - lanes, lanes)
    lo = np.repeat(off[:-1], lanes) + (np.arange(len(first)) - first) * LANE
    limit = np.minimum(lo + LANE, np.repeat(off[1:], lanes))
    i = np.searchsorted(a_end, lo, "right")
    j = np.searchsorted(b_end, lo, "right")
    # a link whose overlap began before the lane belongs to the lane before it
    begun = np.maximum(np.where(i > 0, a_end[i - 1], 0), np.where(j > 0, b_end[j - 1], 0)) < lo
    ea, eb = a_end[i], b_end[j]
    at = np.where(begun, np.minimum(ea, eb), lo)
    i += begun & (ea == at)
    j += begun & (eb == at)
    live = at < limit
    i, j, limit = i[live], j[live], limit[live]
    links, cuts = [], []
    while len(i):
        links.append((i, j))
        ea, eb = a_end[i], b_end[j]
        both = ea == eb
        cuts.append((i[both], j[both]))
        live = np.minimum(ea, eb) < limit
        i, j = i + (ea <= eb), j + (eb <= ea)
        if not live.all():
            i, j, limit = i[live], j[live], limit[live]
    if not links:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    return (*(np.concatenate(x) for x in zip(*links)), *(np.concatenate(x) for x in zip(*cuts)))


def _written_groups(va: Vocabulary, a: np.ndarray, a_last: np.ndarray, vb: Vocabulary,
                    b: np.ndarray, b_last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of all tokens, and the offsets of A's tokens' documents.

    ``a_last`` and ``b_last`` mark the last token of each group; a group's A tokens come
    first, so a token's place among all is its own index plus the other side's tokens before it.
    """
    n = len(a) + len(b)
    a_ends, b_ends = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    a_at = np.arange(len(a)) + np.concatenate([[0], b_ends])[a_group]
    b_at = np.arange(len(b)) + a_ends[b_group]
    size = np.empty(n, np.int64)
    size[a_at], size[b_at] = va.n_digits[a] + 1, vb.n_digits[b] + 1
    end = np.cumsum(size)
    out = np.empty(int(end[-1]) if n else 0, np.uint8)
    for v, ids, place, last, between in ((va, a, a_at, a_last, b"|"), (vb, b, b_at, b_last, b";")):
        begin, width = end[place] - size[place], v.n_digits[ids]
        for k in range(int(width.max()) if len(ids) else 0):
            here = width > k
            out[begin[here] + k] = v.digits[ids[here], k]
        out[begin + width] = np.where(last, between[0], 44)
    return out, np.concatenate([[0], end])


@dataclass
class Aligned:
    """Figures of a chunk's documents, and the distinct pairs of each with their counts."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digest: list[str]
    n_pairs: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def align(texts: pa.Array, buf: np.ndarray, off: np.ndarray, a: ByteLevel, b: PieceModel) -> Aligned:
    """Align one chunk of documents (``texts`` as an Arrow array and as bytes)."""
    n = len(off) - 1
    some = np.flatnonzero(np.diff(off) > 0)
    lengths = np.diff(off)[some] + 1
    want = np.insert(buf, off[some], 32)
    want_off = np.concatenate([[0], np.cumsum(lengths)])
    a_ids, a_off = a.encode(want, want_off)
    b_ids, b_off = b.encode(texts.take(pa.array(some)).to_pylist())

    # keep the documents that both sides spell as they are
    good = np.ones(len(some), bool)
    for ids, at, vocabulary in ((a_ids, a_off, a.vocabulary), (b_ids, b_off, b.vocabulary)):
        got, end = vocabulary.spelled(ids)
        got_off = np.concatenate([[0], end])[at]
        same_size = np.diff(got_off) == lengths
        good &= same_size
        if same_size.all():
            off_bytes = np.flatnonzero(got != want)
            good[np.searchsorted(want_off, off_bytes, "right") - 1] = False
        else:
            for d in np.flatnonzero(same_size).tolist():
                good[d] &= np.array_equal(got[got_off[d]:got_off[d + 1]],
                                          want[want_off[d]:want_off[d + 1]])
    if not good.all():
        a_ids = a_ids[np.repeat(good, np.diff(a_off))]
        b_ids = b_ids[np.repeat(good, np.diff(b_off))]
        a_off = np.concatenate([[0], np.cumsum(np.diff(a_off)[good])])
        b_off = np.concatenate([[0], np.cumsum(np.diff(b_off)[good])])
        want_off = np.concatenate([[0], np.cumsum(lengths[good])])
        some = some[good]

    i, j, cut_i, cut_j = lockstep(np.cumsum(a.vocabulary.size[a_ids]),
                                  np.cumsum(b.vocabulary.size[b_ids]), want_off)
    a_doc = np.repeat(np.arange(len(some)), np.diff(a_off))
    a_last, b_last = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
    a_last[cut_i], b_last[cut_j] = True, True

    def per_doc(x):
        out = np.zeros(n, np.int64)
        out[some] = x
        return out

    written_, at = _written_groups(a.vocabulary, a_ids, a_last, b.vocabulary, b_ids, b_last)
    raw, edges = memoryview(written_), at[a_off + b_off]
    digest = [""] * n
    for d, lo, hi in zip(some.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
        digest[d] = hashlib.sha256(raw[lo:hi - 1]).hexdigest()      # without the last ";"

    # distinct pairs of every document
    doc, pair = a_doc[i], a_ids[i] * WIDTH + b_ids[j]
    order = np.lexsort((pair, doc))
    doc, pair = doc[order], pair[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(pair)))
    count = lambda x: np.bincount(x, minlength=len(some))
    return Aligned(per_doc(np.diff(a_off)), per_doc(np.diff(b_off)), per_doc(count(a_doc[cut_i])),
                   per_doc(count(doc)), digest, per_doc(count(doc[first])), pair[first], times)


# -- the corpus ---------------------------------------------------------------

_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def blocks(docs: DataFrame, vocabulary: str, model: str, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row per block of documents: figures and pairs of each, and the block's pairs.

    ``pairs`` are the block's distinct pairs, ``links`` how many links hold each; ``place``
    and ``times`` are every document's pairs one after the other, ``n_pairs`` of each.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (f"block long, doc_ids array<{kind}>, "
              + "".join(f"{x} array<long>, " for x in _FIGURES)
              + "digest array<string>, n_pairs array<int>, place array<int>, times array<int>, "
                "pairs array<long>, links array<long>")

    def run(batches):
        a, b = tokenizers(vocabulary, model)
        number, ids, got, held = TaskContext.get().partitionId() << 32, [], [], 0

        def row():
            join = lambda x: np.concatenate([getattr(g, x) for g in got])
            times = join("times")
            pairs, place = np.unique(join("pair"), return_inverse=True)
            links = np.zeros(len(pairs), np.int64)
            np.add.at(links, place.reshape(-1), times)
            doc_ids = pa.concat_arrays(ids)
            one = lambda x: pa.ListArray.from_arrays(
                pa.array([0, len(x)], pa.int32()), x)
            cells = {"block": pa.array([number], pa.int64()), "doc_ids": one(doc_ids)}
            cells |= {x: one(pa.array(join(x))) for x in _FIGURES}
            cells["digest"] = one(pa.array([x for g in got for x in g.digest], pa.string()))
            cells |= {"n_pairs": one(pa.array(join("n_pairs").astype(np.int32))),
                      "place": one(pa.array(place.reshape(-1).astype(np.int32))),
                      "times": one(pa.array(times.astype(np.int32))),
                      "pairs": one(pa.array(pairs)), "links": one(pa.array(links))}
            return pa.RecordBatch.from_arrays(list(cells.values()), names=list(cells))

        for batch in batches:
            column = pc.fill_null(batch.column(1), "")
            for lo, hi, buf, off in chunks(column, PART):
                got.append(align(column.slice(lo, hi - lo), buf, off, a, b))
                ids.append(batch.column(0).slice(lo, hi - lo))
                held += len(buf) + hi - lo
                if held >= BLOCK:
                    yield row()
                    number, ids, got, held = number + 1, [], [], 0
                    pa.default_memory_pool().release_unused()
        if got:
            yield row()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(run, schema)


def aligned(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json",
            model: str = "piece_bpe_32k.model", doc_id: str = "doc_id", text: str = "text"
            ) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per document."""
    kind = docs.schema[doc_id].dataType.simpleString()
    table = written(blocks(docs, vocabulary, model, doc_id, text), "alignment",
                    {"parquet.block.row.count.limit": 1})
    pairs = table.select("block", F.posexplode(F.arrays_zip("pairs", "links")).alias("pos", "p")) \
        .select("block", "pos", F.col("p.pairs").alias("pair"), F.col("p.links").alias("links"))
    counts = written(pairs.groupBy("pair").agg(F.sum("links").alias("count")), "alignment-counts")
    b_id = F.pmod("pair", F.lit(WIDTH))
    best = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("best"))
    answers = pairs.drop("links").join(counts, "pair") \
        .join(F.broadcast(best), b_id == F.col("b")) \
        .select("block", "pos", "count", (F.col("count") == F.col("best")).alias("is_best"))

    names = ("doc_id", *_FIGURES, "n_best", "count_sum", "groups_sha256")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left.column(c).combine_chunks().flatten() for c in left.column_names if c != "block"}
        pos = right.column("pos").to_numpy()
        count, best_ = np.zeros(len(pos), np.int64), np.zeros(len(pos), bool)
        count[pos] = right.column("count").to_numpy()
        best_[pos] = right.column("is_best").to_numpy()
        place, times = row["place"].to_numpy(), row["times"].to_numpy().astype(np.int64)
        at = np.concatenate([[0], np.cumsum(row["n_pairs"].to_numpy())])
        total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[at])
        return pa.table({
            "doc_id": row["doc_ids"], **{x: row[x] for x in _FIGURES},
            "n_best": pa.array(total(times * best_[place])),
            "count_sum": pa.array(total(times * count[place])), "groups_sha256": row["digest"]})

    # read anew: a table's two uses in one join must not share their columns
    documents = table.sparkSession.read.schema(table.schema).parquet(table._riverbed_path) \
        .drop("pairs", "links")
    return documents.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, f"doc_id {kind}, " + "".join(f"{x} long, " for x in names[1:-1]) + "groups_sha256 string")
