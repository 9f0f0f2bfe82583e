"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

Documents are put in ascending doc_id order by one range shuffle (rows that share a
doc_id may lie in several ranges, by a hash of their text and their place), tokenised,
and written in segments of about ``SEGMENT`` ids. A segment is self-contained:
its ids are ranked by their frequency in it (ties by id), and the ranks are
coded in one to four little-endian bytes each. The byte counts stand apart, in
control bytes of two bits an id, so a reader finds all code positions with one
table lookup per control byte and a cumulative sum, and all values with numpy
gathers; frequent ids take one byte.

A file set is a Parquet folder (so that it can live in any store Spark
reaches) with one row per segment:

``part``        range partition; parts ascend with doc_id
``segment``     number within the part, ascending
``n_tokens``    ids in the segment
``doc_ids``     documents of the segment, ascending
``lengths``     ids of each document, end id included
``ranked``      the segment's distinct ids, uint32, most frequent first
``control``     two bits per id, lowest first: bytes of its code minus one
``data``        the codes

Defined results: the string of an added token of the vocabulary gives that token's
id wherever it stands in a text; a null or empty text has the end id only; rows that share a
doc_id follow each other in any order; null doc_ids come first; an empty table
gives an empty file set.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .base import chunks, local_path
from .pieces import PieceCoder

END_ID = 2
SEGMENT = 1 << 20
_U1, _U4 = np.dtype("u1"), np.dtype("<u4")
#: the four code lengths that a control byte stands for
LENGTHS = (((np.arange(256)[:, None] >> (2 * np.arange(4))) & 3) + 1).astype(np.int64)
_KEEP = np.arange(4) < np.arange(1, 5)[:, None]


def pack(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """``ranked, control, data`` of one segment."""
    if len(ids) and int(ids.max()) < 1 << 22:       # a vocabulary: count by id
        counts = np.bincount(ids)
        values = np.flatnonzero(counts)
        counts, inverse = counts[values], ids
        place = np.zeros(values[-1] + 1, _U4)
    else:
        values, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
        inverse = inverse.reshape(-1)
        place = np.empty(len(values), _U4)
    order = np.lexsort((values, -counts))
    place[values[order] if inverse is ids else order] = np.arange(len(order), dtype=_U4)
    codes = place[inverse]
    size = 1 + (codes > 0xFF).astype(np.uint8) + (codes > 0xFFFF) + (codes > 0xFFFFFF)
    data = codes.view(_U1).reshape(-1, 4)[_KEEP[size - 1]]
    bits = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    bits[:len(codes)] = size - 1
    bits = bits.reshape(-1, 4)
    control = bits[:, 0] | bits[:, 1] << 2 | bits[:, 2] << 4 | bits[:, 3] << 6
    return values[order].astype(_U4).tobytes(), control.tobytes(), data.tobytes()


def unpack(ranked: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ids of one segment (uint32)."""
    size = LENGTHS[np.frombuffer(control, _U1)].reshape(-1)[:n]
    start = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", _U1)
    codes = raw[start].astype(_U4)
    for i in range(1, int(size.max()) if n else 0):
        longer = np.flatnonzero(size > i)
        codes[longer] |= raw[start[longer] + i].astype(_U4) << _U4.type(8 * i)
    return np.frombuffer(ranked, _U4)[codes]


def byte_alphabet() -> dict[int, int]:
    """Byte -> the character that byte-level vocabularies spell it with: printable
    Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in plain)
    return {b: b for b in plain} | {b: 0x100 + i for i, b in enumerate(rest)}


def added_tokens(vocabulary: str) -> dict[bytes, int]:
    """Added tokens of a vocabulary file: the literal bytes of each, and its id."""
    with open(local_path(vocabulary), encoding="utf-8") as f:
        listed = [t for t in json.load(f)["added_tokens"] if t["content"]]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in listed) \
            or len({t["normalized"] for t in listed}) > 1:
        raise ValueError(f"{vocabulary}: only added tokens that match literally are supported")
    return {t["content"].encode(): t["id"] for t in listed}


class TextCoder(PieceCoder):
    """Piece coder that first cuts every document at the added tokens' strings, as the
    library does: leftmost match, the longest of several; what lies between is split
    into pieces as if it were a document of its own."""

    def __init__(self, encode: Callable[[bytes], list[int]], added: dict[bytes, int]):
        super().__init__(encode)
        self.added = added
        longest = sorted(added, key=len, reverse=True)
        self.find = re.compile(b"|".join(map(re.escape, longest))) if added else None

    def chunk(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = buf.tobytes()
        if self.find is None or not self.find.search(raw):
            return super().chunk(buf, off)
        # document by document: a match never spans two
        found = [m for lo, hi in zip(off[:-1].tolist(), off[1:].tolist())
                 for m in self.find.finditer(raw, lo, hi)]
        first = np.array([m.start() for m in found], np.int64)
        last = np.array([m.end() for m in found], np.int64)
        here = np.array([self.added[m.group()] for m in found], np.uint32)
        # the texts without the matches, cut where a match was
        inside = np.zeros(len(buf) + 1, np.int64)
        inside[first] += 1
        np.subtract.at(inside, last, 1)
        kept = np.cumsum(inside[:-1]) == 0
        gone = np.concatenate([[0], np.cumsum(last - first)])
        before = np.searchsorted(last, off, "right")        # matches before each document edge
        cut, edge = first - gone[:-1], off - gone[before]
        all_cuts = np.sort(np.concatenate([cut, edge]))
        ids, at = super().chunk(buf[kept], all_cuts)
        place = at[np.searchsorted(all_cuts, cut)]
        return np.insert(ids, place, here), at[np.searchsorted(all_cuts, edge)] + before


_coders: dict[str, TextCoder] = {}


def coder(vocabulary: str) -> TextCoder:
    """One tokenizer per worker process and vocabulary.

    Texts are cut at the added tokens; pieces go straight to the library's merge
    model, in its byte alphabet: what the whole tokenizer does to a text once it
    is split (it has no normaliser).
    """
    if vocabulary not in _coders:
        from tokenizers import Tokenizer
        model, alphabet = Tokenizer.from_file(local_path(vocabulary)).model, byte_alphabet()

        def encode(piece: bytes) -> list[int]:
            return [t.id for t in model.tokenize(piece.decode("latin-1").translate(alphabet))]
        _coders[vocabulary] = TextCoder(encode, added_tokens(vocabulary))
    return _coders[vocabulary]


def _schema(kind: str) -> str:
    return (f"part int, segment int, n_tokens long, doc_ids array<{kind}>, lengths array<int>, "
            "ranked binary, control binary, data binary")


def write(docs: DataFrame, path: str, vocabulary: str = "byte_bpe_50k.json", end_id: int = END_ID,
          doc_id: str = "doc_id", text: str = "text") -> None:
    """Tokenise all documents and write the file set."""
    kind = docs.schema[doc_id].dataType.simpleString()
    names = [x.split()[0] for x in _schema(kind).split(", ")]

    def run(batches):
        code, part, segment = coder(vocabulary), TaskContext.get().partitionId(), 0
        ids, docs_in, sizes, held, out_schema = [], [], [], 0, None

        def row():
            stream = np.concatenate(ids)
            cells = [part, segment, len(stream), docs_in, np.concatenate(sizes), *pack(stream)]
            return pa.RecordBatch.from_pylist([dict(zip(names, cells))], schema=out_schema)

        for batch in batches:
            out_schema = out_schema or pa.schema([
                ("part", pa.int32()), ("segment", pa.int32()), ("n_tokens", pa.int64()),
                ("doc_ids", pa.list_(batch.schema.field(0).type)), ("lengths", pa.list_(pa.int32())),
                ("ranked", pa.binary()), ("control", pa.binary()), ("data", pa.binary())])
            for lo, hi, buf, off in chunks(batch.column(1)):
                got, at = code.chunk(buf, off)
                # each document's ids, then the end id
                ids.append(np.insert(got, at[1:], end_id).astype(_U4))
                sizes.append((np.diff(at) + 1).astype(np.int32))
                docs_in += batch.column(0).slice(lo, hi - lo).to_pylist()
                held += len(ids[-1])
                if held >= SEGMENT:
                    yield row()
                    segment += 1
                    ids, docs_in, sizes, held = [], [], [], 0
        if docs_in:
            yield row()

    docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")) \
        .withColumn("hash", F.xxhash64("text")) \
        .repartitionByRange("doc_id", "hash", F.monotonically_increasing_id()) \
        .sortWithinPartitions("doc_id", "hash").drop("hash") \
        .mapInArrow(run, _schema(kind)).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, decoded from the files.

    ``start`` counts the ids of all documents before it: the position in its
    segment, plus the segments before it in its part, plus the parts before it
    (one row per part).
    """
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                stream = unpack(row["ranked"], row["control"], row["data"], row["n_tokens"])
                sizes = np.array(row["lengths"], np.int64)
                at = np.concatenate([[0], np.cumsum(sizes)])
                raw, n = memoryview(stream.astype(_U4).tobytes()), len(sizes)
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()),
                     pa.array([row["segment"]] * n, pa.int32()),
                     pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                     pa.array(at[:-1]), pa.array(sizes), pa.array(crc, pa.int64())],
                    names=["part", "segment", "doc_id", "at", "n_tokens", "ids_crc32"])

    docs = files.mapInArrow(run, f"part int, segment int, doc_id {kind}, at long, n_tokens long, "
                                 "ids_crc32 long")
    sizes = files.select("part", "segment", "n_tokens")
    in_part = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    by_segment = sizes.select("part", "segment", F.coalesce(
        F.sum("n_tokens").over(in_part), F.lit(0)).alias("seg_start"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    return docs.join(by_segment.join(by_part, "part"), ["part", "segment"]).select(
        "doc_id", (F.col("part_start") + F.col("seg_start") + F.col("at")).alias("start"),
        "n_tokens", "ids_crc32")
