"""SimHash near-dedup with a byte-position inverted index and count filtering.

A fingerprint has 64 bits, eight bytes at eight positions. Two fingerprints
that differ in at most ``max_bits`` bits differ in at most that many bytes, so
they share at least ``8 - max_bits`` positional bytes. The index posts every
distinct fingerprint under the positional bytes it would have to share with a
partner: with a guaranteed minimum of five of eight, any seven positions hold at
least four of them, so it posts under each four of the first seven (a posting
list is one choice of positions with its byte values). For two members of a
list all eight positional bytes are tallied; pairs that reach the minimum are
verified by their bit distance.

``posted`` (positional bytes a list fixes) trades postings for list length and
never changes a link. Of N evenly spread fingerprints, three give 20 postings
each and N / 2^24 members a list; four give 35 and N / 2^32; five give 56 and
N / 2^40. At 4 x 10^10 documents (100 TB) that is some 10^15, 7 x 10^12 and
4 x 10^10 compared pairs, while the shuffled postings grow from 20 to 35 and 56.

Equal fingerprints are folded first, so copies cost one posting. A list longer
than ``BLOCK`` is cut into blocks by hash, and every two blocks meet in a task
of their own: no list is capped and none is gathered whole. Within a task a
list gives links that span its linked groups, not all of their pairs. The
links' connected components are found with :func:`graph.components`.

Defined results: a text without words (null and empty too) has fingerprint
zero and is linked like any other; fewer words than a shingle make one shingle;
rows that repeat are linked by their equal fingerprints; a null doc_id is never
a component's id unless all its ids are null.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .base import written
from .graph import components

SEED = 42
#: positional bytes that a posting list fixes
POSTED = 4
BLOCK = 2048
_PART = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bitwise majority of the shingles' XXH64 values."""
    words = (text or "").encode().lower().split()     # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    start = np.cumsum(size) - size
    end = (start + size - 1)[min(shingle, len(words)) - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for lo in range(0, n, _PART):
        part = np.array([digest(line[a:b], SEED) for a, b in zip(
            start[lo:min(n, lo + _PART)].tolist(), end[lo:lo + _PART].tolist())], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = 3) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed long."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = [fingerprint(x, shingle) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.array(found, np.uint64).view(np.int64))],
                    names=["doc_id", "fp"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, fp long")


class Index:
    """Which positions are posted for a bit limit, and the tests on candidate pairs."""

    def __init__(self, max_bits: int, posted: int = POSTED):
        self.max_bits, self.least = max_bits, 8 - max_bits
        if not 0 < self.least <= 8:
            raise ValueError("max_bits must be 0 to 7")
        if not 0 < posted <= 7:
            raise ValueError("posted must be 1 to 7")     # list number and bytes share one long
        # any `span` positions hold at least `chosen` shared ones
        self.chosen = min(posted, self.least)
        self.span = 8 - self.least + self.chosen
        self.posts = list(combinations(range(self.span), self.chosen))
        rank = {c: i for i, c in enumerate(self.posts)}
        # per set of shared positions: the one list in which its pair is reported
        self.home = np.full(256, -1, np.int64)
        for bits in range(256):
            shared = [i for i in range(self.span) if bits >> i & 1]
            if len(shared) >= self.chosen:
                self.home[bits] = rank[tuple(shared[:self.chosen])]

    def lists(self):
        """Column: the posting lists of ``fp`` as longs (list number above the byte values)."""
        out = []
        for i, places in enumerate(self.posts):
            key = F.lit(i).cast("long")
            for p in places:
                key = key * 256 + F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
            out.append(key)
        return F.array(*out)

    def linked(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For differences ``x = a ^ b``: whether linked, and the shared positions as bits."""
        same = x[..., None].view(np.uint8).reshape(*x.shape, 8) == 0
        ok = same.sum(-1) >= self.least
        ok[ok] = np.bitwise_count(x[ok]) <= self.max_bits
        return ok, np.packbits(same, axis=-1, bitorder="little")[..., 0]

    def links(self, lists: np.ndarray, post: np.ndarray, fp: np.ndarray,
              short: int = 48) -> tuple[np.ndarray, np.ndarray]:
        """Links among runs of equal ``lists`` values (sorted); ``post`` numbers the posting."""
        cut = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1], True])
        size = np.diff(cut)
        run = np.repeat(np.arange(len(size)), size)
        left, right = [], []
        small = np.flatnonzero(size[run] <= short)
        f, r, h = fp[small], run[small], post[small]
        for d in range(1, min(short, int(size.max(initial=0))) + 1):
            at = np.flatnonzero(r[d:] == r[:-d]) if d < len(r) else np.zeros(0, int)
            if not len(at):
                break
            ok, bits = self.linked(f[at] ^ f[at + d])
            ok &= self.home[bits] == h[at]
            left.append(f[at[ok]])
            right.append(f[at[ok] + d])
        for k in np.flatnonzero(size > short):
            a, b = self._span(np.unique(fp[cut[k]:cut[k + 1]]))
            left.append(a)
            right.append(b)
        none = np.zeros(0, np.uint64)
        return np.concatenate([none, *left]), np.concatenate([none, *right])

    def _span(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links that span the linked groups of one long list: each member is compared
        only with those not yet reached."""
        left, right, queue = [], [], []
        while len(rest):
            if not queue:
                queue, rest = [rest[0]], rest[1:]
            x = queue.pop()
            ok, _ = self.linked(rest ^ x)
            near = rest[ok]
            if len(near):
                left.append(np.full(len(near), x, np.uint64))
                right.append(near)
                queue.extend(near)
                rest = rest[~ok]
        none = np.zeros(0, np.uint64)
        return np.concatenate([none, *left]), np.concatenate([none, *right])


def links(prints: DataFrame, max_bits: int = 3, posted: int = POSTED) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that span every
    group linked by ``max_bits`` or fewer differing bits, whatever ``posted`` is."""
    index = Index(max_bits, posted)
    width = 8 * index.chosen
    postings = prints.select("fp", F.explode(index.lists()).alias("list"))
    long_lists = postings.groupBy("list").count().where(F.col("count") > BLOCK) \
        .select("list", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    met = postings.join(long_lists, "list", "left") \
        .withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("mine", mine) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("list", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                "fp")

    def run(batches):
        keep = None
        for batch in batches:
            now = [np.array(batch.column(i)) for i in range(4)]
            if keep is not None:
                now = [np.concatenate(x) for x in zip(keep, now)]
            # the last run may go on in the next batch
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1])
                                  | (now[2] != now[2][-1]))
            cut = last[-1] + 1 if len(last) else 0
            keep = [x[cut:] for x in now]
            if cut:
                yield found([x[:cut] for x in now])
        if keep is not None and len(keep[0]):
            yield found(keep)

    def found(rows):
        lists, i, j, fp = rows
        change = np.r_[True, (lists[1:] != lists[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
        a, b = index.links(np.cumsum(change), lists >> width, fp.astype(np.int64).view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                          names=["a", "b"])

    return met.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j") \
        .mapInArrow(run, "a long, b long")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
           max_bits: int = 3, posted: int = POSTED) -> DataFrame:
    """``doc_id, fp, component_id`` per document; the id is the smallest doc_id reachable."""
    prints = written(fingerprints(docs, doc_id, text, shingle), "simhash-prints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    labels = components(links(nodes, max_bits, posted))
    owned = nodes.join(labels, nodes["fp"] == labels["node"], "left") \
        .select("fp", "rep", F.coalesce("label", "fp").alias("label"))
    owned = written(owned, "simhash-owned")
    ids = written(owned.groupBy("label").agg(F.min("rep").alias("component_id")), "simhash-reps")
    # one row per fingerprint, written so that a hot fingerprint's documents can be split
    by_print = written(owned.join(ids, "label").select("fp", "component_id"), "simhash-ids")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The documents that are their component's id, with all their columns.

    Rows that share a doc_id are one document: they stay or go together.
    """
    found = groups(docs, doc_id, text, shingle, max_bits)
    gone = found.groupBy("doc_id").agg(
        F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept")) \
        .where("NOT kept").select(F.col("doc_id").alias("_id"))
    # the same plan at every size: rows shuffled by id, never a broadcast that stops fitting
    return docs.join(gone.hint("shuffle_hash"), docs[doc_id].eqNullSafe(gone["_id"]), "left_anti")
