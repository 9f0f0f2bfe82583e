"""Exact dedup by progressive refinement, in DataFrame functions only.

Texts are equal when identical after replacing each run of white space by one
space. Documents are grouped by length of the normalised text; only groups of
two or more are split by a hash of a prefix; only groups that survive this are
split by the SHA-256 of the full normalised text. Full content is read again
only for survivors: the surviving (length, prefix hash) groups set one bit each
in a bitmap of ``BITS`` bits a group, and the hash is taken where a row's bit is
set. The bitmap is broadcast in rows of 4 KB and has at most ``MAX_BITS`` bits
(32 MB) whatever the corpus. A bit shared with a group that did not survive
costs one needless hash, never a wrong result: of the rows without a partner at
most one in ``BITS`` up to ``MAX_BITS / BITS`` surviving groups (16 million),
more beyond. Texts are normalised twice, once for the groups and once for the
hashes, and ``refine`` moves none of them: what crosses its shuffles are a few
numbers and a hash per document, and counts are pre-aggregated per task.
(``drop_copies`` then moves the documents once, by id.)

Defined results: a null text equals the empty text; the row with the smallest
doc_id of a group stays (a null id sorts last); of rows that repeat that
doc_id and text exactly one stays; rows of an empty table give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import SPACE, written

PREFIX = 128
#: bits per surviving group, and the least and most bits of the broadcast bitmap
BITS, MIN_BITS, MAX_BITS = 16, 1 << 18, 1 << 28


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE + "+", " ")


def _bit(bits: int) -> Column:
    """A group's bit, numbered from 1."""
    return F.pmod(F.xxhash64("len", "head"), F.lit(bits)) + 1


def _bitmap_bits(groups: int) -> int:
    """A power of two of at least ``BITS`` bits a group, within the bounds."""
    return min(MAX_BITS, max(MIN_BITS, 1 << max(0, groups * BITS - 1).bit_length()))


def _bitmap(groups: DataFrame, bits: int) -> DataFrame:
    """``bucket, bitmap``: the bits of the groups, at most ``bits`` / 8 bytes in all."""
    return groups.select(_bit(bits).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap"))


def _is_set(bitmap: str, bit: Column) -> Column:
    """Whether a bucket's bitmap (null: no bits) holds a bit."""
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.coalesce(F.getbit(byte.cast("int"), place.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))


def refine(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           prefix: int = PREFIX, digest: bool = False) -> DataFrame:
    """``doc_id, keep_id, group_size, kept``: one row per document.

    ``digest`` adds ``text_sha256`` of the normalised text, for every row.
    """
    extra = ["text_sha256"] if digest else []
    norm = docs.select(F.col(doc_id).alias("doc_id"), normalised(text).alias("norm")) \
        .select("doc_id", F.length("norm").alias("len"), "norm")
    head = F.xxhash64(F.substring("norm", 1, prefix)).alias("head")
    # stage 1: length groups; stage 2: prefix hashes inside them
    by_head = written(norm.select("len", head).groupBy("len", "head").count(), "exact-heads")
    by_len = by_head.groupBy("len").agg(F.sum("count").alias("rows")).where("rows > 1").select("len")
    alive = written(by_head.where("count > 1").join(by_len, "len", "left_semi").select("len", "head"),
                    "exact-alive")
    bits = _bitmap_bits(alive.count())
    # stage 3: the full hash, only where a group survived
    keyed = norm.select("doc_id", "len", head, "norm") \
        .withColumn("bucket", F.bitmap_bucket_number(_bit(bits))) \
        .join(F.broadcast(_bitmap(alive, bits)), "bucket", "left") \
        .select("doc_id", "len", "head", F.monotonically_increasing_id().alias("row"),
                F.when(_is_set("bitmap", _bit(bits)), F.unhex(F.sha2(F.col("norm"), 256))).alias("full"),
                *(F.sha2(F.col("norm"), 256).alias(x) for x in extra))
    keyed = written(keyed, "exact-keys")
    alone = keyed.where("full IS NULL").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), *extra)
    shared = keyed.where("full IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    # written, so that the join has two plain exchanges and a hot group's rows can be split
    groups = written(shared.groupBy("len", "head", "full").agg(
        first.alias("first"), F.count("*").alias("group_size")), "exact-firsts")
    joined = shared.join(groups, ["len", "head", "full"])
    return alone.unionByName(joined.select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), *extra))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    Dropped ids are removed by an anti-join. Where a doc_id itself repeats, the
    join cannot tell its rows apart, so those rows (and no others) are ranked
    per (doc_id, normalised text); a rank limit is applied before their shuffle.
    """
    found = written(refine(docs, doc_id, text), "exact-groups")
    ids = found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("kept").alias("kept"))
    gone = ids.where("rows = 1 AND NOT kept").select(F.col("doc_id").alias("__exact_id"))
    # the same plan at every size: rows shuffled by id, never a broadcast that stops fitting
    out = docs.join(gone.hint("shuffle_hash"), docs[doc_id].eqNullSafe(gone["__exact_id"]), "left_anti")
    repeats = written(ids.where("rows > 1").select(F.col("doc_id").alias("__exact_id")), "exact-repeats")
    if repeats.isEmpty():
        return out
    once = docs.join(repeats, docs[doc_id].eqNullSafe(repeats["__exact_id"]), "left_semi") \
        .withColumn("__exact_norm", F.sha2(normalised(text), 256)) \
        .withColumn("__exact_rank", F.row_number().over(
            Window.partitionBy(doc_id, "__exact_norm").orderBy(F.lit(0)))) \
        .where("__exact_rank = 1").drop("__exact_rank")
    lowest = docs.select(F.sha2(normalised(text), 256).alias("__exact_h"), F.col(doc_id).alias("__exact_d")) \
        .groupBy("__exact_h").agg(F.min(F.struct(F.col("__exact_d").isNull().alias("n"), "__exact_d")).alias("__exact_m")) \
        .select("__exact_h", F.col("__exact_m.__exact_d").alias("__exact_low"))
    once = once.join(lowest, once["__exact_norm"] == lowest["__exact_h"]) \
        .where(F.col(doc_id).eqNullSafe(F.col("__exact_low"))).drop("__exact_norm", "__exact_h", "__exact_low")
    plain = out.join(repeats, out[doc_id].eqNullSafe(repeats["__exact_id"]), "left_anti")
    return plain.unionByName(once)
