"""Sharding by a Feistel permutation of global row numbers, in DataFrame functions only.

Rows are numbered 0 .. n-1 in the order of (bucket of doc_id, doc_id, text
checksum): every bucket is ranked on its own, and bucket offsets come from at
most ``BUCKETS`` counts, so no task ever ranks the whole table. The number
``r`` is permuted by a keyed Feistel network on pairs (left, right) below
``side = ceil(sqrt(n))``; images outside 0 .. n-1 are permuted again (cycle
walking) until they fall inside, which makes it a bijection of 0 .. n-1. The
law is ``rows``: the permuted number ``p`` gives shard ``p mod shards`` and
slot ``p div shards``, so counts differ by one at most and slots have no gaps.
Both can be computed for any row number without the data, and the same key
gives the same order on every run.

Defined results: a null text has size ``OVERHEAD`` and the checksum of no
bytes; rows that repeat (same doc_id and text) take different slots, which of
them gets which is immaterial as they are identical; a null doc_id is an id of
its own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import written

BUCKETS = 4096
ROUNDS = 6
#: Feistel images per job before rows still outside are looked for
STEPS = 4
OVERHEAD = 16
#: copies of one row that one task numbers at a time
STRIDE = 1 << 16


def feistel(x: Column, side: int, key: int) -> Column:
    """One pass of the network: a permutation of 0 .. side**2 - 1."""
    left, right = F.floor(x / F.lit(side)).cast("long"), F.pmod(x, F.lit(side).cast("long"))
    pair = F.struct(left.alias("l"), right.alias("r"))

    def step(acc: Column, i: Column) -> Column:
        turned = F.pmod(acc["l"] + F.pmod(F.xxhash64(acc["r"], i), F.lit(side).cast("long")),
                        F.lit(side).cast("long"))
        return F.struct(acc["r"].alias("l"), turned.alias("r"))

    rounds = F.array(*(F.lit(key * 1000 + i).cast("long") for i in range(ROUNDS)))
    return F.aggregate(rounds, pair, step, lambda acc: acc["l"] * F.lit(side) + acc["r"])


def numbered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, row``: global row numbers without gaps.

    Rows equal in all three columns are one row with a count until they are numbered, so
    that no bucket grows with the copies of a row; the copies are dealt out in two steps.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).alias("doc_id"),
                       (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32")) \
        .groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies")) \
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(BUCKETS)).cast("int"))
    rows = written(rows, "shard-rows")
    counts = rows.groupBy("bucket").agg(F.sum("copies").alias("count"))      # BUCKETS rows at most
    offsets = counts.select("bucket", (F.sum("count").over(Window.orderBy("bucket"))
                                       - F.col("count")).alias("offset"))
    within = Window.partitionBy("bucket").orderBy("doc_id", "text_crc32", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("offset") + F.coalesce(F.sum("copies").over(within), F.lit(0))
    placed = rows.join(F.broadcast(offsets), "bucket") \
        .select("doc_id", "size", "text_crc32", "copies", first.alias("first"))
    one = placed.where("copies = 1").select("doc_id", "size", "text_crc32", F.col("first").alias("row"))
    many = placed.where("copies > 1").withColumn(
        "at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(STRIDE).cast("long")))) \
        .repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "first", "at")
    last = F.least(F.col("copies"), F.col("at") + STRIDE) - 1
    dealt = F.explode(F.sequence(F.col("first") + F.col("at"), F.col("first") + last))
    return one.unionByName(many.select("doc_id", "size", "text_crc32", dealt.alias("row")))


def assign(docs: DataFrame, shards: int, key: int = 7, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, row, shard, slot`` for every document."""
    rows = numbered(docs, doc_id, text)
    rows = written(rows.withColumn("image", F.col("row")), "shard-numbers")
    n = rows.count()
    side = 1
    while side * side < n:
        side += 1 if side * side * 4 > n else side
    cols = ["doc_id", "size", "text_crc32", "row"]
    done = None
    walk, first = rows, True
    while True:
        image = F.col("image")
        for i in range(STEPS):
            again = feistel(image, side, key)
            image = again if first and i == 0 else F.when(image >= n, again).otherwise(image)
        walk = walk.select(*cols, image.alias("image"))
        # outside points number 2 * side at most, so the rows left shrink at once
        walk = written(walk, "shard-walk")
        inside = walk.where(F.col("image") < n)
        done = inside if done is None else done.unionByName(inside)
        walk, first = walk.where(F.col("image") >= n), False
        if n == 0 or walk.isEmpty():
            break
    return done.select(*cols, F.pmod("image", F.lit(shards)).cast("int").alias("shard"),
                       F.floor(F.col("image") / shards).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, key: int = 7,
                 doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the documents as folders ``shard=k``, each sorted by slot.

    The join is on (doc_id, checksum); rows that repeat both are identical in
    id and text and are numbered among themselves by ``row_number`` first.
    """
    twin = Window.partitionBy("doc_id", "text_crc32")
    places = assign(docs, shards, key, doc_id, text) \
        .withColumn("_twin", F.row_number().over(twin.orderBy("row"))) \
        .select(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc"), "_twin",
                "shard", "slot")
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    full = docs.withColumn("_c", crc).withColumn("_t", F.row_number().over(
        Window.partitionBy(doc_id, "_c").orderBy(F.lit(0))))
    joined = full.join(places, full[doc_id].eqNullSafe(places["_id"])
                       & (F.col("_c") == F.col("_crc")) & (F.col("_t") == F.col("_twin")))
    joined.drop("_c", "_t", "_id", "_crc", "_twin") \
        .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)
