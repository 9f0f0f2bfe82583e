"""Mixing sources to target weights by hash-threshold histograms.

Sizes are word counts. Sources, ordered by code point with null last, weigh
3, 1, 2, repeating, and share ``share`` times all words; a target stops at
``cap`` times its source's words and the excess is shared again by weight
until no target is above (water filling).

A document whose source has target ``t`` and size ``s`` is taken
``floor(t / s)`` times, and once more if the hash of its id lies below its
source's threshold. The threshold is found from histograms: words per (source,
hash bucket) give nested cumulative budgets; the bucket in which the budget
ends is the only one refined by the next digits of the hash, and so on; no
rows are sorted and none are compared with each other. The extra copies end at
the document whose inclusion brings the source nearest to its budget.

Thresholds depend on the ids alone, so reruns agree, and a smaller budget
takes a subset of a larger one's documents.

Defined results: a null text has size 0 and is taken with 0 words; a null id
has a hash like any other; rows that share an id share its fate; sources
without words have target 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import n_words, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
#: hexadecimal digits of the hash per level (4096 buckets) and number of levels
DIGITS, LEVELS = 3, 8


def doc_hash(doc_id: str) -> Column:
    """Hash of an id as 24 hexadecimal digits, uniform over ids."""
    return F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
                             .cast("binary")), 1, DIGITS * LEVELS)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            cap: int = CAP) -> DataFrame:
    """``source, source_size, weight, target`` per source (one small row each).

    Each round of the water filling is one aggregate over the sources; only
    its three sums reach the driver.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    kinds = F.array(*(F.lit(w) for w in weights))
    per = written(per.withColumn("weight", F.get(kinds, F.pmod(place, F.lit(len(weights))))),
                  "mix-sources")
    limit = F.col("source_size") * cap
    total = per.agg(F.sum("source_size")).head()[0] or 0
    level, seen = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) > limit
        n, full, rest = per.agg(
            F.count(F.when(over, 1)), F.sum(F.when(over, limit).otherwise(0)),
            F.sum(F.when(over, 0).otherwise(F.col("weight")))).head()
        if n == seen or not rest:
            break
        level, seen = (share * total - full) / rest, n
    if level is None:
        level = 0.0
    target = F.least(F.col("weight") * F.lit(float(level)), limit.cast("double"))
    return per.select("source", "source_size", "weight", target.alias("target"))


def _threshold(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """``source, limit``: hashes at or below ``limit`` get the extra copy ('' for none)."""
    live = plan.select("source", F.lit("").alias("prefix"), F.col("budget").alias("left"))
    ends = None
    for depth in range(1, LEVELS + 1):
        cells = sizes.alias("s").join(
            live.alias("l"),
            F.col("s.source").eqNullSafe(F.col("l.source"))
            & F.startswith(F.col("s.hash"), F.col("l.prefix"))) \
            .groupBy("l.source", "l.left",
                     F.substring("s.hash", 1, depth * DIGITS).alias("cell")) \
            .agg(F.sum("s.size").alias("words"), F.count("*").alias("rows"))
        # 4096 cells per source at most
        run = Window.partitionBy("source").orderBy("cell")
        cells = cells.withColumn("upto", F.sum("words").over(run)) \
            .withColumn("before", F.col("upto") - F.col("words"))
        # the boundary cell is the first whose end passes the budget
        edge = cells.where(F.col("upto") > F.col("left")).groupBy("source").agg(
            F.min(F.struct("cell", "before", "words", "rows", "left")).alias("e")) \
            .select("source", "e.*")
        edge = written(edge, "mix-edge")
        small = (F.col("rows") == 1) | F.lit(depth == LEVELS)
        nearer = F.col("before") + F.col("words") - F.col("left") < F.col("left") - F.col("before")
        found = edge.where(small).select(
            "source", F.when(nearer, F.concat("cell", F.lit("~"))).otherwise(F.col("cell"))
            .alias("limit"))
        ends = found if ends is None else ends.unionByName(found)
        live = edge.where(~small).select("source", F.col("cell").alias("prefix"),
                                         (F.col("left") - F.col("before")).alias("left"))
        if live.isEmpty():
            break
    return ends


def plan(sizes: DataFrame, **rule) -> DataFrame:
    """``source, source_size, target, whole, limit``: a document is taken ``whole`` times,
    once more if its hash is below ``limit``. One row per source."""
    goal = targets(sizes, **rule)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))) \
        .otherwise(F.lit(0)).cast("long")
    goal = goal.withColumn("whole", whole) \
        .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    goal = written(goal, "mix-plan")
    ends = _threshold(sizes, goal)
    out = goal.alias("p").join(ends.alias("e"),
                               F.col("p.source").eqNullSafe(F.col("e.source")), "left") \
        .select("p.source", "source_size", "target", "whole",
                F.coalesce("limit", F.lit("")).alias("limit"))
    return written(out, "mix-limits")


def _sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return written(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(text).alias("size"),
        doc_hash(doc_id).alias("hash")), "mix-sizes")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        **rule) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies``: one row per document."""
    sizes = _sizes(docs, doc_id, text, source)
    out = sizes.alias("s").join(plan(sizes, **rule).alias("p"),
                                F.col("s.source").eqNullSafe(F.col("p.source")))
    extra = (F.col("hash") < F.col("limit")).cast("long")
    return out.select("s.doc_id", "s.source", "s.size", "source_size", "target",
                      (F.col("whole") + extra).alias("copies"))


def take(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         **rule) -> DataFrame:
    """The mixed documents, all columns: every row as often as the mix takes it.

    Joined on the source only, so rows that share an id are never multiplied.
    """
    rules = plan(_sizes(docs, doc_id, text, source), **rule) \
        .select(F.col("source").alias("__mix_source"), F.col("whole").alias("__mix_whole"),
                F.col("limit").alias("__mix_limit"))
    copies = F.col("__mix_whole") + (doc_hash(doc_id) < F.col("__mix_limit")).cast("long")
    return docs.join(rules, docs[source].eqNullSafe(rules["__mix_source"])) \
        .withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int")))) \
        .select(*docs.columns)
