"""Language identification by nearest centroid.

A text becomes a vector of hashed letter n-grams (two and three bytes of the
lower-cased text, everything but letters folded to a blank), weighted by
``log(1 + tf) * idf`` and normalised. Every language has several centroids:
spherical k-means of its training vectors. A text takes the language of the
centroid with the largest cosine; its distance, ``1 - cosine``, is compared
with the distances seen in training, and a text that lies further out than
``reject_quantile`` of the language's training rows is marked rejected.

The classifier (idf and centroids) is fitted on a bounded sample: at most
``per_lang`` documents of each language, those with the smallest hash of doc_id, and
fewer of each if there are so many languages that ``most_rows`` would be passed. However
often rows repeat, a doc_id counts once per language. Only the sample's vectors reach
the driver (``most_rows * DIMS`` floats). Prediction reads every whole text, in one pass without a shuffle.

Defined results: null texts and texts without a letter are ``und`` with score
0 and count as rejected; rows without a language teach nothing; with no
training rows at all every text is ``und``; repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import chunks, written

DIMS = 4096
SALTS = 32
UND = "und"


@dataclass(frozen=True)
class Fit:
    per_lang: int = 600
    most_rows: int = 4800       # of all languages together: bounds the driver's table
    centroids: int = 4
    rounds: int = 12
    reject_quantile: float = 0.999
    seed: int = 5


_FOLD = np.full(256, 32, np.uint64)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def counts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """n-gram counts, one row per document of a chunk (bytes already lower-cased)."""
    n, size = len(off) - 1, len(buf)
    if size < 3:
        return np.zeros((n, DIMS))
    b = _FOLD[buf]
    doc = np.repeat(np.arange(n) * DIMS, np.diff(off))
    out = np.zeros(n * DIMS, np.int64)
    pair = b[:-1] << np.uint64(8) | b[1:]
    blank = (b[:-1] == 32) & (b[1:] == 32)
    for width, key, mult in ((2, pair, _M2), (3, pair[:-1] << np.uint64(8) | b[2:], _M3)):
        m = size - width + 1
        ok = (doc[:m] == doc[width - 1:]) & ~blank[:m]
        if width == 3:
            ok &= ~blank[1:m + 1]
        at = ((key[ok] * mult) >> np.uint64(52)).astype(np.int64)
        out += np.bincount(doc[:m][ok] + at, minlength=n * DIMS)
    return out.reshape(n, DIMS)


def _lower(col: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(col, ""))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Model:
    """Centroids by language, with each language's rejection distance."""

    def __init__(self, langs: list[str], rows: np.ndarray, fit: Fit = Fit()):
        seen = (rows > 0).sum(0)
        self.idf = np.log((1 + len(rows)) / (1 + seen)) + 1.0
        x = self.vectors(rows)
        names = np.array(langs, dtype=object)
        self.langs, self.reject, centres, owner = sorted(set(langs)), [], [], []
        rng = np.random.default_rng(fit.seed)
        for i, lang in enumerate(self.langs):
            mine = x[names == lang]
            mine = mine[np.linalg.norm(mine, axis=1) > 0]
            c = self._cluster(mine, fit, rng)
            centres.append(c)
            owner += [i] * len(c)
            far = 1 - (mine @ c.T).max(1) if len(c) else np.zeros(0)
            self.reject.append(float(np.quantile(far, fit.reject_quantile)) if len(far) else 0.0)
        self.centres = np.concatenate(centres) if centres else np.zeros((0, DIMS))
        self.owner = np.array(owner, np.int64)

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(rows) * self.idf)

    @staticmethod
    def _cluster(x: np.ndarray, fit: Fit, rng) -> np.ndarray:
        if not len(x):
            return np.zeros((0, x.shape[1]))
        k = min(fit.centroids, len(x))
        c = x[rng.choice(len(x), k, replace=False)]
        for _ in range(fit.rounds):
            near = (x @ c.T).argmax(1)
            c = _unit(np.stack([x[near == j].sum(0) if (near == j).any() else c[j] for j in range(k)]))
        return c

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and rejection per row of counts."""
        n = len(rows)
        if not len(self.owner):
            return [UND] * n, np.zeros(n), np.ones(n, bool)
        cos = self.vectors(rows) @ self.centres.T
        best = cos.argmax(1)
        score = np.clip(cos[np.arange(n), best], 0.0, 1.0)
        lang = self.owner[best]
        return [self.langs[i] for i in lang], score, 1 - score > np.array(self.reject)[lang]


def train(docs: DataFrame, may_learn: Column, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang", fit: Fit = Fit()) -> Model:
    """Fit on at most ``fit.per_lang`` documents per language, ``fit.most_rows`` in all, of the
    rows for which ``may_learn`` holds; a doc_id counts once per language, by one of its texts."""
    learn = docs.where(may_learn & F.col(lang).isNotNull() & F.col(text).isNotNull()) \
        .select(F.col(doc_id).alias("_id"), F.col(lang).cast("string").alias("lang"),
                F.col(text).alias("text"))
    # repeated rows meet before the shuffle; then cut per task and (language, salt), then
    # per language: the last step sees at most SALTS * per_lang rows of a language
    ids = learn.groupBy("_id", "lang").agg(F.count(F.lit(1)).alias("_rows")).drop("_rows") \
        .withColumn("_h", F.xxhash64("_id")).withColumn("_s", F.pmod("_h", F.lit(SALTS)))
    for keys in (["lang", "_s"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("_h", "_id")
        ids = ids.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= fit.per_lang)
    ids = written(ids.select("_id", "lang", "_n"), "langid-sample")
    each = max(1, fit.most_rows // max(1, ids.select("lang").distinct().count()))
    ids = ids.where(F.col("_n") <= each).select(F.col("_id").alias("_i"), F.col("lang").alias("_l"))
    # the smallest text of a doc_id's rows, taken per task first
    rows = learn.join(F.broadcast(ids), (F.col("_id").eqNullSafe(F.col("_i"))) & (F.col("lang") == F.col("_l"))) \
        .groupBy("_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")

    def run(batches):
        for batch in batches:
            for lo, hi, buf, off in chunks(_lower(batch.column(1))):
                raw = np.minimum(counts(buf, off), 65535).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([x.tobytes() for x in raw])],
                    names=["lang", "counts"])

    sample = rows.mapInArrow(run, "lang string, counts binary").collect()
    sample.sort(key=lambda r: (r["lang"], r["counts"]))
    table = np.array([np.frombuffer(r["counts"], np.uint16) for r in sample], np.float64) \
        .reshape(len(sample), DIMS)
    return Model([r["lang"] for r in sample], table, fit)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected``: ``lang_pred`` is the nearest language."""
    kind = docs.schema[doc_id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            has_letter = pc.fill_null(pc.match_substring_regex(batch.column(1), r"\p{L}"), False)
            letters = np.array(has_letter)
            for lo, hi, buf, off in chunks(_lower(batch.column(1))):
                langs, score, out = shared.value.predict(counts(buf, off))
                some = letters[lo:hi]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo),
                     pa.array([x if ok else UND for x, ok in zip(langs, some)]),
                     pa.array(np.where(some, score, 0.0)), pa.array(out | ~some)],
                    names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
