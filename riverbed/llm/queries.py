"""The thin ``opN_*`` queries: each applies its operator to its whole table and
derives the digest columns that are compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_path
from . import (alignment, bpe, exact_dedup, langid, mixing, quality, repeats, sharding, simhash,
               token_files, toxicity, url_rules, whitening)
from .base import crc_mod, prepare, read

SHARDS = 40


def op1_quality(spark: SparkSession, d: str) -> DataFrame:
    """Quality verdict of every document: base rules and distribution divergence."""
    return quality.assess(read(spark, d, "documents"))


def op2_shards(spark: SparkSession, d: str) -> DataFrame:
    """Every document's shard (0 to 39) and slot under the Feistel permutation; law ``rows``."""
    return sharding.assign(read(spark, d, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_token_files(spark: SparkSession, d: str) -> DataFrame:
    """Token files of all documents, written and read back: place and checksum of their ids."""
    path = shared_path(spark, "token-files")
    token_files.write(read(spark, d, "documents"), path)
    return token_files.read(spark, path)


def op4_simhash(spark: SparkSession, d: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document (3-word shingles, 3 bits)."""
    return simhash.groups(read(spark, d, "documents"), shingle=3, max_bits=3).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Exact groups by progressive refinement, with the digest of every normalised text."""
    return exact_dedup.refine(read(spark, d, "documents"), digest=True)


def op6_langid(spark: SparkSession, d: str) -> DataFrame:
    """Language of every document; rows of class 0 mod 5 are held out of the training."""
    docs = read(spark, d, "documents")
    model = langid.train(docs, crc_mod("doc_id", 5) != 0)
    return langid.predict(docs, model).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op7_bpe(spark: SparkSession, d: str) -> DataFrame:
    """Ids of every document by the transducer, and the text decoded from them, as digests."""
    return bpe.round_trip(read(spark, d, "documents"))


def op8_mix(spark: SparkSession, d: str) -> DataFrame:
    """Words taken of every document when the sources are mixed to their targets."""
    return mixing.mix(read(spark, d, "documents")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def op9_repeats(spark: SparkSession, d: str) -> DataFrame:
    """Bytes of every document covered by a 400-byte string that also starts elsewhere."""
    found = repeats.repeats(read(spark, d, "documents"))
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", length.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op10_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Toxicity of every document; rows of class 2 mod 4 are held out of the training."""
    docs = read(spark, d, "documents")
    lexicon = toxicity.train(docs, read(spark, d, "labels"), crc_mod("doc_id", 4) != 2)
    return toxicity.score(docs, lexicon).select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_hits")


def op11_url_rules(spark: SparkSession, d: str) -> DataFrame:
    """Verdict of every page's url by the longest allow or block rule; allowed without one."""
    rules = url_rules.rules_table(spark, allow=["org/", "com/fr/"],
                                  block=["example.org/es/", "example.org/en/1", "com/de/"])
    return url_rules.judge(read(spark, d, "pages"), rules)


def op12_whitening(spark: SparkSession, d: str) -> DataFrame:
    """Every vector on the first 32 whitened components, fitted on all vectors."""
    vectors = read(spark, d, "embeddings")
    return whitening.transform(vectors, whitening.fit(vectors, components=32))


def op13_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Every document's tokens by two tokenizers, aligned; links counted over the corpus."""
    return alignment.aligned(read(spark, d, "documents"))


_QUERIES = {f.__name__: f for f in (
    op1_quality, op2_shards, op3_token_files, op4_simhash, op5_exact_dedup, op6_langid,
    op7_bpe, op8_mix, op9_repeats, op10_toxicity, op11_url_rules, op12_whitening, op13_alignment)}


def queries() -> dict:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        return run
    return {name: wrap(fn) for name, fn in _QUERIES.items()}
