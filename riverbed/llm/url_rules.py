"""URL allow and block rules: a broadcast trie over reversed host labels and path segments.

A rule is a host and the beginning of a path. It fits its host and all of that host's
subdomains, if the url's path starts with the rule's path, character by character: the
rule ``example.org/en/1`` fits ``/en/1``, ``/en/12`` and ``/en/1/x``. The rule that
matches longest decides: the one with most host labels, then the one with the longest
path. The same host and path on both lists is a block. A rule with an empty host
fits every host. A url that no rule fits gets the default verdict.

The trie has two storeys. Host labels lead from the last one inwards
(``org`` -> ``example``); every host node may carry a path trie, whose edges are whole
segments (those a ``/`` follows) and whose nodes hold the rules' last, possibly
partial, segments by length. A walk visits one node per label and per segment, however
many rules there are; walks are remembered per host within a batch, so a host that
holds a third of all rows is walked once per batch.

The trie is broadcast only if the rules' text is at most ``max_bytes``, summed by Spark
before anything is collected. A larger rule set is joined instead: a url's keys (every
host suffix with every run of whole segments, at most labels x segments) meet the
rules of that key in one equi-join, and the longest is kept per url. Both give the
same rows.

Defined results: a null url, or one without ``://``, has empty host and path, so only
rules with empty host and path can fit it; repeated rows are judged one by one; an
empty table gives no rows; extra columns of the input are not read. A rule with a null
host or path is ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: rules of up to so many bytes of host and path are broadcast (a node costs some 300)
MAX_BYTES = 32 << 20
ALLOW, BLOCK = "allow", "block"
RULES_SCHEMA = "host string, path string, verdict string"


def rules_table(spark: SparkSession, allow: Iterable[str] = (), block: Iterable[str] = ()
                ) -> DataFrame:
    """Rules written as ``host/path`` (``example.org/es/``) as a table."""
    rows = [(*_split(r), v) for v, rules in ((ALLOW, allow), (BLOCK, block)) for r in rules]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def _split(rule: str) -> tuple[str, str]:
    host, slash, rest = rule.partition("/")
    return host, slash + rest


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    u = F.col(url) if isinstance(url, str) else url
    rest = F.coalesce(F.regexp_extract(u, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


class _Host:
    __slots__ = ("labels", "paths")

    def __init__(self):
        self.labels: dict[str, _Host] = {}
        self.paths: _Path | None = None


class _Path:
    __slots__ = ("segments", "tails", "sizes")

    def __init__(self):
        self.segments: dict[str, _Path] = {}
        #: beginnings of the next segment -> (rule, verdict), and their lengths, longest first
        self.tails: dict[str, tuple[str, str]] = {}
        self.sizes: tuple[int, ...] = ()


class Trie:
    """Longest-match lookup of hosts and paths."""

    def __init__(self, rules: Iterable[tuple[str, str, str]] = ()):
        self.root = _Host()
        for host, path, verdict in rules:
            self.add(host, path, verdict)

    def add(self, host: str, path: str, verdict: str) -> None:
        node = self.root
        for label in _labels(host):
            node = node.labels.setdefault(label, _Host())
        if node.paths is None:
            node.paths = _Path()
        at = node.paths
        *whole, tail = path.split("/")
        for segment in whole:
            at = at.segments.setdefault(segment, _Path())
        if at.tails.get(tail, (None, ALLOW))[1] != BLOCK:
            at.tails[tail] = (host + path, verdict)
        if len(tail) not in at.sizes:
            at.sizes = tuple(sorted({len(tail), *at.sizes}, reverse=True))

    def hosts(self, host: str) -> list[_Path]:
        """Path tries of every rule host that fits, the one with most labels first."""
        node, found = self.root, []
        if node.paths is not None:
            found.append(node.paths)
        for label in _labels(host):
            node = node.labels.get(label)
            if node is None:
                break
            if node.paths is not None:
                found.append(node.paths)
        return found[::-1]

    @staticmethod
    def longest(tries: list[_Path], path: str) -> tuple[str, str] | None:
        """``(rule, verdict)`` of the longest rule, of the host with most labels."""
        segments = path.split("/")
        for at in tries:
            best = None
            for i, segment in enumerate(segments):
                for size in at.sizes:
                    hit = at.tails.get(segment[:size]) if size <= len(segment) else None
                    if hit is not None:
                        best = hit          # deeper in the path, so longer
                        break
                # the last segment has no "/" behind it
                at = at.segments.get(segment) if i + 1 < len(segments) else None
                if at is None:
                    break
            if best is not None:
                return best
        return None

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        return self.longest(self.hosts(host), path)


def _labels(host: str) -> Iterator[str]:
    """Labels from the last to the first; an empty host has none."""
    return reversed(host.split(".")) if host else iter(())


def _clean(rules: DataFrame) -> DataFrame:
    return rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()
                       & F.col("verdict").isin(ALLOW, BLOCK)).select("host", "path", "verdict")


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
          default: str = ALLOW, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every url."""
    rules = _clean(rules)
    size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path")).alias("n"))
    small = (size.collect()[0]["n"] or 0) <= max_bytes
    host, path = host_and_path(url)
    urls = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    return _by_trie(urls, rules, default) if small else _by_join(urls, rules, default)


def _by_trie(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    spark = urls.sparkSession
    trie = spark.sparkContext.broadcast(Trie(tuple(r) for r in rules.toLocalIterator()))

    def run(batches):
        find = trie.value
        for batch in batches:
            fits: dict[str, list[_Path]] = {}
            rule, verdict = [], []
            for host, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                tries = fits.get(host)
                if tries is None:
                    tries = fits[host] = find.hosts(host)
                hit = find.longest(tries, path) or (None, default)
                rule.append(hit[0])
                verdict.append(hit[1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    kind = urls.schema["page_id"].dataType.simpleString()
    return urls.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, "
                                "verdict string")


def _by_join(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """For rule sets beyond the broadcast bound: one equi-join on (host suffix, whole segments).

    Distinct (host, path) pairs are looked up once; the copies get the answer by a join
    that Spark may split."""
    distinct = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.concat(
        F.array(F.lit("")),
        F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda n: F.array_join(F.slice(labels, -n, n), "."))))
    parts = F.split("path", "/")
    heads = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.struct(
        F.concat_ws("/", F.slice(parts, F.lit(1), n)).alias("dir"), n.alias("depth"),
        F.element_at(parts, n + 1).alias("next")))
    keys = distinct.select("host", "path", F.explode(suffixes).alias("k_host")) \
        .select("host", "path", "k_host", F.explode(heads).alias("h")) \
        .select("host", "path", "k_host", F.col("h.dir").alias("k_dir"),
                F.col("h.depth").alias("k_depth"), F.col("h.next").alias("next"))
    cut = F.split("path", "/")
    rule_rows = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        F.col("host").alias("k_host"),
        F.concat_ws("/", F.slice(cut, F.lit(1), F.size(cut) - 1)).alias("k_dir"),
        (F.size(cut) - 1).alias("k_depth"), F.element_at(cut, -1).alias("tail"),
        F.concat("host", "path").alias("rule"), "verdict")
    hits = keys.join(rule_rows, ["k_host", "k_dir", "k_depth"]) \
        .where(F.col("next").startswith(F.col("tail")))
    size = F.struct(F.when(F.col("k_host") == "", 0).otherwise(F.size(F.split("k_host", r"\."))),
                    F.length("rule"))
    best = hits.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), size).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
