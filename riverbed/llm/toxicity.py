"""Toxicity: a lexicon trie intersected with Levenshtein automata, and context windows.

Lexicon. From a bounded sample of labelled rows (at most ``toxic_rows`` and
``clean_rows``, smallest hash of doc_id) a word becomes a term if it is
significantly more frequent in toxic rows (a Chernoff bound, corrected for the
number of words tried), or if it is in toxic rows only and far fewer words than
observed would be there by chance. Its support is the smaller of its distinct
left neighbours and its documents, so the words of copied documents do not
qualify.

Matching. All terms form one trie; the automaton that accepts every word
within a term's edit budget (0 below five letters, 1 from five, 2 from nine;
insertion, deletion, substitution, swap of neighbours) runs over trie and
edits at once: a state is the set of (trie node, edits spent), made on demand
and kept per letter, so most words die after a few letters.

Scoring. An exact hit carries the term's precision in the sample, a misspelt
one the precision of the term's misspellings (variants seen in clean rows are
no hits). Each hit is weighed by its window of ``WINDOW`` words on both sides:
between quotation marks, or beside a reporting word, it counts as quotation and
its evidence shrinks by a factor that starts from ``QUOTED`` and follows the
labels where they say otherwise. A text's score is one minus the product of
one minus its hits' evidence, over whole texts, in one pass without a shuffle.

Defined results: null, empty and hitless texts score ``FLOOR``; rows with
null labels teach nothing; of labels that repeat for a doc_id the largest
counts; without training rows every text scores ``FLOOR``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .base import written

FLOOR = 0.01
WINDOW = 8
_K = 64
QUOTED = 0.25
_WORD = re.compile(r"\w+")
_QUOTES = set("\"“”„«»‹›")
#: reporting words that mark a quotation in the window before a hit
REPORTING = frozenset(
    "quote quoted quotes quoting said says wrote writes called calls word words term terms "
    "zitat zitiert sagte schrieb wort cite citation dit écrit mot cita dijo escribió palabra".split())


@dataclass(frozen=True)
class Fit:
    toxic_rows: int = 4000
    clean_rows: int = 16000
    alpha: float = 0.01
    max_terms: int = 2000


def edits_for(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Deterministic on demand: accepts words within a term's edit budget."""

    def __init__(self, terms: list[str], limit: int = 100_000):
        self.limit = limit
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.budget = [0]       # largest edit budget of the terms below a node
        for term in terms:
            node, k = 0, edits_for(term)
            self.budget[0] = max(self.budget[0], k)
            for ch in term:
                if ch not in self.child[node]:
                    self.child[node][ch] = len(self.child)
                    self.child.append({})
                    self.ends.append(None)
                    self.budget.append(0)
                node = self.child[node][ch]
                self.budget[node] = max(self.budget[node], k)
            self.ends[node] = term
        self._reset()

    def _reset(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self.start = self._state({(0, ""): 0})

    def _state(self, items: dict[tuple[int, str], int]) -> int:
        """``items``: (node, awaited letter of a swap) -> fewest edits; closed under deletions."""
        todo = [(node, e) for (node, wait), e in items.items() if not wait]
        while todo:
            node, e = todo.pop()
            for nxt in self.child[node].values():
                if e < self.budget[nxt] and items.get((nxt, ""), 99) > e + 1:
                    items[nxt, ""] = e + 1
                    todo.append((nxt, e + 1))
        key = frozenset((node, wait, e) for (node, wait), e in items.items())
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            hits = [(e, self.ends[n]) for n, wait, e in key
                    if not wait and self.ends[n] is not None and e <= edits_for(self.ends[n])]
            self.accepts.append(min(hits)[::-1] if hits else None)
        return self.number[key]

    def _move(self, state: int, ch: str) -> int:
        items: dict[tuple[int, str], int] = {}

        def put(node: int, wait: str, e: int) -> None:
            if e <= self.budget[node] and items.get((node, wait), 99) > e:
                items[node, wait] = e
        for node, wait, e in self.sets[state]:
            if wait:
                if wait == ch:
                    put(node, "", e)
                continue
            put(node, "", e + 1)                       # a letter too many
            for letter, nxt in self.child[node].items():
                put(nxt, "", e if letter == ch else e + 1)
                if letter != ch and ch in self.child[nxt]:
                    put(self.child[nxt][ch], letter, e + 1)     # two letters swapped
        to = self.moves[state][ch] = self._state(items)
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """Nearest term and its edits (ties: fewest edits, then term order), or None."""
        if len(self.sets) > self.limit:
            self._reset()
        state, moves = self.start, self.moves
        for ch in word:
            to = moves[state].get(ch)
            state = self._move(state, ch) if to is None else to
            if not self.sets[state]:
                return None
        return self.accepts[state]


@dataclass
class Lexicon:
    exact: dict[str, float]                                    # term -> precision
    near: dict[str, float] = field(default_factory=dict)       # term -> precision of misspellings
    innocent: frozenset = frozenset()                          # variants seen in clean rows
    quoted: float = QUOTED

    def scorer(self) -> Scorer:
        """One scorer per worker process: the broadcast lexicon stays there between tasks."""
        if "_scorer" not in self.__dict__:
            self._scorer = Scorer(self)
        return self._scorer


class Scorer:
    def __init__(self, lexicon: Lexicon, memo: int = 600_000):
        self.lexicon, self.limit = lexicon, memo
        self.automaton = Automaton(sorted(lexicon.exact))
        self.memo: dict[str, tuple[str, int] | None] = {}

    def match(self, word: str) -> tuple[str, int] | None:
        try:
            return self.memo[word]
        except KeyError:
            if len(self.memo) >= self.limit:
                self.memo.clear()
            hit = self.automaton.match(word)
            if hit and hit[1] and word in self.lexicon.innocent:
                hit = None
            if len(word) <= 64:
                self.memo[word] = hit
            return hit

    def hits(self, text: str | None) -> list[tuple[str, str, int, bool]]:
        """``word, term, edits, quoted`` of every hit of a whole text."""
        if not text:
            return []
        low = text.lower()
        words = _WORD.findall(low)
        found = {w: hit for w in set(words) if (hit := self.match(w))}
        if not found:
            return []
        spans = [m.span() for m in _WORD.finditer(low)]
        out = []
        for i, word in enumerate(words):
            if word in found:
                first, last = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
                before = low[spans[first][0]:spans[i][0]]
                after = low[spans[i][1]:spans[last - 1][1] + 1]
                marks = sum(c in _QUOTES for c in before) % 2 == 1 and any(c in _QUOTES for c in after)
                told = not REPORTING.isdisjoint(words[first:i])
                out.append((word, *found[word], marks or told))
        return out

    def score(self, text: str | None) -> tuple[float, int]:
        """Score and number of hits."""
        clean, hits = 1.0 - FLOOR, self.hits(text)
        for _, term, edits, quoted in hits:
            p = self.lexicon.near.get(term, 0.5) if edits else self.lexicon.exact[term]
            clean *= 1.0 - p * (self.lexicon.quoted if quoted else 1.0)
        return 1.0 - clean, len(hits)


def _sample(docs: DataFrame, labels: DataFrame, may_learn: Column, fit: Fit, doc_id: str,
            text: str, label: str) -> DataFrame:
    """``text, toxic`` of the training sample: at most ``toxic_rows + clean_rows`` documents,
    each by one of its rows (the smallest text, taken per task first)."""
    marks = labels.where(may_learn & F.col(label).isNotNull()) \
        .groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("toxic"))
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = marks.where("toxic = 1").orderBy(*order).limit(fit.toxic_rows).unionByName(
        marks.where("toxic = 0").orderBy(*order).limit(fit.clean_rows))
    return docs.select(F.col(doc_id).alias("_d"), F.col(text).alias("text")) \
        .join(F.broadcast(chosen), F.col("_d") == F.col("_id")) \
        .groupBy("_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, doc_id: str = "doc_id",
          text: str = "text", label: str = "toxic", fit: Fit = Fit()) -> Lexicon:
    """Learn the lexicon, its precisions and the quotation factor from the sample."""
    sample = written(_sample(docs, labels, may_learn, fit, doc_id, text, label), "tox-sample")

    def words(batches):
        for batch in batches:
            seen: Counter = Counter()
            for body, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                run = _WORD.findall((body or "").lower())
                # rows with a left neighbour count contexts, rows without it documents
                for left, word in {*zip(["", *run], run), *((None, w) for w in run)}:
                    seen[word, left, toxic] += 1
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([k[2] for k in keys], pa.int32()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "left", "toxic", "n"])

    pairs = sample.mapInArrow(words, "word string, left string, toxic int, n long") \
        .groupBy("word", "left", "toxic").agg(F.sum("n").alias("n"))
    context = F.col("left").isNotNull().cast("long")
    part_of = lambda mark: F.least(
        F.sum(F.when(F.col("toxic") == mark, context).otherwise(0)),
        F.sum(F.when(F.col("toxic") == mark, (1 - context) * F.col("n")).otherwise(0)))
    table = written(pairs.groupBy("word").agg(part_of(1).alias("t"), part_of(0).alias("c")),
                    "tox-words")
    tried, t_all, c_all = table.agg(F.count("*"), F.sum("t"), F.sum("c")).head()
    if not tried or not t_all:
        return Lexicon({})
    share = t_all / (t_all + c_all)
    # words never seen in clean rows: how many with k sightings would chance alone put there?
    table = table.withColumn("k", F.least(F.col("t") + F.col("c"), F.lit(_K)))
    by_k = table.groupBy("k").agg(F.count("*").alias("all"), F.count(
        F.when(F.col("c") == 0, 1)).alias("pure"))      # _K rows at most
    chance = F.least(F.lit(1.0), F.pow(F.lit(share), "k") * F.col("all") / F.col("pure"))
    pure = F.when((F.col("c") == 0) & (F.col("k") > 1), 1 - chance).otherwise(0.0)
    part = F.col("t") / (F.col("t") + F.col("c"))
    surprise = F.col("t") * F.log(part / share) + F.when(
        F.col("c") > 0, F.col("c") * F.log((1 - part) / max(1 - share, 1e-9))).otherwise(0.0)
    balance = t_all / max(c_all, 1)
    sure = F.when(surprise > math.log(tried / fit.alpha),
                  F.col("t") / (F.col("t") + F.col("c") * balance + 0.5)).otherwise(0.0)
    terms = table.join(F.broadcast(by_k), "k").where((part > share) & (F.length("word") > 2)) \
        .withColumn("p", F.greatest(pure, sure)).where("p > 0.8") \
        .orderBy(F.desc("p"), F.desc("t"), "word").limit(fit.max_terms).select("word", "p")
    lexicon = Lexicon({r["word"]: min(0.98, r["p"]) for r in terms.collect()})
    return _refine(sample, lexicon, balance)


def _refine(sample: DataFrame, lexicon: Lexicon, balance: float) -> Lexicon:
    """Precision of misspellings and of quotations, counted over the sample's documents."""
    def run(batches):
        scorer = Scorer(lexicon)
        for batch in batches:
            rows = []
            for body, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                hits = scorer.hits(body)
                if hits and all(h[3] for h in hits):
                    rows.append(("quoted", "", "", toxic))
                if not any(h[2] == 0 for h in hits):
                    rows += {("near", h[0], h[1], toxic) for h in hits}
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.string(), pa.string(), pa.string(), pa.int32()))],
                names=["kind", "word", "term", "toxic"])

    # a row per variant at most: documents of the sample times their hits
    rows = sample.mapInArrow(run, "kind string, word string, term string, toxic int") \
        .groupBy("kind", "word", "term").agg(F.sum("toxic").alias("t"),
                                             F.sum(1 - F.col("toxic")).alias("c")).collect()
    innocent = frozenset(r["word"] for r in rows if r["kind"] == "near" and r["c"] and not r["t"])
    near: dict[str, float] = {}
    for term in lexicon.exact:
        own = [r for r in rows if r["kind"] == "near" and r["term"] == term]
        t, c = sum(r["t"] for r in own), sum(r["c"] for r in own)
        near[term] = (t + 0.5) / (t + c + 1.0)
    quoted = [r for r in rows if r["kind"] == "quoted"]
    t, c = sum(r["t"] for r in quoted), sum(r["c"] for r in quoted)
    return Lexicon(lexicon.exact, near, innocent, (4 * QUOTED + t) / (4 + t + c))


def score(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, n_hits`` for every document."""
    kind = docs.schema[doc_id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        scorer = shared.value.scorer()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                found = [scorer.score(x) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x[0] for x in found], pa.float64()),
                     pa.array([x[1] for x in found], pa.int64())],
                    names=["doc_id", "score", "n_hits"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, score double, n_hits long")
