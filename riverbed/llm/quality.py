"""Quality rules: distribution divergence from language references.

Every document has two histograms: character classes, and common words (words
hashed, lower-cased in ASCII, to ``WORD_BUCKETS`` counters; the most frequent
buckets of a language are its common words, all others count as "other").
A language's reference sums both histograms over all distinct texts of that
language which pass the base rules, so that a verdict does not depend on how
often any text is copied. A document whose language has a reference
is kept if, for some language, its Jensen-Shannon distances (square root of the
base-2 divergence, 0 to 1) to that reference stay below the limits. A document
whose language has none gets no divergence verdict: the base rules decide, and
its distances are 0. A document without a language that is too far from every
reference may be of a language that has none, so its words are not held against
it: it is kept if its character histogram, all letters counted as one class,
stays below the character limit for some reference.

Minimum-length guards: short documents have noisy histograms, so the word
histogram counts only from ``min_words`` words on and the character histogram
from ``min_chars`` characters on; a reference needs ``min_ref_words`` words.

Defined results: a null or empty text has no words and fails the base rules;
a null language gives no reference and is judged as said above; repeated
rows are judged one by one; with no reference at all the base rules decide.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .base import (BYTE_KEY, chunks, mix, prefix_hash, range_hash, verified_hash, word_spans,
                   written)

WINDOW = 8
WORD_BUCKETS = 4096
CELL = 1 << 13          # more than all bins of a language
SYMBOLS = b"#*$%&|<>"
#: character classes of single bytes; a multi-byte character counts once, by its first byte
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "quote", "bracket",
           "shout", "symbol", "other", "accented", "foreign")


@dataclass(frozen=True)
class Limits:
    """Verdict parameters. A distance limit is ``floor + slack / sqrt(n_words)``: the
    distance of n words drawn from the reference itself shrinks like ``1 / sqrt(n)``."""

    char_floor: float = 0.15
    char_slack: float = 1.4
    word_floor: float = 0.30
    word_slack: float = 1.5
    min_chars: int = 200
    min_words: int = 50
    min_ref_words: int = 2000
    common_words: int = 64


def _class_table() -> np.ndarray:
    t = np.full(256, CLASSES.index("other"), np.int64)
    for name, members in (("lower", b"abcdefghijklmnopqrstuvwxyz"),
                          ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", b"0123456789"),
                          ("space", b" \t"), ("newline", b"\n\r\x0b\x0c"), ("stop", b".,;:-"),
                          ("quote", b"'\""), ("bracket", b"()[]{}/"), ("shout", b"!?"),
                          ("symbol", SYMBOLS)):
        t[list(members)] = CLASSES.index(name)
    t[0x80:0xC0] = len(CLASSES)        # continuation bytes: a bin of their own, dropped
    t[0xC0:0xCE] = CLASSES.index("accented")   # Latin supplements and extensions
    t[0xCE:] = CLASSES.index("foreign")
    return t


_CLASS = _class_table()
_LETTER = np.isin(CLASSES, ("lower", "upper", "accented", "foreign"))
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_LEAD = (np.arange(256) & 0xC0) != 0x80
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LOWER_KEY = BYTE_KEY[_LOWER]


def _counts(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[off[1:]] - total[off[:-1]]


def _repeated(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries' (document, key) occurs twice or more, and which occurred before."""
    order = np.lexsort((np.arange(len(keys)), keys, doc))
    k, d = keys[order], doc[order]
    same = np.zeros(len(k), bool)
    same[1:] = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    any_twin = same.copy()
    any_twin[:-1] |= same[1:]
    twin, later = np.empty(len(k), bool), np.empty(len(k), bool)
    twin[order], later[order] = any_twin, same
    return twin, later


def measures(buf: np.ndarray, off: np.ndarray, base_only: bool = False) -> dict[str, np.ndarray]:
    """The contract's counts and, per document, both histograms of one chunk."""
    n = len(off) - 1
    start, end, doc = word_spans(buf, off)
    words = np.bincount(doc, minlength=n)
    out = {"n_words": words}
    in_word = np.zeros(len(buf) + 1, np.int8)
    np.add.at(in_word, start, 1)
    np.add.at(in_word, end, -1)
    out["word_chars"] = _counts((np.cumsum(in_word[:-1]) > 0) & _LEAD[buf], off)
    out["n_symbols"] = _counts(_SYMBOL[buf], off)

    pre = prefix_hash(buf)
    # lines: cut at every \n and document edge; a line counts if it holds a word
    cut = np.unique(np.concatenate([off, np.flatnonzero(buf == 10) + 1]))
    line_start, line_end = cut[:-1], cut[1:].copy()
    line_end -= (line_end > line_start) & (buf[line_end - 1] == 10) if len(line_end) else 0
    line_doc = np.searchsorted(off, line_start, "right") - 1
    filled = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end, line_doc = line_start[filled], line_end[filled], line_doc[filled]
    lines = verified_hash(buf, line_start, line_end, range_hash(pre, line_start, line_end))
    _, later = _repeated(lines, line_doc)
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=n)

    w = verified_hash(buf, start, end, range_hash(pre, start, end))
    m = len(w) - WINDOW + 1
    covered = np.zeros(len(w), bool)
    if m > 0:
        key = np.zeros(m, np.uint64)
        for i in range(WINDOW):
            key = mix(key + w[i:i + m])
        inside = np.flatnonzero(doc[:m] == doc[WINDOW - 1:])
        twin, _ = _repeated(key[inside], doc[inside])
        hit = np.zeros(len(w) + 1, np.int64)
        first = inside[twin]
        hit[first] += 1
        np.add.at(hit, first + WINDOW, -1)
        covered = np.cumsum(hit[:-1]) > 0
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=n)
    out["base_failed"] = (words < 20) | (100 * out["n_repeat_words"] > 30 * words)

    c = len(CLASSES) + 1
    doc_of_byte = np.repeat(np.arange(n), np.diff(off))
    chars = np.bincount(doc_of_byte * c + _CLASS[buf], minlength=n * c).reshape(n, c)
    out["chars"] = chars[:, :-1]
    bucket = (range_hash(prefix_hash(buf, _LOWER_KEY), start, end)
              & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
    out["bucket"], out["doc"] = bucket, doc
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row-wise Jensen-Shannon distance of histograms (rows of ``p`` against ``q``)."""
    p = p / np.maximum(p.sum(-1, keepdims=True), 1)
    q = q / np.maximum(q.sum(-1, keepdims=True), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(-1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(-1)
    return np.sqrt(np.maximum((a + b) / 2, 0))


def _one_letter_class(chars: np.ndarray) -> np.ndarray:
    """Character histograms with all letters in one class."""
    return np.concatenate([chars[..., ~_LETTER], chars[..., _LETTER].sum(-1, keepdims=True)], -1)


def references(docs: DataFrame, text: str = "text", lang: str = "lang",
               once: bool = False) -> DataFrame:
    """Histogram counts per language over all documents that pass the base rules:
    rows ``(lang, kind, bin, n)``, at most ``len(CLASSES) + WORD_BUCKETS`` per language.

    ``once`` counts the documents of a language that have the same text (by its
    128-bit digest) once. For this the sparse histogram of every document, never its
    text, is grouped by hash; every task drops its own copies before the shuffle.
    """
    classes = len(CLASSES)

    def sparse(batches):
        for batch in batches:
            has_lang = np.asarray(batch.column(1).is_valid())
            for lo, hi, buf, off in chunks(batch.column(0)):
                got = measures(buf, off)
                good = ~got["base_failed"] & has_lang[lo:hi]
                row, cls = np.nonzero(got["chars"] * good[:, None])
                mine = good[got["doc"]]
                key, n = np.unique(got["doc"][mine] * WORD_BUCKETS + got["bucket"][mine],
                                   return_counts=True)
                place = np.concatenate([row, key // WORD_BUCKETS])
                # a bin and its count in one number: classes first, then word buckets
                cell = np.concatenate([got["chars"][row, cls] * CELL + cls,
                                       n * CELL + key % WORD_BUCKETS + classes])
                order = np.argsort(place, kind="stable")
                sizes = np.bincount(place, minlength=hi - lo)[good]
                raw = memoryview(buf)
                digest = [hashlib.blake2b(raw[a:b], digest_size=16).digest()
                          for a, b, ok in zip(off[:-1].tolist(), off[1:].tolist(), good.tolist()) if ok]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(lo, hi - lo).filter(pa.array(good)),
                     pa.array(digest, pa.binary()),
                     pa.ListArray.from_arrays(
                         pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                         pa.array(cell[order].astype(np.int64)))],
                    names=["lang", "hash", "cells"])

    parts = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")) \
        .mapInArrow(sparse, "lang string, hash binary, cells array<long>")
    if once:
        parts = parts.dropDuplicates(["lang", "hash"])
    at = F.col("cell") % CELL
    sums = parts.select("lang", F.explode("cells").alias("cell")) \
        .groupBy("lang", at.cast("int").alias("at")) \
        .agg(F.sum(F.shiftright("cell", CELL.bit_length() - 1)).alias("n"))
    word = F.col("at") >= classes
    return sums.select("lang", F.when(word, "word").otherwise("char").alias("kind"),
                       F.when(word, F.col("at") - classes).otherwise(F.col("at")).alias("bin"), "n")


class Judge:
    """References as arrays; gives a verdict per document of a chunk."""

    def __init__(self, rows: list, limits: Limits):
        self.limits = limits
        by_lang: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for r in rows:
            chars, words = by_lang.setdefault(
                r["lang"], (np.zeros(len(CLASSES)), np.zeros(WORD_BUCKETS)))
            (chars if r["kind"] == "char" else words)[r["bin"]] = r["n"]
        self.refs, self.names = [], set()
        for name in sorted(by_lang):
            chars, words = by_lang[name]
            if words.sum() < limits.min_ref_words:
                continue
            top = np.lexsort((np.arange(WORD_BUCKETS), -words))[:limits.common_words]
            slot = np.full(WORD_BUCKETS, len(top), np.int64)
            slot[top] = np.arange(len(top))
            common = np.append(words[top], words.sum() - words[top].sum())
            self.refs.append((chars, slot, common))
            self.names.add(name)

    def distances(self, got: dict[str, np.ndarray], langs: list[str | None]
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Smallest guarded distances over the languages, and the verdict."""
        n, lim = len(got["n_words"]), self.limits
        best = np.full((3, n), np.inf)
        enough_chars = got["chars"].sum(1) >= lim.min_chars
        enough_words = got["n_words"] >= lim.min_words
        noise = 1 / np.sqrt(np.maximum(got["n_words"], 1))
        no_lang = np.array([x is None for x in langs], bool)
        no_reference = np.array([x is not None and x not in self.names for x in langs], bool)
        merged, like_text = _one_letter_class(got["chars"]), np.zeros(n, bool)
        for chars, slot, common in self.refs:
            k = len(common)
            hist = np.bincount(got["doc"] * k + slot[got["bucket"]], minlength=n * k).reshape(n, k)
            dc = np.where(enough_chars, js_distance(got["chars"], chars), 0.0)
            dw = np.where(enough_words, js_distance(hist, common), 0.0)
            excess = np.maximum(dc / (lim.char_floor + lim.char_slack * noise),
                                dw / (lim.word_floor + lim.word_slack * noise))
            better = excess < best[0]
            best = np.where(better, [excess, dc, dw], best)
            if no_lang.any():
                d = np.where(enough_chars, js_distance(merged, _one_letter_class(chars)), 0.0)
                like_text |= d <= lim.char_floor + lim.char_slack * noise
        best[:, no_reference] = 0.0
        if not self.refs:
            best[:] = 0.0
        return best[1], best[2], (best[0] <= 1.0) | (no_lang & like_text)


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, char_distance double, word_distance double")


def _judge_table(docs: DataFrame, text: str, lang: str, limits: Limits) -> Judge:
    refs = written(references(docs, text, lang, once=True), "quality-references")
    enough = refs.where("kind = 'word'").groupBy("lang").agg(F.sum("n").alias("words")) \
        .where(F.col("words") >= limits.min_ref_words).select("lang")
    # languages that have a reference x (character classes + word buckets), whatever the corpus
    return Judge(refs.join(enough, "lang", "left_semi").collect(), limits)


def _verdict(judge: Judge, buf, off, langs: list[str | None]) -> dict[str, np.ndarray]:
    got = measures(buf, off)
    got["char_distance"], got["word_distance"], fits = judge.distances(got, langs)
    got["kept"] = fits & ~got["base_failed"]
    return got


def assess(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
           limits: Limits = Limits()) -> DataFrame:
    """One row per document: base counts, distances to the nearest reference, verdict."""
    judge = _judge_table(docs, text, lang, limits)
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            langs = batch.column(2).to_pylist()
            for lo, hi, buf, off in chunks(batch.column(1)):
                got = _verdict(judge, buf, off, langs[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(got[x]) for x in names)],
                    names=["doc_id", *names])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.col(lang).cast("string").alias("lang")) \
        .mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang",
              limits: Limits = Limits()) -> DataFrame:
    """The documents that the rules keep, with all their columns, in one pass and no shuffle."""
    judge = _judge_table(docs, text, lang, limits)
    at, width = docs.columns.index(text), len(docs.columns)

    def run(batches):
        for batch in batches:
            langs = batch.column(width).to_pylist()
            batch = batch.select(range(width))
            kept = [_verdict(judge, buf, off, langs[lo:hi])["kept"]
                    for lo, hi, buf, off in chunks(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate(kept))) if kept else batch

    return docs.select("*", F.col(lang).cast("string").alias("__quality_lang")) \
        .mapInArrow(run, docs.schema)
