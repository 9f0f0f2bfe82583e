"""URL rules, whitening and alignment against brute force: nulls, empty and odd values,
ties, repeated rows, empty tables, clashing extra columns, several partitions."""

import hashlib
import math
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riverbed.llm import alignment, queries, token_files, url_rules, whitening
from riverbed.llm.base import local_path, prepare
from riverbed.session import shared_path
from test_operators import SCHEMA, _rows


# -- url rules ----------------------------------------------------------------

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
ODD_RULES = RULES + [("", "", "block"), ("a.b", "", "allow"), ("a.b", "", "block"), ("b", "/x/y", "allow"),
                     ("net", "/", "allow"), ("net", "//", "block"), ("net", "/x/", "block"),
                     ("net", "/x", "allow"), (None, "/", "block"), ("c", None, "block")]
HOSTS = ["org", "www.Example.ORG", "xexample.org", "example.org.", "a.b", "b", "x.a.b", "", "fr.com",
         "com", "net", "user@net", "net:80", "..org"]
PATHS = ["", "/", "/es/", "/es", "/en/1", "/en/12/x", "/en/", "/fr/", "/de/a/b", "/x/y", "/x/yz", "/x/",
         "//", "/x", "/x//", "/fr/\nline", "/é/ü"]


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    stop = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[stop:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:stop]), path


def verdict_of(url, rules):
    host, path = parts_of(url)
    fits = [(h.count(".") + 1 if h else 0, len(p), v == "block", h + p, v) for h, p, v in rules
            if h is not None and p is not None and path.startswith(p)
            and (h == "" or host == h or host.endswith("." + h))]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


def urls():
    r = random.Random(3)
    out = [f"{r.choice(['http', 'HTTPS', ''])}://{h}{p}{t}" for h in HOSTS for p in PATHS
           for t in ("", "?q=/es/", "#x")]
    return out + [None, "", "example.org/es/", "a://b://org/", "http:///es/", "://org/"] + out[:7]


@pytest.mark.parametrize("rules", [RULES, ODD_RULES, []])
@pytest.mark.parametrize("max_bytes", [1 << 20, -1])
def test_url_rules(spark, rules, max_bytes):
    rows = [(i, u, "h", "p") for i, u in enumerate(urls())] + [(None, "http://org/", "h", "p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string").repartition(3)
    table = spark.createDataFrame(rules, url_rules.RULES_SCHEMA)
    got = url_rules.judge(pages, table, max_bytes=max_bytes)
    want = Counter((i, *verdict_of(u, rules)) for i, u, *_ in rows)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert url_rules.judge(pages.limit(0), table, max_bytes=max_bytes).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab.", max_size=5), st.text("xy/", max_size=5),
                          st.sampled_from(["allow", "block"])), max_size=8),
       st.text("ab.", max_size=7), st.text("xy/", max_size=7))
def test_trie_finds_the_longest_rule(rules, host, path):
    path = "/" + path if path else path
    want = verdict_of(f"s://{host}{path}", rules)
    got = url_rules.Trie(rules).find(host, path) or (None, "allow")
    assert got == want[2:]


# -- whitening ----------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, n long, component int, part long, up long"


def vector_rows(n=400, d=12):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((n, d)) @ np.diag(2.0 ** -np.arange(d)) @ rng.standard_normal((d, d))
    rows = [[i, [float(np.float32(x)) for x in v]] for i, v in enumerate(base)]
    rows[3][1] = None
    rows[4][1] = []
    rows[5][1][2] = None
    rows[6][1][0] = math.nan
    rows[7][1][1] = math.inf
    rows[8][1] = rows[8][1][:5]
    rows[9][0] = None
    rows += [list(rows[10])] * 150          # a third of the rows is one vector
    return [(*r, 1, 2, 3, 4) for r in rows]


def used(rows, d=12):
    return [(r[0], [math.floor(64 * c) + 1000000 for c in r[1]]) for r in rows if r[1] is not None
            and len(r[1]) == d and all(c is not None and math.isfinite(c) for c in r[1])]


def test_whitening(spark):
    prepare(spark)
    rows = vector_rows()
    table = spark.createDataFrame(rows, VECTORS).repartition(40)
    model = whitening.fit(table, components=5)
    got = whitening.transform(table, model).collect()
    kept = used(rows)
    x = np.array([v for _, v in kept], float)
    n = len(x)
    v = np.cov(x.T, bias=True)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:5], axes[:, ::-1][:, :5]
    w = (x - x.mean(0)) @ axes / np.sqrt(values)
    sums = [sum(c) for c in zip(*[k for _, k in kept])]
    want = {}
    for (i, xs), row in zip(kept, w):
        dev = sum((n * a - s) ** 2 for a, s in zip(xs, sums))
        for c in range(5):
            want.setdefault((i, c + 1), []).append((dev, abs(row[c]), values[c] / np.trace(v)))
    assert len(got) == 5 * n and all(r.n == n for r in got)
    for r in got:
        ok = [t for t in want[r.vec_id, r.component] if t[0] == r.deviation]
        assert ok and math.isclose(abs(r.whitened), ok[0][1], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r.explained, ok[0][2], rel_tol=1e-9) and 0 <= r.identity_error < 1e-9
    # one sign per component
    first = {}
    for r in got:
        first.setdefault(r.component, []).append(r)
    for c, some in first.items():
        ref = {i: row[c - 1] for (i, _), row in zip(kept, w) if i is not None}
        signs = {np.sign(r.whitened * ref[r.vec_id]) for r in some if r.vec_id is not None and abs(r.whitened) > 1e-6}
        assert len(signs) == 1


def test_whitening_without_variance(spark):
    prepare(spark)
    empty = spark.createDataFrame([], VECTORS)
    assert whitening.transform(empty, whitening.fit(empty)).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0], 1, 2, 3, 4) for i in range(9)], VECTORS)
    assert whitening.transform(same, whitening.fit(same)).collect() == []
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0], 1, 2, 3, 4) for i in range(9)], VECTORS)
    got = whitening.transform(flat, whitening.fit(flat)).collect()
    assert {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-12 for r in got)
    huge = spark.createDataFrame([(i, [1e30 * (-1) ** i], 1, 2, 3, 4) for i in range(4)], VECTORS)
    got = whitening.transform(huge, whitening.fit(huge)).collect()
    assert all(r.deviation is None and abs(abs(r.whitened) - 1) < 1e-9 for r in got)


def _matrices():
    r = np.random.default_rng(2)
    q = np.linalg.qr(r.standard_normal((24, 24)))[0]
    yield np.linalg.qr(r.standard_normal((300, 24)), mode="r")
    yield np.linalg.qr(r.standard_normal((300, 24)) @ np.diag(10.0 ** -np.linspace(0, 7, 24)), mode="r")
    yield q @ np.diag([5.0] * 8 + [2.0] * 8 + [1.0] * 8) @ q.T
    yield q @ np.diag(np.r_[1 + 1e-13 * np.arange(12), 0.5 + 1e-9 * np.arange(12)]) @ q.T
    yield np.eye(24)
    yield np.diag(np.arange(24.0))
    yield np.linalg.qr(r.standard_normal((5, 24)), mode="r")
    yield np.zeros((24, 24))
    yield np.array([[3.0, 1.0], [0.0, 2.0]])
    yield np.array([[-2.0]])


@pytest.mark.parametrize("r", list(_matrices()), ids=lambda r: f"{len(r)}x{r.shape[1]}")
def test_directions_match_singular_values(r):
    values, v = whitening.directions(r, 99)
    want = np.zeros(r.shape[1])
    s = np.linalg.svd(r, compute_uv=False) ** 2
    want[:len(s)] = s
    k = v.shape[1]
    assert k == np.linalg.matrix_rank(r) and np.allclose(values, want, rtol=1e-9, atol=1e-13 * want[0])
    assert np.allclose(values[:k], want[:k], rtol=1e-9, atol=0)
    assert np.abs(v.T @ v - np.eye(k)).max(initial=0) < 1e-11
    assert np.linalg.norm(r.T @ (r @ v) - v * values[:k]) <= 1e-12 * max(values[0], 1)


# -- alignment ----------------------------------------------------------------


def brute_alignment(rows):
    """The contract by the libraries themselves: every overlapping pair of tokens."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(local_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=local_path("piece_bpe_32k.model"))
    byte_of = {chr(c): x for x, c in token_files.byte_alphabet().items()}

    def a_bytes(i):
        return bytes(byte_of[c] for c in a.id_to_token(i))

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for doc_id, text in rows:
        ia = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ib = b.encode(text) if text else []
        sa, sb = [a_bytes(i) for i in ia], [b_bytes(i) for i in ib]
        whole = (" " + (text or "")).encode()
        if b"".join(sa) != whole or b"".join(sb) != whole:
            ia, ib, sa, sb = [], [], [], []
        ea, eb = np.cumsum([len(x) for x in sa]).tolist(), np.cumsum([len(x) for x in sb]).tolist()
        links, lo = [], 0
        for i, e in enumerate(ea):
            while lo < len(eb) and eb[lo] <= e - len(sa[i]):
                lo += 1
            j = lo
            while j < len(eb) and eb[j] - len(sb[j]) < e:
                links.append((ia[i], ib[j]))
                j += 1
        groups, pa_, pb = [], 0, 0
        at_a, at_b = {e: i + 1 for i, e in enumerate(ea)}, {e: i + 1 for i, e in enumerate(eb)}
        for e in ea:
            if e in at_b:
                groups.append(",".join(map(str, ia[pa_:at_a[e]])) + "|" + ",".join(map(str, ib[pb:at_b[e]])))
                pa_, pb = at_a[e], at_b[e]
        counts.update(links)
        docs.append((doc_id, len(ia), len(ib), groups, links))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return Counter((i, na, nb, len(g), len(ln), sum(counts[p] == best[p[1]] for p in ln),
                    sum(counts[p] for p in ln),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
                   for i, na, nb, g, ln in docs)


def aligned_rows():
    odd = [(100 + i, t) for i, t in enumerate([
        " ", "▁", "a▁b", "<s> </s> <unk> <0x0A> <|endoftext|> x", "two  spaces\n\n\n  ", "\x00", "w " * 3000,
        "é" * 700, "x" * 511, "x" * 512, "x" * 513, "it's we'll don't", " lead", "trail "])]
    return [(r[0], r[1]) for r in _rows()] + odd


def test_alignment(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(alignment, "BLOCK", 30_000)         # several blocks a task
    rows = [(*r, *t) for r, t in zip(_rows(), [()] * 999)] + [
        (i, t, "en", "s", 7, 9, "fp", 1, 2, "id", "w", 3, 4, True) for i, t in aligned_rows()[len(_rows()):]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = alignment.aligned(docs)
    assert Counter(tuple(r) for r in got.collect()) == brute_alignment([(r[0], r[1]) for r in rows])
    assert alignment.aligned(docs.limit(0)).collect() == []
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                           "groups_sha256"]


def test_alignment_writes_a_row_group_per_block(spark, monkeypatch):
    """Writers and readers of the blocks hold a row group as a whole."""
    import pyarrow.parquet as pq
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")     # blocks end with a batch
    monkeypatch.setattr(alignment, "BLOCK", 3_000)
    tables, written = [], alignment.written
    monkeypatch.setattr(alignment, "written", lambda *a: tables.append(written(*a)) or tables[-1])
    docs = spark.createDataFrame([(i, f"word {i} " * 200) for i in range(40)], "doc_id long, text string")
    assert alignment.aligned(docs.coalesce(1)).count() == 40
    files = [f for f in os.scandir(tables[0]._riverbed_path.removeprefix("file:")) if f.name.endswith(".parquet")]
    found = [pq.ParquetFile(f.path).metadata for f in files]
    groups = [m.row_group(k).num_rows for m in found for k in range(m.num_row_groups)]
    prepare(spark)
    assert len(groups) > 10 and set(groups) == {1}


def test_what_a_worker_remembers_does_not_grow(monkeypatch):
    """Ever new pieces, many and long ones: the same ids and links as without forgetting."""
    letters = str.maketrans("0123456789", "abcdefghij")
    texts = [" ".join(str(i * 300 + k).translate(letters) for k in range(300)) + " "
             + str(i).translate(letters) * 400 for i in range(60)]
    model = alignment.PieceModel("piece_bpe_32k.model")

    def run(coder):
        out, most = [], 0
        for t in texts:
            raw = np.frombuffer(t.encode(), np.uint8)
            got = alignment.align(pa.array([t]), raw, np.array([0, len(raw)]), coder, model)
            out.append((got.digest, got.n_links.tolist(), got.pair.tolist(), got.times.tolist()))
            most = max(most, coder.coder.n)
        return out, most
    want, grown = run(alignment.ByteLevel("byte_bpe_50k.json"))
    assert grown > 15_000
    monkeypatch.setattr(alignment, "PIECES", 2_000, raising=False)
    few = alignment.ByteLevel("byte_bpe_50k.json")
    got, most = run(few)
    assert got == want and most < 3_000 and few.coder.limit == 2_000
    monkeypatch.setattr(alignment, "PIECES", 1 << 30, raising=False)
    monkeypatch.setattr(alignment, "PIECE_BYTES", 10_000, raising=False)
    got, most = run(alignment.ByteLevel("byte_bpe_50k.json"))
    assert got == want and most < 5_000


def test_lanes_meet_without_losing_or_doubling_links():
    r = np.random.default_rng(1)
    for lane in (1, 2, 7, 64):
        alignment.LANE, old = lane, alignment.LANE
        try:
            sizes = r.integers(1, 60, 9)
            off = np.concatenate([[0], np.cumsum(sizes)])
            cut = lambda: np.unique(np.concatenate([off[1:], r.integers(1, off[-1], 90)]))
            a, b = cut(), cut()
            i, j, ci, cj = alignment.lockstep(a, b, off)
        finally:
            alignment.LANE = old
        sa, sb = np.concatenate([[0], a[:-1]]), np.concatenate([[0], b[:-1]])
        want = {(x, y) for x in range(len(a)) for y in range(len(b)) if sa[x] < b[y] and sb[y] < a[x]}
        assert len(i) == len(want) and set(zip(i.tolist(), j.tolist())) == want
        assert sorted(a[ci].tolist()) == sorted(set(a.tolist()) & set(b.tolist())) and (a[ci] == b[cj]).all()


@pytest.mark.parametrize("name", ["op11_url_rules", "op12_whitening", "op13_alignment"])
def test_queries_read_whole_tables(spark, name):
    d = "/root/testdata/sf0.001"
    got = queries.queries()[name](spark, d)
    table, key = {"op11": ("pages", "page_id"), "op12": ("embeddings", "vec_id"),
                  "op13": ("documents", "doc_id")}[name.split("_")[0]]
    want = spark.read.parquet(f"{d}/{table}.parquet").count()
    assert got.select(key).distinct().count() == want
    if name == "op13_alignment":
        src = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
        assert Counter(tuple(r) for r in got.collect()) == brute_alignment([tuple(r) for r in src])
