"""Every operator against brute force on one awkward fixture: nulls, empty and
blank texts, repeated rows, ties, long texts, clashing extra columns."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riverbed.llm import (bpe, exact_dedup, langid, mixing, quality, repeats, sharding, simhash,
                          token_files, toxicity)
from riverbed.llm.base import crc_mod, local_path
from riverbed.session import shared_path

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size int, fp string, "
          "uid int, slot int, _id string, word string, count int, shard int, kept boolean")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _rows():
    r = random.Random(11)
    stems = {"en": "the of and that with thing river water stone under light",
             "de": "der die und nicht mit schön fluß wasser straße unter licht",
             "fr": "le la et que avec été rivière eau pierre sous lumière"}
    def prose(lang, n):  # noqa: E306
        w = stems[lang].split()
        return " ".join(r.choice(w) + r.choice(["", "", "er", "en", "s"]) for _ in range(n))
    out, passage = [], prose("en", 120)
    for i in range(60):
        lang = r.choice(sorted(stems))
        out.append([i, prose(lang, r.choice([3, 30, 90, 200])), lang, f"s{i % 5}" if i % 3 else "s0"])
    out[3][1] = None
    out[4][1] = ""
    out[5][1] = " \t\n "
    out[6][1] = out[7][1].replace(" ", " \n ")
    out[8][1] = out[9][1] = prose("de", 250)
    out[10][1] = prose("en", 40) + " " + passage + "\n" + prose("fr", 40)
    out[11][1] = passage + " " + prose("en", 30)
    out[12][1] = "x" * 5000
    out[13][1] = ("line one here\n" * 60)
    out[14][1] = " ".join("w%d" % (i % 9) for i in range(20000))
    out[15][1] = "日本語 テキスト ½ 👩‍👩‍👧 'll don't   \x1c\x85 end"
    out[16][1] = "THE!! OF!! AND$$$ *** " * 30
    out[17][2] = None
    out[18][3] = None
    out[19][3] = None
    out[20][0] = None
    out[21][0] = None
    out[21][1] = out[20][1]
    out.append(list(out[9]))
    out.append([61, out[9][1] + " tail", "de", "s1"])
    out.append([62, "short", "en", "alone"])
    return [(*x, 7, 9, "fp", 1, 2, "id", "w", 3, 4, True) for x in out]


ROWS = _rows()
TEXTS = [(r[0], r[1] or "") for r in ROWS]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def as_bag(rows):
    return Counter(tuple(r) for r in rows)


def key(v):
    return (v is None, v if v is not None else 0)


# -- quality -----------------------------------------------------------------------------

def _base(text):
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            covered.update(range(i, i + 8))
    rep = len(covered)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, rep,
            len(w) < 20 or 100 * rep > 30 * len(w))


def test_quality_counts_and_verdict(docs):
    got = quality.assess(docs).collect()
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed"]
    assert as_bag([tuple(r[c] for c in cols) for r in got]) == as_bag(
        [(i, *_base(t)) for i, t in TEXTS])
    assert not any(r["kept"] and r["base_failed"] for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert not by_id[16]["kept"] and by_id[8]["kept"]


def test_js_distance_against_definition():
    rng = np.random.default_rng(3)
    p, q = rng.random((4, 6)), rng.random(6)
    for row, d in zip(p, quality.js_distance(p, q)):
        a, b = row / row.sum(), q / q.sum()
        m = (a + b) / 2
        kl = lambda x: float((x * np.log2(x / m)).sum())
        assert abs(d - ((kl(a) + kl(b)) / 2) ** 0.5) < 1e-12
    assert quality.js_distance(q[None], q)[0] == 0


def test_quality_filter_keeps_columns(docs):
    kept = quality.keep_good(docs)
    want = [r["doc_id"] for r in quality.assess(docs).where("kept").collect()]
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(want)


def test_references_cover_all_good_documents(docs):
    refs = quality.references(docs).where("kind = 'word'").groupBy("lang").agg(F.sum("n").alias("n"))
    want = defaultdict(int)
    for r in ROWS:
        b = _base(r[1] or "")
        if r[2] is not None and not b[5]:
            want[r[2]] += b[0]
    assert {r["lang"]: r["n"] for r in refs.collect()} == dict(want)


def _prose_corpus(seed):
    """``(doc_id, text, lang)``: sixty English texts and one function that makes more."""
    r = random.Random(seed)
    stems = {"en": "the of and that with thing river water stone under light",
             "pt": "não uma para com mais água pedra sobre luz então muito",
             "el": "και το να του με που από για στο νερό πέτρα"}
    def text(lang, n):  # noqa: E306
        return " ".join(r.choice(stems[lang].split()) + r.choice(["", "a", "s"]) for _ in range(n))
    return [(i, text("en", 150), "en") for i in range(60)], text, r


def _noise(r, n):
    return " ".join(r.choice("#*$%&|<>") * 2 + r.choice("#*$%&|<>0123456789") for _ in range(n))


def test_quality_gives_no_divergence_verdict_without_a_reference(spark):
    rows, text, r = _prose_corpus(5)
    rows += [(100 + i, text("pt", 100), "pt") for i in range(10)]       # under min_ref_words
    rows += [(200, text("el", 120), "el")]                              # a language of one text
    rows += [(300, text("pt", 120), None), (301, text("el", 120), None), (302, text("en", 120), None)]
    rows += [(400, _noise(r, 150), "en"), (401, _noise(r, 150), None), (402, "pt short", "pt")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    got = {x["doc_id"]: x for x in quality.assess(docs).collect()}
    assert {i for i, x in got.items() if not x["kept"]} == {400, 401, 402}
    assert all(got[i]["char_distance"] == got[i]["word_distance"] == 0 for i in [*range(100, 110), 200])
    assert got[300]["word_distance"] > 0.5
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {x["doc_id"] for x in kept.collect()} == {*got} - {400, 401, 402}


def test_quality_verdicts_do_not_depend_on_copies(spark):
    rows, _, r = _prose_corpus(6)
    noise = _noise(r, 150)
    rows += [(100 + i, _noise(r, 150), "en") for i in range(5)] + [(200, noise, "en")]
    copies = [(300 + i, noise, "en") for i in range(200)]
    schema = "doc_id long, text string, lang string"

    def verdicts(x):
        frame = spark.createDataFrame(x, schema).repartition(3)
        refs = quality.references(frame, once=True).collect()
        return as_bag(refs), {v["doc_id"]: v[1:] for v in quality.assess(frame).collect()}

    refs, plain = verdicts(rows)
    hot_refs, hot = verdicts(rows + copies)
    assert hot_refs == refs
    assert {i: v for i, v in hot.items() if i < 300} == plain
    assert not any(hot[i] != plain[200] for i in range(300, 500))
    at = quality.SCHEMA.replace(" boolean", "").replace(" long", "").split(", ").index("kept")
    assert not any(hot[i][at] for i in [*range(100, 105), *range(300, 500)])


# -- sharding ----------------------------------------------------------------------------

@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_are_even_gapless_and_reproducible(docs, shards):
    a = sharding.assign(docs, shards).collect()
    assert as_bag((r["doc_id"], r["size"], r["text_crc32"]) for r in a) == as_bag(
        (i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in TEXTS)
    slots = defaultdict(list)
    for r in a:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    b = sharding.assign(docs.repartition(5), shards).collect()
    assert as_bag(a) == as_bag(b)


@pytest.mark.parametrize("side", [1, 2, 13])
def test_feistel_is_a_permutation(spark, side):
    image = spark.range(side * side).select(sharding.feistel(F.col("id"), side, 7).alias("y"))
    assert sorted(r["y"] for r in image.collect()) == list(range(side * side))


def test_copies_of_one_row_are_numbered_in_strides(spark, monkeypatch):
    """A third of all rows equal, ids null or repeated; gapless and the same on every run."""
    monkeypatch.setattr(sharding, "STRIDE", 7)
    rows = [(5, "same")] * 100 + [(None, "none")] * 60 + [(None, None)] * 2 + [(i, f"t{i % 9}") for i in range(140)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    a = sharding.assign(frame.repartition(4), 40).collect()
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in a) == want
    assert sorted(r["row"] for r in a) == list(range(len(rows)))
    assert sorted((r["shard"], r["slot"]) for r in a) == sorted((i % 40, i // 40) for i in range(len(rows)))
    assert Counter(map(tuple, a)) == Counter(map(tuple, sharding.assign(frame, 40).collect()))


def test_rows_of_one_id_fill_several_parts(spark):
    path = shared_path(spark, "hot-id-tokens")
    rows = [(None, f"text {i % 5}") for i in range(300)] + [(7, "same")] * 300 + [(i, "x") for i in range(300)]
    small = "spark.sql.adaptive.coalescePartitions.enabled"     # these ranges are tiny
    spark.conf.set(small, "false")
    try:
        token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), path)
    finally:
        spark.conf.unset(small)
    assert spark.read.parquet(path).where("array_contains(doc_ids, 7)").select("part").distinct().count() > 1
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids)
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()


def test_write_shards(spark, docs):
    path = shared_path(spark, "shards")
    sharding.write_shards(docs.select("doc_id", "text"), path, 4)
    back = spark.read.parquet(path)
    assert as_bag((r["doc_id"], r["text"]) for r in back.collect()) == as_bag(
        (r[0], r[1]) for r in ROWS)


# -- token files -------------------------------------------------------------------------

def test_token_files_round_trip(spark, docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(local_path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    path = shared_path(spark, "tokens")
    token_files.write(docs, path)
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
    ids = {}
    for i, t in TEXTS:
        ids.setdefault((i is not None, i or 0), []).append(
            [*tok.encode(t, add_special_tokens=False).ids, 2])
    start, seen = 0, []
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
        seen.append((r["doc_id"] is not None, r["doc_id"] or 0))
    assert seen == sorted(seen)
    crc = lambda x: zlib.crc32(struct.pack(f"<{len(x)}I", *x))
    want = Counter((k, len(x), crc(x)) for k, v in ids.items() for x in v)
    assert Counter((k, r["n_tokens"], r["ids_crc32"]) for k, r in zip(seen, got)) == want


def test_token_files_match_added_tokens_inside_texts(spark):
    from tokenizers import Tokenizer
    tok, mark = Tokenizer.from_file(local_path("byte_bpe_50k.json")), "<|endoftext|>"
    r = random.Random(4)
    parts = [mark, mark, "a ", " b", "  ", "'s", "<|", "|>", "endoftext", "\n", "日本 ", "é", "", "<|endof"]
    texts = ["a <|endoftext|> b", mark, mark + mark, "x<|endof", "text|>", "", mark + "é", "<" + mark + ">", None]
    texts += ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    path = shared_path(spark, "tokens-added")
    token_files.write(rows, path)
    start = 0
    for t, row in zip(texts, sorted(token_files.read(spark, path).collect(), key=lambda x: x["doc_id"])):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (
            start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_pack_unpack_all_lengths():
    rng = np.random.default_rng(5)
    for n in (0, 1, 3, 4, 1000):
        ids = rng.integers(0, 2**32, n, dtype=np.uint32)
        ids[: n // 2] = 7
        assert (token_files.unpack(*token_files.pack(ids), n) == ids).all()
    many = np.arange(70000, dtype=np.uint32)
    ranked, control, data = token_files.pack(many)
    assert len(data) == 256 + 2 * (65536 - 256) + 3 * (70000 - 65536)
    assert (token_files.unpack(ranked, control, data, len(many)) == many).all()


# -- SimHash -----------------------------------------------------------------------------

def _fingerprint(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(n, linked):
    parent = list(range(n))
    def root(i):  # noqa: E306
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                parent[root(i)] = root(j)
    return [root(i) for i in range(n)]


def test_simhash_components(docs):
    prints = [_fingerprint(t) for _, t in TEXTS]
    cls = _classes(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    least = {}
    for c, (i, _) in zip(cls, TEXTS):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = Counter((i, p, least.get(c)) for (i, _), p, c in zip(TEXTS, prints, cls))
    got = simhash.groups(docs).collect()
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == want
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _, c in want if i == c}


@pytest.mark.parametrize("short,block,posted", [(48, 2048, 4), (2, 4, 4), (48, 2048, 3), (2, 4, 5), (2, 4, 1)])
def test_links_span_the_same_groups_as_all_pairs(spark, monkeypatch, short, block, posted):
    """Random clusters, with posting lists short, long, and cut into blocks, of any width."""
    rng = np.random.default_rng(short)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:
        x = int(b)
        for _ in range(12):
            for bit in rng.integers(0, 64, rng.integers(1, 4)):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(fps)
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash.Index.links, "__defaults__", (short,))
    frame = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    found = {tuple(sorted((r["a"] % 2**64, r["b"] % 2**64))) for r in simhash.links(frame, 3, posted).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    want = _classes(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    got = _classes(len(fps), lambda i, j: (fps[j], fps[i]) in found)
    assert len(set(want)) == len(set(got))


# -- exact dedup -------------------------------------------------------------------------

def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t)


def test_exact_groups(docs):
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[_norm(t)].append(i)
    got = exact_dedup.refine(docs, digest=True).collect()
    assert as_bag((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == \
        as_bag((i, min(groups[_norm(t)], key=key), len(groups[_norm(t)]),
                hashlib.sha256(_norm(t).encode()).hexdigest()) for i, t in TEXTS)
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter(
        hashlib.sha256(t.encode()).hexdigest() for t in groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_bitmap_hashes_every_survivor_and_few_others(spark):
    groups = spark.range(3000).selectExpr("cast(id % 7 as int) AS len", "id * 31 AS head")
    bits = exact_dedup._bitmap_bits(3000)
    assert bits == exact_dedup.MIN_BITS and exact_dedup._bitmap_bits(0) == bits
    assert exact_dedup._bitmap_bits(1 << 20) == 1 << 24 and exact_dedup._bitmap_bits(1 << 40) == exact_dedup.MAX_BITS
    bits = 1 << 16
    rows = spark.range(60000).selectExpr("cast(id % 7 as int) AS len", "id * 31 AS head", "id") \
        .withColumn("bucket", F.bitmap_bucket_number(exact_dedup._bit(bits))) \
        .join(exact_dedup._bitmap(groups, bits), "bucket", "left") \
        .select("id", exact_dedup._is_set("bitmap", exact_dedup._bit(bits)).alias("on")).collect()
    on = {r["id"] for r in rows if r["on"]}
    assert len(rows) == 60000 and set(range(3000)) <= on
    # 3,000 of 65,536 bits: some 4.5 % of the others share one
    assert 0.03 < (len(on) - 3000) / 57000 < 0.06


def test_exact_hot_text_among_texts_of_its_length(spark):
    """A third of all rows is one text; as many have its length, and its prefix, but are alone."""
    head = "w" * exact_dedup.PREFIX
    rows = [(i, head + "same-" + "x" * 5) for i in range(400)] \
        + [(i, head + f"{i:010d}") for i in range(400, 800)] + [(i, f"{i:0138d}") for i in range(800, 1200)]
    got = exact_dedup.refine(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got} == \
        {(i, 0 if i < 400 else i, 400 if i < 400 else 1, i == 0 or i >= 400) for i in range(1200)}


def test_exact_filter_keeps_one_row_of_each_text(docs):
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[_norm(t)].append(i)
    assert as_bag((r["doc_id"], _norm(r["text"] or "")) for r in kept.collect()) == as_bag(
        (min(v, key=key), t) for t, v in groups.items())


# -- language ----------------------------------------------------------------------------

def test_language_held_out_and_rejection(docs):
    model = langid.train(docs, crc_mod("doc_id", 5) != 0)
    got = langid.predict(docs, model).withColumn("out", crc_mod("doc_id", 5) == 0).collect()
    lang = {r[0]: r[2] for r in ROWS}
    # rows 22 to 59 hold the prose of their own language
    held = [r for r in got if r["out"] and 22 <= r["doc_id"] < 60
            and len(dict(TEXTS)[r["doc_id"]]) > 300]
    assert held and all(r["lang_pred"] == lang[r["doc_id"]] for r in held)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (3, 4, 5))
    assert by_id[12]["rejected"]
    assert all(0 <= r["score"] <= 1 for r in got) and len(got) == len(ROWS)


# -- BPE ---------------------------------------------------------------------------------

def test_bpe_equals_library_and_round_trips(docs):
    import public_tokenizers as P
    import tiktoken
    ranks = bpe.load_ranks(local_path("byte_bpe_50k.tiktoken"))
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.round_trip(docs).collect()
    want = Counter()
    for i, t in TEXTS:
        ids = lib.encode_ordinary(t)
        want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
             hashlib.sha256(t.encode()).hexdigest()] += 1
    assert as_bag(got) == want


def test_transducer_on_random_merges_and_small_state_tables():
    r = random.Random(2)
    ranks = {bytes([b]): b for b in range(256)}
    alphabet = [b"a", b"b", b"c"]
    tokens = list(alphabet)
    while len(tokens) < 60:
        t = r.choice(tokens) + r.choice(tokens)
        if t not in ranks and len(t) < 9:
            ranks[t] = len(ranks)
            tokens.append(t)
    machine = bpe.Transducer(ranks, limit=20)

    def plain(word):
        parts = [word[i:i + 1] for i in range(len(word))]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                return [ranks[p] for p in parts]
            _, i = min(pairs)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
    for _ in range(400):
        word = b"".join(r.choice(alphabet) for _ in range(r.randint(1, 30)))
        assert machine.encode(word) == plain(word)


def test_decoder_holds_characters_over_and_marks_broken_bytes():
    d = bpe.Decoder({i: bytes([i]) for i in range(256)})
    text = "aé日👩z"
    assert "".join(d.feed([b]) for b in text.encode()) + d.finish() == text
    assert d.feed([0x61, 0xE6, 0x97, 0x62]) + d.finish() == "a�b"
    assert d.feed([0xFF, 0x61, 0xC3]) + d.finish() == "�a�"
    assert d.feed([0xE0, 0x80]) + d.finish() == "��"


# -- mixing ------------------------------------------------------------------------------

def test_mix_targets_and_copies(docs):
    got = mixing.mix(docs).collect()
    n = lambda t: len(WORD.findall(t))
    assert as_bag((r["doc_id"], r["size"]) for r in got) == as_bag((i, n(t)) for i, t in TEXTS)
    total = defaultdict(int)
    for r in ROWS:
        total[r[3]] += n(r[1] or "")
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, goal = {}, 1.5 * sum(total.values())
    open_names = set(names)
    while True:
        level = (goal - sum(2 * total[s] for s in names if s not in open_names)) / sum(
            weight[s] for s in open_names)
        over = {s for s in open_names if weight[s] * level > 2 * total[s]}
        if not over:
            break
        open_names -= over
    target = {s: weight[s] * level if s in open_names else 2.0 * total[s] for s in names}
    taken, biggest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == total[r["source"]]
        assert abs(r["target"] - target[r["source"]]) < 1e-6
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    for r in ROWS:
        biggest[r[3]] = max(biggest[r[3]], n(r[1] or ""))
    assert all(abs(taken[s] - target[s]) <= biggest[s] for s in names)
    assert as_bag(got) == as_bag(mixing.mix(docs.repartition(5)).collect())


def test_mixed_rows(docs):
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"], r["source"]] += r["copies"]
    rows = mixing.take(docs)
    assert rows.columns == docs.columns
    assert Counter((r["doc_id"], r["source"]) for r in rows.collect()) == +want


def test_one_hash_cell_for_all(spark):
    """A source whose rows share one id is a single unit of the histogram."""
    rows = [(1, "a b c", "x")] * 4 + [(i, "w " * 10, "y") for i in range(50)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len({r["copies"] for r in got if r["source"] == "x"}) == 1


# -- repeated passages -------------------------------------------------------------------

def _removed(texts, length):
    n = Counter()
    raw = [t.encode() for t in texts]
    for b in raw:
        n.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if n[b[i:i + length]] > 1:
                gone[i:i + length] = True
        turn = np.flatnonzero(np.diff(np.r_[False, gone, False]))
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), tuple(zip(turn[::2].tolist(), turn[1::2].tolist())),
                    hashlib.sha256(kept).hexdigest()))
    return out


def _spans(rows):
    return Counter((r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), r["kept_sha256"])
                   for r in rows)


def test_repeats_equal_brute_force(docs):
    assert _spans(repeats.repeats(docs).collect()) == Counter(_removed([t for _, t in TEXTS], 400))


def test_repeats_with_edits_and_many_shards(spark, monkeypatch):
    """Near copies, shifted passages and settled beside open ranges, in tiny shards."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    page = [word() for _ in range(400)]
    texts = [" ".join(page)] * 3
    for _ in range(12):
        copy = list(page)
        for _ in range(r.randint(1, 6)):
            copy[r.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    for _ in range(8):
        a = r.randrange(200)
        texts.append(" ".join([word() for _ in range(r.randrange(60))] + page[a:a + r.randint(50, 150)]
                              + [word() for _ in range(r.randrange(60))]))
    texts.append("ab" * 700)
    texts.append("é" * 900)
    monkeypatch.setattr(repeats, "SHARD", 30)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert _spans(repeats.repeats(frame).collect()) == Counter(_removed(texts, 400))


def test_repeats_merge_finds_the_common_prefixes(spark, monkeypatch):
    """Candidates of the merged transforms = anchors whose suffix shares its first ``depth``
    phrases with another suffix, by comparing all of them; depths of 2 to ``ROUNDS``."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    page = [word() for _ in range(700)]
    texts = [" ".join(page), "xy" * 500]
    for _ in range(25):
        a = r.randrange(500)
        texts.append(" ".join([word() for _ in range(r.randrange(40))]
                              + page[a:a + r.randint(20, 200)] + [word() for _ in range(80)]))
    suffixes, mine = Counter(), []
    for i, t in enumerate(texts):
        buf = np.frombuffer(t.encode(), np.uint8)
        off = np.array([0, len(buf)])
        place, doc, low, high = repeats.anchors(buf, off)
        sym = repeats.symbols(repeats.prefix_hash(buf), place, doc).tolist()
        for k in range(len(place)):
            for h in range(1, repeats.ROUNDS + 1):
                if 0 not in sym[k:k + h] and k + h <= len(sym):
                    suffixes[tuple(sym[k:k + h])] += 1
            if high[k] >= low[k]:
                # phrases that begin before the reach, by the definition
                h = sum(p < place[k] + repeats.reach(400) for p in place[k:-1])
                mine.append((i, int(place[k]), tuple(sym[k:k + min(h, repeats.ROUNDS)])))
    want = {(i, at) for i, at, head in mine if suffixes[head] > 1}
    assert {len(head) for _, _, head in mine} == set(range(2, repeats.ROUNDS + 1))
    monkeypatch.setattr(repeats, "SHARD", 40)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {(row["doc_id"], int(at)) for row in repeats.candidates(frame, "doc_id", "text", 400).collect()
           for at in np.frombuffer(row["places"], np.int32)}
    assert got == want and len(want) < len(mine)


# -- toxicity ----------------------------------------------------------------------------

def test_toxicity_learns_terms_and_misspellings(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("aeinorstl") for _ in range(r.randint(2, 8)))
    bad = ["vermin", "scoundrel", "wretchedly"]
    rows, marks = [], []
    for i in range(400):
        words = [word() for _ in range(40)]
        if i % 4 == 0:
            for _ in range(2):
                words.insert(r.randrange(40), r.choice(bad))
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 4 == 0)))
    marks += [(0, None), (None, 1), (0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    lexicon = toxicity.train(docs, labels, crc_mod("doc_id", 4) != 2)
    assert set(bad) <= set(lexicon.exact) and len(lexicon.exact) < 6
    probe = spark.createDataFrame([
        (1, "you are a vermin here"), (2, "such a scuondrel indeed"), (3, "quite wretchdly done"),
        (4, 'he said "vermin" and left'), (5, None), (6, ""), (7, "a calm and pleasant text")],
        "doc_id long, text string")
    s = {x["doc_id"]: x["score"] for x in toxicity.score(probe, lexicon).collect()}
    assert s[1] >= 0.9 and s[2] >= 0.3 and s[3] >= 0.3
    assert s[4] < s[1] and s[5] == s[6] == s[7] < 0.3


def test_automaton_equals_edit_distance():
    r = random.Random(6)
    terms = sorted({"".join(r.choice("abc") for _ in range(n)) for n in (3, 4, 5, 6, 7, 9, 10) for _ in range(4)})
    machine = toxicity.Automaton(terms, limit=50)

    def distance(a, b):     # edits with swaps of neighbours, each letter edited once
        d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]
    for _ in range(1500):
        w = "".join(r.choice("abcd") for _ in range(r.randint(0, 11)))
        hits = [(distance(w, t), t) for t in terms if distance(w, t) <= toxicity.edits_for(t)]
        assert machine.match(w) == (min(hits)[::-1] if hits else None)


# -- empty tables ------------------------------------------------------------------------

def test_empty_tables_give_empty_results(spark, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    path = shared_path(spark, "none")
    token_files.write(none, path)
    results = [
        quality.assess(none), quality.keep_good(none), sharding.assign(none, 40),
        token_files.read(spark, path), simhash.groups(none), simhash.drop_near_copies(none),
        exact_dedup.refine(none, digest=True), exact_dedup.drop_copies(none),
        langid.predict(none, langid.train(none, F.lit(True))), bpe.round_trip(none),
        mixing.mix(none), mixing.take(none), repeats.repeats(none),
        toxicity.score(none, toxicity.train(none, labels, F.lit(True)))]
    assert all(x.count() == 0 for x in results)
