"""Operators over single texts: toxicity, decontamination, shards, token files, BPE, PII."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seisma.llm import bpe, chunks, decontaminate, pii, registry, sharding, token_files, toxicity
from seisma.session import scratch_path

SCHEMA = "doc_id bigint, text string, n_words string, shard int"
LONG = "word 12 a.b@c.de 1234 5678 " * 4000
ODD = ["", None, " \t\n ", "a", "á É İstanbul ΣΑΣ ß ﬁ", "<|endoftext|>x <|startoftext|>", "x y z\x1cq\x85", "日本 語!! 42", "'s 't don't", LONG, "\U0001f600 \u0000 b"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "n", 7) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[3], (None, "null id", None, None)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [r.asDict() for r in df.collect()]


# toxicity


def test_toxicity_learns_words_and_stems():
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(300)]
    texts, y = [], []
    for i in range(1500):
        words = list(rng.choice(base, 40))
        bad = i % 5 == 0
        if bad:
            words[3] = ["grumsh", f"zorkl{rng.integers(1000)}"][i % 2]
            if i % 3 == 0:
                words += ["grumsh"] * 9
        texts.append(" ".join(words).encode())
        y.append(bad)
    y = np.array(y)
    grades = toxicity.severity_grades(texts, y)
    assert set(grades[~y]) == {0} and grades[y].min() >= 1 and grades.max() == 3
    m = toxicity.fit(texts[:1000], grades[:1000])
    p = np.array([m.probabilities(t) for t in texts[1000:]])
    assert ((p[:, 0] >= 0.5) == y[1000:]).mean() > 0.99
    assert (np.diff(p, axis=1) <= 1e-12).all() and m.cuts == sorted(m.cuts)
    severe = p.sum(axis=1)
    assert severe[grades[1000:] == 3].mean() > severe[grades[1000:] == 1].mean() > severe[grades[1000:] == 0].mean()


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, 0), (99, 1), (None, 1), (5, None)], "doc_id bigint, toxic int")
    m = toxicity.train(odd, labels)
    got = toxicity.score(odd, m)
    assert got.columns == ["doc_id", "p_toxic", "severity", "grade", "rejected"] and got.count() == len(ODD) + 2
    assert toxicity.keep_clean(odd, m).columns == odd.columns
    none = toxicity.train(odd, labels.limit(0))
    assert all(r["severity"] == 0 and not r["rejected"] for r in rows(toxicity.score(odd, none)))
    assert toxicity.score(empty, toxicity.train(empty, labels)).count() == 0
    assert toxicity.keep_clean(odd, none).count() == odd.count()


def test_toxicity_fit_is_the_maximum_of_the_penalised_likelihood():
    rng = np.random.default_rng(5)
    words = [bytes([97 + i, 113]) for i in range(12)]  # two letters: no beginnings of their own
    counts = rng.poisson(0.6, (900, 12))
    truth, cuts = rng.normal(0, 1.5, 12), np.array([0.5, 1.5, 3.0])
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0)
    grades = ((x @ truth + rng.logistic(size=900))[:, None] > cuts).sum(axis=1)
    texts = [b" ".join(w for w, n in zip(words, row) for _ in range(n)) for row in counts]
    m = toxicity.fit(texts, grades, words)
    w, b = np.array([m.weights.get(f, 0.0) for f in words]), np.array(m.cuts)

    def loss(w, b):
        p = 1 / (1 + np.exp(b[None, :] - (x @ w)[:, None]))
        above = grades[:, None] >= np.arange(1, 4)
        return -np.log(np.where(above, p, 1 - p)).sum() + 0.15 * (w**2).sum()

    at, eps = loss(w, b), 1e-4
    slopes = [(loss(w + eps * d, b) - loss(w - eps * d, b)) / (2 * eps) for d in np.eye(12)]
    slopes += [(loss(w, b + eps * d) - loss(w, b - eps * d)) / (2 * eps) for d in np.eye(3)]
    assert np.abs(slopes).max() < 0.5 and (b[1:] >= b[:-1]).all()  # of a loss of several hundred
    for _ in range(200):  # no step in any direction betters it
        d = rng.normal(size=15)
        d *= 0.1 / np.linalg.norm(d)
        assert loss(w + d[:12], b + d[12:]) > at
    for text, row in zip(texts[:50], x):
        p = 1 / (1 + np.exp(b - row @ w))
        assert np.allclose(m.probabilities(text), p)


def test_toxicity_severity_is_the_expected_grade(spark):
    m = toxicity.OrdinalModel({b"bad": 2.0, b"vill*": 1.0}, [1.0, 2.5, 4.0])
    df = spark.createDataFrame([(1, "bad bad village VILLA"), (2, "fine"), (3, None)], "doc_id bigint, text string")
    for r in rows(toxicity.score(df, m)):
        z = 3 * (1 + np.log(2)) if r["doc_id"] == 1 else 0.0  # two words and two beginnings
        p = [1 / (1 + np.exp(b - z)) for b in m.cuts]
        grade = [1 - p[0], p[0] - p[1], p[1] - p[2], p[2]]
        assert abs(r["severity"] - sum(k * q for k, q in enumerate(grade))) < 1e-9 and abs(r["p_toxic"] - p[0]) < 1e-9


# decontamination


def brute_hits(text, items, window=10):
    def low(t):
        return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    found = list(word.finditer(low(text)))
    words, hit, names = [m.group() for m in found], set(), set()
    for name, item in items:
        w = word.findall(low(item))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            p = w[k : k + window]
            for i in range(len(words) - len(p) + 1):
                if words[i : i + len(p)] == p:
                    hit |= set(range(i, i + len(p)))
                    names.add(str(name))
    return len(words), hit, sorted(names), found


def test_decontaminate_against_brute_force(spark):
    rng = np.random.default_rng(2)
    vocab = ["a", "B", "é", "c3", "ab"]
    items = [(i, " ".join(rng.choice(vocab, n))) for i, n in enumerate([1, 2, 3, 5, 11, 12, 14, 0])] + [(2, "x, Y"), (None, "a"), (9, None)]
    texts = [(i, "-".join(rng.choice([*vocab, "z", "q", "r", "s"], rng.integers(0, 60)))) for i in range(60)] + [(60, None), (61, ""), (0, "a b"), (62, "X y!")]
    docs = spark.createDataFrame([(*t, "k") for t in texts], "doc_id int, text string, items string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    known = [(i, t) for i, t in items if i is not None and t is not None]
    for block in (decontaminate.BLOCK_BYTES, 40):  # in one automaton, and in several
        got = rows(decontaminate.scan(docs, bench, window=4, block_bytes=block))
        want = [(i, *brute_hits(t, known, 4)) for i, t in texts]
        assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got) == sorted((i, n, len(h), x) for i, n, h, x, _ in want)
        by = {(i, n): (h, f) for i, n, h, _, f in want}
        for r in got:
            hit, found = by[r["doc_id"], r["n_words"]]
            assert {k for k, m in enumerate(found) for s in r["spans"] if s["start"] <= m.start() and m.end() <= s["end"]} == hit
        clean = decontaminate.keep_clean(docs, bench, window=4, block_bytes=block)
        assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _, h, _, _ in want if not h)


def test_decontaminate_empty(spark, odd, empty):
    bench = spark.createDataFrame([], "item_id int, text string")
    assert all(r["n_hit"] == 0 for r in rows(decontaminate.scan(odd, bench)))
    assert decontaminate.scan(empty, bench).count() == 0 and decontaminate.keep_clean(odd, bench).count() == odd.count()


# sharding


def jump(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(100, 400, 7)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for n in (1, 2, 40, 41, 1000):
        assert [r[0] for r in df.select(sharding.jump_hash(F.col("k"), n)).collect()] == [jump(k, n) for k in keys]


def test_shards(spark, docs, odd, empty):
    for df in (docs, odd):
        got, texts = rows(sharding.assign(df, 40)), df.collect()
        by = collections.defaultdict(list)
        for r in got:
            assert r["shard"] == jump(r["doc_id"] or 0, 40) and r["grown_shard"] in (r["shard"], 40)
            by[r["shard"]].append(r["slot"])
        assert all(sorted(x) == list(range(len(x))) for x in by.values())
        want = collections.Counter((t.doc_id, len((t.text or "").encode()) + 16, zlib.crc32((t.text or "").encode())) for t in texts)
        assert want == collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    assert sharding.assign(empty, 40).count() == 0


# token files and BPE


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(registry.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_as_the_library(spark, docs, odd, empty, tokenizer):
    for df in (docs, odd):
        texts = collections.Counter((r.doc_id, r.text) for r in df.collect())
        want = collections.Counter()
        for (i, t), n in texts.items():
            ids = tokenizer.encode(t or "", add_special_tokens=False).ids
            want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                 hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += n
        got = collections.Counter(tuple(r) for r in bpe.digests(df, registry.tokenizer_path()).collect())
        assert got == want
    whole = rows(bpe.encode(odd.where("doc_id = 4"), registry.tokenizer_path()))[0]
    assert whole["ids"] == tokenizer.encode(ODD[4], add_special_tokens=False).ids
    assert bpe.digests(empty, registry.tokenizer_path()).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aeiounthr'sd 1-é")), max_size=60))
def test_bpe_fragments(text):
    e = bpe.encoder(registry.tokenizer_path())
    ids, decoded = e.encode(text)
    want = e.library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert decoded.decode() == e.library.decode(want, skip_special_tokens=False)


def test_bpe_other_vocabulary():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    try:
        e = bpe.FragmentBpe(path)
    except ValueError:
        return
    for text in ("The the  cat's\n\n hat<|endoftext|>x", LONG[:500], "é ü 日本"):
        ids, decoded = e.encode(text)
        want = e.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and decoded.decode() == e.library.decode(want, skip_special_tokens=False)


def test_fragments_are_cut_where_no_token_spans():
    e = bpe.encoder(registry.tokenizer_path())
    for word in ("strength", "qzxj", "aaaaaaaa", "é"[:1]):
        parts = e.fragments(word)
        assert [s for p in parts for s in p] == [*word[:-1], word[-1] + e.end]
        assert all((a[-1], b[0]) not in e.inside for a, b in zip(parts, parts[1:]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=400), max_size=6))
def test_simple8b_round_trip(lists):
    ids = np.array([i for x in lists for i in x], dtype=np.uint64)
    records = token_files.pack(ids, np.array([len(x) for x in lists], dtype=np.int64))
    back, lengths = token_files.unpack(records)
    assert lengths.tolist() == [len(x) for x in lists] and back.tolist() == ids.tolist()


def test_token_files(spark, docs, odd, empty, tokenizer):
    for df in (docs, odd, empty):
        folder = scratch_path(spark, "test-tokens")
        token_files.write(df, folder, registry.tokenizer_path(), 2)
        got = sorted(rows(token_files.read_digests(spark, folder)), key=lambda r: r["start"])
        at = 0
        texts = collections.defaultdict(list)
        for r in df.collect():
            texts[r.doc_id].append(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2])
        assert [r["doc_id"] for r in got] == sorted((i for i, x in texts.items() for _ in x), key=lambda i: (i is not None, i))
        for r in got:
            assert r["start"] == at
            at += r["n_tokens"]
            assert (r["n_tokens"], r["ids_crc32"]) in [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in texts[r["doc_id"]]]
    ids = {r["doc_id"]: r["ids"] for r in rows(token_files.read(spark, folder))}
    assert ids == {}


# PII

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_pii(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TRICKY = [
    "a@b.c.d-e%f@g.h x@y", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111",
    "😀é mail: jo.hn+x@ex-am.co.uk, tel +49 (30) 123-456.78 +1", "+1234567890123456 + 123456789", "9" * 5000 + "@", "a" * 5000, "1." * 3000,
    "x@" + "a." * 3000 + "b", "IBAN DE89370400440532013000 or GB82 WEST 1234 5698 7654 32 not DE88370400440532013000", "@@..@a.b", "1-1-1-1 " * 2000, "%@a.b\n.@c.d"]


def test_pii_against_brute_force(spark, docs, odd, empty):
    tricky = spark.createDataFrame([(i, t) for i, t in enumerate([*TRICKY, None, "", LONG])], "doc_id bigint, text string")
    for df in (docs, odd, tricky):
        texts = collections.Counter()
        for r in df.collect():
            spans = brute_pii(r.text)
            n = collections.Counter(s.split(":")[0] for s in spans)
            texts[(r.doc_id, *(n[k] for k in pii.KINDS), hashlib.sha256(",".join(spans).encode()).hexdigest())] += 1
        got = rows(pii.report(df))
        assert texts == collections.Counter((r["doc_id"], *(r[f"n_{k}"] for k in pii.KINDS), r["base_sha256"]) for r in got)
    by = {r["doc_id"]: r for r in rows(pii.report(tricky))}
    assert by[9]["n_iban"] == 2 and by[9]["spans"].endswith(",iban:31:58") and by[9]["top_score"] == 1.0
    assert pii.report(empty).count() == 0


def test_pii_has_no_python(spark, docs):
    plan = pii.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_pii_many_spans_in_one_text(spark):
    import time

    iban = "DE89370400440532013000"
    texts = ["é ".join(f"jo{i}@ex.org mail 10.0.{i % 256}.7" for i in range(n)) for n in (127, 128, 129, 257)] + [
        f"{iban} " * 300, "+49 30 1234567, " * 400, "a@b.c " * 170_000, f"bank {iban} x" * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    started = time.time()
    got = {r["doc_id"]: r for r in rows(pii.report(df))}
    assert time.time() - started < 60
    for i, t in enumerate(texts):
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(brute_pii(t)).encode()).hexdigest()
    assert got[4]["spans"].endswith(",".join(f"iban:{23 * i}:{23 * i + 22}" for i in range(300))) and got[4]["n_iban"] == 300
    assert got[6]["n_email"] == 170_000


def account(code, rest):
    """A valid account number: the check digits are 98 less the remainder."""
    n = int("".join(str(int(c, 36)) for c in rest + code + "00"))
    return f"{code}{98 - n % 97:02d}{rest}"


def test_pii_account_numbers_before_capitals_and_digits(spark):
    de, gb, no = "DE89370400440532013000", "GB82WEST12345698765432", "NO9386011117947"
    mt, zz = "MT84MALT011000012345MTLCAST001S", account("ZZ", "0123456789ABCDE")
    spaced = [" ".join(x[i : i + 4] for i in range(0, len(x), 4)) for x in (de, gb, no, mt, zz)]
    wanted = [  # text with its numbers in braces
        *(f"😀 {{{x}}}{tail}" for x in (de, gb, no, mt, *spaced[:4]) for tail in (" Please", " Bank", " 12 times", " A", " 1", "", ".", " NO WAY 12 AND 34 MORE", "\nX1")),
        f"{{{zz}}} please", f"{{{spaced[4]}}}, A", f"{{{de}}} {{{gb}}} {{{no}}}", f"{{{spaced[0]}}} {{{spaced[1]}}} 77", f"ID12 {{{spaced[0]}}} OK",
        f"x{de} {de}x {de}7 {de[:-1]} DE88370400440532013000 Please"]
    df = spark.createDataFrame(list(enumerate(x.replace("{", "").replace("}", "") for x in wanted)), "doc_id bigint, text string")
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["iban"]] for r in rows(pii.find(df))}
    for i, x in enumerate(wanted):
        marks = [m.start() - k for k, m in enumerate(re.finditer("[{}]", x))]
        assert got[i] == list(zip(marks[::2], marks[1::2])), x


def test_bpe_heap_merge_equals_the_plain_one_and_is_fast(monkeypatch):
    enc = bpe.encoder(registry.tokenizer_path())
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 40, 200):
        for letters in ("ab", "the rain"):
            s = [*rng.choice(list(letters.replace(" ", "")), n)]
            monkeypatch.setattr(bpe, "_LONG", 10**9)
            want = enc._merge([str(x) for x in s])
            assert enc._merge_long([str(x) for x in s]) == want
    monkeypatch.undo()
    library = Tokenizer.from_file(registry.tokenizer_path())
    for text in ("a" * 200_000, "ab" * 50_000 + " c"):
        ids, _ = enc.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_plain_texts_take_the_short_way_with_equal_results():
    enc, ids = bpe.encoder(registry.tokenizer_path()), token_files._Ids(registry.tokenizer_path())
    library = Tokenizer.from_file(registry.tokenizer_path())
    texts = [*ODD, " à É ß\n\nÿ× ", "²½ ª µ", "don't I'LL 12a3 ''ve !!'s", "soft\xadhyphen", "x" * 500 + " q", "“quoted” word, word. (word"]
    for _ in range(2):  # the second time from memory
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(enc.encode(t)[0], "<u4").tolist() for t in texts] == want
        assert [np.frombuffer(x, "<u4").tolist() for x in ids(texts)] == want
    assert all(len(w) <= 64 for m in (enc.pairs, enc.known, enc.words, ids.known, ids.words) for w in m)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=255), st.sampled_from("'' sStmdrevl 1²é!\n")), max_size=40), max_size=5))
def test_texts_are_cut_as_by_the_pattern(texts):
    assert chunks.cuts_by_class(registry.tokenizer_path())
    split = chunks.plain_splitter(registry.tokenizer_path())
    raw = [chunks.plain_bytes(t) for t in texts]
    assert [r is not None for r in raw] == [chunks.plain(t.replace("\n", " ")) for t in texts]
    kept = [t for t, r in zip(texts, raw) if r is not None]
    body, begins, before = chunks.cut([r for r in raw if r is not None])
    words = [body[a:b].decode("latin-1") for a, b in zip(begins, begins[1:])]
    assert [words[a:b] for a, b in zip(before, before[1:])] == [split(t) for t in kept]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aeiounthr'' sd 1-éÀ́“”\n\t")), max_size=60))
def test_token_file_ids_are_those_of_the_library(text):
    ids = token_files._encoder(registry.tokenizer_path())
    texts = [text, text + " <|endoftext|>s", None, "plain " + text]
    want = [ids.library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids(texts)] == want


def test_each_different_pre_token_is_looked_up_once():
    ids, asked = token_files._Ids(registry.tokenizer_path()), []

    class Asked(type(ids.words)):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

    ids.words = Asked(ids.words.make, 1000)
    got = ids(["The rain, the rain!"] * 200)
    assert len(asked) == 4 and len(set(got)) == 1
    assert np.frombuffer(got[0], "<u4").tolist() == ids.library.encode("The rain, the rain!", add_special_tokens=False).ids


def test_words_are_filled_as_far_as_ids_fit():
    """A word takes the most ids of the narrowest width that holds them, up to its block's end."""
    rng = np.random.default_rng(4)
    for _ in range(20):
        lengths = rng.integers(0, 300, 4)
        n_ids = int(lengths.sum())
        ids = rng.integers(0, 2**63, n_ids, dtype=np.uint64) >> rng.integers(0, 64, n_ids).astype(np.uint64)
        want, at = [], 0
        for n in lengths:
            for lo in range(0, n, token_files.BLOCK):
                block = ids[at + lo : at + min(n, lo + token_files.BLOCK)].tolist()
                want += [next((s for s in range(14) if all(x >> int(token_files.BITS[s]) == 0 for x in block[i : i + token_files.COUNTS[s]])), 15)
                         for i in range(len(block))]
            at += n
        _, sizes, _ = token_files._layout(lengths)
        assert token_files._selectors(ids, sizes).tolist() == want
