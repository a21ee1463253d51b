"""Operators over pairs: n-gram join, line de-duplication, nearest neighbours, components; WARC; the pipeline."""

import base64
import collections
import hashlib
import html
import re
import time

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from seisma.llm import ann, line_dedup, linkage, ngram_join, warc
from seisma.llm.tables import size_in_bytes


def rows(df):
    return [r.asDict() for r in df.collect()]


class Union:
    def __init__(self, ids):
        self.p = {i: i for i in ids}

    def root(self, x):
        while self.p[x] != x:
            x = self.p[x]
        return x

    def join(self, x, y):
        x, y = self.root(x), self.root(y)
        self.p[max(x, y)] = min(x, y)


def brute_join(texts, n, percent):
    low = {i: re.sub("[A-Z]+", lambda m: m.group().lower(), t or "") for i, t in texts.items()}
    words = {i: re.findall("[^\x20\x09-\x0D]+", t) for i, t in low.items()}
    sets = {i: {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set() for i, w in words.items()}
    u = Union(texts)
    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    u.join(a, b)
    return {i: (len(sets[i]), u.root(i)) for i in texts}


def made_texts(seed=3, groups=12):
    """Families of near copies around the bound, exact copies, shared passages, short and odd texts."""
    rng = np.random.default_rng(seed)
    vocab = [f"v{i}" for i in range(400)]
    passage = list(rng.choice(vocab, 60))
    texts = []
    for g in range(groups):
        base = list(rng.choice(vocab, rng.integers(20, 200)))
        for _ in range(rng.integers(1, 9)):
            w = list(base)
            for _ in range(rng.integers(0, 4)):
                w[rng.integers(len(w))] = str(rng.choice(vocab))
            texts.append(" ".join(w) + (" " + " ".join(passage) if g % 3 == 0 else ""))
        texts += ["\t".join(base).upper()] * 2
    texts += [None, "", "  \n ", "a", "A", "a b", "b a", "a b c", "x " * 500, "x " * 3, " ".join(rng.choice(vocab, 6000))]
    return dict(enumerate(texts))


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_ngram_join_against_brute_force(spark, n, percent):
    texts = made_texts()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in texts.items()], "doc_id bigint, text string, n int, key string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(ngram_join.join(df, n, percent))}
    want = brute_join(texts, n, percent)
    assert got == want
    kept = ngram_join.keep_one(df, n, percent)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if c == i)


def test_ngram_join_in_many_chunks_and_parts(spark, monkeypatch):
    texts = made_texts(seed=8)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    want = {r["doc_id"]: r["component_id"] for r in rows(ngram_join.join(df))}
    monkeypatch.setattr(ngram_join, "CHUNK_KEYS", 8)
    monkeypatch.setattr(ngram_join, "PART_KEYS", 8)
    monkeypatch.setattr("seisma.llm.tables.BROADCAST_BYTES", 0)
    assert {r["doc_id"]: r["component_id"] for r in rows(ngram_join.join(df))} == want
    assert want == {d: c for d, (_, c) in brute_join(texts, 3, 90).items()}


def test_size_classes_of_allowed_sizes_are_neighbours():
    for percent in (50, 80, 90, 99, 100):
        for n in range(1, 3000):
            least = -(-percent * n // 100)
            a, b = ngram_join._classes(np.array([least, n]), percent)
            assert b - a in (0, 1)


def test_bytes_of_a_table(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], "abc"), (None, None, None)], "id bigint, numbers array<bigint>, name string")
    assert size_in_bytes(df) == 2 * (16 + 3 * 8) + 24 + 3
    assert size_in_bytes(df.limit(0)) == 0
    assert size_in_bytes(df.select(F.struct("id", "name").alias("s"), F.array("name").alias("a"))) > 0


def test_ngram_join_odd_rows(spark):
    schema = "doc_id bigint, text string"
    assert ngram_join.join(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (7, "A b C d"), (9, None)], schema)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(ngram_join.join(df))), key=repr)
    assert got == sorted([(5, 2, 5), (5, 2, 5), (None, 2, None), (7, 2, 5), (9, 0, 9)], key=repr)


def test_cells_give_the_same_links_whatever_their_size(spark):
    rng = np.random.default_rng(4)
    core = rng.integers(1, 1 << 62, 60).astype(np.uint64)
    sets = [np.unique(np.r_[core[rng.random(60) < 0.95], rng.integers(1, 1 << 62, 3).astype(np.uint64)]) for _ in range(80)]
    table = spark.createDataFrame([(i, bytearray(s.astype("<u8").tobytes())) for i, s in enumerate(sets)], "id bigint, elements binary")
    groups = spark.createDataFrame([(0, i) for i in range(80)] + [(1, 5), (1, 6), (2, 7)], "pivot bigint, id bigint")
    u = Union(range(80))
    for a in range(80):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                u.join(a, b)
    for block in (256, 16, 3):
        edges = linkage.links(groups, table, 85, block)
        found = {r.id: r.component for r in linkage.components(edges).collect()}
        assert {i: found.get(i, i) for i in range(80)} == {i: u.root(i) for i in range(80)}
    assert edges.count() < 80 * 27


def test_components(spark):
    rng = np.random.default_rng(6)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(200, x) for x in range(201, 290)] + [tuple(int(v) for v in rng.integers(300, 400, 2)) for _ in range(70)] + [(7, 7)]
    u = Union({x for p in pairs for x in p})
    for a, b in pairs:
        u.join(a, b)
    got = {r.id: r.component for r in linkage.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    ends = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: u.root(x) for x in ends}
    assert linkage.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_lines(texts):
    occ = [(i, k, f) for i in sorted(texts) for k, x in enumerate((texts[i] or "").split("\n")) if (f := line_dedup.fold(x)) is not None]
    distinct = list(dict.fromkeys(f for _, _, f in occ))
    sets = [{p[i : i + 8] for i in range(len(p) - 7)} for p in (f.ljust(8) for f in distinct)]
    u = Union(range(len(distinct)))
    for a in range(len(distinct)):
        for b in range(a):
            if 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    u.join(b, a)
    number = {f: u.root(k) for k, f in enumerate(distinct)}
    seen, gone = set(), collections.defaultdict(list)
    for i, k, f in occ:
        if number[f] in seen:
            gone[i].append(k)
        seen.add(number[f])
    return gone


def test_line_dedup_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    line = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    extra = [None, "", "\n\n", line + "\nshort line\nshort line", f"  {line.upper()}  \nshort line", line.replace("nine", "nime") + "\n" + "é" * 50 + " b c d e",
             line + "\n" + line, "tail " * 30000, "a b c d e", "A  b\tc d e"]
    docs |= {1000 + k: t for k, t in enumerate(extra)}
    df = spark.createDataFrame([(i, t, "k", 3) for i, t in docs.items()], "doc_id bigint, text string, dropped_lines string, line int")
    want = brute_lines(docs)
    got = rows(line_dedup.dedup(df))
    assert len(got) == len(docs)
    for r in got:
        i = r["doc_id"]
        assert (r["dropped_lines"] or []) == want.get(i, []), i
        lines = None if docs[i] is None else "\n".join(x for k, x in enumerate(docs[i].split("\n")) if k not in want.get(i, []))
        assert r["text"] == lines
    assert 1006 in want and want[1006] == [0, 1] and want[1009] == [0]


def test_line_dedup_keeps_a_column_named_like_its_own(spark):
    df = spark.createDataFrame([(1, "one two three four five", "x"), (2, "one two three four five", "y")], "doc_id bigint, text string, __gone string")
    got = {r["doc_id"]: (r["text"], r["__gone"], r["dropped_lines"]) for r in rows(line_dedup.dedup(df))}
    assert got == {1: ("one two three four five", "x", None), 2: ("", "y", [0])}


def test_line_dedup_odd_rows(spark):
    schema = "doc_id bigint, text string"
    assert line_dedup.dedup(spark.createDataFrame([], schema)).count() == 0
    line = "some words that make a line of text"
    df = spark.createDataFrame([(2, line), (2, line), (None, line), (3, line + "\nkept")], schema)
    got = sorted(((r["doc_id"], r["text"]) for r in rows(line_dedup.dedup(df))), key=repr)
    assert got == sorted([(2, ""), (2, ""), (None, line), (3, "kept")], key=repr)


def own_fold(line):
    return re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), " ".join(line.split())) or None


def test_line_dedup_takes_short_lines(spark, monkeypatch):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    long_word = "".join(chr(0x4E00 + i * 37 % 900) for i in range(60))
    extra = ["les.", "Les. \n\n  \nnew one", "a\nb\nA\n \na b", "aaaaaaaa\naaaaaaaaa", long_word, long_word[:-1] + "x\n" + long_word[::-1],
             "one two three, four\nOne  two\tthree, four\nquite other words", "\u00a0\n\u3000\nles."]
    docs |= {1000 + k: t for k, t in enumerate(extra)}
    with monkeypatch.context() as m:
        m.setattr(line_dedup, "fold", own_fold)
        want = brute_lines(docs)
    got = rows(line_dedup.dedup(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")))
    assert len(got) == len(docs) and {r["doc_id"]: r["dropped_lines"] for r in got if r["dropped_lines"]} == want
    assert 0 in want[1001] and want[1002] == [2] and want[1003] == [1] and want[1005] == [0] and want[1006] == [1] and want[1007] == [2]


def test_band_recall():
    rng = np.random.default_rng(9)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz     "))
    pairs = []
    while len(pairs) < 300:
        a = rng.choice(letters, 200)
        b = a.copy()
        for k in rng.integers(0, 200, 2):
            b[k] = rng.choice(letters)
        x, y = " ".join("".join(a).split()), " ".join("".join(b).split())
        sx, sy = set(line_dedup.shingle_set(x)), set(line_dedup.shingle_set(y))
        if len(sx & sy) >= 0.8 * len(sx | sy):
            pairs.append((x, y))
    met = [(line_dedup.band_hashes([x, y])[0] == line_dedup.band_hashes([x, y])[1]).any() for x, y in pairs]
    assert np.mean(met) > 0.98


# nearest neighbours


def test_forest_recall_and_exact_scores(spark):
    rng = np.random.default_rng(11)
    v = rng.standard_normal((3000, 24))
    v[100:140] = v[100]
    data = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    data += [(5001, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (5060, [1.0] * 3), (None, [1.0] * 24), (5080, []), (5100, [None] * 24)]
    df = spark.createDataFrame([(*d, 1) for d in data], "vec_id bigint, embedding array<double>, rank int")
    got = collections.defaultdict(list)
    for r in rows(ann.search(df, lambda i: F.pmod(i, F.lit(20)) == 0, 10)):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hit = 0
    for q in range(0, 3000, 20):
        s = v @ v[q]
        best = [i for i in np.lexsort((np.arange(3000), -s.round(12))) if i != q][:10]
        ranks = sorted(got[q])
        assert [r for r, _, _ in ranks] == list(range(1, 11)) and all(abs(x - s[i]) < 1e-9 for _, i, x in ranks)
        hit += len({i for _, i, _ in ranks} & set(best))
        if q in (100, 120):  # the copies come in order of their ids
            assert [i for _, i, _ in ranks] == [i for i in range(100, 111) if i != q][:10]
    assert hit / (150 * 10) >= 0.9 and set(got) == set(range(0, 3000, 20))
    assert not ann.search(df.limit(0), lambda i: i >= 0, 5).collect()
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5])], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in ann.search(few, lambda i: i == 1, 5).collect()] == [(1, 1, 2, 0.5)]


def test_every_point_is_in_a_leaf_of_each_tree():
    points = np.random.default_rng(1).standard_normal((777, 8))
    f = ann.Forest(points, trees=3, leaf=20)
    per_tree = len(f.leaves) // 3
    for t in range(3):
        assert sorted(np.concatenate(f.leaves[t * per_tree : (t + 1) * per_tree]).tolist()) == list(range(777))
    assert all(len(c) >= 300 for c in f.candidates(points[:5], 0.4, 1))


# WARC


def sha1(b):
    return "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a.example/x", "<html><head><title>T &amp; t</title><style>p{}</style></head><body><p>One<br>two &lt;3</p><script>x</script><!-- c --><a href='/l?a=1&amp;b'>link</a><a href=/m>m</a></body></html>"),
             (2, None, ""), (3, "http://b.example/", None), (3, "http://b.example/", None)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id int, url string, html string, record string")
    got = rows(warc.derive(warc.responses(df)))
    assert len(got) == 8 and {r["record_type"] for r in got} == {"conversion", "metadata"}
    first = {r["record_type"]: r for r in got if r["page_id"] == 1}
    assert first["conversion"]["block"] == "One\ntwo <3\nlink m" or first["conversion"]["block"] == "One\ntwo <3\nlinkm"
    meta = first["metadata"]["block"].split("\r\n")
    assert "title: T & t" in meta and "outlink: /l?a=1&b" in meta and "outlink: /m" in meta and "http-status: 200" in meta
    assert f"source-payload-digest: {sha1(pages[0][2].encode())}" in meta
    heads, block = warc.parse(first["conversion"]["record"].encode())
    assert heads["warc-refers-to"] == first["conversion"]["refers_to"] == first["metadata"]["refers_to"]
    assert heads["warc-concurrent-to"] == first["metadata"]["record_id"] and heads["warc-block-digest"] == sha1(block)
    assert heads["warc-refers-to-target-uri"] == "http://a.example/x"
    folder = str(tmp_path / "w")
    warc.write(warc.derive(warc.responses(df)), folder)
    whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    back = []
    while whole:
        head, _, rest = whole.partition(b"\r\n\r\n")
        n = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and rest[n : n + 4] == b"\r\n\r\n"
        back.append(rest[:n].decode())
        whole = rest[n + 4 :]
    assert sorted(back) == sorted(r["block"] for r in got)


def test_warc_other_records(spark):
    def response(http, status="200 OK", kind="response"):
        return warc.record([("WARC-Type", kind), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Payload-Digest", "sha1:WRONG")], f"HTTP/1.1 {status}\r\n".encode() + http)

    import gzip

    raws = [response(b"Content-Type: image/png\r\n\r\n\x89PNG"), response(b"Content-Type: text/html\r\n\r\nx", "404 Not Found"), response(b"", kind="request"),
            response(b"Content-Type: text/plain; charset=latin-1\r\n\r\n\xe9"), response(b"Content-Type: text/html\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n" + (
                lambda z: f"{len(z):x}\r\n".encode() + z + b"\r\n0\r\n\r\n")(gzip.compress(b"<p>zip"))), None, b"junk"]
    df = spark.createDataFrame([(k, None if r is None else bytearray(r)) for k, r in enumerate(raws)], "page_id int, record binary")
    got = collections.defaultdict(dict)
    for r in rows(warc.derive(df)):
        got[r["page_id"]][r["record_type"]] = r["block"]
    assert set(got) == {0, 1, 3, 4} and "conversion" not in got[0] and "conversion" not in got[1]
    assert got[3]["conversion"] == "é" and got[4]["conversion"] == "zip" and "digest-mismatch: sha1:" in got[3]["metadata"]
    assert not warc.derive(df.limit(0)).collect()


def test_warc_body_of_several_members():
    import gzip
    import zlib

    a, b = gzip.compress(b"<p>one "), gzip.compress(b"two")
    heads = {"content-encoding": "gzip"}
    assert warc._body(heads, a + b) == b"<p>one two" and warc._body(heads, a + b + bytes(9)) == b"<p>one two"
    assert warc._body(heads, b"plain") == b"plain" and warc._body(heads, b"") == b"" and warc._body(heads, a) == b"<p>one "
    assert warc._body({"content-encoding": "deflate"}, zlib.compress(b"x") + b"junk") == b"x"


def html_response(body, heads=b"Content-Type: text/html; charset=utf-8"):
    return warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], b"HTTP/1.1 200 OK\r\n" + heads + b"\r\n\r\n" + body)


def brute_page(markup):
    """Title and links by patterns that try every opening anew."""
    title = re.search(r"(?is)<title\b[^>]*>(.*?)</title\s*>", markup)
    plain = title and " ".join(html.unescape(re.sub(r"(?s)<[a-zA-Z/!?][^>]*>", " ", title[1])).split())
    anchors = re.findall(r"""(?is)<a\b[^>]*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", markup)
    links = [" ".join(html.unescape("".join(m)).split()) for m in anchors]
    return plain, [x for x in dict.fromkeys(links) if x]


PARTS = ["<a", "<a ", "<title", ">", "</title>", " href=", '"', "'", "x", "<", "</p", "<p ", " ", "\n", "<!--", "-->", "<script>", "</script>", "&amp;", "="]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join))
def test_warc_titles_and_links_against_brute_force(markup):
    assert (warc._title(markup), warc._links(markup)) == brute_page(markup)


@pytest.mark.parametrize("part", ["<title>", "<title ", "<a ", "<a href=", '<a href="', "<a x>", "<!--", "<head>", "</title ", "<p ", "<", "&#", "&#1", "<a href='\" ", "<a \thref"])
def test_warc_long_pages_that_close_nothing(part):
    for end in ("", ">"):
        started = time.process_time()
        made = warc.derivatives(html_response((part * ((1 << 20) // len(part)) + end).encode()))
        assert [r["record_type"] for r in made] == ["conversion", "metadata"] and time.process_time() - started < 10


def test_warc_odd_heads_numbers_and_bodies():
    import gzip

    text = warc.derivatives(html_response(b"&#" + b"1" * 9000 + b"; &#" + b"0" * 9000 + b"65;<title>&#99999999999;</title>"))
    assert text[0]["block"].split() == ["\ufffd", "A", "\ufffd"] and "title: \ufffd\r\n" in text[1]["block"]
    bare = b"WARC/1.1\nWARC-Type: response\nWARC-Record-ID: <u>\nContent-Length: " + b"9" * 5000 + b"\n\nHTTP/1.1 200 OK\nContent-Type: text/plain; charset=undefined\n\na\n\nb"
    assert warc.derivatives(bare)[0]["block"] == "a\n\nb"
    wide = html_response(b"\\ud800x", b"Content-Type: text/plain; charset=raw_unicode_escape")
    assert warc.derivatives(wide)[0]["block"] == "?x"
    members = b"".join(gzip.compress(b"p%d " % i) for i in range(20_000))
    chunks = b"".join(b"1;x=y\r\nz\r\n" for _ in range(100_000)) + b"0\r\n\r\n"
    started = time.process_time()
    zipped = warc.derivatives(html_response(members, b"Content-Type: text/plain\r\nContent-Encoding: gzip"))
    dealt = warc.derivatives(html_response(chunks, b"Content-Type: text/plain\r\nTransfer-Encoding: chunked"))
    assert zipped[0]["block"] == "".join(f"p{i} " for i in range(20_000)) and dealt[0]["block"] == "z" * 100_000
    assert time.process_time() - started < 10


# the pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontamination", "bpe"]
    rich = docs.withColumn("__key", F.lit(1)).withColumn("component_id", F.lit("x"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, rich, SF_SMALL)
        assert out.schema.names == rich.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in rich.schema], name
        assert 0 < out.count() <= docs.count()
        assert stage(spark, rich.limit(0), SF_SMALL).count() == 0
    done = corpus_pipeline.run(spark, SF_SMALL)
    assert done.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < done.count() < docs.count()


def test_pipeline_catches_planted_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").first().text
    clean = " ".join(f"plain{i} text{i * 7 % 31}" for i in range(80))
    planted = spark.createDataFrame([
        (900001, clean, "en", "s", len(clean)), (900002, clean + " end", "en", "s", 0), (900003, "before " + bench + " after", "en", "s", 0),
        (900004, "quite another text that stands alone here", "en", "s", 0)], docs.schema)
    both = docs.unionByName(planted)
    stages = dict(corpus_pipeline.STAGES)
    near = {r.doc_id for r in stages["ngram_join"](spark, both, SF_SMALL).select("doc_id").collect()}
    assert 900001 in near and 900002 not in near and 900004 in near
    leaks = {r.doc_id for r in stages["decontamination"](spark, both, SF_SMALL).select("doc_id").collect()}
    assert 900003 not in leaks and {900001, 900002, 900004} <= leaks
    lines = {r.doc_id: r.text for r in stages["line_dedup"](spark, both, SF_SMALL).collect()}
    assert lines[900001] == clean and 900002 not in lines and lines[900004] == planted.collect()[3].text


def test_pipeline_drops_whole_copies(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    long = ["\n".join(" ".join(f"plain{j} text{(i * 5 + j) * 7 % 31}" for j in range(i * 20, i * 20 + 20)) for i in (2 * k, 2 * k + 1)) for k in range(3)]
    text = f"Haanth.\n{long[0]}\n\nTwo words\n\u00a0\n{long[1]}\nthree short words\n \n{long[2]}\n\u65e5\u672c\u8a9e\u306e\u6587\n\u3000\n\x1f\nEnd"
    planted = [text, text, text.upper(), text.replace(" ", "  ") + "\n", "another text that stands alone\nwith a short line"]
    folder = str(tmp_path / "sf")
    docs.unionByName(spark.createDataFrame([(900001 + k, t, "en", "s", len(t)) for k, t in enumerate(planted)], docs.schema)).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    done = {r.doc_id for r in corpus_pipeline.run(spark, folder).select("doc_id").collect()}
    assert {i for i in done if i > 900000} == {900001, 900005}
