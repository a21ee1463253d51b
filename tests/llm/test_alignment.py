"""Cross-tokenizer alignment against a walk over every byte."""

import hashlib
from collections import Counter

import public_tokenizers as P
import sentencepiece
from conftest import SF_SMALL
from tokenizers import Tokenizer

from seisma.llm import alignment, registry

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  a  b \n c\n\n d ", "a", "ab▁c", "<|endoftext|> x <s></s> <0x41>", "日本語のテキスト 中文", "\U0001f600‍ ok", "\x00 b", "a  b　 c\x1c d\x85 e",
       "x" * 30_000, "word, and more. " * 5_000, "é́ ﬁ ſ Å", "tab\t here\r\n\r\n there's", "1234567 8.9-10", " lead", "trail ", "\n", "the cat the cat the cat"]


def brute(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(x): x for x in printable}
    for x in range(256):
        if x not in printable:
            of[chr(256 + len(of) - len(printable))] = x
    per_doc, count = [], Counter()
    for doc_id, text in rows:
        raw = (" " + (text or "")).encode()
        ia = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ib = b.encode(text) if text else []
        ta = [bytes(of[c] for c in a.id_to_token(i)) for i in ia]
        tb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if b"".join(ta) != raw or b"".join(tb) != raw:
            per_doc.append((doc_id, [], [], "", Counter()))
            continue
        at_a = [k for k, t in enumerate(ta) for _ in t]
        at_b = [k for k, t in enumerate(tb) for _ in t]
        links = Counter((ia[x], ib[y]) for x, y in set(zip(at_a, at_b)))
        groups, ga, gb = [], [], []
        for k in range(len(raw)):
            last = k + 1 == len(raw)
            end_a, end_b = last or at_a[k + 1] != at_a[k], last or at_b[k + 1] != at_b[k]
            if end_a:
                ga.append(str(ia[at_a[k]]))
            if end_b:
                gb.append(str(ib[at_b[k]]))
            if end_a and end_b:
                groups.append(",".join(ga) + "|" + ",".join(gb))
                ga, gb = [], []
        count.update(links.keys())
        per_doc.append((doc_id, ia, ib, groups, links))
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    return sorted(((d, len(ia), len(ib), len(g), sum(ln.values()), sum(t for p, t in ln.items() if count[p] == top[p[0]]), sum(t * count[p] for p, t in ln.items()),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, ia, ib, g, ln in per_doc), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert result(registry.op13_alignment(spark, SF_SMALL)) == brute(rows)


def test_odd_texts_and_small_batches(spark):
    rows = [*enumerate(ODD), (4, "a"), (None, "null id")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, batch int, pair int").repartition(3)
    want = brute(rows)
    assert result(alignment.align(docs, A, B)) == want
    assert result(alignment.align(docs, A, B, slice_bytes=1, batch_bytes=20)) == want
    assert {r[0] for r in want if r[1] == 0} == {0, 1, 5}


def test_whole_texts_where_chunks_do_not_hold():
    p = alignment.Pair(A, B)
    assert p.cuts
    chunked = p.encode(ODD)
    p.cuts = False
    assert p.encode(ODD) == chunked


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "CHUNKS", 50)
    p = alignment.Pair(A, B)
    for k in range(20):
        p.encode([" ".join(f"w{k}x{i}" for i in range(40)), "y" * 500])
    assert len(p.new) <= 50 + 41 and len(p.old) <= 50 + 41
    assert all(len(c) <= alignment.CHUNK_CHARS for c in p.new)


def test_empty_table(spark):
    assert result(alignment.align(spark.createDataFrame([], "doc_id bigint, text string"), A, B)) == []
