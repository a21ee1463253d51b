"""Merkle manifest: van Emde Boas addresses, proofs and roots against a plain tree."""

import hashlib
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL

from seisma.llm import merkle, registry

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, pos bigint, total string, leaf int"


def sha(data):
    return hashlib.sha256(data).hexdigest().encode()


def field(value):
    if value is None:
        return b"-"
    raw = str(value).encode()
    return str(len(raw)).encode() + b":" + raw


def plain_tree(nodes):
    """Root and, for each node, its (index, siblings) level by level."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(own):
            run = nodes[k - k % 16 : k - k % 16 + 16]
            paths[i].append((k % 16, run[: k % 16] + run[k % 16 + 1 :]))
            own[i] = k // 16
        nodes = [sha(b"".join(nodes[a : a + 16])) for a in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) -> what op12 gives."""

    def leaf(r, text):
        return sha(b"".join(map(field, (*r[:4], text))))

    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    keys = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    trees = []
    for k in keys:
        by[k].sort(key=lambda x: x[:3])
        trees.append(plain_tree([x[2] for x in by[k]]))
    if not trees:
        return []
    root, tops = plain_tree([t[0] for t in trees])
    out = []
    for k, (subroot, paths), top in zip(keys, trees, tops):
        for (_, _, own, r), path in zip(by[k], paths):
            path, now = path + top, own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                now = leaf(r, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]))
            for i, siblings in path:
                now = sha(b"".join([*siblings[:i], now, *siblings[i:]]))
            proof = sha(b"".join(s for _, x in path for s in x))
            out.append((r[0], own.decode(), subroot.decode(), root.decode(), proof.decode(), now.decode(), now == root))
    return sorted(out, key=str)


def op12(spark, tmp_path, rows):
    spark.createDataFrame([(*r, 5, "x", 7) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in registry.op12_merkle(spark, str(tmp_path)).collect()), key=str)


def test_addresses_are_a_van_emde_boas_layout():
    for levels in (1, 2, 3, 4):
        every = np.concatenate([merkle.addresses(levels, d) for d in range(levels)])
        assert sorted(every) == list(range(merkle._size(levels)))
    # four levels: the upper two come first, then 256 subtrees of two levels, each with its root first
    assert list(merkle.addresses(4, 1)) == list(range(1, 17))
    assert list(merkle.addresses(4, 2)[:3]) == [17, 34, 51]
    assert list(merkle.addresses(4, 3)[:17]) == [*range(18, 34), 35]


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256])
def test_block_round_trip(n):
    leaves = [sha(str(i).encode()) for i in range(n)]
    levels = merkle.steps(n)
    store, root = merkle.build_block(leaves, levels)
    want, paths = plain_tree(leaves)
    assert root == want
    rows = merkle.read_block(store.tobytes(), n, levels)
    assert rows[-1] == leaves and rows[0] == [root]
    for leaf, path, plain in zip(leaves, merkle.paths_of(rows, b""), paths):
        assert [(i, b"".join(s)) for i, s in plain] == list(merkle.path_levels(path))
        assert merkle.fold(leaf, path) == root


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = sorted((tuple(r) for r in registry.op12_merkle(spark, SF_SMALL).collect()), key=str)
    assert got == brute(rows)
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_sources_of_many_sizes(spark, tmp_path):
    """One row, a run and one more, a block and one more, three layers, a null source; nulls, ties, odd texts."""
    sizes = {None: 17, "": 1, "a": 256, "é": 257, "hot": 4400, "Z": 16}
    rows = [(i * 7 - 50, s, None if i % 3 else "en", i, f"Text {i} É") for s, n in sizes.items() for i in range(n)]
    rows += [(None, "a", None, None, None), (None, "a", None, None, "B"), (5, "a", "x", 1, "Same"), (5, "a", "x", 1, "Same"), (5, "a", "x", 1, ""), (9, "Z", "", 0, "Long " * 200_000)]
    rows += [(i, f"s{i}", "en", 1, "One") for i in range(300)]
    assert op12(spark, tmp_path, rows) == brute(rows)


def test_single_and_empty(spark, tmp_path):
    (tmp_path / "a").mkdir()
    rows = [(3, "s", "en", 3, "Abc")]
    got = op12(spark, tmp_path / "a", rows)
    assert got == brute(rows) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == sha(b"").decode()
    (tmp_path / "b").mkdir()
    assert op12(spark, tmp_path / "b", []) == []
