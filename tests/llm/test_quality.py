"""Quality classifier: exact context sums, the network's gradients, calibration, held-out accuracy."""

import zlib

import numpy as np
import pytest

from seisma.llm import quality as Q, registry

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, quality int, score double, held_out string"


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_contexts_are_sums_over_neighbours(spark):
    texts = ["The cat, the cat sat.", None, "", "one", "a b c d e f", "É\x00 12 ### x_y", "the the the"]
    docs = spark.createDataFrame([(i, t, 1, 1.0, "") for i, t in enumerate(texts * 3)], SCHEMA).repartition(5)
    index = np.zeros((Q.SLOTS, Q.DIM), dtype=int)
    for slot, places in enumerate(Q.index_places()):
        for p in places:
            index[slot, p % Q.DIM] += 1 if p < Q.DIM else -1
    want = np.zeros((Q.SLOTS, Q.DIM), dtype=int)
    for t in texts * 3:
        s = Q.slots_of(t)
        for i in range(len(s)):
            for j in range(max(0, i - Q.WINDOW), min(len(s), i + Q.WINDOW + 1)):
                if i != j:
                    want[s[i]] += index[s[j]]
    assert (Q.contexts(docs) == want).all()
    assert want.any()


def test_index_vectors_are_sparse_and_distinct_places():
    places = Q.index_places()
    assert places.shape == (Q.SLOTS, Q.PLACES) and all(len(set(p % Q.DIM)) == Q.PLACES for p in places[:500])


def test_pooling_of_long_texts_in_steps(monkeypatch):
    rng = np.random.default_rng(3)
    vectors, slots = rng.normal(size=(Q.SLOTS, Q.DIM)), rng.integers(0, 50, 1000)
    whole = Q.pooled(slots, vectors)
    monkeypatch.setattr(Q, "_NEAR", 7)
    assert np.allclose(Q.pooled(slots, vectors), whole)
    assert np.allclose(whole[: Q.DIM], vectors[slots].mean(axis=0))
    assert np.allclose(whole[Q.DIM : 2 * Q.DIM], vectors[slots].std(axis=0))
    assert np.allclose(whole[3 * Q.DIM : 4 * Q.DIM], (vectors[slots[1:]] * vectors[slots[:-1]]).mean(axis=0))
    assert not Q.pooled(Q.slots_of(None), vectors).any() and not Q.pooled(Q.slots_of(" \n"), vectors).any()


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(40, Q.N_FEATURES)), (rng.random(40) < 0.6).astype(float)
    net = Q.Network(np.zeros(Q.N_FEATURES), np.ones(Q.N_FEATURES), rng.normal(0, 0.1, (Q.N_FEATURES, 5)), rng.normal(size=5), rng.normal(size=5), 0.3)
    got, _ = Q.gradients(net, x, y, 0.01)
    for name, at, grad in (("w1", (3, 2), got[0]), ("b1", (4,), got[1]), ("w2", (1,), got[2])):
        value = getattr(net, name)
        losses = []
        for step in (1e-5, -2e-5):
            value[at] += step
            losses.append(Q.gradients(net, x, y, 0.01)[1])
        value[at] += 1e-5
        assert grad[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-4, abs=1e-9)


def test_temperature_calibrates():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(4000, Q.N_FEATURES))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    aside = rng.random(4000) < 0.3
    net = Q.fit(x, y, aside)
    z = net.logits(x[aside])
    assert Q.log_loss(z / net.temperature, y[aside]) <= Q.log_loss(z, y[aside])
    p = net.probabilities(x[aside])
    assert abs(p.mean() - y[aside].mean()) < 0.05


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = registry.op11_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    test = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, y in test if y == k] for k in (1, 0))
    assert np.mean([s >= 0.3 for s in good]) > 0.95
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_labels_of_held_out_rows_teach_nothing(spark):
    rows = [(i, "good words here now" if i % 2 else "$$$ ### |", i % 2) for i in range(200)]
    docs = spark.createDataFrame([(i, t, None, 0.5, "x") for i, t, _ in rows], SCHEMA)
    scores = []
    for flip in (False, True):
        labels = spark.createDataFrame([(i, 1 - y if flip and held(i) else y) for i, _, y in rows], "doc_id bigint, quality int")
        scores.append(sorted((r.doc_id, r.score) for r in Q.score(docs, Q.train(docs, labels)).collect()))
    assert scores[0] == scores[1]
    assert all((s >= 0.3) == bool(i % 2) for i, s in scores[0])


def test_odd_rows_and_missing_labels(spark):
    texts = [(1, None), (2, ""), (2, ""), (None, "null id"), (3, "word " * 300_000), (4, "plain")]
    docs = spark.createDataFrame([(i, t, 1, 0.0, "x") for i, t in texts], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = Q.score(docs, Q.train(docs, none)).collect()
    assert len(got) == 6 and {r.score for r in got} == {0.5} and [r.held_out for r in got if r.doc_id is None] == [False]
    some = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (77, 0)], "doc_id bigint, quality int")
    assert {r.predicted for r in Q.score(docs, Q.train(docs, some)).collect()} == {1}
    assert Q.score(empty, Q.train(empty, some)).collect() == []
