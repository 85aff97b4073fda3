import zlib

import numpy as np

from conftest_llm import SF, with_clashes
from pulse.llm import quality_mil as Q
from pulse.llm.queries import QUERIES

GOOD = "This sentence has words, and it reads well. Another one follows here.\n"
BAD = "###$$$ %%% BUY!! NOW!! ### $$$ click%%% here*** NOW!! BUY!!\n"
DDL = "doc_id long, quality int, toxic int"


def docs_and_labels(n=120):
    docs, labels = [], []
    for i in range(n):
        docs.append((i, (GOOD if i % 2 else BAD) * (1 + i % 7)))
        labels.append((i, i % 2, 0))
    return docs, labels


def test_encoding_counts():
    texts = ["aB 1.", "", " \n", "word " * 200, "a b a b"]
    x, sizes = Q.encode(texts)
    assert sizes.tolist() == [1, 1, 1, 4, 1] and x.shape == (8, Q.FEATURES)
    assert np.allclose(x[0, :5], [1 / 5, 1 / 5, 1 / 5, 1 / 5, 0]) and np.allclose(x[0, 5], 1 / 5)  # space a B 1 . of five
    assert not x[1].any() and not x[2].any()
    e = Q.CLASSES * (Q.CLASSES + 1)
    assert x[3, e + 3] == 1 and x[0, e + 3] == 0 and x[7, e + 3] == 1  # repeated words
    assert np.isclose(x[0, e], 2 / 10)  # mean word length
    one, _ = Q.encode([texts[3]])
    assert np.allclose(one, x[3:7])  # a text's vectors don't depend on its neighbours


def test_gradients():
    rng = np.random.Generator(np.random.PCG64(1))
    x, sizes = rng.standard_normal((60, 5)).astype(np.float32), np.array([1, 3, 6] * 6)
    y = np.array([0.0, 1.0, 1.0] * 6)
    model = Q.fit(x, sizes, y, 0.5)
    o = Q._forward(model.w, ((x - model.mean) / model.scale).clip(-8, 8), sizes)
    assert np.allclose(np.add.reduceat(o["a"], np.cumsum(sizes) - sizes), 1, atol=1e-5)
    assert ((model.score(x, sizes) > 0.5) == y).mean() > 0.9  # it can fit


def test_scores(frame):
    docs, labels = docs_and_labels()
    got = Q.classify(with_clashes(frame(docs)), with_clashes(frame(labels, DDL))).collect()
    assert len(got) == len(docs)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == r["doc_id"] % 2


def test_held_out_labels_and_ids_are_no_inputs(frame):
    docs, labels = docs_and_labels()
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 1) for i, q, _ in labels]
    a = {r["doc_id"]: r["score"] for r in Q.classify(frame(docs), frame(labels, DDL)).collect()}
    b = {r["doc_id"]: r["score"] for r in Q.classify(frame([(i, x, "xx", "src") for i, x in docs]), frame(flipped, DDL)).collect()}
    assert a == b


def test_odd_rows(frame):
    docs, labels = docs_and_labels(60)
    odd = [(None, GOOD), (None, None), (900, None), (901, ""), (902, "x" * 200000), (903, "w " * 30000), (1, docs[1][1])]
    got = Q.classify(frame(docs + odd), frame([*labels, (None, 1), (3, None), (5, 7), (1, 0), (1, 1)], DDL)).collect()
    assert len(got) == len(docs) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    assert Q.classify(frame([]), frame(labels, DDL)).collect() == []
    assert {r["score"] for r in Q.classify(frame(docs), frame([], DDL)).collect()} == {0.5}
    ones = Q.classify(frame(docs), frame([(i, 1, 0) for i in range(60)], DDL)).collect()
    assert len({r["score"] for r in ones}) == 1 and ones[0]["score"] > 0.9


def test_query_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op4_attention_mil_quality"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) >= 0.85


def plain_score(model, text):
    """Passage by passage: hidden layer, gated attention, weighted mean, logistic unit."""
    x, _ = Q.encode([text or ""])
    w = {k: v.astype(np.float64) for k, v in model.w.items()}
    hidden, weights = [], []
    for row in x:
        z = np.clip((row - model.mean) / model.scale, -8, 8)
        h = np.tanh(z @ w["wh"] + w["bh"])
        hidden.append(h)
        weights.append(np.tanh(h @ w["v"] + w["bv"]) / (1 + np.exp(-(h @ w["u"] + w["bu"]))) @ w["a"])
    e = np.exp(np.array(weights) - max(weights))
    mean = sum(h * k for h, k in zip(hidden, e / e.sum()))
    return 1 / (1 + np.exp(-(mean @ w["c"] + w["b"][0] + model.shift)))


def test_scores_as_passage_by_passage(frame):
    docs, labels = docs_and_labels()
    docs = docs + [(500, "w " * 5000), (501, None), (502, GOOD * 40)]
    model = Q.train(frame(docs), frame(labels, DDL))
    got = {r["doc_id"]: r["score"] for r in Q.score(frame(docs), model).collect()}
    for i, text in docs:
        assert abs(got[i] - plain_score(model, text)) < 1e-3


def test_same_model_in_any_order(frame):
    """Repeated ids with other texts, rows in another order and partitioning: the same model."""
    docs, labels = docs_and_labels()
    docs = docs + [(i, docs[i + 1][1]) for i in range(0, 20)]
    a = Q.train(frame(docs).repartition(1), frame(labels, DDL))
    b = Q.train(frame(docs[::-1]).repartition(5), frame(labels[::-1], DDL))
    assert all((a.w[k] == b.w[k]).all() for k in a.w) and a.shift == b.shift


def test_documents_are_learned_whole(frame, monkeypatch):
    """All passages of a document are learned from, or none if they don't fit."""
    docs, labels = docs_and_labels(60)
    docs[1] = (1, docs[1][1] + " " + GOOD * 200)
    sizes = {}
    fit = Q.fit
    monkeypatch.setattr(Q, "fit", lambda x, n, y, p: sizes.update(n=sorted(n.tolist())) or fit(x, n, y, p))
    Q.train(frame(docs), frame(labels, DDL))
    assert sizes["n"][-1] == Q.encode([docs[1][1]])[1][0] > 16
    monkeypatch.setattr(Q, "TRAIN_PASSAGES", sizes["n"][-1] - 1)
    Q.train(frame(docs), frame(labels, DDL))
    assert sizes["n"][-1] < 16
