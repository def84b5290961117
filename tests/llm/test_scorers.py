"""The trained scorers: gradients, held-out accuracy, awkward rows."""

from __future__ import annotations

import os
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from messy import frame, rows

from tradeflow.llm import quality, toxicity
from tradeflow.llm.learning import fold, labelled_sample, sigmoid, trained
from tradeflow.llm.queries import op3_quality, op6_toxicity

SF = "/root/testdata/sf0.01"


def numeric(f, array, at, step=1e-2):
    old = array[at]
    array[at] = old + step
    high = f()
    array[at] = old - step
    low = f()
    array[at] = old
    return (high - low) / (2 * step)


def entropy(logit, y, weight):
    p = sigmoid(logit.astype(np.float64))
    return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / len(y)


def test_toxicity_gradients():
    rng = np.random.default_rng(0)
    net = toxicity.Network()
    for k in net.known:
        net.known[k][:] = True
        net.p[k][:] = rng.standard_normal(net.p[k].shape) * 0.5
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    data, offsets = toxicity.W.utf8(pa.array(["some few words " * 9, "other words, fewer of them", ""]))
    piece, y, w = toxicity.Piece(data, offsets), np.array([1.0, 0.0, 1.0, 0.0]), np.array([1.0, 2.0, 0.5, 1.0])
    ids = piece.ids(slice(0, 4))
    assert len(ids) == 4
    got = net.gradients(piece, ids, y, w)

    def loss():
        return entropy(net.read(net.gates(net.inputs(piece.slot, piece.char, piece.char_word)), ids), y, w)

    for name in ("out", "att", "att_v", "in_f", "in_b", "rec_f", "rec_b", "bias_f"):
        at = tuple(rng.integers(0, s) for s in net.p[name].shape)
        assert numeric(loss, net.p[name], at) == pytest.approx(got[name][at], rel=0.03, abs=2e-5), name
    at = (piece.slot[1], 2)
    assert numeric(loss, net.p["word"], at) == pytest.approx(got["word"][at], rel=0.03, abs=2e-5)


def test_quality_gradients():
    rng = np.random.default_rng(0)
    net = quality.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    data, offsets = quality.W.utf8(pa.array(["some few words " * 50, "other words, fewer of them", ""]))
    bags, y, w = quality.Bags(data, offsets), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    got = net.gradients(bags, y, w)
    for name in ("out", "att", "gate", "att_v", "enc", "enc_b"):
        at = tuple(rng.integers(0, s) for s in net.p[name].shape)
        loss = lambda: entropy(net.read(bags)[0], y, w)
        assert numeric(loss, net.p[name], at, 1e-3) == pytest.approx(got[name][at], rel=0.03, abs=2e-5), name


def test_bags_of_some_texts():
    data, offsets = quality.W.utf8(pa.array(["a b " * 50, "", "C d, e!", "x " * 200]))
    whole = quality.Bags(data, offsets)
    net = quality.Network()
    every = net.read(whole)[0]
    assert np.allclose(net.read(whole.take(np.array([3, 1])))[0], every[[3, 1]], atol=1e-5)


def auc(score, y):
    rank = np.argsort(np.argsort(score))
    return (rank[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("query, label, folds, held, least", [(op3_quality, "quality", 5, 0, 0.97), (op6_toxicity, "toxic", 4, 2, 0.6)])
def test_held_out(spark, query, label, folds, held, least):
    found = {r.doc_id: r for r in query(spark, SF).collect()}
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % folds == held) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if found[r.doc_id].held_out]
    assert auc(np.array([found[r.doc_id].score for r in labels]), np.array([r[label] for r in labels])) >= least


def test_awkward_rows(spark):
    docs = frame(spark).withColumnRenamed("score", "toxicity").withColumnRenamed("value", "quality_score")
    labels = spark.createDataFrame([(k, k % 2, None if k % 5 else k % 2) for k in range(40)] + [(1, 0, 1), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for module, column in ((toxicity, "toxicity"), (quality, "quality_score")):
        scored = module.score(docs, module.fit(docs, labels)).collect()
        assert len(scored) == len(rows()) and all(0 <= r[column] <= 1 for r in scored)
        by = {r.doc_id: r[column] for r in scored}
        assert by[300] == by[301]
        assert module.score(docs.limit(0), toxicity.Network() if module is toxicity else quality.Network()).collect() == []
        flat = module.score(docs, module.fit(docs, labels.limit(0))).collect()
        assert {r[column] for r in flat} == {0.5}


def test_sample_is_bounded_and_ignores_other_folds(spark):
    docs = spark.createDataFrame([(k, f"text {k}" * (1 if k else 20_000)) for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 4 == 0) for k in range(200)], "doc_id long, toxic boolean")
    texts, y, weight = labelled_sample(docs, labels.filter(fold("doc_id", 4) != 2), "toxic", rows=20)
    assert (y == 1).sum() <= 20 and (y == 0).sum() == 20 and weight[y == 0][0] > weight[y == 1][0]
    for t in texts.to_pylist():
        assert zlib.crc32(t.split()[1].encode()) % 4 != 2 and len(t) < 100


def test_training_reads_its_texts_in_blocks(monkeypatch):
    """Blocks of any size give the same network."""
    rng = np.random.default_rng(4)
    texts = pa.array([" ".join(f"w{k}" for k in rng.integers(0, 80, n)) + (" vile" if n % 2 else "") for n in rng.integers(0, 60, 80)])
    y = np.array([float(t.endswith("vile")) for t in texts.to_pylist()])
    nets = []
    for size in (1 << 20, 100, 1):
        monkeypatch.setattr(toxicity.W, "PIECE_BYTES", size)
        nets.append(toxicity.train(texts, y, np.ones(len(y)), epochs=1))
    for other in nets[1:]:
        assert all(np.array_equal(nets[0].p[k], other.p[k]) for k in other.p)
        assert (nets[0].scale, nets[0].shift) == (other.scale, other.shift)


def test_training_runs_in_a_task(spark):
    """The driver gets the model, not the texts."""
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")

    def train(texts, y, weight):
        return SimpleNamespace(process=os.getpid(), texts=sorted(texts.to_pylist()), share=float((y * weight).sum() / max(1, weight.sum())))

    made = trained(docs, labels, "toxic", train, SimpleNamespace)
    assert made.process != os.getpid()
    assert made.texts == sorted(f"text {k}" for k in range(40)) and made.share == 0.5
    assert trained(docs, labels.limit(0), "toxic", train, SimpleNamespace).texts == []
