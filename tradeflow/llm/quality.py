"""Quality: attention-based multiple-instance learning over passages.

A document is a bag of passages of PASSAGE words, labelled as a whole. Every
passage is encoded from its hashed words, word shapes and character classes;
gated attention learned from document labels alone decides how much each
passage weighs; the weighted representation is scored. Everything is numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradeflow.llm import words as W
from tradeflow.llm.common import text_or_empty
from tradeflow.llm.learning import Adam, batches_of, calibrate, sigmoid, sum_by, trained

PASSAGE = 64
WORD_SLOTS, SHAPE_SLOTS, DIM = 1 << 13, 1 << 8, 12
ENCODED, ATTENTION = 24, 12
EPOCHS, RATE, BATCH = 15, 0.01, 128

# Character classes: each ASCII punctuation mark, lower and upper case letters,
# digits, space, line feed, other controls, lead and other bytes beyond ASCII.
_CLASS = np.full(256, 0, np.uint8)
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_MARKS] = np.arange(1, len(_MARKS) + 1)
_OTHERS = [range(97, 123), range(65, 91), range(48, 58), [32], [10], range(0xC0, 256), range(0x80, 0xC0)]
for _k, _bytes in enumerate(_OTHERS):
    _CLASS[list(_bytes)] = len(_MARKS) + 1 + _k
CLASSES = len(_MARKS) + 1 + len(_OTHERS)
_LOWER, _UPPER = len(_MARKS) + 1, len(_MARKS) + 2
STATISTICS = CLASSES + 7


class Bags:
    """Passages of some texts: statistics, word and shape slots. A text without
    words is one passage without words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = W.split_words(data, offsets)
        hashes = W.hash_words(W.lower_ascii(data), words)
        counts = np.diff(words.first)
        passages = np.maximum(1, -(-counts // PASSAGE))
        self.first = np.cumsum(passages) - passages
        self.text = np.repeat(np.arange(len(counts)), passages)
        n = len(self.text)
        nth = np.arange(len(words.starts)) - np.repeat(words.first[:-1], counts)
        self.passage = np.repeat(self.first, counts) + nth // PASSAGE
        self.words = np.bincount(self.passage, minlength=n)
        self.slot = (hashes % np.uint64(WORD_SLOTS)).astype(np.int64)
        kind = _CLASS[data]
        head, tail = kind[words.starts], kind[words.ends - 1]
        length = words.ends - words.starts
        capital = head == _UPPER
        loud = capital & (tail == _UPPER) & (length > 1)
        self.shape = (W.mix(head.astype(np.uint64) * np.uint64(64) + tail + (np.minimum(length, 15).astype(np.uint64) << np.uint64(13)))
                      % np.uint64(SHAPE_SLOTS)).astype(np.int64)
        # Bytes belong to the passage of the last word that began before them.
        of_byte = np.zeros(len(data), np.int64)
        begin = self.first[np.arange(len(counts))]
        marks = np.concatenate([offsets[:-1], words.starts])
        owner = np.concatenate([begin, self.passage])
        order = np.lexsort((owner, marks))
        marks, owner = marks[order], owner[order]
        of_byte[:] = np.repeat(owner, np.diff(marks, append=len(data)))
        by_class = np.bincount(of_byte * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
        size = np.maximum(1, by_class.sum(1))
        per = np.maximum(1, self.words)
        distinct = np.bincount(np.unique(self.passage * WORD_SLOTS + self.slot) // WORD_SLOTS, minlength=n)
        mean = lambda x: np.bincount(self.passage, x, n) / per
        again = np.zeros(len(hashes))
        again[1:] = (hashes[1:] == hashes[:-1]) & (self.passage[1:] == self.passage[:-1])
        self.statistics = np.concatenate([
            np.sqrt(by_class / size[:, None]), np.stack([
                mean(length) / 8, mean(capital), mean(loud), distinct / per, mean(again), np.log1p(self.words) / 4,
                np.log1p(passages[self.text]) / 4], 1)], 1).astype(np.float32)

    def take(self, texts: np.ndarray) -> Bags:
        """The bags of some of the texts."""
        out = object.__new__(Bags)
        new = np.full(len(self.first), -1)
        new[texts] = np.arange(len(texts))
        own = new[self.text] >= 0
        order = np.flatnonzero(own)[np.argsort(new[self.text[own]], kind="stable")]
        to = np.full(len(self.text), -1)
        to[order] = np.arange(len(order))
        out.text, out.statistics, out.words = new[self.text[order]], self.statistics[order], self.words[order]
        out.first = np.searchsorted(out.text, np.arange(len(texts)))
        mine = to[self.passage] >= 0
        out.passage = to[self.passage[mine]]
        by = np.argsort(out.passage, kind="stable")
        out.passage, out.slot, out.shape = out.passage[by], self.slot[mine][by], self.shape[mine][by]
        return out


class Network:
    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)

        def init(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {"word": init(WORD_SLOTS, DIM) * 10, "shape": init(SHAPE_SLOTS, DIM) * 4,
                  "enc": init(STATISTICS + 2 * DIM, ENCODED), "enc_b": np.zeros(ENCODED, np.float32),
                  "att": init(ENCODED, ATTENTION), "gate": init(ENCODED, ATTENTION), "att_v": init(ATTENTION),
                  "out": init(ENCODED), "out_b": np.zeros(1, np.float32)}
        self.mean, self.spread = np.zeros(STATISTICS, np.float32), np.ones(STATISTICS, np.float32)
        self.scale, self.shift = 1.0, 0.0

    def _means(self, table: np.ndarray, slots: np.ndarray, bags: Bags) -> np.ndarray:
        out = np.zeros((len(bags.text), table.shape[1]), np.float32)
        if len(slots):
            cuts = np.flatnonzero(np.diff(bags.passage, prepend=-1))
            out[bags.passage[cuts]] = np.add.reduceat(table[slots], cuts, axis=0)
        return out / np.maximum(1, bags.words)[:, None].astype(np.float32)

    def read(self, bags: Bags):
        """(logit of each text, what the way back needs)."""
        p = self.p
        x = np.concatenate([(bags.statistics - self.mean) / self.spread, self._means(p["word"], bags.slot, bags),
                            self._means(p["shape"], bags.shape, bags)], 1)
        h = np.tanh(x @ p["enc"] + p["enc_b"])
        a, g = np.tanh(h @ p["att"]), sigmoid(h @ p["gate"])
        s = (a * g) @ p["att_v"]
        e = np.exp(s - np.maximum.reduceat(s, bags.first)[bags.text])
        e /= np.add.reduceat(e, bags.first)[bags.text]
        z = np.add.reduceat(e[:, None] * h, bags.first, axis=0)
        return z @ p["out"] + p["out_b"][0], (x, h, a, g, e, z)

    def gradients(self, bags: Bags, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        logit, (x, h, a, g, e, z) = self.read(bags)
        d_logit = ((sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
        out = {"out": z.T @ d_logit, "out_b": d_logit.sum(keepdims=True)}
        d_z = (d_logit[:, None] * p["out"])[bags.text]
        d_e = (d_z * h).sum(1)
        d_s = e * (d_e - np.add.reduceat(e * d_e, bags.first)[bags.text])
        out["att_v"] = (a * g).T @ d_s
        d_a = d_s[:, None] * p["att_v"] * g * (1 - a * a)
        d_g = d_s[:, None] * p["att_v"] * a * g * (1 - g)
        out["att"], out["gate"] = h.T @ d_a, h.T @ d_g
        d_h = (e[:, None] * d_z + d_a @ p["att"].T + d_g @ p["gate"].T) * (1 - h * h)
        out["enc"], out["enc_b"] = x.T @ d_h, d_h.sum(0)
        d_x = d_h @ p["enc"].T
        share = (1 / np.maximum(1, bags.words))[:, None].astype(np.float32)
        d_word, d_shape = d_x[:, STATISTICS:STATISTICS + DIM] * share, d_x[:, STATISTICS + DIM:] * share
        out["word"] = sum_by(bags.slot, d_word[bags.passage], WORD_SLOTS)
        out["shape"] = sum_by(bags.shape, d_shape[bags.passage], SHAPE_SLOTS)
        return out

    def document_scores(self, bags: Bags) -> np.ndarray:
        return sigmoid(self.scale * self.read(bags)[0].astype(np.float64) + self.shift)


def train(texts: pa.Array, y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> Network:
    """A network fitted on labelled texts. Without labels of both classes its
    scores are the share of label 1 (a half without any label)."""
    net = Network(seed)
    if len(np.unique(y)) < 2:
        net.scale, share = 0.0, float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
        net.shift = float(np.log(share / (1 - share)))
        return net
    rng = np.random.default_rng(seed)
    data, offsets = W.utf8(texts)
    bags = Bags(data[offsets[0]:offsets[-1]], offsets - offsets[0])
    net.mean, net.spread = bags.statistics.mean(0), bags.statistics.std(0) + 0.05
    adam = Adam(net.p, RATE)
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for epoch in range(epochs):
        adam.rate = RATE * (1 - epoch / epochs)
        for at in batches_of(len(y), BATCH, rng):
            adam.step(net.gradients(bags.take(at), y[at], balance[at]))
    net.scale, net.shift = calibrate(net.read(bags)[0].astype(np.float64), y, weight)
    return net


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Network:
    """Train on a bounded sample (see ``learning``) of the labelled documents, in
    a task of its own."""
    return trained(docs, labels, label, train, Network)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with a column quality_score (0 to 1; replaces one of that name).

    All passages of the whole text are encoded. Null and empty texts, and texts
    of white space, are one passage without words. Rows are scored one by one:
    ties and repeated rows get equal scores, an empty table an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.drop("quality_score").withColumn("__scored_text", text_or_empty())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            scores = [own.document_scores(Bags(data, offsets))
                      for _, _, data, offsets in W.pieces(batch.column("__scored_text"))]
            kept = batch.drop_columns(["__scored_text"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(np.concatenate([np.zeros(0), *scores]))], names=[*kept.schema.names, "quality_score"])

    schema = docs.drop("quality_score").schema.add("quality_score", "double")
    return rows.mapInArrow(run, schema)
