"""Toxicity: a bidirectional GRU with attention pooling over overlapping windows.

A word enters the network as its own embedding beside a max-pooled embedding of
its character n-grams, so that unseen words still carry signal. The
network reads every window of WIDTH words, STRIDE apart, in both directions;
attention pools its states to one score a window, and a document has the score
of its worst window. Everything is numpy. Training picks, again and again, the
window that now scores highest in each labelled document (the labels do not say
where), and learns from those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm import words as W
from tradeflow.llm.common import lean, text_or_empty
from tradeflow.llm.learning import Adam, batches_of, calibrate, sigmoid, sum_by, trained

WIDTH, STRIDE = 24, 12
WORD_SLOTS, CHAR_SLOTS = 1 << 15, 1 << 16
CHAR_GRAMS = (3, 4, 5, 6)
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 8, 8, 8
EPOCHS, RATE, BATCH = 6, 0.01, 512
#: Labelled documents that must hold a word (or words with an n-gram) before it
#: has an embedding of its own.
SUPPORT = 8
#: Windows read at once when scoring, and distinct words whose n-grams are held at once.
READ, WORDS = 4096, 1 << 14

# Bytes as the network sees them: A-Z lowered, ASCII punctuation and controls
# separate words.
_SEEN = W.lower_ascii(np.arange(256, dtype=np.uint8))
_SEEN[[b for b in range(128) if not chr(b).isalnum()]] = 0x20


def _char_grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots of the words' character n-grams, word of each, ascending), made
    for WORDS words at a time."""
    slots, words = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for lo in range(0, len(starts), WORDS):
        slot, word = _grams(data, starts[lo:lo + WORDS], ends[lo:lo + WORDS])
        slots.append(slot.astype(np.int32))
        words.append((word + lo).astype(np.int32))
    return np.concatenate(slots), np.concatenate(words)


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of some words; the ends of a word count as characters."""
    n = ends - starts + 2
    first = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], n)
    edge = (at == 0) | (at == np.repeat(n, n) - 1)
    byte = data[np.minimum(np.repeat(starts, n) + np.maximum(at - 1, 0), len(data) - 1)] if len(data) else np.zeros(0, np.uint8)
    value = W.mix(np.where(edge, at == 0, byte + np.uint64(2)).astype(np.uint64) + np.uint64(1))
    word = np.repeat(np.arange(len(n)), n)
    slots, words = [], []
    for size in CHAR_GRAMS:
        ok = np.flatnonzero(W.inside_texts(first, size))
        slots.append((W.ngrams(value, size)[ok] >> np.uint64(20)) % np.uint64(CHAR_SLOTS))
        words.append(word[ok])
    slots, words = np.concatenate(slots).astype(np.int64), np.concatenate(words)
    order = np.argsort(words, kind="stable")
    return slots[order], words[order]


def _blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about PIECE_BYTES together."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + W.PIECE_BYTES, "right")) - 1)
        yield lo, hi
        lo = hi


def _hashes(data: np.ndarray, offsets: np.ndarray, words: W.Words) -> np.ndarray:
    """The hash of each word, made for a block of texts at a time."""
    out = [np.zeros(0, np.uint64)]
    for lo, hi in _blocks(offsets):
        own, begin = slice(words.first[lo], words.first[hi]), offsets[lo]
        part = W.Words(words.starts[own] - begin, words.ends[own] - begin, words.first[lo:hi + 1] - words.first[lo])
        out.append(W.hash_words(data[begin:offsets[hi]], part))
    return np.concatenate(out)


class Piece:
    """Distinct words and windows of some texts. Word 0 pads short windows; a
    text without words has one window of padding."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = _SEEN[data]
        words = W.split_words(data, offsets)
        hashes, shown, at = np.unique(_hashes(data, offsets, words), return_index=True, return_inverse=True)
        self.slot = np.concatenate([[0], 1 + (hashes % np.uint64(WORD_SLOTS - 1)).astype(np.int64)])
        self.char, self.char_word = _char_grams(data, words.starts[shown], words.ends[shown])
        counts = np.diff(words.first)
        windows = np.maximum(1, -(-(counts - WIDTH) // STRIDE) + 1)
        self.text = np.repeat(np.arange(len(counts)), windows)
        nth = np.arange(len(self.text)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.start = words.first[:-1][self.text] + nth * STRIDE
        self.end = words.first[1:][self.text]
        self.first = np.cumsum(windows) - windows
        self.word = np.concatenate([at + 1, [0]]).astype(np.int32)

    def ids(self, windows: np.ndarray | slice) -> np.ndarray:
        """Distinct-word indexes of some windows, WIDTH each."""
        at = self.start[windows, None] + np.arange(WIDTH)
        return np.where(at < self.end[windows, None], self.word[np.minimum(at, len(self.word) - 1)], 0)


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)

        def init(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        x = WORD_DIM + CHAR_DIM
        self.p = {"word": np.zeros((WORD_SLOTS, WORD_DIM), np.float32), "char": np.zeros((CHAR_SLOTS, CHAR_DIM), np.float32),
                  "att": init(2 * HIDDEN, ATTENTION), "att_b": np.zeros(ATTENTION, np.float32), "att_v": init(ATTENTION),
                  "out": init(2 * HIDDEN), "out_b": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"in_{d}": init(x, 3 * HIDDEN), f"bias_{d}": np.zeros(3 * HIDDEN, np.float32),
                       f"rec_{d}": init(HIDDEN, 3 * HIDDEN)}
        self.known = {"word": np.zeros((WORD_SLOTS, 1), bool), "char": np.zeros((CHAR_SLOTS, 1), bool)}
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, slot: np.ndarray, char: np.ndarray, char_word: np.ndarray) -> np.ndarray:
        """Input vector of each distinct word, the padding first."""
        out = np.zeros((len(slot), WORD_DIM + CHAR_DIM), np.float32)
        out[:, :WORD_DIM] = self.p["word"][slot]
        if len(char):
            cuts = np.append(np.flatnonzero(np.diff(char_word, prepend=-1)), len(char))
            for lo in range(0, len(cuts) - 1, WORDS):
                own = cuts[lo:lo + WORDS + 1]
                out[1 + lo:lo + len(own), WORD_DIM:] = np.maximum.reduceat(
                    self.p["char"][char[own[0]:own[-1]]], own[:-1] - own[0], axis=0)
        out[0] = 0
        return out

    def read(self, gates: dict[str, np.ndarray], ids: np.ndarray, keep: bool = False):
        """Logit of each window; with ``keep`` also what the way back needs."""
        size, steps = ids.shape
        states = np.empty((steps, size, 2 * HIDDEN), np.float32)
        tape: dict[str, list] = {"f": [], "b": []}
        for d, half, order in (("f", slice(0, HIDDEN), range(steps)), ("b", slice(HIDDEN, None), range(steps - 1, -1, -1))):
            rec, h = self.p[f"rec_{d}"], np.zeros((size, HIDDEN), np.float32)
            for t in order:
                g = gates[d][ids[:, t]]
                u = h @ rec
                zr = g[:, :2 * HIDDEN] + u[:, :2 * HIDDEN]
                np.negative(zr, zr)
                np.exp(zr, zr)
                zr += 1
                np.reciprocal(zr, zr)
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                n = np.tanh(g[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
                new = n + z * (h - n)
                if keep:
                    tape[d].append((t, h, z, r, n, u[:, 2 * HIDDEN:]))
                h = new
                states[t, :, half] = h
        a = np.tanh(states @ self.p["att"] + self.p["att_b"])
        e = np.exp(a @ self.p["att_v"])
        e /= e.sum(0)
        pooled = np.einsum("tb,tbh->bh", e, states)
        logit = pooled @ self.p["out"] + self.p["out_b"][0]
        return (logit, (states, a, e, pooled, tape)) if keep else logit

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {d: x @ self.p[f"in_{d}"] + self.p[f"bias_{d}"] for d in "fb"}

    def logits(self, piece: Piece) -> np.ndarray:
        gates = self.gates(self.inputs(piece.slot, piece.char, piece.char_word))
        n = len(piece.text)
        return np.concatenate([self.read(gates, piece.ids(slice(lo, lo + READ))) for lo in range(0, n, READ)])

    def gradients(self, piece: Piece, ids: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted cross-entropy over the windows ``ids``."""
        own, ids = np.unique(np.append(ids.ravel(), 0), return_inverse=True)
        ids = ids[:-1].reshape(len(y), WIDTH)
        here = np.isin(piece.char_word + 1, own)
        char, word = piece.char[here], np.searchsorted(own, piece.char_word[here] + 1) - 1
        x = self.inputs(piece.slot[own], char, word)
        gates = self.gates(x)
        logit, (states, a, e, pooled, tape) = self.read(gates, ids, keep=True)
        d_logit = ((sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
        g = {"out": pooled.T @ d_logit, "out_b": d_logit.sum(keepdims=True)}
        d_pool = d_logit[:, None] * self.p["out"]
        d_e = np.einsum("bh,tbh->tb", d_pool, states)
        d_s = e * (d_e - (e * d_e).sum(0))
        d_states = e[:, :, None] * d_pool
        g["att_v"] = np.einsum("tb,tba->a", d_s, a)
        d_a = d_s[:, :, None] * self.p["att_v"] * (1 - a * a)
        g["att"], g["att_b"] = np.einsum("tbh,tba->ha", states, d_a), d_a.sum((0, 1))
        d_states += d_a @ self.p["att"].T
        d_x = np.zeros_like(x)
        for d, half in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            rec, d_h = self.p[f"rec_{d}"], np.zeros((len(y), HIDDEN), np.float32)
            d_rec, d_gates = np.zeros_like(rec), np.zeros((WIDTH, len(y), 3 * HIDDEN), np.float32)
            for t, h, z, r, n, un in reversed(tape[d]):
                d_h = d_h + d_states[t, :, half]
                d_z = d_h * (h - n) * z * (1 - z)
                d_n = d_h * (1 - z) * (1 - n * n)
                d_r = d_n * un * r * (1 - r)
                d_gates[t] = np.concatenate([d_z, d_r, d_n], 1)
                d_u = np.concatenate([d_z, d_r, d_n * r], 1)
                d_rec += h.T @ d_u
                d_h = d_h * z + d_u @ rec.T
            d_word = sum_by(ids.T.ravel(), d_gates.reshape(-1, 3 * HIDDEN), len(x))
            g |= {f"rec_{d}": d_rec, f"in_{d}": x.T @ d_word, f"bias_{d}": d_word.sum(0)}
            d_x += d_word @ self.p[f"in_{d}"].T
        d_x[0] = 0
        g["word"] = sum_by(piece.slot[own], d_x[:, :WORD_DIM], WORD_SLOTS) * self.known["word"]
        top = self.p["char"][char] == x[1:, WORD_DIM:][word]  # the n-grams that were the largest
        g["char"] = sum_by(char, d_x[1:, WORD_DIM:][word] * top, CHAR_SLOTS) * self.known["char"]
        return g

    def document_scores(self, piece: Piece) -> np.ndarray:
        worst = np.maximum.reduceat(self.logits(piece), piece.first)
        return sigmoid(self.scale * worst.astype(np.float64) + self.shift)


def train(texts: pa.Array, y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """A network fitted on labelled texts. Without labels of both classes its
    scores are the share of label 1 (a half without any label)."""
    net = Network(seed)
    if len(np.unique(y)) < 2:
        net.scale, share = 0.0, float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
        net.shift = float(np.log(share / (1 - share)))
        return net
    rng = np.random.default_rng(seed)
    data, offsets = W.utf8(texts)
    piece = Piece(data[offsets[0]:offsets[-1]], offsets - offsets[0])
    # Embeddings begin with how much oftener a word, or words with an n-gram,
    # stand in documents of label 1, in standard deviations; what has little
    # support stays zero.
    hit, seen = np.zeros(len(piece.slot)), np.zeros(len(piece.slot), np.int64)
    bounds = np.append(piece.first, len(piece.text))
    for lo, hi in _blocks(offsets - offsets[0]):
        own = slice(bounds[lo], bounds[hi])
        pair = np.unique(np.repeat(piece.text[own], WIDTH) * len(piece.slot) + piece.ids(own).ravel())
        hit += np.bincount(pair % len(piece.slot), y[pair // len(piece.slot)], len(piece.slot))
        seen += np.bincount(pair % len(piece.slot), minlength=len(piece.slot))
    share = hit[1:].sum() / max(1, seen[1:].sum())
    for kind, slots, word, n in (("word", piece.slot[1:], np.arange(len(piece.slot) - 1), WORD_SLOTS),
                                 ("char", piece.char, piece.char_word, CHAR_SLOTS)):
        slot_hit, slot_seen = np.bincount(slots, hit[1:][word], n), np.bincount(slots, seen[1:][word], n)
        z = (slot_hit - slot_seen * share) / np.sqrt(np.maximum(1, slot_seen) * share * (1 - share))
        net.known[kind] = (slot_seen >= SUPPORT)[:, None]
        net.p[kind][:] = 0.1 * rng.standard_normal(net.p[kind].shape) * net.known[kind]
        net.p[kind][:, 0] = np.clip((z - 3) / 6, 0, 2) * net.known[kind][:, 0]
    adam = Adam(net.p, RATE)
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(epochs):
        logits = net.logits(piece)
        worst = np.array([lo + logits[lo:hi].argmax() for lo, hi in zip(piece.first, [*piece.first[1:], len(logits)])])
        # Windows of clean documents are clean, wherever they lie.
        other = rng.integers(0, len(logits), len(worst))
        other = other[y[piece.text[other]] == 0]
        chosen = np.concatenate([worst, other])
        for at in batches_of(len(chosen), BATCH, rng):
            own = chosen[at]
            adam.step(net.gradients(piece, piece.ids(own), y[piece.text[own]], balance[piece.text[own]]))
    worst = np.maximum.reduceat(net.logits(piece), piece.first).astype(np.float64)
    net.scale, net.shift = calibrate(worst, y, weight)
    return net


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Network:
    """Train on a bounded sample (see ``learning``) of the labelled documents, in
    a task of its own."""
    return trained(docs, labels, label, train, Network)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with a column toxicity (0 to 1; replaces one of that name).

    All overlapping windows of the whole text are read. Null and empty texts,
    and texts without a letter or digit, get the score of padding alone. Rows
    are scored one by one: ties and repeated rows get equal scores, an empty
    table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.drop("toxicity").withColumn("__scored_text", text_or_empty())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            scores = [own.document_scores(Piece(data, offsets))
                      for _, _, data, offsets in W.pieces(batch.column("__scored_text"))]
            kept = batch.drop_columns(["__scored_text"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(np.concatenate([np.zeros(0), *scores]))], names=[*kept.schema.names, "toxicity"])

    schema = docs.drop("toxicity").schema.add("toxicity", "double")
    return rows.mapInArrow(lean(run), schema)
