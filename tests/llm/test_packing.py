"""Packing: every id lies in exactly one piece, sequences need no padding."""

from __future__ import annotations

import os
import pickle
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from messy import frame, rows
from tokenizers import Tokenizer

from tradeflow.llm import packing as P
from tradeflow.llm import tokens as T
from tradeflow.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_words_encode_as_whole_texts_do():
    whole, own, rng = Tokenizer.from_file(PATH), WordEncoder(PATH), random.Random(1)
    parts = [*"abZQéèßüÿ÷ç ,.\n\t'’sStT<|>#1٣̸̈=Σς　\x1c\x85 \x0b!ñ", ". ", ", ", "<|endoftext|>", "<|ENDOFTEXT|>", "a.", "the", "Wörter"]
    for _ in range(400):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) if rng.random() > 0.1 else None for _ in range(8)]
        ids, n = own(pa.array(texts, pa.string())[1:])
        for text, got in zip(texts[1:], np.split(ids, np.cumsum(n))):
            assert whole.encode(text or "", add_special_tokens=False).ids == got.tolist(), text


def test_pieces_of_texts_are_split_and_looked_up_alike(monkeypatch):
    """A lowered U+0130 ends in a combining mark, which joins the marks after it."""
    monkeypatch.setattr(T, "PIECE_BYTES", 16)
    monkeypatch.setattr(T, "COPY_WORDS", 3)
    whole, own = Tokenizer.from_file(PATH), WordEncoder(PATH)
    texts = ["\u0130>a, b", None, "", "!a\u0130.", "É! the boat, the river; Boat's end.", "\u0131>", "<|endoftext|> A!"] * 3
    ids, n = own(pa.array(texts, pa.string()))
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [part.tolist() for part in np.split(ids, np.cumsum(n)[:-1])] == want


def test_subjects_are_the_heaviest_common_terms(monkeypatch):
    monkeypatch.setattr(P, "GROUP", 7)
    rng = np.random.default_rng(5)
    ids = [rng.integers(0, rng.integers(1, 60), rng.integers(1, 90)).astype(np.uint16) for _ in range(100)]
    corpus = P.Corpus(100, 45.0, P.document_counts(ids))
    idf, want = corpus.idf(), []
    for own in ids:
        tf = Counter(own.tolist())
        weight = {t: idf[t] * n / (n + P.K1 * (1 - P.B + P.B * len(own) / 45.0)) - 1e6 * (corpus.df[t] < 30) for t, n in tf.items()}
        top = sorted(sorted(tf), key=lambda t: -weight[t])[:P.TOP]
        top.sort(key=lambda t: int(P.W.mix(np.array([t], np.uint64))[0]))
        want.append([top[0], top[min(1, len(top) - 1)]])
    assert corpus.subjects(ids, idf, 30).tolist() == want and corpus.subjects([], idf, 30).shape == (0, 2)


@pytest.mark.parametrize("sequence, shard_bytes", [(4096, 8 << 20), (64, 10_000)])
def test_pack(spark, sequence, shard_bytes):
    whole = Tokenizer.from_file(PATH)
    want = Counter(tuple(whole.encode(t or "", add_special_tokens=False).ids + [2]) for _, t, *_ in rows())
    got, sequences = defaultdict(list), defaultdict(list)
    pieces = P.pack(frame(spark), PATH, sequence=sequence, shard_bytes=shard_bytes).collect()
    for r in pieces:
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        got[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    assert sum(r.length for r in pieces) == sum(len(k) * n for k, n in want.items())
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= sequence and at & (at - 1) == 0
    for (doc_id, n), own in got.items():
        if doc_id not in (None, 7):  # repeated rows
            own.sort(key=lambda r: r.start)
            assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]]
            assert want[tuple(i for r in own for i in r.ids)] >= 1


def test_nothing_to_pack(spark):
    assert P.pack(frame(spark).limit(0), PATH).collect() == []


def test_neighbours_come_first():
    texts = [np.array([10 * t + k for k in range(8)] * 4, np.int64) for t in (1, 2, 1, 2, 1, 2)]
    first, second, _ = P.fill(texts, 64)
    assert [{d % 2 for d, *_ in pieces} for pieces in (first, second)] == [{0}, {1}]


def test_bm25_order_is_that_of_the_formula():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 50, rng.integers(5, 40)) for _ in range(30)]
    index = P.Index(texts)
    mean = np.mean([len(t) for t in texts])

    def weight(term, d):
        tf, df = (texts[d] == term).sum(), sum((t == term).any() for t in texts)
        return np.log(1 + (30 - df + 0.5) / (df + 0.5)) * tf * (P.K1 + 1) / (tf + P.K1 * (1 - P.B + P.B * len(texts[d]) / mean))

    for seed in range(5):
        query = sorted(set(texts[seed].tolist()), key=lambda t: (-np.float32(weight(t, seed)), t))[:P.QUERY_TERMS]
        score = np.array([sum(weight(t, d) for t in query) for d in range(30)])
        found = index.neighbours(seed)
        assert set(found.tolist()) == set(np.flatnonzero(score > 0).tolist())
        assert np.all(np.diff(score[found]) <= 1e-4)


def test_related_documents_share_a_shard_and_its_size_is_bounded(spark):
    rng = random.Random(4)
    subjects = ["river boat harbor sailor", "piano violin concert opera", "doctor hospital nurse patient", "carbon oxygen atom molecule"]
    own = [(k, " ".join(rng.choice(subjects[k % 4].split()) for _ in range(30)) + f" the number {k}", "en", "s") for k in range(80)]
    found = P.pack(frame(spark, own), PATH, sequence=256, shard_bytes=4_000).collect()
    shards, sizes = defaultdict(Counter), {i: len(t) + 1 for i, t, *_ in own}
    for r in found:
        shards[r.sequence_id >> 32][r.doc_id] += 1
    assert len(shards) > 2 and max(sum(sizes[d] for d in s) for s in shards.values()) < 8_000
    same = sum(max(Counter(d % 4 for d in s).values()) for s in shards.values())
    assert same > 0.7 * sum(len(s) for s in shards.values())


def test_weights_are_those_of_the_corpus():
    texts = [np.array([1, 2, 3]), np.array([1, 4]), np.array([2, 5])]
    df = np.ones(1 << 16, np.int64)
    df[1], df[2] = 900, 2
    index = P.Index(texts, P.Corpus(1000, 3.0, df))
    assert index.neighbours(0).tolist() == [0, 2, 1]


def test_all_terms_of_a_seed_are_asked():
    seed = np.arange(40).repeat(2)
    texts = [seed] + [np.array([k] * 5) for k in range(40)]
    assert len(P.Index(texts).neighbours(0)) == 41


def test_known_words_are_encoded_once_and_stay_with_the_worker():
    encoder, asked = pickle.loads(pickle.dumps(WordEncoder(PATH))), []
    own = encoder._encode
    encoder._encode = lambda word: asked.append(word) or own(word)
    first = encoder(pa.array(["the boat, the river", None]))
    again = encoder(pa.array(["river boat the", "the harbor"]))
    assert sorted(filter(None, asked)) == [",", "boat", "harbor", "river", "the"]
    assert first[1].tolist() == [5, 0] and again[1].tolist()[0] == 3
    assert again[0].tolist() == Tokenizer.from_file(PATH).encode("river boat the the harbor", add_special_tokens=False).ids


def test_known_words_are_no_python_objects():
    """300,000 words, which a Python worker keeps for as long as it lives."""
    encoder = WordEncoder(PATH)
    encoder(pa.array(["a"]))
    tracemalloc.start()
    try:
        for k in range(3):
            encoder(pa.array([" ".join(f"w{k}x{i}" for i in range(100_000))]))
        assert len(encoder.known) > 300_000 and tracemalloc.get_traced_memory()[0] < 16 << 20
    finally:
        tracemalloc.stop()


def test_filling_goes_by_all_scores_though_used_documents_leave_the_index():
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 60, rng.integers(1, 90)) for _ in range(200)]
    index, rest, start = P.Index(ids), np.array([len(a) for a in ids]), np.zeros(200, int)
    for pieces in P.fill(ids, 128):
        seed = int(np.flatnonzero(rest)[0])
        score = index.scores(seed)
        order = [seed] + [d for d in sorted(range(200), key=lambda d: (-score[d], d)) if d != seed and rest[d]]
        assert pieces[0][0] == seed
        want, room = [], 128
        for d in order:
            if room and rest[d] and (d == seed or score[d]):
                n = min(room, rest[d])
                want.append((d, start[d], n))
                room, rest[d], start[d] = room - n, rest[d] - n, start[d] + n
        assert pieces[:len(want)] == want
        for d, at, n in pieces[len(want):]:
            assert at == start[d]
            rest[d], start[d] = rest[d] - n, start[d] + n
    assert not rest.any()


def test_documents_are_counted_by_id():
    ids = [np.array(x, np.uint16) for x in ([3, 1, 3, 65535], [3], [], [1, 1])]
    assert {k: int(n) for k, n in enumerate(P.document_counts(ids)) if n} == {1: 2, 3: 2, 65535: 1}


def test_workers_keep_little_memory_after_packing(spark):
    """A worker outlives its task, and lies beside the executor's heap."""
    def held(batches):
        for _ in batches:
            time.sleep(0.5)  # so that each worker gets one
            found = re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
            yield pa.RecordBatch.from_pydict({"pid": pa.array([os.getpid()]), "mb": pa.array([int(found[0]) >> 10])})

    # 48 MB of 20,000 words, most of it in one worker at a time.
    texts = spark.range(0, 4000, 1, 1).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(1, 1500), k -> concat('w', hash(id, k) % 10000))) AS text")
    P.pack(texts, PATH).write.format("noop").mode("overwrite").save()
    after = spark.range(0, 4, 1, 4).mapInArrow(held, "pid long, mb long").collect()
    assert max(r.mb for r in after) < 170, after
