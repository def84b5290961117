"""N-gram join, decontamination and language-model scores against brute force."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import by_id, frame, lower, rows, words
from pyspark.sql import functions as F

from tradeflow.llm import common, components
from tradeflow.llm import decontamination as D
from tradeflow.llm import ngram_join as N
from tradeflow.llm.components import connected_components
from tradeflow.llm.lm_scoring import lm_scores


def brute_components(own, n, percent):
    sets = []
    for _, t, *_ in own:
        w = words(lower(t))
        sets.append({tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = set()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
                if a != b:
                    links.add(frozenset([frozenset(a), frozenset(b)]))
    ids = defaultdict(list)
    for k, (i, *_) in enumerate(own):
        ids[root(k)].append(i)
    least = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    return by_id((i, len(sets[k]), least[root(k)] if sets[k] else i) for k, (i, *_) in enumerate(own)), len(links)


@pytest.mark.parametrize("n, percent, all_links", [(4, 85, False), (5, 80, True), (1, 50, False)])
def test_ngram_join(spark, n, percent, all_links, monkeypatch):
    if n == 1:
        monkeypatch.setattr(N, "BLOCK", 8)  # homes are split into blocks
    want, links = brute_components(rows(), n, percent)
    found = N.ngram_join(frame(spark), n, percent, all_links)
    assert by_id(found.members.select("doc_id", "n_shingles", "component_id").collect()) == want
    assert found.links.count() == links if all_links else found.links.count() <= links
    assert links > 10


def test_keep_one(spark):
    own = rows()
    want, _ = brute_components(own, 5, 80)
    kept = N.keep_one(frame(spark))
    assert kept.columns == frame(spark).columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert all(ids[c] for _, size, c in want if size and c is not None)
    assert ids[None] == 1 and ids[7] == 1
    assert all(ids[i] for i in (300, 301, 302))  # without words: linked with nothing
    assert sum(ids.values()) == len({c for _, size, c in want if size}) + 3 + 1  # id 8 stands for two texts
    assert N.keep_one(frame(spark).limit(0)).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 40), min_size=1, max_size=12), min_size=2, max_size=30), st.integers(50, 100))
def test_tree_loses_no_pair(sets, percent):
    hashed = [np.sort(N.W.mix(np.array(sorted(s), np.uint64) + np.uint64(1))) for s in sets]
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    prints = np.stack([N._signature(hashed[i], 256) for i in order]).view(np.uint64)
    nodes = N.Nodes(prints, size[order], size[order], size[order] - N._pop(prints), np.arange(len(sets)))
    found = {frozenset((order[x], order[y])) for i, j in N.traverse(nodes, percent) for x, y in zip(i, j)}
    counts = np.stack([N._histogram(h) for h in hashed])
    every = np.array([(i, j) for i in range(len(sets)) for j in range(i)]).reshape(-1, 2).T
    near = {(int(every[0][k]), int(every[1][k])) for k in N.near_histograms(counts, size, *every, percent)}
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                assert frozenset((i, j)) in found and (i, j) in near


def test_histogram_bound_holds_for_long_sets():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 63, 60_000, dtype=np.uint64) * np.uint64(2))
    sets = [np.sort(rng.choice(base, n, replace=False)) for n in (50_000, 52_000, 58_000, 9_000)] + [base]
    counts, size = np.stack([N._histogram(s) for s in sets]), np.array([len(s) for s in sets])
    for i in range(5):
        for j in range(i):
            for percent in (50, 80, 90):
                both = len(np.intersect1d(sets[i], sets[j]))
                linked = 100 * both >= percent * (size[i] + size[j] - both)
                assert len(N.near_histograms(counts, size, np.array([i]), np.array([j]), percent)) >= linked


def test_components(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, 101), (102, 101), (200, 200), (300, 301), (301, 300), (300, 301)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    want = {**{k: 0 for k in range(51)}, 100: 100, 101: 100, 102: 100, 200: 200, 300: 300, 301: 300}
    assert by_id(found.collect()) == sorted(want.items())


@pytest.mark.parametrize("kind", ["long", "string"])
def test_components_of_links_in_many_tasks(spark, kind):
    drawn = np.random.default_rng(3).integers(0, 700, (500, 2)).tolist()
    label = {k: k for k in chain.from_iterable(drawn)}
    if kind == "string":
        label = {k: f"é{k}" for k in label}
    for _ in range(700):
        for a, b in drawn:
            label[a] = label[b] = min(label[a], label[b])
    name = str if kind == "long" else lambda k: f"é{k}"
    links = spark.createDataFrame([(name(a), name(b)) for a, b in drawn], "a string, b string").repartition(7)
    found = connected_components(links.select(*(F.col(c).cast(kind) for c in "ab")))
    assert sorted(map(tuple, found.collect())) == sorted((k if kind == "long" else name(k), v) for k, v in label.items())


def test_components_within_a_task_take_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(components, "MOST_ROUNDS", 1)
    links = [(k, k + 1) for k in range(50)] + [(k, 100 + k % 7) for k in range(200, 300)]
    found = connected_components(spark.createDataFrame(links, "a long, b long").coalesce(1))
    want = {**{k: 0 for k in range(51)}, **{k: 100 + k % 7 for k in range(200, 300)}, **{k: k for k in range(100, 107)}}
    assert by_id(found.collect()) == sorted(want.items())


def test_scratch_tables_do_not_outlast_their_use(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "checkpoint_dir", lambda spark: str(tmp_path))
    assert N.keep_one(frame(spark)).count()
    left = Counter(p.name.rsplit("-", 1)[0] for p in (tmp_path / "llm").iterdir())
    assert set(left) <= {"shingle-counts", "home-links", "around", "class-components", "stay"} and sum(left.values()) <= 9


ITEMS = [(1, "The quick brown fox jumps over the lazy dog while seven wise owls watch the quiet river bend."),
         (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"),
         (3, "three short words"), (4, None), (5, ""), (2, "a second text of the same item id with some more words in it, twelve")]


def leaked():
    own = rows()
    item, other = ITEMS[0][1], ITEMS[1][1]
    own += [(501, own[1][1] + " " + item + " " + own[2][1], "en", "s"), (502, item.upper().replace(" ", "  "), "en", "s"),
            (503, own[4][1] + "\n" + other.replace("kappa", "KAPPA!"), "en", "s"),
            (504, own[6][1] + " " + " ".join(other.split()[:9]) + " and no more", "en", "s"),
            (505, "before three short words after", "en", "s")]
    return own


def brute_matches(own):
    index = D.Index([i for i, t in ITEMS if t], [t for _, t in ITEMS if t], 5)
    out = set()
    data, offsets = D.W.utf8(pa.array([t or "" for _, t, *_ in own]))
    grams, first = D._shingles(data, offsets, 5)
    for k, (i, *_) in enumerate(own):
        for item in range(len(index.ids)):
            value, _ = index.similarity(grams[first[k]:first[k + 1]], item, 0, 1 << 30)
            if value >= D.SIMILARITY:
                out.add((i, index.ids[item], round(value, 9)))
    return out


def test_decontamination(spark):
    own = leaked()
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    found = D.contamination(frame(spark, own), items).collect()
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in found}
    assert got == brute_matches(own)
    assert {(i, k) for i, k, _ in got} >= {(501, 1), (502, 1), (503, 2)} and 504 not in {i for i, *_ in got}
    clean = D.remove_contaminated(frame(spark, own), items)
    assert clean.count() == len(own) - len({i for i, *_ in got}) and clean.columns == frame(spark).columns
    assert D.contamination(frame(spark, own), items.limit(0)).collect() == []
    assert D.contamination(frame(spark).limit(0), items).collect() == []


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    index = D.Index(list(range(40)), [" ".join(f"w{rng.integers(99)}" for _ in range(20)) for _ in range(40)], 5)
    for group, (_, items, own, _) in enumerate(index.groups):
        prints = np.repeat(own, 200)
        for k in range(len(prints)):
            for bit in rng.choice(64, rng.integers(0, 20), replace=False):
                prints[k] ^= np.uint64(1) << np.uint64(bit)
        got = set(zip(*(x.tolist() for x in index.near(prints, group))))
        near = np.bitwise_count(prints[:, None] ^ own) <= D.RADIUS
        assert got == {(w, int(items[i])) for w, i in zip(*(x.tolist() for x in np.nonzero(near)))}


def brute_scores(own, corpus, leave_out):
    pairs, contexts, alone, total = Counter(), Counter(), Counter(), 0
    for _, t, *_ in corpus:
        before = None
        for w in words(lower(t)):
            pairs[before, w] += 1
            contexts[before] += 1
            alone[w] += 1
            total += 1
            before = w
    out = []
    for i, t, *_ in own:
        score, before = 0.0, None
        for w in words(lower(t)):
            if pairs[before, w] > leave_out:
                score += math.log((pairs[before, w] - leave_out) / (contexts[before] - leave_out))
            else:
                score += math.log(0.4) + math.log(max(alone[w] - leave_out, 0.5)) - math.log(total - leave_out)
            before = w
        out.append((i, len(words(t)), score))
    return by_id(out)


def same_scores(found, want):
    found = by_id((r.doc_id, r.n_words, r.log_score) for r in found)
    assert [r[:2] for r in found] == [r[:2] for r in want]
    assert np.allclose([r[2] for r in found], [r[2] for r in want], rtol=1e-9)


def test_lm_scores(spark):
    same_scores(lm_scores(frame(spark)).collect(), brute_scores(rows(), rows(), 1))


def test_lm_scores_by_another_corpus(spark, monkeypatch):
    import tradeflow.llm.lm_scoring as module
    monkeypatch.setattr(module, "HOT", 8)  # few hot keys: most go through the buckets
    own = rows()
    corpus = frame(spark, own[:20]).select("text", "key")
    same_scores(lm_scores(frame(spark, own[20:]), corpus).collect(), brute_scores(own[20:], own[:20], 0))
    assert {r.log_score for r in lm_scores(frame(spark, own[:3]), corpus.limit(0)).collect()} == {0.0}
    assert lm_scores(frame(spark).limit(0)).collect() == []


def test_bigrams_of_a_tiny_corpus_back_off(spark):
    own = [(1, "a b c a b", "en", "s"), (2, "d e", "en", "s"), (3, "a b f", "en", "s")]
    same_scores(lm_scores(frame(spark, own)).collect(), brute_scores(own, own, 1))


def test_short_items_are_found_inside_documents(spark):
    items = [(1, "three short words"), (2, "one"), (3, "Four words, not five"), (4, "five words are one shingle")]
    own = [(1, "before three short words after it all", "en", "s"), (2, "three short and words", "en", "s"),
           (3, "say FOUR words not; five or one", "en", "s"), (4, "one", "en", "s"), (5, "a five words are one shingle b", "en", "s")]
    plain = {i: "".join(c if c.isalnum() else " " for c in t.lower()).split() for i, t in [*items, *((10 + i, t) for i, t, *_ in own)]}
    want = {(i, k, at) for i, *_ in own for k, _ in items
            if (at := next((p for p in range(len(plain[10 + i])) if plain[10 + i][p:p + len(plain[k])] == plain[k]), None)) is not None}
    found = D.contamination(frame(spark, own), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.start) for r in found} == want and len(want) == 6


def test_similarities_do_not_depend_on_passes(spark, monkeypatch):
    items = spark.createDataFrame([*ITEMS, (6, ITEMS[0][1] + " and more"), (7, "word1 " * 70 + "end")], "item_id long, text string")
    own = [*leaked(), (601, "before " + "word1 " * 70 + "end after", "en", "s")]
    want = by_id(D.contamination(frame(spark, own), items).collect())
    monkeypatch.setattr(D, "ITEMS", 2)
    monkeypatch.setattr(D, "ITEM_CHARS", 300)  # the last item is longer
    assert by_id(D.contamination(frame(spark, own), items).collect()) == want
    assert (601, 7) in {(r[0], r[2]) for r in want}


def test_no_match_just_above_the_threshold_is_lost():
    rng = np.random.default_rng(6)
    items = [" ".join(f"w{x}" for x in rng.integers(0, 20_000, n)) for n in (60, 211, 330, 804, 1004) for _ in range(6)]
    index, texts = D.Index(list(range(len(items))), items, 5), []
    for i, item in enumerate(items):
        for _ in range(8):
            own, value = item.split(), 1.0
            while value >= 0.8:  # scattered edits until the next one is too many
                kept, before = list(own), value
                own[rng.integers(len(own))] = "edited"
                value = _value(index, own, i)
            around = [[f"x{x}" for x in rng.integers(0, 9_999, rng.integers(0, 90))] for _ in range(2)]
            texts.append((i, " ".join(around[0] + kept + around[1])))
    grams, first = D._shingles(*D.W.utf8(pa.array([t for _, t in texts])), 5)
    found = {(t, item) for t, item, *_ in D.matches(grams, first, index, 0.8)}
    assert {(t, i) for t, (i, _) in enumerate(texts)} <= found


def _value(index, own, item):
    grams, _ = D._shingles(*D.W.utf8(pa.array([" ".join(own)])), 5)
    return index.similarity(grams, item, 0, 0)[0]


def test_lm_scores_of_rare_words(spark, monkeypatch):
    """Almost every word is dealt again, to where it is counted."""
    import tradeflow.llm.lm_scoring as module
    monkeypatch.setattr(module, "HOT", 2)
    monkeypatch.setattr(module, "HOT_WORDS", 2)
    own = rows() + [(500 + k, "x " * 700 + f"only{k} here{k}", "en", "s") for k in range(3)]
    same_scores(lm_scores(frame(spark, own)).collect(), brute_scores(own, own, 1))
    same_scores(lm_scores(frame(spark, own[20:]), frame(spark, own[:20]).select("text")).collect(), brute_scores(own[20:], own[:20], 0))


def test_lm_positions_are_packed_small():
    import tradeflow.llm.lm_scoring as module
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 48, 70_000, dtype=np.uint64))
    ranked = module.Ranked(keys, rng.integers(1, 9_000, len(keys)))
    for n in (0, 1, 255, 256, 40_000):
        words = keys[np.minimum(rng.zipf(1.3, n), len(keys)) - 1] if n else keys[:0]
        words[::9] = rng.integers(0, 1 << 48, len(words[::9]), dtype=np.uint64)
        assert (ranked.get(ranked.put(words)) == words).all()
        assert n < 40_000 or len(ranked.put(words)) < 3 * n  # 6 bytes each before
        begin, length = module._runs(np.sort(words))
        assert (np.repeat(np.sort(words)[begin], length) == np.sort(words)).all()
    begin, length = module._runs(np.repeat(np.arange(3), [255, 700, 1]))
    assert begin.tolist() == [0, 255, 510, 765, 955] and length.tolist() == [255, 255, 255, 190, 1]


def test_long_sets_are_told_apart_in_buckets():
    """Sets of thousands of n-grams are no candidates unless they overlap; similar ones always are."""
    import tradeflow.llm.ngram_join as J
    rng = np.random.default_rng(3)
    sets = []
    for n in (30, 300, 900, 1024, 1025, 1100, 2000, 4000, 4100, 6000, 9000, 20_000):
        own = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        own[:len(own) // 20] &= np.uint64((1 << 55) - 1)  # one crowded range
        sets += [np.unique(own)]
        for share in (0.02, 0.1, 0.3):
            kept = own[rng.random(len(own)) > share]
            sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 64, int(share * len(own) / 3), dtype=np.uint64)])))
        sets.append(np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64)))
    size = np.array([len(s) for s in sets])
    prints = J.Prints([J.long_counts(s) if len(s) > J.LONG else J._signature(s).tobytes() + J._histogram(s).tobytes() for s in sets], size)
    i, j = np.triu_indices(len(sets), 1)
    both = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
    similar = 100 * both >= 80 * (size[i] + size[j] - both)
    near = np.zeros(len(i), bool)
    near[prints.near(i, j, 80)] = True
    assert similar.sum() > 20 and (near | ~similar).all()
    apart = (both == 0) & (size[i] > 3000) & (size[j] > 3000)
    assert apart.sum() > 50 and not near[apart].any()
    nodes = J.Nodes(prints.bits, size, size, prints.slack, np.arange(len(sets)))
    met = {(a, b) for x, y in J.traverse(nodes, 80) for a, b in zip(x.tolist(), y.tolist())}
    assert {(a, b) for a, b, s in zip(i.tolist(), j.tolist(), similar) if s} <= met


def test_lm_rows_do_not_grow_by_pieces_and_buckets(spark, monkeypatch):
    """Sums come back in a row for each two of a few buckets and groups, not one for each piece."""
    import tradeflow.llm.lm_scoring as module
    monkeypatch.setattr(module, "HOT", 2)
    monkeypatch.setattr(module, "HOT_WORDS", 2)
    monkeypatch.setattr(module, "LEAST_BUCKETS", 4)
    monkeypatch.setattr(module, "BUCKET_BYTES", 1 << 12)
    own = [(k, " ".join("x " * 9 + f"only{k}of{j}" for j in range(20)), "en", "s") for k in range(96)]
    docs, made = frame(spark, own).repartition(24), []
    plain = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a, **b: made.append(plain(self, *a, **b)) or made[-1])
    same_scores(lm_scores(docs).collect(), brute_scores(own, own, 1))
    sent = [df.filter("kind >= 3").count() for df in made if "kind" in df.columns and "bucket" in df.columns]
    size = sum(len(t) for _, t, *_ in own)
    buckets = size // module.BUCKET_BYTES
    assert buckets > 10 and len(sent) == 3 and sent[0] <= 24
    assert sent[-1] <= 24 + buckets + buckets * buckets // 2 < 96 * 20 // 4


def test_lm_scores_of_pieces_over_batches(spark, monkeypatch):
    """Pieces of many reads, pieces that occur again, and texts that one piece can't number."""
    import tradeflow.llm.lm_scoring as module
    for name, most in (("HOT", 2), ("HOT_WORDS", 2), ("BUCKET_BYTES", 1 << 10), ("PACK_BYTES", 3000), ("READ_BYTES", 500)):
        monkeypatch.setattr(module, name, most)
    own = rows() + [(500 + k, f"a{k % 7} b c{k} a{k % 3} b", "en", "s") for k in range(60)]
    one = frame(spark, own).coalesce(1)
    same_scores(lm_scores(one.union(one)).collect(), brute_scores(own + own, own + own, 1))
    monkeypatch.setattr(module, "PACK_BYTES", 1 << 24)
    many = [(k, f"a b{k}" if k % 9_000 == 0 else "a" if k % 2 else None, "en", "s") for k in range(70_000)]
    same_scores(lm_scores(frame(spark, many).coalesce(1)).collect(), brute_scores(many, many, 1))
