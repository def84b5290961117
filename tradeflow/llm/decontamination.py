"""Benchmark decontamination by SimHash windows of the items' sizes.

Every text is cut into overlapping windows about as long as the benchmark
items, each window has a 64-bit SimHash of its word shingles, and a multi-index
finds every item fingerprint within RADIUS bits: 64 bits are four blocks, of
RADIUS = 15 differing bits one block holds three at most, and the index lists
each item under all block values within three bits of its own. Windows can miss
what is just similar enough, so a second source is exact: a run that is similar
to an item holds one of its rarest shingles at least. Candidates are verified by the weighted Jaccard similarity of their shingles at every
alignment near the window.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tradeflow.llm import words as W
from tradeflow.llm.common import lean, text_or_empty

SHINGLE = 5
SIMILARITY = 0.8
RADIUS, BLOCKS = 15, 4
#: Window sizes grow by this factor; windows of a size lie a STEP-th of it apart.
GROWTH, STEP = 1.25, 6
#: Items and characters of one index: they bound what is sent to every task, more
#: are taken in several passes. An item longer than ITEM_CHARS has its own pass.
ITEMS, ITEM_CHARS, PASS_CHARS = 10_000, 100_000, 16 << 20

# Letters are compared in lower case; ASCII punctuation separates words.
_SEEN = W.lower_ascii(np.arange(256, dtype=np.uint8))
_SEEN[[b for b in range(128) if not chr(b).isalnum()]] = 0x20
_FLIPS = np.array([sum(1 << b for b in c) for n in range(RADIUS // BLOCKS + 1) for c in combinations(range(16), n)])


def _shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes by first word and, in column k - 1, k words long; each
    text's first word). A text of fewer than k words has one shingle of all of
    them, if any, at its first word; other words with fewer after them none."""
    words = W.split_words(_SEEN[data], offsets)
    hashes = W.hash_words(_SEEN[data], words)
    out = np.zeros((n, len(hashes)), np.uint64)
    for k in range(1, n + 1):
        grams = W.ngrams(hashes, k)
        out[k - 1, :len(grams)] = grams
    counts = np.diff(words.first)
    for t in np.flatnonzero((counts > 0) & (counts < n)):
        out[counts[t]:, words.first[t]] = out[counts[t] - 1, words.first[t]]
    return out.T, words.first


def _of_length(grams: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles of k words of all texts in a row, each text's first one)."""
    counts = np.diff(first)
    sizes = np.maximum(counts - k + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    return grams[np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], sizes), k - 1], begin


def _item_shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(shingles of each item, their numbers of words): an item of fewer words
    than n is compared by shingles of its length."""
    grams, first = _shingles(data, offsets, n)
    length = np.clip(np.diff(first), 1, n)
    return [grams[a:max(a, b - k + 1), k - 1] for a, b, k in zip(first, first[1:], length)], length


def _simhash(sums: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints from the counts of set bits among ``size`` shingles."""
    return np.packbits(sums > size / 2, axis=1).view(">u8").ravel().astype(np.uint64)


def _bits(grams: np.ndarray) -> np.ndarray:
    return np.unpackbits(grams.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def _sorted_by(keys: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    return keys[order], *(x[order] for x in others)


class Index:
    """Benchmark items, grouped by window size, with their block tables.

    They are weighed as part of a benchmark of ``total`` items, of whose
    shingles ``common`` has those of two items or more, sorted, and their
    numbers of items; without it these items are the whole benchmark. ``least``
    is the smallest similarity asked for.
    """

    def __init__(self, ids: list, texts: list[str], n: int, total: int = 0,
                 common: tuple[np.ndarray, np.ndarray] | None = None, least: float = SIMILARITY):
        self.ids, self.n = ids, n
        data, offsets = W.utf8(pa.array(texts, pa.string()))
        self.grams, self.length = _item_shingles(data, offsets, n)
        if common is None:
            total = len(ids)
            common = np.unique(np.concatenate([np.zeros(0, np.uint64), *map(np.unique, self.grams)]), return_counts=True)
        known, df = common
        # Rare shingles weigh more; those of no item weigh like those of one.
        self.known, self.weight = known, 1 + np.log(max(1, total) / df)
        self.most = 1 + np.log(max(1, total))
        groups: dict[int, list[int]] = {}
        for i, own in enumerate(self.grams):
            if len(own) and self.length[i] == n:
                groups.setdefault(round(np.log(len(own)) / np.log(GROWTH)), []).append(i)
        self.groups = []
        for step, items in sorted(groups.items()):
            size = max(1, round(GROWTH ** step))
            prints = np.array([_simhash(_bits(self.grams[i]).sum(0, dtype=np.int64)[None], len(self.grams[i]))[0]
                               for i in items], np.uint64)
            tables = []
            for block in range(BLOCKS):
                value = ((prints >> np.uint64(16 * block)) & np.uint64(0xFFFF)).astype(np.int64)
                near = (value[:, None] ^ _FLIPS).ravel()
                item = np.repeat(np.arange(len(items)), len(_FLIPS))
                order = np.argsort(near, kind="stable")
                tables.append((np.searchsorted(near[order], np.arange((1 << 16) + 1)).astype(np.int32),
                               item[order].astype(np.int32)))
            self.groups.append((size, np.array(items), prints, tables))
        # Of each item its rarest shingles, by their number of words: a run
        # without any of them lacks more of the item's weight than it may.
        self.rare = []
        for k in range(1, n + 1):
            keys, at = [np.zeros(0, np.uint64)], []
            for i in np.flatnonzero(self.length == k):
                own = np.unique(self.grams[i])
                if len(own):
                    own = own[np.argsort(-self.weights(own), kind="stable")]
                    lacks = np.cumsum(self.weights(own))
                    keys.append(own[:np.searchsorted(lacks, (1 - least) * lacks[-1] + 1e-6) + 1])
                    at += [i] * len(keys[-1])
            if at:
                self.rare.append((k, *_sorted_by(np.concatenate(keys), np.array(at))))

    def weights(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(grams), self.most)
        at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        return np.where(self.known[at] == grams, self.weight[at], self.most)

    def near(self, prints: np.ndarray, group: int) -> tuple[np.ndarray, np.ndarray]:
        """(windows, items of the group) within RADIUS bits: all of them."""
        _, items, own, tables = self.groups[group]
        windows, found = [], []
        for block, (begin, item) in enumerate(tables):
            value = ((prints >> np.uint64(16 * block)) & np.uint64(0xFFFF)).astype(np.int64)
            lo, n = begin[value], begin[value + 1] - begin[value]
            window = np.repeat(np.arange(len(prints)), n)
            at = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            hit = np.bitwise_count(prints[window] ^ own[item[at]]) <= RADIUS
            windows.append(window[hit])
            found.append(item[at[hit]])
        pair = np.unique(np.concatenate(windows).astype(np.int64) * len(items) + np.concatenate(found))
        return pair // len(items), items[pair % len(items)]

    def similarity(self, grams: np.ndarray, item: int, start: int, stop: int) -> tuple[float, int]:
        """The largest similarity of the item to the item-sized runs of a text
        (its rows of ``_shingles``) that begin from start to stop, and the first
        such begin."""
        grams, _ = _of_length(grams, np.array([0, len(grams)]), self.length[item])
        own = np.unique(self.grams[item])
        size = len(self.grams[item])
        start, stop = max(0, start), min(stop, max(0, len(grams) - size))
        region = grams[start:stop + size]
        inside = np.isin(region, own)
        best, at = 0.0, start
        if not inside.any():
            return best, at
        # Each shingle counts in the runs that hold it but not the same one before.
        order = np.argsort(region, kind="stable")
        again = region[order][1:] == region[order][:-1]
        lo = np.zeros(len(region), np.int64)
        lo[order[1:][again]] = order[:-1][again] + 1
        place, runs = np.arange(len(region)), stop - start + 1
        lo, hi = np.maximum(lo, place - size + 1), np.minimum(place, runs - 1) + 1

        def sums(weight: np.ndarray) -> np.ndarray:
            weight = np.where(lo < hi, weight, 0)
            return np.cumsum(np.bincount(np.minimum(lo, runs), weight, runs + 1) - np.bincount(hi, weight, runs + 1))[:runs]

        weight = self.weights(region)
        both = sums(np.where(inside, weight, 0))
        # Sums of floats differ in their last digits by where they begin.
        value = np.round(both / (self.weights(own).sum() + sums(weight) - both), 12)
        at = int(np.argmax(value))
        return float(value[at]), start + at


def matches(grams: np.ndarray, first: np.ndarray, index: Index, least: float) -> Iterator[tuple[int, int, float, int]]:
    """(text, item, similarity, first shingle) of the best match of each text
    and item with at least that similarity."""
    if not len(grams):
        return
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for k, keys, items in index.rare:
        flat, begin = _of_length(grams, first, k)
        lo, hi = np.searchsorted(keys, flat), np.searchsorted(keys, flat, "right")
        places = np.repeat(np.arange(len(flat)), hi - lo)
        found = items[np.arange(len(places)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)]
        order = np.lexsort((places, found))
        places, found = places[order], found[order]
        text = np.searchsorted(begin, places, "right") - 1
        # Places of one item and text less than a run apart are judged together.
        size = np.array([len(g) for g in index.grams], np.int64)[found]
        new = np.ones(len(places), bool)
        new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1]) | (np.diff(places) >= size[1:])
        cuts = np.flatnonzero(new)
        for a, b in zip(cuts, np.append(cuts[1:], len(places))):
            t, item = int(text[a]), int(found[a])
            value, at = index.similarity(grams[first[t]:first[t + 1]], item, int(places[a] - begin[t] - size[a] + 1),
                                         int(places[b - 1] - begin[t]))
            if value >= least and value > best.get((t, item), (0.0, 0))[0]:
                best[t, item] = value, at
    rows, first_row = grams, first
    grams, first = _of_length(rows, first_row, index.n)
    largest = max((g[0] for g in index.groups), default=0)
    kind = np.uint8 if largest < 256 else np.int32  # differences modulo 256 are exact
    total = np.zeros((len(grams) + 1, 64), kind)
    np.cumsum(_bits(grams), axis=0, dtype=kind, out=total[1:])
    counts = np.diff(first)
    tried = set()
    for group, (size, *_) in enumerate(index.groups):
        step = max(1, size // STEP)
        # Windows of each text from its first shingle on, and one at its end;
        # a shorter text is one window.
        n = np.where(counts == 0, 0, -(-np.maximum(0, counts - size) // step) + 1)
        text = np.repeat(np.arange(len(counts)), n)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        start = first[text] + np.minimum(nth * step, np.maximum(0, counts[text] - size))
        end = np.minimum(start + size, first[text + 1])
        for lo in range(0, len(start), 1 << 16):
            a, b = start[lo:lo + (1 << 16)], end[lo:lo + (1 << 16)]
            prints = _simhash(total[b] - total[a], (b - a)[:, None])
            for window, item in zip(*index.near(prints, group)):
                t, s = int(text[lo + window]), int(a[window])
                begin = s - first[t]
                key = (t, int(item), begin // step)
                if key in tried:
                    continue
                tried.add(key)
                own = rows[first_row[t]:first_row[t + 1]]
                value, at = index.similarity(own, item, begin - step, begin + step + max(0, size - len(index.grams[item])))
                if value >= least and value > best.get((t, int(item)), (0.0, 0))[0]:
                    best[t, int(item)] = value, at
    for (t, item), (value, at) in sorted(best.items()):
        yield t, item, value, at


def contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                  shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, text_hash, item_id, similarity, start): every document and
    item for which a run of the document, as long as the item, has a weighted
    shingle similarity of at least ``similarity`` to it; the best run's first
    word. text_hash is xxhash64 of the text.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Items without
    words match nothing, null and empty texts have no match, an empty table on
    either side gives none. Repeated rows and items each have rows of their
    own. Other columns are not read. Documents are not shuffled. Similarities
    do not depend on how items are dealt to passes.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", text_or_empty().alias("text")).filter("text != ''")
    rows = docs.select("doc_id", text_or_empty().alias("text"), F.xxhash64(text_or_empty()).alias("text_hash"))
    kinds = [docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType]
    schema = (f"doc_id {kinds[0].simpleString()}, text_hash long, item_id {kinds[1].simpleString()}, "
              "similarity double, start long")
    item_type = to_arrow_type(kinds[1])
    key, chars = F.xxhash64("item_id", "text"), F.char_length("text")
    short, long = items.filter(chars <= ITEM_CHARS), items.filter(chars > ITEM_CHARS)
    count, size = short.agg(F.count("*"), F.coalesce(F.sum(chars), F.lit(0))).first()
    passes = max(1, -(-count // ITEMS), -(-size // PASS_CHARS))
    parts = [short.filter(F.pmod(key, F.lit(passes)) == k) for k in range(passes)]
    parts += [long.filter(key == r[0]) for r in long.select(key).distinct().collect()]
    common, total = None, items.count()
    if len(parts) > 1:
        def count_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, _, data, offsets in W.pieces(batch.column("text")):
                    for own in _item_shingles(data, offsets, shingle)[0]:
                        yield pa.RecordBatch.from_arrays([pa.array(np.unique(own).view(np.int64))], names=["gram"])

        shared = items.select("text").mapInArrow(count_items, "gram long").groupBy("gram").agg(
            F.count("*").alias("n")).filter("n > 1").toArrow()
        known = shared.column("gram").to_numpy().view(np.uint64)
        common = _sorted_by(known, shared.column("n").to_numpy())
    found = None
    for part in parts:
        own = part.orderBy("item_id", "text").collect()
        index = spark.sparkContext.broadcast(Index([r["item_id"] for r in own], [r["text"] for r in own], shingle, total, common, similarity))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi, data, offsets in W.pieces(batch.column("text")):
                    grams, first = _shingles(data, offsets, index.value.n)
                    hits = list(matches(grams, first, index.value, similarity))
                    own = pa.array([lo + t for t, *_ in hits], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(own), batch.column("text_hash").take(own),
                         pa.array([index.value.ids[i] for _, i, *_ in hits], item_type),
                         pa.array([v for *_, v, _ in hits], pa.float64()), pa.array([int(s) for *_, s in hits], pa.int64())],
                        names=["doc_id", "text_hash", "item_id", "similarity", "start"])

        part_found = rows.mapInArrow(lean(run), schema)
        found = part_found if found is None else found.unionByName(part_found)
    return found


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item (see
    ``contamination``); repeated rows go together."""
    hits = (contamination(docs, benchmark, similarity)
            .select(F.col("doc_id").alias("__doc_id"), F.col("text_hash").alias("__hash")).distinct())
    rows = docs.withColumn("__text_hash", F.xxhash64(text_or_empty()))
    same = rows["doc_id"].eqNullSafe(hits["__doc_id"]) & (rows["__text_hash"] == hits["__hash"])
    return rows.join(hits, same, "left_anti").drop("__text_hash")
