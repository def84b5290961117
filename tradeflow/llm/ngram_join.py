"""Jaccard join of documents on word n-grams, exact, with signature trees.

Documents with equal n-gram sets form one class, so copies cost nothing more.
Classes that look alike by their min-hashes share a home, where all their pairs
are judged: a signature tree is traversed against itself, its nodes hold the OR
of the token bitmaps below and the range of their sizes, a pair of nodes is
left as soon as the largest overlap it could hold is too small, and what
remains is verified on the whole sets. Large homes are split into blocks.

No pair is lost to the choice of homes: any two sets that are similar enough
share an n-gram among the first few of each in one global order (frequent
n-grams last). Each class enters the buckets of those n-grams; pairs of
different homes that meet there go through a signature tree alike, and what a
bucket's tree leaves is joined to families, which are judged like homes. So a
text travels once to its home and once to its family, not once a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm import words as W
from tradeflow.llm.common import join_counted, lean, release, scratch, text_or_empty
from tradeflow.llm.components import connected_components
from tradeflow.llm.countmin import Repeated, cells_for, repeated_cells, share, split_by_members

#: Bits of a signature in a bucket and the most in a home, children of a tree
#: node, largest bucket without a tree.
BITS, MOST_BITS, FANOUT, SMALL = 1024, 1 << 16, 8, 8
#: Ranges of the hashes whose elements are counted beside a bucket's signature.
RANGES = 128
#: Sets of more n-grams fill a bitmap and such counts; they have four-bit counts
#: of ranges of 4 to 8 n-grams instead, of at least that many ranges.
LONG, LONG_RANGES = 1024, 512
#: At most this many n-grams count as frequent (each in more than that share of
#: all rows); the bound of what is sent to every task.
FREQUENT = 1 << 16
#: Min-hash bands and hashes per band of the homes; leaders that the members of
#: a home are compared with first; members and n-grams of a block.
BANDS, BAND_ROWS, LEADERS, BLOCK, BLOCK_SHINGLES = 6, 3, 3, 2048, 1 << 21
CHUNK = 1 << 22
#: 64-bit words of signatures compared at once, and node pairs opened at once.
PAIR_WORDS, OPEN_PAIRS = 1 << 20, 1 << 12


class Joined(NamedTuple):
    members: DataFrame  # doc_id, text_hash, n_shingles, class_id, group_id, component_id
    links: DataFrame    # a, b (class ids), overlap, together


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Per text the sorted hashes of its distinct n-word shingles (A-Z lowered);
    fewer words than n are one shingle, no words none."""
    for lo, hi, data, offsets in W.pieces(column):
        data = W.lower_ascii(data)
        words = W.split_words(data, offsets)
        hashes = W.hash_words(data, words)
        grams = W.ngrams(hashes, n)
        for a, b in zip(words.first, words.first[1:]):
            if b - a >= n:
                own = np.sort(grams[a:b - n + 1])
                yield own[np.concatenate([[True], own[1:] != own[:-1]])]
            else:
                yield W.ngrams(hashes[a:b], b - a)[:1] ^ np.uint64(b - a) if b > a else grams[:0]


def needed_overlap(total: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of two sets of ``total`` elements together that makes
    100 * overlap >= percent * union."""
    return -(-percent * total // (100 + percent))


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    """First elements in which two similar sets must meet."""
    return size - -(-percent * size // 100) + 1


def _signature(own: np.ndarray, bits: int = BITS) -> np.ndarray:
    out = np.zeros(bits, np.uint8)
    out[(own >> np.uint64(32)).astype(np.int64) % bits] = 1
    return np.packbits(out)


def _histogram(own: np.ndarray) -> np.ndarray:
    """How many elements lie in each of RANGES ranges of the hashes, up to 255."""
    return np.minimum(np.bincount((own >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.int64), minlength=RANGES),
                      255).astype(np.uint8)


def near_histograms(counts: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Indexes of the pairs whose ranges could overlap enough. In a range two
    sets share at most the smaller count; what is over 255 is added as a whole.
    Tells long sets apart, whose bitmaps are full."""
    over = size - counts.sum(axis=1, dtype=np.int64)
    keep = []
    step = max(1, 8 * PAIR_WORDS // RANGES)
    for lo in range(0, len(i), step):
        a, b = i[lo:lo + step], j[lo:lo + step]
        overlap = np.minimum(counts[a], counts[b]).sum(axis=1, dtype=np.int64) + np.minimum(over[a], over[b])
        keep.append(lo + np.flatnonzero(overlap >= needed_overlap(size[a] + size[b], percent)))
    return np.concatenate([np.zeros(0, np.int64), *keep])


def long_counts(own: np.ndarray) -> bytes:
    """Counts of a long set's n-grams by range of their hashes, up to 15, two a byte."""
    ranges = max(LONG_RANGES, 1 << (len(own) // 8 - 1).bit_length())
    counts = np.minimum(np.bincount((own >> np.uint64(64 - ranges.bit_length() + 1)).astype(np.int64), minlength=ranges), 15)
    return (counts[::2] | counts[1::2] << 4).astype(np.uint8).tobytes()


class Prints:
    """What the sets that meet in buckets are compared by: ``bits`` and ``slack``
    for the signature tree (a long set may hold anything) and counts by range."""

    def __init__(self, prints: list[bytes], size: np.ndarray):
        long = size > LONG
        self.size, self.bits = size, np.full((len(size), BITS // 8), 255, np.uint8)
        self.ranges = np.where(long, [2 * len(p) for p in prints], RANGES)
        self.at, self.counts = np.zeros(len(size), np.int64), {}
        for ranges in np.unique(self.ranges * np.where(long, 1, -1)).tolist():  # negative: short sets
            own = np.flatnonzero((self.ranges == abs(ranges)) & (long == (ranges > 0)))
            self.at[own] = np.arange(len(own))
            raw = np.frombuffer(b"".join([prints[k] for k in own]), np.uint8).reshape(len(own), -1)
            if ranges < 0:
                self.bits[own], self.counts[RANGES] = raw[:, :BITS // 8], raw[:, BITS // 8:]
            else:
                self.counts[ranges] = np.stack([raw & 15, raw >> 4], 2).reshape(len(own), ranges)
        self.bits = self.bits.view(np.uint64)
        self.slack = np.where(long, size, size - _pop(self.bits))

    def near(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Indexes of the pairs whose ranges could overlap enough, ascending."""
        keep = [np.zeros(0, np.int64)]
        first, second = np.minimum(self.ranges[i], self.ranges[j]), np.maximum(self.ranges[i], self.ranges[j])
        for few, many in np.unique(np.stack([first, second], 1), axis=0).tolist():
            at = np.flatnonzero((first == few) & (second == many))
            ordered = self.ranges[i[at]] == few
            a, b = np.where(ordered, i[at], j[at]), np.where(ordered, j[at], i[at])
            step = max(1, 8 * PAIR_WORDS // many)
            for lo in range(0, len(at), step):
                u, v = a[lo:lo + step], b[lo:lo + step]
                x, y = self.counts[few][self.at[u]], self.counts[many][self.at[v]]
                over = [self.size[k] - c.sum(axis=1, dtype=np.int64) for k, c in ((u, x), (v, y))]
                if few < many:
                    # Counts cut off at different heights: what is over on either side may be shared.
                    y, over = y.reshape(len(v), few, -1).sum(axis=2, dtype=np.uint16), [over[0] + over[1]]
                overlap = np.minimum(x, y).sum(axis=1, dtype=np.int64) + np.minimum.reduce(over)
                keep.append(at[lo:lo + step][overlap >= needed_overlap(self.size[u] + self.size[v], percent)])
        return np.sort(np.concatenate(keep))


def _pop(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=-1, dtype=np.int64)


class Nodes(NamedTuple):
    """One level of a signature tree (or the members themselves)."""
    bits: np.ndarray       # OR of the signatures below
    least: np.ndarray      # smallest and largest size below
    most: np.ndarray
    slack: np.ndarray      # most elements that share a bit with another of their set
    component: np.ndarray  # the one component below, or -1

    def pairs(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Whether members below i and j could be similar."""
        near = self.most[i] * 100 >= percent * self.least[j]
        near &= self.most[j] * 100 >= percent * self.least[i]
        near &= (self.component[i] != self.component[j]) | (self.component[i] < 0)
        at, keep = np.flatnonzero(near), []
        step = max(1, PAIR_WORDS // self.bits.shape[1])
        for lo in range(0, len(at), step):
            part = at[lo:lo + step]
            a, b = i[part], j[part]
            overlap = _pop(self.bits[a] & self.bits[b]) + np.minimum(self.slack[a], self.slack[b])
            keep.append(part[overlap >= needed_overlap(self.least[a] + self.least[b], percent)])
        return np.concatenate([at[:0], *keep])

    def parents(self) -> Nodes:
        cuts = np.arange(0, len(self.least), FANOUT)
        low, high = np.minimum.reduceat(self.component, cuts), np.maximum.reduceat(self.component, cuts)
        return Nodes(np.bitwise_or.reduceat(self.bits, cuts, axis=0), np.minimum.reduceat(self.least, cuts),
                     np.maximum.reduceat(self.most, cuts), np.maximum.reduceat(self.slack, cuts),
                     np.where(low == high, low, -1))


def traverse(members: Nodes, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members that could be similar, by dual traversal of their tree."""
    levels = [members]
    while len(levels[-1].least) > 1:
        levels.append(levels[-1].parents())

    def down(depth: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        level = levels[depth]
        keep = level.pairs(i, j, percent)
        i, j = i[keep], j[keep]
        if depth == 0:
            yield i, j
            return
        for lo in range(0, len(i), OPEN_PAIRS):
            a = i[lo:lo + OPEN_PAIRS, None] * FANOUT + np.repeat(np.arange(FANOUT), FANOUT)
            b = j[lo:lo + OPEN_PAIRS, None] * FANOUT + np.tile(np.arange(FANOUT), FANOUT)
            a, b = a.ravel(), b.ravel()
            size = len(levels[depth - 1].least)
            ok = (a < size) & (b < size) & (a <= b if depth > 1 else a < b)
            yield from down(depth - 1, a[ok], b[ok])

    if len(levels) > 1:
        yield from down(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))


def judge_home(ids: np.ndarray, sets: list[np.ndarray], block: np.ndarray, judged: np.ndarray, component: np.ndarray,
               percent: int, all_links: bool) -> list[tuple[int, int, int, int]]:
    """Links (a, b, overlap, together) among the members of a home: within the
    block if all have one, else between the two blocks. Pairs with the same
    ``judged`` are left out. Without ``all_links`` enough links to connect what
    is connected, given what ``component`` connects already."""
    size = np.array([len(s) for s in sets])
    order = np.lexsort((ids, size))
    ids, size, block, judged, sets = ids[order], size[order], block[order], judged[order], [sets[i] for i in order]
    across = (block != block[0]).any()
    component = np.arange(len(ids)) if all_links else np.unique(component[order], return_inverse=True)[1]
    links = []

    def judge(i: int, j: int) -> None:
        if judged[i] == judged[j] or across and block[i] == block[j]:
            return
        if 100 * min(size[i], size[j]) < percent * max(size[i], size[j]):
            return
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        union = int(size[i] + size[j]) - both
        if 100 * both >= percent * union:
            a, b = max(ids[i], ids[j]), min(ids[i], ids[j])
            links.append((int(a), int(b), both, union))
            if not all_links:
                component[component == component[j]] = component[i]

    if not all_links:
        for leader in np.argsort(W.mix(ids.view(np.uint64).copy()))[:LEADERS]:
            for i in range(len(ids)):
                if component[i] != component[leader]:
                    judge(int(leader), i)
    bits = min(MOST_BITS, max(256, 1 << int(4 * size.max()).bit_length()))
    prints = np.stack([_signature(s, bits) for s in sets]).view(np.uint64)
    members = Nodes(prints, size, size, size - _pop(prints), component.copy())
    for i, j in traverse(members, percent):
        for x, y in zip(i.tolist(), j.tolist()):
            if component[x] != component[y]:
                judge(x, y)
    return links


def _frequent(rows: DataFrame, n: int) -> np.ndarray:
    """Sorted n-grams that may be in more than 1/FREQUENT of all (document,
    n-gram) rows: each task reports those frequent in a chunk of its own, so
    at most FREQUENT remain over the same threshold in the sum."""
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def chunk():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= max(2, size / FREQUENT)
            return pa.RecordBatch.from_pydict({"key": pa.array(keys[often].view(np.int64)),
                                               "n": pa.array(counts[often]), "total": pa.array(np.where(
                                                   np.arange(often.sum()) == 0, size, 0), pa.int64())})
        for batch in batches:
            for own in shingle_sets(batch.column("text"), n):
                held.append(own)
                size += len(own)
                if size >= CHUNK:
                    yield chunk()
                    held, size = [], 0
        if held:
            yield chunk()

    found = scratch(rows.select("text").mapInArrow(lean(report), "key long, n long, total long")
                    .groupBy("key").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "frequent")
    total = found.agg(F.sum("total")).first()[0] or 0
    least = max(64, total / FREQUENT)
    often = np.array([r["key"] for r in found.filter(F.col("n") >= least).select("key").collect()], np.int64)
    release(found)
    return np.sort(often.view(np.uint64))


def _spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Enough of the pairs to connect what they connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        u, v = root(x), root(y)
        if u != v:
            parent[u] = v
            out.append((x, y))
    return out


def ngram_join(docs: DataFrame, n: int = 5, percent: int = 80, all_links: bool = False) -> Joined:
    """Documents whose n-word shingle sets have a Jaccard similarity of at least
    ``percent`` / 100, exactly.

    members has one row per input row: doc_id, text_hash (xxhash64 of the
    text), n_shingles, class_id (equal sets have equal ids; null for empty
    sets, which link with nothing), group_id (the smallest class_id of the
    component; null like class_id) and component_id, the smallest doc_id
    reachable by links (its own for a document without any; null only where
    every document of the component lacks an id). links has pairs of classes:
    all of them with ``all_links``, else enough to connect every component.
    Null texts count as empty. Repeated rows and ids are kept as they are. An
    empty table gives empty results. Other columns are not read.
    """
    spark = docs.sparkSession
    # (key, text_hash) stands for a row's id and text.
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumns(
        {"text_hash": F.xxhash64("text"), "key": F.xxhash64("doc_id", "text")})
    often = spark.sparkContext.broadcast(_frequent(rows, n))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = often.value
        odd = W.mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_shingles", "node", "bands", "keys", "bits")}
            for own in shingle_sets(batch.column("text"), n):
                out["n_shingles"].append(len(own))
                if not len(own):
                    for k in ("node", "bands", "keys", "bits"):
                        out[k].append(None)
                    continue
                out["node"].append(np.array([W.mix(own ^ np.uint64(k)).sum() for k in (11, 13)]).tobytes())
                least = np.array([(own * k).min() for k in odd]).reshape(BANDS, BAND_ROWS)
                out["bands"].append(W.mix(least.sum(axis=1) + np.arange(BANDS, dtype=np.uint64)).view(np.int64))
                late = np.zeros(len(own), bool)
                if len(frequent):
                    late = frequent[np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)] == own
                first = np.concatenate([own[~late], own[late]])[:prefix_length(len(own), percent)]
                out["keys"].append(first.view(np.int64))
                out["bits"].append(long_counts(own) if len(own) > LONG else _signature(own).tobytes() + _histogram(own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), batch.column("text_hash"), pa.array(out["n_shingles"], pa.int64()),
                 pa.array(out["node"], pa.binary()), pa.array(out["bands"], pa.list_(pa.int64())),
                 pa.array(out["keys"], pa.list_(pa.int64())), pa.array(out["bits"], pa.binary())],
                names=["doc_id", "key", "text_hash", "n_shingles", "node", "bands", "keys", "bits"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    featured = scratch(rows.mapInArrow(lean(features), f"doc_id {kind}, key long, text_hash long, n_shingles long, "
                                                       "node binary, bands array<long>, keys array<long>, bits binary"), "shingles")
    # Equal sets have equal features; any row of a class may stand for it.
    classes = scratch(
        featured.filter("n_shingles > 0").groupBy("node").agg(
            F.min(F.struct("key", "text_hash")).alias("shown"), F.min("doc_id").alias("least_id"),
            F.count("*").alias("copies"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"),
            F.first("keys").alias("keys"), F.first("bits").alias("bits"))
        .withColumn("id", F.monotonically_increasing_id()), "shingle-classes")

    found = scratch(featured.select("doc_id", "text_hash", "n_shingles", "node"), "shingle-counts")
    release(featured)
    shown = classes.select("id", F.col("shown.key").alias("key"), F.col("shown.text_hash").alias("text_hash"))

    def texts_of(wanted: DataFrame) -> DataFrame:
        """``wanted`` (a written table of key, text_hash and more columns) with a
        text of each class."""
        near, _ = split_by_members(rows.select("key", "text_hash", "text"), wanted.select("text_hash"), "text_hash")
        # Repeated rows show the same text: one is enough. The grouping takes
        # the join's partitions as they are.
        return near.join(wanted, ["key", "text_hash"]).groupBy("key", "text_hash").agg(
            *[F.first(c).alias(c) for c in wanted.columns if c not in ("key", "text_hash")], F.first("text").alias("text"))

    def links_within(placed: DataFrame) -> DataFrame:
        """The links among classes of the same home: ``placed`` has id, home,
        judged and component (see ``judge_home``)."""
        placed = scratch(placed.join(classes.select("id", "size"), "id"), "placed")
        crowds = scratch(placed.groupBy("home").agg(F.count("*").alias("n"), F.sum("size").alias("size")).filter("n > 1").select(
            "home", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"), "n"), "crowds")
        crowded = join_counted(placed, crowds, ["home"], "n", placed.count()).withColumn(
            "block", F.pmod(F.xxhash64("id", F.lit(5)), F.col("blocks")).cast("int"))
        # Every pair of a home's blocks is a piece of work of its own.
        wanted = scratch(shown.join(crowded.select("id", "home", "judged", "component", "block", "blocks"), "id"), "wanted")
        work = texts_of(wanted).select(
            "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
            "home", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "id", "block", "judged", "component", "text")
        links = scratch(work.repartition("home", "low", "high").sortWithinPartitions("home", "low", "high")
                        .mapInArrow(lean(judge_homes), "a long, b long, overlap long, together long"), "home-links")
        release(placed, crowds, wanted)
        return links

    def judge_homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by home and blocks; one piece of work is held at a time.
        now, rows, sets = None, [], []

        def links() -> pa.RecordBatch:
            ids, block, judged, component = np.array(rows).T
            found = judge_home(ids, sets, block, judged, component, percent, all_links)
            columns = np.array(found, np.int64).reshape(-1, 4).T
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "overlap", "together"])

        for batch in batches:
            own = zip(*(batch.column(c).to_pylist() for c in ("home", "low", "high", "id", "block", "judged", "component")))
            for row, found in zip(own, shingle_sets(batch.column("text"), n)):
                if row[:3] != now:
                    if len(rows) > 1:
                        yield links()
                    now, rows, sets = row[:3], [], []
                rows.append(row[3:])
                sets.append(found)
        if len(rows) > 1:
            yield links()

    # A class's home is the smallest of the first members of its band groups.
    first = F.min(F.struct(F.xxhash64("id").alias("h"), "id"))
    entries = scratch(classes.select("id", F.posexplode("bands").alias("band", "value")), "band-entries")
    groups = scratch(entries.groupBy("band", "value").agg(first.alias("first"), F.count("*").alias("n")), "band-groups")
    homes = scratch(join_counted(entries, groups, ["band", "value"], "n", entries.count())
                    .groupBy("id").agg(F.min("first")["id"].alias("home")), "homes")
    release(entries, groups)
    links = links_within(homes.select("id", "home", F.col("id").alias("judged"), F.col("id").alias("component")))
    home_components = scratch(connected_components(links), "home-components")
    components = homes.join(home_components, "id", "left").select(
        "id", "home", F.coalesce("component", "id").alias("component") if not all_links
        else F.col("id").alias("component"))

    cells = cells_for(classes.agg(F.sum(F.size("keys"))).first()[0] or 0)

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield W.mix(batch.column("keys").flatten().to_numpy().view(np.uint64).copy())

    sketch = share(repeated_cells(classes.select("keys"), keys_of, cells))

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = Repeated(sketch.value, cells)
        for batch in batches:
            keys = batch.column("keys")
            row = np.repeat(np.arange(len(keys)), np.diff(keys.offsets.to_numpy()))
            flat = keys.flatten().to_numpy()
            at = np.flatnonzero(repeated(W.mix(flat.view(np.uint64).copy())))
            yield pa.RecordBatch.from_arrays([pa.array(flat[at]), batch.column("id").take(pa.array(row[at]))], names=["key", "id"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by key; a bucket may go on in the next batch.
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            key = table.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            yield from candidates(table.slice(0, cut))
            rest = table.slice(cut).combine_chunks().to_batches()[0] if cut < len(key) else None
        if rest is not None:
            yield from candidates(pa.Table.from_batches([rest]))

    def candidates(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not len(table):
            return
        key, ids, home, component, size = (table.column(c).to_numpy() for c in ("key", "id", "home", "component", "size"))
        prints = Prints(table.column("bits").to_pylist(), size)
        all_nodes = Nodes(prints.bits, size, size, prints.slack, component)

        def pair_rows(i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
            apart = home[i] != home[j]  # pairs of one home are judged
            i, j = i[apart], j[apart]
            near = prints.near(i, j, percent)
            pairs = np.array(_spanning(ids[i[near]], ids[j[near]]), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_pydict({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

        cuts = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
        ends = np.append(cuts[1:], len(key))
        mixed = np.minimum.reduceat(component, cuts) < np.maximum.reduceat(component, cuts)
        small = mixed & (ends - cuts <= SMALL)
        a = b = np.zeros(0, np.int64)
        for step in range(1, SMALL):  # small buckets are single leaves, all at once
            start = np.concatenate([np.zeros(0, np.int64), *(cuts[small] + k for k in range(SMALL - step))])
            bound = np.tile(ends[small], SMALL - step)
            start = start[start + step < bound]
            a, b = np.concatenate([a, start]), np.concatenate([b, start + step])
        keep = all_nodes.pairs(a, b, percent)
        yield pair_rows(a[keep], b[keep])
        for lo, hi in zip(cuts[mixed & ~small], ends[mixed & ~small]):
            order = lo + np.lexsort((size[lo:hi], component[lo:hi]))
            for i, j in traverse(Nodes(*(x[order] for x in all_nodes)), percent):
                yield pair_rows(order[i], order[j])

    entered = scratch(classes.select("id", "keys").mapInArrow(lean(enter), "key long, id long").join(homes, "id"), "bucket-entries")
    mixed = entered.groupBy("key").agg(F.min("home").alias("low"), F.max("home").alias("high")).filter("low < high")
    members = (entered.select("key", "id").join(mixed.select("key"), "key")
               .join(components.join(classes.select("id", "size", "bits"), "id"), "id"))
    pairs = (members.select("key", "id", "home", "component", "size", "bits").repartition("key")
             .sortWithinPartitions("key").mapInArrow(lean(meet), "a long, b long").distinct())
    pairs = scratch(pairs, "pairs")
    release(entered)
    families = connected_components(pairs).select("id", F.col("component").alias("family"))
    links = links.unionByName(links_within(components.join(families, "id").select(
        "id", F.col("family").alias("home"), F.col("home").alias("judged"), "component")))
    release(pairs, homes, home_components)

    joined = scratch(connected_components(links), "components")
    named = classes.select("id", "node", "least_id", "copies").join(joined, "id", "left")
    named = named.withColumn("component", F.coalesce("component", "id"))
    reach = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    groups = scratch(named.join(reach, "component").select(
        "node", F.col("id").alias("class_id"), F.col("component").alias("group_id"), "component_id", "copies"),
                     "class-components")
    release(classes, joined)
    base = found.select("doc_id", "text_hash", "n_shingles", "node")
    members = join_counted(base.filter("n_shingles > 0"), groups, ["node"], "copies", found.count())
    names = ["doc_id", "text_hash", "n_shingles", "class_id", "group_id", "component_id"]
    empty = base.filter("n_shingles = 0").select(
        "doc_id", "text_hash", "n_shingles", F.lit(None).cast("long").alias("class_id"),
        F.lit(None).cast("long").alias("group_id"), F.col("doc_id").alias("component_id"))
    return Joined(members.select(*names).unionByName(empty), links)


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (rows
    without an id only where the component has no other), of the smallest text
    hash among rows of that id, and one of identical rows. Texts without words
    link with nothing, so all of them stay."""
    members = scratch(ngram_join(docs, n, percent).members, "members")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    chosen = (members.filter("group_id IS NOT NULL").groupBy("group_id").agg(F.min(rank).alias("best"))
              .select(F.col("best.doc_id").alias("best_id"), F.col("best.text_hash").alias("best_hash")))
    same = members["doc_id"].eqNullSafe(chosen["best_id"]) & (members["text_hash"] == chosen["best_hash"])
    stay = scratch(members.join(chosen, same).groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"))
                   .select(F.col("doc_id").alias("__doc_id"), F.col("text_hash").alias("__hash"), F.col("n").alias("__n")),
                   "stay")
    release(members)
    rows = docs.withColumn("__text_hash", F.xxhash64(text_or_empty()))
    key = rows["doc_id"].eqNullSafe(stay["__doc_id"]) & (rows["__text_hash"] == stay["__hash"])
    kept = rows.join(stay, key)
    wordless = docs.filter(~text_or_empty().rlike("[^ \\t\\n\\x0B\\f\\r]"))
    once = kept.filter("__n = 1").unionByName(kept.filter("__n > 1").dropDuplicates(["__doc_id", "__hash"]))
    return once.select(*docs.columns).unionByName(wordless)
