"""Spelling variant grouping: words one edit apart, and the frequent form behind each.

Method: blocked Gram matrices. Words lie in blocks of one length and one
pattern of letter classes. A numpy product of two blocks' letter counts gives
all squared distances between them; an edit changes the counts by a squared
distance of at most two, so only blocks of the same or the next length whose
patterns can hold such a pair meet, and what the product leaves is checked
letter by letter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import release, scratch
from tradeflow.llm.runs import counted_runs, spans

#: Words have so many code points and occurrences at least.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A near word is a form where it is so many times as frequent.
RATIO = 10
#: One run in so many loses a code point.
DAMAGE = 31
#: Letters of a block, about: larger patterns are split into blocks by hash.
BLOCK_LETTERS = 8192
#: Cells of a distance matrix that a task holds at once.
CELLS = 1 << 22

#: Letters by how common they are, dealt to classes in turn so that classes weigh alike.
COMMON = "etaoinsrhldcumfpgwybvkxjqz"
ALPHABET = [*COMMON, *(chr(c) for c in range(0xC0, 0x100))]
_INDEX = np.zeros(256, np.int64)
_INDEX[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF, of no other character
_OUTSIDE = ~_LETTER
_OUTSIDE[0x80:] = False

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def _letter_runs(least: int):
    """Finder of runs of at least ``least`` letters A-Z, a-z, U+00C0 to U+00FF."""
    def find(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lead = data == _LEAD
        inside = _LETTER[data] | lead
        inside[1:] |= lead[:-1]
        starts, ends = spans(inside, offsets)
        before = np.concatenate([[0], np.cumsum(lead)])
        long = ends - starts - (before[ends] - before[starts]) >= least
        return starts[long], ends[long]
    return find


def crc32_with_prefix(prefix: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, continued from the crc32 ``prefix``."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    state, at, lengths = ~prefix[order].astype(np.uint32), starts[order], lengths[order]
    live = len(order)
    for k in range(int(lengths[0]) if live else 0):
        if live < 64:  # the few longest
            for j in range(live):
                state[j] = ~np.uint32(zlib.crc32(data[at[j] + k:at[j] + lengths[j]].tobytes(), int(~state[j])))
            break
        live = int(np.searchsorted(-lengths, -k, "left"))
        head = state[:live]
        state[:live] = _CRC[(head ^ data[at[:live] + k]) & 0xFF] ^ (head >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    return out


def word_counts(docs: DataFrame, least: int = LEAST_LENGTH, damage: int = DAMAGE) -> DataFrame:
    """(word, n): the runs of letters of all texts after the damage, of ``least``
    code points or more, and how often they occur.

    A run is lower-cased (A-Z only); where the crc32 of ``<doc_id>:<run>`` is a
    multiple of ``damage`` it loses the code point at crc32 modulo its length.
    A null doc_id counts as the empty text, a null text as without runs.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in batch.column("id").to_pylist()], np.uint32)
            for found in counted_runs(batch.column("text"), _OUTSIDE, _letter_runs(least)):
                runs = found.terms
                offsets = np.frombuffer(runs.buffers()[1], np.int64)[runs.offset:runs.offset + len(runs) + 1] if len(runs) \
                    else np.zeros(1, np.int64)
                data = np.frombuffer(runs.buffers()[2], np.uint8) if len(runs) else np.zeros(0, np.uint8)
                crc = crc32_with_prefix(prefix[found.row], data, offsets[:-1][found.term], offsets[1:][found.term])
                hit = crc % np.uint32(damage) == 0
                whole = np.bincount(found.term[~hit], found.count[~hit], len(runs)).astype(np.int64)
                changed: dict[str, int] = {}
                for t, h, n in zip(found.term[hit].tolist(), crc[hit].tolist(), found.count[hit].tolist()):
                    run = runs[t].as_py().decode()
                    word = run[:h % len(run)] + run[h % len(run) + 1:]
                    if len(word) >= least:
                        changed[word] = changed.get(word, 0) + n
                held = np.flatnonzero(whole)
                words = runs.take(pa.array(held)).cast(pa.large_string()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([words, pa.array(list(changed), pa.string())]),
                     pa.array([*whole[held].tolist(), *changed.values()], pa.int64())], names=["word", "n"])

    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_classes(words: int) -> int:
    """Classes of letters that patterns count: more for a larger vocabulary, so
    that blocks stay small. Results do not depend on it."""
    return min(12, max(3, int(math.log2(max(2, words))) // 3))


def _patterns(words: DataFrame, classes: int) -> DataFrame:
    """``words`` with pattern: how many letters of each class a word has."""
    letters = ["".join(ALPHABET[k::classes]) for k in range(classes)]
    counts = [F.length("word") - F.length(F.translate("word", group, "")) for group in letters]
    return words.withColumn("pattern", F.concat_ws(",", *[c.cast("string") for c in counts]))


def _block(codes: np.ndarray) -> np.ndarray:
    """Letter counts of words of one length."""
    n, wide = len(codes), len(ALPHABET)
    flat = (np.arange(n)[:, None] * wide + _INDEX[codes]).ravel()
    kind = np.float32 if codes.shape[1] < 4096 else np.float64  # squares stay exact
    return np.bincount(flat, minlength=n * wide).reshape(n, wide).astype(kind)


def _one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Pairs of words (rows) that differ by exactly one edit; long is as long or one longer."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(1) == 1
    ahead = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(1)
    behind = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= short.shape[1]


def near_pairs(a: np.ndarray, count_a: np.ndarray, b: np.ndarray, count_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of two blocks that are one edit apart.

    ``a`` and ``b`` are code points, words as rows, ``count_*`` their letter
    counts. Squared distances come from Gram products, ``CELLS`` at a time.
    """
    if abs(a.shape[1] - b.shape[1]) > 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    used = count_a.any(0)  # a letter that a lacks adds to b's norm alone
    left = np.ascontiguousarray(count_a[:, used])
    right = np.ascontiguousarray(count_b[:, used].T)
    norm_a, norm_b = np.einsum("ij,ij->i", count_a, count_a), np.einsum("ij,ij->i", count_b, count_b)
    step, found = max(1, CELLS // max(1, len(b))), []
    for lo in range(0, len(a), step):
        squared = norm_a[lo:lo + step, None] + norm_b - 2 * (left[lo:lo + step] @ right)
        i, j = np.nonzero(squared <= 2)
        i = i + lo
        cells = max(1, CELLS // max(1, a.shape[1]))
        for at in range(0, len(i), cells):
            x, y = i[at:at + cells], j[at:at + cells]
            ok = _one_edit(a[x], b[y]) if a.shape[1] <= b.shape[1] else _one_edit(b[y], a[x])
            found.append((x[ok], y[ok]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _best(words: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, other: np.ndarray, other_n: np.ndarray
          ) -> list[tuple[str, int, int, str]]:
    """(word, near words, n of the most frequent, that word) of each word with pairs."""
    if not len(i):
        return []
    _, rank = np.unique(other[j], return_inverse=True)
    order = np.lexsort((rank, -other_n[j], i))
    i, j = i[order], j[order]
    cuts = np.flatnonzero(np.diff(i, prepend=-1))
    many = np.diff(np.append(cuts, len(i)))
    return list(zip(words[i[cuts]].tolist(), many.tolist(), other_n[j[cuts]].tolist(), other[j[cuts]].tolist()))


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): for each word of ``vocabulary`` (word, n)
    with a word one edit away, how many there are and the most frequent of them
    (of equal ones the smallest)."""
    total = vocabulary.count()
    classes = letter_classes(total)
    words = _patterns(vocabulary, classes)
    sizes = words.groupBy("pattern").agg(
        F.ceil(F.sum(F.length("word")) / BLOCK_LETTERS).cast("int").alias("split"))
    placed = (words.join(sizes, "pattern")
              .withColumn("block", F.pmod(F.xxhash64("word"), F.col("split")).cast("int")))

    # One row per block: its words in one string, their counts in an array.
    blocks = scratch(
        placed.groupBy("pattern", "block", "split").agg(F.collect_list(F.struct("word", "n")).alias("held"))
        .select("pattern", "block", "split", F.array_join("held.word", "\n").alias("words"), F.col("held.n").alias("counts")),
        "spelling-blocks")

    # A block is at home in its pattern and a guest wherever a word of it can
    # have a near word: one letter more, or one letter of a lower class for one
    # of a higher. Each pair of patterns meets in one of the two only.
    pattern = F.transform(F.split("pattern", ","), lambda c: c.cast("int"))

    def moved(up: int | None, down: int | None):
        parts = []
        for k in range(classes):
            step = (k == up) - (k == down)
            parts.append(F.element_at("p", k + 1) + step)
        return F.when(F.lit(True) if down is None else F.element_at("p", down + 1) > 0,
                      F.concat_ws(",", *[x.cast("string") for x in parts]))

    targets = [moved(up, None) for up in range(classes)] + [moved(b, a) for a, b in combinations(range(classes), 2)]
    guests = (blocks.withColumn("p", pattern).withColumn("home", F.explode(F.array(F.col("pattern"), *targets)))
              .filter("home IS NOT NULL")
              .join(blocks.select(F.col("pattern").alias("home"), F.col("split").alias("home_split")).distinct(), "home")
              .withColumn("home_block", F.explode(F.expr("sequence(0, home_split - 1)")))
              # Within a pattern each pair of blocks meets once, at the later one.
              .filter("home <> pattern OR home_block >= block")
              .withColumn("guest", ~((F.col("home") == F.col("pattern")) & (F.col("home_block") == F.col("block"))))
              .select("home", "home_block", "guest", "words", "counts"))
    # A home's own block comes first, its guests one after the other: a task
    # holds one pair of blocks, however many guests there are.
    dealt = guests.repartition("home", "home_block").sortWithinPartitions("home", "home_block", "guest")

    def read(packed: str, counts: np.ndarray):
        words = np.array(packed.split("\n"))
        codes = np.frombuffer(packed.replace("\n", "").encode("latin-1"), np.uint8).reshape(len(words), -1)
        return words, counts, codes, _block(codes)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, own = None, None
        for batch in batches:
            out: list[tuple[str, int, int, str]] = []
            numbers, ends = batch.column("counts").values.to_numpy(), batch.column("counts").offsets.to_numpy()
            columns = (batch.column(c) for c in ("home", "home_block", "guest", "words"))
            for k, (where, block, guest, packed) in enumerate(zip(*[c.to_pylist() for c in columns])):
                other = read(packed, numbers[ends[k]:ends[k + 1]])
                if not guest:
                    home, own = (where, block), other
                    i, j = near_pairs(own[2], own[3], own[2], own[3])
                    out += _best(own[0], own[1], i, j, own[0], own[1])
                elif home == (where, block):
                    i, j = near_pairs(own[2], own[3], other[2], other[3])
                    out += _best(own[0], own[1], i, j, other[0], other[1])
                    out += _best(other[0], other[1], j, i, own[0], own[1])
            word, near, n, best = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.int64()),
                                              pa.array(n, pa.int64()), pa.array(best, pa.string())],
                                             names=["word", "n_near", "best_n", "best"])

    parts = dealt.mapInArrow(compare, "word string, n_near long, best_n long, best string")
    return (parts.withColumn("rank", F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
            .groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("rank").alias("rank"))
            .select("word", "n_near", (-F.col("rank.m")).alias("best_n"), F.col("rank.w").alias("best")))


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
             ratio: int = RATIO, damage: int = DAMAGE) -> DataFrame:
    """Every word with its frequent form: word, form, root, n, n_near, form_n.

    Words are the results of ``word_counts`` that occur ``least_count`` times
    or more. Two words are near if one inserted, deleted or replaced code point
    makes one the other. A word's form is its most frequent near word (ties:
    the smallest in code-point order) if that is ``ratio`` times as frequent,
    else null; root follows forms to the last one. Null and empty texts add no
    words, repeated rows count again, texts and words may have any length, an
    empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    vocabulary = scratch(word_counts(docs, least_length, damage).filter(F.col("n") >= least_count), "spelling-words")
    near = near_words(vocabulary)
    isform = F.col("best_n") >= ratio * F.col("n")
    formed = scratch(vocabulary.join(near, "word", "left")
                     .select("word", F.when(isform, F.col("best")).alias("form"), "n",
                             F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                             F.when(isform, F.col("best_n")).alias("form_n")), "spelling-forms")
    # Each step of a chain is ratio times as frequent, which bounds its length;
    # following the followed halves it, so a few joins reach every root.
    most = formed.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most, max(2, ratio))) + 1)
    roots = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    reach = 1
    while reach < steps:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = scratch(roots.join(onward, "root", "left")
                        .select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
        reach *= 2
    out = formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")
