"""Source divergence audit: how far the sources of a language differ in their words.

Method: duplicate-text collapse. Identical texts of a language become one row
that carries its number of copies per source; each is tokenised once, and its
term counts and document frequencies are added with those weights. Pairs of
sources are then compared through the terms they hold (sparse), never through
the whole vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.common import release, scratch
from tradeflow.llm.runs import counted_runs, spans, sum_pairs

#: Terms are kept from this many documents of a language on.
LEAST_DOCUMENTS = 10
#: Terms listed per group.
TOP_TERMS = 10
#: Sources that one array of a text's copies may hold; with more sources in the
#: corpus the copies of a text are spread over several rows.
SOURCES_A_ROW = 4096
#: Weighted entries that a task makes at once.
ENTRIES = 1 << 21
SCALE = 1_000_000_000

_INSIDE = np.zeros(256, bool)
_INSIDE[0x41:0x5B] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True


class Audit(NamedTuple):
    pairs: DataFrame  # lang, source, item, value, rank
    terms: DataFrame  # lang, source, item, value, rank


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return spans(_INSIDE[data], offsets)


def _weighted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a batch of distinct texts."""
    copies = batch.column("copies")
    per_row = np.diff(copies.offsets.to_numpy())
    first = copies.offsets.to_numpy()[:-1] - copies.offsets.to_numpy()[0]
    flat = copies.flatten()
    times = flat.field("n").to_numpy()
    langs = batch.column("lang").dictionary_encode()
    sources = flat.field("source").dictionary_encode()
    n_sources = max(1, len(sources.dictionary))
    # The group (lang, source) of each entry of the rows' copies.
    group = (np.repeat(langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), per_row) * n_sources
             + sources.indices.to_numpy(zero_copy_only=False))
    for found in counted_runs(batch.column("text"), ~_INSIDE, _terms):
        wide = per_row[found.row]
        ends = np.cumsum(wide)
        lo = 0
        while lo < len(ends):
            base = ends[lo] - wide[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, base + ENTRIES, "right")))
            own = wide[lo:hi]
            entry = np.arange(own.sum()) + np.repeat(first[found.row[lo:hi]] - (ends[lo:hi] - own - base), own)
            n = times[entry]
            g, t, count, docs = sum_pairs(group[entry], np.repeat(found.term[lo:hi], own), len(found.terms),
                                          n * np.repeat(found.count[lo:hi], own), n)
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(g // n_sources)), sources.dictionary.take(pa.array(g % n_sources)),
                 found.terms.take(pa.array(t)).cast(pa.large_string()).cast(pa.string()), pa.array(count), pa.array(docs)],
                names=["lang", "source", "term", "n", "docs"])
            lo = hi


def term_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, counts): every (lang, source) that occurs, and (lang, source,
    term, n, docs), a term's occurrences and documents in a group.

    Null text, lang and source are the empty string. One text travels once per
    map task that holds it (aggregated before the shuffle), however many copies
    there are; the numbers of copies travel without texts.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = scratch(rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("n")), "divergence-copies")
    groups = scratch(copies.select("lang", "source").distinct(), "divergence-groups")
    parts = 1 + groups.select("source").distinct().count() // SOURCES_A_ROW
    lists = (copies.groupBy("lang", "digest", F.pmod(F.xxhash64("source"), F.lit(parts)).alias("part"))
             .agg(F.collect_list(F.struct("source", "n")).alias("copies")))
    texts = rows.groupBy("lang", "digest").agg(F.any_value("text").alias("text"))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _weighted(batch)

    found = (texts.join(lists, ["lang", "digest"]).select("lang", "text", "copies")
             .mapInArrow(tokenise, "lang string, source string, term string, n long, docs long"))
    counts = scratch(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
                     "divergence-counts")
    release(copies)
    return groups, counts


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact at any size."""
    def wide(c):
        return c.cast("decimal(19,0)")
    return F.call_function("div", (F.lit(SCALE).cast("decimal(10,0)") * wide(count + 2)).cast("decimal(38,0)"),
                           wide(total + 2 * kept)) + 1


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q))."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> Audit:
    """Distances between the sources of each language and each source's own terms.

    Terms are maximal runs of ASCII letters and characters beyond ASCII, A-Z
    lowered, of whole texts of any length; a language keeps those in at least
    ``least`` of its documents (rows; repeated rows count). A share p is
    ``share`` of a term in a group, also where it never occurs there. ``pairs``
    has each ordered pair of sources of a language with the sum of ``distance``
    over all kept terms (0 without any); ``terms`` the ``top`` terms of a group
    whose share is above the language's. ``rank`` counts from 1, ties by the
    UTF-8 order of item. Null text, lang and source are ''; empty texts make a
    group without terms; an empty table gives empty results. Other columns of
    ``docs`` are not read.
    """
    groups, counts = term_counts(docs)
    of_term = Window.partitionBy("lang", "term")
    kept = scratch(counts.withColumn("in_lang", F.sum("docs").over(of_term)).withColumn("lang_n", F.sum("n").over(of_term))
                   .filter(F.col("in_lang") >= least).select("lang", "source", "term", "n", "lang_n"), "divergence-kept")
    langs = (kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n"))
             .groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total")))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    zero = F.lit(0).cast("long")
    sides = scratch(
        groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("v", "lang_total", "total", "held")])
        .withColumn("none", F.when(F.col("v") > 0, share(zero, F.col("total"), F.col("v")))), "divergence-sides")
    shares = scratch(kept.join(sides, ["lang", "source"])
                     .withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
                     .withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("v")))
                     .select("lang", "source", "term", "n", "p", "q", "none"), "divergence-shares")
    release(counts, kept)
    return Audit(_pairs(sides, shares), _own_terms(shares, top))


def _ranked(rows: DataFrame, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rows = rows.withColumn("rank", F.row_number().over(order))
    return rows if top is None else rows.filter(F.col("rank") <= top)


def _own_terms(shares: DataFrame, top: int) -> DataFrame:
    above = shares.filter(F.col("p") > F.col("q"))
    return _ranked(above.select("lang", "source", F.col("term").alias("item"),
                                distance(F.col("p"), F.col("q")).alias("value")), top)


def _pairs(sides: DataFrame, shares: DataFrame) -> DataFrame:
    """The distance is symmetric, so pairs are summed once, a < b: all terms as
    if neither source held them, then what a's, b's and the common ones change."""
    a = sides.select("lang", F.col("source").alias("a"), F.col("none").alias("none_a"), F.col("held").alias("held_a"), "v")
    b = sides.select("lang", F.col("source").alias("b"), F.col("none").alias("none_b"), F.col("held").alias("held_b"))
    both = a.join(b, "lang").filter("a < b")
    absent = distance(F.col("none_a"), F.col("none_b"))
    base = both.select("lang", "a", "b", F.coalesce(
        (F.col("v") - F.col("held_a") - F.col("held_b")) * absent, F.lit(0)).alias("value"))
    # A source's terms of one count share p: they meet the other sources once per count.
    steps = shares.groupBy("lang", "source", "p", "none").agg(F.count("*").alias("terms"))
    other = sides.select("lang", F.col("source").alias("other"), F.col("none").alias("other_none"))
    alone = (steps.join(other, "lang").filter("source <> other")
             .select("lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"),
                     (F.col("terms") * distance(F.col("p"), F.col("other_none"))).alias("value")))
    x = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("none").alias("none_a"))
    y = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("none").alias("none_b"))
    common = (x.join(y, ["lang", "term"]).filter("a < b")
              .select("lang", "a", "b", (distance(F.col("pa"), F.col("pb")) - distance(F.col("pa"), F.col("none_b"))
                                         - distance(F.col("none_a"), F.col("pb")) + absent).alias("value")))
    sums = base.unionByName(alone).unionByName(common).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("way")
    return _ranked(sums.select("lang", "value", ways).select("lang", "way.source", "way.item", "value"))


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """Both parts of ``audit`` as one table: lang, source, part, item, value, rank."""
    found = audit(docs, least, top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (found.pairs.withColumn("part", F.lit("pair")).select(*columns)
            .unionByName(found.terms.withColumn("part", F.lit("term")).select(*columns)))
