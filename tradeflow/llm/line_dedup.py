"""Cross-site boilerplate lines, by HyperLogLog sketches of their sites.

One sketch of sites per line hash merges by aggregation, map-side first, so a
line in a third of all documents costs one sketch a task. Lines whose estimate
is clearly above or below the threshold are decided by it; for those near it
the distinct sites are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import join_counted, release, scratch, text_or_empty
from tradeflow.llm.ngram_join import ngram_join

#: Distinct sites from which a line is boilerplate, and the characters (without
#: outer spaces) that a line must have to be judged at all.
MIN_SITES, MIN_CHARS = 10, 20
#: A document that would lose more than this share of its characters keeps all
#: lines if it is a copy, which is for document-level stages to judge; whether
#: it is one is tested with ``prove_copies`` only.
MAX_SHARE = 0.5
#: log2 of a sketch's registers; standard errors that count as near.
LG_REGISTERS, NEAR = 10, 6


def _keys(line: Column) -> list[Column]:
    """128 bits of hash as two numbers."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]


def _lines(docs: DataFrame, min_chars: int, *extra: str) -> DataFrame:
    """A row per judged line: its key, position, characters, and ``extra``."""
    lines = docs.select(*extra, F.posexplode(F.split(text_or_empty(), "\n")).alias("position", "line"))
    lines = lines.withColumn("line", F.trim("line")).withColumn("chars", F.char_length("line"))
    return lines.filter(F.col("chars") >= min_chars).select(*extra, "position", "chars", *_keys(F.col("line")))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Keys (h1, h2) and number of occurrences n of the lines that occur in at
    least ``min_sites`` distinct sites (column source; null is no site)."""
    lines = _lines(docs, min_chars, "source")
    total = lines.count()
    spread = scratch(lines.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("source", F.lit(LG_REGISTERS)).alias("sites"), F.count("*").alias("n"))
        .withColumn("sites", F.hll_sketch_estimate("sites"))
        # Fewer occurrences than sites asked for, or far below the threshold.
        .filter((F.col("n") >= min_sites) & (F.col("sites") >= min_sites - _margin(min_sites))), "line-spread")
    near = spread.filter(F.col("sites") <= min_sites + _margin(min_sites))
    exact = (join_counted(lines, scratch(near, "near-lines"), ["h1", "h2"], "n", total)
             .groupBy("h1", "h2").agg(F.count_distinct("source").alias("exact")))
    return spread.join(exact, ["h1", "h2"], "left").filter(
        F.coalesce("exact", "sites") >= min_sites).select("h1", "h2", "n")


def _margin(min_sites: int) -> float:
    return 1 + NEAR * 1.04 / 2 ** (LG_REGISTERS / 2) * min_sites


def _copies(over: DataFrame, min_sites: int) -> DataFrame:
    """Text hashes and number of rows __n of the near copies (as of the stage that
    keeps one of them) that stand on ``min_sites`` distinct sites; ``over`` has
    __hash, text and source."""
    texts = over.groupBy("__hash").agg(F.first("text").alias("text"), F.count("*").alias("__n"))
    texts = scratch(texts.withColumnRenamed("__hash", "doc_id"), "dominated-texts")
    members = scratch(ngram_join(texts).members.filter("group_id IS NOT NULL").select(
        F.col("doc_id").alias("__hash"), "group_id"), "dominated-groups")
    sites = (over.select("__hash", "source").distinct().join(members, "__hash")
             .groupBy("group_id").agg(F.count_distinct("source").alias("sites")).filter(F.col("sites") >= min_sites))
    return (members.join(sites.select("group_id"), "group_id")
            .join(texts.select(F.col("doc_id").alias("__hash"), "__n"), "__hash").select("__hash", "__n"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS,
                       max_share: float = MAX_SHARE, prove_copies: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines cut from text, and the columns n_lines and
    n_removed (replacing columns of these names; n_chars, if there, is the new
    text's length).

    ``docs`` has doc_id, text and source. Lines are compared without outer
    spaces; shorter ones than ``min_chars`` always stay. A null text stays null
    and an empty one empty; each has one line that is never removed. Repeated
    rows lose the same lines. A document that would lose more than
    ``max_share`` of its characters is left whole; with ``prove_copies`` only if
    it is one of near copies that stand on ``min_sites`` sites themselves, any
    other one loses its lines.
    """
    rows = docs.drop("n_lines", "n_removed").withColumn("__text_hash", F.xxhash64(text_or_empty()))
    found = scratch(boilerplate(docs, min_sites, min_chars), "boilerplate")
    lines = _lines(rows.select("doc_id", "text", F.col("__text_hash").alias("text_hash")), min_chars,
                   "doc_id", "text_hash")
    # Repeated rows give each position several times; a set is enough.
    marks = (join_counted(lines, found, ["h1", "h2"], "n", lines.count())
             .groupBy(F.col("doc_id").alias("__doc_id"), F.col("text_hash").alias("__hash"))
             .agg(F.collect_set(F.struct("position", "chars")).alias("__marks")))
    same = rows["doc_id"].eqNullSafe(marks["__doc_id"]) & (rows["__text_hash"] == marks["__hash"])
    lost = F.aggregate("__marks", F.lit(0), lambda s, m: s + m["chars"])
    little = lost <= max_share * F.char_length("text")
    cut = F.col("__marks").isNotNull() & little
    if prove_copies:
        marks = scratch(marks, "line-marks")
        same = rows["doc_id"].eqNullSafe(marks["__doc_id"]) & (rows["__text_hash"] == marks["__hash"])
        over = scratch(rows.join(marks, same).filter(~little).select("__hash", "text", "source"), "dominated")
        copies = scratch(_copies(over, min_sites), "copies")
        marks = join_counted(marks, copies, ["__hash"], "__n", over.count(), "left")
        release(over)
        same = rows["doc_id"].eqNullSafe(marks["__doc_id"]) & (rows["__text_hash"] == marks["__hash"])
        cut = F.col("__marks").isNotNull() & (little | F.col("__n").isNull())
    every = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("__marks")["position"])
    kept = F.concat_ws("\n", F.transform(stay, lambda i: F.get(every, i)))
    out = rows.join(marks, same, "left").withColumns({
        "n_lines": F.size(F.split(text_or_empty(), "\n")).cast("long"),
        "n_removed": F.when(cut, F.size("__marks")).otherwise(0).cast("long"),
        "text": F.when(cut, kept).otherwise(F.col("text"))})
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*rows.drop("__text_hash").columns, "n_lines", "n_removed")
