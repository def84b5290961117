"""Queries of the corpus operators over the test tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tradeflow.llm.exact_dedup import exact_dedup
from tradeflow.llm import quality, toxicity
from tradeflow.llm.decontamination import contamination
from tradeflow.llm.divergence import divergence
from tradeflow.llm.learning import fold
from tradeflow.llm.line_dedup import remove_boilerplate
from tradeflow.llm.lm_scoring import lm_scores
from tradeflow.llm.ngram_join import ngram_join
from tradeflow.llm.packing import pack
from tradeflow.llm.secret_scan import scan
from tradeflow.llm.spelling import variants
from tradeflow.llm.substring_dedup import substring_dedup
from tradeflow.llm.warc import archive_pages, read_records


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the normalised archives of all pages hold."""
    return read_records(archive_pages(_table(spark, sf_dir, "pages"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN response_id END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS response_id,
             payload_bytes >= 100 AND page_id > min(page_id) OVER (PARTITION BY payload_digest) AS revisit
      FROM (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
                   octet_length(encode(coalesce(html, ''))) AS payload_bytes
            FROM pages))
"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the lines that occur on many sites."""
    cut = remove_boilerplate(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP2_SQL = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         string_split(coalesce(text, ''), chr(10)) AS all_lines
  FROM documents),
lines AS (
  SELECT r, source, p, line, trim(line, ' ') AS bare
  FROM (SELECT r, source, unnest(all_lines) AS line, generate_subscripts(all_lines, 1) AS p FROM texts)),
spread AS (
  SELECT bare FROM lines WHERE length(bare) >= 20 GROUP BY bare HAVING count(DISTINCT source) >= 10),
hits AS (SELECT r, p, length(bare) AS chars FROM lines SEMI JOIN spread USING (bare)),
cut AS (
  SELECT r FROM hits JOIN texts USING (r) GROUP BY r, text HAVING sum(chars) <= 0.5 * length(text)),
kept AS (
  SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS text
  FROM lines ANTI JOIN (SELECT r, p FROM hits SEMI JOIN cut USING (r)) gone USING (r, p) GROUP BY r)
SELECT doc_id, len(all_lines) AS n_lines, len(all_lines) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS text_sha256
FROM texts LEFT JOIN kept USING (r)
"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned without the held-out fold."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = quality.score(docs, quality.fit(docs, labels.filter(fold("doc_id", 5) != 0)))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 4096 ids."""
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds."""
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "start")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned without the held-out fold."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels.filter(fold("doc_id", 4) != 2)))
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= 0.3).cast("int").alias("predicted"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the copy that stays for it."""
    return exact_dedup(_table(spark, sf_dir, "documents"))


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's stupid-backoff score by the rest of the corpus."""
    scored = lm_scores(_table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"))


OP8_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
positions AS (
  SELECT r, word, lag(word) OVER (PARTITION BY r ORDER BY p) AS before
  FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM texts)),
counted AS (
  SELECT r, count(*) OVER (PARTITION BY before, word) - 1 AS seen,
         count(*) OVER (PARTITION BY before) - 1 AS one,
         count(*) OVER (PARTITION BY word) - 1 AS alone, count(*) OVER () - 1 AS total
  FROM positions),
scores AS (
  SELECT r, count(*) AS n, sum(CASE WHEN seen > 0 THEN ln(seen / one)
                                    ELSE ln(0.4) + ln(greatest(alone, 0.5)) - ln(total) END) AS score
  FROM counted GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_words, round(coalesce(score, 0), 4) AS log_score
FROM texts LEFT JOIN scores USING (r)
"""


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents by the Jaccard similarity of their 4-word shingles."""
    found = ngram_join(_table(spark, sf_dir, "documents"), n=4, percent=85)
    return found.members.select("doc_id", "n_shingles", "component_id")


OP9_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(words[s:s + 3], ' ') AS shingle
  FROM (SELECT r, words, unnest(range(1, greatest(1, len(words) - 3) + 1)) AS s FROM texts WHERE len(words) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
pairs AS (
  SELECT a.r AS x, b.r AS y, count(*) AS shared FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.r <> b.r GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes a ON a.r = x JOIN sizes b ON b.r = y
  WHERE 100 * shared >= 85 * (a.n + b.n - shared)),
reach(r, s) AS (SELECT x, y FROM links UNION SELECT reach.r, y FROM reach JOIN links ON s = x)
SELECT doc_id, coalesce(n, 0) AS n_shingles,
       least(doc_id, (SELECT min(t.doc_id) FROM reach JOIN texts t ON t.r = s WHERE reach.r = texts.r)) AS component_id
FROM texts LEFT JOIN sizes USING (r)
"""


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What removing repeated windows of 35 words leaves of each document."""
    done = substring_dedup(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
windows AS (
  SELECT r, s, array_to_string(words[s:s + 34], ' ') AS sequence
  FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS s FROM texts)),
repeated AS (
  SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY sequence) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM repeated),
kept AS (
  SELECT w.r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept
  FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM texts) w
  ANTI JOIN gone g USING (r, p) GROUP BY w.r)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and each source's own terms."""
    return divergence(_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents),
terms AS (
  SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM texts),
kept AS (
  SELECT lang, term, count(*) AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
own AS (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sides AS (SELECT DISTINCT lang, source FROM texts),
dense AS (
  SELECT s.lang, s.source, k.term, coalesce(o.n, 0) AS n, k.n AS lang_n
  FROM sides s JOIN kept k USING (lang) LEFT JOIN own o USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER grp + 2 * count(*) OVER grp) AS p,
         1 + (1000000000::HUGEINT * (lang_n + 2)) // (sum(lang_n) OVER grp + 2 * count(*) OVER grp) AS q
  FROM dense WINDOW grp AS (PARTITION BY lang, source)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM sides a JOIN sides b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with the frequent form that it is one edit away from."""
    return variants(_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
              lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) x(i)),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{7,}')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
hashed AS (
  SELECT run, n, 4294967295 - list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(
             string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
             lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END))::UBIGINT[]),
             lambda c, b: xor(t[(xor(c, b) & 255)::BIGINT + 1], c >> 8)) AS h
  FROM (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL), crc_table),
damaged AS (
  SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2)
              ELSE run END AS word, n
  FROM hashed),
vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gaps AS (
  SELECT word, p, substring(word, 1, p::INT - 1) || substring(word, p::INT + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM vocabulary)),
shorter AS (SELECT DISTINCT g.word, v.word AS other FROM gaps g JOIN vocabulary v ON g.rest = v.word),
near AS (
  SELECT a.word, b.word AS other FROM gaps a JOIN gaps b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT word, other FROM shorter UNION ALL SELECT other, word FROM shorter),
counted AS (
  SELECT near.word, other, v.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY v.n DESC, other) AS place
  FROM near JOIN vocabulary v ON other = v.word),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * v.n THEN other END AS form,
         CASE WHEN other_n >= 10 * v.n THEN other_n END AS form_n
  FROM vocabulary v LEFT JOIN counted c ON c.word = v.word AND place = 1),
followed(word, root) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT f.word, formed.form FROM followed f JOIN formed ON formed.word = f.root WHERE formed.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT followed.word, root FROM followed JOIN formed ON formed.word = root
                    WHERE formed.form IS NULL) r USING (word)
"""


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets."""
    return scan(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_warc, op2_line_dedup, op3_quality, op4_packing, op5_decontamination, op6_toxicity,
        op7_exact_dedup, op8_lm_scoring, op9_ngram_join, op10_substring_dedup, op11_divergence, op12_spelling,
        op13_secrets)} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """The other queries have no SQL form; tests hold them against brute force."""
    return {"op1_warc": OP1_SQL, "op2_line_dedup": OP2_SQL, "op7_exact_dedup": OP7_SQL, "op8_lm_scoring": OP8_SQL,
            "op9_ngram_join": OP9_SQL,
            "op10_substring_dedup": OP10_SQL, "op11_divergence": OP11_SQL, "op12_spelling": OP12_SQL}
