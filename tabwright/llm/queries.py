"""Registered queries of the text operators, each over its whole table, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import (
    collocations, hard_negatives, licenses, lm_scoring, mixing, pii, quality_rules, repeats, sentencepiece_viterbi, simhash, syncmers, token_files, toxicity,
)
from tabwright.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return register


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("op1_simhash_near_dedup")
def _(spark, sf):
    return simhash.near_duplicates(documents(spark, sf).select("doc_id", "text"))


# Words, lines and 8-word windows of each text; the host verdict with the beta prior of all hosts.
QUALITY_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT row_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM words),
windows AS (
  SELECT row_id, i, n, list(word) OVER (PARTITION BY row_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS win FROM places),
twice AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, win) AS c FROM windows WHERE i + 7 <= n) WHERE c > 1),
covered AS (
  SELECT row_id, count(*) AS n_repeat_words FROM (SELECT DISTINCT row_id, i + unnest(range(8)) AS i FROM twice) GROUP BY row_id),
lines AS (
  SELECT row_id, sum(c - 1) AS n_dup_lines FROM (
    SELECT row_id, line, count(*) AS c FROM (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM words)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id, line) GROUP BY row_id),
counts AS (
  SELECT row_id, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN covered USING (row_id) LEFT JOIN lines USING (row_id)),
rules AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    word_chars < 2 * n_words OR word_chars > 15 * n_words OR 100 * n_symbols > 10 * n_words
      OR 100 * n_dup_lines > 30 * n_words AS shape_failed FROM counts),
hosts AS (SELECT source, count(*) AS docs, count(*) FILTER (WHERE base_failed OR shape_failed) AS failed FROM rules GROUP BY source),
total AS (
  SELECT sum(failed) / sum(docs) AS mean, var_pop(failed / docs) AS spread, avg(1 / docs) AS noise FROM hosts),
prior AS (
  SELECT mean, CASE WHEN spread - mean * (1 - mean) * noise <= 0 THEN 1000.0
    ELSE least(greatest(mean * (1 - mean) / (spread - mean * (1 - mean) * noise) - 1, 2.0), 1000.0) END AS strength FROM total),
rates AS (SELECT source, (mean * strength + failed) / (strength + docs) AS host_rate, 1.5 * mean AS lifted FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_rate <= greatest(0.5, lifted) AS kept
FROM rules JOIN rates ON rules.source IS NOT DISTINCT FROM rates.source
"""


@query("op2_quality_rules", QUALITY_SQL)
def _(spark, sf):
    judged = quality_rules.judge(documents(spark, sf), carry=["doc_id"])
    return judged.select("doc_id", *quality_rules.FEATURES, "base_failed", "kept")


@query("op3_suffix_array_dedup")
def _(spark, sf):
    found = repeats.without_repeats(documents(spark, sf).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_toxicity_neighbours")
def _(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    model = toxicity.train(docs, documents(spark, sf, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model)


@query("op5_sentencepiece_round_trip")
def _(spark, sf):
    return sentencepiece_viterbi.digest(documents(spark, sf))


@query("op6_token_files")
def _(spark, sf):
    return token_files.token_rows(documents(spark, sf).select("doc_id", "text"))


@query("op7_pii_candidates")
def _(spark, sf):
    return pii.span_digest(pii.find_spans(documents(spark, sf).select("doc_id", "text")))


@query("op8_syncmer_fingerprints")
def _(spark, sf):
    return syncmers.edited_neighbours(documents(spark, sf).select("doc_id", "text"), runs=_tasks(spark))


# Sources by rank, their level by capacity per weight, and the running words of a source in hash order.
MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w,
    row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM per_source),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE)
      / CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS level
  FROM ranked WINDOW before AS (ORDER BY CAST(3 * source_size AS DOUBLE) / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * w) AS target FROM levels),
placed AS (
  SELECT s.*, source_size, target,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY h, s.doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      + CAST(size AS DOUBLE) / 2 AS middle
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE least(3, floor(target / source_size)
  + CASE WHEN middle < target - floor(target / source_size) * source_size THEN 1 ELSE 0 END) END * size AS BIGINT) AS taken
FROM placed
"""


@query("op9_curriculum_mixing", MIXING_SQL)
def _(spark, sf):
    mixed = mixing.mix(documents(spark, sf).select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op10_attention_scores")
def _(spark, sf):
    return lm_scoring.lm_scores(documents(spark, sf).select("doc_id", "text"))


# Every anchor against every row; embeddings are lists of FLOAT, whole numbers are exact as DOUBLE.
NEGATIVES_SQL = r"""
WITH rows AS (
  SELECT row_number() OVER () AS row_id, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.row_id AS a_row, a.vec_id AS anchor_id, r.row_id AS r_row, r.vec_id, a.label = r.label AS same,
    CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.row_id <> r.row_id),
positives AS (
  SELECT a_row, anchor_id, r_row, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a_row ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.a_row, p.r_row ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.a_row = p.a_row AND NOT n.same
  AND 80 * positive_score <= 100 * n.score AND n.score <= positive_score
QUALIFY rank <= 5
"""


@query("op11_hard_negative_mining", NEGATIVES_SQL)
def _(spark, sf):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = documents(spark, sf, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


@query("op12_license_notices")
def _(spark, sf):
    return licenses.notice_digest(licenses.find_notices(documents(spark, sf).select("doc_id", "text")))


# All phrases of 1 to 5 words of each piece, counted; cuts, weakest cut, longer phrases of equal count.
PHRASES_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
lengths AS (SELECT lang, w, i, unnest([1, 2, 3, 4, 5]) AS k FROM places),
counts AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f
  FROM lengths WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
cuts AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM counts WHERE k > 1),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, cut, l.f AS l, r.f AS r, n, 1000::HUGEINT * c.f * n // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(w, 1, cut), ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(w, cut + 1, c.k), ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT DISTINCT lang, array_to_string(list_slice(string_split(phrase, ' '), s, s + m - 1), ' ') AS phrase, a
  FROM (SELECT lang, k, phrase, a, unnest(range(2, k)) AS m FROM weakest), unnest(range(1, k - m + 2)) AS t(s))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM weakest w WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = w.lang AND i.phrase = w.phrase AND i.a >= w.a)
QUALIFY rank <= 2000
"""


@query("op13_phrase_collocations", PHRASES_SQL)
def _(spark, sf):
    return collocations.collocations(documents(spark, sf).select("doc_id", "lang", "text"), key="doc_id")
