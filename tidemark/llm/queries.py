"""The corpus operators as queries over the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import align, brown, decontam, jaccard, minhash, phrases, pii, quality, suffix, template, tokens, toxicity


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return template.extract_main_text(_table(spark, folder, "pages"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.repeat_digests(_table(spark, folder, "documents"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(_table(spark, folder, "documents"))


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return brown.score_documents(_table(spark, folder, "documents"))


def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.duplicate_classes(_table(spark, folder, "documents"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_files(_table(spark, folder, "documents"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.packed(_table(spark, folder, "documents"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contamination_report(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, folder, "documents"))


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.alignment_report(_table(spark, folder, "documents"))


def op13_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.component_report(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_extraction, op2_toxicity, op3_suffix_dedup, op4_quality_rules, op5_lm_scoring,
                            op6_minhash, op7_token_files, op8_packing, op9_decontamination, op10_pii, op11_phrases,
                            op12_alignment, op13_ngram_jaccard)}

_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
#: The measures and rules of ``quality`` written out for DuckDB; windows are compared as text, not by hash.
ORACLES = {"op4_quality_rules": rf"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT row, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS gram,
         unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5),
twice AS (SELECT row, i FROM grams QUALIFY count(*) OVER (PARTITION BY row, gram) > 1),
cover AS (SELECT row, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2), (3), (4)) AS o(k) GROUP BY row),
lines AS (
  SELECT row, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM words),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_alpha,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{Lu}}{{3}}'))) AS n_upper,
         len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop, len(list_distinct(w)) AS n_distinct
  FROM words JOIN lines USING (row) LEFT JOIN cover USING (row)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 15.0 AND n_symbols / n_words <= 0.30
       AND n_dup_lines / n_lines <= 0.50 AND n_repeat_words / n_words <= 0.20 AND n_alpha / n_words >= 0.60
       AND n_upper / n_words <= 0.50 AND n_distinct / n_words >= 0.05 AND 100.0 * (n_stop + 0.25) / n_words >= 0.5 AS kept
FROM b""", "op11_phrases": r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
words AS (SELECT piece, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM pieces),
runs AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)),
f AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*)::HUGEINT AS f FROM runs GROUP BY lang, w1 HAVING count(*) >= 10
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 10
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM runs WHERE w3 IS NOT NULL
            GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10),
splits AS (
  SELECT lang, k, phrase, f AS a, cut, array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[cut + 1:], ' ') AS tail
  FROM f, (VALUES (1), (2)) AS o(cut) WHERE cut < k),
cuts AS (
  SELECT c.lang, c.k, c.phrase, a, l.f AS l, r.f AS r, cut, 1000000 * a * a // (l.f * r.f) AS score
  FROM splits AS c JOIN f AS l ON l.lang = c.lang AND l.phrase = c.head JOIN f AS r ON r.lang = c.lang AND r.phrase = c.tail
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1),
inner_pairs AS (
  SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase, f
  FROM f WHERE k = 3),
longer AS (SELECT lang, phrase, max(f) AS longest FROM inner_pairs GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a,
       l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM cuts JOIN totals USING (lang) LEFT JOIN longer USING (lang, phrase)
WHERE k = 3 OR longest IS NULL OR 100 * longest < 50 * a
QUALIFY rank <= 2000"""}
