"""The registered queries of this subpackage and, where SQL can say it, their DuckDB form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontaminate, html_extract, line_dedup, lm_scoring, near_dup, packing, quality, token_counts, toxicity
from ._shared import fold

#: White space of the contracts in DuckDB.
_SPACES = "' '||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, tokenizer_path("word_bpe_49k.json"))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_token_counts(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    evidence = F.aggregate("passages", F.lit(0.0), lambda total, p: total + p["evidence"])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"), evidence.alias("evidence"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(_table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lines.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (SELECT doc_id, pos, line, translate(trim(line, {_SPACES}), {_LOWER}) AS key FROM lines),
frequent AS (SELECT key, true AS bad FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(bad) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE bad IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent USING (key) GROUP BY doc_id
"""


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = quality.fit(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, machine).select("row.doc_id", "score")
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", (F.size("hits") > 0).alias("contaminated"), F.col("hits.item_id").alias("item_ids"), F.col("hits.edits").alias("edits"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dup.NearDuplicates(_table(spark, sf_dir, "documents"), percent=85).classes()
    return classes.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP10_SQL = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS grams FROM split),
rows AS (SELECT doc_id, unnest(grams) AS gram FROM sets),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM rows a JOIN rows b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sets s ON s.doc_id = x JOIN sets t ON t.doc_id = y
  WHERE 100 * common >= 85 * (len(s.grams) + len(t.grams) - common)),
near AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT near.x, reach.other FROM reach JOIN near ON near.y = reach.doc_id),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(grams) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""


def queries() -> dict:
    found = (
        op1_best_fit_packing,
        op2_token_counts,
        op3_lm_scoring,
        op4_toxicity,
        op5_html_extraction,
        op6_line_dedup,
        op7_nearest_neighbours,
        op8_quality_classifier,
        op9_benchmark_decontamination,
        op10_minhash_near_dedup,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op6_line_dedup": OP6_SQL, "op10_minhash_near_dedup": OP10_SQL}
