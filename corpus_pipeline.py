"""From raw documents to packed sequences: five stages, each one operator of ``tidemark.llm``.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; its result
is written as Parquet and read again as the next stage's ``docs``.  All stages but the
last return the columns of ``documents``, whatever further columns there are and however
they are named.  Null and empty texts, null and repeated ids, repeated rows, texts of any
length and empty tables are fine at every stage: each row is a document of its own, null
text is empty, and no rows give no rows.  ``docs`` must be a stable source (files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, near_dup, packing, quality
from tidemark.llm._shared import materialise, row_id
from tidemark.llm.queries import tokenizer_path

#: SQL can't express the stages; tests hold them against plain versions.
ORACLE_SQL = None


def _columns(rows: DataFrame, like: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in like.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.3); equal texts share one fate."""
    machine = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _columns(quality.score(docs, machine).where("score >= 0.3"), docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that at least 10 of them share; ``n_chars`` follows the text."""
    lines = line_dedup.dedup_lines(docs)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    changed = F.col("n_dropped") > 0
    return lines.select(*[(F.when(changed, new[c]).otherwise(F.col(f"row.`{c}`")) if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five-word shingles, similarity 0.8 or more).

    Of a class the row with the smallest id stays, of rows with one id the first; texts without words all stay.
    """
    work = near_dup.NearDuplicates(docs, percent=80)
    gone = work.classes().where("NOT keep_row").select("uid")
    rows = docs.select(row_id(docs).alias("uid"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    gone = materialise(gone, "duplicates")
    small = gone.count() * 16 <= near_dup.BROADCAST_BYTES
    return _columns(rows.join(F.broadcast(gone) if small else gone, "uid", "left_anti"), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; without items all stay."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _columns(found.where(F.size("hits") == 0), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents; null and empty texts are an end id alone, equal texts are packed as often as they occur."""
    pieces = packing.token_pieces(docs, tokenizer_path("word_bpe_49k.json"))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus from ``documents`` in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
