"""Slowly changing dimension, type 2, with deletions derived from absence in full loads.

All rows of one entity are handled by windows over (tenant, entity) ordered by ingest
number, which share one shuffle; deletions get numbers of their own, so rows are sorted
twice.  Files are delivered one after another, so which full loads an entity is absent
from after a row follows from two ordinals: the first full file after the row's own file,
and the number of full files before its successor's file.  Both belong to files, not to
rows: a small table of files is joined by equality after the window, with neither a range
join nor an anti join nor an array of files on each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..columns import BATCH, CHANGED, DELETED, FILE, FULL, GONE, HASH, INGESTED, KEY, MODE, NEW, OPEN_END, SEQ, TENANT
from ..workspace import materialise

#: A table of so many files (a few hundred bytes each) is broadcast; a larger one is joined by shuffles.
BROADCAST_FILES = 50_000
_STAMP = ("lo", "hi", "ts", "batch", "file")


def full_file_bounds(staged: DataFrame) -> DataFrame:
    """First and last ingest number, last ingest time and batch of every full-load file."""
    full = staged.where(F.col(MODE) == FULL)
    return full.groupBy(TENANT, FILE).agg(F.min(SEQ).alias("lo"), F.max(SEQ).alias("hi"), F.max(INGESTED).alias("ts"), F.max(BATCH).alias("batch"))


class Files:
    """The files of staged rows with their ordinals among the full files of their tenant.

    ``of_file``: per (tenant, file) ``_before`` and ``_until``, the number of its tenant's
    full files that begin before it, and before its end (itself included), and ``_fulls``,
    their number in all.  ``full``: per (tenant, ``_n``) the stamp of the n-th full file.
    """

    def __init__(self, staged: DataFrame):
        whole = F.when(F.col(MODE) == FULL, F.col(SEQ))
        found = staged.groupBy(TENANT, FILE).agg(
            F.min(SEQ).alias("_lo"), F.min(whole).alias("lo"), F.max(whole).alias("hi"), F.max(F.when(F.col(MODE) == FULL, F.col(INGESTED))).alias("ts"), F.max(F.when(F.col(MODE) == FULL, F.col(BATCH))).alias("batch")
        )
        found = materialise(found, "files")
        self.small = found.count() <= BROADCAST_FILES
        by_time = Window.partitionBy(TENANT).orderBy("_lo")
        is_full = F.col("lo").isNotNull().cast("int")
        until = F.sum(is_full).over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found = found.withColumn("_until", until).withColumn("_before", until - is_full).withColumn("_fulls", F.sum(is_full).over(Window.partitionBy(TENANT)))
        self.of_file = found.select(F.col(TENANT).alias("_t"), F.col(FILE).alias("_file"), "_before", "_until", "_fulls")
        self.full = found.where("lo IS NOT NULL").select(F.col(TENANT).alias("_t"), F.col("_before").alias("_n"), F.struct(*[F.col(FILE if c == "file" else c).alias(c) for c in _STAMP]).alias("_f"))

    def _sized(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df

    def absences(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_from`` and ``_to``: their entity is absent from the full files of these ordinals (``_to`` left out), until its next row."""
        after = rows.withColumn("_next_file", F.lead(FILE).over(_entity()))
        own = self._sized(self.of_file.select("_t", "_file", F.col("_until").alias("_from"), "_fulls"))
        following = self._sized(self.of_file.select(F.col("_t").alias("_t2"), F.col("_file").alias("_file2"), F.col("_before").alias("_to")))
        met = after.join(own, (F.col(TENANT) == F.col("_t")) & (F.col(FILE) == F.col("_file")), "left").drop("_t", "_file")
        met = met.join(following, (F.col(TENANT) == F.col("_t2")) & (F.col("_next_file") == F.col("_file2")), "left").drop("_t2", "_file2")
        return met.withColumn("_to", F.coalesce("_to", "_fulls")).drop("_fulls", "_next_file")

    def stamped(self, rows: DataFrame, ordinal: str, how: str) -> DataFrame:
        """``rows`` with the stamp ``_f`` of the full file that ``ordinal`` names."""
        return rows.join(self._sized(self.full), (F.col(TENANT) == F.col("_t")) & (F.col(ordinal) == F.col("_n")), how).drop("_t", "_n")


def _entity() -> object:
    return Window.partitionBy(TENANT, KEY).orderBy(SEQ)


def _restamp(columns: list[str], dead: Column) -> list[Column]:
    """The columns of a row, or of its entity's deletion where ``dead``."""
    new = {SEQ: F.col("_f.hi"), INGESTED: F.col("_f.ts"), BATCH: F.col("_f.batch"), FILE: F.col("_f.file"), HASH: F.lit(DELETED), MODE: F.lit(FULL)}
    return [F.when(dead, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in columns]


def deletion_events(staged: DataFrame) -> DataFrame:
    """One row per entity and full file it is absent from: its last row before the file, restamped.

    Entities without a key are never absent.  An empty full load says nothing, for it has no rows.
    """
    files = Files(staged)
    rows = files.absences(staged.where(F.col(KEY).isNotNull())).where("_from < _to")
    rows = rows.withColumn("_k", F.explode(F.sequence(F.col("_from"), F.col("_to") - 1))).drop("_from", "_to")
    return files.stamped(rows, "_k", "inner").select(*_restamp(staged.columns, F.lit(True)))


def events(staged: DataFrame) -> DataFrame:
    """Delivered rows and, after each row that needs it, the first deletion (later ones change nothing)."""
    files = Files(staged)
    gone = F.col(KEY).isNotNull() & (F.col("_from") < F.col("_to"))
    rows = files.absences(staged).withColumn("_k", F.when(gone, F.col("_from"))).drop("_from", "_to")
    rows = files.stamped(rows, "_k", "left")
    both = rows.withColumn("_dead", F.explode(F.when(F.col("_k").isNotNull(), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    return both.select(*_restamp(staged.columns, F.col("_dead")))


def collapse(rows: DataFrame) -> DataFrame:
    """Without rows that repeat their entity's previous hash."""
    before = F.lag(HASH).over(_entity())
    return rows.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") != F.col(HASH))).drop("_before")


def number_versions(changed: DataFrame, event_time: str | None = None) -> DataFrame:
    """Version number, validity and reason of collapsed rows.

    Validity starts at the event time where there is one, for deletions always at the
    ingest time, and ends where the next version starts; an event time that goes
    backwards therefore gives an inverted interval, which is reported elsewhere.
    """
    w = _entity()
    start = F.coalesce(F.col(event_time), F.col(INGESTED)) if event_time else F.col(INGESTED)
    dead = F.col(HASH) == DELETED
    rows = changed.withColumn("version_no", F.row_number().over(w)).withColumn("valid_from", F.when(dead, F.col(INGESTED)).otherwise(start))
    end = F.lit(OPEN_END).cast(dict(rows.dtypes)["valid_from"])
    rows = rows.withColumn("valid_to", F.coalesce(F.lead("valid_from").over(w), end)).withColumn("is_current", F.lead(SEQ).over(w).isNull() & ~dead)
    return rows.withColumn("_change_reason", F.when(dead, GONE).when(F.col("version_no") == 1, NEW).otherwise(CHANGED))


def assign_versions(staged: DataFrame, event_time: str | None = None) -> DataFrame:
    """Versions of every entity: deliveries and derived deletions, resends collapsed, intervals half open."""
    return number_versions(collapse(events(staged)), event_time)
