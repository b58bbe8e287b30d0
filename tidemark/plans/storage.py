"""Tables as versioned Parquet folders behind views.

Parquet has no MERGE and cannot be overwritten while it is read, so each new state goes
to a folder of its own and a view is pointed at it; readers of the old state keep it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def append(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        """Add rows; readers of the folder see them with the next listing."""
        df.write.mode("append").partitionBy(*partition_by).parquet(self.folder(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.folder(table))

    def _files(self, path: str):
        """(file system, path) in whatever store the root is."""
        jvm = self.spark.sparkContext._jvm
        found = jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), found

    def exists(self, table: str) -> bool:
        store, path = self._files(self.folder(table))
        return store.exists(path)

    def _pointers(self, view: str) -> list[str]:
        store, path = self._files(f"{self.folder(view.replace('.', '/'))}/_pointers")
        return sorted(s.getPath().getName() for s in store.listStatus(path)) if store.exists(path) else []

    def current(self, view: str) -> str:
        """The folder that ``view`` was last pointed at, by any process."""
        names = self._pointers(view)
        if not names:
            raise LookupError(f"{view} was never published")
        return self.spark.read.text(f"{self.folder(view.replace('.', '/'))}/_pointers/{names[-1]}").first()[0]

    def _persist(self, view: str, path: str) -> None:
        """Add a pointer file.  The next number can be created once only, so of two writers at a time one fails."""
        names = self._pointers(view)
        number = int(names[-1].removeprefix("p")) + 1 if names else 0
        store, file = self._files(f"{self.folder(view.replace('.', '/'))}/_pointers/p{number:012d}")
        out = store.create(file, False)
        out.write(bytearray(path.encode()))
        out.close()

    def publish(self, df: DataFrame, view: str, cluster_by: Sequence[str] = (), files: int | None = None, gate: Callable[[DataFrame], DataFrame] | None = None) -> str:
        """Write a new state and point ``view`` at it; returns the folder, which names the state.

        ``gate`` gives the rows of a written state that break a constraint.  If there are
        any, the view stays where it is and an error says how many.

        ``cluster_by`` lays rows out by ranges and sorts them inside files, so that file
        statistics skip what a filter on these columns does not need.
        """
        if cluster_by:
            df = (df.repartitionByRange(files, *cluster_by) if files else df.repartitionByRange(*cluster_by)).sortWithinPartitions(*cluster_by)
        path = f"{self.folder(view.replace('.', '/'))}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        if gate is not None and (bad := gate(self.spark.read.parquet(path)).count()):
            raise ValueError(f"{view}: {bad} rows break a constraint; the state in {path} was not published")
        self.point(view, path)
        return path

    def point(self, view: str, path: str) -> None:
        """Make ``view`` show the state in ``path``: the swap of a rebuild, or the way back.

        The pointer is kept in the store, where other processes find it (``current``).
        """
        self._persist(view, path)
        if "." in view:
            self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
        else:
            self.spark.read.parquet(path).createOrReplaceTempView(view)


def slice_after(df: DataFrame, seq: int, seq_col: str = "_ingest_seq") -> DataFrame:
    """Rows above a cursor; the predicate reaches the files' statistics."""
    return df.where(F.col(seq_col) > seq)


def watermark(df: DataFrame, seq_col: str = "_ingest_seq") -> DataFrame:
    """Per tenant the last number and time, to be taken before the table is read for a build."""
    return df.groupBy("tenant_id").agg(F.max(seq_col).alias("last_ingest_seq"), F.max("_ingest_ts").alias("last_ingest_ts"))
