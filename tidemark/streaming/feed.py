"""A change feed as a stream: every micro-batch is appended, the target follows by keys.

The target of a feed depends on the set of its events and not on their order or
repetition, so a batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.cdc import apply_changes
from ..plans.storage import Store


def read_feed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """An append-only folder of feed files as a stream."""
    return spark.readStream.schema(schema).parquet(folder)


def apply_stream(feed: DataFrame, store: Store, target: str, keys: Sequence[str], checkpoint: str, sequence_by: str = "seq", buckets: int = 8, **options):
    """Run all available micro-batches; returns the finished query.

    The log of events is kept by hash bucket of the keys under the batch's number, which
    makes a replayed batch overwrite itself.  ``target_of`` derives the target from it.
    """
    from pyspark.sql import functions as F

    def write(batch: DataFrame, number: int) -> None:
        tagged = batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
        tagged.write.mode("overwrite").partitionBy("_bucket").parquet(f"{store.folder(target)}/log/_batch={number}")

    query = feed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def target_of(store: Store, target: str, keys: Sequence[str], sequence_by: str = "seq", **options) -> DataFrame:
    """The target from the log; events that came twice count once."""
    log = store.spark.read.option("basePath", f"{store.folder(target)}/log").parquet(f"{store.folder(target)}/log").drop("_batch", "_bucket")
    return apply_changes(log, keys, sequence_by, **options)
