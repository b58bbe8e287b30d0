"""Helpers that several operators use: shared storage, row ids, word splitting, caches."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space by the contracts: space and 0x09 to 0x0D.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where the session has none, a temporary folder is set if everything runs in one
    process (``local`` masters, as in tests); on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        given = spark.sparkContext._jsc.sc().getCheckpointDir()
        if given.isDefined():
            found = given.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            found = tempfile.mkdtemp(prefix="tidemark-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends at the files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_id(df: DataFrame):
    """A number for each row of a stable source, the same in every read of this session.

    It is the row's place in its input split.  How files are split may depend on the
    number of cores in the cluster at the time, which an executor's loss changes, so the
    first call pins that number for the session (where it is not set already).
    """
    pin_splits(df.sparkSession)
    return F.monotonically_increasing_id()


def pin_splits(spark: SparkSession) -> None:
    key = "spark.sql.leafNodeDefaultParallelism"
    if spark.conf.get(key, None) is None and spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


#: Entries of a worker's cache, and the longest key that is remembered: together they bound its bytes (about 80 MB).
CACHE_ENTRIES, CACHE_KEY = 400_000, 64
#: Bytes of an Arrow batch on its way to Python, where the session does not say.
BATCH_BYTES = "4m"


def process_cache(name: str) -> dict:
    """A dictionary of the Python worker, kept across its tasks.  A worker has one at a time: asking for another drops it."""
    caches = sys.__dict__.setdefault("_tidemark_caches", {})
    if name not in caches:
        caches.clear()
    return caches.setdefault(name, {})


def give_back() -> None:
    """Return memory that Arrow and the allocator hold free to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def _tidy(run: Callable) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def arrow_settings(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, for a batch of the default 10,000 rows may hold 10,000 long texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH_BYTES)


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` over batches of bounded bytes; a worker gives its free memory back when a task ends."""
    arrow_settings(df.sparkSession)
    return df.mapInArrow(_tidy(run), schema)


def text_of(name: str = "text"):
    """The text column with null read as empty."""
    return F.coalesce(F.col(f"`{name.strip('`')}`").cast("string"), F.lit(""))


def fold(mod: int, id_col: str = "doc_id"):
    """crc32 of the id as text, modulo ``mod``; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def ascii_lower(column):
    """Lower-case A-Z only."""
    return F.translate(column, UPPER, UPPER.lower())


def words_of(data: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text with A-Z lower-cased (bytes methods are ASCII-only)."""
    return data.lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), applied to a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Memory:
    """Values of words, remembered in a Python worker up to a bound.

    A full memory stays as it is, for it has the frequent words, until as many unknown
    words have come by as it holds; then it begins anew.
    """

    SLICE = 1 << 16

    def __init__(self, value_of: Callable, known: dict, bound: int = CACHE_ENTRIES):
        self.value_of, self.known, self.bound, self.strange = value_of, known, bound, 0

    def values(self, words: list, use: Callable[[Iterator], object]):
        """``use`` of the values of at most ``SLICE`` words in order."""
        known = self.known
        try:
            return use(map(known.__getitem__, words))
        except KeyError:
            pass
        fresh = {w: self.value_of(w) for w in set(words).difference(known)}
        known.update(fresh)
        try:
            return use(map(known.__getitem__, words))
        finally:
            if len(known) > self.bound:
                self.strange += len(fresh)
                if self.strange > self.bound:
                    known.clear()
                    self.strange = 0
                else:
                    self.forget(fresh)
            else:
                self.forget([w for w in fresh if len(w) > CACHE_KEY])

    def forget(self, words) -> None:
        for w in words:
            del self.known[w]


class WordHasher:
    """64-bit hashes of words."""

    def __init__(self):
        import xxhash

        self.memory = Memory(xxhash.xxh3_64_intdigest, process_cache("word-hash"))

    def __call__(self, words: list[bytes]) -> np.ndarray:
        n = Memory.SLICE
        if len(words) > n:
            return np.concatenate([self(words[at : at + n]) for at in range(0, len(words), n)])
        return self.memory.values(words, lambda values: np.fromiter(values, np.uint64, len(words)))


def hash_rows(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` neighbours; order matters."""
    out = np.full(len(hashes) - n + 1, 0x9E3779B97F4A7C15, np.uint64)
    for i in range(n):
        out = mix64(out + hashes[i : len(hashes) - n + 1 + i] + np.uint64(i + 1))
    return out


def shingles(hashes: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``n``-word shingles; fewer words make one shingle, no word none."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    return np.unique(hash_rows(hashes, min(n, len(hashes))))


def share_of(df: DataFrame, rows: int, *cols: str) -> DataFrame:
    """All rows where there are at most ``rows``; else those whose hash of ``cols`` falls in a share that holds about ``rows``."""
    n = df.count()
    return df if n <= rows else df.where(F.pmod(F.xxhash64(*cols, F.lit(7)), F.lit(1 << 30)) < int((1 << 30) * rows / n))
