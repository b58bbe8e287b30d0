"""MinHash near-dedup: one-permutation hashing, banded buckets, star-shaped candidates, exact confirmation.

1. One pass over the texts: the set of hashed 5-word shingles, its 128-bit fingerprint,
   and a one-permutation signature (the least hash of each of ``BINS`` equal ranges;
   an empty range copies a random full one, chosen by range and attempt alone).
   Copies (equal sets) collapse to one representative.
2. Bands of ``ROWS`` values make buckets.  Each bucket's least member is the centre of a
   star: one candidate edge per member, so edges never exceed memberships.
3. Candidates are confirmed on whole shingle sets, and confirmed links give components.
4. A star alone can miss a link between two members that are both far from the centre.
   Buckets that still hold several components are therefore searched completely, in
   blocks of bounded size: signatures rule pairs out, whole sets confirm the rest inside
   the task, and only links leave it.  Pairs within one component need no look: they are
   linked already.
5. A bucket of more members than a block (boilerplate that many documents share) is not
   searched pair by pair: its members are dealt again by ``FINE_SEEDS`` signatures of
   other hashes in bands of ``FINE_ROWS`` values, which far fewer unlike sets share, and
   those buckets are searched completely.

With 32 bands of 4, two sets of similarity 0.85 share no bucket with probability 6e-11;
with the 50 finer ones of 5 the chance is 2e-13 (at 0.8: 9e-8 and 2e-9).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import WordHasher, arrow_settings, map_batches, materialise, mix64, row_id, shingles, text_of, words_of
from .graph import components

BINS, ROWS = 128, 4
BLOCK, BLOCK_SHINGLES = 512, 500_000
FINE_SEEDS, FINE_ROWS = 2, 5
BROADCAST_BYTES = 16 << 20
SKETCH_SCHEMA = "uid long, doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, signature binary"
EDGES = (np.arange(BINS + 1, dtype=np.float64) / BINS * 2.0**64)[:BINS].astype(np.uint64)


def one_permutation(values: np.ndarray) -> np.ndarray:
    """The densified signature of a non-empty sorted set of 64-bit hashes."""
    at = np.searchsorted(values, EDGES)
    after = np.append(at[1:], len(values))
    full = after > at
    out = np.zeros(BINS, np.uint64)
    out[full] = values[at[full]]
    left = np.flatnonzero(~full)
    if full.sum() == 1:
        out[left] = out[full][0]
        return out
    attempt = 0
    while len(left):
        attempt += 1
        donor = (mix64(left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt)) >> np.uint64(40)).astype(np.int64) % BINS
        hit = full[donor]
        out[left[hit]] = out[donor[hit]]
        left = left[~hit]
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    parts = signature[: len(signature) // rows * rows].reshape(-1, rows)
    key = np.arange(len(parts), dtype=np.uint64) + np.uint64(1)
    for i in range(rows):
        key = mix64(key + parts[:, i])
    return key


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    hasher = WordHasher()
    for batch in batches:
        rows: list[list] = [[] for _ in range(5)]
        for text in batch["text"].cast(pa.binary()).to_pylist():
            grams = shingles(hasher(words_of(text)))
            one, two = np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), np.int64).tolist()
            values = one_permutation(grams) if len(grams) else None
            for column, value in zip(rows, (len(grams), one, two, band_keys(values).view(np.int64) if len(grams) else [], (mix64(values) >> np.uint64(56)).astype(np.uint8).tobytes() if len(grams) else b""), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        yield pa.RecordBatch.from_arrays([batch["uid"], batch["doc_id"], *(pa.array(c, t) for c, t in zip(rows, kinds, strict=True))], names=[x.split()[0] for x in SKETCH_SCHEMA.split(", ")])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    for batch in batches:
        sets = [shingles(hasher(words_of(t))).tobytes() for t in batch["text"].cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["sid"], pa.array(sets, pa.binary())], names=["sid", "grams"])


def fine_keys(grams: np.ndarray) -> np.ndarray:
    """The keys of the finer bands of a non-empty set, from signatures of independent hashes."""
    seeds = [mix64(grams + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % (1 << 64))) for i in range(FINE_SEEDS)]
    keys = [band_keys(one_permutation(np.sort(x)), FINE_ROWS) for x in seeds]
    return mix64(np.concatenate(keys) + np.repeat(np.arange(FINE_SEEDS, dtype=np.uint64), len(keys[0])))


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [fine_keys(np.frombuffer(g, np.uint64)).view(np.int64) for g in batch["grams"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["sid"], pa.array(keys, pa.list_(pa.int64()))], names=["sid", "bands"])


def _confirm(numerator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= numerator * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _residual(numerator: int):
    """The links of a block: pairs of different components, met first in this band, that their sizes and signatures allow and their sets confirm."""

    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        sid, comp, n = (table[c].to_numpy() for c in ("sid", "comp", "n"))
        sig = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(-1, BINS)
        bands = table["keys"].combine_chunks().flatten().to_numpy().reshape(len(sid), -1)
        sets = [np.frombuffer(x, np.uint64) for x in table["grams"].to_pylist()]
        here, t = int(table["band"][0].as_py()), numerator / 100
        least = t - 4.5 * np.sqrt(t * (1 - t) / np.minimum(n, BINS))
        whole = np.flatnonzero(side == 0)
        other = np.flatnonzero(side == 1)
        one_block = not len(other)
        a, b = [], []
        for k, i in enumerate(whole.tolist()):
            rest = whole[k + 1 :] if one_block else other
            rest = rest[(comp[rest] != comp[i]) & (np.minimum(n[rest], n[i]) * 100 >= numerator * np.maximum(n[rest], n[i]))]
            if len(rest):
                near = (sig[rest] == sig[i]).sum(axis=1) / BINS
                rest = rest[near >= np.where(np.minimum(n[rest], n[i]) < 64, 0.0, np.minimum(least[rest], least[i]))]
                rest = rest[(bands[rest] == bands[i]).argmax(axis=1) == here]
            if len(rest):
                values = np.concatenate([sets[j] for j in rest])
                at = np.minimum(np.searchsorted(sets[i], values), len(sets[i]) - 1)
                common = np.add.reduceat((sets[i][at] == values).astype(np.int64), np.cumsum(n[rest]) - n[rest])
                rest = rest[100 * common >= numerator * (n[rest] + n[i] - common)]
                a += [sid[i]] * len(rest)
                b += sid[rest].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


class NearDuplicates:
    """Classes of documents whose shingle sets are linked, directly or through others."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80):
        self.percent = percent
        self.rows = docs.select(row_id(docs).alias("uid"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))

    def _sets_of(self, ids: DataFrame) -> DataFrame:
        """Shingle sets of the representatives in ``ids(sid)``, from their texts."""
        ids = materialise(ids.distinct(), "wanted")
        small = ids.count() * 16 <= BROADCAST_BYTES
        texts = self.rows.select(F.col("uid").alias("sid"), "text").join(F.broadcast(ids) if small else ids, "sid", "left_semi")
        return materialise(map_batches(texts, _grams, "sid long, grams binary"), "sets")

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` that are linked by their full sets."""
        sets = self._sets_of(pairs.select(F.explode(F.array("a", "b")).alias("sid")))
        joined = pairs.join(sets.select(F.col("sid").alias("a"), F.col("grams").alias("x")), "a").join(sets.select(F.col("sid").alias("b"), F.col("grams").alias("y")), "b")
        return materialise(map_batches(joined.select("a", "b", "x", "y"), _confirm(self.percent), "a long, b long"), "links")

    @staticmethod
    def _mixed(members: DataFrame) -> DataFrame:
        """``key, parts`` of the buckets that hold several components; ``parts`` is the number of blocks of their members."""
        blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
        grouped = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), blocks.alias("parts"))
        return materialise(grouped.where("lo <> hi").select("key", "parts"), "mixed")

    def classes(self) -> DataFrame:
        """Per row: ``uid, doc_id, n_shingles, component_id, keep_row``.

        ``component_id`` is the smallest doc_id of the class; ``keep_row`` marks exactly
        one row of each class (smallest doc_id, then first in the source).  Rows without
        words are linked with nothing and kept.  Rows with a null id take part; a class
        with no other id has a null component_id.  Repeated rows and ids are rows each.
        A text of any length is read whole.  An empty table gives an empty result.
        Columns other than the two named ones are not read.  Ids are integers.
        """
        arrow_settings(self.rows.sparkSession)
        sketches = materialise(map_batches(self.rows, _sketch, SKETCH_SCHEMA), "sketches")
        far = (1 << 63) - 1
        first = F.min(F.struct(F.coalesce("doc_id", F.lit(far)).alias("d"), F.col("uid").alias("u"))).alias("first")
        sets = materialise(sketches.where("n_shingles > 0").groupBy("h1", "h2").agg(F.min("uid").alias("sid"), first, F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands"), F.any_value("signature").alias("signature")), "representatives")

        exploded = sets.select("sid", F.posexplode("bands").alias("band", "key"))
        centres = materialise(exploded.groupBy("key").agg(F.min("sid").alias("centre"), F.count("*").alias("members")).where("members > 1"), "centres")
        buckets = materialise(exploded.join(centres, "key"), "buckets")
        stars = buckets.where("sid <> centre").select(F.col("centre").alias("a"), F.col("sid").alias("b")).distinct()
        sig = sets.select("sid", "n", "signature")
        stars = stars.join(sig.toDF("a", "na", "sa"), "a").join(sig.toDF("b", "nb", "sb"), "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent)
        stars = materialise(map_batches(stars, _near(self.percent), "a long, b long"), "stars")
        links = self._confirmed(stars)

        roots = components(links)
        labelled = buckets.where("members > 2").join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("root", "sid"))
        labelled = materialise(labelled.join(sets.select("sid", "n"), "sid").select("key", "band", "sid", "n", "comp"), "labelled")
        mixed = self._mixed(labelled)
        small = labelled.join(mixed.where("parts = 1"), "key").withColumn("fine", F.lit(0))
        hot = materialise(labelled.join(mixed.where("parts > 1").select("key"), "key", "left_semi").select("sid", "n", "comp").distinct(), "hot")
        fine = materialise(map_batches(self._sets_of(hot.select("sid")), _fine, "sid long, bands array<long>").join(hot, "sid"), "fine")
        dealt = materialise(fine.select("sid", "n", "comp", F.posexplode("bands").alias("band", "key")), "dealt")
        dealt = dealt.join(self._mixed(dealt), "key").withColumn("fine", F.lit(1))
        open_rows = materialise(small.unionByName(dealt), "open")
        short = lambda df, is_fine: df.select("sid", F.transform("bands", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("keys"), F.lit(is_fine).alias("fine"))
        keys = short(sets, 0).unionByName(short(fine, 1))
        texts = sets.select("sid", "signature").join(self._sets_of(open_rows.select("sid")), "sid")
        rows = open_rows.join(keys, ["sid", "fine"]).join(texts, "sid").withColumn("part", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o")
        columns = ("fine", "key", "band", "sid", "comp", "n", "signature", "keys", "grams")
        rows = rows.select(*columns, "part", other).select(*columns, F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"), (F.col("part") > F.col("o")).cast("int").alias("side"))
        rest = rows.groupBy("fine", "key", "i", "j").applyInArrow(_residual(self.percent), "a long, b long")
        more = materialise(rest.distinct(), "residual")

        roots = components(links.union(more)) if not more.isEmpty() else roots
        labels = sets.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("h1", "h2", "first", F.coalesce("root", "sid").alias("root"))
        labels = materialise(labels, "labels")
        firsts = labels.groupBy("root").agg(F.min("first").alias("best"))
        labels = labels.join(firsts, "root").select("h1", "h2", "best")
        out = sketches.select("uid", "doc_id", "n_shingles", "h1", "h2").join(materialise(labels, "classes"), ["h1", "h2"], "left")
        component = F.when(F.col("best").isNull(), F.col("doc_id")).when(F.col("best.d") != far, F.col("best.d"))
        return out.select("uid", "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("best.u") == F.col("uid"), F.lit(True)).alias("keep_row"))


def _near(numerator: int):
    """Keep the pairs whose signatures allow the threshold (4.5 standard errors; small sets all pass)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = numerator / 100
        for batch in batches:
            x = np.frombuffer(b"".join(batch["sa"].to_pylist()), np.uint8).reshape(-1, BINS)
            y = np.frombuffer(b"".join(batch["sb"].to_pylist()), np.uint8).reshape(-1, BINS)
            n = np.minimum(batch["na"].to_numpy(), batch["nb"].to_numpy())
            least = np.where(n < 64, 0.0, t - 4.5 * np.sqrt(t * (1 - t) / np.minimum(n, BINS)))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    return run
