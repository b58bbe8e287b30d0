"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample and indexes every vector.  A query walks the tree
with a priority queue of nodes by distance to their centres and visits leaves in that
order; the number of visits is the least that reaches the target recall on calibration
queries, whose true neighbours come from brute force over all vectors.

Neighbouring small leaves share a bucket of bounded rows; a large leaf is a bucket of its
own, dealt out in parts, so one hot leaf is many tasks.  A task returns the k best of a
query over all its visited leaves in the bucket.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import map_batches, materialise, share_of

SAMPLE_ROWS, BRANCH, MAX_LEAVES, LEAF_SAMPLE = 20_000, 16, 1024, 40
CALIBRATION_QUERIES, TARGET_RECALL = 128, 0.97
PART_ROWS, PART_QUERIES = 4096, 1024


def kmeans(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    """Centres of Lloyd's algorithm from distinct starting points; fewer where points coincide."""
    points = np.unique(x, axis=0)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        near = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None, :] - 2 * x @ centres.T).argmin(axis=1)


class Tree:
    """nodes[i] = (centres of the children, their node numbers); a negative number -1 - leaf is a leaf."""

    def __init__(self, sample: np.ndarray, leaf_rows: int, seed: int = 5):
        self.nodes: list[tuple[np.ndarray, np.ndarray]] = []
        self.leaves = 0
        rng = np.random.default_rng(seed)
        if len(sample):
            self._grow(sample, max(1, leaf_rows), rng)

    def _grow(self, x: np.ndarray, leaf_rows: int, rng) -> int:
        if len(x) <= leaf_rows or (self.nodes and self.leaves >= MAX_LEAVES) or (x == x[0]).all():
            self.leaves += 1
            return -self.leaves
        centres = kmeans(x, BRANCH, rng)
        number = len(self.nodes)
        self.nodes.append((centres, np.zeros(len(centres), np.int64)))
        near = nearest(x, centres)
        for c in range(len(centres)):
            part = x[near == c]
            self.nodes[number][1][c] = self._grow(part, leaf_rows, rng) if len(part) < len(x) and len(part) else self._leaf()
        return number

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, by the nearest child at each level."""
        at = np.zeros(len(x), np.int64) if self.nodes else np.full(len(x), -1)
        while (at >= 0).any():
            for node in np.unique(at[at >= 0]):
                mine = np.flatnonzero(at == node)
                centres, children = self.nodes[node]
                at[mine] = children[nearest(x[mine], centres)]
        return -1 - at

    def visits(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order."""
        if not self.nodes:
            yield 0
            return
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if node < 0:
                yield -1 - node
                continue
            centres, children = self.nodes[node]
            for d, child in zip(((centres - q) ** 2).sum(axis=1).tolist(), children.tolist(), strict=True):
                heapq.heappush(queue, (d, child))


def _matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.array(rows, np.float64).reshape(len(rows), -1)


def _assign(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["v"], pa.array(tree.assign(_matrix(batch["v"])), pa.int32())], names=["vec_id", "v", "leaf"])

    return run


def top_k(q_ids, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[list, list, list]:
    """The k nearest rows of x to each query, by (distance, id), the query's own id left out."""
    out: tuple[list, list, list] = ([], [], [])
    for qid, v in zip(q_ids, q, strict=True):
        d = np.sqrt(((x - v) ** 2).sum(axis=1))
        some = np.flatnonzero(ids != qid)
        if len(some) > k:
            limit = np.partition(d[some], k - 1)[k - 1]
            some = some[d[some] <= limit]
        some = some[np.lexsort((ids[some], d[some]))][:k]
        out[0].extend([qid] * len(some))
        out[1].extend(ids[some].tolist())
        out[2].extend(d[some].tolist())
    return out


def _brute(q_ids: list[int], q: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, x, leaf = batch["vec_id"].to_numpy(), _matrix(batch["v"]), batch["leaf"].to_numpy()
                a, b, c = top_k(q_ids, q, ids, x, k)
                of = dict(zip(ids.tolist(), leaf.tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64()), pa.array([of[i] for i in b], pa.int32())], names=["query_id", "vec_id", "score", "leaf"])

    return run


def buckets_of(counts: dict[int, int]) -> tuple[dict[int, int], dict[int, int]]:
    """leaf -> bucket, and bucket -> parts.  Leaves in tree order fill a bucket up to ``PART_ROWS`` rows; larger leaves stand alone."""
    of, parts, bucket, filled = {}, {}, -1, PART_ROWS
    for leaf in sorted(counts):
        n = counts[leaf]
        if n > PART_ROWS or filled + n > PART_ROWS:
            bucket, filled = bucket + 1, 0
        of[leaf], parts[bucket] = bucket, -(-n // PART_ROWS)
        filled = PART_ROWS if n > PART_ROWS else filled + n
    return of, parts


def _plan(tree: Tree, visits: int, sizes: dict[int, int], k: int, of: dict[int, int], parts: dict[int, int]):
    """Rows (query, bucket, part, leaves) for the leaves a query visits: ``visits`` of them, and more until k + 1 vectors are in reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for qid, v in zip(batch["vec_id"].to_pylist(), batch["v"].to_pylist(), strict=True):
                seen, reach = 0, 0
                found: dict[int, list[int]] = {}
                for leaf in tree.visits(np.array(v, np.float64)):
                    if leaf in of:
                        found.setdefault(of[leaf], []).append(leaf)
                    seen, reach = seen + 1, reach + sizes.get(leaf, 0)
                    if seen >= visits and reach > k:
                        break
                rows += [(qid, v, bucket, p, leaves) for bucket, leaves in found.items() for p in range(parts[bucket])]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.list_(pa.float64()), pa.int32(), pa.int32(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["query_id", "q", "bucket", "part", "leaves"])

    return run


def _search(k: int):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        a, b, c = [], [], []
        if len(queries) and len(vectors):
            vectors = vectors.sort_by("leaf")
            ids, x, leaf = vectors["vec_id"].to_numpy(), _matrix(vectors["v"]), vectors["leaf"].to_numpy()
            for qid, q, leaves in zip(queries["query_id"].to_pylist(), queries["q"].to_pylist(), queries["leaves"].to_pylist(), strict=True):
                mine = np.isin(leaf, leaves)
                found = top_k([qid], np.array([q], np.float64), ids[mine], x[mine], k)
                for all_, some in zip((a, b, c), found, strict=True):
                    all_.extend(some)
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    return run


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v`` of the rows that take part: an id, and a vector with only finite components, not all zero."""
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0))


def search(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, every: int = 100) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each row whose id is divisible by ``every``.

    Nearness is Euclidean distance in double precision on the original vectors, ties to
    the smaller id; the query's own id is left out.  Rows of another length than the most
    frequent one have no distance to the rest and take no part.  Repeated ids are
    candidates each.  An empty table gives an empty result.
    """
    vectors = usable(table, id_col, vector_col)
    sizes = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return vectors.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    vectors = vectors.where(F.size("v") == sizes["d"])
    sample = share_of(vectors, SAMPLE_ROWS, "vec_id").toPandas().sort_values("vec_id")
    x = np.array(sample["v"].tolist(), np.float64).reshape(len(sample), -1)
    tree = Tree(x, max(LEAF_SAMPLE, len(x) // MAX_LEAVES))
    index = materialise(map_batches(vectors, _assign(tree), "vec_id long, v array<double>, leaf int"), "leaves")
    counts = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}
    of, parts = buckets_of(counts)

    queries = index.where(F.col("vec_id") % every == 0)
    probe = share_of(queries, CALIBRATION_QUERIES, "vec_id").select("vec_id", "v").toPandas().sort_values("vec_id").drop_duplicates("vec_id")
    visits = _calibrate(tree, index, probe, k)

    planned = map_batches(queries.select("vec_id", "v"), _plan(tree, visits, counts, k, of, parts), "query_id long, q array<double>, bucket int, part int, leaves array<int>")
    planned = materialise(planned, "visits")
    asked = {r["bucket"]: r["count"] for r in planned.where("part = 0").groupBy("bucket").count().collect()}
    salts = {bucket: -(-n // PART_QUERIES) for bucket, n in asked.items()}
    spread = F.create_map(*[x for leaf, k_ in of.items() for x in (F.lit(leaf), F.struct(F.lit(k_).alias("b"), F.lit(parts[k_]).alias("p"), F.lit(salts.get(k_, 0)).alias("s")))])[F.col("leaf")]
    salt_of = F.create_map(*[x for k_ in parts for x in (F.lit(k_), F.lit(salts.get(k_, 0)))])[F.col("bucket")]
    left = planned.withColumn("salt", F.pmod(F.xxhash64("query_id"), salt_of).cast("int"))
    right = index.select("vec_id", "v", "leaf", spread.alias("spread")).where("spread.s > 0").withColumn("bucket", F.col("spread.b")).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("spread.p")).cast("int"))
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("spread.s") - 1))).drop("spread")
    keys = ("bucket", "part", "salt")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _calibrate(tree: Tree, index: DataFrame, probe, k: int) -> int:
    """The least number of leaf visits at which the probe queries' true neighbours are found with the target recall."""
    if not len(probe):
        return 1
    q_ids, q = probe["vec_id"].tolist(), np.array(probe["v"].tolist(), np.float64)
    near = map_batches(index, _brute(q_ids, q, k), "query_id long, vec_id long, score double, leaf int")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    true = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "leaf").collect()
    place = {qid: {leaf: i for i, leaf in enumerate(tree.visits(v))} for qid, v in zip(q_ids, q, strict=True)}
    needed = np.sort([place[r["query_id"]][r["leaf"]] + 1 for r in true])
    return int(needed[min(len(needed) - 1, int(np.ceil(TARGET_RECALL * len(needed))) - 1)]) if len(needed) else 1
