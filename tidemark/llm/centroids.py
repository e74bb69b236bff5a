"""Centroid clustering over blocks of vectors in Hilbert order, with zone maps.

Vectors become integers, floor(256 x), and are written once as blocks in Hilbert order, each with
the box of its smallest and largest components. In every round the squared distances of a box's
nearest and farthest point to each centroid bound the distances of all its vectors: a centroid whose
least distance exceeds another one's greatest is no candidate for the block. Vectors are compared
exactly with the block's candidates only. All sums are integers, so results do not depend on the
order of rows or on partitions. A task adds up its blocks and emits one row per centroid; the driver
sees ``clusters`` rows per round, and the centroids are the only thing sent back.

Ties go to the smaller centroid. A centroid without vectors stays. Vectors that are null, have
another number of components than asked, or hold null or non-finite ones take no part. Wholly
repeated rows count each; a null vec_id comes last in the choice of first centroids, and rows with
one id are chosen by falling order of their components. Fewer vectors than centroids: every vector
starts one. An empty table gives no rows. A component beyond half a million is refused, as squared
distances would leave the range of a long.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import hilbert
from tidemark.llm.scratch import Scratch


@dataclass(frozen=True)
class Clustering:
    clusters: int = 40
    rounds: int = 5
    width: int = 64
    seed: str = "2"
    curve: hilbert.Curve = field(default_factory=hilbert.Curve)


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to those of ``c``."""
    reach = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * reach * reach < 1 << 53:  # doubles hold every sum exactly
        x, c = x.astype(np.float64), c.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)
    x, c = x.astype(np.int64), c.astype(np.int64)
    return np.stack([((x - one) ** 2).sum(axis=1) for one in c], axis=1)


def box_bounds(low: np.ndarray, high: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of each centroid to points of the box."""
    low, high, c = low.astype(np.int64), high.astype(np.int64), c.astype(np.int64)
    near = np.maximum(0, np.maximum(low - c, c - high))
    far = np.maximum(np.abs(c - low), np.abs(c - high))
    return (near * near).sum(axis=1), (far * far).sum(axis=1)


def nearest(x: np.ndarray, low: np.ndarray, high: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Centroid and squared distance of each vector of a block, and the number of candidates compared."""
    least, most = box_bounds(low, high, c)
    candidates = np.flatnonzero(least <= most.min())  # rising, so that ties go to the smaller number
    d = squared_distances(x, c[candidates])
    best = d.argmin(axis=1)
    return candidates[best], d[np.arange(len(x)), best], len(candidates)


def first_centroids(vectors: DataFrame, p: Clustering) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``; at most ``clusters`` rows reach the driver."""
    by_hash = F.sha2(F.concat(F.lit(p.seed + ":"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(by_hash.asc_nulls_last(), F.desc("q")).limit(p.clusters).select("q").collect()
    return np.array([np.frombuffer(r["q"], np.int32) for r in rows], np.int64).reshape(-1, p.width)


def centroid_sha(c: np.ndarray) -> list[str]:
    return [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]


def _totals(blocks: DataFrame, c: np.ndarray, p: Clustering) -> DataFrame:
    """cluster, n, inertia, total (componentwise): one row per cluster."""
    def add(batches):
        n, inertia, total = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64), np.zeros((len(c), p.width), np.int64)
        for batch in batches:
            for q, low, high in zip(*(batch.column(i).to_pylist() for i in range(3))):
                x, low, high = (hilbert.rows_of([b], p.width) for b in (q, low, high))
                cluster, distance, _ = nearest(x, low[0], high[0], c)
                n += np.bincount(cluster, minlength=len(c))
                np.add.at(inertia, cluster, distance)
                order = np.argsort(cluster, kind="stable")
                own, at = np.unique(cluster[order], return_index=True)
                total[own] += np.add.reduceat(x[order].astype(np.int64), at, axis=0)
        full = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)), pa.array(n[full]), pa.array(inertia[full]), pa.array(total[full].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "inertia", "total"])

    parts = blocks.select("q", "low", "high").mapInArrow(add, "cluster int, n long, inertia long, total array<long>")
    return parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.sum("inertia").alias("inertia"), *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(p.width)])


def kept_vectors(vectors: DataFrame, width: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    rows = rows.where(hilbert.finite("vector") & (F.size("vector") == width))
    return hilbert.integer_rows(rows, "vector", width)


def cluster(vectors: DataFrame, p: Clustering = Clustering(), scratch: Scratch | None = None) -> tuple[DataFrame, np.ndarray]:
    """One row per vector (vec_id, q, cluster, distance, cluster_inertia, inertia), and the final centroids."""
    scratch = scratch or Scratch(vectors.sparkSession, "centroids")
    rows = kept_vectors(vectors, p.width)
    table = hilbert.blocks(scratch, rows, p.width, p.curve)
    flat = table.select(F.explode("vec_id").alias("vec_id"), F.lit(None).cast("binary").alias("q"))
    c = first_centroids(rows, p)
    if not len(c):
        empty = flat.withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long"), "cluster_inertia": F.lit(0).cast("long"), "inertia": F.lit(0).cast("long")})
        return empty, c
    for _ in range(p.rounds):
        for r in _totals(table, c, p).collect():
            c[r["cluster"]] = [r[f"t{i}"] // r["n"] for i in range(p.width)]
    inertia = {r["cluster"]: r["inertia"] for r in _totals(table, c, p).select("cluster", "inertia").collect()}
    whole = sum(inertia.values())

    def assign(batches):
        for batch in batches:
            for ids, q, low, high in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x, low, high = (hilbert.rows_of([b], p.width) for b in (q, low, high))
                own, distance, _ = nearest(x, low[0], high[0], c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(own.astype(np.int32)), pa.array(distance),
                     pa.array([inertia[k] for k in own.tolist()], pa.int64()), pa.array([whole] * len(x), pa.int64())],
                    ["vec_id", "q", "cluster", "distance", "cluster_inertia", "inertia"])

    schema = "vec_id long, q binary, cluster int, distance long, cluster_inertia long, inertia long"
    return table.select("vec_id", "q", "low", "high").mapInArrow(assign, schema), c


def candidates_per_block(vectors: DataFrame, c: np.ndarray, p: Clustering = Clustering(), scratch: Scratch | None = None) -> DataFrame:
    """block, n, candidates: how many centroids the box bounds leave to compare."""
    table = hilbert.blocks(scratch or Scratch(vectors.sparkSession, "centroids"), kept_vectors(vectors, p.width), p.width, p.curve)

    def count(batches):
        for batch in batches:
            low, high = (hilbert.rows_of(batch.column(i).to_pylist(), p.width) for i in (2, 3))
            found = [int((least <= most.min()).sum()) for least, most in (box_bounds(a, b, c) for a, b in zip(low, high))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.int32())], ["block", "n", "candidates"])

    return table.select("block", "n", "low", "high").mapInArrow(count, "block long, n int, candidates int")


def digest(c: np.ndarray, cluster_column: str = "cluster") -> Column:
    """SHA-256 of the components of each row's centroid, as decimal integers joined by commas."""
    return F.element_at(F.array(*map(F.lit, centroid_sha(c) or [""])), F.col(cluster_column) + 1)
