"""Blocks of integer vectors in Hilbert order, with a zone map (smallest and largest component) per block.

Components x become floor(256 * x), x as double. The dimensions that vary most are quantised around
their mean and give each vector its place on a Hilbert curve; rows are range-partitioned and sorted
by that place, and every ``size`` consecutive rows of a partition are one block, one row of a
Parquet table. Places only decide which rows share a block: any order gives right results, a good
one gives narrow boxes. Equal vectors are dealt on by row key, so a vector that very many rows
share fills many blocks and partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

LARGEST = 1 << 27  # of a component: sums of squares over hundreds of dimensions stay within a long


@dataclass(frozen=True)
class Curve:
    dims: int = 15
    bits: int = 4  # dims * bits below 64
    size: int = 256  # rows of a block


def finite(vector: str):
    """Not null, and no component null or non-finite."""
    return F.col(vector).isNotNull() & F.forall(
        F.col(vector).cast("array<double>"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def scaled(flat: np.ndarray) -> np.ndarray:
    """floor(256 x) as integers; a component beyond the range of exact distances is refused."""
    x = np.floor(256 * np.asarray(flat, np.float64))
    if len(x) and np.abs(x).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST // 256} has no exact distance in a long")
    return x.astype(np.int32)


def place(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with coordinates below 2**bits (Skilling's transform)."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(set_, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn, q = np.zeros(x.shape[1], np.int64), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    out = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def rows_of(blobs: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.int32).reshape(-1, width)


def integer_rows(vectors: DataFrame, vector: str, width: int) -> DataFrame:
    """The rows with their vector as ``q`` (bytes of 32-bit integers) in place of ``vector``; shorter ones end in zeros."""
    others = [c for c in vectors.columns if c != vector]
    full = F.slice(F.concat(F.col(vector).cast("array<double>"), F.array_repeat(F.lit(0.0), max(width, 1))), 1, max(width, 1))
    rows = vectors.select(*others, full.alias("q"))

    def run(batches):
        for batch in batches:
            q = scaled(batch.column(len(others)).flatten().to_numpy()).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([r.tobytes() for r in q], pa.binary())], [*others, "q"])

    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes[:-1]), "q binary"]))


def blocks(scratch: Scratch, rows: DataFrame, width: int, p: Curve = Curve()) -> DataFrame:
    """One row per block: block, n, one list for each column of ``rows (..., q)``, low, high."""
    others = [c for c in rows.columns if c != "q"]

    def moments(batches):
        total, square, n = np.zeros(width), np.zeros(width), 0
        for batch in batches:
            x = rows_of(batch.column(0).to_pylist(), width).astype(np.float64)
            total, square, n = total + x.sum(axis=0), square + (x * x).sum(axis=0), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()]), pa.array([square.tolist()])], ["n", "total", "square"])

    # One row per task, summed by Spark: only `width` sums reach the driver.
    sums = rows.select("q").mapInArrow(moments, "n long, total array<double>, square array<double>").select(
        "n", F.posexplode(F.arrays_zip("total", "square"))).groupBy("pos").agg(F.sum("n"), F.sum("col.total"), F.sum("col.square")).collect()
    n, mean, deviation = 0, np.zeros(width), np.zeros(width)
    for pos, n, total, square in sums:
        mean[pos] = total / max(n, 1)
        deviation[pos] = np.sqrt(max(0.0, square / max(n, 1) - mean[pos] ** 2))
    chosen = np.argsort(-deviation, kind="stable")[:p.dims]
    cells = 1 << p.bits

    def placed(batches):
        for batch in batches:
            x = rows_of(batch.column(len(others)).to_pylist(), width)[:, chosen]
            # Cells of equal width over two deviations to either side; what lies beyond is in the outer ones.
            c = np.floor((x - mean[chosen]) / np.maximum(deviation[chosen], 1e-9) * (cells / 4) + cells / 2).clip(0, cells - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place(c, p.bits))], [*batch.schema.names, "place"])

    kinds = dict(rows.dtypes)
    with_place = rows.select(*others, "q").mapInArrow(placed, ", ".join([*(f"`{c}` {kinds[c]}" for c in others), "q binary", "place long"]))
    keys = ["place", *others]
    ordered = with_place.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def cut(batches):
        part, number, waiting = TaskContext.get().partitionId(), 0, None

        def block(table: pa.Table) -> pa.RecordBatch:
            nonlocal number
            q = rows_of(table.column("q").to_pylist(), width)
            lists = [pa.array([table.column(c).to_pylist()], pa.list_(table.schema.field(c).type)) for c in others]
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number - 1]), pa.array([len(q)], pa.int32()), *lists,
                 *(pa.array([v.tobytes()], pa.binary()) for v in (q, q.min(axis=0), q.max(axis=0)))],
                ["block", "n", *others, "q", "low", "high"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            waiting = table if waiting is None else pa.concat_tables([waiting, table])
            while waiting.num_rows >= p.size:
                yield block(waiting.slice(0, p.size))
                waiting = waiting.slice(p.size)
        if waiting is not None and waiting.num_rows:
            yield block(waiting)

    schema = ", ".join(["block long, n int", *(f"`{c}` array<{kinds[c]}>" for c in others), "q binary, low binary, high binary"])
    return scratch.keep(ordered.mapInArrow(cut, schema), "blocks")
