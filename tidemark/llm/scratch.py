"""Intermediate tables in the shared folder, and running totals over a distributed sort."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only for a single-JVM session without one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def lean(run):
    """``run`` for ``mapInArrow``, in a worker that stays for later tasks: what its batches took goes back to the system."""
    @wraps(run)
    def running(batches):
        for number, batch in enumerate(run(batches)):
            yield batch
            if number % 2:
                give_back()
        give_back()

    return running


def lean_group(run):
    """The same for a function of one whole group (``applyInArrow``)."""
    def running(table: pa.Table) -> pa.Table:
        out = run(table)
        give_back()
        return out

    return running


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # GNU libraries only
    if trim:
        trim(0)


def small_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Rows reach Python in Arrow batches of about ``size`` bytes: texts are long, and 10,000 of them may be a gigabyte."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


class Scratch:
    """Tables of one run. ``keep`` cuts the lineage: later plans scan files that outlive any executor."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        small_batches(spark)
        self._root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._number = 0

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        self._number += 1
        path = f"{self._root}/{self._number:03d}-{name}"
        frame.write.parquet(path)
        kept = self.spark.read.schema(frame.schema).parquet(path)
        kept._scratch_path = path
        return kept

    def drop(self, *frames: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for frame in frames:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(frame._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def running_totals(scratch: Scratch, frame: DataFrame, order: list, sums: list[str], name: str = "ordered", stored: bool = False) -> DataFrame:
    """Adds ``position`` (from 0) and ``<column>_before`` (sum over all earlier rows) in a total order.

    ``order`` must make rows distinct but for wholly equal ones. The rows are range-partitioned and
    sorted; each partition numbers its own rows, and only one total per partition goes to the driver.
    Wholly equal rows lie in one partition, unless ``frame`` is a stored table: there their places in the
    scan, the same on every attempt, tell them apart.
    """
    columns = frame.columns
    if stored:
        frame, order = frame.withColumn("_tie", F.monotonically_increasing_id()), [*order, "_tie"]
    added = [T.StructField("_part", T.IntegerType()), T.StructField("position", T.LongType())]
    added += [T.StructField(f"{c}_before", T.LongType()) for c in sums]
    schema = T.StructType(frame.schema.fields + added)

    def number(batches):
        part, rows, totals = TaskContext.get().partitionId(), 0, dict.fromkeys(sums, 0)
        for batch in batches:
            n = batch.num_rows
            columns = list(batch.columns) + [pa.array([part] * n, pa.int32()), pa.array(range(rows, rows + n), pa.int64())]
            for c in sums:
                values = batch.column(batch.schema.get_field_index(c)).cast(pa.int64())
                ends = pc.add(pc.cumulative_sum(values), totals[c])
                columns.append(pc.subtract(ends, values))
                totals[c] = ends[n - 1].as_py() if n else totals[c]
            rows += n
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    ordered = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    local = scratch.keep(ordered.mapInArrow(lean(number), schema), name)
    tops = local.groupBy("_part").agg(F.max("position").alias("p"), *[F.max(F.col(f"{c}_before") + F.col(c)).alias(c) for c in sums])
    offsets, at = [], [0] * (1 + len(sums))
    for r in sorted(tops.collect()):
        offsets.append((r["_part"], *at))
        at = [at[0] + r["p"] + 1] + [a + r[c] for a, c in zip(at[1:], sums)]
    table = scratch.spark.createDataFrame(offsets, "_part int, _p long" + "".join(f", _{c} long" for c in sums))
    out = local.join(F.broadcast(table), "_part")
    out = out.withColumn("position", F.col("position") + F.col("_p"))
    for c in sums:
        out = out.withColumn(f"{c}_before", F.col(f"{c}_before") + F.col(f"_{c}"))
    return out.select(*columns, "position", *[f"{c}_before" for c in sums])


def parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
