"""Where shared intermediate frames are kept.

With ``spark.checkpoint.dir`` set, a stage is written once as a table below that shared
folder and read back: later plans start from a pruned columnar scan and a lost executor costs
nothing but its running tasks. Without it (local sessions) the stage is persisted and keeps
its lineage.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK = 100_000  # of rows that are sorted and laid out inside their fund


def task_count(rows: int | None) -> int:
    """Into how many tasks so many rows go, so that the memory of a task does not grow with the table."""
    return -(-(rows or 1) // ROWS_PER_TASK)


def shared_dir(spark: SparkSession) -> str | None:
    """The folder that the session's configuration or its checkpoint setting names."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    checkpoints = spark.sparkContext._jsc.sc().getCheckpointDir()
    return checkpoints.get() if checkpoints.isDefined() else None


class Staging:
    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._base = shared_dir(spark)
        self._run = f"tidemark-stage-{uuid.uuid4().hex}"
        self._persisted: list[DataFrame] = []

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        if self._base is None:
            kept = frame.persist(StorageLevel.MEMORY_AND_DISK)
            self._persisted.append(kept)
            return kept
        path = f"{self._base}/{self._run}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return self._spark.read.schema(frame.schema).parquet(path)

    def release(self, drop: bool = True) -> None:
        """Gives back what the run kept. With ``drop`` its tables go too, so frames over them must be done with."""
        while self._persisted:
            self._persisted.pop().unpersist()
        if drop and self._base is not None:
            folder = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._base}/{self._run}")
            folder.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(folder, True)


class NoStaging:
    """Leaves every frame as a plan; used where one query is run on its own."""

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        return frame

    def release(self, drop: bool = True) -> None:
        pass
