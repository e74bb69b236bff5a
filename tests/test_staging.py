from pyspark.sql import functions as F

from tidemark.plans import staging as module
from tidemark.plans.staging import Staging


def test_stage_is_a_table_in_the_shared_folder(spark, tmp_path, monkeypatch):
    # The setting is fixed when a session starts, so the reading of it is replaced here.
    monkeypatch.setattr(module, "shared_dir", lambda _: str(tmp_path))
    rows = spark.range(10).withColumn("v", F.col("id") * 2)
    staging = Staging(spark)
    kept = staging.keep(rows, "rows")
    assert kept.schema.names == rows.schema.names and kept.count() == 10
    assert list(tmp_path.glob("tidemark-stage-*/rows/*.parquet"))
    staging.release()
    assert not list(tmp_path.glob("tidemark-stage-*"))


def test_without_a_shared_folder_the_stage_is_persisted(spark, monkeypatch):
    monkeypatch.setattr(module, "shared_dir", lambda _: None)
    staging = Staging(spark)
    kept = staging.keep(spark.range(5), "rows")
    assert kept.storageLevel.useMemory and kept.count() == 5
    staging.release()
    assert not kept.storageLevel.useMemory
