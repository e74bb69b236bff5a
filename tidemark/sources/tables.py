"""Reading the stored tables and stacking stock and non-stock holdings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources.store import Store


@dataclass(frozen=True)
class Tables:
    """The three input tables: stock holdings, other assets, fund universe."""

    holdings: DataFrame
    non_stock: DataFrame
    universe: DataFrame


def read_tables(spark: SparkSession, root: str) -> Tables:
    """Parquet tables laid down by ``tidemark.sources.sinks`` (facts partitioned by date)."""
    return stored_tables(Store(spark, root))


def stored_tables(store: Store, **parts) -> Tables:
    """The tables of a store; ``parts`` limits the dates of the facts that are read."""
    return Tables(
        store.read("etf_daily_holdings", schemas.HOLDINGS, **parts),
        store.read("etf_daily_non_stock_assets", schemas.NON_STOCK, **parts),
        store.read("etf_universe", schemas.UNIVERSE),
    )


def scan_holdings(holdings: DataFrame, non_stock: DataFrame) -> DataFrame:
    """Stock rows and other assets as one frame; stock columns are NULL for the latter."""
    return holdings.unionByName(non_stock, allowMissingColumns=True)


def scan_dates(holdings: DataFrame, non_stock: DataFrame) -> DataFrame:
    """Distinct dates present in either holdings table."""
    return holdings.select("date").union(non_stock.select("date")).distinct()


def range_filter(rows: DataFrame, from_date: str | None = None, to_date: str | None = None) -> DataFrame:
    """Optional closed date range; on a date-partitioned table this prunes partitions."""
    if from_date:
        rows = rows.where(F.col("date") >= F.lit(from_date).cast("date"))
    if to_date:
        rows = rows.where(F.col("date") <= F.lit(to_date).cast("date"))
    return rows
