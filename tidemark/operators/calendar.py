"""Trading calendar and the date a run should expect data for.

All frames here have one row per calendar date (or per run), so windows without partitions
stay within the length of a calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.params import DEFAULT, Params

RUN_TIMEZONE = "Asia/Taipei"


def full_calendar(dates: DataFrame) -> DataFrame:
    """Every day from ten days before the first date to the last one."""
    span = dates.agg(F.date_sub(F.min("date"), 10).alias("first"), F.max("date").alias("last"))
    return span.select(F.explode(F.sequence("first", "last")).alias("date"))


def trading_days(dates: DataFrame, holidays: DataFrame) -> DataFrame:
    """Each date with whether it trades: a weekday that is neither a holiday nor an override."""
    closed = holidays.select("year", "mmdd").distinct().withColumn("closed", F.lit(True))
    keyed = dates.withColumn("year", F.year("date")).withColumn("mmdd", F.date_format("date", "MMdd"))
    return keyed.join(closed, ["year", "mmdd"], "left").select(
        "date", ((F.weekday("date") < 5) & F.col("closed").isNull()).alias("trading")
    )


def last_trading_day(calendar: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Latest trading day on or before each day, within the lookback, else NULL."""
    recent = W.orderBy("date").rowsBetween(-(params.calendar_lookback - 1), W.currentRow)
    return calendar.withColumn(
        "last_trading_day", F.last(F.when(F.col("trading"), F.col("date")), ignorenulls=True).over(recent)
    )


def local_run_time(run_at: Column) -> Column:
    """Wall-clock time of a UTC instant where the data is published."""
    return F.from_utc_timestamp(run_at, RUN_TIMEZONE)


def expected_data_date(runs: DataFrame, last_days: DataFrame | None, params: Params = DEFAULT) -> DataFrame:
    """Data date a run should see: before the cutoff hour the previous day counts.

    ``runs`` has ``run_at`` (UTC). Without a calendar the run date itself is expected.
    """
    local = local_run_time(F.col("run_at"))
    timed = runs.withColumn("run_date", F.to_date(local))
    if last_days is None:
        return timed.withColumn("expected_data_date", F.col("run_date"))
    asked = F.when(F.hour(local) < params.cutoff_hour, F.date_sub("run_date", 1)).otherwise(F.col("run_date"))
    days = last_days.select(F.col("date").alias("asked"), F.col("last_trading_day").alias("expected_data_date"))
    return timed.withColumn("asked", asked).join(F.broadcast(days), "asked", "left").drop("asked")
