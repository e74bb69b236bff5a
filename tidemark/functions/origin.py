"""Ranking and grouping of snapshot sources."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank of each source type, and the rank of any other.
SOURCE_PRIORITY = {
    "moneydj_primary": 40,
    "moneydj_browser": 38,
    "official_fallback": 35,
    "official_browser": 35,
    "official_static": 30,
}
OTHER_PRIORITY = 10

AGGREGATOR_SOURCES = ("moneydj_primary", "moneydj_browser")
OFFICIAL_SOURCES = ("official_fallback", "official_browser", "official_static")


def source_priority(source_type: Column) -> Column:
    ranks = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in SOURCE_PRIORITY.items()))
    return F.coalesce(F.try_element_at(ranks, F.coalesce(source_type, F.lit(""))), F.lit(OTHER_PRIORITY))


def source_family(source_type: Column) -> Column:
    return (
        F.when(source_type.contains("moneydj"), F.lit("moneydj"))
        .when(source_type.contains("official"), F.lit("official"))
        .otherwise(F.coalesce(F.nullif(source_type, F.lit("")), F.lit("unknown")))
    )
