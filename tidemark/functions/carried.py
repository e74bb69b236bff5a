"""Columns that a window only hands on, as one value.

A window writes every row anew, field by field; a struct is written as one piece.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CARRIED = "carried"


def pack(rows: DataFrame, used: Iterable[str]) -> DataFrame:
    """The ``used`` columns, and all others as one struct."""
    used = set(used)
    rest = [c for c in rows.columns if c not in used]
    kept = [c for c in rows.columns if c in used]
    return rows.select(*kept, F.struct(*rest).alias(CARRIED)) if rest else rows


def unpack(rows: DataFrame) -> DataFrame:
    """The packed columns as columns again, behind the others."""
    if CARRIED not in rows.columns:
        return rows
    return rows.select(*[c for c in rows.columns if c != CARRIED], f"{CARRIED}.*")
