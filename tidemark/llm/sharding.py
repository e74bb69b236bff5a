"""Contiguous shards of near equal bytes: the smallest capacity that a greedy filling can meet.

Groups of equal texts are atomic; they are ordered by their smallest id. Running sums of group
sizes come from a distributed sort. A binary search over capacities asks whether greedy filling
needs at most ``shards`` shards. The search sees the running sums through a grid of at most
``cells`` cells (smallest and largest running sum in each), so a capacity is proven feasible,
proven infeasible, or open; only the stretches in which cuts of open capacities can lie are read
again on a finer grid, until no capacity is open. What the driver holds is bounded by ``cells``
and the number of shards, whatever the size of the input.

Filling every shard to that capacity would leave the last ones empty where one group is large. So the
cuts are placed evenly below it: each shard ends at the group end that is nearest to an equal share of
what is left, groups beyond that share counted apart, as long as the rest still fits. No shard is empty
while there are as many groups as shards.

Null texts form one group of their own, with no bytes (CRC 0). A null id comes first. Wholly
repeated rows are separate rows of one group. An empty table gives no rows; with fewer groups than
shards the last shards stay empty.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch, running_totals

ROW_BYTES = 8


@dataclass(frozen=True)
class Grid:
    """Running sums seen through cells: for each, the smallest and the largest sum in it."""
    low: list[int]
    high: list[int]

    def at_most(self, target: int) -> tuple[int, int]:
        """Bounds of the largest running sum that is <= target (0 if none)."""
        i = bisect.bisect_right(self.low, target) - 1
        if i < 0:
            return 0, 0
        if self.high[i] <= target:
            return self.high[i], self.high[i]
        return self.low[i], min(target, self.high[i])

    def cuts(self, capacity: int, shards: int) -> list[tuple[int, int]]:
        """Bounds of the running sum at the end of each greedy shard."""
        out, low, high = [], 0, 0
        for _ in range(shards):
            low, high = self.at_most(low + capacity)[0], self.at_most(high + capacity)[1]
            out.append((low, high))
        return out


def smallest_capacity(sums: DataFrame, shards: int, cells: int = 50_000) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and the running sums at which its shards end.

    ``sums``: column ``ends``, the running sum at the end of each group, and ``bytes`` of the group.
    """
    total, largest = sums.agg(F.max("ends"), F.max("bytes")).first()
    if not total:
        return 0, [0] * shards
    infeasible, feasible = max(-(-total // shards), largest) - 1, -(-total // shards) + largest
    windows = [(0, total)]
    while True:
        width = max(1, -(-sum(b - a + 1 for a, b in windows) // cells))
        inside = F.lit(False)
        for a, b in windows:
            inside = inside | F.col("ends").between(a, b)
        cell = F.floor(F.col("ends") / width)
        rows = sums.where(inside).groupBy(cell.alias("cell")).agg(F.min("ends").alias("low"), F.max("ends").alias("high")).collect()
        rows.sort(key=lambda r: r["low"])
        grid = Grid([r["low"] for r in rows], [r["high"] for r in rows])

        a, b = infeasible, feasible  # the smallest capacity that is proven feasible
        while b - a > 1:
            c = (a + b) // 2
            a, b = (a, c) if grid.cuts(c, shards)[-1][0] >= total else (c, b)
        feasible = b
        a, b = infeasible, feasible  # the largest that is proven infeasible
        while b - a > 1:
            c = (a + b) // 2
            a, b = (c, b) if grid.cuts(c, shards)[-1][1] < total else (a, c)
        infeasible = a
        cuts = grid.cuts(feasible, shards)
        if feasible - infeasible == 1 and all(x == y for x, y in cuts):
            return feasible, [x for x, _ in cuts]
        windows = _merged([(low, high) for (low, _), (_, high) in zip(grid.cuts(infeasible + 1, shards), cuts)])


def _merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def even_cuts(ends: list[int], large: list[tuple[int, int]], capacity: int, shards: int) -> list[int]:
    """Ends of the shards among the rising group ``ends`` (the last is the total), none over ``capacity``.

    ``large``: start and end of the groups beyond an equal share. ``ends`` must hold a feasible choice.
    """
    total, count = ends[-1], [0] * len(ends)  # shards that the groups after each end take at least
    for i in range(len(ends) - 2, -1, -1):
        count[i] = 1 + count[bisect.bisect_right(ends, ends[i] + capacity) - 1]
    cuts, at, index = [], 0, -1
    for left in range(shards, 0, -1):
        if index == len(ends) - 1:
            cuts.append(total)
            continue
        ahead = [(a, b) for a, b in large if a >= at]
        rest = total - at - sum(b - a for a, b in ahead)
        share = rest / max(1, left - len(ahead))
        last = min(bisect.bisect_right(ends, at + capacity), max(index + 2, len(ends) - left + 1)) - 1
        first = next(i for i in range(index + 1, len(ends)) if count[i] <= left - 1) if count[index + 1] > left - 1 else index + 1
        last = max(first, last)
        near = bisect.bisect_left(ends, at + share, first, last)
        if near > first and at + share - ends[near - 1] <= ends[near] - at - share:
            near -= 1
        index, at = near, ends[near]
        cuts.append(at)
    return cuts


def spread_cuts(ordered: DataFrame, capacity: int, greedy: list[int], shards: int, cells: int = 50_000) -> list[int]:
    """Even cuts for groups in order (position, bytes, ends), chosen among at most some ``cells`` group ends.

    Few groups: all ends. Else one end per stretch of positions and per stretch of bytes, beside the greedy cuts
    and the edges of groups beyond an equal share; the driver holds no more than these.
    """
    total, n = ordered.agg(F.max("ends"), F.max("position")).first()
    if not total:
        return greedy
    large = ordered.where(F.col("bytes") > total / shards).select("ends", "bytes").collect()  # fewer than shards
    by_place, by_size = max(1, 2 * (n + 1) // cells), max(1, 2 * total // cells)
    if n + 1 <= cells:
        some = [r["ends"] for r in ordered.select("ends").collect()]
    else:
        places = ordered.groupBy(F.floor(F.col("position") / by_place)).agg(F.max("ends").alias("ends"))
        sizes = ordered.groupBy(F.floor(F.col("ends") / by_size)).agg(F.max("ends").alias("ends"))
        some = [r["ends"] for r in places.select("ends").union(sizes.select("ends")).collect()]
    edges = {x for r in large for x in (r["ends"] - r["bytes"], r["ends"])}
    return even_cuts(sorted({*some, *greedy, *edges, total} - {0}), [(r["ends"] - r["bytes"], r["ends"]) for r in large], capacity, shards)


def shard_documents(docs: DataFrame, shards: int = 24, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (its place in the shard)."""
    spark: SparkSession = docs.sparkSession
    scratch = scratch or Scratch(spark, "sharding")
    text = F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.when(F.col("text").isNull(), "0").otherwise("1"), text), 256))
    slim = docs.select(
        F.col("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        digest.alias("digest"))
    rows = scratch.keep(slim, "rows")
    groups = rows.groupBy("digest").agg(
        F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("first"), F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    ordered = scratch.keep(running_totals(scratch, groups, ["first", "digest"], ["bytes", "rows"], "groups").withColumn(
        "ends", F.col("bytes_before") + F.col("bytes")), "sums")
    capacity, greedy = smallest_capacity(ordered, shards)
    ends = spread_cuts(ordered, capacity, greedy, shards)

    starts = [0, *ends[:-1]]
    shard = sum(((F.col("bytes_before") >= at).cast("int") for at in starts[1:]), F.lit(0))
    placed = ordered.withColumn("shard", shard)
    firsts = placed.groupBy("shard").agg(F.min("rows_before").alias("shard_start"))
    # Rows of a group are numbered by a sort over all rows, so no group has to fit into a task.
    named = rows.join(placed.select("digest", "first", "shard"), "digest")
    numbered = running_totals(scratch, named, ["first", "digest", "doc_id"], [], "slots")
    return numbered.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("position") - F.col("shard_start")).alias("slot"))
