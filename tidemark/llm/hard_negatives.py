"""Hard negatives for contrastive training, read through zone maps of Hilbert-ordered blocks.

Vectors become integers, floor(256 x), and are written as Parquet blocks in Hilbert order with the
smallest and largest component of each dimension and the smallest id. An anchor asks for windows of
scores (integer inner products): first all rows of its own label (its positives), then for each
positive the rows of other labels from ``least`` percent of its score up to its score. Interval
arithmetic over a block's box gives the least and greatest score an anchor can meet there; the block
is read only for anchors with a window that the interval meets and that the block may still improve.

Anchors go in groups that lie close on the curve. A group first reads the blocks its anchors come
from, then the ``first`` most promising ones, then all that are still needed; after each reading the
windows shrink to what can still enter their first ``k`` rows, with ties by id. Plans are made by
sets of groups against sets of zone-map pages, so neither side is ever whole in one task; blocks are
shipped once per set of groups that reads them. Every row in a window is found: nothing is sampled.

Rows with a null label, a null vector or a null or non-finite component take no part. A shorter
vector ends in zeros. Wholly repeated rows count each, as different rows; a null vec_id comes last
in ties and is never an anchor. An empty table gives no rows. A component beyond half a million is
refused, as scores would leave the range of a long.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import hilbert
from tidemark.llm.scratch import Scratch

LAST = (1 << 63) - 1
EDGE = 1 << 62  # beyond every score


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 5
    least: int = 80        # percent of the positive's score
    group: int = 64        # anchors of a group
    groups: int = 32       # groups of a set
    page_bits: int = 6     # 2**bits blocks of one partition are a page of zone maps
    pages: int = 16        # pages of a set
    first: int = 16        # most promising blocks read before all others
    curve: hilbert.Curve = field(default_factory=hilbert.Curve)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``."""
    reach = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if reach < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def score_bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each vector with any point of each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return product(up, low) + product(down, high), product(up, high) + product(down, low)


def interval_bounds(a_low: np.ndarray, a_high: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of any point of one box with any point of each other box."""
    corners = np.stack([x[None, :].astype(np.int64) * y.astype(np.int64) for x in (a_low, a_high) for y in (low, high)])
    return corners.min(axis=0).sum(axis=1), corners.max(axis=0).sum(axis=1)


def usable(vectors: DataFrame, anchor: Column, label: Column) -> tuple[DataFrame, int]:
    """vec_id, key (of the row), label, asked, q, and the width."""
    rows = vectors.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST)).alias("vec_id"), label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("asked"), F.col("embedding").alias("vector"))
    rows = rows.where(F.col("label").isNotNull() & hilbert.finite("vector"))
    width = max(1, rows.agg(F.max(F.size("vector"))).first()[0] or 0)
    keyed = rows.select("vec_id", F.monotonically_increasing_id().alias("key"), "label", "asked", "vector")
    return hilbert.integer_rows(keyed, "vector", width), width


def anchor_groups(blocks: DataFrame, size: int) -> DataFrame:
    """group, key, label, home (lists of up to ``size`` anchors that lie close together) and their vectors."""
    def gather(batches):
        part, number, waiting = TaskContext.get().partitionId(), 0, []

        def group(some):
            nonlocal number
            number += 1
            key, label, home, q = zip(*some)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number - 1]), *(pa.array([list(x)], pa.list_(pa.int64())) for x in (key, label, home)), pa.array([b"".join(q)])],
                ["group", "key", "label", "home", "vectors"])

        for batch in batches:
            for block, key, label, asked, q in zip(*(batch.column(i).to_pylist() for i in range(5))):
                step = len(q) // len(key)
                waiting += [(key[i], label[i], block, q[i * step:(i + 1) * step]) for i, yes in enumerate(asked) if yes]
                while len(waiting) >= size:
                    yield group(waiting[:size])
                    waiting = waiting[size:]
        if waiting:
            yield group(waiting)

    return blocks.select("block", "key", "label", "asked", "q").mapInArrow(
        gather, "group long, key array<long>, label array<long>, home array<long>, vectors binary")


def zone_pages(blocks: DataFrame, p: Mining) -> DataFrame:
    """page, and of its blocks: number, least id, and the boxes one after the other."""
    zones = blocks.select(F.shiftright("block", p.page_bits).alias("page"), "block", F.array_min("vec_id").alias("least_id"), "low", "high")

    def page(table: pa.Table) -> pa.Table:
        lists = [pa.array([table.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("block", "least_id")]
        boxes = [pa.array([b"".join(table.column(c).to_pylist())], pa.binary()) for c in ("low", "high")]
        return pa.table([table.column("page").slice(0, 1), *lists, *boxes], ["page", "block", "least_id", "low", "high"])

    return zones.groupBy("page").applyInArrow(page, "page long, block array<long>, least_id array<long>, low binary, high binary")


class Miner:
    """Blocks, zone maps and anchor groups of one table, and searches of windows over them."""

    def __init__(self, vectors: DataFrame, anchor: Column, label: Column, p: Mining = Mining(), scratch: Scratch | None = None):
        self.p, self.scratch = p, scratch or Scratch(vectors.sparkSession, "negatives")
        rows, self.width = usable(vectors, anchor, label)
        rows = self.scratch.keep(rows, "rows")  # row keys stay as they are from here on
        self.blocks = hilbert.blocks(self.scratch, rows, self.width, p.curve)
        self.groups = self.scratch.keep(anchor_groups(self.blocks, p.group), "groups")
        self.pages = self.scratch.keep(zone_pages(self.blocks, p), "pages")
        self.anchors = self.groups.select("group", F.posexplode("key").alias("at", "anchor"))
        self.sets = max(1, self.groups.count() // p.groups)
        self.page_sets = max(1, self.pages.count() // p.pages)
        self.read = 0  # pairs of a group and a block

    def windows(self, asked: DataFrame) -> DataFrame:
        """The groups with the windows of their anchors; ``asked``: anchor, slot, low, high, last."""
        own = asked.join(self.anchors, "anchor").groupBy("group").agg(F.collect_list(F.struct("at", "slot", "low", "high", "last")).alias("w"))
        lists = [F.col(f"w.{c}").cast("array<long>").alias(c) for c in ("at", "slot", "low", "high", "last")]
        return own.select("group", *lists).join(self.groups, "group")

    def plan(self, groups: DataFrame, limit: int | None, done: DataFrame) -> DataFrame:
        """(group, block): blocks that may improve a window, without those already read; the best ``limit`` of each group."""
        width = self.width
        jobs = groups.select("group", "vectors", "at", "low", "high", "last").withColumn("set", F.pmod(F.xxhash64("group"), F.lit(self.sets)).cast("int"))
        jobs = jobs.withColumn("pages", F.explode(F.sequence(F.lit(0), F.lit(self.page_sets - 1))))
        pages = self.pages.withColumn("pages", F.pmod(F.xxhash64("page"), F.lit(self.page_sets)).cast("int"))
        pages = pages.withColumn("set", F.explode(F.sequence(F.lit(0), F.lit(self.sets - 1))))

        def choose(jobs: pa.Table, pages: pa.Table) -> pa.Table:
            zones = [[hilbert.rows_of([b], width) for b in pages.column(c).to_pylist()] for c in ("low", "high")]
            blocks, ids = ([np.array(x, np.int64) for x in pages.column(c).to_pylist()] for c in ("block", "least_id"))
            lows, highs = (np.stack([f(z) for z in zs]) if zs else np.zeros((0, width), np.int32) for f, zs in ((lambda z: z.min(axis=0), zones[0]), (lambda z: z.max(axis=0), zones[1])))
            out = [np.zeros((4, 0), np.int64)]
            for row in jobs.to_pylist():
                a = hilbert.rows_of([row["vectors"]], width)
                at, low, high, last = (np.array(row[c], np.int64) for c in ("at", "low", "high", "last"))
                least, most = interval_bounds(a.min(axis=0), a.max(axis=0), lows, highs)
                for i in np.flatnonzero((most >= low.min()) & (least <= high.max())):
                    least_, most_ = score_bounds(a, zones[0][i], zones[1][i])
                    top = most_[at]
                    meets = (least_[at] <= high[:, None]) & ((top > low[:, None]) | (top == low[:, None]) & (ids[i][None, :] < last[:, None]))
                    found = np.flatnonzero(meets.any(axis=0))
                    gain = np.where(meets, np.minimum(top, high[:, None]) - np.maximum(low[:, None], -EDGE), -EDGE).max(axis=0)
                    out.append(np.stack([np.full(len(found), row["group"]), blocks[i][found], gain[found], ids[i][found]]))
            return pa.table([pa.array(x) for x in np.concatenate(out, axis=1)], ["group", "block", "gain", "least_id"])

        pairs = jobs.groupBy("set", "pages").cogroup(pages.groupBy("set", "pages")).applyInArrow(choose, "group long, block long, gain long, least_id long")
        pairs = pairs.join(done, ["group", "block"], "left_anti")
        if limit:
            best = Window.partitionBy("group").orderBy(F.desc("gain"), "least_id", "block")
            pairs = pairs.withColumn("n", F.row_number().over(best)).where(F.col("n") <= limit)
        return pairs.select("group", "block")

    def rows(self, groups: DataFrame, pairs: DataFrame, same: bool, k: int) -> DataFrame:
        """anchor, slot, score, vec_id, key: the first ``k`` rows of every window in each block read."""
        width = self.width
        keyed = pairs.withColumn("set", F.pmod(F.xxhash64("group"), F.lit(self.sets)).cast("int"))
        sent = keyed.join(groups.select("group", "key", "label", "vectors", "at", "slot", "low", "high"), "group")
        wanted = keyed.select("block", "set").distinct().join(self.blocks.select("block", "vec_id", "key", "label", "q"), "block")

        wanted = wanted.toDF(*wanted.columns)  # columns of its own for the grouping

        def meet(sent: pa.Table, wanted: pa.Table) -> pa.Table:
            ids, keys, labels = (np.array(wanted.column(c)[0].as_py(), np.int64) for c in ("vec_id", "key", "label"))
            order = np.lexsort((keys, ids))
            ids, keys, labels = ids[order], keys[order], labels[order]
            x = hilbert.rows_of([wanted.column("q")[0].as_py()], width)[order]
            out = [np.zeros((5, 0), np.int64)]
            for row in sent.to_pylist():
                own, kind, at, slot, low, high = (np.array(row[c], np.int64) for c in ("key", "label", "at", "slot", "low", "high"))
                s = product(hilbert.rows_of([row["vectors"]], width), x)
                fits = (kind[:, None] == labels[None, :]) == same
                fits &= own[:, None] != keys[None, :]
                s = s[at]
                fits = fits[at] & (s >= low[:, None]) & (s <= high[:, None])
                full = np.flatnonzero(fits.any(axis=1))
                if not len(full):
                    continue
                s, fits = s[full], fits[full]
                best = np.argsort(np.where(fits, -s, EDGE), axis=1, kind="stable")[:, :k]  # columns are in the order of ties
                i, j = np.nonzero(np.take_along_axis(fits, best, 1))
                column = best[i, j]
                out.append(np.stack([own[at[full]][i], slot[full][i], s[i, column], ids[column], keys[column]]))
            return pa.table([pa.array(x) for x in np.concatenate(out, axis=1)], ["anchor", "slot", "score", "vec_id", "key"])

        return sent.groupBy("block", "set").cogroup(wanted.groupBy("block", "set")).applyInArrow(
            meet, "anchor long, slot long, score long, vec_id long, key long")

    def first_rows(self, asked: DataFrame, same: bool, k: int, name: str) -> DataFrame:
        """The first ``k`` rows of every window (falling score, then id): anchor, slot, score, vec_id, key, rank."""
        best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "key")
        asked = self.scratch.keep(asked, f"{name}-windows")
        groups = self.windows(asked)
        pairs = self.scratch.keep(groups.select("group", F.explode(F.array_distinct("home")).alias("block")), f"{name}-home")
        found, done = None, pairs
        for step, limit in enumerate((self.p.first, None, 0)):
            more = self.rows(groups, pairs, same, k)
            found = more if found is None else more.unionByName(found.drop("rank"))
            ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            found = self.scratch.keep(ranked, f"{name}-found-{step}")
            if limit == 0:
                break
            # What can still enter a full window is better than its last row, or equal with a smaller id.
            full = found.where(F.col("rank") == k).select("anchor", "slot", F.col("score").alias("worst"), F.col("vec_id").alias("worst_id"))
            now = asked.join(full, ["anchor", "slot"], "left").select(
                "anchor", "slot", F.coalesce("worst", "low").alias("low"), "high", F.coalesce("worst_id", "last").alias("last"))
            groups = self.windows(now)
            pairs = self.scratch.keep(self.plan(groups, limit, done), f"{name}-plan-{step}")
            done = done.unionByName(pairs)
        self.read += done.count()
        return found

    def positives(self) -> DataFrame:
        """anchor (its row key), score, vec_id, key, rank of the first rows of the anchor's label."""
        asked = self.anchors.select("anchor", F.lit(0).cast("long").alias("slot"), F.lit(-EDGE).alias("low"), F.lit(EDGE).alias("high"), F.lit(LAST).alias("last"))
        return self.first_rows(asked, True, self.p.positives, "positives")

    def negatives(self, positives: DataFrame) -> DataFrame:
        """anchor, slot (the rank of the positive), score, vec_id, rank of the first rows of other labels in each positive's window."""
        low = F.expr(f"(score * {self.p.least} + 99) div 100")
        asked = positives.where("score >= 0").select(  # below zero the window is empty
            "anchor", F.col("rank").cast("long").alias("slot"), low.alias("low"), F.col("score").alias("high"), F.lit(LAST).alias("last"))
        return self.first_rows(asked, False, self.p.negatives, "negatives")

    def mine(self) -> DataFrame:
        """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
        real = lambda c: F.nullif(F.col(c), F.lit(LAST))
        ids = self.blocks.select(F.explode(F.arrays_zip("key", "vec_id", "asked")).alias("r")).where("r.asked").select(
            F.col("r.key").alias("anchor"), F.col("r.vec_id").alias("anchor_id"))
        positives = self.positives()
        negatives = self.negatives(positives).select("anchor", "slot", "rank", F.col("vec_id").alias("negative"), F.col("score").alias("negative_score"))
        named = positives.select("anchor", F.col("rank").cast("long").alias("slot"), F.col("vec_id").alias("positive"), F.col("score").alias("positive_score"))
        return negatives.join(named, ["anchor", "slot"]).join(ids, "anchor").select(
            "anchor_id", real("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), real("negative").alias("negative_id"),
            "positive_score", "negative_score")
