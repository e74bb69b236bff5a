"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

Build. Equal vectors become one node. Nodes get first neighbours inside cells of random hyperplanes
(several tables, cells of bounded size). Then NN-descent: in every round each node brings together
its neighbours and those that have it as a neighbour, through Spark joins; pairs that have not met
before are compared, and each keeps its best ``k``. Rounds end when few lists change. Nodes of one
cell are handled in one group, so a vector travels once per cell that needs it.

Search. Queries go in blocks of bounded size. A block starts from its own nodes, if they are in
the index, and a bounded sample of entry nodes; in each round every query names its best nodes not
yet expanded, the block joins their neighbours, and every query of the block scores them. A greedy
search ends when nothing new is named or after ``rounds``. The best are scored again on the
original vectors in double precision; equal vectors are spelled out, ties go to the smaller id.

Every vector is coded in half precision relative to its own largest component, with that factor
beside it, and hyperplanes see unit vectors, so a row of any size leaves the others as they are.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do vectors
of another length than the most common one (the smaller on a tie). A vec_id that repeats with one
vector counts once; a null vec_id takes no part. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch


@dataclass(frozen=True)
class Graph:
    k: int = 32            # neighbours kept per node
    reverse: int = 32      # sampled nodes that have it as a neighbour
    tables: int = 16       # hyperplane tables of the start
    cell: int = 400        # aimed at; a cell over twice that is cut by hash
    rounds: int = 4
    least_change: float = 0.02
    expand: int = 24       # nodes that a query expands in a round
    search_rounds: int = 4
    keep: int = 120        # best nodes that a query remembers
    entries: int = 256
    block: int = 128       # queries
    seed: int = 4


def blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def coded(x: np.ndarray, largest: np.ndarray) -> list[bytes]:
    """Rows ``x`` with components up to 1 in half precision, after the eighth root of their factor."""
    root = (largest / (2 * x.shape[1])) ** 0.125  # a product of rows is at most the width: no score overflows
    return [blob(r) + blob(v) for r, v in zip(root.astype(np.float32), x.astype(np.float16))]


def decoded(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The components and the roots of the factors."""
    return np.stack([np.frombuffer(r, np.float16, offset=4) for r in rows]).astype(np.float32), np.array([np.frombuffer(r, np.float32, 1)[0] for r in rows])


def scored(product: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Signed eighth roots of the products times the factors of the columns.

    In a row they are ordered as the inner products, and single precision holds the range of doubles.
    """
    size = np.abs(product)
    for _ in range(3):
        np.sqrt(size, out=size)
    size *= root
    return np.copysign(size, product, out=size)


def best_lists(u: np.ndarray, w: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (u, w) pairs, for each u its k best, ordered by u and falling s (ties: smaller w)."""
    order = np.lexsort((w, u))
    u, w, s = u[order], w[order], s[order]
    first = np.ones(len(u), bool)
    first[1:] = (u[1:] != u[:-1]) | (w[1:] != w[:-1])
    u, w, s = u[first], w[first], s[first]
    order = np.lexsort((w, -s, u))
    u, w, s = u[order], w[order], s[order]
    start = np.ones(len(u), bool)
    start[1:] = u[1:] != u[:-1]
    rank = np.arange(len(u)) - np.flatnonzero(start)[np.cumsum(start) - 1] if len(u) else np.zeros(0, int)
    near = rank < k
    return u[near], w[near], s[near]


def list_table(u: np.ndarray, w: np.ndarray, s: np.ndarray) -> pa.Table:
    """One row per u with its list."""
    ids, at = np.unique(u, return_index=True)
    ends = np.append(at[1:], len(u))
    return pa.table([pa.array(ids, pa.int64()), pa.array([blob(w[a:b]) for a, b in zip(at, ends)], pa.binary()),
                     pa.array([blob(s[a:b]) for a, b in zip(at, ends)], pa.binary())], ["id", "near", "score"])


LISTS = "id long, near binary, score binary"


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    near = [np.frombuffer(x, np.int64) for x in table.column("near").to_pylist()]
    u = np.repeat(table.column("id").to_numpy(), [len(x) for x in near])
    score = [np.frombuffer(x, np.float32) for x in table.column("score").to_pylist()]
    return u, np.concatenate([np.zeros(0, np.int64), *near]), np.concatenate([np.zeros(0, np.float32), *score])


def merged(lists: DataFrame, buckets: int, k: int) -> DataFrame:
    """The k best of all lists of a node. Buckets hold bounded numbers of nodes."""
    def merge(table: pa.Table) -> pa.Table:
        return list_table(*best_lists(*unpack(table), k))

    return lists.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets))).groupBy("bucket").applyInArrow(merge, LISTS)


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, embedding) that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where("vec_id is not null and embedding is not null").where(finite & F.exists("embedding", lambda v: v != 0))
    size = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == (size["n"] if size else 0)).dropDuplicates(["vec_id", "embedding"])


class Index:
    """Nodes, their vectors in half precision (each with its factor), and the neighbour lists."""

    def __init__(self, vectors: DataFrame, p: Graph = Graph(), scratch: Scratch | None = None):
        spark = vectors.sparkSession
        self.p, self.scratch = p, scratch or Scratch(spark, "neighbours")
        rows = self.scratch.keep(usable(vectors), "vectors")
        same = Window.partitionBy("embedding").orderBy("vec_id")
        # The smallest ids of each vector: one for the node, one more than any answer needs.
        self._few = rows.withColumn("copy", F.row_number().over(same))
        self.exact = rows
        nodes = rows.groupBy("embedding").agg(F.min("vec_id").alias("id")).withColumn("largest", F.array_max(F.transform("embedding", F.abs)))
        squares = F.aggregate("embedding", F.lit(0.0), lambda t, v: t + (v / F.col("largest")) * (v / F.col("largest")))
        nodes = nodes.withColumn("length", F.sqrt(squares))
        self.n = 0
        nodes = self.scratch.keep(nodes, "distinct")
        self.n = nodes.count()
        width = len(nodes.select("embedding").first()[0]) if self.n else 1
        bits = max(0, int(np.ceil(np.log2(max(1, self.n / p.cell)))))
        planes = np.random.default_rng(p.seed).standard_normal((p.tables, max(bits, 1), width)).astype(np.float32)
        middle = np.array(nodes.select([F.avg(F.col("embedding")[i] / F.col("largest") / F.col("length")) for i in range(width)]).first() if self.n else [0.0], np.float32)

        def half(batches):
            for batch in batches:
                largest = batch.column(2).to_numpy()
                x = np.array(batch.column(1).flatten().to_numpy(), np.float64).reshape(batch.num_rows, -1) / largest[:, None]
                unit = (x / batch.column(3).to_numpy()[:, None]).astype(np.float32)
                side = np.einsum("tbw,nw->ntb", planes, unit - middle) > 0
                code = (side @ (1 << np.arange(planes.shape[1]))) if bits else np.zeros((len(x), p.tables), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(coded(x, largest), pa.binary()), pa.array(list(code.astype(np.int64)), pa.list_(pa.int64()))],
                    ["id", "vector", "codes"])

        halves = self.scratch.keep(nodes.select("id", "embedding", "largest", "length").mapInArrow(half, "id long, vector binary, codes array<long>"), "half")
        self.buckets = max(1, self.n // 20_000)
        cells = halves.select("id", "vector", F.posexplode("codes").alias("table", "code"))
        sizes = cells.groupBy("table", "code").agg(F.count(F.lit(1)).alias("size"))
        cells = cells.join(sizes, ["table", "code"]).withColumn(
            "part", F.pmod(F.xxhash64("id", "table"), F.greatest(F.lit(1), F.floor(F.col("size") / p.cell)).cast("long")))
        cells = cells.withColumn("cell", F.xxhash64("table", "code", "part"))
        self.vectors = self.scratch.keep(cells.where("table = 0").select("id", "vector", "cell"), "nodes")
        self.lists = self.scratch.keep(merged(cells.groupBy("cell").applyInArrow(self._all_pairs(), LISTS), self.buckets, p.k), "lists-0")
        for i in range(p.rounds):
            before, self.lists = self.lists, self._descend(i + 1)
            changed = before.withColumnRenamed("near", "old").join(self.lists, "id").where("old <> near").count()
            if changed <= p.least_change * self.n:
                break

    def _all_pairs(self):
        k = self.p.k

        def compare(table: pa.Table) -> pa.Table:
            ids = table.column("id").to_numpy()
            x, root = decoded(table.column("vector").to_pylist())
            s = scored(x @ x.T, root)
            np.fill_diagonal(s, -np.inf)
            n = min(k, len(ids) - 1)
            near = np.argpartition(-s, n - 1, axis=1)[:, :n] if n else np.zeros((len(ids), 0), int)
            return list_table(*best_lists(np.repeat(ids, n), ids[near].ravel(), np.take_along_axis(s, near, 1).ravel(), k))

        return compare

    def _ids(self, lists: DataFrame) -> DataFrame:
        """(id, other) from the lists."""
        def spread(batches):
            for batch in batches:
                u, w, _ = unpack(pa.Table.from_batches([batch]))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(w)], ["id", "other"])

        return lists.mapInArrow(spread, "id long, other long")

    def neighbours(self) -> DataFrame:
        """(id, other): neighbours and sampled reverse neighbours, both ways distinct."""
        forward = self._ids(self.lists)
        chance = Window.partitionBy("other").orderBy(F.xxhash64("id", "other"))
        back = forward.withColumn("n", F.row_number().over(chance)).where(F.col("n") <= self.p.reverse)
        return forward.unionByName(back.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct()

    def _descend(self, number: int) -> DataFrame:
        p = self.p
        edges = self.scratch.keep(self.neighbours().join(self.vectors.select("id", "cell"), "id"), f"edges-{number}")
        worst = self.lists.select("id", "score")
        wanted = edges.select("cell", F.col("other").alias("id")).distinct()
        sent = wanted.join(self.vectors.select("id", "vector"), "id").join(worst, "id", "left")
        sent = sent.toDF(*sent.columns)  # columns of its own for the grouping

        def meet(edges: pa.Table, sent: pa.Table) -> pa.Table:
            order = np.argsort(sent.column("id").to_numpy())
            ids = sent.column("id").to_numpy()[order]
            raw = sent.column("vector").to_pylist()
            x, root = decoded([raw[i] for i in order])
            scores = sent.column("score").to_pylist()
            limit = np.full(len(ids), -np.inf, np.float32)
            for j, i in enumerate(order):
                if scores[i] is not None and len(scores[i]) == 4 * p.k:
                    limit[j] = np.frombuffer(scores[i], np.float32)[-1]
            u, w = edges.column("id").to_numpy(), np.searchsorted(ids, edges.column("other").to_numpy())
            order = np.argsort(u, kind="stable")
            u, w = u[order], w[order]
            starts = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]])) if len(u) else np.zeros(0, int)
            found: list[tuple[np.ndarray, ...]] = []
            kept, most = 0, 8_000_000
            for a, b in zip(starts, np.append(starts[1:], len(u))):
                own = w[a:b]
                s = scored(x[own] @ x[own].T, root[own])
                np.fill_diagonal(s, -np.inf)
                i, j = np.nonzero(s > limit[own][:, None])
                found.append((own[i], own[j], s[i, j]))
                kept += len(i)
                if kept > most:
                    found, kept = [best_lists(*map(np.concatenate, zip(*found)), p.k)], 0
            if not found:
                return list_table(*(np.zeros(0, t) for t in (np.int64, np.int64, np.float32)))
            u, w, s = best_lists(*map(np.concatenate, zip(*found)), p.k)
            return list_table(ids[u], ids[w], s)

        met = edges.groupBy("cell").cogroup(sent.groupBy("cell")).applyInArrow(meet, LISTS)
        return self.scratch.keep(merged(self.lists.unionByName(met), self.buckets, p.k), f"lists-{number}")

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """For ``queries (query_id, embedding)``: query_id, rank, vec_id, score. A query's own id is no answer."""
        p = self.p
        asked = self.scratch.keep(usable(queries.withColumnRenamed("query_id", "vec_id")).withColumnRenamed("vec_id", "query_id"), "queries")
        total = asked.count()
        places = asked.join(self.vectors.select(F.col("id").alias("query_id"), "cell"), "query_id", "left")
        rank = Window.partitionBy("part").orderBy(F.coalesce("cell", F.xxhash64("query_id")), "query_id")
        parts = max(1, total // 20_000)
        places = places.withColumn("part", F.pmod(F.xxhash64(F.coalesce("cell", "query_id")), F.lit(parts)))
        block = F.floor((F.row_number().over(rank) - 1) / p.block)
        blocks = self.scratch.keep(places.withColumn("block", F.xxhash64("part", block)), "blocks")
        edges = self.scratch.keep(self.neighbours(), "edges")
        # A bounded number of ids: the same entry nodes for every block.
        entries = [r["id"] for r in self.vectors.orderBy(F.xxhash64("id"), "id").limit(p.entries).select("id").collect()]
        # A copy of a vector is found through the node of the vector.
        owners = self.exact.join(self.exact.groupBy("embedding").agg(F.min("vec_id").alias("id")), "embedding").select(
            F.col("vec_id").alias("query_id"), "id")
        own = blocks.select("block", "query_id").join(owners, "query_id").select("block", "id")
        entered = blocks.select("block").distinct().withColumn("id", F.explode(F.array(*map(F.lit, entries)).cast("array<bigint>")))
        frontier = own.unionByName(entered).distinct()
        state = blocks.groupBy("block").agg(F.collect_list(F.struct("query_id", "embedding")).alias("asked")).select(
            "block", F.col("asked.query_id").alias("query_id"), F.col("asked.embedding").alias("embedding"),
            *[F.lit(b"").alias(c) for c in ("near", "score", "seen", "expanded")])
        schema = "block long, query_id array<long>, embedding array<array<double>>, near binary, score binary, seen binary, expanded binary, next array<long>"
        for number in range(p.search_rounds + 1):
            state, frontier = self._expand(state, frontier, edges, schema, number)
        found = state.mapInArrow(self._named(), "query_id long, id long")
        return self._exact(found, asked, k)

    def _expand(self, state: DataFrame, frontier: DataFrame, edges: DataFrame, schema: str, number: int) -> tuple[DataFrame, DataFrame]:
        p = self.p
        wanted = frontier if number == 0 else frontier.join(edges, "id").select("block", F.col("other").alias("id")).distinct()
        sent = wanted.join(self.vectors.select("id", "vector"), "id")
        sent = sent.toDF(*sent.columns)

        def advance(state: pa.Table, sent: pa.Table) -> pa.Table:
            if not state.num_rows:
                return state.append_column("next", pa.array([], pa.list_(pa.int64())))
            row = state.to_pylist()[0]
            q = np.array(row["embedding"], np.float64)
            q = (q / np.abs(q).max(axis=1, keepdims=True)).astype(np.float32)
            n = len(q)
            seen, expanded = np.frombuffer(row["seen"], np.int64), np.frombuffer(row["expanded"], np.int64).reshape(n, -1)
            near, score = np.frombuffer(row["near"], np.int64).reshape(n, -1), np.frombuffer(row["score"], np.float32).reshape(n, -1)
            ids = sent.column("id").to_numpy()
            new = np.flatnonzero(~np.isin(ids, seen))
            if len(new):
                raw = sent.column("vector").to_pylist()
                x, root = decoded([raw[i] for i in new])
                near = np.concatenate([near, np.broadcast_to(ids[new], (n, len(new)))], axis=1)
                score = np.concatenate([score, scored(q @ x.T, root)], axis=1)
                m = min(p.keep, near.shape[1])
                order = np.lexsort((near, -score), axis=1)[:, :m]
                near, score = np.take_along_axis(near, order, 1), np.take_along_axis(score, order, 1)
                seen = np.union1d(seen, ids[new])
            named = np.full((n, p.expand), -(1 << 63), np.int64)
            for i in range(n):
                fresh = near[i][~np.isin(near[i], expanded[i])][:p.expand]
                named[i, :len(fresh)] = fresh
            nodes = np.unique(named)
            out = dict(zip(state.column_names, (state.column(c) for c in state.column_names)))
            for name, value in (("near", near), ("score", score.astype(np.float32)), ("seen", seen), ("expanded", np.concatenate([expanded, named], axis=1))):
                out[name] = pa.array([blob(value)], pa.binary())
            out["next"] = pa.array([nodes[nodes > -(1 << 63)].tolist()], pa.list_(pa.int64()))
            return pa.table(out)

        state = self.scratch.keep(state.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(advance, schema), f"search-{number}")
        return state.drop("next"), state.select("block", F.explode("next").alias("id"))

    def _named(self):
        keep = min(self.p.keep, 60)

        def name(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    near = np.frombuffer(row["near"], np.int64).reshape(len(row["query_id"]), -1)[:, :keep]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(np.array(row["query_id"], np.int64), near.shape[1])), pa.array(near.ravel())], ["query_id", "id"])

        return name

    def _exact(self, found: DataFrame, asked: DataFrame, k: int) -> DataFrame:
        few = self._few.where(F.col("copy") <= k + 1)
        node = Window.partitionBy("embedding")
        copies = few.select(F.min("vec_id").over(node).alias("id"), "vec_id", "embedding")
        pairs = found.join(copies, "id").where("query_id <> vec_id").join(asked.withColumnRenamed("embedding", "asked"), "query_id")
        product = F.aggregate(F.zip_with("asked", "embedding", lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return pairs.select("query_id", "vec_id", product.alias("score")).withColumn("rank", F.row_number().over(best)).where(
            F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
