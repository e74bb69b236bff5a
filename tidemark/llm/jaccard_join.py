"""Similarity join of documents on word n-grams by chosen paths.

A document is the set of its n-grams of five words (all its words, if it has fewer); documents with
equal sets are one set. A signature holds the smallest n-gram of each of 128 hash bins. In every run
a set chooses few of its signature's tokens, by shared random numbers, and joins their buckets; a
large bucket is split again by chosen tokens, with longer and longer paths. Before a split, the
members on the near side of a gap in the similarities to the bucket's first member are tied to it;
only those beyond the gap go on, which by the triangle inequality of the Jaccard distance parts no
similar pair. In small buckets all pairs
are compared by signatures. Runs are repeated until the wanted share of pairs at the threshold is
expected to meet at least once even if every bucket on their way is large, so that in each run a
path that they share has to survive all splits.

Ties are joined to groups, and inside each group the sets are compared exactly, by the sizes of
their intersections, so a pair is linked if and only if its similarity reaches the threshold; a
group too large for one task is compared in pairs of blocks. Links are counted, never listed: a group
of near copies gives one row per document.

A document without words (null, empty, white space) has no links. A null id comes after all others.
Wholly repeated rows are documents with equal sets. Ids may repeat with other texts: a text is found
again by a hash of its id and bytes. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.components import components
from tidemark.llm.scratch import Scratch, lean, lean_group

CHUNK = 2 << 20
LAST = (1 << 63) - 1
BINS = 128
ALIKE = 8  # steps of a twentieth
DEEPER = 1.25  # times as many tokens are chosen in a split as at the start


@dataclass(frozen=True)
class Join:
    words: int = 5
    similarity: float = 0.8
    recall: float = 0.9999   # of pairs at the threshold, to meet in a bucket
    chosen: float = 1.25     # tokens that a set chooses per run and level, in expectation
    small: int = 200         # members of a bucket compared pair by pair
    depth: int = 4
    block_bytes: int = 12 << 20
    block_sets: int = 5000

    @property
    def runs(self) -> int:
        """The fewest runs in which a pair at the threshold is missed with probability at most 1 - recall.

        Shared paths are a branching process over all levels: every one has to be chosen again at each
        split. The number of equal bins of two full signatures is binomial and the same in all runs.
        """
        equal = np.arange(BINS + 1)
        ways = [math.lgamma(BINS + 1) - math.lgamma(k + 1) - math.lgamma(BINS - k + 1) for k in equal]
        weight = np.exp(ways + equal * math.log(self.similarity) + (BINS - equal) * math.log1p(-self.similarity)) if self.similarity < 1 else equal == BINS
        missed = np.zeros(BINS + 1)
        for level in range(self.depth, 0, -1):
            chosen = self.chosen * (1 if level == 1 else DEEPER)
            missed = (1 - min(1, chosen / BINS) * (1 - missed)) ** equal
        runs = 1
        while weight @ missed**runs > 1 - self.recall:
            runs += 1
        return runs


def ngram_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each text's set in the array of all distinct n-gram hashes, sorted within a text."""
    bounds, every = W.split_words(texts)
    hashes = W.word_hashes(every)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    last = max(0, len(hashes) - n + 1)
    starts = np.flatnonzero(text[:last] == text[n - 1:n - 1 + last])
    length = np.full(len(starts), n)
    short = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < n))
    starts, length = np.concatenate([starts, bounds[short]]), np.concatenate([length, np.diff(bounds)[short]])
    grams = W.mix(W.Rolling(hashes).stretch(starts, length) + length.astype(W.U64))
    owner = text[starts]
    order = np.lexsort((grams, owner))
    owner, grams = owner[order], grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])
    return np.searchsorted(owner[new], np.arange(len(texts) + 1)), grams[new]


def set_keys(bounds: np.ndarray, grams: np.ndarray) -> list[bytes]:
    """128 bits per set: two sums of differently mixed members."""
    one, two = (W.sums_by_text(W.mix(grams * W.U64(k)), bounds) for k in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
    n = np.diff(bounds).astype(W.U64)
    return [x.tobytes() for x in np.stack([W.mix(one + n), W.mix(two ^ n)], axis=1)]


def signature(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filled bins and the smallest n-gram in each; ``grams`` is sorted."""
    bins, at = np.unique(grams >> W.U64(57), return_index=True)
    return bins.astype(np.int64), grams[at]


def coarse(bins: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """A signature as one byte per bin, 0 where it is empty."""
    out = np.zeros(BINS, np.uint8)
    out[bins] = W.mix(tokens) % W.U64(255) + W.U64(1)
    return out


def choose(path: np.ndarray, tokens: np.ndarray, p: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, new path) of the tokens that each path chooses, with probability p each."""
    h = W.mix(path[:, None] ^ W.mix(tokens + W.U64(W.BASE))) if tokens.ndim == 2 else W.mix(path[:, None] ^ W.mix(tokens[None, :] + W.U64(W.BASE)))
    i, j = np.nonzero(h < np.asarray(p * 2.0**64).clip(0, 2.0**64 - 2**11).astype(W.U64))
    return i, W.mix(h[i, j] + W.U64(1))


def alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of signature rows, and the number of bins behind it."""
    filled = np.count_nonzero((a > 0) | (b > 0), axis=1)
    return np.count_nonzero((a == b) & (a > 0), axis=1) / np.maximum(filled, 1), np.maximum(filled, 1)


def _row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits of id and text: equal for wholly repeated rows only."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("")), F.lit(" "), F.coalesce(text, F.lit("")))))


def _described(docs: DataFrame, p: Join) -> DataFrame:
    """doc_id, row_key, set_key, grams, sig, paths of every document; null key where there are no words."""
    seeds = W.mix(np.arange(1, p.runs + 1, dtype=W.U64) * W.U64(W.BASE))

    def describe(batches):
        for batch in batches:
            for part in W.chunks(batch, "text", CHUNK):
                bounds, grams = ngram_sets(W.strings(part.column(1)), p.words)
                keys, rows = set_keys(bounds, grams), []
                for key, a, b in zip(keys, bounds[:-1], bounds[1:]):
                    if a == b:
                        rows.append((None, 0, None, []))
                        continue
                    bins, tokens = signature(grams[a:b])
                    paths = choose(seeds, tokens, p.chosen / len(tokens))[1]
                    rows.append((key, int(b - a), coarse(bins, tokens).tobytes(), np.unique(paths).view(np.int64).tolist()))
                key, n, sig, paths = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(key, pa.binary()), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(paths, pa.list_(pa.int64()))],
                    ["doc_id", "row_key", "set_key", "grams", "sig", "paths"])

    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), "text", _row_key().alias("row_key")).mapInArrow(
        lean(describe), "doc_id long, row_key binary, set_key binary, grams long, sig binary, paths array<long>")


def _split(rows: DataFrame, p: Join) -> DataFrame:
    """(path, id, sig, leader_sig) -> longer paths of the chosen tokens.

    Tokens are chosen where a set differs from the leader: what all of a bucket shares with it, like a
    passage or a template, tells its members no further apart. Two sets at the threshold differ in at most a
    fifth of their bins, so the others among these are chosen often enough to meet as often as before.
    """
    def deeper(batches):
        for batch in batches:
            if batch.num_rows:
                path = batch.column(0).to_numpy().view(W.U64)
                sig, leader = (np.stack([np.frombuffer(s, np.uint8) for s in batch.column(i).to_pylist()]) for i in (2, 3))
                tokens = sig.astype(W.U64) + (np.arange(BINS, dtype=W.U64) << W.U64(8))
                own = (sig > 0) & (sig != leader)
                n = own.sum(axis=1)
                shared = np.maximum(n - (1 - p.similarity) * (sig > 0).sum(axis=1), n / 4)
                share = np.where(own, (DEEPER * p.chosen * p.similarity / np.maximum(shared, 1e-9))[:, None], 0.0)
                i, new = choose(path, tokens, share)
                yield pa.RecordBatch.from_arrays([pa.array(new.view(np.int64)), batch.column(1).take(pa.array(i))], ["path", "id"])

    return rows.select("path", "id", "sig", "leader_sig").mapInArrow(lean(deeper), "path long, id long").distinct()


def _near_leader(pairs: DataFrame) -> DataFrame:
    """(id, sig, leader, leader_sig) -> id, leader and the estimated similarity in steps of a twentieth."""
    def compare(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.stack([np.frombuffer(s, np.uint8) for s in batch.column(i).to_pylist()]) for i in (1, 3))
                step = np.floor(alike(a, b)[0] * 20).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(step)], ["id", "leader", "step"])

    return pairs.select("id", "sig", "leader", "leader_sig").mapInArrow(lean(compare), "id long, leader long, step int")


def _cuts(near: DataFrame, gap: int = 7) -> DataFrame:
    """(leader, cut): downwards from the leader, the last similarity before a gap of 0.3 among all members of its buckets.

    Two sets at the threshold 0.8 differ by at most 0.2 in their similarity to the leader; the rest of the
    gap is for the error of the two estimates (a deviation of some 0.06 for their difference). A pair that
    an error parts in one run is met again under other leaders and in other runs. Members that are much alike
    on average, such as copies with many changes each, would stay together in every further split: they are
    tied at once, and compared exactly.
    """
    steps = F.sort_array(F.collect_set("step"), asc=False)
    found = F.aggregate(steps, F.lit(20), lambda last, s: F.when(last - s < gap, s).otherwise(last))
    others = F.avg(F.when(F.col("id") != F.col("leader"), F.col("step")))
    return near.groupBy("leader").agg(F.when(others >= ALIKE, 0).otherwise(found).alias("cut"))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of n nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _small_buckets(p: Join):
    def compare(table: pa.Table) -> pa.Table:
        path, id_ = table.column("path").to_numpy(), table.column("id").to_numpy()
        sig = np.stack([np.frombuffer(s, np.uint8) for s in table.column("sig").to_pylist()])
        order = np.lexsort((id_, path))
        ids, node = np.unique(id_, return_inverse=True)
        starts = np.flatnonzero(np.concatenate([[True], np.diff(path[order]) != 0]))
        ends = np.append(starts[1:], len(path))
        left, right = [], []

        def settle(pairs: list[tuple[np.ndarray, np.ndarray]]) -> None:
            i, j = (np.concatenate(x) for x in zip(*pairs))
            s, m = alike(sig[i], sig[j])
            good = s >= p.similarity - 5 * np.sqrt(p.similarity * (1 - p.similarity) / m)
            left.append(node[i[good]])
            right.append(node[j[good]])

        pairs, waiting = [], 0
        for a, b in zip(starts, ends):
            i, j = np.triu_indices(b - a, 1)
            pairs.append((order[a + i], order[a + j]))
            waiting += len(i)
            if waiting > 200_000:
                settle(pairs)
                pairs, waiting = [], 0
        if pairs:
            settle(pairs)
        label = forest(len(ids), np.concatenate([np.zeros(0, int), *left]), np.concatenate([np.zeros(0, int), *right]))
        tied = np.flatnonzero(label != np.arange(len(ids)))
        return pa.table([pa.array(ids[tied]), pa.array(ids[label[tied]])], ["a", "b"])

    return compare


def _ties(scratch: Scratch, sets: DataFrame, p: Join) -> DataFrame:
    """(a, b): sets that may be similar, as a forest rather than all pairs."""
    rows, ties = sets.select(F.explode("paths").alias("path"), "id"), []
    sigs = sets.select("id", "sig")
    for level in range(1, p.depth + 1):
        rows = scratch.keep(rows, f"paths-{level}")
        sizes = scratch.keep(rows.groupBy("path").agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("leader")).where("members > 1"), f"buckets-{level}")
        total = sizes.where(F.col("members") <= p.small).agg(F.sum("members")).first()[0] or 0
        if total:
            members = rows.join(sizes.where(F.col("members") <= p.small).select("path"), "path").join(sigs, "id")
            some = F.pmod(F.xxhash64("path"), F.lit(max(1, total // 50_000)))
            ties.append(scratch.keep(members.withColumn("some", some).groupBy("some").applyInArrow(lean_group(_small_buckets(p)), "a long, b long"), f"ties-{level}"))
        large = sizes.where(F.col("members") > p.small)
        if not large.limit(1).count():
            break
        # A crowd of near copies meets in many buckets under one leader: each set is compared with a leader once.
        crowded = scratch.keep(rows.join(large.select("path", "leader"), "path"), f"crowded-{level}")
        leaders = sigs.select(F.col("id").alias("leader"), F.col("sig").alias("leader_sig"))
        pairs = crowded.select("id", "leader").distinct().join(sigs, "id").join(leaders, "leader")
        near = scratch.keep(_near_leader(pairs), f"leaders-{level}")
        if level == p.depth:  # nothing is split any more: the rest of the bucket stays together
            ties.append(near.where("id <> leader").select(F.col("id").alias("a"), F.col("leader").alias("b")))
            break
        near = near.join(_cuts(near), "leader")
        ties.append(near.where("id <> leader and step >= cut").select(F.col("id").alias("a"), F.col("leader").alias("b")))
        far = near.where("step < cut").select("id", "leader").join(sigs, "id").join(leaders, "leader")
        rows = _split(far.join(crowded, ["id", "leader"]), p)
    out = sets.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    for one in ties:
        out = out.unionByName(one)
    return out


def _dense(row: np.ndarray, column: np.ndarray, m: int, width: int, a: int, b: int) -> np.ndarray:
    """Sizes of the intersections of sets a..b with all ``m``, over the given entries; ``column`` is sorted."""
    s, step = np.zeros((b - a, m), np.float32), max(1, min(width, 4_000_000 // m))
    cuts = np.searchsorted(column, np.arange(0, width + step, step))
    for k in range(len(cuts) - 1):
        part = np.zeros((m, step), np.float32)
        part[row[cuts[k]:cuts[k + 1]], column[cuts[k]:cuts[k + 1]] - k * step] = 1
        s += part[a:b] @ part.T
    return s


def _links(sets: list[np.ndarray], weight: np.ndarray, block: np.ndarray | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Exact comparison: for each set the weight of its links, and its component. ``block``: only pairs of different blocks.

    Tokens are ordered from rare to frequent. Two similar sets share one of their first n - t n + 1 tokens
    (prefix filter), so only pairs that meet there, and whose sizes allow it, are compared; where a
    large part of all pairs meets, a dense product counts the frequent tokens they share and lists of the
    few sets that hold it each other token; elsewhere the tokens of each pair are looked up.
    """
    m, n = len(sets), np.array([len(s) for s in sets], np.int64)
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(uses), np.int64)
    rank[np.argsort(uses, kind="stable")] = np.arange(len(uses))
    row, column = np.repeat(np.arange(m), n), rank[column]
    order = np.lexsort((column, row))
    column = column[order]  # rows stay as they are
    width, every = len(uses), row * len(uses) + column
    starts = np.cumsum(n) - n
    first = np.arange(len(row)) - starts[row] <= (n - np.ceil(similarity * n - 1e-9))[row]
    by_token = np.flatnonzero(first)
    by_token = by_token[np.argsort(column[by_token], kind="stable")]
    meets = row[by_token]
    low = np.searchsorted(column[by_token], column, side="left")
    length = np.where(first, np.searchsorted(column[by_token], column, side="right") - low, 0)
    work = np.bincount(row, length, m)
    uses = np.sort(uses)[column]  # of each entry's token
    frequent = np.flatnonzero(uses > max(1, m // 32))
    frequent = frequent[np.argsort(column[frequent], kind="stable")]
    dense_row, dense_column = row[frequent], np.unique(column[frequent], return_inverse=True)[1]
    dense_width = int(dense_column[-1]) + 1 if len(dense_column) else 1
    rare = np.flatnonzero((uses > 1) & (uses <= max(1, m // 32)))
    rare_row, rare_uses = row[rare], uses[rare]
    by_rare = rare[np.argsort(column[rare], kind="stable")]
    rare_rows, rare_low = row[by_rare], np.searchsorted(column[by_rare], column[rare])
    links, label, high = np.zeros(m), np.arange(m), max(1, 2_000_000 // m)
    for a in range(0, m, high):
        b = min(m, a + high)
        if work[a:b].sum() > (b - a) * m // 4:  # most pairs meet
            s = _dense(dense_row, dense_column, m, dense_width, a, b)
            at, to = np.searchsorted(rare_row, [a, b])
            total = np.cumsum(rare_uses[at:to])
            while at < to:  # tokens of few sets, pair by pair
                upto = at + max(1, int(np.searchsorted(total, 1_000_000, side="right")))
                count, total = rare_uses[at:upto], total[upto - at:] - total[upto - at - 1]
                ends = np.cumsum(count)
                other = rare_rows[np.repeat(rare_low[at:upto] - (ends - count), count) + np.arange(ends[-1])]
                np.add.at(s.reshape(-1), (np.repeat(rare_row[at:upto], count) - a) * m + other, 1)
                at = upto
            linked = s >= similarity * (n[a:b, None] + n[None, :] - s) - 1e-4
            linked &= np.arange(m)[None, :] > np.arange(a, b)[:, None]
            if block is not None:
                linked &= block[a:b, None] != block[None, :]
            links[a:b] += linked @ weight
            links += weight[a:b] @ linked
            i, j = np.nonzero(linked)
            i += a
        else:
            own = slice(int(starts[a]), int(starts[b - 1] + n[b - 1]))
            count = length[own].astype(np.int64)
            ends = np.cumsum(count)
            j = meets[np.repeat(low[own] - (ends - count), count) + np.arange(ends[-1])]
            i = np.repeat(row[own], count)
            near = (j > i) & (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9)
            if block is not None:
                near &= block[i] != block[j]
            pairs = np.unique((i[near] - a) * m + j[near])
            i, j = pairs // m + a, pairs % m
            s, size, at = np.zeros(len(pairs)), np.minimum(n[i], n[j]), 0
            little, other = np.where(n[i] <= n[j], i, j), np.where(n[i] <= n[j], j, i)
            total = np.cumsum(size)
            while at < len(pairs):
                to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + 2_000_000, side="right")))
                k, pair = size[at:to], np.repeat(np.arange(at, to), size[at:to])
                token = column[np.repeat(starts[little[at:to]] - (np.cumsum(k) - k), k) + np.arange(len(pair))]
                probe = other[pair] * width + token
                found = every[np.minimum(np.searchsorted(every, probe), len(every) - 1)] == probe
                s[at:to] = np.bincount(pair[found] - at, minlength=to - at)
                at = to
            linked = s >= similarity * (n[i] + n[j] - s) - 1e-4
            i, j = i[linked], j[linked]
            links += np.bincount(i, weight[j], m) + np.bincount(j, weight[i], m)
        tied = np.flatnonzero(label != np.arange(m))  # a forest of the rows before is enough
        label = forest(m, np.concatenate([tied, i]), np.concatenate([label[tied], j]))
    return links, label


def _exact(p: Join):
    def compare(table: pa.Table) -> pa.Table:
        group, id_ = table.column("label").to_numpy(), table.column("id").to_numpy()
        copies, block = table.column("copies").to_numpy(), table.column("block").to_numpy()
        crossing = table.column("across").to_numpy(zero_copy_only=False)
        bounds, grams = ngram_sets(W.strings(table.column("text").combine_chunks()), p.words)
        good = np.array([k == e for k, e in zip(set_keys(bounds, grams), table.column("set_key").to_pylist())], bool)
        order = np.argsort(group, kind="stable")
        order = order[good[order]]
        starts = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0])) if len(order) else []
        ids, links, labels = [], [], []
        for a, b in zip(starts, np.append(starts[1:], len(order))):
            own = order[a:b]
            own = own[np.unique(id_[own], return_index=True)[1]]
            across = block[own] if crossing[own[0]] else None
            count, label = _links([grams[bounds[i]:bounds[i + 1]] for i in own], copies[own].astype(np.float64), across, p.similarity)
            ids.append(id_[own])
            links.append(count.astype(np.int64))
            labels.append(id_[own][label])
        return pa.table([pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (ids, links, labels)], ["id", "links", "label"])

    return compare


def _classes(docs: DataFrame, p: Join, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Every document (doc_id, row_key, set_key), and every set with its class: set_key, class_id, class_row
    (row key of the document that stands for the class), copies, links."""
    slim = scratch.keep(_described(docs, p), "sets")
    first = slim.where("set_key is not null").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "row_key")).alias("least"), F.count(F.lit(1)).alias("copies"), F.first("sig").alias("sig"), F.first("paths").alias("paths"))
    sets = scratch.keep(first.withColumn("id", F.monotonically_increasing_id()), "distinct")
    maybe = components(scratch, _ties(scratch, sets, p), "maybe")

    texts = docs.select(_row_key().alias("row_key"), "text").where("text is not null")
    chosen = sets.select("id", F.col("least.row_key").alias("row_key"), "set_key", "copies").join(maybe, "id")
    # Wholly repeated rows have one key: one text of them is enough.
    found = scratch.keep(chosen.join(texts, "row_key").groupBy("id", "set_key", "copies", "label").agg(F.first("text").alias("text")), "texts")
    weights = found.groupBy("label").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("members"))
    total = weights.agg(F.sum("bytes")).first()[0] or 0
    blocks = F.ceil(F.greatest(F.col("bytes") / p.block_bytes, F.col("members") / p.block_sets))
    weighed = found.join(weights.select("label", blocks.alias("blocks")), "label")
    # A small group goes with others into one task; a large one becomes pairs of blocks.
    bundle = F.struct(F.pmod(F.xxhash64("label"), F.lit(max(1, total // p.block_bytes))).alias("job"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    small = weighed.where("blocks <= 1").withColumns({"block": F.lit(0), "across": F.lit(False), "key": bundle})
    other = weighed.where("blocks > 1").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
    pair = F.struct(F.col("label").alias("job"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    other = other.withColumns({"across": F.col("block") != F.col("other"), "key": pair})
    columns = ["key", "label", "id", "copies", "block", "across", "text", "set_key"]
    jobs = small.select(columns).unionByName(other.select(columns))
    counted = scratch.keep(jobs.groupBy("key").applyInArrow(lean_group(_exact(p)), "id long, links long, label long"), "links")

    classes = components(scratch, counted.select(F.col("id").alias("a"), F.col("label").alias("b")), "classes")
    links = counted.groupBy("id").agg(F.sum("links").alias("links"))
    named = sets.select("set_key", "id", "least", "copies").join(classes, "id", "left").join(links, "id", "left")
    named = named.withColumn("label", F.coalesce("label", "id"))
    smallest = named.groupBy("label").agg(F.min("least").alias("of_class"))
    named = named.join(smallest, "label").select(
        "set_key", F.col("of_class.doc_id").alias("class_id"), F.col("of_class.row_key").alias("class_row"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
    return slim.select("doc_id", "row_key", "set_key"), named


def near_duplicates(docs: DataFrame, p: Join = Join(), scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its group of linked documents), n_copies
    (documents with the same set, itself included), n_links (other documents at the similarity or above)."""
    slim, named = _classes(docs, p, scratch or Scratch(docs.sparkSession, "jaccard"))
    out = slim.select("doc_id", "set_key").join(named, "set_key", "left")
    real = {c: F.nullif(F.col(c), F.lit(LAST)) for c in ("doc_id", "class_id")}
    return out.select(
        real["doc_id"].alias("doc_id"), F.coalesce(real["class_id"], real["doc_id"]).alias("class_id"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"), (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"))


def one_per_class(docs: DataFrame, p: Join = Join()) -> DataFrame:
    """One document of each class, with all its columns: one with the smallest id, whichever ids are null or repeat.

    A document without words is a class of its own, so all of them stay.
    """
    slim, named = _classes(docs, p, Scratch(docs.sparkSession, "jaccard"))
    kept = named.select(F.col("class_row").alias("row_key"), F.lit(True).alias("words")).distinct().unionByName(
        slim.where("set_key is null").select("row_key", F.lit(False).alias("words")).distinct())
    rows = docs.select(_row_key().alias("row_key"), F.struct(*docs.columns).alias("row"))
    left = rows.join(kept, "row_key").withColumn("alone", F.when(~F.col("words"), F.monotonically_increasing_id()))
    first = Window.partitionBy("row_key", "alone").orderBy(F.lit(0))
    return left.withColumn("n", F.row_number().over(first)).where("n = 1").select("row.*")
