"""Mixing, sharding and packing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpus import DOCS, odd_rows, rows, with_clashing

from tidemark.llm.mixing import Mix, mix_sources, resample
from tidemark.llm.packing import Capacity, pack_documents, pack_histogram
from tidemark.llm.scratch import Scratch, running_totals
from tidemark.llm.sharding import even_cuts, shard_documents, smallest_capacity

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def plain_targets(sizes, p):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: p.weights[i % len(p.weights)] for i, s in enumerate(names)}
    full: set = set()
    while True:
        rest = [s for s in names if s not in full]
        level = (sum(sizes.values()) - sum(p.most_copies * sizes[s] for s in full)) / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if level * weight[s] > p.most_copies * sizes[s]}
        if not over:
            return {s: float(p.most_copies * sizes[s]) if s in full else level * weight[s] for s in names}
        full |= over


@pytest.mark.parametrize("data", [rows(200, 2), odd_rows(), []], ids=["plain", "odd", "empty"])
def test_mix(spark, data):
    p, sizes, largest = Mix(), Counter(), Counter()
    for _, text, _, source, _ in data:
        n = len((text or "").split())
        sizes[source] += n
        largest[source] = max(largest[source], n)
    target = plain_targets(sizes, p) if data else {}
    got = mix_sources(spark.createDataFrame(data, DOCS)).collect()
    assert len(got) == len(data)
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= p.most_copies * r["size"] and r["taken"] == r["times"] * r["size"]
        taken[r["source"]] += r["taken"]
    for source in sizes:
        assert abs(taken[source] - target[source]) <= max(1, largest[source] / 2)


def test_mix_is_repeatable_and_skewed(spark):
    data = [(i, f"w{i} " * (1 + i % 9), "en", "hot" if i % 3 else f"s{i % 7}", 1) for i in range(600)]
    one, two = ({r["doc_id"]: r["taken"] for r in mix_sources(spark.createDataFrame(data, DOCS).repartition(n)).collect()} for n in (2, 7))
    assert one == two


def test_resample_repeats_rows(spark):
    df = with_clashing(spark.createDataFrame(rows(80, 4), DOCS))
    times = {r["doc_id"]: r["times"] for r in mix_sources(df).collect()}
    out = resample(df)
    assert out.columns == df.columns
    assert Counter(r["doc_id"] for r in out.select("doc_id").collect()) == Counter({i: n for i, n in times.items() if n})


@pytest.mark.parametrize("seed", range(4))
def test_resample_of_null_and_repeated_ids(spark, seed):
    """A third of the ids are null and many rows are equal: rows out are the copies of the mix, text by text."""
    rng = random.Random(seed)
    data = []
    for i in range(240):
        text = " ".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 1, 2, 9])))
        data.append((None if i % 3 == 0 else i // 4, text if i % 11 else None, "en", rng.choice(["a", "b", None, "hot", "hot"]), i % 2))
    df = with_clashing(spark.createDataFrame(data, DOCS).repartition(5))
    by_key, source = Counter(), Counter()
    mixed = mix_sources(df).collect()
    for r in mixed:
        by_key[r["doc_id"], r["source"], r["size"]] += r["times"]
        source[r["source"]] += r["taken"]
    out = resample(df)
    assert out.columns == df.columns
    rows_ = out.collect()
    assert Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in rows_) == +by_key
    own = Counter()
    for r in rows_:
        own[r["source"]] += len((r["text"] or "").split())
    assert own == +source
    given = Counter((i, t, s) for i, t, _, s, _ in data)
    for key, n in Counter((r["doc_id"], r["text"], r["source"]) for r in rows_).items():
        assert n <= Mix().most_copies * given[key]


def test_running_totals_split_equal_rows(spark):
    scratch = Scratch(spark, "t")
    df = scratch.keep(spark.createDataFrame([(1, 5)] * 400 + [(2, 7)] * 3, "a int, b int").repartition(4), "rows")
    got = running_totals(scratch, df, ["a"], ["b"], stored=True)
    assert got.columns == ["a", "b", "position", "b_before"]
    assert sorted(r["b_before"] for r in got.collect()) == [5 * i for i in range(400)] + [2000, 2007, 2014]


def test_running_totals(spark):
    data = [(random.Random(5).randint(0, 9), i % 17, i) for i in range(300)]
    df = spark.createDataFrame(data, "a int, b int, c int").repartition(6)
    got = sorted(running_totals(Scratch(spark, "t"), df, ["a", "b", "c"], ["b"]).collect(), key=lambda r: r["position"])
    total = 0
    for at, (r, want) in enumerate(zip(got, sorted(data))):
        assert (r["a"], r["b"], r["c"], r["position"], r["b_before"]) == (*want, at, total)
        total += r["b"]


def greedy(sizes, capacity):
    n, now = 1, 0
    for s in sizes:
        if now + s > capacity:
            n, now = n + 1, 0
        now += s
    return n


@pytest.mark.parametrize("seed", range(6))
def test_smallest_capacity(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 7, 40, rng.randint(1, 900)]) for _ in range(rng.choice([3, 40, 400]))]
    ends = np.cumsum(sizes).tolist()
    df = spark.createDataFrame(list(zip(ends, sizes)), "ends long, bytes long")
    shards = rng.choice([2, 5, 24])
    capacity, cuts = smallest_capacity(df, shards, cells=rng.choice([8, 50, 5000]))
    best = next(c for c in range(max(sizes), sum(sizes) + 1) if greedy(sizes, c) <= shards)
    assert capacity == best and cuts[-1] == ends[-1] and set(cuts) <= set(ends)


@pytest.mark.parametrize("data", [rows(120, 6), odd_rows(), []], ids=["plain", "odd", "empty"])
def test_shards(spark, data):
    got = shard_documents(spark.createDataFrame(data, DOCS), 5).collect()
    texts = defaultdict(list)
    for i, text, *_ in data:
        texts[i].append(text)
    assert len(got) == len(data)
    slots, bytes_, home = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        sizes = {len((t or "").encode()) + 8: zlib.crc32((t or "").encode()) for t in texts[r["doc_id"]]}
        assert sizes[r["size"]] == r["text_crc32"] or len(texts[r["doc_id"]]) > 1
        slots[r["shard"]].append(r["slot"])
        bytes_[r["shard"]] += r["size"]
        home[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for i, text, *_ in data:
        first, size = groups.get(text, (float("inf"), 0))
        groups[text] = (min(first, -1 if i is None else i), size + len((text or "").encode()) + 8)
    if data:
        sizes = [s for _, s in sorted(groups.values())]
        assert max(bytes_.values()) == next(c for c in range(max(sizes), sum(sizes) + 1) if greedy(sizes, c) <= 5)


@pytest.mark.parametrize("seed", range(8))
def test_even_cuts(seed):
    rng = random.Random(seed)
    for _ in range(60):
        sizes = [rng.choice([1, 7, 40, rng.randint(1, 900)]) for _ in range(rng.randint(1, 90))]
        if rng.random() < 0.5:
            sizes[rng.randrange(len(sizes))] = sum(sizes) // rng.choice([1, 2, 3])
        sizes = [max(1, s) for s in sizes]
        shards = rng.choice([1, 2, 5, 24])
        ends = np.cumsum(sizes).tolist()
        best = next(c for c in range(max(sizes), sum(sizes) + 1) if greedy(sizes, c) <= shards)
        large = [(e - s, e) for s, e in zip(sizes, ends) if s > ends[-1] / shards]
        cuts = even_cuts(ends, large, best, shards)
        filled = np.diff([0, *cuts])
        assert len(cuts) == shards and cuts[-1] == ends[-1] and set(cuts) <= set(ends) and filled.max() == best
        assert (filled > 0).sum() == min(shards, len(sizes))


def test_no_shard_is_empty_beside_a_large_group(spark):
    data = [(i, "the same text" if i % 3 == 0 else f"own text {i:05d}", "en", "s", 1) for i in range(3000)]
    got = shard_documents(spark.createDataFrame(data, DOCS), 24).groupBy("shard").sum("size").collect()
    sizes = sorted(r["sum(size)"] for r in got)
    assert len(sizes) == 24 and sizes[-1] == 1000 * 21 and sizes[-2] <= 1.1 * sum(sizes[:-1]) / 23 and sizes[0] >= 0.8 * sizes[-2]


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limit", [Capacity(tokens=64, pieces=64, attention=64 * 64), Capacity(tokens=64, pieces=3, attention=1500)])
def test_histogram_plan(rule, limit):
    rng = np.random.default_rng(3)
    limit = Capacity(limit.tokens, limit.pieces, limit.attention, limit.weights, rule)
    counts = {int(n): int(k) for n, k in zip(*np.unique(rng.integers(1, 36, 3000), return_counts=True))}
    bins = defaultdict(list)
    placed = Counter()
    for length, first, n, sequence, offset in pack_histogram(counts, limit).tolist():
        assert first == placed[length]
        placed[length] += n
        for i in range(n):
            bins[sequence + i].append((offset, length))
    assert placed == counts
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *[n for _, n in pieces][:-1]]).tolist()
        assert sum(n for _, n in pieces) <= 64 and len(pieces) <= limit.pieces and sum(n * n for _, n in pieces) <= limit.attention
    if limit.pieces == 64:
        assert len(bins) <= 1.02 * sum(n * k for n, k in counts.items()) / 64 + 1


@pytest.mark.parametrize("data", [rows(50, 8), odd_rows(), []], ids=["plain", "odd", "empty"])
def test_pack_round_trip(spark, data):
    from tokenizers import Tokenizer

    extra = [(900, "İstanbul's 12.5% don't. x!!", "en", "a", 1), (901, "<|endoftext|> A <|ENDOFTEXT|>.", "en", "a", 1), (902, "é. 日本語。 a\u200db", "en", "a", 1)]
    data = data + (extra if data else [])
    tokenizer, want = Tokenizer.from_file(TOKENIZER), Counter()
    for i, text, *_ in data:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            want[i, k, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes())] += 1
    got = pack_documents(spark.createDataFrame(data, DOCS), TOKENIZER).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *[n for _, n in pieces][:-1]]).tolist() and sum(n for _, n in pieces) <= 4096
