"""Exact dedup, substring dedup and the Jaccard join against plain loops."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import DOCS, odd_rows, rows, with_clashing

from tidemark.llm import substring_dedup
from tidemark.llm.exact_dedup import deduplicate, duplicate_groups
from tidemark.llm.jaccard_join import BINS, DEEPER, Join, _links, choose, near_duplicates, one_per_class
from tidemark.llm.substring_dedup import later_windows, longest_repeats


def order(i):
    return (i is None, i)


def plain_groups(data):
    groups = defaultdict(list)
    for i, text, *_ in data:
        groups[re.sub("[ \t-\r]+", " ", text or "")].append(i)
    out = Counter()
    for i, text, *_ in data:
        t = re.sub("[ \t-\r]+", " ", text or "")
        keep = min(groups[t], key=order)
        out[i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("data", [rows(), odd_rows(), []], ids=["plain", "odd", "empty"])
def test_exact_groups(spark, data):
    df = spark.createDataFrame(data, DOCS)
    assert Counter(tuple(r) for r in duplicate_groups(df).collect()) == plain_groups(data)


def test_deduplicate_keeps_rows_whole(spark):
    df = with_clashing(spark.createDataFrame(odd_rows(), DOCS))
    left = deduplicate(df)
    assert left.columns == df.columns
    # null, '' and white space: the first is empty like the second, the third is one space
    assert sorted((r["doc_id"] for r in left.collect()), key=order) == [1, 3, 4, 5, 6, 7]


def plain_windows(data, window=13):
    starts = defaultdict(set)
    for i, text, *_ in data:
        w = (text or "").encode().split()
        for k in range(len(w) - window + 1):
            starts[tuple(w[k:k + window])].add((i is None, i or 0))
    out = Counter()
    for i, text, *_ in data:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if min(starts[tuple(w[k:k + window])]) < (i is None, i or 0):
                gone[k:k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("data", [rows(80, 3), odd_rows(), []], ids=["plain", "odd", "empty"])
def test_later_windows(spark, data):
    df = spark.createDataFrame(data, DOCS)
    if data:
        df = df.repartition(5)
    got = Counter(tuple(r) for r in later_windows(df).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert got == plain_windows(data)


def test_longest_repeats_doubles_until_nothing_is_shared(spark):
    data = rows(40, 5)
    got = {(r["doc_id"], r["start"]): (r["length"], r["later"]) for r in longest_repeats(spark.createDataFrame(data, DOCS)).collect()}
    want = {}
    for length in (13, 26, 52, 104, 208):
        places = defaultdict(list)
        for i, text, *_ in data:
            w = text.split()
            for k in range(len(w) - length + 1):
                places[tuple(w[k:k + length])].append((i, k))
        for found in places.values():
            if len({i for i, _ in found}) > 1:
                want |= {(i, k): (length, i > min(found)[0]) for i, k in found}
    assert want and got == want


def plain_links(data, n=5, limit=0.8):
    sets = []
    for i, text, *_ in data:
        w = (text or "").encode().split()
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()})
    links, group = Counter(), list(range(len(data)))
    for a in range(len(data)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= limit * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                group = [group[b] if g == group[a] else g for g in group]
    smallest = {g: min((data[i][0] for i in range(len(data)) if group[i] == g), key=order) for g in set(group)}
    return Counter((data[i][0], smallest[group[i]], links[i]) for i in range(len(data)))


@pytest.mark.parametrize("join", [Join(), Join(small=4, depth=2), Join(block_bytes=600)], ids=["default", "deep", "blocks"])
def test_near_duplicates(spark, join):
    data = rows(90, 7)
    got = near_duplicates(spark.createDataFrame(data, DOCS), join)
    assert Counter(tuple(r) for r in got.select("doc_id", "class_id", "n_links").collect()) == plain_links(data)


def test_near_duplicates_odd(spark):
    data = odd_rows()
    got = near_duplicates(spark.createDataFrame(data, DOCS))
    assert Counter(tuple(r) for r in got.select("doc_id", "class_id", "n_links").collect()) == plain_links(data)
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_one_per_class_keeps_rows_whole(spark):
    df = with_clashing(spark.createDataFrame(rows(30, 7), DOCS))
    left = one_per_class(df)
    classes = near_duplicates(df).select("class_id").distinct().count()
    assert left.columns == df.columns and left.count() == classes < 30


def test_pairs_meet_although_every_bucket_is_split():
    p, pairs = Join(), 20_000
    rng = np.random.default_rng(1)
    equal = rng.binomial(BINS, p.similarity, pairs)  # the first bins of a pair are its equal ones
    tokens = rng.integers(0, 1 << 62, (pairs, BINS)).astype(np.uint64)
    met = np.zeros(pairs, bool)
    for seed in rng.integers(0, 1 << 62, p.runs).astype(np.uint64):
        pair, path = np.arange(pairs), np.full(pairs, seed)
        for level in range(p.depth):
            share = np.where(np.arange(BINS) < equal[pair][:, None], p.chosen * (DEEPER if level else 1) / BINS, 0.0)
            i, path = choose(path, tokens[pair], share)
            pair = pair[i]
        met[pair] = True
    # 0.0001 of the pairs may be missed: two, and seven or more with a chance of 0.5 per cent
    assert np.count_nonzero(~met) < 7


def test_one_per_class_with_null_and_repeated_ids(spark):
    data = rows(60, 7)
    ids = [None if i % 3 == 0 else i // 4 for i in range(60)]
    data = [(i, *r[1:]) for i, r in zip(ids, data)] + [(None, "", "en", "s", 0), (None, " ", "en", "s", 1), (None, "", "en", "s", 0)]
    data += data[:3]
    df = spark.createDataFrame(data, DOCS)
    sets = []
    for _, text, *_ in data:
        w = text.split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    group = list(range(len(data)))
    for a in range(len(data)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    want = Counter(min((data[i][0] for i in range(len(data)) if group[i] == g), key=order) for g in set(group))
    left = one_per_class(df).collect()
    assert Counter(r["doc_id"] for r in left) == want
    texts = defaultdict(set)
    for i, (_, text, *_) in enumerate(data):
        texts[text].add(group[i])
    named = Counter(g for r in left if r["text"].split() for g in texts[r["text"]])
    assert named and set(named.values()) == {1}  # one document of each class
    got = near_duplicates(df).select("doc_id", "class_id", "n_links").collect()
    assert Counter(tuple(r) for r in got) == plain_links(data)


def test_null_and_repeated_ids_do_not_share_one_answer(spark, monkeypatch):
    data = [(None if i % 3 == 0 else i // 4, *r[1:]) for i, r in enumerate(rows(80, 3))]
    data += data[:10] * 2
    seen, answers = [], substring_dedup._answers
    monkeypatch.setattr(substring_dedup, "_answers", lambda entries: seen.append(answers(entries)) or seen[-1])
    df = spark.createDataFrame(data, DOCS).repartition(3)
    got = Counter(tuple(r) for r in later_windows(df).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert got == plain_windows(data)
    longest = max(len(text.split()) for _, text, *_ in data)
    for frame in seen:
        assert frame.selectExpr("max(size(answers))").first()[0] <= 4 * longest


@pytest.mark.parametrize("seed", range(30))
def test_links_inside_a_group(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 40, int(rng.integers(1, 30)))
    sets = [np.unique(np.concatenate([base[rng.random(len(base)) < 0.9], rng.integers(0, 200, rng.integers(0, 4))]).astype(np.uint64)) for _ in range(50)]
    sets = [s for s in sets if len(s)] + [np.array([7], np.uint64)]
    m, weight, block = len(sets), rng.integers(1, 5, len(sets)).astype(float), rng.integers(0, 2, len(sets)) if seed % 2 else None
    links, label = _links(sets, weight, block, 0.8)
    want, near = np.zeros(m), []
    for i, j in itertools.combinations(range(m), 2):
        both = len(set(sets[i].tolist()) & set(sets[j].tolist()))
        if (block is None or block[i] != block[j]) and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
            want[i] += weight[j]
            want[j] += weight[i]
            near.append((i, j))
    assert np.allclose(links, want)
    assert all(label[i] == label[j] for i, j in near) and len(set(label.tolist())) == m - len(spanning(m, near))


def spanning(m, edges):
    """Edges that join two components."""
    of, used = list(range(m)), []
    for i, j in edges:
        a, b = of[i], of[j]
        if a != b:
            of = [a if x == b else x for x in of]
            used.append((i, j))
    return used


def test_many_short_sets_of_one_template_take_no_time():
    rng = np.random.default_rng(1)
    sets = [np.unique(np.concatenate([np.arange(5), rng.integers(100, 10**9, 5)]).astype(np.uint64)) for _ in range(8000)]
    start = time.process_time()
    links, _ = _links(sets, np.ones(len(sets)), None, 0.8)
    assert time.process_time() - start < 2 and links.sum() == 0


def test_a_crowd_of_changed_copies(spark):
    """More near copies of one text than a bucket compares pair by pair, some of them at the threshold of each other."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    origin = [rng.choice(words) for _ in range(150)]
    texts = []
    for _ in range(420):
        own = list(origin)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6, 9])):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own))
    grams = [frozenset(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    want = Counter()
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(grams[i] & grams[j])
        if 5 * both >= 4 * (len(grams[i]) + len(grams[j]) - both):
            want[i] += 1
            want[j] += 1
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    assert {r["doc_id"]: r["n_links"] for r in near_duplicates(df, Join(small=60)).collect()} == {i: want[i] for i in range(len(texts))}
