"""Byte pairs against the tokenizers library; clustering and hard negatives against plain loops."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from corpus import DOCS, odd_rows, rows, with_clashing
from pyspark.sql import functions as F

from tidemark.llm import byte_pairs, centroids, hard_negatives, hilbert
from tidemark.llm.byte_pairs import BytePairs

PATH = public_tokenizers.path("byte_bpe_50k.json")
VECTORS = "vec_id long, embedding array<float>, label int"
TEXTS = [
    "", " ", "  ", "   x", "don't we'll they've I'm 's's ''s 'something \n's  's x're'r'l'll'lll 'S", "<|endoftext|> a<|endoftext|><|endof", "text|> b",
    "\n\n\n x\t\ty  z ", "日本語 テキスト　全角 ａ", "é İstanbul's ١٢٣ ²³ x²", "a‍b́ 👨‍👩‍👧", "\r\n \r\n", "'", "a'", "'l", "'r", " 's",
    "!!'s x!'s", "a" * 20_000, "ab\x00\x01c\x85 d\x1c\x1de", "1234567 3.14", "﻿x�",
]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def check_texts(texts):
    pairs, tokenizer = byte_pairs.loaded(PATH), library()
    bounds, ids = pairs.encode(pa.array(texts, pa.large_string()))
    decoded = pairs.decode(bounds, ids).to_pylist()
    for i, text in enumerate(texts):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[bounds[i]:bounds[i + 1]].tolist() == want, repr(text[:80])
        assert decoded[i] == tokenizer.decode(want, skip_special_tokens=False)


def test_byte_pairs_of_odd_texts():
    check_texts(TEXTS)
    check_texts(TEXTS[::-1])


@pytest.mark.parametrize("letters", ["ab'sltredmv  \n\t1 2!.,é日  '’²x<|>", "".join(map(chr, range(0x20, 0x250))), None])
def test_byte_pairs_of_random_texts(letters):
    rng = random.Random(7)
    any_ = lambda: chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF), rng.randint(32, 126)]))
    check_texts(["".join(rng.choice(letters) if letters else any_() for _ in range(rng.randint(0, 40))) for _ in range(1500)])


def test_forced_boundaries_are_those_of_the_vocabulary():
    pairs, alphabet = BytePairs(PATH), byte_pairs.byte_alphabet()
    of = {c: i for i, c in enumerate(alphabet)}
    inside = {(of[a], of[b]) for t in library().get_vocab(with_added_tokens=False) if t != "<|endoftext|>" for a, b in itertools.pairwise(t)}
    assert {tuple(p) for p in np.argwhere(~pairs.forced).tolist()} == inside
    assert pairs.forced.mean() > 0.9


def test_remembered_fragments_are_bounded(monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 3000)
    pairs, tokenizer = BytePairs(PATH), library()
    for i in range(30):
        text = " ".join(f"word{i}x{j} é{j}" for j in range(i, i + 9))
        assert pairs.encode(pa.array([text], pa.large_string()))[1].tolist() == tokenizer.encode(text).ids
        assert pairs._size <= 3000


@pytest.mark.parametrize("data", [rows(60, 5), odd_rows(), []], ids=["plain", "odd", "empty"])
def test_byte_pairs_of_documents(spark, data):
    tokenizer, want = library(), Counter()
    for i, text, *_ in data:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False))]
        want[i, len(ids), *sha] += 1
    docs = with_clashing(spark.createDataFrame(data, DOCS))
    coded = byte_pairs.encode(docs, PATH, decoded="again")
    assert coded.columns == [*docs.columns, "token_ids", "again"]
    assert Counter(map(tuple, byte_pairs.digests(coded, decoded="again").collect())) == want
    back = byte_pairs.decode(coded.select("doc_id", "token_ids"), PATH)
    assert Counter(r["decoded"] for r in back.collect()) == Counter(r["again"] for r in coded.collect())
    with pytest.raises(ValueError):
        byte_pairs.encode(docs, PATH, ids="hash")


def test_decode_of_odd_ids(spark):
    got = byte_pairs.decode(spark.createDataFrame([(1, None), (2, []), (3, [72, None, 10**6, -1, 50256]), (4, [165])], "doc_id int, token_ids array<int>"), PATH)
    assert [r["decoded"] for r in got.orderBy("doc_id").collect()] == ["", "", library().decode([72]) + "<|endoftext|>", "�"]


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (5, 2)])
def test_curve_visits_neighbouring_cells(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    at = hilbert.place(cells, bits)
    assert sorted(at.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(axis=1) == 1).all()


def vector_rows(n=160, width=6, seed=3, hot=True, clustered=False):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, width)) * 3
    data = []
    for i in range(n):
        v = centres[i % 4] + 0.05 * rng.standard_normal(width) if clustered else rng.standard_normal(width)
        v = v / np.linalg.norm(v)
        if hot and i % 3 == 0:
            v = centres[0] / np.linalg.norm(centres[0])
        data.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 3))))
    return data


def odd_vectors(width=6):
    one = [0.5] * width
    return vector_rows(40, width) + [
        (100, None, 1), (101, one, None), (102, [None, *one[1:]], 1), (103, [float("nan"), *one[1:]], 1), (104, [float("inf"), *one[1:]], 1),
        (105, [], 1), (106, [0.0] * width, 2), (None, one, 1), (None, one, 2), (200, one, 1), (200, one, 1), (200, [-x for x in one], 1), (300, one, 0), (301, one, 0),
    ]


def good(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def ints(v, width):
    return [int(x) for x in np.floor(256 * np.array(v + [0.0] * (width - len(v)), np.float64))]


def plain_clusters(data, p):
    kept = [(i, ints(v, p.width)) for i, v, *_ in data if good(v) and len(v) == p.width]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{p.seed}:{r[0]}".encode()).hexdigest(), [-x for x in np.array(r[1], "<i4").tobytes()]))
    c = [q for _, q in order[:p.clusters]]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, one)), k) for k, one in enumerate(c))
    for _ in range(p.rounds):
        own = [near(q)[1] for _, q in kept]
        for k in set(own):
            mine = [q for (_, q), o in zip(kept, own) if o == k]
            c[k] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [(i, *near(q)) for i, q in kept]
    inertia = Counter()
    for _, d, k in last:
        inertia[k] += d
    return Counter((i, k, d, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest()) for i, d, k in last)


@pytest.mark.parametrize("data", [vector_rows(), vector_rows(200, hot=False), odd_vectors(), odd_vectors()[:3], []], ids=["hot", "plain", "odd", "few", "empty"])
@pytest.mark.parametrize("size", [7, 256])
def test_centroids(spark, data, size):
    p = centroids.Clustering(clusters=9, rounds=3, width=6, curve=hilbert.Curve(dims=4, bits=3, size=size))
    df = with_clashing(spark.createDataFrame(data, VECTORS).drop("label")).repartition(3)
    got, c = centroids.cluster(df, p)
    got = got.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroids.digest(c))
    assert Counter(map(tuple, got.collect())) == plain_clusters(data, p)


def test_box_bounds_leave_fewer_candidates(spark):
    p = centroids.Clustering(clusters=12, rounds=1, width=6, curve=hilbert.Curve(dims=4, bits=3, size=10))
    df = spark.createDataFrame(vector_rows(400, hot=False, clustered=True), VECTORS)
    _, c = centroids.cluster(df, p)
    found = centroids.candidates_per_block(df, c, p).collect()
    assert sum(r["n"] for r in found) == 400 and sum(r["candidates"] for r in found) < 0.7 * len(found) * len(c)


def test_large_components_stay_exact(spark):
    data = [(i, [400_000.0 + i, -399_999.5 * (i % 2), 0.25], 1) for i in range(30)]
    p = centroids.Clustering(clusters=3, rounds=2, width=3)
    got, c = centroids.cluster(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"), p)
    assert Counter(map(tuple, got.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroids.digest(c)).collect())) == plain_clusters(data, p)
    with pytest.raises(Exception, match="no exact distance"):
        centroids.cluster(spark.createDataFrame([(1, [1e12, 0.0, 0.0], 1)], "vec_id long, embedding array<double>, label int"), p)


def plain_negatives(data, every, p):
    kept = [(float("inf") if i is None else i, n, label, v) for n, (i, v, label) in enumerate(data) if good(v) and label is not None]
    width = max([len(v) for *_, v in kept], default=1)
    kept = [(i, n, label, ints(v, width)) for i, n, label, v in kept]
    real = lambda i: None if i == float("inf") else i
    out = Counter()
    for i, n, label, q in kept:
        if i == float("inf") or i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, o)), j, m, other) for j, m, other, o in kept if m != n)
        for ps, j, *_ in [s for s in scored if s[3] == label][:p.positives]:
            window = [s for s in scored if s[3] != label and p.least * -ps <= 100 * -s[0] <= 100 * -ps][:p.negatives]
            for rank, (ns, k, *_) in enumerate(window, 1):
                out[i, real(j), rank, real(k), -ps, -ns] += 1
    return out


SMALL = hard_negatives.Mining(positives=3, negatives=4, group=3, groups=2, page_bits=1, pages=2, first=2, curve=hilbert.Curve(dims=4, bits=3, size=8))


@pytest.mark.parametrize("data", [vector_rows(), vector_rows(150, hot=False), odd_vectors(), []], ids=["hot", "plain", "odd", "empty"])
@pytest.mark.parametrize("p", [SMALL, hard_negatives.Mining()], ids=["small", "whole"])
def test_hard_negatives(spark, data, p):
    df = with_clashing(spark.createDataFrame(data, VECTORS).withColumnRenamed("label", "kind")).drop("label").withColumnRenamed("kind", "label").repartition(3)
    got = hard_negatives.Miner(df, F.col("vec_id") % 10 == 0, F.col("label"), p).mine()
    assert Counter(map(tuple, got.collect())) == plain_negatives(data, 10, p)


def test_zone_maps_spare_blocks(spark):
    data = vector_rows(600, hot=False, clustered=True)
    miner = hard_negatives.Miner(spark.createDataFrame(data, VECTORS), F.col("vec_id") % 20 == 0, F.col("label"), SMALL)
    assert Counter(map(tuple, miner.mine().collect())) == plain_negatives(data, 20, SMALL)
    assert miner.read < 0.6 * 2 * miner.groups.count() * miner.blocks.count()


def test_score_bounds_hold():
    rng = np.random.default_rng(2)
    a, x = rng.integers(-300, 300, (7, 5)), rng.integers(-300, 300, (90, 5))
    boxes = x.reshape(9, 10, 5)
    low, high = boxes.min(axis=1), boxes.max(axis=1)
    s = (a @ x.T).reshape(7, 9, 10)
    least, most = hard_negatives.score_bounds(a, low, high)
    assert (least <= s.min(axis=2)).all() and (s.max(axis=2) <= most).all()
    least, most = hard_negatives.interval_bounds(a.min(axis=0), a.max(axis=0), low, high)
    assert (least <= s.min(axis=(0, 2))).all() and (s.max(axis=(0, 2)) <= most).all()
