"""Language identification, personal data, url reputation and nearest neighbours."""

import itertools
import math
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from corpus import DOCS, odd_rows, with_clashing

from tidemark.llm import private_data as P
from tidemark.llm.language_id import Lattice, accepted, identify, public_pieces, train
from tidemark.llm.neighbours import Graph, Index
from tidemark.llm.url_filter import domain_of, host_of, judge_urls, path_of, suffix_of

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_forward_sums_all_segmentations():
    pieces, p = ["▁", "▁a", "a", "b", "ab", "▁ab", "bb"], np.array([0.1, 0.2, 0.05, 0.3, 0.15, 0.1, 0.1])
    lattice, at = Lattice(pieces), {x: i for i, x in enumerate(pieces)}

    def whole(text):
        if not text:
            return 1.0
        return sum((p[at[text[:k]]] if text[:k] in at else 1e-7 * (k == 1)) * whole(text[k:]) for k in range(1, len(text) + 1))

    words = ["a", "ab", "abb", "bab", "abcab", "c"]
    table = np.concatenate([np.stack([p, p[::-1]], axis=1), np.zeros((1, 2))])
    got = lattice.forward(words, table)
    assert got[:, 0] == pytest.approx([math.log(whole("▁" + w)) for w in words])
    uses = lattice.expected(words, np.ones(len(words)), p)
    step = 1e-6
    for i in range(len(p)):  # an expected count is the derivative of the log-likelihood by log p
        more = p.copy()
        more[i] *= 1 + step
        moved = lattice.forward(words, np.concatenate([more[:, None], [[0]]]))[:, 0]
        assert uses[i] == pytest.approx((moved - got[:, 0]).sum() / step, rel=1e-3, abs=1e-6)


def test_language(spark):
    rng = random.Random(2)
    parts = {"aa": ["ing", "the", "er", "on"], "bb": ["ção", "que", "os", "ñar"], "cc": ["ich", "ung", "der", "sch"]}
    data = [(i, " ".join("".join(rng.choices(parts[k], k=2)) for _ in range(12)), k, "s", 1) for i, k in enumerate(itertools.islice(itertools.cycle(parts), 120))]
    df = spark.createDataFrame(data, DOCS)
    model = train(df.where("doc_id < 60").select("text", "lang"), public_pieces(PIECES), rounds=2)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(df.where("doc_id >= 60"), model).collect()}
    assert all(got[i][0] == k and 0 <= got[i][1] <= 1 for i, _, k, *_ in data[60:])
    odd = with_clashing(spark.createDataFrame(odd_rows() + [(20, "12 !? ½", "en", "a", 1)], DOCS))
    named = Counter((r["doc_id"], r["lang_pred"] == "und") for r in identify(odd, model).collect())
    assert all(named[i, True] == 1 for i in (1, 2, 3, 20)) and named[4, False] == 2 and sum(named.values()) == 12
    left = accepted(odd, model)
    assert left.columns == odd.columns and left.count() <= 8
    untaught = train(df.where("false").select("text", "lang"), public_pieces(PIECES))
    assert {r["lang_pred"] for r in identify(df, untaught).collect()} == {"und"}
    assert identify(df.where("false"), model).count() == 0


TEXTS = [
    "mail a.b@x.example.com, or ring +1 (269) 555-3296 now", "card 4524132264652876 paid", "host 99.52.99.129 and 300.1.1.1", None, "",
    "4451718024887799 27.65.93.188 two side by side", "+1 (906) 555-7738 4451718024887799 again", "a@b@c.de x@y 1.2.3.4.5.6.7.8", "+" * 50 + "1 2 3 4 5 6 7 8 9",
    "x" * 5000 + "@" + "y" * 5000 + ".com", "write to jo (at) host (dot) com",
]


def test_base_spans_are_those_of_the_patterns():
    for text in TEXTS:
        text = text or ""
        want = [("email", m.start(), m.end()) for m in P.EMAIL.finditer(text)]
        for kind, pattern in (("ip", P.IP), ("card", P.CARD), ("phone", P.PHONE)):
            want += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if P.valid(kind, m.group())]
        assert P.base_spans(text, P.number_runs(text)) == want


def test_private_spans(spark):
    rng = random.Random(4)

    def card():
        digits = [rng.randint(0, 9) for _ in range(15)]
        return next(c for c in ("".join(map(str, digits)) + str(k) for k in range(10)) if P.luhn(c))

    def phone():
        return f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"

    data = []
    for i in range(300):
        parts = [card(), phone(), ".".join(str(rng.randint(1, 255)) for _ in range(4)), "".join(rng.choices("0123456789", k=16)), f"u{i}@m.example.com"]
        rng.shuffle(parts)
        data.append((i, " ".join(f"some words {x} here" for x in parts), "en", "s", 1))
    df = spark.createDataFrame(data, DOCS)
    model = P.fit(df)
    new = [(1000 + i, t, "en", "s", 1) for i, t in enumerate(TEXTS)] + odd_rows()
    got = {(r["doc_id"], r["base_sha256"], r["spans"]): r for r in P.private_spans(with_clashing(spark.createDataFrame(new, DOCS)), model).collect()}
    by_id = {k[0]: r for k, r in got.items()}
    assert "phone:0:17,".replace(",", "") in by_id[1006]["spans"] and "card:18:34" in by_id[1006]["spans"]
    assert "card:0:16" in by_id[1005]["spans"] and "ip:17:29" in by_id[1005]["spans"]
    assert by_id[1003]["spans"] == "" == by_id[7]["spans"] and by_id[1000]["redacted"].startswith("mail [email], or ring [phone]")
    for i, text in enumerate(TEXTS):  # base spans stay
        base = P.base_spans(text or "", P.number_runs(text or ""))
        assert set(P.written(base).split(",")) - {""} <= set(by_id[1000 + i]["spans"].split(","))
    none = P.fit(df.where("false"))
    assert none.trees is None and P.private_spans(df.where("false"), none).count() == 0


OLD_RUN = re.compile(r"[0-9+][0-9 ().+-]{5,}[0-9]")


@pytest.mark.parametrize("letters", ["ab@.-_ %+1", "0123 .-+()", "12.3 -@a+(", "1.22.3 4-5"])
def test_base_spans_are_those_of_the_patterns(letters):
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        want = [("email", m.start(), m.end()) for m in P.EMAIL.finditer(text)]
        for kind, pattern in (("ip", P.IP), ("card", P.CARD), ("phone", P.PHONE)):
            want += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if P.valid(kind, m.group())]
        runs = P.number_runs(text)
        assert runs == [m.span() for m in OLD_RUN.finditer(text)] and P.base_spans(text, runs) == want


@pytest.mark.parametrize("text", ["a@", "+", "1", "+1", "+(", "a", "1.", "1 ", " at a dot", "4111111111111111 ", "x@y.z "], ids=str)
def test_long_texts_take_time_in_proportion(text):
    long, rng = text * (200_000 // len(text)) + "@ dot ", np.random.default_rng(1)
    trees = P.boost(rng.random((200, 27)), rng.integers(0, 2, 200).astype(float))
    start = time.process_time()
    P.find([long], P.Model(trees, (0.99,) * 4))
    assert time.process_time() - start < 6


def test_isotonic_calibration():
    y = np.array([0, 1, 0, 0, 1, 1, 0, 1, 1], float)
    got = P.calibrated(np.arange(9.0), y)
    assert got.tolist() == pytest.approx([0, 1 / 3, 1 / 3, 1 / 3, 2 / 3, 2 / 3, 2 / 3, 1, 1]) and len(P.calibrated(np.zeros(0), np.zeros(0))) == 0


def test_recall_of_forms_that_base_patterns_miss(spark):
    rng = random.Random(8)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    name = lambda: "".join(rng.choices("abcdefghij", k=6))
    lead = {"phone": ["call me at", "phone:", "tel"], "email": ["mail", "write to", "contact"]}

    def text(body, kind):
        return f"some words here {rng.choice(lead[kind])} {body} and others follow {digits(4)}"

    def base():
        if rng.random() < 0.5:
            return text(f"+{rng.choice([1, 44, 49])} {rng.randint(200, 999)} {digits(3)} {digits(4)}", "phone")
        return text(f"{name()}@{name()}.{rng.choice(['com', 'org', 'co.uk'])}", "email")

    noise = lambda: f"order {digits(rng.choice([9, 10, 12]))} was sent in {rng.randint(1990, 2030)} and arrived at the dock"
    docs = [(i, base() if i % 2 else noise(), "en", "s", 1) for i in range(900)]
    model = P.fit(spark.createDataFrame(docs, DOCS))
    planted = {"phone": [], "email": []}
    for _ in range(60):
        planted["phone"].append(rng.choice([f"{rng.randint(200, 999)} {digits(3)} {digits(4)}", f"{rng.randint(200, 999)}{digits(7)}"]))
        planted["email"].append(rng.choice([f"{name()} (at) {name()} (dot) org", f"{name()} at {name()} dot com"]))
    for kind, bodies in planted.items():
        texts = [text(b, kind) for b in bodies]
        found = [[t[a:b] for k, a, b in spans if k == kind] for t, (_, spans) in zip(texts, P.find(texts, model))]
        assert sum(b in f for b, f in zip(bodies, found)) >= 0.9 * len(bodies), kind
    clean = P.find([noise() for _ in range(200)], model)
    assert sum(bool(spans) for _, spans in clean) <= 4


def test_urls(spark):
    urls = ["http://A.Example.COM/de/x?q", "no scheme", None, "https://u@h.co.uk:80#f", "x://y://z/p", "http://net/", "http://a.example.net/en/", "http://b.org/fr/1"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = df.select(host_of(df.url), path_of(df.url)).collect()
    assert [tuple(r) for r in got] == [("a.example.com", "/de/x"), ("", ""), ("", ""), ("u@h.co.uk:80", ""), ("y:", "//z/p"), ("net", "/"), ("a.example.net", "/en/"), ("b.org", "/fr/1")]
    named = df.select(domain_of(host_of(df.url)), suffix_of(host_of(df.url))).collect()
    assert tuple(named[0]) == ("example.com", "com") and tuple(named[3]) == ("h.co.uk", "co.uk") and tuple(named[1]) == ("", "")
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    outcomes = spark.createDataFrame([(0, 1), (0, None)], "page_id long, good int")
    judged = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(df, outcomes, rules).collect()}
    assert judged[0] == ("example.com/de/", "block") and judged[6] == ("example.net/en/", "allow") and judged[5] == ("net/", "block")
    assert judged[2] == (None, "allow") and len(judged) == 8
    assert judge_urls(df.where("false"), outcomes.where("false"), rules).count() == 0


def test_reputation_shrinks(spark):
    pages = [(i, f"http://bad.example.com/{i}") for i in range(200)] + [(i, f"http://good.example.org/{i}") for i in range(200, 600)]
    pages += [(600, "http://new.example.org/"), (601, "http://once.example.org/")]
    outcomes = [(i, 0) for i in range(200)] + [(i, 1) for i in range(200, 600)] + [(601, 0)]
    got = judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, good int"))
    verdict = {r["host"]: r["verdict"] for r in got.collect()}
    assert verdict == {"bad.example.com": "block", "good.example.org": "allow", "new.example.org": "allow", "once.example.org": "allow"}


def test_neighbours(spark):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((700, 12)).round(3)
    x[50:90] = x[50]  # equal vectors
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 12), (902, [float("nan")] * 12), (903, [None] * 12), (904, [1.0]), (None, [1.0] * 12), (3, data[3][1])]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<double>")
    small = Graph(k=12, reverse=12, tables=4, cell=60, rounds=3, expand=10, keep=60, block=40)
    got = Index(df, small).search(df.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), 10).collect()
    score = x @ x.T
    found = {}
    for r in got:
        assert r["vec_id"] != r["query_id"] and r["score"] == pytest.approx(score[r["query_id"], r["vec_id"]])
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    hits = 0
    for q in range(0, 700, 20):
        want = sorted((i for i in range(700) if i != q), key=lambda i: (-score[q, i].round(9), i))[:10]
        assert sorted(found[q]) == list(range(1, 11))
        hits += len(set(want) & set(found[q].values()))
    assert hits >= 0.9 * 350 and 900 not in found
    assert [found[60][r] for r in range(1, 11)] == sorted(found[60].values())  # ties go to the smaller id
    few = df.where("vec_id in (0, 1, 2, 900)")
    assert Index(few, small).search(few.where("vec_id = 0").withColumnRenamed("vec_id", "query_id"), 10).count() == 2
    assert Index(df.where("false"), small).search(df.where("false").withColumnRenamed("vec_id", "query_id"), 10).count() == 0


@pytest.mark.parametrize("size", [1e8, 1e150], ids=["large", "beyond single precision"])
def test_neighbours_beside_a_damaged_row(spark, size):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((700, 12))
    x[5] *= size
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    small = Graph(k=12, reverse=12, tables=4, cell=60, rounds=3, expand=4, search_rounds=3, keep=40, block=10, entries=20)
    found = {}
    for r in Index(df, small).search(df.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), 10).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    score, hits = x @ x.T, 0
    for q in range(0, 700, 20):
        hits += len(found[q] & set(sorted((i for i in range(700) if i != q), key=lambda i: -score[q, i])[:10]))
    assert hits >= 0.9 * 350
