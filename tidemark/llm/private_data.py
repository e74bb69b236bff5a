"""Personal data by candidate gradient boosting.

High-recall generators propose overlapping spans for four kinds: e-mail addresses, also written
with ``at`` and ``dot``; IPv4 addresses; card numbers; telephone numbers, with or without a plus.
Every span that the base patterns accept stays. Boosted trees judge the other candidates by format
and context; a candidate that passes its kind's check becomes a span when its probability reaches
the threshold of the kind, best first, if it overlaps nothing chosen before.

The trees are fitted on candidates of a bounded sample of documents. Base spans are the positive
examples; candidates that cut through a base span, or fail a check sum or range, are the negative
ones, and so are plain runs of digits that nothing marks as a number to call. What base patterns do
not see has no label, so it is made from labelled spans: two numbers side by side, addresses spelt with
``at`` and ``dot``, telephone numbers without their plus, each in the context of the span it is made
from. Half of the sample fits the trees; on the other half scores are calibrated per kind (isotonic
regression), and the threshold is the lowest score that is more likely right than not and keeps the
wanted precision. A kind without positive examples adds nothing.

A null text is empty and has no spans. Repeated rows give repeated results. Offsets are code
points, ends exclusive. An empty table gives no rows. Every character of a text is looked at a bounded
number of times, so a text of any length takes time in proportion.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as W

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]
CHUNK = 8 << 20

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
STRETCH = re.compile(r"[0-9 ().+-]{7,}+")  # no number pattern matches beyond such a stretch
SPELT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?(?:@|\(at\)|\[at\]) ?| at )"
    r"[A-Za-z0-9-]++(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?| dot )[A-Za-z0-9-]++)++")
SPELT_MARKS = ("(at)", "[at]", " dot ", "@")
MOST_GROUPS = 8  # groups of digits that a candidate joins
AROUND = 60  # characters of a number's surroundings that features look at
GROUP = re.compile(r"[0-9]+")
CONTEXT = {
    "email": re.compile(r"mail|contact|write|courriel|correo|schreib", re.I), "ip": re.compile(r"\bip|address|server|host|adress", re.I),
    "card": re.compile(r"card|visa|credit|carte|tarjeta|kart", re.I), "phone": re.compile(r"tel|phone|call|fax|mobil|ruf", re.I)}
CODE = re.compile(r"token|key|hash|sha|uuid|version|password|secret", re.I)


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2] + [2 * v - 9 * (v > 4) for v in values[1::2]]) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(GROUP.findall(text))


def valid(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(p) <= 9 and int(p) <= 255 or not p.strip("0") for p in GROUP.findall(text))
    if kind == "card":
        digits = digits_of(text)
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits_of(text)) <= 15


def emails(text: str):
    """The spans of ``EMAIL``, leftmost and not overlapping; each character is read once."""
    bound, at = 0, text.find("@")
    while at >= 0:
        start = bound + len(text[bound:at].rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        bound = found.end() if found else at + 1
        at = text.find("@", bound)


def number_runs(text: str) -> list[tuple[int, int]]:
    """Where numbers may stand: from the first digit or plus of a stretch to its last digit, seven characters at least."""
    out = []
    for m in STRETCH.finditer(text):
        body = m.group()
        start, end = m.start() + len(body) - len(body.lstrip(" ().-")), m.start() + len(body.rstrip(" ().+-"))
        if end - start >= 7:
            out.append((start, end))
    return out


def _groups(text: str, run: tuple[int, int]) -> tuple[list[tuple[int, int]], list[str]]:
    """The groups of digits of a run, and what stands between them."""
    groups = [m.span() for m in GROUP.finditer(text, *run)]
    return groups, [text[a[1]:b[0]] if b[0] - a[1] <= 4 else "...." for a, b in zip(groups, groups[1:])]


def base_spans(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    """What the base patterns accept, by kind and then start. No match reaches over the end of a run."""
    found, ips, cards = [("email", a, b) for a, b in emails(text)], [], []
    for run in runs:
        groups, gaps = _groups(text, run)
        i = 0
        while i + 3 < len(groups):
            dotted = gaps[i:i + 3] == [".", ".", "."]
            if dotted:
                ips.append(("ip", groups[i][0], groups[i + 3][1]))
            i += 4 if dotted else 1
        i = 0
        while i < len(groups):
            j = i
            while j < len(gaps) and gaps[j] in (" ", "-"):
                j += 1
            if groups[j][1] - groups[i][0] > 1:
                cards.append(("card", groups[i][0], groups[j][1]))
            i = j + 1
    phones = [("phone", m.start(), m.end()) for a, b in runs for m in PHONE.finditer(text, a, b)]
    return found + [s for s in (*ips, *cards, *phones) if valid(s[0], text[s[1]:s[2]])]


def candidates(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    out = set()
    if any(mark in text for mark in SPELT_MARKS):
        out.update(("email", m.start(), m.end()) for m in SPELT.finditer(text))
        out.update(("email", a, b) for a, b in emails(text))
    for run in runs:
        groups, gaps = _groups(text, run)
        for i, (start, end) in enumerate(groups):
            plus = start > run[0] and text[start - 1] == "+"
            opened = start > run[0] and text[start - 1] == "("
            n, dotted, plain = 0, True, True
            for j in range(i, min(i + MOST_GROUPS, len(groups))):
                if j > i:
                    gap = gaps[j - 1]
                    dotted, plain = dotted and gap == ".", plain and gap in (" ", "-")
                    if "+" in gap or len(gap) > 3:
                        break
                n += groups[j][1] - groups[j][0]
                if n > 19:
                    break
                end = groups[j][1]
                if dotted and j == i + 3:
                    out.add(("ip", start, end))
                if plain and n >= 13:
                    out.add(("card", start, end))
                # Digits that letters touch are part of a key or a code.
                if 9 <= n <= 15 and (plus or not (text[end:end + 1].isalnum() or text[max(0, start - 1):start].isalnum())):
                    out.add(("phone", start - (plus or opened), end))
    return sorted(out)


class Taken:
    """Stretches of a text that spans have taken, in order."""

    def __init__(self, spans: list[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, a, b in sorted(spans, key=lambda s: s[1:]):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, span: Span) -> bool:
        i = bisect.bisect_left(self.starts, span[2])
        return i > 0 and self.ends[i - 1] > span[1]

    def add(self, span: Span) -> None:
        """A span that meets none."""
        i = bisect.bisect_left(self.starts, span[1])
        self.starts.insert(i, span[1])
        self.ends.insert(i, span[2])


def features(text: str, span: Span, run: tuple[int, int] | None) -> list[float]:
    kind, start, end = span
    body, before = text[start:end], text[max(0, start - 40):start]
    groups = GROUP.findall(body)
    sizes = [len(g) for g in groups] or [0]
    gaps = {g for g in GROUP.split(body)[1:-1]}
    last, next_ = (text[start - 1] if start else " "), (text[end] if end < len(text) else " ")
    left, right = (text[max(run[0], start - AROUND):start], text[end:min(run[1], end + AROUND)]) if run else ("", "")
    return [
        KINDS.index(kind), end - start, sum(sizes), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1], len(gaps),
        body.startswith("+"), "(" in body, "-" in body, "." in body, " " in body, valid(kind, body),
        bool(re.search(r"\b0[0-9]", body)), last.isalnum(), next_.isalnum(), last in "+-.(", next_ in "-.)",
        min(len(digits_of(left)), 20), min(len(digits_of(right)), 20), right.lstrip(" ")[:1] == "+", "@" in body,
        len(body.rsplit(".", 1)[-1]) if kind == "email" else 0, bool(CONTEXT[kind].search(before)), bool(CODE.search(before)),
    ]


def described(text: str, spans: list[Span], runs: list[tuple[int, int]]) -> list[list[float]]:
    starts = [r[0] for r in runs]
    rows = []
    for span in spans:
        i = int(np.searchsorted(starts, span[1], side="right")) - 1
        run = runs[i] if i >= 0 and runs[i][1] >= span[2] else None
        rows.append(features(text, span, run))
    return rows


def variants(kind: str, body: str) -> list[str]:
    """A labelled span as people also write it, in forms that the base patterns do not see."""
    if kind == "email":
        local, _, domain = body.partition("@")
        dotted = domain.replace(".", " dot ")
        return [f"{local} (at) {domain.replace('.', ' (dot) ')}", f"{local} at {dotted}", f"{local}[at]{domain}", f"{local} @ {domain}"]
    if kind == "phone":
        plain = body[1:]
        short = plain.partition(" ")[2].lstrip() or plain
        return [x for x in dict.fromkeys((plain, short, digits_of(plain), digits_of(short))) if 9 <= len(digits_of(x)) <= 15 and x[-1:].isdigit()]
    return []


def labelled(text: str) -> list[tuple[int, list[float]]]:
    """Candidates with a known label: base spans, what cuts through them, what fails its check, and variants of base spans."""
    runs = number_runs(text)
    base = base_spans(text, runs)
    known, taken = set(base), Taken(base)
    spans, labels = [], []
    for span in candidates(text, runs):
        body = text[span[1]:span[2]]
        if span in known:
            label = 1
        elif taken.meets(span) or not valid(span[0], body) or body.isdigit() and span[0] == "phone":
            label = 0
        else:
            continue
        spans.append(span)
        labels.append(label)
    rows = list(zip(labels, described(text, spans, runs)))

    def add(made: str, true: set[Span], low: int = 0, high: int | None = None) -> None:
        """The candidates of a made text that begin in the part that was made."""
        within = number_runs(made)
        found = [s for s in candidates(made, within) if low <= s[1] and s[2] <= (len(made) if high is None else high)]
        rows.extend(zip([int(s in true) for s in found], described(made, found, within)))

    numbers = [b for b in base if b[0] != "email"]
    for one, two in zip(numbers, numbers[1:]):  # neighbours, as base patterns would not see them
        for first, second in ((one, two), (two, one)):
            x, y = text[first[1]:first[2]], text[second[1]:second[2]]
            joint = f"{x} {y}"
            add(joint, {(first[0], 0, len(x)), (second[0], len(x) + 1, len(joint))})
    for kind, start, end in base:
        before, after = text[max(0, start - 40):start], text[end:end + 20]
        for body in variants(kind, text[start:end]):
            opened = body.startswith("(")  # a candidate begins at the bracket before its digits
            add(before + body + after, {(kind, len(before), len(before + body))}, max(0, len(before) - opened), len(before + body))
    return rows


def calibrated(score: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Isotonic regression: for rising scores, the share of hits that never falls (adjacent violators are pooled)."""
    blocks: list[list[float]] = []
    for hit in y.tolist():
        blocks.append([hit, 1.0])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            hits, n = blocks.pop()
            blocks[-1][0] += hits
            blocks[-1][1] += n
    return np.concatenate([np.zeros(0), *[np.full(int(n), hits / n) for hits, n in blocks]])


@dataclass(frozen=True)
class Trees:
    """Boosted trees of fixed depth on binned features: feature and cut per inner node, value per leaf."""
    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        b, rows, total = self.bins(x), np.arange(len(x)), np.zeros(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0) -> Trees:
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33)[1:-1])) for j in range(x.shape[1])]
    model = Trees(edges, np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth)))
    b, total, parts = model.bins(x), np.zeros(len(x)), ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        feature, cut, node = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, 99, np.int64), np.zeros(len(x), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            best = np.full(n, 1e-6)
            for j in range(x.shape[1]):
                at = (node - first) * 33 + b[:, j]
                g = np.bincount(at, gradient, n * 33).reshape(n, 33).cumsum(axis=1)
                h = np.bincount(at, weight, n * 33).reshape(n, 33).cumsum(axis=1)
                g1, h1 = g[:, -1:] - g, h[:, -1:] - h
                gain = g**2 / (h + ridge) + g1**2 / (h1 + ridge) - g[:, -1:]**2 / (h[:, -1:] + ridge)
                top = gain.argmax(axis=1)
                better = np.flatnonzero(gain[np.arange(n), top] > best)
                best[better] = gain[better, top[better]]
                feature[first + better], cut[first + better] = j, top[better]
            node = 2 * node + 1 + (b[np.arange(len(x)), feature[node]] > cut[node])
        node -= 2**depth - 1
        leaf = rate * np.bincount(node, gradient, 2**depth) / (np.bincount(node, weight, 2**depth) + ridge)
        total += leaf[node]
        for part, value in zip(parts, (feature, cut, leaf)):
            part.append(value)
    return Trees(edges, *(np.array(p) for p in parts))


@dataclass(frozen=True)
class Model:
    trees: Trees | None
    thresholds: tuple[float, ...]


def fit(docs: DataFrame, documents: int = 20_000, rows: int = 100_000, precision: float = 0.98) -> Model:
    """From at most ``documents`` documents (in expectation) and at most ``rows`` labelled candidates."""
    n = docs.count()
    share = int(min(1.0, documents / max(n, 1)) * (1 << 30))
    key = F.xxhash64("doc_id", "text")
    chosen = docs.select("text", key.alias("key")).where("text is not null").where(F.pmod("key", F.lit(1 << 30)) < share)

    def collect(batches):
        for batch in batches:
            keys, labels, found = [], [], []
            for text, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for label, row in labelled(text):
                    keys.append(k)
                    labels.append(label)
                    found.append([float(v) for v in row])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(labels, pa.int32()), pa.array(found, pa.list_(pa.float64()))], ["key", "label", "x"])

    examples = chosen.mapInArrow(collect, "key long, label int, x array<double>").orderBy("key", "label", "x").limit(rows).collect()
    if not any(r["label"] for r in examples):
        return Model(None, (2.0,) * len(KINDS))
    x, y = np.array([r["x"] for r in examples]), np.array([r["label"] for r in examples], np.float64)
    fitting = np.array([(r["key"] >> 31) % 2 == 0 for r in examples])
    if not (0 < y[fitting].sum() < fitting.sum()) or fitting.all():
        fitting[:] = True
    trees = boost(x[fitting], y[fitting])
    held = ~fitting if not fitting.all() else fitting
    p, y, kind = trees.probability(x[held]), y[held], x[held][:, 0]
    thresholds = []
    for k in range(len(KINDS)):
        order = np.argsort(-p[kind == k], kind="stable")
        score, hits = p[kind == k][order], np.cumsum(y[kind == k][order])
        likely = calibrated(score[::-1], y[kind == k][order][::-1])[::-1] >= 0.5
        good = np.flatnonzero(likely & (hits >= precision * (1 + np.arange(len(hits))))) if len(hits) and hits[-1] else np.zeros(0, int)
        thresholds.append(float(score[good[-1]]) if len(good) else 2.0)
    return Model(trees, tuple(thresholds))


def find(texts: list[str], model: Model) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    out, open_, rows = [], [], []
    for i, text in enumerate(texts):
        runs = number_runs(text)
        base = base_spans(text, runs)
        taken = Taken(base)
        new = [s for s in candidates(text, runs) if not taken.meets(s)] if model.trees else []
        new = [s for s in new if valid(s[0], text[s[1]:s[2]])]
        out.append((base, new))
        open_ += [(i, s) for s in new]
        rows += described(text, new, runs)
    chosen: dict[int, list[Span]] = {}
    full: dict[int, Taken] = {}
    if rows:
        p = model.trees.probability(np.array(rows, np.float64))
        best = sorted((-q, i, s) for q, (i, s) in zip(p.tolist(), open_) if q >= model.thresholds[KINDS.index(s[0])])
        for _, i, span in best:
            if not full.setdefault(i, Taken()).meets(span):
                full[i].add(span)
                chosen.setdefault(i, []).append(span)
    return [(base, sorted(base + chosen.get(i, []), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))) for i, (base, _) in enumerate(out)]


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b > at:
            out += [text[at:max(a, at)], f"[{kind}]"]
            at = b
    return "".join(out) + text[at:]


def private_spans(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, counts of base spans, base_sha256, spans, redacted text (null where unchanged)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    counts = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    schema = T.StructType([docs.schema["doc_id"], *counts, *[T.StructField(c, T.StringType()) for c in ("base_sha256", "spans", "redacted")]])

    def scan(batches):
        m = shared.value
        for batch in batches:
            for part in W.chunks(batch, "text", CHUNK):
                texts = [t or "" for t in part.column(1).to_pylist()]
                found = find(texts, m)
                counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, pa.int64()) for c in counts],
                     pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found], pa.string()),
                     pa.array([written(spans) for _, spans in found], pa.string()),
                     pa.array([redact(t, spans) if spans else None for t, (_, spans) in zip(texts, found)], pa.string())],
                    ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "redacted"])

    return docs.select("doc_id", "text").mapInArrow(scan, schema)
