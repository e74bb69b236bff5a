"""Repeated passages by level-wise doubling of window lengths.

A window of n words that also starts in another document contains shorter windows that do. So
lengths grow level by level, and only windows whose parts were found shared at one level are looked
at on the next: first windows of ``(n + 1) / 2`` words, then of n words (twice that length, cut to
n), then of 2n, 4n, ... until no candidate survives. The first level need not look at every short
window: each n-word window is represented by the short window in it with the smallest hash, which
is the same wherever the long window occurs.

``later_windows`` stops at n words, which decides what is removed; ``longest_repeats`` goes on.

Per level, the tasks hash their windows (62 bits), keep one entry per hash and task chunk, that of
the smallest document, and answer the other documents of the chunk at once. The entries are dealt
by hash and compared; answers go back by document: by its id and 32 bits of its text, because null
or repeated ids may be many (documents that agree in both share their answers, which depend on the
id and the hash only). Of wholly repeated rows a chunk enters one. So a passage that a third of all
documents share makes one entry per chunk, or one per text where several texts of the chunk have the
smallest id (all null, say). A hash collision would remove a window that is not repeated; its chance
per window is the number of windows over 2^62.

Null texts have no words. A null id comes after all others, and null ids are not smaller than each
other; rows with equal ids never count as copies of each other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.scratch import Scratch

CHUNK = 4 << 20
LAST = (1 << 63) - 1  # stands for a null id
ENTRIES = 2_000_000   # aimed at per bucket
SHARED, LATER = 1, 2  # in another document; in a document with a smaller id
KEPT = W.U64(W.MASK ^ 3)  # of a hash, where the lowest bits carry the answer


class Texts:
    """Word hashes of the texts of a chunk, one after the other."""

    def __init__(self, texts: pa.Array):
        self.bounds, every = W.split_words(texts)
        self.hashes = W.word_hashes(every)
        self.n = len(self.hashes)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.bounds))
        self._rolling = W.Rolling(self.hashes)

    def windows(self, length: int) -> np.ndarray:
        """Starts of the windows that lie in one text."""
        last = self.n - length + 1
        return np.flatnonzero(self.text[:last] == self.text[length - 1:]) if last > 0 else np.zeros(0, np.int64)

    def hash(self, starts: np.ndarray, length: int) -> np.ndarray:
        return W.mix(self._rolling.stretch(starts, length) + W.U64(length))

    def representatives(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each window, its start and the start of the half-length window that stands for it."""
        half = (length + 1) // 2
        starts = self.windows(length)
        if not len(starts):
            return starts, starts
        h = self.hash(np.arange(self.n - half + 1), half)
        best, at = h[starts].copy(), starts.copy()
        for k in range(1, length - half + 1):
            smaller = h[starts + k] < best
            best[smaller] = h[starts + k][smaller]
            at[smaller] = starts[smaller] + k
        return starts, at


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(LAST).to_numpy()


def _entered(part: pa.RecordBatch, ids: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which windows, of these texts, lie in the first of wholly repeated rows."""
    code = part.column(1).dictionary_encode().indices.fill_null(-1).to_numpy()
    _, at = np.unique(np.stack([ids, code.astype(np.int64)]), axis=1, return_index=True)
    first = np.zeros(len(ids), bool)
    first[at] = True
    return first[text]


def _entries(part: pa.RecordBatch, texts: Texts, starts: np.ndarray, length: int, buckets: int):
    """Rows for the comparison: entries by hash, and answers found inside this chunk by document.

    ``part``: id, text, and the bits of the text in its last column.
    """
    ids, bits = _ids(part.column(0)), part.columns[-1].to_numpy()
    starts = starts[_entered(part, ids, texts.text[starts])]
    hashes, text = texts.hash(starts, length), texts.text[starts]
    order = np.lexsort((text, ids[text], hashes))
    hashes, text = hashes[order], text[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1])]) if len(hashes) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    least = ids[text[new]][group] if len(hashes) else np.zeros(0, np.int64)
    later = ids[text] > least
    several = np.zeros(int(new.sum()), bool)
    several[group[later]] = True
    # Different texts with the smallest id (null, say) all enter: each is answered on its own.
    enter = ~later & (new | np.concatenate([[False], text[1:] != text[:-1]])) if len(hashes) else new
    # Only the first text of a group is compared with other chunks, unless it is shared already and first everywhere.
    answer = np.where(later, SHARED | LATER, SHARED).astype(np.uint8)[several[group]]
    local = np.flatnonzero(several[group])
    by = [(hashes[enter] % W.U64(buckets)).astype(np.int64), ((ids[text[local]] ^ bits[text[local]]).view(W.U64) * W.U64(W.BASE) >> W.U64(33)).astype(np.int64) % buckets]
    rows = []
    first, sort, sort_local = np.flatnonzero(enter), np.argsort(by[0], kind="stable"), np.argsort(by[1], kind="stable")
    cuts = [np.searchsorted(by[i][s], np.arange(buckets + 1)) for i, s in ((0, sort), (1, sort_local))]
    for b in range(buckets):
        own, told = first[sort[cuts[0][b]:cuts[0][b + 1]]], sort_local[cuts[1][b]:cuts[1][b + 1]]
        if len(own) or len(told):
            docs, at = np.unique(np.concatenate([text[own], text[local[told]]]), return_inverse=True)
            kind = np.uint16 if len(docs) < 1 << 16 else np.uint32
            rows.append((b, kind().itemsize, ids[docs].tobytes(), bits[docs].tobytes(), hashes[own].tobytes(), at[:len(own)].astype(kind).tobytes(),
                         hashes[local[told]].tobytes(), at[len(own):].astype(kind).tobytes(), answer[told].tobytes()))
    return rows


ENTRY = "bucket int, width int, docs binary, bits binary, hashes binary, at binary, told binary, told_at binary, told_answer binary"
NAMES = [x.split()[0] for x in ENTRY.split(", ")]


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, schema.types)], names)


ENTRY_SCHEMA = pa.schema([(n, pa.int32() if n in ("bucket", "width") else pa.binary()) for n in NAMES])


def _compare(table: pa.Table) -> pa.Table:
    """Answers of one bucket: documents with the hashes they share."""
    ids, bits, hashes, told_ids, told_bits, told, answers = [], [], [], [], [], [], []
    for row in table.to_pylist():
        docs, some, kind = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["bits"], np.int32), np.uint16 if row["width"] == 2 else np.uint32
        hashes.append(np.frombuffer(row["hashes"], W.U64))
        at, told_at = np.frombuffer(row["at"], kind), np.frombuffer(row["told_at"], kind)
        ids.append(docs[at])
        bits.append(some[at])
        told.append(np.frombuffer(row["told"], W.U64))
        told_ids.append(docs[told_at])
        told_bits.append(some[told_at])
        answers.append(np.frombuffer(row["told_answer"], np.uint8))
    h, d, b = np.concatenate(hashes), np.concatenate(ids), np.concatenate(bits)
    order = np.lexsort((d, h))
    h, d, b = h[order], d[order], b[order]
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    later = d > d[new][group] if len(h) else new
    several = np.zeros(int(new.sum()), bool)
    several[group[later]] = True
    shared = several[group] if len(h) else new
    d = np.concatenate([d[shared], *told_ids])
    b = np.concatenate([b[shared], *told_bits])
    h = np.concatenate([h[shared], *told])
    flags = np.concatenate([np.where(later[shared], SHARED | LATER, SHARED).astype(np.uint8), *answers])
    answer = (h & KEPT | flags.astype(W.U64)).view(np.int64)
    # Repeated rows of several chunks have the same answers.
    order = np.lexsort((answer, b, d))
    d, b, answer = d[order], b[order], answer[order]
    once = np.ones(len(d), bool)
    once[1:] = (d[1:] != d[:-1]) | (b[1:] != b[:-1]) | (answer[1:] != answer[:-1])
    return pa.table([pa.array(d[once], pa.int64()), pa.array(b[once], pa.int32()), pa.array(answer[once])], ["_key", "_bits", "answer"])


def _answers(entries: DataFrame) -> DataFrame:
    """One row per document: the hashes that it shares, with the flags in their lowest two bits."""
    found = entries.groupBy("bucket").applyInArrow(_compare, "_key long, _bits int, answer long")
    return found.groupBy("_key", "_bits").agg(F.collect_list("answer").alias("answers"))


def _flags(texts: Texts, starts: np.ndarray, length: int, answers: pa.Array) -> np.ndarray:
    """The answer for each window."""
    out = np.zeros(len(starts), np.uint8)
    counts = answers.value_lengths().fill_null(0).to_numpy()
    values = answers.flatten().to_numpy().view(W.U64)
    if len(values) and len(starts):
        text = np.repeat(np.arange(1, len(counts) + 1, dtype=W.U64), counts)
        key, group = np.unique(W.mix((values & KEPT) ^ W.mix(text)), return_inverse=True)
        flag = np.zeros(len(key), np.uint8)
        np.bitwise_or.at(flag, group, (values & ~KEPT).astype(np.uint8))
        own = W.mix((texts.hash(starts, length) & KEPT) ^ W.mix(texts.text[starts].astype(W.U64) + W.U64(1)))
        i = np.minimum(np.searchsorted(key, own), len(key) - 1)
        out = np.where(key[i] == own, flag[i], 0).astype(np.uint8)
    return out


def _joined(rows: DataFrame, answers: DataFrame) -> DataFrame:
    keyed = rows.withColumns({"_key": F.coalesce("doc_id", F.lit(LAST)), "_bits": F.hash("text")})
    return keyed.join(answers, ["_key", "_bits"], "left").drop("_key", "_bits")


def _sha(text: str | None) -> tuple[int, str]:
    words = (text or "").encode().split()
    return len(words), hashlib.sha256(b" ".join(words)).hexdigest()


def _candidates(scratch: Scratch, docs: DataFrame, window: int) -> DataFrame:
    """First level. All documents with word count and digest; those with candidate windows keep text and starts."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, size // (24 * ENTRIES))  # a short window in four stands for others, words have six bytes

    def enter(batches):
        for batch in batches:
            for part in W.chunks(batch, "text", CHUNK):
                texts = Texts(W.strings(part.column(1)))
                starts = np.unique(texts.representatives(window)[1])
                yield _batch(_entries(part, texts, starts, (window + 1) // 2, buckets), NAMES, ENTRY_SCHEMA)

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("words_sha256", pa.string()), ("text", pa.string()),
                        ("starts", pa.binary()), ("n_starts", pa.int64())])

    def narrow(batches):
        for batch in batches:
            for part in W.chunks(batch, "text", CHUNK):
                texts = Texts(W.strings(part.column(1)))
                starts, at = texts.representatives(window)
                short = np.unique(at)
                flags = _flags(texts, short, (window + 1) // 2, part.column(2))
                shared = np.zeros(texts.n, bool)
                shared[short] = flags > 0
                starts = starts[shared[at]]
                cuts = np.searchsorted(starts, texts.bounds)
                rows = []
                for i, (doc_id, text) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                    own = starts[cuts[i]:cuts[i + 1]] - texts.bounds[i]
                    n, sha = _sha(text)
                    rows.append((doc_id, n, sha, text, own.astype(np.int32).tobytes(), len(own)) if len(own) else (doc_id, n, sha, None, None, 0))
                yield _batch(rows, schema.names, schema)

    answers = _answers(docs.withColumn("_bits", F.hash("text")).mapInArrow(enter, ENTRY))
    rows = _joined(docs, answers).select("doc_id", "text", "answers")
    return scratch.keep(rows.mapInArrow(
        narrow, "doc_id long, n_words long, words_sha256 string, text string, starts binary, n_starts long"), "candidates")


def _own_starts(texts: Texts, column: pa.Array) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(
        np.frombuffer(x, np.int32) + texts.bounds[i] for i, x in enumerate(column.to_pylist()) if x)]).astype(np.int64)


def _level(candidates: DataFrame, length: int) -> DataFrame:
    """Candidates with the answers for their windows of this length."""
    total = candidates.agg(F.sum("n_starts")).first()[0] or 0
    buckets = max(1, total // ENTRIES)

    def enter(batches):
        for batch in batches:
            for part in W.chunks(batch, "text", CHUNK):
                texts = Texts(W.strings(part.column(1)))
                yield _batch(_entries(part, texts, _own_starts(texts, part.column(2)), length, buckets), NAMES, ENTRY_SCHEMA)

    rows = candidates.select("doc_id", "text", "starts", F.hash("text").alias("_bits"))
    return _joined(candidates, _answers(rows.mapInArrow(enter, ENTRY)))


def later_windows(docs: DataFrame, window: int = 13, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text digest ``kept_sha256``, ``kept_text`` where words went.

    Removed are the words of every window that also starts in a document with a smaller id.
    """
    scratch = scratch or Scratch(docs.sparkSession, "substrings")
    every = _candidates(scratch, docs, window)
    found = _level(every.where("text is not null"), window)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])

    def remove(batches):
        for batch in batches:
            for part in W.chunks(batch, "text", CHUNK):
                texts = Texts(W.strings(part.column(1)))
                starts = _own_starts(texts, part.column(2))
                later = starts[_flags(texts, starts, window, part.column(3)) & LATER > 0]
                change = np.zeros(texts.n + 1, np.int64)
                np.add.at(change, later, 1)
                np.add.at(change, later + window, -1)
                covered = np.cumsum(change[:-1]) > 0
                rows = []
                for i, (doc_id, text) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                    gone = covered[texts.bounds[i]:texts.bounds[i + 1]]
                    kept = b" ".join(w for w, g in zip(text.encode().split(), gone.tolist()) if not g)
                    rows.append((doc_id, len(gone), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if gone.any() else None))
                yield _batch(rows, schema.names, schema)

    changed = found.select("doc_id", "text", "starts", "answers").mapInArrow(
        remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    same = every.where("text is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("words_sha256").alias("kept_sha256"), F.lit(None).cast("string").alias("kept_text"))
    return changed.unionByName(same)


def longest_repeats(docs: DataFrame, window: int = 13, scratch: Scratch | None = None) -> DataFrame:
    """Doubling to the end: rows (length, doc_id, start, later) for windows that start in another document.

    Lengths are window, 2 window, 4 window, ...; a start is listed at the greatest length at which
    it is shared. ``later`` tells whether a document with a smaller id has the window.
    """
    scratch = scratch or Scratch(docs.sparkSession, "repeats")
    level, length, out = _candidates(scratch, docs, window).where("text is not null").select("doc_id", "text", "starts", "n_starts"), window, []
    fields = "doc_id long, text string, starts binary, n_starts long, done array<int>, done_later array<boolean>"
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("starts", pa.binary()), ("n_starts", pa.int64()),
                        ("done", pa.list_(pa.int32())), ("done_later", pa.list_(pa.bool_()))])
    while True:
        def extend(batches, length=length):
            for batch in batches:
                for part in W.chunks(batch, "text", CHUNK):
                    texts = Texts(W.strings(part.column(1)))
                    starts = _own_starts(texts, part.column(2))
                    flags = _flags(texts, starts, length, part.column(3))
                    starts, flags = starts[flags > 0], flags[flags > 0]
                    whole = np.zeros(texts.n + 2 * length, bool)
                    whole[starts] = True
                    inside = starts + 2 * length <= texts.bounds[texts.text[starts] + 1]
                    longer = whole[starts + length] & inside
                    cuts = np.searchsorted(starts, texts.bounds)
                    rows = []
                    for i, (doc_id, text) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                        own, more, late = (x[cuts[i]:cuts[i + 1]] for x in (starts, longer, flags & LATER > 0))
                        own = (own - texts.bounds[i]).astype(np.int32)
                        if len(own):
                            rows.append((doc_id, text, own[more].tobytes(), int(more.sum()), own.tolist(), late.tolist()))
                    yield _batch(rows, schema.names, schema)

        level = scratch.keep(_level(level, length).select("doc_id", "text", "starts", "answers").mapInArrow(extend, fields), f"length-{length}")
        out.append(level.select(F.lit(length).alias("length"), "doc_id", F.explode(F.arrays_zip("done", "done_later")).alias("w")).select(
            "length", "doc_id", F.col("w.done").alias("start"), F.col("w.done_later").alias("later")))
        level, length = level.where("n_starts > 0").select("doc_id", "text", "starts", "n_starts"), 2 * length
        if not level.limit(1).count():
            break
    every = out[0]
    for one in out[1:]:
        every = every.unionByName(one)
    return every.groupBy("doc_id", "start").agg(F.max_by("later", "length").alias("later"), F.max("length").alias("length"))
