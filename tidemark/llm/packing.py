"""Vector best-fit packing of tokenised documents into sequences.

A document is its token ids and an end id; only one longer than a sequence is cut. A sequence has
three capacities: tokens, pieces, and attention cost (sum of squared lengths). Pieces go in by
falling length; each goes to the open sequence that can take it under every constraint and whose
weighted residual is best, by the smallest norm after placing or the largest dot product with the
piece. A new sequence is opened only when no open one can take the piece.

All three demands of a piece follow from its length, so pieces of one length are alike and the
whole corpus is one histogram with at most ``tokens`` entries. The driver packs this histogram,
sequences in equal state as one group; its work and its plan are bounded by the number of lengths,
not by the number of documents. Spark numbers the pieces of each length in one distributed sort and
looks up their places in the plan.

A null text is empty (one end id). Repeated rows are separate documents. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as W
from tidemark.llm.scratch import Scratch, lean, running_totals

CHUNK = 2 << 20
CACHED = 1_000_000  # words whose ids a worker remembers, some 60 bytes each
SLICE = 5000  # words in one call of the tokenizer: its results hold strings and offsets for every token
TAIL = ".,;:!?"


@dataclass(frozen=True)
class Capacity:
    tokens: int = 4096
    pieces: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"  # or "dot"


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``values``, one after the other."""
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """Token ids of whole texts; distinct words are encoded once and remembered by their hash.

    The tokenizer drops white space and never joins across it, nor across the end of a letter or
    digit run before the marks in ``TAIL``; so words can be encoded apart, and many of them in one
    call: words of letters alone end with the only token that carries the end mark. A text that may
    hold a special token goes through the tokenizer whole.
    """

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        self._tokenizer, self._end = Tokenizer.from_file(path), end
        self._ends = np.zeros(self._tokenizer.get_vocab_size() + 1, bool)
        self._ends[[i for token, i in self._tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self._keys, self._starts, self._lengths = np.zeros(0, W.U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _each(self, items: list[str], step: int = SLICE) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for at in range(0, len(items), step):
            out += [np.array(e.ids, np.uint32) for e in self._tokenizer.encode_batch(items[at:at + step], add_special_tokens=False)]
        return out

    def _many(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids."""
        parts = [self._some(items[at:at + SLICE]) for at in range(0, len(items), SLICE)]
        return np.concatenate([n for n, _ in parts]), np.concatenate([ids for _, ids in parts])

    def _some(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        simple = np.fromiter((x.isalpha() for x in items), bool, len(items))
        lengths, ids = np.zeros(len(items), np.int64), [np.zeros(0, np.uint32)]
        words = np.flatnonzero(simple)
        joint = np.array(self._tokenizer.encode(" ".join([items[i] for i in words]), add_special_tokens=False).ids, np.uint32)
        last = np.flatnonzero(self._ends[joint])
        if len(last) != len(words):
            words, last, joint = words[:0], last[:0], joint[:0]
            simple[:] = False
        lengths[words] = np.diff(last, prepend=-1)
        others = self._each([items[i] for i in np.flatnonzero(~simple)])
        lengths[~simple] = [len(x) for x in others]
        starts = np.zeros(len(items), np.int64)
        starts[simple] = np.concatenate([[0], last[:-1] + 1]) if len(last) else 0
        starts[~simple] = len(joint) + np.cumsum([0, *[len(x) for x in others]])[:-1]
        return lengths, gather(np.concatenate([joint, *ids, *others]), starts, lengths)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and number of ids of each word, and the array of ids."""
        hashes = W.word_hashes(words)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self._keys, keys)
        new = np.flatnonzero(self._keys[np.minimum(at, len(self._keys) - 1)] != keys) if len(self._keys) else np.arange(len(keys))
        if len(self._keys) + len(new) > CACHED:
            self._forget()
            new = np.arange(len(keys))
        if len(new):
            lengths, ids = self._many(words.take(pa.array(first[new])).to_pylist())
            starts = len(self._ids) + np.cumsum(lengths) - lengths
            place = np.searchsorted(self._keys, keys[new])
            self._keys, self._starts = np.insert(self._keys, place, keys[new]), np.insert(self._starts, place, starts)
            self._lengths, self._ids = np.insert(self._lengths, place, lengths), np.concatenate([self._ids, ids])
        at = np.searchsorted(self._keys, keys)[inverse]
        return self._starts[at], self._lengths[at], self._ids

    def _distinct(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each distinct word, marks at its end included, and all ids."""
        bases = pc.ascii_rtrim(names, characters=TAIL)
        size, kept = (pc.binary_length(x).to_numpy(zero_copy_only=False) for x in (names, bases))
        marks = size - kept
        cut = (marks > 0) & (marks < 8) & pc.match_substring_regex(bases, r"[\p{L}\p{N}]$").to_numpy(zero_copy_only=False)
        starts, lengths, ids = self._words(pc.if_else(pa.array(cut), bases, names))
        if not cut.any():
            return lengths, gather(ids, starts, lengths)
        ended = names.filter(pa.array(cut))
        offsets = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset + 1:ended.offset + len(ended) + 1]
        data, code = np.frombuffer(ended.buffers()[2], np.uint8), np.zeros(len(ended), np.int64)
        for k in range(int(marks[cut].max()), 0, -1):
            has = marks[cut] >= k
            code[has] = code[has] * 256 + data[offsets[has] - k]
        codes, which = np.unique(code, return_inverse=True)
        tails = self._each([int(c).to_bytes(8, "big").lstrip(b"\0").decode() for c in codes])
        tail_length = np.array([len(x) for x in tails], np.int64)
        # Base and marks by turns; words without marks have an empty second part.
        both, from_ = np.zeros(2 * len(names), np.int64), np.zeros(2 * len(names), np.int64)
        both[::2], from_[::2] = lengths, starts
        at = 2 * np.flatnonzero(cut) + 1
        both[at], from_[at] = tail_length[which], len(ids) + (np.cumsum(tail_length) - tail_length)[which]
        return lengths + both[1::2], gather(np.concatenate([ids, *tails]), from_, both)

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of each document in the array of all ids."""
        whole = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        plain = pc.ascii_lower(pc.if_else(pa.array(~whole), texts, pa.scalar("", pa.large_string())))
        bounds, every = W.split_words(plain)
        coded = every.dictionary_encode()
        index, names = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
        lengths, ids = self._distinct(coded.dictionary) if names else (np.zeros(0, np.int64), np.zeros(0, np.uint32))
        extra = [np.append(x, np.uint32(self._end)) for x in self._each([texts[i].as_py() for i in np.flatnonzero(whole)], 1)]
        lengths = np.concatenate([lengths, [1], [len(x) for x in extra]]).astype(np.int64)
        ids = np.concatenate([ids, np.array([self._end], np.uint32), *extra])
        # Each document ends with the end id, or is one piece of its own if it was encoded whole.
        last = np.full(len(texts), names, np.int64)
        last[whole] = names + 1 + np.arange(len(extra))
        index = np.insert(index, bounds[1:], last)
        n = lengths[index]
        word_ends = np.concatenate([[0], np.cumsum(n)])
        return word_ends[bounds + np.arange(len(bounds))], gather(ids, (np.cumsum(lengths) - lengths)[index], n)


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def tokenised_pieces(docs: DataFrame, path: str, tokens: int, end: int = 1) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    longs = [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]
    schema = T.StructType([docs.schema["doc_id"], T.StructField("piece", T.IntegerType()), *longs])

    def cut(batches):
        encoder = _ENCODERS.get((path, end)) or _ENCODERS.setdefault((path, end), Encoder(path, end))
        for batch in batches:
            for part in W.chunks(batch, "text", CHUNK):
                bounds, ids = encoder.documents(W.strings(part.column(1)))
                rows = []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    for k, at in enumerate(range(a, b, tokens)):
                        to = min(b, at + tokens)
                        rows.append((i, k, at - a, to - at, zlib.crc32(ids[at:to].astype("<u4").tobytes())))
                row, piece, start, length, crc = (np.array(x) for x in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(lean(cut), schema)


def pack_histogram(counts: dict[int, int], c: Capacity = Capacity()) -> np.ndarray:
    """The plan: rows (length, first piece of that length, pieces, first sequence, offset).

    Piece ``first + i`` of the length goes to sequence ``first sequence + i`` at the offset.
    """
    size, plan, opened = 0, [], 0
    state = np.zeros((1024, 5), np.int64)  # residual tokens, pieces, attention; first sequence, sequences
    most = np.array([c.tokens, c.pieces, c.attention], np.float64)
    weights = np.array(c.weights) / most**2

    def open_group(residual: tuple[int, int, int], first: int, n: int) -> None:
        nonlocal state, size
        if n and min(residual) > 0:
            if size == len(state):
                state = np.concatenate([state, np.zeros_like(state)])
            state[size] = (*residual, first, n)
            size += 1

    for length in sorted(counts, reverse=True):
        left, placed = counts[length], 0
        demand = np.array([length, 1, length * length], np.int64)
        if (demand > most).any():
            raise ValueError(f"a piece of {length} tokens exceeds a capacity")
        while left:
            fits = np.flatnonzero((state[:size, :3] >= demand).all(axis=1))
            if len(fits):
                residual = state[fits, :3]
                if c.rule == "dot":
                    g = fits[np.argmax(residual @ (weights * demand))]
                else:
                    g = fits[np.argmin(((residual - demand) ** 2) @ weights)]
                room, first, n = state[g, :3].copy(), int(state[g, 3]), int(state[g, 4])
            else:
                g, room, first = None, most.astype(np.int64), opened
                n = left
            each = min(int((room // demand).min()), left)  # the fullest sequence stays the best one until it is full
            n = min(n, left // each)
            used = c.tokens - int(room[0])
            for i in range(each):
                plan.append((length, placed, n, first, used + i * length))
                placed += n
            left -= n * each
            if g is None:
                opened += n
            elif n == state[g, 4]:
                size -= 1
                state[g] = state[size]
            else:
                state[g, 3] += n
                state[g, 4] -= n
            open_group(tuple((room - each * demand).tolist()), first, n)
    return np.array(plan, np.int64).reshape(-1, 5)


def pack_documents(docs: DataFrame, path: str, c: Capacity = Capacity(), end: int = 1, scratch: Scratch | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    scratch = scratch or Scratch(docs.sparkSession, "packing")
    pieces = scratch.keep(tokenised_pieces(docs, path, c.tokens, end), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = pack_histogram(counts, c)
    # The sort below puts shorter pieces first: a plan row covers positions from its length's first one.
    firsts, at = {}, 0
    for length in sorted(counts):
        firsts[length], at = at, at + counts[length]
    starts = np.array([firsts[x] for x in plan[:, 0].tolist()], np.int64) + plan[:, 1]
    order = np.argsort(starts)
    shared = docs.sparkSession.sparkContext.broadcast((starts[order], plan[order, 3], plan[order, 4]))
    numbered = running_totals(scratch, pieces, ["length", "doc_id", "piece", "ids_crc32", "start"], [], "numbered", stored=True)

    def place(batches):
        starts, sequences, offsets = shared.value
        for batch in batches:
            position = batch.column(batch.num_columns - 1).to_numpy()
            i = np.searchsorted(starts, position, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequences[i] + position - starts[i]), pa.array(offsets[i])],
                [*batch.schema.names[:-1], "sequence_id", "offset"])

    places = [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")]
    return numbered.select(*pieces.columns, "position").mapInArrow(place, T.StructType(pieces.schema.fields + places))
