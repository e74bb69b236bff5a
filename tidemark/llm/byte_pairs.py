"""Byte-level BPE by forced boundaries: encoding whole texts and decoding token ids.

Two neighbouring bytes that occur side by side inside no token of the vocabulary can never end up
in one token, so the text may be cut between them for certain. A chunk of texts is cut between all
such pairs and at the ends of the tokenizer's words (letters, digits, other signs, white space, with
one leading space, contractions apart). Merges never cross these cuts, so every fragment is encoded
independently, distinct fragments once, and the ids are put together again. The tokenizers library
encodes the fragments; the classes of characters are also asked from it, so they are of its version
of Unicode.

A special token inside a text is one id, as in the library. Decoding joins the bytes of the tokens;
bytes that are no UTF-8 become U+FFFD. A null text is empty (no ids); null ids decode to an empty
text. A text of any length is one chunk of its own and whole. Repeated rows are separate documents.
An empty table gives no rows. All other columns are returned as they are.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as W
from tidemark.llm.packing import gather

CHUNK = 2 << 20  # bytes of text handled at once
REMEMBERED = 24 << 20  # bytes of fragments and ids that a worker remembers
SLICE = 4096  # fragments in one call of the library
LETTER, DIGIT, SIGN, SPACE = 1, 2, 3, 4


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def code_points(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte at which each begins (with the end as the last)."""
    if data.isascii():
        return np.frombuffer(data, np.uint8).astype(np.uint32), np.arange(len(data) + 1)
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    return points, np.concatenate([[0], np.cumsum(width)])


class BytePairs:
    """The vocabulary of one tokenizer file, its forced boundaries, and remembered fragments."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        words = config["pre_tokenizer"]
        if config["normalizer"] or words["type"] != "ByteLevel" or words["add_prefix_space"] or not words["use_regex"]:
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in config["added_tokens"]):
            raise ValueError(f"{path} has special tokens that take their surroundings")
        self._split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        whole = Tokenizer.from_file(path)
        self._model = Tokenizer(whole.model)
        self._model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()  # the byte alphabet has no white space
        alphabet = byte_alphabet()
        self._letters = {i: c for i, c in enumerate(alphabet)}
        of = {c: i for i, c in enumerate(alphabet)}
        self._special = {t["content"].encode(): t["id"] for t in config["added_tokens"]}
        special = set(self._special.values())
        vocabulary = whole.get_vocab(with_added_tokens=True)
        tokens: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = token.encode() if i in special else bytes(of[c] for c in token)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.forced = np.ones((256, 256), bool)
        for i, token in enumerate(tokens):
            if i not in special:
                pairs = np.frombuffer(token, np.uint8)
                self.forced[pairs[:-1], pairs[1:]] = False
        self._finder = re.compile(b"|".join(re.escape(t) for t in sorted(self._special, key=len, reverse=True))) if special else None
        self._classes = np.zeros(0x110000, np.uint8)
        self._known: dict[bytes, bytes] = {}
        self._size = 0

    def _class(self, points: np.ndarray) -> np.ndarray:
        """Letter, digit, sign or space, by how the library splits around the character."""
        found = self._classes[points]
        if (found == 0).any():
            for p in np.unique(points[found == 0]).tolist():
                between = lambda a, b: [stop - start for _, (start, stop) in self._split.pre_tokenize_str(a + chr(p) + b)]
                if between("a", "!") == [2, 1]:
                    kind = LETTER
                elif between("0", "!") == [2, 1]:
                    kind = DIGIT
                else:
                    kind = SIGN if between("!", "!") == [3] else SPACE
                self._classes[p] = kind
            found = self._classes[points]
        return found

    def word_starts(self, points: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """True where a word of the tokenizer begins; ``edges`` marks the beginnings of texts."""
        n, kind = len(points), self._class(points)
        start = edges.copy()
        start[1:] |= kind[1:] != kind[:-1]
        ends = np.append(start[1:], True)  # last character of a run
        outer = np.append(edges[1:], True)
        # White space before something else leaves its last character, and a space joins what follows.
        last = np.flatnonzero((kind == SPACE) & ends & ~outer)
        start[last] = True
        start[last[points[last] == 0x20] + 1] = False
        # Contractions: a word that begins with an apostrophe directly before certain letters.
        mark = np.flatnonzero((points == 0x27) & start & ~outer)
        ahead = np.append(points, [0, 0])
        one, two = ahead[mark + 1], ahead[mark + 2]
        two = np.where(np.append(outer, [True, True])[mark + 1], 0, two)
        letters = {c: ord(c) for c in "stmdrvel"}
        short = np.isin(one, [letters[c] for c in "stmd"])
        long = ((one == letters["r"]) | (one == letters["v"])) & (two == letters["e"]) | (one == letters["l"]) & (two == letters["l"])
        for found, size in ((mark[short], 2), (mark[long], 3)):
            start[found + 1] = False
            after = found + size
            start[after[after < n]] = True
        return start

    def _encode(self, fragments: list[bytes]) -> list[bytes]:
        """Ids of each fragment as little-endian 32-bit numbers."""
        out = []
        for at in range(0, len(fragments), SLICE):
            some = fragments[at:at + SLICE]
            coded = self._model.encode(" ".join([f.decode("latin-1").translate(self._letters) for f in some]), add_special_tokens=False)
            ids, word = np.array(coded.ids, "<u4"), np.array(coded.word_ids, np.int64)
            ends = np.searchsorted(word, np.arange(len(some)), side="right").tolist()
            out += [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends)]
        return out

    def _blobs(self, fragments: list[bytes]) -> list[bytes]:
        new = [f for f in fragments if f not in self._known]
        if new:
            coded = dict(zip(new, self._encode(new)))
            out = [self._known.get(f) or coded[f] for f in fragments]
            size = sum(map(len, new)) + sum(map(len, coded.values())) + 150 * len(new)
            if self._size + size > REMEMBERED:
                self._known, self._size = {}, 0
            if size <= REMEMBERED:
                self._known.update(coded)
                self._size += size
            return out
        return [self._known[f] for f in fragments]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of each text (large_string, without nulls) in the array of all ids."""
        if not len(texts):
            return np.zeros(1, np.int64), np.zeros(0, np.uint32)
        texts = pa.concat_arrays([texts])
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2].to_pybytes()[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else b""
        bounds = offsets - offsets[0]
        if not data:
            return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint32)
        points, at = code_points(data)
        special = [m.span() for i in self._with_special(texts) for m in self._finder.finditer(data, bounds[i], bounds[i + 1])]
        edges = np.zeros(len(data) + 1, bool)
        edges[bounds] = True
        edges[[x for span in special for x in span]] = True
        start = np.zeros(len(data), bool)
        start[at[:-1][self.word_starts(points, edges[at[:-1]])]] = True
        code = np.frombuffer(data, np.uint8)
        start[1:] |= self.forced[code[:-1], code[1:]]
        for a, b in special:
            start[a + 1:b] = False
        cuts = np.append(np.flatnonzero(start), len(data))
        fragments = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
        coded = fragments.dictionary_encode()
        index, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        blobs = self._blobs(names)
        if special:  # a text may hold the bytes of a special token only as that token
            blobs = [np.array([self._special[f]], "<u4").tobytes() if f in self._special else b for f, b in zip(names, blobs)]
        lengths = np.array([len(b) // 4 for b in blobs], np.int64)
        ids = np.frombuffer(b"".join(blobs), "<u4")
        counts = lengths[index]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ends[np.searchsorted(cuts, bounds)], gather(ids, (np.cumsum(lengths) - lengths)[index], counts)

    def _with_special(self, texts: pa.Array) -> np.ndarray:
        has = np.zeros(len(texts), bool)
        for token in self._special:
            has |= pc.match_substring(texts, token.decode()).to_numpy(zero_copy_only=False)
        return np.flatnonzero(has)

    def decode(self, bounds: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The text of each stretch of ids; an id that is not in the vocabulary has no bytes."""
        ids = ids.astype(np.int64)
        ok = (ids >= 0) & (ids < len(self.lengths))
        lengths = np.where(ok, self.lengths[np.where(ok, ids, 0)], 0)
        data = gather(self.bytes, self.starts[np.where(ok, ids, 0)], lengths).tobytes()
        at = np.concatenate([[0], np.cumsum(lengths)])[bounds].tolist()
        return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:])], pa.string())


_LOADED: dict[str, BytePairs] = {}


def loaded(path: str) -> BytePairs:
    return _LOADED.get(path) or _LOADED.setdefault(path, BytePairs(path))


def _added(frame: DataFrame, *fields: T.StructField) -> T.StructType:
    taken = set(frame.columns) & {f.name for f in fields}
    if taken:
        raise ValueError(f"columns {sorted(taken)} exist already: name the new ones otherwise")
    return T.StructType(frame.schema.fields + list(fields))


def _lists(bounds: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """The rows with their token ids and, if a name is given, the text decoded from these ids again."""
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    schema = _added(docs, *fields)

    def run(batches):
        pairs = loaded(path)
        for batch in batches:
            for part in W.chunks(batch, text, CHUNK):
                bounds, found = pairs.encode(W.strings(part.column(part.schema.get_field_index(text))))
                more = [pairs.decode(bounds, found)] if decoded else []
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(bounds, found), *more], schema.names)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """The rows with the text of their token ids; ids may be null or unknown."""
    schema = _added(rows, T.StructField(decoded, T.StringType()))
    rows = rows.withColumn(ids, F.col(ids).cast("array<int>"))

    def run(batches):
        pairs = loaded(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            values = pc.fill_null(column.flatten(), -1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pairs.decode(np.concatenate([[0], np.cumsum(lengths)]), values)], schema.names)

    return rows.mapInArrow(run, T.StructType([T.StructField(f.name, T.ArrayType(T.IntegerType()) if f.name == ids else f.dataType, f.nullable) for f in schema.fields]))


def digests(rows: DataFrame, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids joined by commas and of the decoded text."""
    return rows.select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2(F.col(decoded), 256).alias("decoded_sha256"))
