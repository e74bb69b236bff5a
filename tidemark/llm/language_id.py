"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary get probabilities per language. The likelihood of a word
is the sum, over all ways to cut it into pieces, of the product of their probabilities (forward
algorithm, for all distinct words of a batch at once). Probabilities are learnt by expectation
maximisation over word counts of a bounded sample of labelled texts: ``sample`` texts per language,
chosen by a hash of their content. Expected piece counts are summed by Spark; the driver holds
pieces x languages. Texts are lower-cased, only runs of letters count, and a cut is forced after
every 24 letters, so any text is scored whole in bounded memory.

A text that is null or has no letter is ``und`` with score 0. The score is the posterior of the
predicted language with equal priors; ties go to the smaller name. Without any labelled text every
document is ``und``. Repeated rows get equal results; an empty table gives no rows; columns named
like the outputs are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as W
from tidemark.llm.scratch import lean

UNKNOWN = "und"
LONGEST = 24  # letters scored as one word
LETTERS = regex.compile(r"\p{L}{1,%d}" % LONGEST)
FLOOR = 1e-7  # of a character that no piece covers
CHUNK = 2 << 20
START = "▁"


def public_pieces(path: str) -> list[str]:
    """Pieces of a vocabulary file that consist of letters, with or without the mark of a word's start."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({x for x in every if x == x.lower() and x.removeprefix(START).isalpha() or x == START})


class Lattice:
    """All pieces inside words, found by rolling hashes."""

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces), default=1)
        hashes = self._hash(pieces)
        self._order = np.argsort(hashes)
        self._sorted = hashes[self._order]

    @staticmethod
    def _codes(items: list[str]) -> np.ndarray:
        return W.mix(np.frombuffer("".join(items).encode("utf-32-le"), np.uint32).astype(W.U64))

    def _hash(self, items: list[str]) -> np.ndarray:
        lengths = np.array([len(x) for x in items], np.int64)
        starts = np.cumsum(lengths) - lengths
        return W.Rolling(self._codes(items)).stretch(starts, lengths)

    def blocks(self, items: list[str], size: int = 20_000):
        """Yields (numbers of words, lengths, piece(start, length, n)) for words of falling length."""
        lengths = np.array([len(x) + 1 for x in items], np.int64)
        order = np.argsort(-lengths, kind="stable")
        for at in range(0, len(order), size):
            own = order[at:at + size]
            n = lengths[own]
            starts = np.cumsum(n) - n
            rolling = W.Rolling(self._codes([START + items[i] for i in own]))

            def piece(start: int, length: int, k: int, rolling=rolling, starts=starts) -> np.ndarray:
                h = rolling.stretch(starts[:k] + start, length)
                i = np.minimum(np.searchsorted(self._sorted, h), len(self._sorted) - 1)
                return np.where(self._sorted[i] == h, self._order[i], -1)

            yield own, n, piece

    def forward(self, items: list[str], table: np.ndarray) -> np.ndarray:
        """Log-likelihood of each word under each column of ``table`` (pieces + 1 rows, the last is 0)."""
        out = np.zeros((len(items), table.shape[1]))
        for own, n, piece in self.blocks(items):
            alpha = np.zeros((n[0] + 1, len(own), table.shape[1]))
            alpha[0] = 1
            for end in range(1, n[0] + 1):
                k = int(np.searchsorted(-n, -end, side="right"))
                for length in range(1, min(end, self.longest) + 1):
                    found = piece(end - length, length, k)
                    step = table[found]
                    if length == 1:
                        step = np.where((found < 0)[:, None], FLOOR, step)
                    alpha[end, :k] += alpha[end - length, :k] * step
            out[own] = np.log(alpha[n, np.arange(len(own))])
        return out

    def expected(self, items: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece over the words (forward and backward sums)."""
        total = np.zeros(len(p))
        for own, n, piece in self.blocks(items):
            width, edges = int(n[0]), []
            alpha, beta = np.zeros((width + 1, len(own))), np.zeros((width + 1, len(own)))
            alpha[0] = 1
            for end in range(1, width + 1):
                k = int(np.searchsorted(-n, -end, side="right"))
                for length in range(1, min(end, self.longest) + 1):
                    found = piece(end - length, length, k)
                    step = np.where(found < 0, FLOOR if length == 1 else 0.0, p[found])
                    alpha[end, :k] += alpha[end - length, :k] * step
                    edges.append((end, length, k, found, step))
            beta[n, np.arange(len(own))] = 1
            for end, length, k, found, step in reversed(edges):
                beta[end - length, :k] += beta[end, :k] * step
            whole = alpha[n, np.arange(len(own))]
            for end, length, k, found, step in edges:
                use = alpha[end - length, :k] * step * beta[end, :k] / whole[:k] * counts[own[:k]]
                total += np.bincount(found[found >= 0], use[found >= 0], len(p))
        return total


@dataclass(frozen=True)
class Model:
    pieces: list[str]
    languages: list[str]
    table: np.ndarray  # (pieces + 1) x languages; the last row is 0


def _word_counts(batches):
    for batch in batches:
        for part in W.chunks(batch, "text", CHUNK):
            table = pa.table([part.column(0), pc.utf8_lower(W.strings(part.column(1)))], ["lang", "text"])
            for lang in table.column("lang").unique().to_pylist():
                texts = table.filter(pc.equal(table.column("lang"), lang)).column("text").combine_chunks()
                index, names = W.distinct(W.split_words(texts)[1])
                count: dict[str, int] = {}
                for name, n in zip(names, np.bincount(index, minlength=len(names)).tolist()):
                    for word in LETTERS.findall(name):
                        count[word] = count.get(word, 0) + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(count), pa.string()), pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())],
                    ["lang", "word", "n"])


def train(labelled: DataFrame, pieces: list[str], sample: int = 1500, rounds: int = 3, smoothing: float = 0.01) -> Model:
    """From ``labelled (text, lang, ...)``. ``sample`` bounds the texts per language that are learnt from, in
    expectation; a hash of all columns chooses them, so an id among them spreads the choice over equal texts."""
    labelled = labelled.where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    chosen = F.lit(False)
    for lang in languages:
        share = min(1.0, sample / sizes[lang])
        chosen = chosen | ((F.col("lang") == lang) & (F.pmod(F.xxhash64(*labelled.columns), F.lit(1 << 20)) < int(share * (1 << 20))))
    counts = labelled.where(chosen).select("lang", "text").mapInArrow(lean(_word_counts), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = counts.persist()
    table = np.full((len(pieces) + 1, max(1, len(languages))), 1.0 / max(1, len(pieces)))
    table[-1] = 0
    for _ in range(rounds if languages else 0):
        def expect(batches, table=table):
            lattice, total = Lattice(pieces), np.zeros((len(languages), len(pieces)))
            for batch in batches:
                lang = np.array(batch.column(0).to_pylist())
                word, n = np.array(batch.column(1).to_pylist(), dtype=object), batch.column(2).to_numpy()
                for j, name in enumerate(languages):
                    own = np.flatnonzero(lang == name)
                    if len(own):
                        total[j] += lattice.expected(list(word[own]), n[own], table[:-1, j])
            j, i = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(j, pa.int32()), pa.array(i, pa.int32()), pa.array(total[j, i])], ["j", "i", "use"])

        uses = counts.mapInArrow(lean(expect), "j int, i int, use double").groupBy("j", "i").agg(F.sum("use").alias("use")).toPandas()
        table = np.zeros_like(table)
        table[uses["i"], uses["j"]] = uses["use"]
        table[:-1] += smoothing
        table[:-1] /= table[:-1].sum(axis=0)
    counts.unpersist()
    return Model(pieces, languages, table)


def identify(docs: DataFrame, model: Model, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs``, and the predicted language with its posterior."""
    docs = docs.drop(lang_pred, score)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # pieces x languages
    names = docs.columns

    def predict(batches):
        m = shared.value
        lattice, options = Lattice(m.pieces), [*m.languages, UNKNOWN]
        for batch in batches:
            for part in W.chunks(batch, text, CHUNK):
                texts = pc.utf8_lower(W.strings(part.column(names.index(text))))
                bounds, every = W.split_words(texts)
                index, chunks = W.distinct(every)
                numbers: dict[str, int] = {}
                runs = [[numbers.setdefault(w, len(numbers)) for w in LETTERS.findall(c)] for c in chunks]
                flat = np.array([i for r in runs for i in r], np.int64)
                ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int64)
                letters = np.array([len(w) for w in numbers], np.float64)
                known = W.sums_by_text(W.sums_by_text(letters[flat], ends)[index], bounds) > 0
                best, top = np.full(len(texts), len(m.languages)), np.zeros(len(texts))
                if m.languages:
                    logs = lattice.forward(list(numbers), m.table)
                    total = np.stack([
                        W.sums_by_text(W.sums_by_text(logs[flat, j], ends)[index], bounds) for j in range(len(m.languages))])
                    total -= total.max(axis=0)
                    best = np.where(known, total.argmax(axis=0), best)
                    top = np.where(known, 1 / np.exp(total).sum(axis=0), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([options[i] for i in best], pa.string()), pa.array(top)], [*names, lang_pred, score])

    added = [T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())]
    return docs.mapInArrow(lean(predict), T.StructType(docs.schema.fields + added))


def held_out(doc_id: Column) -> Column:
    """A third of the documents, by their id; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_documents(docs: DataFrame, path: str) -> Model:
    """The production model: public pieces, learnt from the documents that are not held out."""
    return train(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"), public_pieces(path))


def accepted(docs: DataFrame, model: Model, least_score: float = 0.5) -> DataFrame:
    """The documents whose language is known, with the columns they came with."""
    rows = docs.select("text", F.struct(*docs.columns).alias("row"))
    return identify(rows, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("row.*")
