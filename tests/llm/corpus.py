"""Small corpora for the tests of the corpus operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(n: int = 60, seed: int = 1) -> list[tuple]:
    """Texts of invented words with copies, near copies and shared passages."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioubdgklmnrst") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    texts: list[str] = []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            text = rng.choice(texts)
        elif texts and kind < 0.35:
            own = rng.choice(texts).split()
            for _ in range(max(1, len(own) // 80)):
                own[rng.randrange(len(own))] = rng.choice(words)
            text = " ".join(own)
        else:
            text = " ".join(rng.choice(words) for _ in range(rng.randint(3, 150)))
            if kind > 0.8:
                text += "\n" + passage + ".\t" + rng.choice(words)
        texts.append(text)
    return [(i, t, rng.choice(["en", "fr"]), f"s{i % 4}", len(t)) for i, t in enumerate(texts)]


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    return [
        (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \t\n", "en", None, 3), (None, "one two three", "en", "b", 13),
        (4, "one two three", None, None, 13), (4, "one two three", None, None, 13), (5, long, "en", "a", len(long)),
        (6, long + " end", "en", None, None), (7, "x", "fr", "a", 1), (8, "one  two\tthree", "fr", "b", 14), (None, None, None, None, None),
    ]


CLASHING = ("row", "id", "size", "position", "hash", "n", "copy", "label", "score", "lang_pred", "bucket", "_part", "_id", "key")


def with_clashing(df):
    """The same rows with further columns that carry names used inside the operators."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})
