"""Small frames of documents, among them all the awkward ones."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "the", "ré", "sun", "x"]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def corpus(n: int = 60, seed: int = 5) -> list[tuple]:
    """Random texts with copies, near copies, shared passages, hot rows, nulls and a long text."""
    rng = random.Random(seed)
    passage = sentence(rng, 40)
    rows = []
    for i in range(n):
        text = sentence(rng, rng.randint(5, 120))
        if i % 5 == 1:
            text += "\n" + passage + "\n" + sentence(rng, 10)
        if i % 7 == 3 and rows:
            text = rng.choice(rows)[1] or ""
        if i % 11 == 4 and rows:
            text = (rng.choice(rows)[1] or "") + " " + sentence(rng, 1)
        rows.append((i * 3, text, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c", None]), len(text)))
    rows += [
        (1001, None, None, None, None), (1002, "", "en", "a", 0), (1003, " \t\n ", "en", "b", 4), (1004, "One", "en", "a", 3),
        (1005, sentence(rng, 20000), "de", "a", 1), (1006, "a" * 700, "de", "b", 700), (1007, "é" * 80 + " " * 300 + "b", "fr", "b", 1),
        (None, "no id here but words that are long enough to be a window of fifty bytes", "en", "a", 1), (None, None, None, "z", None),
        (1008, rows[0][1], "en", "a", 1), (1008, rows[0][1], "en", "a", 1), (1009, rows[2][1].upper(), "en", "a", 1),
        (1010, "<|endoftext|> it's we'll \x1c\x85 ½ Ⅷ 日本 🙂<|endoftext|>", "en", "a", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


#: Names that operators use inside, as extra columns of the input.
CLASHING = ("size", "block", "payload", "data", "part", "fp", "root", "rank", "score", "target", "ids", "bucket", "taken", "key", "class", "order", "copies")


def with_clashes(df):
    for name in CLASHING:
        df = df.selectExpr("*", f"'extra' AS `{name}`")
    return df
