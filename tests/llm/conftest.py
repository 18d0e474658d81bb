"""Small documents with the cases every operator has to stand."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, rate double"


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(words))


def make_docs(seed: int = 1) -> list[tuple]:
    """Nulls, empty and long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    texts: list[str | None] = [None, "", " \n\t", "one", "Ünïcode wörds öf ä smäll text 😀 end", "aaaa " * 300, "x" * 5000]
    texts += [sentence(rng, rng.randint(3, 200)) for _ in range(60)]
    texts += [texts[10], texts[10], texts[11]]
    texts += [texts[12] + " tail", texts[13].replace(" ", "  ", 1), texts[14][:-3]]
    texts += [sentence(rng, 20) + " " + passage + " " + sentence(rng, 20) for _ in range(6)]
    texts += [sentence(rng, 4000)]
    sources = ["alpha", "beta", None, "gamma", "Ähre"]
    rows = [(i * 7 % 1009, t, "en", sources[min(i % 9, 4)], None if t is None else len(t), 0.5, "k", 1.0) for i, t in enumerate(texts)]
    rows.append(rows[20])  # a repeated row
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(make_docs(), DOCS).repartition(3).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
