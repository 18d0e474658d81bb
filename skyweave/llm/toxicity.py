"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.common import id_share, small_batches, table

BITS = 20  # terms are hashed to so many bits
FACTORS = 4  # latent factors of a term
TRAIN_TOXIC, TRAIN_CLEAN = 6_000, 9_000  # labelled rows that the model is fitted on, at most
LEAST_G = 10.0  # a term whose log-likelihood ratio with the label is lower gets no weight in the first round
LEAST_ROWS = 5  # a term of fewer training rows is not learnt
BATCH, LEAST_STEPS = 256, 250  # rows of a step; steps of the second round, at least
WORD = re.compile(r"[^\W\d_]+")
MEMO = 500_000  # words whose terms a task remembers


def word_terms(word: str) -> tuple[int, ...]:
    """Hashed terms of a lower-case word: itself and its beginnings of four, five and six letters."""
    return tuple({zlib.crc32(t.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1) for t in (word, *(f"{word[:n]}-" for n in (4, 5, 6) if len(word) >= n))})


def terms(text: str | None) -> np.ndarray:
    """Distinct hashed terms of a text, sorted."""
    found = {t for w in set(WORD.findall((text or "").lower())) for t in word_terms(w)}
    return np.array(sorted(found), dtype=np.int32)


@dataclass
class Machine:
    """score = sigmoid(bias + sum of w over the terms + sum of v.v over the pairs of terms)."""

    bias: float = -np.inf
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    w: np.ndarray = field(default_factory=lambda: np.empty(0))
    v: np.ndarray = field(default_factory=lambda: np.empty((0, FACTORS)))

    def score(self, places: list[int]) -> float:
        """Score of a text from the places in ``ids`` of its terms; pairs in linear time."""
        z = self.bias
        if places:
            rows = self.v[places]
            z += self.w[places].sum() + 0.5 * ((rows.sum(axis=0) ** 2) - (rows**2).sum(axis=0)).sum()
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40)))) if np.isfinite(z) else 0.0


def _ratio(hits: np.ndarray, rows: np.ndarray, toxic: float, total: int) -> np.ndarray:
    """G statistic of terms in ``rows`` of ``total`` rows, ``hits`` of them toxic."""

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-300) / np.maximum(expected, 1e-300)), 0.0)

    share = toxic / total
    cells = ((hits, rows * share), (rows - hits, rows * (1 - share)), (toxic - hits, (total - rows) * share), (total - toxic - rows + hits, (total - rows) * (1 - share)))
    return 2 * sum(part(a, b) for a, b in cells)


def fit(rows: list[np.ndarray], y: np.ndarray, seed: int = 7) -> Machine:
    """Fit on the terms of some rows: all that at least ``LEAST_ROWS`` of them have.

    AdaGrad on the logistic loss, in two rounds. The first gives weights to terms whose log-likelihood ratio says that
    they go with the label. In the second all terms, also those that go with the label in no way by themselves,
    have a weight and latent factors. After a third of its steps a penalty takes weights, and the factors of a term
    together, to zero unless the loss holds them; terms that keep neither are left out of the machine.
    """
    if not len(y):
        return Machine()
    rate = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(rate / (1 - rate)))
    ids, place, n = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    sizes = np.array([len(r) for r in rows])
    kept = n >= LEAST_ROWS
    goes = _ratio(np.bincount(place, np.repeat(y, sizes), len(ids)), n, y.sum(), len(y))[kept] >= LEAST_G
    some = kept[place]
    cells = (np.cumsum(kept, dtype=np.int32) - 1)[place[some]]
    starts = np.searchsorted(np.repeat(np.arange(len(rows)), sizes)[some], np.arange(len(rows) + 1))
    ids = ids[kept].astype(np.int32)
    if not len(ids):
        return Machine(bias)
    rng = np.random.default_rng(seed)

    def batches() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, which row of the batch, place in ids) of the non-zeros."""
        order = rng.permutation(len(rows))
        for low in range(0, len(order), BATCH):
            some = order[low : low + BATCH]
            yield some, np.repeat(np.arange(len(some)), starts[some + 1] - starts[some]), np.concatenate([cells[starts[i] : starts[i + 1]] for i in some])

    w, squares, bias_square = np.zeros(len(ids)), np.full(len(ids), 1e-8), 1e-8
    for _ in range(8):
        for some, of, at in batches():
            z = bias + np.bincount(of, w[at], len(some))
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[some]) / len(some)
            g = np.bincount(at, error[of], len(ids)) * goes
            squares += g * g
            step = 0.3 / np.sqrt(squares)
            w -= step * g
            w = np.sign(w) * np.maximum(np.abs(w) - step * 4e-4, 0)
            bias_square += error.sum() ** 2
            bias -= 0.1 / np.sqrt(bias_square) * error.sum()
    # terms without a weight so far move as far as their gradient says, where AdaGrad's first steps are all of one length
    squares = np.where(w != 0, squares, np.maximum(squares, 1e-2))
    v = rng.normal(0, 0.05 / np.sqrt(max(1, len(cells) / len(rows) / 10)), (len(ids), FACTORS))
    v_squares = np.full(v.shape, 1e-4)
    epochs = max(6, -(-LEAST_STEPS * BATCH // len(rows)))
    for epoch in range(epochs):
        shrink = epoch >= epochs // 3
        for some, of, at in batches():
            mine = v[at]
            sums = np.stack([np.bincount(of, mine[:, f], len(some)) for f in range(FACTORS)], axis=1)
            z = bias + np.bincount(of, w[at] - 0.5 * (mine**2).sum(axis=1), len(some)) + 0.5 * (sums**2).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[some]) / len(some)
            pull = error[of]
            g = np.bincount(at, pull, len(ids))
            squares += g * g
            step = 0.1 / np.sqrt(squares)
            w -= step * g
            g = np.stack([np.bincount(at, pull * (sums[of, f] - mine[:, f]), len(ids)) for f in range(FACTORS)], axis=1)
            v_squares += g * g
            v_step = 0.05 / np.sqrt(v_squares)
            v -= v_step * g
            if shrink:
                w = np.sign(w) * np.maximum(np.abs(w) - step * 2e-3, 0)
                length = np.sqrt((v**2).sum(axis=1))
                v *= np.maximum(0, 1 - v_step.mean(axis=1) * 2e-2 / np.maximum(length, 1e-12))[:, None]
            bias_square += error.sum() ** 2
            bias -= 0.1 / np.sqrt(bias_square) * error.sum()
    kept = (w != 0) | (v != 0).any(axis=1)
    return Machine(bias, ids[kept], w[kept], v[kept])


def train(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", toxic_rows: int = TRAIN_TOXIC, clean_rows: int = TRAIN_CLEAN,
) -> Machine:
    """Fit a machine on the texts that ``labels`` marks 0 or 1.

    At most ``toxic_rows`` and ``clean_rows`` rows are taken, those with the least hash of the id; the bias
    is then set for the share of toxic rows among all labelled ones. The rows are turned into terms by
    tasks, and one task fits the model on them. Null labels and ids are passed over, an id labelled more
    than once counts with its highest label, and of documents that share an id one is taken. Without labelled rows every score is 0.
    """
    small_batches(spark)
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.max("y").alias("y"))
    totals = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = (F.xxhash64("doc_id", F.lit("train")), F.col("doc_id"))
    sample = marked.where("y = 1").orderBy(*order).limit(toxic_rows).unionByName(marked.where("y = 0").orderBy(*order).limit(clean_rows))
    # the sample is bounded by its two parameters, so it may be broadcast
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])

    @F.pandas_udf("array<int>")
    def of(column: pd.Series) -> pd.Series:
        return pd.Series([terms(t) for t in column], dtype=object)

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        m = fit([np.asarray(t, dtype=np.int32) for t in pdf["terms"]], pdf["y"].to_numpy(dtype=np.float64))
        share = pdf["y"].mean()
        return pd.DataFrame({"bias": [m.bias], "share": [share], "ids": [m.ids.tobytes()], "w": [m.w.tobytes()], "v": [m.v.tobytes()]})

    found = texts.select("doc_id", "y", of("text").alias("terms")).groupBy(F.lit(0).alias("all")).applyInPandas(
        learn, "bias double, share double, ids binary, w binary, v binary").first()
    if found is None:
        return Machine()
    bias, share, whole = found["bias"], found["share"], sum(totals.values())
    true = (totals.get(1, 0) + 0.5) / (whole + 1)
    used = min(max(share, 0.5 / (whole + 1)), 1 - 0.5 / (whole + 1))
    bias += np.log(true / (1 - true)) - np.log(used / (1 - used))
    return Machine(bias, np.frombuffer(found["ids"], np.int32), np.frombuffer(found["w"]), np.frombuffer(found["v"]).reshape(-1, FACTORS))


def score(spark: SparkSession, docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``toxicity`` from 0 to 1, from the whole text alone.

    Null and empty texts have the score of a text without terms. Every row and column stays; a column
    named ``toxicity`` is replaced. Tasks look at their own rows, nothing is shuffled; the model they get
    has a weight for at most 2**``BITS`` terms.
    """
    small_batches(spark)
    model = spark.sparkContext.broadcast((machine.bias, machine.ids, machine.w, machine.v))

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Machine(*model.value)
        place = {int(t): i for i, t in enumerate(m.ids)}
        memo: dict[str, tuple[int, ...]] = {}
        for column in texts:
            out = []
            for text in column:
                found: set[int] = set()
                for word in set(WORD.findall((text or "").lower())):
                    at = memo.get(word)
                    if at is None:
                        if len(memo) >= MEMO:
                            memo.clear()
                        at = memo[word] = tuple(place[t] for t in word_terms(word) if t in place)
                    if at:
                        found.update(at)
                out.append(m.score(sorted(found)))
            yield pd.Series(out, dtype="float64")

    return docs.withColumn("toxicity", of(F.col(text_col)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a machine that learns from three quarters of the ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_share(F.col("doc_id"), 4) == 2, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out)
    out = score(spark, docs, train(spark, docs.where(~held_out), labels))
    return out.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), F.when(F.col("toxicity") >= 0.3, 1).otherwise(0).alias("predicted"))
