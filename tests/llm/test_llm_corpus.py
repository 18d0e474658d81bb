"""Operators on whole tables, and the pipeline, against plain versions of their contracts."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyweave.llm import mixing, neighbours, sharding, toxicity
from skyweave.llm.common import numbered, word_count
from skyweave.llm.components import components
from skyweave.llm.queries import ORACLES, QUERIES
from skyweave.session import stage

SF = "/root/testdata/sf0.001"


# sharding ----------------------------------------------------------------------------------------------


def test_difference_balances_better_than_dealing():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 10_000, 300)
    parts = np.zeros((300, 7), dtype=np.int64)
    parts[:, 0] = sizes
    to, sums = sharding.difference(parts)
    loads = np.bincount(to[:, 0], sizes, 7)
    assert sorted(loads) == sorted(sums) and loads.sum() == sizes.sum()
    greedy = np.zeros(7)
    for s in sorted(sizes, reverse=True):
        greedy[np.argmin(greedy)] += s
    assert np.ptp(loads) <= np.ptp(greedy)
    assert all(sorted(row) == list(range(7)) for row in to)


def test_two_ways_are_the_textbook_differencing():
    parts = np.zeros((5, 2), dtype=np.int64)
    parts[:, 0] = [8, 7, 6, 5, 4]
    assert np.ptp(sharding.difference(parts)[1]) == 2  # 8-7, 6-5 leave 4, 1, 1; then 3, 1; then 2


@pytest.mark.parametrize(("per_task", "large"), [(20_000, 64), (20, 2), (10, 1)])
def test_sharding(spark, docs, empty, monkeypatch, per_task, large):
    monkeypatch.setattr(sharding, "GROUPS_PER_TASK", per_task)
    monkeypatch.setattr(sharding, "LARGE", large)
    got = sharding.balanced_shards(spark, docs, 4).collect()
    rows = docs.select("doc_id", "text").collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r["doc_id"], 16 + len((r["text"] or "").encode())) for r in rows)
    text = {r["doc_id"]: r["text"] for r in rows}
    shards, slots, load = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        shards[text[r["doc_id"]]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in shards.values()) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    biggest = max(16 + len((t or "").encode()) for t in text.values())
    assert max(load.values()) <= max(biggest, 1.2 * sum(load.values()) / 4)
    again = sharding.balanced_shards(spark, docs, 4).collect()
    assert Counter(got) == Counter(again)
    assert sharding.balanced_shards(spark, empty, 4).count() == 0


# mixing ------------------------------------------------------------------------------------------------


def plain_targets(sizes, weights, repeats):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * share >= repeats * sizes[s]}
        if not full:
            return target | {s: weight[s] * share for s in open_}
        for s in full:
            target[s] = repeats * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def plain_tilt(sizes, target, repeats):
    """The dual solved by bisection."""
    scale = sum(sizes) / len(sizes)
    given = lambda t: sum(n * min(repeats, math.exp(min(t * n / scale, 700))) for n in sizes)
    low, high = -1e6, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if given(mid) < target else (low, mid)
    return low, scale


@pytest.mark.parametrize("weights", [(1, 2, 3), (1, 40), (1,)])
def test_mixing(spark, docs, empty, weights):
    got = mixing.mix(spark, docs, weights).collect()
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("n")).collect()
    sizes = defaultdict(list)
    for r in rows:
        sizes[r["source"]].append(r["n"])
    targets = plain_targets({s: sum(v) for s, v in sizes.items()}, weights, 3)
    tilts = {s: plain_tilt(v, targets[s], 3) for s, v in sizes.items()}
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(targets[r["source"]]) and r["source_size"] == sum(sizes[r["source"]])
        assert 0 <= r["copies"] <= 3
        tilt, scale = tilts[r["source"]]
        if targets[r["source"]] < 3 * r["source_size"]:
            assert r["rate"] == pytest.approx(min(3, math.exp(min(tilt * r["size"] / scale, 700))), abs=1e-4)
            assert r["copies"] in {max(0, math.floor(r["rate"])), math.floor(r["rate"]) + 1}
        taken[r["source"]] += r["copies"] * r["size"]
    for s, v in sizes.items():
        assert abs(taken[s] - targets[s]) <= max(v)
    assert Counter(got) == Counter(mixing.mix(spark, docs, weights).collect())
    assert mixing.mix(spark, empty).count() == 0
    whole = mixing.mix(spark, docs, whole_rows=True).select("doc.*")
    assert whole.columns == docs.columns and whole.count() == docs.count()


def test_numbered(spark):
    rows = spark.range(0, 500).select((F.col("id") * 7 % 101).alias("x"), "id").repartition(5)
    got = sorted(numbered(spark, rows, F.col("x"), F.col("id")).collect(), key=lambda r: r["nth"])
    assert [r["nth"] for r in got] == list(range(500)) and [(r["x"], r["id"]) for r in got] == sorted((r["x"], r["id"]) for r in got)


def test_components(spark):
    rng = np.random.default_rng(8)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    want = {x: find(x) for x in {v for p in pairs for v in p if p[0] != p[1]}}
    got = {r["node"]: r["root"] for r in components(spark, spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {x: r for x, r in want.items() if x != r} == got
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


# neighbours --------------------------------------------------------------------------------------------


def vectors_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank int")


def test_neighbours(spark):
    rng = np.random.default_rng(6)
    points = rng.normal(size=(900, 24)).astype(np.float32)
    rows = [(i, [float(x) for x in p], 0, 1) for i, p in enumerate(points)]
    rows += [(900, None, 0, 1), (901, [0.0] * 24, 0, 1), (902, [float("nan")] * 24, 0, 1), (903, [None] + [1.0] * 23, 0, 1), (None, [1.0] * 24, 0, 1), (1000, [1.0, 2.0], 0, 1)]
    rows += [rows[40], (904, rows[50][1], 0, 1), (905, rows[50][1], 0, 1), (906, [float("inf")] * 24, 0, 1), (907, [], 0, 1)]
    got = neighbours.nearest(spark, vectors_frame(spark, rows), F.col("vec_id") % 50 == 0, k=10).collect()
    exact = points.astype(np.float64)
    every = {i: exact[i] for i in range(900)} | {904: exact[50], 905: exact[50]}
    hits = 0
    for q in range(0, 900, 50):
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert all(r["score"] == pytest.approx(np.linalg.norm(every[r["vec_id"]] - exact[q]), abs=1e-12) for r in mine)
        assert [(r["score"], r["vec_id"]) for r in mine] == sorted((r["score"], r["vec_id"]) for r in mine)
        want = sorted((np.linalg.norm(v - exact[q]), i) for i, v in every.items() if i != q)[:10]
        hits += len({i for _, i in want} & {r["vec_id"] for r in mine})
    assert hits / 180 >= 0.9 and {r["query_id"] for r in got} == set(range(0, 900, 50))
    assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 50), key=lambda r: r["rank"])][:2] == [904, 905]


def test_neighbours_of_few_and_in_blocks(spark, monkeypatch):
    few = vectors_frame(spark, [(0, [1.0, 0.0], 0, 0), (1, [0.0, 1.0], 0, 0), (2, [2.0, 0.0], 0, 0)])
    got = neighbours.nearest(spark, few, F.col("vec_id") == 0, k=10).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(2, 1.0), (1, math.sqrt(2))]
    assert neighbours.nearest(spark, few.limit(0), F.lit(True)).count() == 0
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    monkeypatch.setattr(neighbours, "QUERIES", 3)
    rng = np.random.default_rng(1)
    points = rng.normal(size=(200, 8))
    rows = [(i, [float(x) for x in p], 0, 1) for i, p in enumerate(points)]
    got = neighbours.nearest(spark, vectors_frame(spark, rows), F.col("vec_id") % 20 == 0, k=5).collect()
    assert Counter(r["query_id"] for r in got) == {q: 5 for q in range(0, 200, 20)}


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.collect()
    points = np.array([r["embedding"] for r in rows], dtype=np.float64)
    ids = np.array([r["vec_id"] for r in rows])
    found = defaultdict(set)
    for r in neighbours.nearest(spark, table, F.col("vec_id") % 20 == 0).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits = 0
    for q in ids[ids % 20 == 0]:
        d = np.linalg.norm(points - points[ids == q][0], axis=1)
        d[ids == q] = np.inf
        hits += len(found[q] & set(ids[np.lexsort((ids, d))[:10]].tolist()))
    assert hits / (10 * (ids % 20 == 0).sum()) >= 0.9


def test_a_neighbour_as_far_as_the_last_found_is_verified():
    """Such a vector shares each window of the reach with probability 0.866, and must share enough of them."""
    n, p = neighbours.PROJECTIONS, math.erf(neighbours.REACH / math.sqrt(2))
    need = math.ceil(neighbours.SHARE * n)
    assert sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(need, n + 1)) > 0.95


# toxicity ----------------------------------------------------------------------------------------------


def test_machine_scores_pairs():
    m = toxicity.Machine(-1.0, np.array([3, 5, 9], np.int32), np.array([0.5, -0.2, 1.0]), np.array([[1.0, 0.0], [0.5, 2.0], [0.0, 1.0]]))
    z = -1.0 + 0.5 + 1.0 - 0.2 + (1.0 * 0.5) + (0.0) + (2.0 * 1.0)
    assert m.score([0, 1, 2]) == pytest.approx(1 / (1 + math.exp(-z)))
    assert toxicity.Machine().score([]) == 0.0


def test_factors_learn_what_weights_cannot():
    """Two terms that are toxic together only, or apart only, in equal shares."""
    rng = np.random.default_rng(0)
    rows, y = [], []
    for i in range(1200):
        a, b = rng.integers(0, 2, 2)
        filler = rng.choice(np.arange(100, 400), 10, replace=False)
        rows.append(np.unique(np.concatenate((([1] if a else []), ([2] if b else []), filler))).astype(np.int32))
        y.append(int(a and b))
    m = toxicity.fit(rows, np.array(y, dtype=float))
    place = {int(t): i for i, t in enumerate(m.ids)}
    scores = np.array([m.score([place[t] for t in r.tolist() if t in place]) for r in rows])
    assert ((scores >= 0.5) == np.array(y)).mean() > 0.98
    assert m.v[place[1]] @ m.v[place[2]] > 0.3


def test_factors_learn_pairs_of_terms_that_are_neutral_by_themselves():
    """Two terms that are toxic apart only: either is as common in toxic as in clean rows."""

    def some(seed, n):
        rng = np.random.default_rng(seed)
        rows, y = [], []
        for _ in range(n):
            a, b = rng.integers(0, 2, 2)
            filler = rng.choice(np.arange(100, 400), 10, replace=False)
            rows.append(np.unique(np.concatenate((([1] if a else []), ([2] if b else []), filler))).astype(np.int32))
            y.append(float(a != b))
        return rows, np.array(y)

    m = toxicity.fit(*some(0, 1200))
    place = {int(t): i for i, t in enumerate(m.ids)}
    rows, y = some(5, 1000)
    scores = np.array([m.score([place[t] for t in r.tolist() if t in place]) for r in rows])
    assert ((scores >= 0.5) == y).mean() > 0.95
    assert m.v[place[1]] @ m.v[place[2]] < -0.3


def test_held_out_toxicity(spark, docs, empty):
    rows = []
    rng = np.random.default_rng(12)
    filler = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(300)]
    for i in range(600):
        words = rng.choice(filler, 30).tolist()
        if i % 8 == 0:
            words[int(rng.integers(30))] = ["dolt", "Oaf,"][i % 16 // 8]
        rows.append((i, " ".join(words), int(i % 8 == 0), "x"))
    table = spark.createDataFrame([*rows, (601, None, None, "x"), (602, "", 0, "x")], "doc_id long, text string, toxic int, toxicity string")
    train = table.where("doc_id % 3 <> 0")
    machine = toxicity.train(spark, train.drop("toxic"), train.select("doc_id", "toxic"))
    scored = toxicity.score(spark, table.select("doc_id", "text", F.col("toxic").alias("marked")), machine).collect()
    held = [r for r in scored if r["doc_id"] % 3 == 0 and r["doc_id"] < 600]
    assert sum((r["toxicity"] >= 0.3) == bool(r["marked"]) for r in held) / len(held) > 0.97
    assert all(0 <= r["toxicity"] <= 1 for r in scored) and len(scored) == 602
    none = toxicity.train(spark, docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["toxicity"] for r in toxicity.score(spark, docs, none).collect()} == {0.0}
    assert toxicity.score(spark, empty, machine).count() == 0


# queries and pipeline ----------------------------------------------------------------------------------


def test_all_ten_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11)) and set(ORACLES) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    out = QUERIES[name](spark, SF)
    rows = out.count()
    if name.startswith("op1_"):
        assert rows == 50
    elif name.startswith("op4_"):
        assert rows >= 200 and out.select("doc_id").distinct().count() == 200
    else:
        assert rows == 200


def test_pipeline(spark, docs, empty, tmp_path):
    labels = docs.select("doc_id", F.coalesce(F.col("text").contains("aaaa"), F.lit(False)).cast("int").alias("toxic"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for start in (docs, empty):
        now = start
        for name, step in corpus_pipeline.STAGES:
            before, now = now, stage(spark, step(spark, now, str(tmp_path)))
            if name != "packing":
                assert now.columns == docs.columns and now.dtypes == docs.dtypes
            ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
            assert ids(now) <= ids(before)
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert kept.count() < docs.count()
    clean = spark.createDataFrame([(1, "nothing to hide", "en", "s", 15), (2, "token=abcdefgh12", "en", "s", 16)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(tuple(r) for r in corpus_pipeline.secrets(spark, clean, "").collect()) == [(1, "nothing to hide", "en", "s", 15), (2, "[secret]", "en", "s", 8)]
