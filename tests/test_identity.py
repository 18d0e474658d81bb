"""The versioned dimension against its rules and a sequential model."""

from __future__ import annotations

import random

from skyweave.operators.identity import IDENTITY_FIELDS, aircraft_dimension

FIX = "hex string, snapshot_time bigint, registration string, aircraft_type string"
REGISTRY = "icao24 string, registration string, aircraft_type string, operator string, operator_icao string"
VERSION = (
    "hex string, registration string, aircraft_type string, operator string, operator_icao string, valid_from bigint, "
    "valid_to bigint, is_current boolean, first_seen bigint, last_seen bigint"
)


def versions(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r["hex"], r["valid_from"]))


def model(fixes, existing, registry):
    known = {r[0]: dict(zip(IDENTITY_FIELDS, r[1:])) for r in registry}
    seen = {}
    for hex_id, t, reg, typ in fixes:
        if not hex_id or t is None:
            continue
        extra = known.get(hex_id, {})
        ident = (reg or extra.get("registration"), typ or extra.get("aircraft_type"), extra.get("operator"), extra.get("operator_icao"))
        if any(ident) and (hex_id not in seen or t > seen[hex_id][0]):
            seen[hex_id] = (t, ident)
    out = [dict(v) for v in existing]
    for hex_id, (t, ident) in seen.items():
        mine = [v for v in out if v["hex"] == hex_id]
        last = max(mine, key=lambda v: v["valid_from"], default=None)
        if last and tuple(last[f] for f in IDENTITY_FIELDS) == ident:
            last["last_seen"] = max(last["last_seen"], t)
            continue
        if last:
            last.update(valid_to=t, is_current=False)
        out.append({"hex": hex_id, **dict(zip(IDENTITY_FIELDS, ident)), "valid_from": t, "valid_to": None, "is_current": True, "first_seen": t, "last_seen": t})
    return sorted(out, key=lambda r: (r["hex"], r["valid_from"]))


def test_random_batches_equal_the_model(spark):
    rng = random.Random(4)
    registry = [(f"h{i}", rng.choice([None, "N1"]), rng.choice([None, "B738"]), rng.choice([None, "Op"]), rng.choice([None, "OPR"])) for i in range(0, 60, 2)]
    existing, clock = [], 0
    for _ in range(3):
        fixes = []
        for _ in range(200):
            clock += 1
            fixes.append((f"h{rng.randrange(60)}", clock, rng.choice([None, "", "N1", "N2"]), rng.choice([None, "B738", "A320"])))
        fixes += [(None, 1, "N1", None), ("", 1, "N1", None), ("h1", None, "N1", None)]
        rng.shuffle(fixes)
        stored = spark.createDataFrame([tuple(v.values()) for v in existing], VERSION) if existing else None
        got = versions(aircraft_dimension(spark.createDataFrame(fixes, FIX), stored, spark.createDataFrame(registry, REGISTRY)))
        assert got == model(fixes, existing, registry)
        existing = got


def test_same_identity_extends_and_change_closes(spark):
    first = aircraft_dimension(spark.createDataFrame([("a", 100, "N1", "B738")], FIX))
    same = aircraft_dimension(spark.createDataFrame([("a", 200, "N1", "B738")], FIX), first)
    assert [(r["valid_from"], r["last_seen"], r["is_current"]) for r in versions(same)] == [(100, 200, True)]
    changed = versions(aircraft_dimension(spark.createDataFrame([("a", 300, "N2", "B738")], FIX), same))
    assert [(r["registration"], r["valid_to"], r["is_current"]) for r in changed] == [("N1", 300, False), ("N2", None, True)]


def test_unseen_aircraft_keep_their_versions(spark):
    first = aircraft_dimension(spark.createDataFrame([("a", 100, "N1", None), ("b", 100, "N9", None)], FIX))
    later = versions(aircraft_dimension(spark.createDataFrame([("a", 200, "N1", None)], FIX), first))
    assert [r["hex"] for r in later] == ["a", "b"]


def test_tie_keeps_the_first_read(spark):
    from pyspark.sql import functions as F

    fixes = spark.createDataFrame([("a", 100, "N1", None, 1), ("a", 100, "N2", None, 2)], FIX + ", seq int")
    assert versions(aircraft_dimension(fixes, arrival=F.col("seq")))[0]["registration"] == "N1"


def test_dyadic_cells_tile_exactly(spark):
    from skyweave.operators import interval

    rows = [(0, 0), (5, 4), (-300, 17), (3, 1000), (123, 2**40), (7, 7)]
    got = spark.createDataFrame(rows, "lo long, hi long").select("lo", "hi", interval.dyadic_cells("lo", "hi").alias("c")).collect()
    for r in got:
        cells = [(c.level, c.cell) for c in r.c]
        assert all(sum(1 for level, _ in cells if level == k) <= 2 for k in range(interval.DYADIC_LEVELS))
        assert sum(2**level for level, _ in cells) == max(0, r.hi - r.lo + 1)
        for p in (r.lo - 1, r.lo, (r.lo + r.hi) // 2, r.hi, r.hi + 1):
            assert sum((p >> level) == cell for level, cell in cells) == (1 if r.lo <= p <= r.hi else 0)


def test_forecast_with_end_in_milliseconds(spark):
    """An end written in milliseconds lists a few cells, not hundreds of millions of hours."""
    from skyweave.operators import interval

    fc = "station string, issue_time long, period_from long, period_to long, change_indicator string, visibility_sm double, ceiling_ft int"
    forecasts = spark.createDataFrame(
        [("KAAA", 100, 0, 1_785_335_434_000, None, 6.0, 1000), ("KAAA", 200, 3600, 7200, "TEMPO", 2.0, 500), ("KBBB", 100, 7200, 7201, None, 1.0, 100)], fc
    )
    hours = spark.createDataFrame([("KAAA", 0), ("KAAA", 3600), ("KAAA", 36_000_000), ("KBBB", 7200), ("KBBB", 10800)], "station string, hour_start long")
    got = sorted(tuple(r) for r in interval.forecast_for_hour(hours, forecasts).collect())
    assert got == [
        ("KAAA", 0, 100, 0, None, 6.0, 1000), ("KAAA", 3600, 200, 3600, "TEMPO", 2.0, 500),
        ("KAAA", 36_000_000, 100, 0, None, 6.0, 1000), ("KBBB", 7200, 100, 7200, None, 1.0, 100),
    ]
