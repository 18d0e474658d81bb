"""Segmentation and legs against plain sequential models, and the edge cases the rules imply."""

from __future__ import annotations

import math
import random

import pytest

from skyweave.operators import nearest
from skyweave.operators.legs import flight_legs, leg_pieces, segments_from_pieces, track_distance
from skyweave.operators.nearest import nearest_within
from skyweave.operators.segments import number_segments, numbered_pieces, segment_fixes, with_segment

DDL = (
    "hex string, snapshot_time bigint, latitude double, longitude double, alt_baro int, on_ground boolean, hub string, "
    "callsign string, registration string, aircraft_type string, ground_speed double, emergency string"
)
AIRPORTS = [("KJFK", 40.6398, -73.7789), ("KLAX", 33.9425, -118.408)]


def fix(hex_id, t, lat=40.64, lon=-73.78, alt=None, ground=False, **more):
    row = {"hub": "KJFK", "callsign": None, "registration": None, "aircraft_type": None, "ground_speed": None, "emergency": None} | more
    return (hex_id, t, lat, lon, alt, ground, row["hub"], row["callsign"], row["registration"], row["aircraft_type"], row["ground_speed"], row["emergency"])


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def airports(spark):
    return spark.createDataFrame(AIRPORTS, "ident string, latitude double, longitude double")


def haversine(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 3440.065 * math.asin(min(1.0, math.sqrt(h)))


def walk(rows, gap):
    """Segment number per (hex, time), one fix after the other."""
    out, by_hex = {}, {}
    for r in rows:
        by_hex.setdefault(r[0], []).append(r)
    for hex_id, fixes in by_hex.items():
        number, armed, last = 0, False, None
        for f in sorted(fixes, key=lambda r: r[1]):
            if last is not None and (f[1] - last[1] > gap or (armed and f[5] and last[5])):
                number, armed = number + 1, False
            armed = armed or (not f[5] and (f[4] or 0) > 0)
            out[hex_id, f[1]] = number
            last = f
    return out


def random_fixes(seed, aircraft, hot=0):
    rng = random.Random(seed)
    rows = []
    for a in range(aircraft):
        t = rng.randrange(3000)
        for _ in range(hot if hot and a == 0 else rng.randrange(1, 60)):
            t += rng.choice([1, 5, 60, 60, 200, 899, 900, 901, 5000])
            ground = rng.random() < 0.5
            located = rng.random() > 0.1
            rows.append(
                fix(f"h{a}", t, rng.uniform(30, 31) if located else None, rng.uniform(-75, -74) if located else None,
                    rng.choice([None, 0, 100, 30000]), rng.choice([ground, ground, None]), callsign=rng.choice([None, "", "C1", "C2"]))
            )
    return rows


@pytest.mark.parametrize("chunk", [7, 300, 1000, 86_400])
def test_segments_equal_the_sequential_walk(spark, chunk):
    rows = random_fixes(5, 60)
    got = {(r.hex, r.snapshot_time): r.seg for r in segment_fixes(frame(spark, rows), 900, chunk).collect()}
    assert got == walk(rows, 900)


def test_one_aircraft_with_most_rows(spark):
    rows = random_fixes(11, 12, hot=3000)
    got = {(r.hex, r.snapshot_time): r.seg for r in segment_fixes(frame(spark, rows), 900, 20_000).collect()}
    assert got == walk(rows, 900)


@pytest.mark.parametrize("chunk", [300, 86_400])
def test_track_distance_equals_the_sequential_sum(spark, chunk):
    rows = random_fixes(9, 40)
    numbers, want, last = walk(rows, 900), {}, {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        key = (r[0], numbers[r[0], r[1]])
        want.setdefault(key, 0.0)
        if r[2] is not None:
            if key in last:
                want[key] += haversine(*last[key], r[2], r[3])
            last[key] = (r[2], r[3])
    got = {(r.hex, r.seg): r.track_distance_nm for r in track_distance(frame(spark, rows), 900, chunk).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 0.011 for k in want)


def test_complete_leg_names_both_airports(spark):
    rows = [
        fix("a", 0, 40.64, -73.78, ground=True), fix("a", 300, 39.0, -90.0, 35000), fix("a", 600, 36.0, -105.0, 34000, callsign="DAL1"),
        fix("a", 900, 33.94, -118.41, ground=True),
    ]
    leg = flight_legs(frame(spark, rows), airports(spark)).first()
    assert (leg.dep_airport, leg.arr_airport, leg.complete) == ("KJFK", "KLAX", True)
    assert (leg.leg_id, leg.fix_count, leg.max_alt_ft, leg.callsign, leg.duration_s) == ("a-0", 4, 35000, "DAL1", 900)
    assert leg.track_efficiency >= 1.0


def test_transit_has_no_airports(spark):
    rows = [fix("a", t, 40.64, -73.78 + t / 1000, 30000) for t in (0, 300, 600)]
    leg = flight_legs(frame(spark, rows), airports(spark)).first()
    assert (leg.dep_airport, leg.arr_airport, leg.complete) == (None, None, False)


def test_airport_is_never_guessed_beyond_the_radius(spark):
    rows = [fix("a", 0, 41.5, -73.78, ground=True), fix("a", 600, 41.6, -73.0, 5000)]
    assert flight_legs(frame(spark, rows), airports(spark)).first().dep_airport is None


def test_gap_splits_and_short_or_ground_segments_drop(spark):
    rows = [fix("a", t, alt=9000) for t in (0, 400, 10_400, 10_900)]
    rows += [fix("b", t, ground=True) for t in (0, 500)] + [fix("c", t, alt=9000) for t in (0, 299)]
    rows += [fix(None, 0, alt=9000), fix("", 0, alt=9000), fix("d", None, alt=9000)]
    legs = flight_legs(frame(spark, rows), airports(spark)).collect()
    assert sorted(leg.leg_id for leg in legs) == ["a-0", "a-10400"]


def test_parked_time_belongs_to_the_next_leg(spark):
    rows = [
        fix("a", 0, alt=5000), fix("a", 400, ground=True), fix("a", 800, ground=True), fix("a", 1200, alt=5000), fix("a", 1600, alt=6000)
    ]
    legs = sorted(flight_legs(frame(spark, rows), airports(spark)).collect(), key=lambda r: r.start_time)
    assert [(leg.start_time, leg.end_time) for leg in legs] == [(0, 400), (800, 1600)]


def test_null_coordinates_leave_the_direct_distance_open(spark):
    rows = [fix("a", 0, None, None, 5000), fix("a", 400, 40.0, -73.0, 5000), fix("a", 700, 41.0, -73.0, 5000)]
    leg = flight_legs(frame(spark, rows), None).first()
    assert leg.direct_distance_nm is None and leg.track_efficiency is None
    assert abs(leg.track_distance_nm - 60.04) < 0.05


@pytest.mark.parametrize("radius", [3.0, 60.0])
def test_nearest_equals_brute_force(spark, radius):
    rng = random.Random(3)
    special = [(89.99, 10.0), (-89.98, 170.0), (10.0, 179.99), (10.0, -179.99), (0.0, 0.0), (90.0, 0.0)]
    sites = [(f"S{i:04d}", rng.uniform(-89, 89), rng.uniform(-180, 180)) for i in range(600)]
    sites += [(f"X{i}", lat, lon) for i, (lat, lon) in enumerate(special)] + [("A0", 10.0, 20.0), ("A1", 10.0, 20.0)]
    points = [(i, s[1] + rng.uniform(-0.05, 0.05) * radius / 3, s[2] + rng.uniform(-0.05, 0.05) * radius / 3) for i, s in enumerate(sites)]
    points = [(i, max(-90.0, min(90.0, lat)), (lon + 180) % 360 - 180) for i, lat, lon in points] + [(9999, None, 1.0)]
    want = {}
    for i, lat, lon in points:
        if lat is None:
            continue
        reach = [(haversine(lat, lon, s[1], s[2]), s[0]) for s in sites]
        reach = [r for r in reach if r[0] <= radius]
        if reach:
            want[i] = min(reach)[1]
    found = nearest_within(
        spark.createDataFrame(points, "id int, latitude double, longitude double"), ["id"],
        spark.createDataFrame(sites, "ident string, latitude double, longitude double"), radius,
    )
    assert {r.id: r.ident for r in found.collect()} == want


def test_pieces_are_numbered_alike_in_one_shuffle(spark, tmp_path):
    """Scanning the pieces gives the numbers of the scan over chunks; merging them moves them once, without a join."""
    path = str(tmp_path / "pieces")
    leg_pieces(frame(spark, random_fixes(7, 30, hot=400)), 900, chunk_seconds=1800).write.parquet(path)
    pieces = spark.read.parquet(path)
    columns = ["hex", "chunk", "piece", "seg"]
    got, want = numbered_pieces(pieces, 900), with_segment(pieces, number_segments(pieces, 900))
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    plan = segments_from_pieces(pieces, 900)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_dense_sites_are_looked_up_close_by(spark, monkeypatch):
    """Among dense sites only points with nothing near are looked up within the whole radius; ties and keys
    that repeat come out as without the first lookup."""
    rng = random.Random(4)
    sites = [(f"S{i:03d}", 40 + rng.random(), -74 + rng.random()) for i in range(400)]
    sites += [("T2", 44.0, -74.5), ("T1", 44.0, -73.5)]
    points = [(i, 40 + rng.random(), -74 + rng.random()) for i in range(200)] + [(200, 44.0, -74.0), (0, 43.9, -74.0), (201, 0.0, 0.0)]
    want = {}
    for i, lat, lon in points:
        d = min(((haversine(lat, lon, a, b), s) for s, a, b in sites), default=None)
        if d[0] <= 60.0:
            want[i] = min(want.get(i, d), d)
    assert want.pop(200)[1] in ("T1", "T2")
    pairs = []
    within = nearest._in_reach
    monkeypatch.setattr(nearest, "_in_reach", lambda *a: pairs.append(within(*a)) or pairs[-1])
    found = {
        r.id: (r.distance_nm, r.ident)
        for r in nearest_within(
            spark.createDataFrame(points, "id int, latitude double, longitude double"), ["id"],
            spark.createDataFrame(sites, "ident string, latitude double, longitude double"), 60.0,
        ).collect()
    }
    assert found.pop(200)[1] == "T1"
    assert {i: s for i, (_, s) in found.items()} == {i: s for i, (_, s) in want.items()}
    assert sum(p.where("_found IS NOT NULL").count() for p in pairs) < 200 * 400 / 4
