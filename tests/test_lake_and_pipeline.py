"""Merging, replay, ingest, publication, and the streaming jobs."""

from __future__ import annotations

import json
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from test_segments_and_legs import AIRPORTS, DDL, random_fixes

from skyweave import lake, streaming
from skyweave.operators.latest import keep_last
from skyweave.operators.legs import flight_legs
from skyweave.plans import pipeline, quality, warehouse
from skyweave.schemas import TABLES
from skyweave.session import clear_stages, stage

NOTAM = "notam_id string, location string, type string"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_keep_last(spark):
    df = spark.createDataFrame([("a", 1, "x", 1), ("a", 1, "y", 2), (None, 1, "z", 3), ("b", None, "w", 4)], "k string, n int, v string, seq int")
    assert rows(keep_last(df, ["k", "n"], ["seq"]), "k", "v") == [("a", "y")]
    assert rows(keep_last(df, ["k", "n"], ["seq"], nullable_keys=["n"]), "k", "v") == [("a", "y"), ("b", "w")]
    assert keep_last(df, [], ["seq"]).count() == 4


def test_upsert_is_idempotent_and_last_wins(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([("1", "KJFK", "N"), ("2", "KJFK", "N"), (None, "KJFK", "N")], NOTAM)
    second = spark.createDataFrame([("2", "KLAX", "R"), ("3", "KLAX", "N")], NOTAM)
    for df in (first, second, second):
        lake.upsert(spark, root, "fct_notam", df)
    assert rows(lake.read_table(spark, root, "fct_notam"), "notam_id", "location") == [("1", "KJFK"), ("2", "KLAX"), ("3", "KLAX")]
    lake.upsert(spark, root, "fct_notam", second.limit(0))
    assert lake.read_table(spark, root, "fct_notam").count() == 3


def test_merge_leaves_other_partitions_alone(spark, tmp_path):
    root = str(tmp_path)
    obs = lambda t, v: spark.createDataFrame([("KJFK", t, v)], "station string, obs_time bigint, visibility_sm double")
    lake.upsert(spark, root, "fct_weather_obs", obs(0, 1.0))
    lake.upsert(spark, root, "fct_weather_obs", obs(7200, 2.0))
    before = {r.f for r in lake.read_table(spark, root, "fct_weather_obs").where("hh = '00'").select(F.col("_metadata.file_path").alias("f")).collect()}
    lake.upsert(spark, root, "fct_weather_obs", obs(7200, 3.0))
    table = lake.read_table(spark, root, "fct_weather_obs")
    assert rows(table, "obs_time", "visibility_sm", "dt", "hh") == [(0, 1.0, "1970-01-01", "00"), (7200, 3.0, "1970-01-01", "02")]
    assert {r.f for r in table.where("hh = '00'").select(F.col("_metadata.file_path").alias("f")).collect()} == before


def test_partition_choice_is_exact_and_prunes(spark, tmp_path):
    df = spark.createDataFrame([("1", "00", 1), ("1", "01", 2), ("2", "00", 3), (None, "00", 4), ("3", "00", 5)], "dt string, hh string, v int")
    touched = spark.createDataFrame([("1", "01"), ("2", "00"), (None, "00")], "dt string, hh string")
    assert rows(lake.in_partitions(df, touched, ["dt", "hh"]), "v") == [(2,), (3,), (4,)]
    assert lake.in_partitions(df, touched.limit(0), ["dt", "hh"]).count() == 0
    df.write.partitionBy("dt", "hh").parquet(f"{tmp_path}/t")
    stored = spark.read.schema("v int, dt string, hh string").parquet(f"{tmp_path}/t")
    plan = lake.in_partitions(stored, touched, ["dt", "hh"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((dt" in plan or "PartitionFilters: [(((dt" in plan


def test_late_pages_do_not_win(spark, tmp_path):
    root = str(tmp_path)
    notice = lambda v, at: spark.createDataFrame([("n", v, at)], "notam_id string, type string, _captured_at bigint")
    lake.upsert(spark, root, "fct_notam", notice("new", 5))
    lake.upsert(spark, root, "fct_notam", notice("old", 3))
    assert lake.read_table(spark, root, "fct_notam").first().type == "new"
    lake.upsert(spark, root, "fct_notam", notice("newest", 6))
    lake.upsert(spark, root, "fct_notam", spark.createDataFrame([("n", "by hand")], "notam_id string, type string"))
    assert lake.read_table(spark, root, "fct_notam").first().type == "by hand"
    assert not set(lake.ARRIVAL) & set(lake.read_table(spark, root, "fct_notam").columns)


def test_merge_keeps_rows_of_a_blank_partition(spark, tmp_path):
    root = str(tmp_path)
    for number in (1, 2):
        lake.upsert(spark, root, "fct_orbital_element", spark.createDataFrame([(number, "2026-07-29")], "norad_cat_id int, epoch string"))
    assert rows(lake.read_table(spark, root, "fct_orbital_element"), "norad_cat_id", "dt", "hh") == [(n, "2026-07-29", "__none__") for n in (1, 2)]


def test_replay_of_a_window_keeps_later_values(spark, tmp_path):
    root, day = str(tmp_path), 86_400_000
    page = lambda name, at, visib: spark.createDataFrame([(name, at, json.dumps(observations(0, visib)))], "page_id string, captured_at bigint, payload string")
    pipeline.ingest(spark, root, "metar", page("late", 4 * day, 9), "r1", keep_ledger=False)
    pipeline.ingest(spark, root, "metar", page("early", 0, 1), "r2", keep_ledger=False)
    pipeline.replay(spark, root, "metar", until="1970-01-03")
    assert {r.visibility_sm for r in lake.read_table(spark, root, "fct_weather_obs").collect()} == {9.0}
    pipeline.ingest(spark, root, "metar", page("late", 4 * day, 9), "r3", keep_ledger=False)
    assert lake.scan_bronze(spark, root, "metar").count() == 2  # a page that comes again is not archived again


def test_publication_takes_rows_back(spark, tmp_path):
    root = str(tmp_path)
    legs = lambda data: spark.createDataFrame(data, "leg_id string, hex string, start_time bigint")
    pipeline.publish_legs(spark, root, legs([("a-0", "a", 0), ("b-0", "b", 0)]), legs([("a-0", "a", 0), ("b-0", "b", 0)]))
    pipeline.publish_legs(spark, root, legs([("a-0", "a", 0)]), spark.createDataFrame([("a",), ("b",)], "hex string"))
    assert rows(lake.read_table(spark, root, "fct_flight_leg"), "leg_id") == [("a-0",)]
    versions = lambda n: spark.createDataFrame([(f"h{i}", i) for i in range(n)], "hex string, valid_from bigint")
    pipeline.publish_dimension(spark, root, versions(8))
    pipeline.publish_dimension(spark, root, versions(1))
    assert rows(lake.read_table(spark, root, "dim_aircraft"), "hex") == [("h0",)]


def test_gold_from_stored_tables(spark, tmp_path):
    root = str(tmp_path)
    fixes = spark.createDataFrame(random_fixes(5, 40), DDL)
    airports = spark.createDataFrame(AIRPORTS, "ident string, latitude double, longitude double")
    lake.upsert(spark, root, "fct_position", fixes)
    lake.upsert(spark, root, "dim_airport", airports)
    pipeline.derive_legs(spark, root)
    direct = flight_legs(lake.read_table(spark, root, "fct_position"), airports)
    assert rows(lake.read_table(spark, root, "fct_flight_leg"), "leg_id") == rows(direct, "leg_id")
    for _ in range(2):
        pipeline.derive_dimension(spark, root)
    assert lake.read_table(spark, root, "dim_aircraft").groupBy("hex", "valid_from").count().where("count > 1").count() == 0


def test_stages_are_cleared(spark):
    kept = stage(spark, spark.range(5))
    assert kept.count() == 5
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert clear_stages(spark) > 0 and not lake.exists(spark, path) and clear_stages(spark) == 0


def test_missing_table_is_empty(spark, tmp_path):
    df = lake.read_table(spark, str(tmp_path), "dim_runway")
    assert df.isEmpty() and set(TABLES["dim_runway"].schema.names) < set(df.columns)


def test_replace_rows_takes_rows_back(spark, tmp_path):
    root = str(tmp_path)
    legs = lambda data: spark.createDataFrame(data, "leg_id string, hex string, start_time bigint")
    first = legs([("a-0", "a", 0), ("a-90000", "a", 90_000), ("b-90000", "b", 90_000), ("c-200000", "c", 200_000)])
    pipeline.publish_legs(spark, root, first, first)
    scope = spark.createDataFrame([("a",), ("c",)], "hex string")
    lake.replace_rows(spark, root, "fct_flight_leg", legs([("a-50", "a", 50)]), scope, ["hex"])
    assert rows(lake.read_table(spark, root, "fct_flight_leg"), "leg_id", "dt") == [("a-50", "1970-01-01"), ("b-90000", "1970-01-02")]


def pages(spark, payloads, start=1):
    data = [(f"p{start + i}", (start + i) * 1000, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(data, "page_id string, captured_at bigint, payload string")


def observations(t, visib):
    return {"observations": [{"icaoId": "KJFK", "obsTime": t, "visib": visib}, {"icaoId": "KLAX", "obsTime": t, "visib": visib}]}


def test_ingest_then_replay_gives_the_same_table(spark, tmp_path):
    root = str(tmp_path / "lake")
    pipeline.ingest(spark, root, "metar", pages(spark, [observations(0, 1), "{torn", observations(0, 2)]), "r1")
    pipeline.ingest(spark, root, "metar", pages(spark, [observations(3600, 3)], 10), "r2")
    columns = ("station", "obs_time", "visibility_sm", "dt", "hh")
    loaded = rows(lake.read_table(spark, root, "fct_weather_obs"), *columns)
    assert loaded == [(s, t, v, "1970-01-01", h) for s in ("KJFK", "KLAX") for t, v, h in ((0, 2.0, "00"), (3600, 3.0, "01"))]
    for _ in range(2):
        pipeline.replay(spark, root, "metar")
        assert rows(lake.read_table(spark, root, "fct_weather_obs"), *columns) == loaded
    assert lake.unreadable(lake.scan_bronze(spark, root, "metar")).count() == 1
    ledger = spark.read.parquet(f"{root}/ops/pipeline_run")
    assert rows(ledger, "run_id", "status", "pages", "rows_read") == [("r1", "ok", 3, 4), ("r2", "ok", 1, 2)]
    assert spark.read.parquet(f"{root}/ops/lineage").where("run_id = 'r1'").count() == 2


def test_pages_are_stored_in_small_row_groups(spark, tmp_path, monkeypatch):
    """A reader holds up to thousands of rows of a row group at once, so pages must come in few rows each."""
    root, held = str(tmp_path / "lake"), []
    groups = lambda files: [g for f in files for m in [pq.ParquetFile(f.removeprefix("file:")).metadata] for g in (m.row_group(i).num_rows for i in range(m.num_row_groups))]
    plain = pipeline.parse
    monkeypatch.setattr(pipeline, "parse", lambda p, s: held.extend(groups(p.inputFiles())) or plain(p, s))
    data = [(f"p{i}", i, json.dumps(observations(i, 1))) for i in range(500)]
    pipeline.ingest(spark, root, "metar", spark.createDataFrame(data, "page_id string, captured_at bigint, payload string").coalesce(1), "r1")
    stored = groups(lake.scan_bronze(spark, root, "metar").inputFiles())
    assert sum(held) == sum(stored) == 500 and max(held) <= 32 and max(stored) <= 32


def test_archive_moves_texts_once_and_keeps_each_page_once(spark, tmp_path, monkeypatch):
    root, plans = str(tmp_path), []
    frame = lambda data: spark.createDataFrame(data, "source string, page_id string, captured_at bigint, payload string")
    hour = 3_600_000
    first = [("s", "a", 1, "x"), ("s", "a", 2, "x"), ("s", "a", 3, "y"), ("s", None, 4, None), ("s", None, 5, None), ("s", "b", None, "x"), ("s", "c", 6, "z")]
    second = [*first[:4], ("s", "a", hour, "x"), ("s", "d", 7, "x"), ("s", "d", 8, "x"), ("s", "e", 9, "z")]
    kept = lambda: sorted((r.page_id or "", r.payload or "", r.hh or "") for r in spark.read.schema(lake.BRONZE_SCHEMA).parquet(f"{root}/bronze").collect())
    lake.archive(frame(first), root)
    stored = [("", "", "00"), ("a", "x", "00"), ("a", "y", "00"), ("b", "x", ""), ("c", "z", "00")]
    assert kept() == sorted(stored)
    for _ in range(2):  # the second time every page is held already
        lake.archive(frame(second), root)
        assert kept() == sorted([*stored, ("a", "x", "01"), ("d", "x", "00"), ("e", "z", "00")])
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **b: plans.append((path, self._df._jdf.queryExecution().optimizedPlan().toString())) or write(self, path, *a, **b))
    lake.archive(frame([("s", "f", 10, "new")]), root)
    written = next(plan for path, plan in plans if path == f"{root}/bronze")
    assert written.count("Repartition") + written.count("Rebalance") == 1 and "Aggregate" not in written and len(kept()) == 9


def test_failed_run_is_noted(spark, tmp_path, monkeypatch):
    def broken(_):
        raise ValueError("bad parser")

    monkeypatch.setattr(pipeline, "parse", lambda p, s: broken(p))
    with pytest.raises(ValueError):
        pipeline.ingest(spark, str(tmp_path), "metar", pages(spark, [observations(0, 1)]), "r1")
    run = spark.read.parquet(f"{tmp_path}/ops/pipeline_run").first()
    assert run.status == "error" and "bad parser" in run.error
    assert lake.scan_bronze(spark, str(tmp_path), "metar").count() == 1


def test_publication_is_gated(spark, tmp_path):
    root = str(tmp_path)
    lake.upsert(spark, root, "fct_notam", spark.createDataFrame([("1", None, "N")], NOTAM))
    with pytest.raises(RuntimeError, match="not_null"):
        warehouse.publish(spark, root, 0)
    assert warehouse.publish(spark, root, 0, require_clean=False)["marts"] == ["mart_notam_impact"]
    lake.upsert(spark, root, "fct_notam", spark.createDataFrame([("1", "KJFK", "N")], NOTAM))
    assert warehouse.publish(spark, root, 0)["marts"] == ["mart_notam_impact"]
    assert warehouse.build(spark, root)["tables"] == ["fct_notam"]
    assert warehouse.adhoc(spark, "SELECT notams FROM mart_notam_impact").first().notams == 1


def test_streamed_legs_equal_batch_legs(spark, tmp_path):
    """Fixes arrive out of order over several batches; the stream ends where the batch job does."""
    data = random_fixes(21, 25)
    random.Random(2).shuffle(data)
    inbox, root = str(tmp_path / "in"), str(tmp_path / "lake")
    sites = spark.createDataFrame(AIRPORTS, "ident string, latitude double, longitude double")
    for part in range(3):
        spark.createDataFrame(data[part::3], DDL).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(DDL).parquet(inbox)
        streaming.run_legs(stream, sites, root, str(tmp_path / "cp"), gap_seconds=900, airport_radius_nm=60.0).awaitTermination()
    want = flight_legs(spark.createDataFrame(data, DDL), sites, 900, 60.0)
    got = lake.read_table(spark, root, "fct_flight_leg").drop("dt")
    key = lambda r: tuple(repr(r[c]) for c in want.columns)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_first_rows_of_a_table_are_written_once(spark, tmp_path, monkeypatch):
    """Without stored rows there is nothing to compare with, so no copy is staged; keys are merged all the same."""
    monkeypatch.setattr(lake, "staged", None)
    data = [("a", 0, 1.0, 1), ("a", 0, 2.0, 2), ("b", 0, 3.0, 1), (None, 0, 4.0, 1)]
    fixes = spark.createDataFrame(data, "hex string, snapshot_time bigint, latitude double, _captured_at bigint")
    lake.upsert(spark, str(tmp_path), "fct_position", fixes)
    stored = lake.read_table(spark, str(tmp_path), "fct_position", arrival=True)
    assert rows(stored, "hex", "latitude", "squawk", "_captured_at", "dt", "hh") == [
        ("a", 2.0, None, 2, "1970-01-01", "00"), ("b", 3.0, None, 1, "1970-01-01", "00"),
    ]
    legs = spark.createDataFrame([("a-0", "a", 0)], "leg_id string, hex string, start_time bigint")
    lake.replace_rows(spark, str(tmp_path), "fct_flight_leg", legs, legs, ["hex"])
    assert rows(lake.read_table(spark, str(tmp_path), "fct_flight_leg"), "leg_id", "dt") == [("a-0", "1970-01-01")]


def test_stream_freshness(spark, tmp_path):
    spark.createDataFrame([("a", 100)], "hex string, snapshot_time bigint").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("hex string, snapshot_time bigint").parquet(str(tmp_path / "in"))
    streaming.run_freshness(stream, "fct_position", "snapshot_time", 60, str(tmp_path), str(tmp_path / "cp"), now=500).awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/ops/freshness"), "passed", "observed") == [(False, "400s old")]


POSITION = "hex string, snapshot_time bigint, latitude double, longitude double, alt_baro int, ground_speed double, track double"


def outcomes(df, *checks):
    return {r.check: r for r in quality.run_checks(df, "fct_position", checks).collect()}


@pytest.mark.parametrize(("missing", "passed"), [(1, True), (10, False)])
def test_null_tolerance(spark, missing, passed):
    df = spark.createDataFrame([("a", i, None if i < missing else 1.0, 1.0, 1, 1.0, 1.0) for i in range(100)], POSITION)
    results = {r.check: r for r in quality.run_suite(df, "fct_position").collect()}
    assert results["not_null[latitude]"].passed is passed
    assert results["not_null[latitude]"].observed == f"{missing}.0% null ({missing}/100)"
    assert all(r.passed for c, r in results.items() if c != "not_null[latitude]")


def test_checks_on_bad_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1, -95.0, 1.0, 1, 1.0, 1.0), ("a", 1, 95.0, 1.0, 1, 1.0, 1.0), (None, None, None, None, None, None, None)], POSITION)
    r = outcomes(df, quality.in_range("latitude", -90, 90), quality.unique(["hex", "snapshot_time"]), quality.fresh_within("snapshot_time", 10, 20), quality.row_count_between(5, 9))
    assert (r["in_range[latitude]"].passed, r["in_range[latitude]"].observed) == (False, "2 out of range e.g. -95.0")
    assert (r["unique[hex+snapshot_time]"].passed, r["unique[hex+snapshot_time]"].observed) == (False, "1 duplicates")
    assert (r["fresh_within[snapshot_time]"].passed, r["fresh_within[snapshot_time]"].observed) == (False, "19s old")
    blocking = quality.blocking(quality.run_checks(df, "t", [quality.row_count_between(5, 9), quality.in_range("latitude", -90, 90)]))
    assert rows(blocking, "check") == [("in_range[latitude]",)]
    empty = outcomes(df.limit(0), quality.not_empty(), quality.not_null("hex"), quality.fresh_within("snapshot_time", 10, 20))
    assert [empty[c].passed for c in ("not_empty", "not_null[hex]", "fresh_within[snapshot_time]")] == [False, True, False]
    known = spark.createDataFrame([("b",)], "icao24 string")
    assert outcomes(df, quality.referential("hex", known, "icao24"))["referential[hex]"].observed == "1 unknown e.g. ['a']"


def test_a_check_that_cannot_run_fails(spark):
    def explode_(_):
        raise KeyError("no such thing")

    broken = quality.Expectation("broken", lambda m: None, metrics=explode_)
    result = outcomes(spark.createDataFrame([("a", 1, 1.0, 1.0, 1, 1.0, 1.0)], POSITION), broken, quality.not_empty())
    assert not result["broken"].passed and "KeyError" in result["broken"].observed and result["not_empty"].passed


def test_silent_feed_is_noted_on_every_tick(spark, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "lake")
    schema = "feed string, t bigint"
    spark.createDataFrame([("adsb", 1000), ("metar", 900)], schema).write.parquet(inbox)
    streaming.run_arrivals(spark.readStream.schema(schema).parquet(inbox), "feed", "t", root, str(tmp_path / "a")).awaitTermination()
    feeds = spark.createDataFrame([("adsb",), ("metar",), ("taf",)], "feed string")
    for _ in range(3):  # three runs, no new file: each tick is a batch all the same
        ticks = streaming.heartbeat(spark, every_seconds=100, start_seconds=1050)
        streaming.run_watch(ticks, feeds, "feeds", 120, root, str(tmp_path / "w")).awaitTermination()
    noted = rows(spark.read.parquet(f"{root}/ops/freshness"), "batch_id", "feed", "passed", "observed")
    assert noted == [
        (0, "adsb", True, "50s old"), (0, "metar", False, "150s old"), (0, "taf", False, "no timestamps"),
        (1, "adsb", False, "150s old"), (1, "metar", False, "250s old"), (1, "taf", False, "no timestamps"),
        (2, "adsb", False, "250s old"), (2, "metar", False, "350s old"), (2, "taf", False, "no timestamps"),
    ]
    spark.createDataFrame([("adsb", 1340)], schema).write.mode("append").parquet(inbox)  # the feed comes back
    streaming.run_arrivals(spark.readStream.schema(schema).parquet(inbox), "feed", "t", root, str(tmp_path / "a")).awaitTermination()
    streaming.run_watch(streaming.heartbeat(spark, 100, 1050), feeds, "feeds", 120, root, str(tmp_path / "w")).awaitTermination()
    last = [r for r in rows(spark.read.parquet(f"{root}/ops/freshness"), "batch_id", "feed", "passed", "observed") if r[0] == 3]
    assert last == [(3, "adsb", True, "10s old"), (3, "metar", False, "450s old"), (3, "taf", False, "no timestamps")]
