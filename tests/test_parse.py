"""Parse jobs on small hand-made payloads of the shapes the feeds have."""

from __future__ import annotations

import json
import time

import pytest

from skyweave.sources import PARSERS, reference
from skyweave.sources.pages import without_origin


def parse(spark, source, payload):
    pages = spark.createDataFrame(
        [("p1", 1000, payload if isinstance(payload, str) else json.dumps(payload)), ("p2", 1001, "{torn"), ("p3", 1002, "{}")],
        "page_id string, captured_at bigint, payload string",
    )
    return without_origin(PARSERS[source].parse(pages)).collect()


def test_surveillance(spark):
    rows = parse(spark, "surveillance", {
        "now": 1785333180999, "_feed": "f", "_hub": "KJFK",
        "ac": [
            {"hex": " AB12 ", "alt_baro": "Ground", "flight": "DAL1  ", "gs": 12.7, "squawk": "7700", "emergency": "none", "mlat": ["a"]},
            {"hex": "x", "alt_baro": 1200, "r": "", "alt_geom": "12", "gs": "1.5", "emergency": "Minfuel", "mlat": [], "flight": 7},
            {"hex": "y", "alt_baro": "1200", "alt_geom": "12.5", "messages": 3.9}, {"hex": None}, {"hex": ""}, {"alt_baro": 1},
        ],
    })
    a, b, c = rows
    assert (a.hex, a.snapshot_time, a.alt_baro, a.on_ground, a.callsign, a.emergency, a.mlat) == ("ab12", 1785333180, None, True, "DAL1", "emergency", True)
    assert (b.alt_baro, b.on_ground, b.registration, b.alt_geom, b.ground_speed, b.emergency, b.mlat, b.callsign) == (1200, False, None, 12, 1.5, "minfuel", False, None)
    # Textual digits are no altitude, a fraction in text is no integer, a fractional number is truncated.
    assert (c.alt_baro, c.on_ground, c.alt_geom, c.messages) == (None, False, None, 3)


def test_states_may_be_short(spark):
    full, short = parse(spark, "opensky", {"time": 5, "_authenticated": True, "states": [
        ["abc", " C1 ", "US", 1, 2, 3.0, 4.0, 5, True, 1.0, 2.0, 3.0, [1, 2], 9.0, "1200", False, 0], ["short", "  "]]})
    assert (full.callsign, full.on_ground, full.spi, full.sensor_count, full.authenticated, full.position_source) == ("C1", True, False, 2, True, 0)
    assert (short.icao24, short.callsign, short.on_ground, short.sensor_count) == ("short", None, None, None)


def test_metar_and_taf(spark):
    clouds = [{"cover": "SCT", "base": 100}, {"cover": "BKN", "base": 3300}, {"cover": "OVC", "base": 1800}, {"cover": "BKN", "base": None}]
    a, b = parse(spark, "metar", {"observations": [
        {"icaoId": "KLAX", "obsTime": 9, "wdir": 90, "visib": 9, "clouds": clouds}, {"icaoId": "KORD", "obsTime": 9, "wdir": "VRB", "visib": "10+", "clouds": [clouds[0]]}]})
    assert (a.wind_dir_deg, a.visibility_sm, a.ceiling_ft) == (90, 9.0, 1800)
    assert (b.wind_dir_deg, b.visibility_sm, b.ceiling_ft) == (None, 10.0, None)
    periods = [{"timeFrom": 1, "timeTo": 3, "visib": "6+"}, {"timeFrom": 1, "timeTo": 2, "fcstChange": "TEMPO", "visib": ""}]
    base, tempo = parse(spark, "taf", {"forecasts": [{"icaoId": "KJFK", "issueTime": "t", "fcsts": periods}, {"icaoId": "X", "fcsts": None}]})
    assert (base.visibility_sm, base.change_indicator, tempo.visibility_sm, tempo.change_indicator) == (6.0, None, None, "TEMPO")


@pytest.mark.parametrize(
    ("lons", "want"),
    [
        ([-100, -90], (-100.0, -90.0, False)),
        ([170, 183.8], (170.0, -176.2, True)),
        ([175, -175], (175.0, -175.0, True)),
        ([-190, -170], (170.0, -170.0, True)),
        ([], (None, None, False)),
    ],
)
def test_polygon_box(spark, lons, want):
    (row,) = parse(spark, "sigmet", {"sigmets": [{"firId": "F", "hazard": "VA", "coords": [{"lat": 50 + i, "lon": x} for i, x in enumerate(lons)]}]})
    got = (row.min_lon, row.max_lon, row.crosses_antimeridian)
    assert got[2] == want[2] and all((g is None) == (w is None) and (g is None or abs(g - w) < 1e-9) for g, w in zip(got[:2], want[:2]))
    assert (row.hazard_id, row.hazard_name) == ("F-None-None-VA", "volcanic_ash")


XML = (
    "<S><Update_Time>Wed Jul 29 14:30:34 2026 GMT</Update_Time>"
    "<Delay_type><Name>Closures</Name><L><A><ARPT> sfo</ARPT><Reason> 007 </Reason><Reopen>soon</Reopen><New>1.50</New></A>"
    "<A><ARPT>LAX</ARPT><Start>true</Start></A></L></Delay_type>"
    "<Delay_type><Name>Delays</Name><M><D><ARPT>SAN</ARPT><Arrival_Departure Type='Departure'><Min>31 minutes</Min><Max>45 minutes</Max>"
    "<Trend>Up</Trend></Arrival_Departure><Arrival_Departure Type='Arrival'><Min>5 minutes</Min></Arrival_Departure></D></M></Delay_type></S>"
)


def test_airport_status_xml(spark):
    sfo, lax, san = sorted(parse(spark, "disruption", {"xml": XML}), key=lambda r: ["SFO", "LAX", "SAN"].index(r.airport))
    assert (sfo.observed_at, sfo.delay_type, sfo.reason, sfo.reopen_time, sfo.extra) == (1785335434, "Closures", "007", "soon", "new=1.50")
    assert lax.extra == "start=true"
    assert (san.departure_delay_min, san.departure_delay_max, san.arrival_delay_min) == ("31 minutes", "45 minutes", "5 minutes")
    assert san.extra == "arrival_departure_departure_trend=Up"


def test_xml_of_any_depth(spark):
    deep = "<a><b><c><d><e><f><Stop><ARPT> jfk </ARPT><p><q q='X &amp; y'><r><s><t><u>007</u></t></s></r></q></p><k1>x</k1><k>y</k><k>z &#233;&#x20AC;</k><Avg/></Stop></f></e></d></c></b></a>"
    text = f"<?xml version='1.0'?><R><!-- <x> --><Update_Time>Wed Jul 29 14:30:34 2026 GMT</Update_Time><Other><ARPT>no</ARPT></Other><Delay_type><Name>Deep</Name>{deep}</Delay_type><Delay_type><ARPT>lax</ARPT><Reason><![CDATA[a < b]]></Reason></Delay_type></R>"
    jfk, lax = sorted(parse(spark, "disruption", {"xml": text}), key=lambda r: r.airport)
    assert (jfk.airport, jfk.delay_type, jfk.observed_at, jfk.avg_delay) == ("JFK", "Deep", 1785335434, None)
    assert jfk.extra == "k=z é€; k1=x; p_q_x & y_r_s_t_u=007"
    assert (lax.airport, lax.delay_type, lax.reason, lax.extra) == ("LAX", "", "a < b", None)


def test_long_status_page_costs_no_more_a_programme(spark):
    """A page of many programmes: work grows with its text, not with programmes times texts."""
    one = "<Stop><ARPT>k{0}</ARPT><Reason>{0} &amp; more</Reason><k>1</k><k>{0}</k><Q no='a&lt;'>v</Q><Avg> </Avg></Stop>"
    text = "<R><Update_Time>Wed Jul 29 14:30:34 2026 GMT</Update_Time><Delay_type><L>" + "".join(one.format(i) for i in range(6000)) + "</L><Name>N</Name></Delay_type></R>"
    began = time.monotonic()
    rows = parse(spark, "disruption", {"xml": text})
    assert time.monotonic() - began < 30
    assert [(r.airport, r.delay_type, r.reason, r.avg_delay, r.extra) for r in rows] == [(f"K{i}", "N", f"{i} & more", None, f"k={i}; q_a<=v") for i in range(6000)]


def test_programmes_within_programmes(spark):
    inner = "<In><Reason>i</Reason><ARPT>b</ARPT></In>"
    text = f"<R><Update_Time>x</Update_Time><Delay_type><Name>old</Name><Out>loose<ARPT>a</ARPT>{inner}<ARPT>c</ARPT></Out><Name>new</Name></Delay_type></R>"
    out, within = parse(spark, "disruption", {"xml": text})
    assert (out.airport, out.delay_type, out.reason, out.extra) == ("C", "new", None, "in_arpt=b; in_reason=i")
    assert (within.airport, within.reason, within.extra) == ("B", "i", None)


def test_reference_pages(spark):
    page = "'registration','icao24','x','operator'\r\n'N1','ABC','','O''Neil, ''the\nsecond'''\n,DEF,,\n'','GHI'\n"
    data = spark.createDataFrame([("p", 1, page), ("q", 2, "'icao24'\n"), ("r", 3, "")], "page_id string, captured_at bigint, payload string")
    (row,) = PARSERS["registry"].parse(data).collect()
    assert (row.icao24, row.registration, row.operator, row.owner, row._page_id) == ("abc", "N1", "O'Neil, 'the\nsecond", None, "p")
    bare = 'id,ident,type,name,latitude_deg\n1,KX,small_airport,"A ""b"", c",12.5\n2,KY,heliport,y,1\n'
    (row,) = PARSERS["airports"].parse(spark.createDataFrame([("p", 1, bare)], "page_id string, captured_at bigint, payload string")).collect()
    assert (row.ident, row.name, row.latitude, row.icao) == ("KX", 'A "b", c', 12.5, None)


def test_torn_xml_gives_no_rows(spark):
    assert parse(spark, "disruption", {"xml": XML[:200]}) == []
    assert parse(spark, "disruption", {"xml": "nothing"}) == []


def test_notam(spark):
    item = lambda notam, tr=None: {"properties": {"coreNOTAMData": {"notam": notam, "notamTranslation": tr}}}
    a, b = parse(spark, "notam", {"_location": "KJFK", "items": [
        item({"number": "1/1", "icaoLocation": "KEWR"}, [{}, {"simpleText": "hi"}]), item({}), {"properties": None},
        item({"id": 77, "number": "2"}, [{"formattedText": "F", "simpleText": "S"}])]})
    assert (a.notam_id, a.location, a.icao_location, a.formatted_text) == ("1/1", "KJFK", "KEWR", "hi")
    assert (b.notam_id, b.formatted_text) == ("77", "F")


def test_notices_are_read_once(spark):
    """Every field of a notice comes from one struct, not from a path of its own."""
    item = lambda notam, tr=None: {"properties": {"coreNOTAMData": {"notam": notam, "notamTranslation": tr}}}
    pages = spark.createDataFrame([("p", 1, json.dumps({"_location": "L", "items": [
        item({"id": "", "number": 7, "text": {"b": [1]}, "type": None, "issued": 1.5}, {"simpleText": "no list"}),
        item("N1"), item(["N2"]), item({"id": "x", "location": "", "minimumFL": True}, [{}, 3, {"formattedText": "", "simpleText": "s"}]),
    ]}))], "page_id string, captured_at bigint, payload string")
    rows = PARSERS["notam"].parse(pages)
    a, b = rows.collect()
    assert (a.notam_id, a.number, a.text, a.type, a.issued, a.location, a.formatted_text, a._ordinal) == ("7", "7", '{"b":[1]}', None, "1.5", "L", None, 0)
    assert (b.notam_id, b.number, b.location, b.minimum_fl, b.formatted_text, b._ordinal) == ("x", None, "L", "true", "s", 3)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("coreNOTAMData.notam,") <= 3


def test_fuel(spark):
    a, b = parse(spark, "fuel", {"response": {"data": [
        {"period": "2026-01-01", "series": "S", "value": "2.5", "product-name": "Jet"}, {"series": "S"}, {"period": "2026-01-02", "duoarea": "NYH", "value": "n/a"}]}})
    assert (a.series, a.price, a.product_name) == ("S", 2.5, "Jet")
    assert (b.series, b.area, b.price) == ("NYH", "NYH", None)
    assert parse(spark, "fuel", {"response": {"data": []}}) == []


def test_launches(spark):
    payload = {"results": [
        {"id": "a", "net": "n", "status": {"name": "Go", "abbrev": "G"}, "mission": {"name": "M", "type": "T", "orbit": {"name": "LEO"}},
         "rocket": {"configuration": {"name": "F9"}}, "program": [{"name": "A"}, {"name": "B"}, "x"],
         "pad": {"latitude": "28.5", "location": {"name": "Cape"}}, "webcast_live": True, "holdreason": "", "updates": [{"id": 1, "comment": "c"}, {}]},
        {"id": "b", "status": "Hold", "mission": "x", "rocket": {}, "program": []},
    ]}
    a, b = parse(spark, "launches", payload)
    assert (a.status, a.status_abbrev, a.orbit, a.vehicle, a.program, a.pad_latitude, a.pad_location, a.hold_reason) == ("Go", "G", "LEO", "F9", "A, B", 28.5, "Cape", None)
    assert (b.status, b.status_abbrev, b.mission_type, b.orbit, b.vehicle, b.program, b.webcast_live) == ("Hold", "Hold", "x", None, None, None, False)
    assert [u.update_id for u in parse(spark, "launch_updates", payload)] == ["a-1", "a-None"]


def test_orbital_and_kp(spark):
    a, b = parse(spark, "orbital", {"_group": "g", "objects": [{"NORAD_CAT_ID": 1, "OBJECT_ID": "2026-045BK", "MEAN_MOTION": 15.5}, {"OBJECT_ID": "UNKNOWN", "MEAN_MOTION": 0}]})
    assert (a.launch_designator, a.launch_year, a.period_minutes, a.group) == ("2026-045", 2026, 92.903, "g")
    assert (b.launch_designator, b.launch_year, b.period_minutes) == (None, None, None)
    c, d = parse(spark, "spaceweather", {"kp": [{"time_tag": "2026-07-29T08:39:00", "estimated_kp": 5}, {"time_tag": "later", "estimated_kp": None}]})
    assert (c.observed_at, c.storm, d.observed_at, d.storm) == (1785314340, True, None, False)


def test_reference_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        '"id","ident","type","name","latitude_deg","longitude_deg","elevation_ft","continent","iso_country","iso_region","municipality","scheduled_service","icao_code","iata_code"\n'
        '1,"EGLL","large_airport","London, ""Heathrow""",51.47,-0.46,83.0,"EU","GB","GB-ENG","London","yes","EGLL",""\n2,"H1","heliport","Pad",1,2,,"EU","GB","","","no","",""\n'
    )
    (row,) = reference.parse_airports(reference.read_double_quoted(spark, str(tmp_path / "a.csv"))).collect()
    assert (row.ident, row.name, row.elevation_ft, row.iata, row.scheduled_service) == ("EGLL", 'London, "Heathrow"', 83, None, True)

    columns = ["icao24", *reference.REGISTRY_COLUMNS]
    lines = [",".join(f"'{c}'" for c in columns)]
    lines += ["A1,N1,'','M \"x\"','Line one\nline two','','OPR','','',Private,'','','',''", "'',N2" + ",''" * 12, "0002" + ",''" * 13]
    (tmp_path / "r.csv").write_text("\n".join(lines) + "\n")
    raw = reference.read_single_quoted(spark, str(tmp_path / "r.csv"))
    (row,) = reference.parse_registry(raw).collect()
    assert (row.icao24, row.registration, row.model, row.manufacturer, row.operator, row.operator_icao) == ("a1", "N1", 'M "x"', "Line one\nline two", None, "OPR")
    assert sorted(r.icao24 for r in reference.parse_registry(raw, identified_only=False).collect()) == ["0002", "a1"]


@pytest.mark.parametrize("q", ['"', "'"])
def test_csv_lines_split_over_tasks_match_python_csv(spark, tmp_path, q):
    """Quoted line breaks, bare quotes, doubled quotes and blank lines, one file cut into many splits."""
    import csv
    import io
    import random

    rng = random.Random(5)
    lines = ["id,owner,note"]
    for i in range(600):
        owner = rng.choice([f"O{q}Neill Air", f"D{q}Arcy", "plain", "", f"{q}multi\nline\n\nowner{q}", f"{q}It{q}{q}s, here{q}"])
        lines.append(f"{i},{owner},{rng.choice(['x', f'{q}a{q}{q}' + chr(10) + f'b{q}', '', q + q, f'bare{q}q'])}")
        if rng.random() < 0.2:
            lines.append("")
    text = "\n".join(lines) + "\n"
    (tmp_path / "f.csv").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = reference.read_csv_lines(spark, str(tmp_path / "f.csv"), q, ("id", "owner", "note", "missing"))
        assert spark.read.text(str(tmp_path / "f.csv")).rdd.getNumPartitions() > 3
        got = sorted((tuple(r) for r in df.collect()), key=lambda r: int(r[0]))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [tuple(v or None for v in (r["id"], r["owner"], r["note"], None)) for r in csv.DictReader(io.StringIO(text), quotechar=q)]
    assert got == want and len(got) == 600
