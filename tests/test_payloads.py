"""Payload pages of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyweave.bindings import payloads
from skyweave.sources import reference


def test_csv_pages_grow_in_number(spark):
    """More rows make more pages, none with more than ``PAGE`` records, and no row is lost."""
    rows = spark.range(1, 40 * payloads.PAGE).selectExpr("CAST(id AS STRING) AS id", "concat('a \"quoted\", ', id) AS name")
    pages = payloads.csv_pages(rows, "id", '"').persist()
    lines = pages.select(F.regexp_count("payload", F.lit("\n")).alias("n")).collect()
    assert len(lines) == 40 and max(r["n"] for r in lines) <= payloads.PAGE
    assert pages.select("page_id").distinct().count() == 40
    back = reference.csv_items(pages, ("id", "name"), '"').select("id", "name")
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_csv_pages_keep_quotes_inside_bare_fields(spark):
    """A quote opens a quoted field only at a field's start: the rows of Python's csv, for both dialects."""
    import csv
    import io

    for q in ('"', "'"):
        text = (
            f"id,owner,note\n1,O{q}Neill Air,plain\n2,D{q}Arcy,{q}quoted, with comma{q}\n\n3,{q}It{q}{q}s{q},{q}two\nlines{q}\n"
            f"4,{q}{'x' * 20000}{q},bare{q}end\n5,,{q}{q}\n6,{q}a{q}{q}{q},x\n"
        )
        pages = spark.createDataFrame([(1, "p1", text)], "captured_at long, page_id string, payload string")
        got = [tuple(r) for r in reference.csv_items(pages, ("id", "owner", "note"), q).select("id", "owner", "note").collect()]
        want = [tuple(v or None for v in (r["id"], r["owner"], r["note"])) for r in csv.DictReader(io.StringIO(text), quotechar=q)]
        assert got == want and len(got) == 6
