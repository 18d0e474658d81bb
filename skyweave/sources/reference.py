"""Reference files: airports, runways and the aircraft registry (CSV)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyweave.functions import normalise as N
from skyweave.sources.pages import ORIGIN

OPERATIONAL_KINDS = ("large_airport", "medium_airport", "small_airport")  # fixed values


def _cells(text: Column, q: str) -> Column:
    """Fields of one record, unquoted, empty ones null; a quote opens a quoted field only at its start."""
    quoted = f"{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}"
    field = f",({quoted}[^,]*+|[^,{q}][^,]*+|)"
    inside = lambda f, part: F.regexp_extract(f, f"^{q}([^{q}]*+(?:{q}{q}[^{q}]*+)*+){q}(.*)$", part)
    unquoted = lambda f: F.concat(F.replace(inside(f, 1), F.lit(q * 2), F.lit(q)), inside(f, 2))
    bare = lambda f: F.when(f.startswith(q), unquoted(f)).otherwise(f)
    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(field), 1), lambda f: N.blank_to_null(bare(f)))


def csv_items(pages: DataFrame, columns: Sequence[str], quote: str) -> DataFrame:
    """One row per CSV record of archived pages, with ``columns`` by name as text and where it came from.

    A page is CSV text with a header line; quotes are doubled inside quoted fields, which may hold line
    breaks. A quote opens a quoted field only at the field's start, as in Python's ``csv``: a bare field
    such as ``O'Neill`` keeps its quote as a letter. Blank lines hold no record. Columns that the header
    lacks are null, and so are empty fields.
    """
    q = quote
    quoted = f"{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}"
    record = f"(?:{quoted}[^,{q}\\r\\n]*+|[^,{q}\\r\\n][^,\\r\\n]*+|)(?:,(?:{quoted}[^,{q}\\r\\n]*+|[^,{q}\\r\\n][^,\\r\\n]*+|))*+"
    field = f",({quoted}[^,]*+|[^,{q}][^,]*+|)"

    cells = lambda text: _cells(text, q)

    cut = pages.select(
        F.col("captured_at").alias("_captured_at"), F.col("page_id").alias("_page_id"),
        F.filter(F.regexp_extract_all("payload", F.lit(record), 0), lambda r: r != "").alias("records"),
    ).where(F.size("records") > 1)
    rows = cut.select(
        "_captured_at", "_page_id", cells(F.col("records")[0]).alias("header"),
        F.posexplode(F.slice("records", 2, F.size("records"))).alias("_ordinal", "record"),
    ).withColumn("fields", cells(F.col("record")))
    named = lambda c: F.get("fields", (F.array_position("header", F.lit(c)) - 1).cast("int"))
    return rows.select("_captured_at", "_page_id", F.col("_ordinal").cast("bigint").alias("_ordinal"), *[named(c).alias(c) for c in columns])


def _origin(raw: DataFrame) -> list[str]:
    return [c for c in ORIGIN if c in raw.columns]


def _field_patterns(q: str) -> tuple[str, str]:
    """A field that starts outside quotes, and the rest of a quoted field that a line starts inside."""
    quoted = f"{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}"
    return f"(?:{quoted}[^,]*+|[^,{q}][^,]*+|)", f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}[^,]*+"


def read_csv_lines(spark: SparkSession, path: str, quote: str, columns: Sequence[str]) -> DataFrame:
    """CSV files with a header, ``columns`` by name as text, read line by line so that one large file is
    split over many tasks, although quoted fields may hold line breaks (no ``multiLine``).

    Each line is a function from the state at its start (outside or inside a quoted field) to the state at
    its end: the identity, a swap, or a constant; two patterns tell which. The state at a line's start is
    the last constant before it, flipped by every swap since (outside at a file's start). That prefix is
    taken in two levels: in read order within each split of a file, and over the summaries of the file's
    splits before it (a row per split). A record starts at each non-blank line that starts outside; lines
    of records that span lines are gathered by record number, the others stay in place. Fields follow
    Python's ``csv`` (a quote opens a quoted field only at a field's start); a line break inside a quoted
    field reads as ``\\n``. Columns the header lacks are null, and so are empty fields.
    """
    q = quote
    field, rest = _field_patterns(q)
    line = F.col("value")
    out_out = line.rlike(f"^{field}(?:,{field})*+$")  # a line that starts outside ends outside
    in_out = line.rlike(f"^{rest}(?:,{field})*+$")  # a line that starts inside ends outside
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_pos"), "value",
    )
    # 0 identity, 1 swap, 2 always ends outside, 3 always ends inside
    lines = raw.withColumn("_kind", F.when(out_out & ~in_out, 0).when(~out_out & in_out, 1).when(out_out, 2).otherwise(3))
    split = Window.partitionBy("_file", "_split").orderBy("_pos")
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col("_kind") == 1).cast("int")
    lines = lines.withColumn("_swaps", F.coalesce(F.sum(swap).over(before), F.lit(0)))
    constant = F.when(F.col("_kind") >= 2, F.struct((F.col("_kind") == 3).alias("inside"), F.col("_swaps").alias("swaps")))
    lines = lines.withColumn("_const", F.last(constant, ignorenulls=True).over(before))
    # per split: the state it leaves, given the state it starts in
    splits = lines.groupBy("_file", "_split").agg(
        F.max_by(constant, F.when(F.col("_kind") >= 2, F.col("_pos"))).alias("_last"), F.sum(swap).alias("_total"),
    )
    leaves = F.when(F.col("_last").isNotNull(), F.col("_last.inside") != ((F.col("_total") - F.col("_last.swaps")) % 2 == 1))
    splits = splits.select("_file", "_split", leaves.alias("_leaves"), (F.col("_total") % 2 == 1).alias("_flips"))
    files = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    flips = F.col("_flips").cast("int")
    splits = splits.withColumn("_cum", F.coalesce(F.sum(flips).over(files), F.lit(0)))
    fixed = F.when(F.col("_leaves").isNotNull(), F.struct(F.col("_leaves").alias("state"), (F.col("_cum") + flips).alias("cum")))
    splits = splits.withColumn("_fix", F.last(fixed, ignorenulls=True).over(files))
    enters = F.when(F.col("_fix").isNotNull(), F.col("_fix.state") != ((F.col("_cum") - F.col("_fix.cum")) % 2 == 1)).otherwise(F.col("_cum") % 2 == 1)
    entry = splits.select("_file", "_split", enters.alias("_enters"))
    lines = lines.join(entry, ["_file", "_split"])  # a row per split
    starts_in = F.when(F.col("_const").isNotNull(), F.col("_const.inside") != ((F.col("_swaps") - F.col("_const.swaps")) % 2 == 1)).otherwise(
        F.col("_enters") != (F.col("_swaps") % 2 == 1)
    )
    lines = lines.withColumn("_in", starts_in)
    ends_in = F.when(F.col("_kind") == 0, F.col("_in")).when(F.col("_kind") == 1, ~F.col("_in")).otherwise(F.col("_kind") == 3)
    lines = lines.withColumn("_end_in", ends_in).where(F.col("_in") | (F.col("value") != ""))
    starts = (~F.col("_in")).cast("int")
    lines = lines.withColumn("_rec_in_split", F.sum(starts).over(split.rowsBetween(Window.unboundedPreceding, 0)))
    counts = lines.groupBy("_file", "_split").agg(F.sum(starts).alias("_n"))
    offsets = counts.select("_file", "_split", F.coalesce(F.sum("_n").over(files), F.lit(0)).alias("_offset"))
    lines = lines.join(offsets, ["_file", "_split"]).withColumn("_rec", F.col("_offset") + F.col("_rec_in_split") - 1)
    single = lines.where(~F.col("_in") & ~F.col("_end_in")).select("_file", "_rec", F.col("value").alias("_record"))
    spanning = lines.where(F.col("_in") | F.col("_end_in")).groupBy("_file", "_rec").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "value"))), lambda x: x["value"]), "\n").alias("_record")
    )
    records = single.unionByName(spanning).withColumn("fields", _cells(F.col("_record"), q))
    header = records.where(F.col("_rec") == 0).select("_file", F.col("fields").alias("header"))
    rows = records.where(F.col("_rec") > 0).join(header, "_file")
    named = lambda c: F.get("fields", (F.array_position("header", F.lit(c)) - 1).cast("int"))
    return rows.select(*[named(c).alias(c) for c in columns])


def read_double_quoted(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, double quotes doubled inside quoted fields, every column as text."""
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True, mode="PERMISSIVE")


def read_single_quoted(spark: SparkSession, path: str) -> DataFrame:
    """The registry's dialect: single quotes around names and fields, every column as text.

    Free-text fields may hold line breaks, so a file is read by one task; a snapshot comes as one
    file, and a history of snapshots is read in parallel.
    """
    return spark.read.csv(path, header=True, quote="'", escape="'", multiLine=True, mode="PERMISSIVE")


def parse_airports(raw: DataFrame, operational_only: bool = True) -> DataFrame:
    rows = raw.where(F.col("type").isin(*OPERATIONAL_KINDS)) if operational_only else raw
    some = lambda c: N.blank_to_null(F.col(c))
    return rows.select(
        *_origin(raw),
        "ident",
        some("icao_code").alias("icao"),
        some("iata_code").alias("iata"),
        "name",
        F.col("type").alias("kind"),
        N.text_to_real(F.col("latitude_deg")).alias("latitude"),
        N.text_to_real(F.col("longitude_deg")).alias("longitude"),
        N.text_to_whole(F.col("elevation_ft")).alias("elevation_ft"),
        some("continent").alias("continent"),
        some("iso_country").alias("iso_country"),
        some("iso_region").alias("iso_region"),
        some("municipality").alias("municipality"),
        N.flag_text(F.col("scheduled_service"), "yes").alias("scheduled_service"),
    )


def parse_runways(raw: DataFrame) -> DataFrame:
    some = lambda c: N.blank_to_null(F.col(c))
    ends = []
    for end in ("le", "he"):
        ends += [
            some(f"{end}_ident").alias(f"{end}_ident"),
            N.text_to_real(F.col(f"{end}_latitude_deg")).alias(f"{end}_latitude"),
            N.text_to_real(F.col(f"{end}_longitude_deg")).alias(f"{end}_longitude"),
            N.text_to_real(F.col(f"{end}_heading_degT")).alias(f"{end}_heading_deg"),
        ]
    return raw.select(
        *_origin(raw),
        F.col("id").alias("runway_id"),
        "airport_ident",
        N.text_to_whole(F.col("length_ft")).alias("length_ft"),
        N.text_to_whole(F.col("width_ft")).alias("width_ft"),
        some("surface").alias("surface"),
        N.flag_text(F.col("lighted"), "1").alias("lighted"),
        N.flag_text(F.col("closed"), "1").alias("closed"),
        *ends,
    )


# Column of the file, column of the table.
REGISTRY_COLUMNS = {
    "registration": "registration",
    "typecode": "aircraft_type",
    "model": "model",
    "manufacturerName": "manufacturer",
    "operator": "operator",
    "operatorIcao": "operator_icao",
    "operatorIata": "operator_iata",
    "operatorCallsign": "operator_callsign",
    "owner": "owner",
    "country": "country",
    "categoryDescription": "category",
    "built": "built",
    "serialNumber": "serial_number",
}


def parse_registry(raw: DataFrame, identified_only: bool = True) -> DataFrame:
    """Airframes; the operator's display name is never filled in from its code, nor the reverse."""
    rows = raw.select(
        *_origin(raw),
        F.lower(N.unquoted(F.col("icao24"))).alias("icao24"),
        *[N.unquoted(F.col(source)).alias(name) for source, name in REGISTRY_COLUMNS.items()],
    ).where(F.col("icao24").isNotNull())
    if identified_only:
        rows = rows.where(F.coalesce("registration", "aircraft_type", "operator").isNotNull())
    return rows


# The columns read from each file.
AIRPORT_FILE = (
    "ident", "icao_code", "iata_code", "name", "type", "latitude_deg", "longitude_deg", "elevation_ft", "continent",
    "iso_country", "iso_region", "municipality", "scheduled_service",
)
RUNWAY_FILE = (
    "id", "airport_ident", "length_ft", "width_ft", "surface", "lighted", "closed", "le_ident", "le_latitude_deg",
    "le_longitude_deg", "le_heading_degT", "he_ident", "he_latitude_deg", "he_longitude_deg", "he_heading_degT",
)


def parse_airport_pages(pages: DataFrame) -> DataFrame:
    return parse_airports(csv_items(pages, AIRPORT_FILE, '"'))


def parse_runway_pages(pages: DataFrame) -> DataFrame:
    return parse_runways(csv_items(pages, RUNWAY_FILE, '"'))


def parse_registry_pages(pages: DataFrame) -> DataFrame:
    return parse_registry(csv_items(pages, ("icao24", *REGISTRY_COLUMNS), "'"))
