"""Layered storage: an append-only archive of raw payloads and merge-on-key Parquet tables.

    <root>/bronze/source=<s>/dt=<day>/hh=<hour>/...    payloads as received
    <root>/silver|gold/<table>/<partition>/...         typed rows, unique by key
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.operators.latest import keep_last
from skyweave.schemas import TABLES, Table
from skyweave.session import LONG_ROWS, delete, staged

BRONZE_SCHEMA = (
    "page_id string, captured_at bigint, payload string, sha256 string, source string, dt string, hh string"
)
# Where a parsed row came from; the order of these is the order of arrival. Merged tables store them, so a
# row that arrived earlier never replaces a later one, whenever it is merged.
ARRIVAL = {"_captured_at": "bigint", "_page_id": "string", "_ordinal": "bigint"}


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


# ---- bronze -------------------------------------------------------------------------------------


def archive(payloads: DataFrame, root: str, is_staged: bool = False) -> None:
    """Append payloads (``source, page_id, captured_at`` in epoch ms, ``payload``) to the archive.

    The payload text is kept as received and never rewritten. A page that the archive already holds, with
    the same hour of capture and the same hash, is not written again. JSON payloads can be read in canonical
    form with :func:`canonical_json`.

    Payloads are read several times; those that are not ``is_staged`` already are written once first. Only the
    pages' keys are grouped; texts move just once, to the partition they are written to, and those that come
    again once more.
    """
    spark = payloads.sparkSession
    if not is_staged:
        with staged(spark, with_hash(payloads), LONG_ROWS) as pages:
            archive(pages, root, is_staged=True)
        return
    page = ["source", "dt", "hh", "page_id", "sha256"]
    rows = bronze_rows(payloads)
    keys = rows.select(*page, F.lit(1).alias("_new"))
    if exists(spark, f"{root}/bronze"):
        stored = spark.read.schema(BRONZE_SCHEMA).parquet(f"{root}/bronze")
        stored = in_partitions(stored, rows.select("source", "dt", "hh").distinct(), ["source", "dt", "hh"])
        keys = keys.unionAll(stored.select(*page, F.lit(0).alias("_new")))
    copies = keys.groupBy(*page).agg(F.sum("_new").alias("_copies"), F.bool_or(F.col("_new") == 0).alias("_held"))
    with staged(spark, copies.where("_copies > 0")) as seen:
        if not seen.isEmpty() and seen.where("NOT _held").isEmpty():
            return
        some = lambda which: seen.where(which).select(*[F.col(c).alias(f"_{c}") for c in page])
        named = lambda df, which, how: df.join(some(which), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in page], how)
        new, again = named(rows, "_held OR _copies > 1", "left_anti"), "NOT _held AND _copies > 1"
        if not seen.where(again).isEmpty():
            new = new.unionByName(named(rows, again, "left_semi").dropDuplicates(page))
        new.hint("rebalance", "source", "dt", "hh").write.mode("append").options(
            compression="zstd", **LONG_ROWS
        ).partitionBy("source", "dt", "hh").parquet(f"{root}/bronze")


def with_hash(payloads: DataFrame) -> DataFrame:
    return payloads.select("source", "page_id", "captured_at", "payload", F.sha2("payload", 256).alias("sha256"))


def bronze_rows(payloads: DataFrame) -> DataFrame:
    at = F.timestamp_millis("captured_at")
    return payloads.select(
        "page_id",
        "captured_at",
        "payload",
        F.col("sha256") if "sha256" in payloads.columns else F.sha2("payload", 256).alias("sha256"),
        "source",
        F.date_format(at, "yyyy-MM-dd").alias("dt"),
        F.date_format(at, "HH").alias("hh"),
    )


def canonical_json(payload: Column) -> Column:
    """JSON text with sorted keys and no spare blanks; null for text that is not JSON."""
    return F.to_json(F.try_parse_json(payload))


def scan_bronze(
    spark: SparkSession, root: str, source: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Archived payloads of one source; ``since`` and ``until`` are dates that prune partitions.

    The result is not sorted: ``captured_at`` and ``page_id`` carry the order, and merging uses them.
    """
    path = f"{root}/bronze"
    if not exists(spark, path):
        return spark.createDataFrame([], BRONZE_SCHEMA)
    pages = spark.read.schema(BRONZE_SCHEMA).parquet(path).where(F.col("source") == source)
    if since:
        pages = pages.where(F.col("dt") >= since)
    if until:
        pages = pages.where(F.col("dt") <= until)
    return pages


def readable(pages: DataFrame) -> DataFrame:
    """Pages whose payload is JSON; parse jobs skip the others, :func:`unreadable` lists them."""
    return pages.where(F.try_parse_json("payload").isNotNull())


def unreadable(pages: DataFrame) -> DataFrame:
    return pages.where(F.try_parse_json("payload").isNull())


# ---- silver and gold ----------------------------------------------------------------------------


def table_path(root: str, name: str) -> str:
    return f"{root}/{TABLES[name].layer}/{name}"


def read_table(spark: SparkSession, root: str, name: str, arrival: bool = False) -> DataFrame:
    """All rows with the declared columns plus the partition columns; a missing table is empty.

    ``arrival`` adds the columns that say when a row arrived.
    """
    table = TABLES[name]
    where = [f"{c} {t}" for c, t in ARRIVAL.items()] if arrival else []
    where += [f"{c} {table.partition_types[c]}" for c in table.partition_columns]
    schema = T.StructType.fromDDL(", ".join([table.ddl, *where]))
    path = table_path(root, name)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def conform(rows: DataFrame, table: Table) -> DataFrame:
    """Cast to the declared columns (absent ones become null), add arrival and partition columns.

    Rows that do not say when they arrived count as arrived now.
    """
    have = set(rows.columns)
    typed = [
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in table.schema.fields
    ]
    extra = [(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in ARRIVAL.items()]
    if "_captured_at" not in have:
        extra[0] = F.lit(int(time.time() * 1000)).cast("bigint").alias("_captured_at")
    shaped = rows.select(*typed, *extra)
    required = [k for k in table.keys if k not in table.nullable_keys]
    return shaped.dropna(subset=required).withColumns(table.partition_values())


def in_partitions(df: DataFrame, touched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``df`` in the partitions that ``touched`` (distinct partition values) names.

    The least and greatest value of each column become literal bounds, which prune the scan while
    planning; a semi join that also matches nulls then picks the partitions exactly.
    """
    ends = touched.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]).first()
    near = F.lit(True)
    for c in columns:
        if ends[f"low_{c}"] is not None:
            near = near & (F.col(c).between(ends[f"low_{c}"], ends[f"high_{c}"]) | F.col(c).isNull())
    named = touched.select(*[F.col(c).alias(f"_in_{c}") for c in columns])
    return df.where(near).join(named, [df[c].eqNullSafe(named[f"_in_{c}"]) for c in columns], "left_semi")


def merged(spark: SparkSession, root: str, name: str, new: DataFrame) -> DataFrame:
    """What the touched partitions hold after merging conformed rows: per key the row that arrived last.

    Of rows that arrived together the new one counts as later.
    """
    table = TABLES[name]
    both = new.withColumn("_new", F.lit(1))
    if exists(spark, table_path(root, name)):
        touched = new.select(*table.partition_columns).distinct()
        old = in_partitions(read_table(spark, root, name, arrival=True), touched, table.partition_columns)
        both = both.unionByName(old.withColumn("_new", F.lit(0)))
    return keep_last(both, table.keys, [*ARRIVAL, "_new"], table.nullable_keys).drop("_new")


def write_partitions(df: DataFrame, root: str, name: str) -> None:
    """Replace exactly the partitions that ``df`` has rows for.

    The rebalance hint lets AQE split large partitions over several files and pack small ones.
    """
    table = TABLES[name]
    (
        df.hint("rebalance", *table.partition_columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*table.partition_columns)
        .parquet(table_path(root, name))
    )


def upsert(spark: SparkSession, root: str, name: str, rows: DataFrame, is_staged: bool = False) -> None:
    """Merge rows into a table; running it again changes nothing, and no rows means no write.

    A merge reads its input several times; rows that are not ``is_staged`` already are written once first.
    The first rows of a table are merged before they get the columns they lack.
    """
    table = TABLES[name]
    new = conform(rows, table)
    if not exists(spark, table_path(root, name)):
        have = [c for c in new.columns if c in rows.columns or c in table.keys or c in ARRIVAL]
        first = keep_last(new.select(*[f"`{c}`" for c in have]), table.keys, list(ARRIVAL), table.nullable_keys)
        write_partitions(conform(first, table), root, name)
        return
    if is_staged:
        write_partitions(merged(spark, root, name, new), root, name)
        return
    with staged(spark, new) as parsed:
        write_partitions(merged(spark, root, name, parsed), root, name)


def replace_rows(
    spark: SparkSession, root: str, name: str, rows: DataFrame, scope: DataFrame, on: Sequence[str]
) -> None:
    """Make ``rows`` the only stored rows for the ``on`` values that occur in ``scope``.

    For derived tables, where a recomputation may also take rows back: a late fix can join two legs.
    Only partitions in which something really changes are rewritten.
    """
    table = TABLES[name]
    parts = table.partition_columns
    fresh = conform(rows, table).drop(*ARRIVAL)
    if not exists(spark, table_path(root, name)):
        write_partitions(fresh, root, name)
        return
    with staged(spark, fresh) as new:
        values = scope.select(*on).distinct()
        stored = read_table(spark, root, name).select(*new.columns)
        scoped = stored.join(values, list(on), "left_semi").select(*new.columns)
        changes = new.exceptAll(scoped).select(*parts).unionByName(scoped.exceptAll(new).select(*parts))
        with staged(spark, changes.distinct()) as touched:
            others = in_partitions(stored, touched, parts).join(values, list(on), "left_anti").select(*new.columns)
            with staged(spark, others.unionByName(in_partitions(new, touched, parts))) as result:
                write_partitions(result, root, name)
                drop_other_partitions(spark, root, name, touched, result)


def replace_table(spark: SparkSession, root: str, name: str, rows: DataFrame) -> None:
    """Make ``rows`` the whole table; partitions without rows go after the others are written."""
    parts = TABLES[name].partition_columns
    with staged(spark, conform(rows, TABLES[name]).drop(*ARRIVAL)) as whole:  # may derive from the table itself
        write_partitions(whole, root, name)
        drop_other_partitions(spark, root, name, read_table(spark, root, name).select(*parts).distinct(), whole)


def drop_other_partitions(spark: SparkSession, root: str, name: str, some: DataFrame, kept: DataFrame) -> None:
    """Delete the partitions of ``some`` that ``kept`` has no rows for: a dynamic overwrite leaves those alone.

    A failure before this step leaves withdrawn rows visible until the job runs again.
    """
    parts = TABLES[name].partition_columns
    gone = some.select(*parts).join(kept.select(*parts).distinct(), parts, "left_anti")
    for row in gone.toLocalIterator():  # partition names only, one piece at a time
        drop_partition(spark, root, name, row.asDict())


def drop_partition(spark: SparkSession, root: str, name: str, values: dict[str, object]) -> None:
    below = "/".join(f"{c}={values[c]}" for c in TABLES[name].partition_columns)
    delete(spark, f"{table_path(root, name)}/{below}")


def attach_views(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """A temporary view per table that holds rows; returns the DataFrames by name."""
    views = {}
    for name in (n for n, t in TABLES.items() if t.layer != "work"):
        df = read_table(spark, root, name)
        if df.isEmpty():
            continue
        df.createOrReplaceTempView(name)
        views[name] = df
    return views
