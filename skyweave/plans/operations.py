"""Operational tables: the load ledger, lineage, check results, and table statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave import lake
from skyweave.schemas import TABLES

LEDGER_DDL = (
    "run_id string, source string, layer string, target string, status string, feeds string, started_at bigint, "
    "pages bigint, rows_read bigint, rows_written bigint, bytes_raw bigint, error string"
)


def append(df: DataFrame, root: str, name: str) -> None:
    df.write.mode("append").option("compression", "zstd").parquet(f"{root}/ops/{name}")


def load_ledger(pages: DataFrame, rows: DataFrame, source: str, table: str, run_id: str, started: int) -> DataFrame:
    """One ledger row for a run: pages and bytes archived, rows parsed, rows that carry a whole key."""
    target = TABLES[table]
    whole = F.lit(True)
    for key in target.keys:
        if key not in target.nullable_keys:
            whole = whole & F.col(f"`{key}`").isNotNull()
    feeds = F.concat_ws(",", F.array_sort(F.collect_set("source"))) if "source" in rows.columns else F.lit(None)
    parsed = rows.agg(
        F.count(F.lit(1)).alias("rows_read"), F.count_if(whole).alias("rows_written"), feeds.alias("feeds")
    )
    read = pages.agg(F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("bytes_raw"))
    counts = read.withColumn("p", parsed.select(F.struct("*")).scalar())
    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.lit(source).alias("source"),
        F.lit(target.layer).alias("layer"),
        F.lit(table).alias("target"),
        F.lit("ok").alias("status"),
        F.col("p.feeds").cast("string").alias("feeds"),
        F.lit(started).cast("bigint").alias("started_at"),
        "pages",
        F.col("p.rows_read").alias("rows_read"),
        F.col("p.rows_written").alias("rows_written"),
        "bytes_raw",
        F.lit(None).cast("string").alias("error"),
    )


def failed_run(spark: SparkSession, run_id: str, source: str, table: str, started: int, error: str) -> DataFrame:
    row = (run_id, source, TABLES[table].layer, table, "error", None, started, 0, 0, 0, 0, error)
    return spark.createDataFrame([row], T.StructType.fromDDL(LEDGER_DDL))


def recent_runs(ledger: DataFrame, n: int = 10) -> DataFrame:
    return ledger.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n)


def lineage(rows: DataFrame, table: str) -> DataFrame:
    """Which archived page fed which partition, and with how many rows."""
    target = TABLES[table]
    placed = lake.conform(rows, target)
    partition = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in target.partition_columns])
    return (
        placed.groupBy(F.col("_page_id").alias("page_id"), partition.alias("partition"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("target", F.lit(table))
    )


def table_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, files and bytes per table, from the file metadata column of each scan."""
    parts = []
    for name, df in tables.items():
        per_file = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size")
        )
        parts.append(
            per_file.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.count(F.lit(1)).alias("file_count"),
                F.coalesce(F.sum("size"), F.lit(0)).alias("byte_count"),
            ).select(F.lit(name).alias("table_name"), "row_count", "file_count", "byte_count")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
