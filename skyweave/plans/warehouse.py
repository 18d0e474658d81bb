"""The SQL surface: views over tables and marts, ad-hoc queries, gated publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave import lake
from skyweave.plans import marts, operations, quality
from skyweave.session import stage

DEFAULT_LIMIT = 25


def build(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """A view per populated table and per mart those tables allow."""
    tables = lake.attach_views(spark, root)
    created, skipped = marts.refresh(tables)
    return {"tables": sorted(tables), "marts": created, "skipped": skipped}


def adhoc(spark: SparkSession, text: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Any SQL over the views; marts are inlined and optimised with the query around them."""
    return spark.sql(text).limit(limit)


def check(spark: SparkSession, root: str, checked_at: int, store: bool = True) -> DataFrame:
    """Run every suite, empty tables included, and keep the outcomes."""
    parts = [quality.run_suite(lake.read_table(spark, root, name), name) for name in quality.SUITES]
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    results = results.withColumn("checked_at", F.lit(checked_at).cast("bigint"))
    if store:
        results = stage(spark, results)
        operations.append(results, root, "dq_result")
    return results


def publish(spark: SparkSession, root: str, checked_at: int, require_clean: bool = True) -> dict[str, list[str]]:
    """Write the marts; with ``require_clean`` not while a blocking check of a populated table fails."""
    populated = lake.attach_views(spark, root)
    failures = quality.blocking(check(spark, root, checked_at)).where(F.col("table").isin(*populated))
    if require_clean and not failures.isEmpty():
        names = [f"{r['table']}: {r['check']}" for r in failures.select("table", "check").limit(20).collect()]
        raise RuntimeError("blocking checks failed: " + "; ".join(names))
    created, skipped = marts.refresh(populated)
    for name in created:
        spark.table(name).write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/marts/{name}")
    return {"marts": created, "skipped": skipped}
