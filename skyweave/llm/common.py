"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyweave.session import stage

# White space of the word rule, and the characters that are not.
WORD = r"[^\x20\x09-\x0D]+"
# Python workers get texts in batches of at most so many rows; Spark also bounds a batch's bytes.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python workers in batches that fit a worker's memory even when texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def text_key(text: Column) -> Column:
    """Equal for equal texts only; null texts share a key of their own."""
    return F.coalesce(F.sha2(text.cast("binary"), 256), F.lit("null"))


def id_share(doc_id: Column, parts: int) -> Column:
    """crc32 of an id written as text, modulo ``parts``; null ids fall in no part."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def numbered(spark: SparkSession, rows: DataFrame, *order: Column, name: str = "nth") -> DataFrame:
    """Number rows from 0 in a total order without gathering them in one task.

    Rows are dealt out by range, numbered within a range, and shifted by the sizes of the ranges before.
    """
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(spark, rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_k", within).join(starts, "_range").withColumn(name, F.col("_start") + F.col("_k") - 1).drop("_range", "_k", "_start")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
