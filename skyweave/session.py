"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. Cluster sizing (cores, memory, the number of shuffle
# partitions) is left to whoever submits the job; AQE coalesces and splits partitions at run time.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small shuffles often feed costly parsing, so they keep more partitions than their bytes call for.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "skyweave", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; ``master`` and extra settings are only needed for local runs and tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach, below ``spark.checkpoint.dir``.

    A machine-local folder is used only when the setting is absent and the master is local, which
    is the situation in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="skyweave-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


# Folders that this driver has staged rows in and that are still there.
_STAGES: list[str] = []


def clear_stages(spark: SparkSession) -> int:
    """Delete everything :func:`stage` has written in this driver; returns how many folders that were.

    To be called once the results that rest on staged rows are written, at the end of a job. What a driver
    leaves behind when it dies is up to the shared folder's retention.
    """
    count = len(_STAGES)
    while _STAGES:
        delete(spark, _STAGES.pop())
    return count


# How files of long texts are written, such as pages. A reader takes thousands of rows of a row group into memory at a
# time, however long they are, so a row group holds few of them.
LONG_ROWS = {"parquet.block.row.count.limit": "32"}


def _write_stage(spark: SparkSession, rows: DataFrame, options: Mapping[str, str] = {}) -> tuple[str, DataFrame]:
    path = shared_folder(spark, "stage")
    rows.write.option("compression", "zstd").options(**options).parquet(path)
    return path, spark.read.schema(rows.schema).parquet(path)


def stage(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Write rows once to the shared folder and read them back.

    For results that are read more than once and are much smaller than what they were computed from.
    Their lineage ends there, so a lost executor costs no recomputation. The files stay, as the
    result may be read at any later time, until :func:`clear_stages` deletes them.
    """
    path, df = _write_stage(spark, rows)
    _STAGES.append(path)
    return df


@contextmanager
def staged(spark: SparkSession, rows: DataFrame, options: Mapping[str, str] = {}) -> Iterator[DataFrame]:
    """Like :func:`stage` for use within a block; the files are deleted when the block ends."""
    path, df = _write_stage(spark, rows, options)
    try:
        yield df
    finally:
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
