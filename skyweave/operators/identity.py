"""The versioned (slowly changing, type 2) aircraft dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.functions.normalise import blank_to_null

IDENTITY_FIELDS = ["registration", "aircraft_type", "operator", "operator_icao"]
VERSION_COLUMNS = ["hex", *IDENTITY_FIELDS, "valid_from", "valid_to", "is_current", "first_seen", "last_seen"]


def observed_identity(
    positions: DataFrame, registry: DataFrame | None = None, arrival: Column | None = None
) -> DataFrame:
    """Per aircraft, the identity carried by its newest fix that carries any.

    Registration and type come from the fix, else from the registry; the operator only from the
    registry. Of fixes with equal time the first by ``arrival`` (a number) counts. The registry adds
    the same values to all fixes of an aircraft, so fixes are reduced to one row per aircraft before
    they meet it.
    """
    t = F.col("snapshot_time")
    newest_first = F.struct(t, -arrival) if arrival is not None else t
    fixes = positions.where((F.col("hex") != "") & t.isNotNull()).select(
        "hex",
        newest_first.alias("_rank"),
        F.struct(
            t.alias("seen_at"),
            blank_to_null(F.col("registration")).alias("registration"),
            blank_to_null(F.col("aircraft_type")).alias("aircraft_type"),
        ).alias("_fix"),
    )
    carries = F.col("_fix.registration").isNotNull() | F.col("_fix.aircraft_type").isNotNull()
    per_hex = fixes.groupBy("hex").agg(
        F.max_by("_fix", "_rank").alias("any_fix"),
        F.max_by("_fix", F.when(carries, F.col("_rank"))).alias("own_fix"),
    )
    if registry is None:
        extra = per_hex.withColumn("extra", F.lit(None).cast("struct<%s>" % ",".join(f"{f}:string" for f in IDENTITY_FIELDS)))
    else:
        known = registry.where(F.col("icao24") != "").select(
            F.col("icao24").alias("hex"),
            F.struct(*[blank_to_null(F.col(f).cast("string")).alias(f) for f in IDENTITY_FIELDS]).alias("extra"),
        )
        extra = per_hex.join(known, "hex", "left")
    identified = F.coalesce(*[F.col(f"extra.{f}") for f in IDENTITY_FIELDS]).isNotNull()
    chosen = extra.withColumn("fix", F.when(identified, F.col("any_fix")).otherwise(F.col("own_fix")))
    return chosen.where(F.col("fix").isNotNull()).select(
        "hex",
        F.coalesce("fix.registration", "extra.registration").alias("registration"),
        F.coalesce("fix.aircraft_type", "extra.aircraft_type").alias("aircraft_type"),
        F.col("extra.operator").alias("operator"),
        F.col("extra.operator_icao").alias("operator_icao"),
        F.col("fix.seen_at").alias("seen_at"),
    )


def aircraft_dimension(
    positions: DataFrame,
    existing: DataFrame | None = None,
    registry: DataFrame | None = None,
    arrival: Column | None = None,
) -> DataFrame:
    """All identity versions after merging one batch of positions into ``existing``.

    An unchanged identity extends the latest version; a changed one closes it and opens another. At
    most one version per aircraft is opened per call, which also bounds the window below.
    """
    seen = observed_identity(positions, registry, arrival)
    fresh = F.struct(
        F.col("seen.hex").alias("hex"),
        *[F.col(f"seen.{f}").alias(f) for f in IDENTITY_FIELDS],
        F.col("seen.seen_at").alias("valid_from"),
        F.lit(None).cast("bigint").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.col("seen.seen_at").alias("first_seen"),
        F.col("seen.seen_at").alias("last_seen"),
    )
    now = seen.select("hex", F.struct("*").alias("seen"))
    if existing is None:
        return now.select(fresh.alias("v")).select("v.*")

    newest = Window.partitionBy("hex").orderBy(F.coalesce("valid_from", F.lit(0)).desc())
    versions = existing.where(F.col("hex") != "").select(
        "hex",
        F.struct(*VERSION_COLUMNS).alias("old"),
        (F.row_number().over(newest) == 1).alias("is_latest"),
    )
    both = versions.join(now, "hex", "full_outer")
    unchanged = F.lit(True)
    for f in IDENTITY_FIELDS:
        unchanged = unchanged & F.col(f"old.{f}").eqNullSafe(F.col(f"seen.{f}"))
    extended = F.col("old").withField(
        "last_seen", F.greatest(F.coalesce("old.last_seen", F.lit(0)), F.col("seen.seen_at"))
    )
    closed = F.col("old").withField("valid_to", F.col("seen.seen_at")).withField("is_current", F.lit(False))
    result = (
        F.when(F.col("old").isNull(), F.array(fresh))
        .when(F.col("seen").isNull() | ~F.col("is_latest"), F.array(F.col("old")))
        .when(unchanged, F.array(extended))
        .otherwise(F.array(closed, fresh))
    )
    return both.select(F.explode(result).alias("v")).select(*[f"v.{c}" for c in VERSION_COLUMNS])
