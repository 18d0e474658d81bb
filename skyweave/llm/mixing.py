"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyweave.llm.common import numbered, table, word_count
from skyweave.session import stage

ROUNDS = 80  # Newton steps at most; a bracket halves where a step leaves it, so far fewer are needed
TOLERANCE = 1e-7  # of a target
STEPS = 4096  # thresholds that rounding chooses from


def source_targets(spark: SparkSession, sizes: DataFrame, weights: tuple[float, ...], repeats: float) -> DataFrame:
    """Share all tokens among sources by weight, no source above ``repeats`` times what it has.

    ``sizes`` has source, key, source_size, n_docs. Sources in code point order (null last) take the
    weights in turn. Shares that would be too large stop at their bound, and the rest is shared again.
    """
    ranked = numbered(spark, sizes, F.col("source").isNull(), F.col("source"), name="place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = stage(spark, ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(repeats)))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:  # each round stops at least one more source, or ends
        share = F.col("weight") * F.lit(level)
        stopped = F.col("most") <= share
        now = ranked.agg(
            F.sum(F.when(stopped, F.col("most")).otherwise(0.0)).alias("held"),
            F.sum(F.when(~stopped, F.col("weight")).otherwise(0.0)).alias("free"),
            F.sum(F.when(stopped, 1).otherwise(0)).alias("n"),
        ).first()
        if not now["free"] or now["n"] == full:
            break
        level, full = (total - now["held"]) / now["free"], now["n"]
    return ranked.withColumn("target", F.least(F.col("most"), F.col("weight") * F.lit(level)))


def _rate(size: Column, tilt: Column, scale: Column, kind: Column, repeats: float) -> Column:
    """min(repeats, exp(tilt * size / scale)), or a constant where the dual has no finite solution."""
    tilted = F.least(F.lit(float(repeats)), F.exp(F.least(tilt * size / scale, F.lit(700.0))))
    return F.when(kind == "all", F.lit(float(repeats))).when(kind == "none", F.lit(0.0)).otherwise(tilted)


def solve_tilts(spark: SparkSession, profile: DataFrame, targets: DataFrame, repeats: float) -> DataFrame:
    """One multiplier per source, by Newton steps on the convex dual of the entropy problem.

    The problem: choose rates r near 1 (least sum of r log r - r, 0 <= r <= repeats) such that the
    tokens of a source, sum of r * size, are its target. Its solution is r = min(repeats, exp(tilt *
    size / scale)); the gradient of the dual is the tokens that the rates give, less the target. Each
    step is one aggregation over ``profile`` (key, size, n); the driver sees the worst error only.
    """
    kind = F.when(F.col("target") <= 0, "none").when(F.col("target") >= F.col("most") * (1 - 1e-12), "all").otherwise("tilt")
    state = targets.select(
        "key", "target", "source_size", kind.alias("kind"), (F.col("source_size") / F.greatest(F.col("n_docs"), F.lit(1))).alias("scale"),
        F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
    )
    state = stage(spark, state.withColumn("scale", F.when(F.col("scale") > 0, F.col("scale")).otherwise(1.0)))
    for _ in range(ROUNDS):
        rate = _rate(F.col("size"), F.col("tilt"), F.col("scale"), F.col("kind"), repeats)
        sums = profile.join(state.where("kind = 'tilt'"), "key").groupBy("key").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("given"),
            F.sum(F.when(rate < repeats, F.col("n") * F.col("size") * F.col("size") / F.col("scale") * rate).otherwise(0.0)).alias("slope"),
        )
        error = F.col("given") - F.col("target")
        close = F.abs(error) <= F.lit(TOLERANCE) * F.col("target")
        low = F.when(error < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(error > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("tilt") - error / F.col("slope"))
        inside = newton.isNotNull() & (low.isNull() | (newton > low)) & (high.isNull() | (newton < high))
        other = F.when(low.isNull(), high - 1 - F.abs(high)).when(high.isNull(), low + 1 + F.abs(low)).otherwise((low + high) / 2)
        moved = state.join(sums, "key", "left").select(
            "key", "target", "source_size", "kind", "scale",
            F.when(F.col("given").isNull() | close, F.col("tilt")).when(inside, newton).otherwise(other).alias("tilt"),
            low.alias("low"), high.alias("high"), F.coalesce(close, F.lit(True)).alias("settled"),
        )
        state = stage(spark, moved)
        if state.where("not settled").limit(1).count() == 0:
            break
    return state


def mix(
    spark: SparkSession, docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), repeats: int = 3,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", whole_rows: bool = False,
) -> DataFrame:
    """Copies of each document such that every source gives its target of tokens.

    Rates are the exponential tilts of :func:`solve_tilts`. A rate is rounded to one of its neighbouring
    whole numbers: up where a hash of the id lies below its fraction plus a shift, and one shift per
    source (of ``STEPS``) brings the source's total next to its target. Reruns agree.

    Null texts have size 0; documents of size 0 keep rate 1 and add nothing. A null source is a source
    of its own, null ids and repeated rows are kept as documents of their own. Other columns of ``docs``
    are dropped, unless ``whole_rows`` asks for the rows themselves as a struct. An empty table gives no rows.

    Returns doc_id, source, size, source_size, target, rate, copies, and doc if asked for.
    """
    keep = ("doc",) if whole_rows else ()
    docs = docs.select(F.struct("*").alias("doc"))
    rows = stage(spark, docs.select(
        F.col(f"doc.{id_col}").alias("doc_id"), F.col(f"doc.{source_col}").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(f"doc.{source_col}")), F.lit("n")).alias("key"),
        word_count(F.col(f"doc.{text_col}")).alias("size"), *keep,
    ))
    profile = stage(spark, rows.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n"), F.first("source").alias("source")))
    sizes = profile.groupBy("key").agg(
        F.first("source").alias("source"), F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n_docs")
    )
    state = solve_tilts(spark, profile.select("key", "size", "n"), source_targets(spark, sizes, weights, repeats), repeats)
    rated = rows.join(state.drop("low", "high", "settled"), "key").withColumn("rate", _rate(F.col("size"), F.col("tilt"), F.col("scale"), F.col("kind"), repeats))
    whole = F.floor("rate")
    draw = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("copies")), 11)) / F.lit(float(1 << 53))
    # a document is rounded up when its step lies below its source's; steps grow with draw minus fraction
    step = F.when(whole >= repeats, F.lit(STEPS)).otherwise(F.least(F.floor((draw - (F.col("rate") - whole) + 1) / 2 * STEPS), F.lit(STEPS - 1)))
    rated = rated.withColumn("whole", whole).withColumn("step", step)
    steps = rated.groupBy("key", "step").agg(
        F.sum("size").alias("tokens"), F.sum(F.col("size") * F.col("whole")).alias("base"), F.first("target").alias("target")
    )
    by_key = Window.partitionBy("key")
    upto = by_key.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    options = steps.select(
        "key", "step", (F.sum("base").over(by_key) + F.coalesce(F.sum("tokens").over(upto), F.lit(0)) - F.col("target")).alias("off")
    )
    # past the last step nothing is left to round up, so a last option takes every step of the source
    last = steps.groupBy("key").agg(
        F.lit(STEPS).cast("long").alias("step"),
        (F.sum("base") + F.sum(F.when(F.col("step") < STEPS, F.col("tokens")).otherwise(0)) - F.max("target")).alias("off"),
    )
    limits = options.unionByName(last).groupBy("key").agg(F.min_by("step", F.struct(F.abs("off"), "step")).alias("limit"))
    limits = stage(spark, limits)
    return rated.join(limits, "key").select(
        "doc_id", "source", "size", "source_size", "target", "rate",
        (F.col("whole") + F.when(F.col("step") < F.col("limit"), 1).otherwise(0)).cast("int").alias("copies"), *keep,
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: weights 1, 2, 3 in turn, no source and no document above three times itself."""
    out = mix(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", F.col("source_size").cast("long"), "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "rate")
