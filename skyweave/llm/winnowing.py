"""Document fingerprints by winnowing, from built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyweave.llm.common import table

GRAM = 12  # characters of a k-gram
WINDOW = 16  # k-grams of a window, a power of two
BUCKETS_PER_TASK = 4
PLACE = 31  # bits of a position


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def grams(text: Column) -> Column:
    """Hash and position of every k-gram, as hash * 2**31 - position: the least of several is the one with
    the least hash, and of equal hashes the rightmost. A shorter text is a k-gram by itself. Positions count code
    points, as each match takes up one, a pair of surrogates included."""
    every = F.when(F.char_length(text) < GRAM, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit("(?s)(?=(.{%d}))." % GRAM), 1))
    return F.transform(every, lambda g, i: F.shiftleft(F.crc32(g.cast("binary")), PLACE) - i)


def least_per_window(values: Column, short: bool = True) -> Column:
    """The least of every ``WINDOW`` neighbours, by doubling the stretch that a minimum covers.

    Fewer values than a window are one window, or none if not ``short``.
    """

    def doubled(step: int, found: Column) -> Column:
        # zip_with fills the shorter side with nulls, which least() passes over; the surplus goes at the end
        wider = F.zip_with(found, F.slice(found, step + 1, F.greatest(F.size(found) - step, F.lit(0))), lambda a, b: F.least(a, b))
        return wider if step * 2 >= WINDOW else bound(wider, lambda w: doubled(step * 2, w))

    def full(v: Column) -> Column:
        fewer = F.array(F.array_min(v)) if short else F.slice(v, 1, 0)
        return F.when(F.size(v) < WINDOW, fewer).otherwise(F.slice(doubled(1, v), 1, F.size(v) - WINDOW + 1))

    return bound(values, full)


def hashes(selected: Column) -> Column:
    """The set of hashes of selected k-grams."""
    return F.array_distinct(F.transform(selected, lambda v: F.shiftright(v + F.lit((1 << PLACE) - 1), PLACE)))


def winnow(text: Column) -> Column:
    """Selected k-grams of a text, each once, in order of first selection (see :func:`grams` for the form)."""
    return F.array_distinct(least_per_window(grams(text)))


def positions(selected: Column) -> Column:
    """Selected k-grams as structs of position (in code points, from 0) and hash.

    Two texts that share a passage of ``GRAM + WINDOW - 1`` characters share a selected k-gram in it.
    """
    half = F.lit((1 << PLACE) - 1)
    return F.transform(selected, lambda v: F.struct((F.shiftleft(F.shiftright(v + half, PLACE), PLACE) - v).alias("position"), F.shiftright(v + half, PLACE).alias("hash")))


def likeness(a: Column, b: Column) -> Column:
    """Shared part of two sets of hashes, 0 to 1."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its selected k-grams with positions.

    A row is looked at by itself. Null texts count as empty, and an empty text has one k-gram, itself.
    Null ids and repeated rows stay; an empty table gives no rows.
    """
    selected = winnow(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col).alias("doc_id"), positions(selected).alias("fingerprint"))


def with_next(spark: SparkSession, docs: DataFrame, computed: Callable[[DataFrame], DataFrame], taken: tuple[str, ...]) -> DataFrame:
    """Rows with columns ``next_x`` for each x of ``taken``, of the next row in descending ``doc_id``, the
    last row's next being the first. ``computed`` adds columns in the stage that sorts, after the shuffle.

    Ids are cut into ranges of about equal counts, found in one pass over the ids alone; a range is one
    window. The first row of a range is also sent to the range that it comes after. The driver holds
    two ids a range; the number of ranges follows ``spark.sql.shuffle.partitions``. Null ids come last. Rows
    of one id are ordered by their text.
    """
    ranges = BUCKETS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = [F.lit(i / ranges) for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx("doc_id", F.array(*parts), max(10_000, 10 * ranges)).alias("cuts")).first()["cuts"] or []
    cuts = sorted({int(c) for c in cuts})
    # ids above the first cut are in range 1, and so on; nulls join the lowest
    bucket = F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("doc_id"))), F.lit(0)) if cuts else F.lit(0)
    bucket = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(bucket)
    tops = sorted((r["bucket"], r["top"]) for r in docs.groupBy(bucket.alias("bucket")).agg(F.max("doc_id").alias("top")).collect() if r["top"] is not None)
    own = F.struct(bucket.cast("int").alias("bucket"), F.lit(False).alias("guest"))
    if tops:
        above = [b for b, _ in tops[1:]] + [0]  # where each range's first row is the next of the last row
        goes = F.element_at(F.create_map(*[F.lit(x) for (_, top), b in zip(tops, above) for x in (top, b)]), F.col("doc_id"))
        guest = F.struct(goes.cast("int").alias("bucket"), F.lit(True).alias("guest"))
        places = F.when(F.col("doc_id").isin([t for _, t in tops]), F.array(own, guest)).otherwise(F.array(own))
    else:
        places = F.array(own)
    dealt = docs.select("*", F.explode(places).alias("place")).select("*", F.col("place.bucket").alias("bucket"), F.col("place.guest").alias("guest")).drop("place")
    rows = computed(dealt.repartition("bucket"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    everything = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # without any id there is no first row elsewhere, so the range's own first row is the last one's next
    led = [(F.lead(c).over(order) if tops else F.coalesce(F.lead(c).over(order), F.first(c).over(everything))).alias(f"next_{c}") for c in taken]
    return rows.select("*", *led).where(~F.col("guest")).drop("bucket", "guest")


def edited_fingerprints(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of texts and of texts whose second half is replaced by the beginning of the next.

    The windows of the first half are those of the text itself; only windows that reach into the second
    half are computed anew. Texts are shuffled once. Null texts count as empty. Other columns of ``docs``
    are not looked at. An empty table gives no rows; a table's only row is its own next.

    Returns doc_id, n_chars, edited, selected, edited_selected, near_edited, near_next.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def computed(df: DataFrame) -> DataFrame:
        df = df.withColumn("n_chars", F.char_length("text")).withColumn("replaced", F.floor(F.col("n_chars") / 2).cast("int"))
        # windows that lie in the kept half
        inner = F.greatest(F.col("n_chars") - F.col("replaced") - F.lit(GRAM + WINDOW - 2), F.lit(0))
        both = bound(least_per_window(grams(F.col("text"))), lambda m: F.struct(F.array_distinct(m).alias("selected"), F.array_distinct(F.slice(m, 1, inner)).alias("head")))
        df = df.withColumn("inner", inner).withColumn("both", both)
        return df.select("*", F.col("both.selected").alias("selected"), F.col("both.head").alias("head")).drop("both").withColumn("hashes", hashes(F.col("selected")))

    rows = with_next(spark, rows, computed, ("text", "hashes"))
    kept = F.substring(F.col("text"), F.lit(1), F.col("n_chars") - F.col("replaced"))
    rows = rows.withColumn("edited", F.concat(kept, F.substring(F.col("next_text"), F.lit(1), F.col("replaced"))))
    rest = grams(F.substring(F.col("edited"), F.col("inner") + 1, F.char_length("edited")))
    tail = F.when(F.col("inner") > 0, F.transform(least_per_window(rest, short=False), lambda v: v - F.col("inner"))).otherwise(least_per_window(rest))
    rows = rows.withColumn("edited_selected", F.array_distinct(F.concat("head", tail))).withColumn("edited_hashes", hashes(F.col("edited_selected")))
    return rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited", "selected", "edited_selected",
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"), likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how like they are."""
    out = edited_fingerprints(spark, table(spark, sf_dir, "documents"))
    digest = lambda c: F.lpad(F.lower(F.hex(F.xxhash64(c))), 16, "0")
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digest("selected").alias("fingerprint"), digest("edited_selected").alias("edited_fingerprint"), "near_edited", "near_next",
    )
