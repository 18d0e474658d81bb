"""Column-level normalisers for feed payloads.

Feed fields are loosely typed: one field may be a number in one record and text in the next. JSON
payloads are therefore kept as VARIANT until a column is read out, and ``try_variant_get`` does
the conversion: a value that does not fit the wanted type becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------------------
EMERGENCY_SQUAWKS = {"7500": "unlawful_interference", "7600": "radio_failure", "7700": "emergency"}
CEILING_COVERS = ("BKN", "OVC", "OVX")
HAZARD_NAMES = {
    "TS": "thunderstorm",
    "TURB": "turbulence",
    "ICE": "icing",
    "MTW": "mountain_wave",
    "VA": "volcanic_ash",
    "TC": "tropical_cyclone",
    "DS": "dust_storm",
    "SS": "sand_storm",
    "IFR": "instrument_conditions",
    "LLWS": "low_level_wind_shear",
}
STORM_KP = 5
MINUTES_PER_DAY = 1440.0
# -------------------------------------------------------------------------------------------------

NUMBER_TYPES = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)"


def _path(*keys: str) -> str:
    return "$" + "".join(f"['{k}']" for k in keys)


def field(v: Column, *keys: str, as_type: str = "string") -> Column:
    """Read one (possibly nested) field of a variant object; null when absent or unconvertible."""
    return F.try_variant_get(v, _path(*keys), as_type)


def part(v: Column, *keys: str) -> Column:
    """A nested value as a variant; a JSON null reads as null."""
    return F.try_variant_get(v, _path(*keys), "variant")


def kind(v: Column) -> Column:
    """The type name of a variant value (``STRING``, ``BIGINT``, ``OBJECT<...>``, ``VOID``...)."""
    return F.schema_of_variant(v)


def whole(v: Column, *keys: str) -> Column:
    """Integer conversion: numbers are truncated, digit strings parsed, anything else is null."""
    return field(v, *keys, as_type="int")


def real(v: Column, *keys: str) -> Column:
    """Double conversion with the same leniency as :func:`whole`."""
    return field(v, *keys, as_type="double")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def padded_text(v: Column, *keys: str) -> Column:
    """Text fields padded to a fixed width: trimmed, blank to null, and non-text values to null."""
    p = part(v, *keys)
    return blank_to_null(F.trim(F.when(kind(p) == "STRING", p.cast("string"))))


def text_to_real(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def text_to_whole(c: Column) -> Column:
    """CSV integer: parsed as a number first so that ``12.0`` counts, then truncated."""
    return text_to_real(c).try_cast("int")


def is_ground(v: Column) -> Column:
    """A surface target reports the word ``ground`` (any case) in place of an altitude."""
    return F.coalesce(F.lower(F.when(kind(v) == "STRING", v.cast("string"))) == "ground", F.lit(False))


def altitude(v: Column) -> Column:
    """Barometric altitude; every textual altitude is unknown, digits included."""
    return F.when(kind(v) != "STRING", F.try_variant_get(v, "$", "int"))


def emergency_state(flag: Column, squawk: Column) -> Column:
    """A distress squawk names the state; otherwise the broadcast flag, lowercased, if it says any."""
    by_code = F.create_map(*[F.lit(x) for pair in EMERGENCY_SQUAWKS.items() for x in pair])
    said = F.lower(flag)
    return F.coalesce(by_code[squawk], F.when(~said.isin("none", ""), said))


def millis_to_seconds(c: Column) -> Column:
    return (c / 1000).cast("bigint")


def visibility(v: Column) -> Column:
    """Statute miles: a number, or text such as ``10+`` (a lower bound, kept as the bound)."""
    text = F.when(kind(v) == "STRING", F.regexp_replace(F.trim(v.cast("string")), r"\++$", ""))
    return F.when(kind(v).rlike(NUMBER_TYPES), F.try_variant_get(v, "$", "double")).otherwise(
        text.try_cast("double")
    )


def ceiling(clouds: Column) -> Column:
    """Base of the lowest broken or overcast layer in ``clouds`` (an array of variants)."""
    bases = F.transform(
        F.filter(clouds, lambda c: field(c, "cover").isin(*CEILING_COVERS)),
        lambda c: F.when(kind(part(c, "base")).rlike(NUMBER_TYPES), real(c, "base")),
    )
    return F.array_min(bases).cast("int")


def integer_only(v: Column) -> Column:
    """Keep a JSON integer; text such as ``VRB`` and fractions become null."""
    return F.when(kind(v) == "BIGINT", F.try_variant_get(v, "$", "int"))


def launch_designator(object_id: Column) -> Column:
    """``2026-045BK`` to ``2026-045``: the year and the digits of what follows the first dash."""
    digits = F.regexp_replace(F.regexp_extract(object_id, r"^[^-]*-(.*)$", 1), r"[^0-9]", "")
    year = F.regexp_extract(object_id, r"^([^-]*)-", 1)
    return F.when(digits != "", F.concat_ws("-", year, digits))


def launch_year(object_id: Column) -> Column:
    return F.when(object_id.rlike(r"^[0-9]{4}"), F.substring(object_id, 1, 4).cast("int"))


def orbital_period(mean_motion: Column) -> Column:
    return rounded(F.lit(MINUTES_PER_DAY) / F.nullif(mean_motion, F.lit(0.0)), 3)


def composed_id(*parts: Column) -> Column:
    """Parts joined by dashes; a missing part is written ``None`` so ids keep their positions."""
    return F.concat_ws("-", *[F.coalesce(p, F.lit("None")) for p in parts])


def hazard_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in HAZARD_NAMES.items() for x in pair])
    return names[code]


def weekday_text_to_epoch(c: Column) -> Column:
    """``Wed Jul 29 14:30:34 2026 GMT`` to epoch seconds; text of another form is null."""
    body = F.regexp_extract(
        F.trim(c), r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)\s+(\w{3}\s+\d{1,2}\s+[\d:]{8}\s+\d{4})(?:\s+GMT)?$", 1
    )
    squeezed = F.regexp_replace(body, r"\s+", " ")
    return F.unix_timestamp(F.try_to_timestamp(blank_to_null(squeezed), F.lit("MMM d HH:mm:ss yyyy")))


def iso_to_epoch(c: Column) -> Column:
    """ISO 8601 text to epoch seconds, read as UTC; unreadable text is null."""
    return F.unix_timestamp(F.try_to_timestamp(blank_to_null(c)))


def unquoted(c: Column) -> Column:
    """Strip the single quotes some CSV exports wrap values in."""
    inner = F.regexp_replace(F.trim(c), r"^'+|'+$", "")
    return blank_to_null(F.trim(inner))


def overflow(pairs: Column, named: list[str]) -> Column:
    """Leaves no column claims, as ``key=value`` texts in order of their keys, joined by ``; ``.

    A key that repeats counts once, with its last value.
    """
    rest = F.filter(pairs, lambda p: ~p["key"].isin(*named))
    keys = F.array_sort(F.array_distinct(F.transform(rest, lambda p: p["key"])))
    last = lambda k: F.element_at(F.filter(rest, lambda p: p["key"] == k), -1)["value"]
    return blank_to_null(F.array_join(F.transform(keys, lambda k: F.concat(k, F.lit("="), last(k))), "; "))


def first_translation(translations: Column) -> Column:
    """Formatted (else simple) text of the first element that holds anything."""
    filled = F.filter(translations, lambda t: F.size(field(t, as_type="map<string,variant>")) > 0)
    # a lambda variable, so that the first filled element is found once however often it is named
    text = lambda t: F.coalesce(blank_to_null(field(t, "formattedText")), field(t, "simpleText"))
    return F.element_at(F.transform(F.array(F.get(filled, F.lit(0))), text), 1)


def text_or_object(v: Column, key: str = "name") -> Column:
    """A field sent either as plain text or as an object; the object contributes ``key``."""
    return F.when(kind(v).startswith("OBJECT"), field(v, key)).otherwise(F.try_variant_get(v, "$", "string"))


def joined_names(items: Column) -> Column:
    """Names of an array of objects joined by ``, ``; entries that are not objects are skipped."""
    objects = F.filter(items, lambda p: kind(p).startswith("OBJECT"))
    names = F.transform(objects, lambda p: F.coalesce(field(p, "name"), F.lit("")))
    return blank_to_null(F.array_join(names, ", "))


def is_storm(estimated_kp: Column) -> Column:
    return F.coalesce(estimated_kp >= STORM_KP, F.lit(False))


def flag_text(c: Column, truth: str) -> Column:
    return F.coalesce(c == truth, F.lit(False))


def truthy(v: Column) -> Column:
    """Whether a JSON value counts as true: not null, false, zero, or empty."""
    text = F.try_variant_get(v, "$", "string")
    return F.coalesce(
        F.when(kind(v) == "VOID", F.lit(False))
        .when(kind(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind(v) == "STRING", text != "")
        .when(kind(v).rlike(NUMBER_TYPES), F.try_variant_get(v, "$", "double") != 0)
        .when(kind(v).startswith("ARRAY"), F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
        .when(kind(v).startswith("OBJECT"), F.size(F.try_variant_get(v, "$", "map<string,variant>")) > 0),
        F.lit(False),
    )


def truthy_or_null(v: Column) -> Column:
    return F.when(v.isNotNull() & (kind(v) != "VOID"), truthy(v))


def rounded(c: Column, digits: int) -> Column:
    """Round half away from zero on the binary value, the way SQL engines working on doubles do.

    ``F.round`` works on the shortest decimal text of a double instead, and so lifts 10.075 (stored a
    little below) to 10.08.
    """
    return F.round(c * float(10**digits)) / float(10**digits)


def utc(seconds: Column) -> Column:
    """Epoch seconds as a zone-free UTC timestamp."""
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")
