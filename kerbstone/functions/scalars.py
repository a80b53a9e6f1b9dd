"""Cell cleaning, codes, classes and formats as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .names import lookup, squeezed


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def number(x: Column) -> Column:
    """A number with thousands commas; null where it is none."""
    return F.replace(F.trim(x), F.lit(","), F.lit("")).try_cast("double")


def coded(table: dict[str, str], x: Column) -> Column:
    """The label of a code; an unknown code stays."""
    return F.coalesce(lookup(table, x), x)


def clean_treatment(table: dict[str, str], x: Column) -> Column:
    """The label of a treatment by its letters alone, else its text with white space squeezed."""
    return F.coalesce(lookup(table, F.regexp_replace(F.lower(x), "[^a-z]", "")), squeezed(x))


def after_dash(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, "^[^-]*-", ""))


def without_parenthetical(x: Column) -> Column:
    return F.regexp_replace(x, r"\s*\(.*\)", "")


def section_key(street_id: Column, section_id: Column) -> Column:
    """Both ids without leading zeros, in upper case, joined by a dash; a null id is the text NONE."""

    def part(x: Column) -> Column:
        return F.upper(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("None")), "^0+", ""))

    return F.concat(part(street_id), F.lit("-"), part(section_id))


def band(score: Column) -> Column:
    """The condition band; null between and outside bands."""
    out = F
    for low, high, name in K.BANDS:
        out = out.when(score.between(low, high), name)
    return out


def shown_band(score: Column) -> Column:
    """The band as the map shows it: Failed where there is none."""
    return F.coalesce(band(score), F.lit("Failed"))


def oakland_class(code: Column) -> Column:
    """struct(primary, secondary) of a dotted class code."""
    c = F.upper(F.trim(F.coalesce(code, F.lit(""))))
    tokens = F.filter(F.split(c, r"\."), lambda t: ~t.isin("", "0"))
    good = ~c.isin("", "0", "0.0", "NONE")
    return F.struct(F.when(good, lookup(K.OAKLAND_CLASS, F.get(tokens, 0))).alias("primary"), F.when(good, lookup(K.OAKLAND_CLASS, F.get(tokens, 1))).alias("secondary"))


def osm_class(tags: Column) -> Column:
    """The class of a map of tags."""
    return F.transform(F.array(tags), _osm_class)[0]  # the map is made once, whatever expression it is


def _osm_class(tags: Column) -> Column:
    sides = F.filter(F.array(*[F.get(F.array(tags[k]), 0) for k in ("cycleway", "cycleway:both", "cycleway:left", "cycleway:right")]), lambda v: F.coalesce(v, F.lit("")) != "")
    buffered = F.exists(F.map_keys(tags), lambda k: F.contains(k, F.lit("buffer"))) | F.array_contains(sides, "buffered_lane")
    return (
        F.when(tags["highway"] == "cycleway", "I")
        .when((tags["bicycle_road"] == "yes") | (tags["cyclestreet"] == "yes"), "IIIB")
        .when(F.array_contains(sides, "track"), "IV")
        .when(F.arrays_overlap(sides, F.array(*map(F.lit, ("lane", "opposite_lane", "buffered_lane")))), F.when(buffered, "IIB").otherwise("II"))
        .when(F.array_contains(sides, "shared_lane"), "IIIA")
    )


def plan_class(treatment: Column, class_raw: Column) -> Column:
    """The class that a plan's treatment text and raw class name."""
    t, raw = F.lower(F.coalesce(treatment, F.lit(""))), F.upper(F.coalesce(class_raw, F.lit("")))
    return (
        F.when((raw == "IV") | F.contains(t, F.lit("cycletrack")), "IV")
        .when(F.contains(t, F.lit("boulevard")), "IIIB")
        .when(raw == "II", F.when(F.contains(t, F.lit("upgraded")), "IIB").otherwise("II"))
        .when(raw.isin("I", "III"), raw)
    )


def title(name: Column) -> Column:
    """Title case that starts anew after every character that is no letter; names that start with a digit stay."""
    s = squeezed(F.coalesce(name, F.lit("")))
    parts = F.regexp_extract_all(s, F.lit("([A-Za-z]+|[^A-Za-z]+)"), F.lit(1))
    return F.when(s.rlike("^[0-9]"), s).otherwise(F.array_join(F.transform(parts, lambda p: F.concat(F.upper(p.substr(1, 1)), F.lower(p.substr(F.lit(2), F.length(p))))), ""))


def epoch_date(ms: Column) -> Column:
    """The UTC day of epoch milliseconds; null for null and 0."""
    return F.to_date(F.timestamp_millis(F.nullif(ms, F.lit(0))))


def active(ends: Column, as_of: str) -> Column:
    """Whether a day written M/D/YYYY is not before ``as_of``."""
    return F.try_to_date(ends, "M/d/yyyy") >= F.lit(as_of).cast("date")


def tag_dump(tags: Column, pattern: str, limit: int = 180) -> Column:
    """key=value of the tags whose key matches, by key, cut to ``limit``."""
    entries = F.filter(F.array_sort(F.map_entries(tags)), lambda e: e["key"].rlike(pattern))
    return F.left(F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";"), F.lit(limit))


def mismatch_reason(error: Column) -> Column:
    """length mismatch (36%), rounded half to even."""
    return F.concat(F.lit("length mismatch ("), F.rint(error * 100).cast("int").cast("string"), F.lit("%)"))


def reason_group(reason: Column) -> Column:
    """The reason before its parenthesis."""
    return F.split(reason, r" \(")[0]


def round_even(x: Column, digits: int) -> Column:
    return F.bround(x, digits)


def html_escape(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def thousands(x: Column) -> Column:
    return F.format_number(x, 0)
