"""Sections, overlays and features in the schemas of the map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.geometry import to_degrees
from ..functions.scalars import active, blank_to_null
from .joins import shuffled
from .match import match_rows

#: The columns of a section, whichever report it comes from.
SECTION = ["city", "street", "section_id", "from", "to", "pci", "rsl_years", "functional_class", "surface_type", "length_ft", "width_ft", "area_sqft", "survey_date", "last_treatment", "last_treatment_date", "match_length_err", "match_method"]
_KINDS = {"pci": "int", "rsl_years": "double", "length_ft": "double", "width_ft": "double", "area_sqft": "double", "match_length_err": "double"}


def sections(rows: DataFrame, city: str, columns: dict[str, str]) -> DataFrame:
    """Rows in the section schema: ``columns`` says which of theirs is which; blank is null, and what they lack is null."""
    made = {"city": F.lit(city)} | {to: blank_to_null(F.col(of).cast("string")) for to, of in columns.items()}
    kept = [c for c in rows.columns if c in ("xs", "ys")]
    return rows.select(*[(made[c].try_cast(_KINDS[c]) if c in _KINDS else made[c]).alias(c) if c in made else F.lit(None).cast(_KINDS.get(c, "string")).alias(c) for c in SECTION], *kept)


def lon_lat(xs: Column, ys: Column) -> Column:
    """array<struct<x, y>> in degrees of a line's metres."""
    return F.transform(F.arrays_zip(xs.alias("x"), ys.alias("y")), lambda p: to_degrees(p["x"], p["y"]))


def placed(rows: DataFrame, edges: DataFrame, miles: str | None = None) -> DataFrame:
    """``rows`` (row_id, street_name, beg_location, end_location, ...) with ok, reason and the line of each, in one pass.

    A plan prints the ``miles`` of a project, which are its length; a moratorium prints none, and the shortest way stands.
    """
    length = F.col(miles).cast("double") * K.FT_PER_MILE if miles else F.lit(None).cast("double")
    found = match_rows(rows.select("row_id", "street_name", "beg_location", "end_location", length.alias("length_ft")), edges)
    return rows.join(shuffled(found), "row_id")


def overlay_report(found: DataFrame) -> DataFrame:
    """(rows, matched) of placed rows, and (reason, n)."""
    return found.agg(F.count("*").alias("rows"), F.count_if("ok").alias("matched"))


def plan_features(found: DataFrame) -> DataFrame:
    """The paving-plan features of placed rows."""
    number = lambda c, t: blank_to_null(F.col(c).cast("string")).try_cast(t).alias(c)
    return found.where("ok").select("row_id", F.lit("paving_plan").alias("layer"), "plan", number("fiscal_year", "int"), F.col("street_name").alias("street"), F.col("beg_location").alias("from"), F.col("end_location").alias("to"), number("pci", "int"), number("miles", "double"), "treatment", "cost", lon_lat(F.col("xs"), F.col("ys")).alias("pts"))


def moratorium_features(found: DataFrame, as_of: str) -> DataFrame:
    """The moratorium features of placed rows, and whether each still holds on a day."""
    return found.where("ok").select("row_id", F.lit("moratorium").alias("layer"), F.col("street_name").alias("street"), F.col("beg_location").alias("from"), F.col("end_location").alias("to"), "begins", "ends", active(F.col("ends"), as_of).alias("active"), lon_lat(F.col("xs"), F.col("ys")).alias("pts"))


#: The columns of both overlays on the map.
PLAN, MORATORIUM = ["city", "street", "from", "to", "label", "detail"], ["city", "street", "from", "to", "ends", "active"]


def as_plan(rows: DataFrame, city: str, detail: Column, label: Column) -> DataFrame:
    """A city's plan rows as the map's plan overlay; what is written about them differs by city."""
    return rows.select(F.lit(city).alias("city"), "street", "from", "to", label.alias("label"), detail.alias("detail"))


def treatment_and_cost() -> Column:
    """treatment - cost, or the one of them that there is."""
    return F.nullif(F.concat_ws(" - ", blank_to_null(F.col("treatment")), blank_to_null(F.col("cost"))), F.lit(""))


def as_moratorium(rows: DataFrame, city: str, begin: str = "from", end: str = "to") -> DataFrame:
    """A city's moratorium as the map's; a city without limits shows the project and the program in their place."""
    return rows.select(F.lit(city).alias("city"), "street", F.col(begin).alias("from"), F.col(end).alias("to"), F.col("ends").cast("string").alias("ends"), "active")


def shown_lines(lines: DataFrame, tiers: list[str], cities: list[str]) -> DataFrame:
    """Bike lines of the chosen tiers and cities."""
    return lines.where(F.col("tier").isin(tiers) & F.col("city").isin(cities))


def shown_overlay(rows: DataFrame, cities: list[str], visible: bool = True) -> DataFrame:
    """An overlay's rows of the chosen cities; none while it is off."""
    return rows.where(F.col("city").isin(cities) & F.lit(visible))


def legend(sections: DataFrame, cities: list[str], bike_only: bool) -> DataFrame:
    """(band, n) of the chosen cities' sections, every band shown."""
    from .summaries import visible

    names = [name for _, _, name in K.BANDS]
    counts = visible(sections, names, cities, tier="bike_tier" if bike_only else None).groupBy(_band().alias("band")).agg(F.count("*").alias("n"))
    every = sections.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("band"))
    return every.join(counts, "band", "left").select("band", F.coalesce("n", F.lit(0)).alias("n"))


def _band() -> Column:
    from ..functions.scalars import shown_band

    return shown_band(F.col("pci"))


def bike_summary(sections: DataFrame, off_street: DataFrame) -> DataFrame:
    """(city, tier, street_miles, off_street_miles, miles): sections on the network by tier, and off-street lines, each of them
    rounded to three places before they are added, as they are drawn."""
    street = sections.where(F.col("bike_tier").isNotNull()).groupBy("city", F.col("bike_tier").alias("tier")).agg((F.sum(F.coalesce("length_ft", F.lit(0.0))) / K.FT_PER_MILE).alias("street_miles"))
    off = off_street.groupBy("city", "tier").agg(F.sum(F.bround("miles", 3)).alias("off_street_miles"))
    both = street.join(off, ["city", "tier"], "full")
    a, b = F.coalesce("street_miles", F.lit(0.0)), F.coalesce("off_street_miles", F.lit(0.0))
    return both.select("city", "tier", a.alias("street_miles"), b.alias("off_street_miles"), F.bround(a + b, 1).alias("miles"))


def tier_miles(summary: DataFrame, cities: list[str]) -> DataFrame:
    """(tier, miles) summed over the chosen cities; a tier that none has is 0, a city without a summary adds nothing."""
    every = summary.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, K.TIERS))).alias("tier"))
    sums = summary.where(F.col("city").isin(cities)).groupBy("tier").agg(F.sum("miles").alias("miles"))
    return every.join(sums, "tier", "left").select("tier", F.coalesce("miles", F.lit(0.0)).alias("miles"))


def with_summary(cities: DataFrame, summary: DataFrame) -> DataFrame:
    """Cities beside their summary; one without it stays, with nulls."""
    return cities.select("city").distinct().join(summary, "city", "left")


def tiles(summary: DataFrame) -> DataFrame:
    """(city, score, mapped): the text of each city's summary tile."""
    share = F.format_string("%.1f", 100 * (1 - F.col("unmatched_rate")))
    return summary.select("city", F.col("weighted_pci_mapped").cast("string").alias("score"), F.concat(F.format_number("sections_mapped", 0), F.lit(" of "), F.format_number("sections_in_report", 0), F.lit(" sections mapped ("), share, F.lit("%)")).alias("mapped"))


def distinct_names(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys..., names): how many names each group has."""
    return rows.groupBy(*keys).agg(F.count_distinct(name).alias("names"))
