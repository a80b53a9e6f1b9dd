"""Condition, match and mileage summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.scalars import band, reason_group, shown_band


def weighted(score: Column, weight: Column) -> Column:
    """Mean of the score by weight; a null weight is nothing, and no weight at all gives null."""
    w = F.coalesce(weight, F.lit(0.0))
    return F.sum(score * w) / F.nullif(F.sum(w), F.lit(0.0))


def band_counts(rows: DataFrame, keys: list[str], score: str) -> DataFrame:
    return rows.withColumn("band", band(F.col(score))).groupBy(*keys, "band").agg(F.count("*").alias("n"))


def match_stats(rows: DataFrame, keys: list[str], matched: Column) -> DataFrame:
    """rows, matched and the unmatched share to four places."""
    n, m = F.count("*"), F.count_if(matched)
    return rows.groupBy(*keys).agg(n.alias("rows"), m.alias("matched"), F.bround(1 - m / n, 4).alias("unmatched_rate"))


def reason_histogram(rows: DataFrame, reason: str = "reason") -> DataFrame:
    return rows.groupBy(reason_group(F.col(reason)).alias("reason")).agg(F.count("*").alias("n"))


def miles_by_class(rows: DataFrame, keys: list[str], miles: str = "miles", digits: int = 1) -> DataFrame:
    """Sums of miles that are rounded to four places by feature first."""
    return rows.groupBy(*keys).agg(F.bround(F.sum(F.bround(F.col(miles), 4)), digits).alias("miles"))


def tier_summary(rows: DataFrame, city: str, tier: str, score: str, area: str, length_ft: str) -> DataFrame:
    """Per city: sections on the network, weighted scores on it and of all, poor or failed ones, street miles by tier."""
    on = F.col(tier).isNotNull()
    weight = F.coalesce(F.col(area), F.lit(0.0))
    poor = band(F.col(score)).isin("Poor", "Failed") & on
    miles = [F.bround(F.coalesce(F.sum(F.when(F.col(tier) == t, F.coalesce(F.col(length_ft), F.lit(0.0)))), F.lit(0.0)) / K.FT_PER_MILE, 1).alias(f"{t}_miles") for t in K.TIERS]
    return rows.groupBy(city).agg(
        F.count_if(on).alias("sections_on_network"),
        F.bround(F.sum(F.when(on, F.col(score) * weight)) / F.nullif(F.sum(F.when(on, weight)), F.lit(0.0)), 1).alias("weighted_on_network"),
        F.bround(F.sum(F.col(score) * weight) / F.nullif(F.sum(weight), F.lit(0.0)), 1).alias("weighted_citywide"),
        F.count_if(poor).alias("poor_or_failed"),
        *miles,
    )


def project_summary(rows: DataFrame) -> DataFrame:
    """Counts and miles by kind and class of projects."""
    return rows.groupBy("kind", "class_raw").agg(F.count("*").alias("n"), F.bround(F.sum("miles"), 1).alias("miles"))


def visible(rows: DataFrame, bands: list[str], cities: list[str], score: str = "pci", city: str = "city", tier: str | None = None) -> DataFrame:
    """Sections of the chosen bands and cities, on the bike network only if a tier column is given."""
    kept = rows.where(shown_band(F.col(score)).isin(bands) & F.col(city).isin(cities))
    return kept.where(F.col(tier).isNotNull()) if tier else kept


def detail(rows: DataFrame, columns: list[str]) -> Column:
    """A map of the columns that are not null, as text."""
    return F.map_filter(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]), lambda _, v: v.isNotNull())
