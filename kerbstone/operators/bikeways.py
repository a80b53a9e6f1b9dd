"""Bikeway sources in one schema, tier tags, the off-street residual and the merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.geometry import length, segments
from ..functions.names import lookup
from ..functions.scalars import active, blank_to_null, coded, epoch_date, oakland_class, osm_class, title
from .coverage import cells_along, covered, covered_more_than, greedy_kept, with_near_interval
from .sequences import priority_tag
from .staging import staged

FIELDS = ["city", "source", "status", "bikeway_class", "class_label", "street", "from_location", "to_location", "miles", "class_raw", "class_secondary", "year"]


def _bikeway(rows: DataFrame, city: Column, source: str, status: Column, kind: Column, **more: Column) -> DataFrame:
    """One source in the common schema; rows without a class or a line are left out."""
    made = {"street": F.lit(None), "from_location": F.lit(None), "to_location": F.lit(None), "class_raw": F.lit(None), "class_secondary": F.lit(None), "year": F.lit(None)} | more
    out = rows.select(
        city.alias("city"), F.lit(source).alias("source"), status.alias("status"), kind.alias("bikeway_class"), lookup(K.CLASS_LABEL, kind).alias("class_label"),
        *[c.cast("string").alias(n) for n, c in made.items()], "pts", F.bround(length(F.col("pts")) / K.M_PER_MILE, 4).alias("miles"),
    )
    return out.where(F.col("bikeway_class").isNotNull() & (F.size("pts") > 1)).select(*FIELDS, "pts")


def from_network(rows: DataFrame) -> DataFrame:
    """EXISTINGCL and PROPOSEDCL of one row are two bikeways; the year is that of an existing one."""
    both = rows.selectExpr("*", "stack(2, 'existing', EXISTINGCL, 'proposed', PROPOSEDCL) as (status, code)")
    kind = oakland_class(F.col("code"))
    year = F.when((F.col("status") == "existing") & (F.col("YEARCURREN") != "0"), blank_to_null(F.col("YEARCURREN")))
    return _bikeway(both, F.lit("Oakland"), K.SOURCE_ORDER[0], F.col("status"), kind["primary"], street=title(F.col("ROADWAY")), from_location=title(F.col("BEGINNING")), to_location=title(F.col("ENDING")), class_raw=F.col("code"), class_secondary=kind["secondary"], year=year)


def from_layer(rows: DataFrame, source: str, kind: str) -> DataFrame:
    """A layer whose rows all have one class."""
    return _bikeway(rows, F.lit("Berkeley"), source, F.lit("existing"), F.lit(kind), street=title(F.col("BB_STRNAM")), from_location=title(F.col("BB_FRO")), to_location=title(F.col("BB_TO")))


def from_2004(rows: DataFrame) -> DataFrame:
    return _bikeway(rows, F.lit("Berkeley"), K.SOURCE_ORDER[4], F.lit("existing"), lookup(K.BERKELEY_2004, F.trim("EX2004")), street=title(F.col("STREET")), from_location=title(F.col("FROM_")), to_location=title(F.col("TO_")), class_raw=F.col("EX2004"), year=F.lit("2004"))


def from_osm(rows: DataFrame) -> DataFrame:
    """Ways (tags, pts, city) whose class and city are known."""
    return _bikeway(rows.where(F.col("city").isNotNull()), F.col("city"), K.SOURCE_ORDER[3], F.lit("existing"), osm_class(F.col("tags")), street=F.col("tags")["name"])


def line_segments(rows: DataFrame, keep: list[str], pts: str = "pts") -> DataFrame:
    """(keep..., seg, ax, ay, bx, by) of lines."""
    return rows.select(*keep, F.posexplode(segments(F.col(pts))).alias("seg", "s")).select(*keep, "seg", "s.*")


def tagged(sections: DataFrame, bikeways: DataFrame) -> DataFrame:
    """``sections`` (id, city, pts) with the best tier that covers more than half of them, or null."""
    bikes = bikeways.where("status = 'existing'").withColumn("tier", lookup(K.TIER_OF, F.col("bikeway_class")))
    lines = line_segments(sections, ["id", "city"])
    lengths = sections.select("id", length(F.col("pts")).alias("length"), F.col("city").alias("own"))
    # tiers of the section's own city only
    hit = covered_more_than(lines, lengths, line_segments(bikes, ["city", "tier"]).withColumnRenamed("city", "of"), K.ON_ROUTE_M, K.COVERAGE, ["of", "tier"]).join(lengths.select("id", "own"), "id").where("of = own")
    return sections.join(priority_tag(hit, ["id"], "tier", K.TIERS).withColumnRenamed("tier", "bike_tier"), "id", "left")


def off_street(bikeways: DataFrame, sections: DataFrame) -> DataFrame:
    """Existing bikeways that neither tagged sections nor better ones kept before them account for."""
    tier, source = lookup(K.TIER_OF, F.col("bikeway_class")), F.array_position(F.array(*map(F.lit, K.SOURCE_ORDER)), F.col("source"))
    bikes = bikeways.where("status = 'existing'").withColumns({"tier": tier, "rank": F.array_position(F.array(*map(F.lit, K.TIERS)), tier), "nth": source, "length": length(F.col("pts"))})
    bikes = staged(bikes.where((F.col("rank") > 0) & (F.col("nth") > 0) & (F.col("length") >= K.MIN_MILES * K.M_PER_MILE)))
    lines = line_segments(bikes, ["id", "city"])
    streets = line_segments(sections.where(F.col("bike_tier").isNotNull()), ["city"]).withColumnRenamed("city", "of")
    drawn = covered(lines, streets, K.ON_ROUTE_M, ["of"]).join(bikes.select("id", "length", "city"), "id").where((F.col("of") == F.col("city")) & (F.col("covered") > K.DEDUP_FRAC * F.col("length"))).select("id")
    open_ = staged(bikes.join(drawn, "id", "left_anti"))
    mine = line_segments(open_, ["id", "city"]).withColumn("__c", F.explode(cells_along(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"), 100.0)))
    other = line_segments(open_, ["id", "city"]).select(F.col("id").alias("other"), "city", F.col("ax").alias("cx"), F.col("ay").alias("cy"), F.col("bx").alias("dx"), F.col("by").alias("dy"))
    other = other.withColumn("__c", F.explode(cells_along(F.col("cx"), F.col("cy"), F.col("dx"), F.col("dy"), 100.0, K.DEDUP_M)))
    met = mine.join(other, ["city", "__c"]).where("id <> other").drop("__c").distinct()
    pairs = with_near_interval(met, K.DEDUP_M).where("t0 is not null").select("city", "id", "other", "seg", "t0", "t1", F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")).alias("len"))
    kept = greedy_kept(open_.select("city", "id", "rank", "nth", "length"), "city", ["rank", "nth", "id"], pairs, K.DEDUP_FRAC)
    return open_.join(kept, ["city", "id"]).select("id", "city", "tier", lookup(K.TIER_LABEL, F.col("tier")).alias("tier_label"), "street", F.bround(F.col("length") / K.M_PER_MILE, 3).alias("miles"), "pts")


def plan_overlay(sections: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Sections with a plan code: the category, and the raw composite id."""
    kept = sections.where(F.trim(F.coalesce("PLAN_2022", F.lit(""))) != "")
    return kept.select(F.concat_ws("-", "STREETID", "SECTIONID").alias("section_id"), blank_to_null(F.trim("STREET")).alias("street"), blank_to_null(F.trim("BEGLOCATIO")).alias("from"), blank_to_null(F.trim("ENDLOCATIO")).alias("to"), coded(codes, F.trim("PLAN_2022")).alias("category"))


def moratorium_overlay(rows: DataFrame, as_of: str) -> DataFrame:
    """Streets that may not be cut, with their days and whether that still holds."""
    ends = epoch_date(F.col("M_DATEEND"))
    return rows.select(F.coalesce(blank_to_null(F.col("NAME")), F.col("LOCATION")).alias("street"), epoch_date(F.col("M_DATEPAVE")).alias("begins"), ends.alias("ends"), (ends >= F.lit(as_of).cast("date")).alias("active"), F.col("M_PROJNUM").alias("project"), F.col("M_3YP").alias("program"))


def moratorium_list(rows: DataFrame, as_of: str) -> DataFrame:
    """The same from a report, whose days are written M/D/YYYY."""
    return rows.withColumn("active", active(F.col("ends"), as_of))


def merged_miles(bikeways: DataFrame, order: list[str] | None = None, tolerance: float = 15.0, by: str | None = None) -> DataFrame:
    """Per source in order of trust: miles alone, miles farther than the tolerance from those before, running miles.

    A few sources, so a few steps: each is one coverage join against the lines accepted so far.
    """
    order, keys = order or K.MERGE_ORDER, [by] if by else []
    rows = bikeways.withColumn("length", length(F.col("pts")))
    out = None
    for k, source in enumerate(order):
        own = rows.where(F.col("source") == source)
        alone = own.select(*keys, "id", "length")
        if k:
            near = covered(line_segments(own, ["id"]), line_segments(rows.where(F.col("source").isin(order[:k])), keys), tolerance, keys)
            if by:
                near = near.join(own.select("id", F.col(by).alias("__b")), "id").where(F.col(by) == F.col("__b"))
            alone = alone.join(near.select("id", "covered"), "id", "left")
        else:
            alone = alone.withColumn("covered", F.lit(0.0))
        step = alone.groupBy(*keys).agg((F.sum("length") / K.M_PER_MILE).alias("alone"), (F.sum(F.col("length") - F.coalesce("covered", F.lit(0.0))) / K.M_PER_MILE).alias("adds")).select(F.lit(k).alias("nth"), F.lit(source).alias("source"), *keys, "alone", "adds")
        out = step if out is None else out.unionByName(step)
    total = F.sum("adds").over(Window.partitionBy(*keys).orderBy("nth"))
    # a source that has no lines is no step
    return out.where("alone is not null").withColumn("running", total)


#: Classes whose miles a plan states under another class.
PLAN_CLASS = {"IIIA": "III"}


def merge_table(bikeways: DataFrame, targets: dict[str, float], order: list[str] | None = None) -> DataFrame:
    """The merge per class and, as ``any``, of all classes: alone, adds, running, and all that was merged as a share of the plan.

    ``targets`` are a plan's miles by class, and its ``Total``; where it states none the share is null.
    """
    each = merged_miles(bikeways, order, by="bikeway_class")
    whole = merged_miles(bikeways, order).withColumn("bikeway_class", F.lit("any"))
    rows = each.unionByName(whole)
    kind = F.when(F.col("bikeway_class") == "any", "Total").otherwise(F.coalesce(lookup(PLAN_CLASS, F.col("bikeway_class")), F.col("bikeway_class")))
    target = lookup({k: float(v) for k, v in targets.items()}, kind)
    merged = F.sum("adds").over(Window.partitionBy("bikeway_class"))  # a row a source
    return rows.select("nth", "bikeway_class", "source", "alone", "adds", "running", target.alias("target"), (merged / F.nullif(target, F.lit(0.0))).alias("share"))
