"""Key joins, fallbacks and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import core_of


def shuffled(side: DataFrame) -> DataFrame:
    """A side of a join of two that both grow: it is sorted and never broadcast.

    Spark takes what comes of an explode or an aggregate to be as small as the columns of the file below it, and would collect
    it at the driver.
    """
    return side.hint("merge")


def first_wins(rows: DataFrame, keys: list[str], order: list[str], keep: list[str] | None = None) -> DataFrame:
    """The first row of each key. A minimum of structs, so it is pre-aggregated before the shuffle."""
    rest = [c for c in (keep or rows.columns) if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*keys).agg(first.alias("__r")).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def key_join(rows: DataFrame, layer: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows with the first feature of their key."""
    return rows.join(first_wins(layer, [key], order), key)


def unmatched(rows: DataFrame, layer: DataFrame, key: str, reason: str) -> DataFrame:
    return rows.join(layer.select(key).distinct(), key, "left_anti").withColumn("reason", F.lit(reason))


def fallback_union(authority: DataFrame, fallback: DataFrame, name: str) -> DataFrame:
    """The authority's rows, and those of the fallback whose name it does not have."""
    return authority.unionByName(fallback.join(authority.select(name).distinct(), name, "left_anti"), allowMissingColumns=True)


def of_municipality(rows: DataFrame, city: str, left: str = "MUNILEFT", right: str = "MUNIRIGHT") -> DataFrame:
    return rows.where((F.col(left) == city) | (F.col(right) == city))


def resolve_names(rows: DataFrame, streets: DataFrame, name: str = "name") -> DataFrame:
    """``rows`` joined with every street that its name means: ``street`` the member and ``resolved`` the least of them.

    A name means itself if there is such a street, else all streets with its core, else those whose core it is.
    """
    known = streets.select(F.col(name).alias("street")).distinct().withColumn("core", core_of(F.col("street")))
    exact = rows.join(shuffled(known.select("street")), rows[name] == F.col("street"), "left_semi").withColumn("street", F.col(name)).withColumn("resolved", F.col(name))
    rest = rows.join(shuffled(known.select("street")), rows[name] == F.col("street"), "left_anti").withColumn("__core", core_of(F.col(name)))
    groups = known.groupBy("core").agg(F.array_sort(F.collect_set("street")).alias("members"))
    by_core = rest.join(shuffled(groups), rest["__core"] == groups["core"], "left").drop("core").withColumnRenamed("members", "__m1")
    by_name = by_core.join(shuffled(groups.withColumnRenamed("members", "__m2")), by_core[name] == F.col("core"), "left").drop("core")
    members = F.coalesce("__m1", "__m2")
    loose = by_name.withColumn("__m", members).withColumn("resolved", F.get("__m", F.lit(0))).select(*rows.columns, F.explode("__m").alias("street"), "resolved")
    return exact.select(*rows.columns, "street", "resolved").unionByName(loose)
