"""Order-dependent operators with explicit order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_seen_ids(rows: DataFrame, value: str, order: list[str]) -> DataFrame:
    """(value, id): ids from 0 in the order in which values are first seen; null and empty have none.

    Only the distinct values are put in one order, after a pre-aggregated minimum.
    """
    text = F.col(value).cast("string")
    first = rows.where(text.isNotNull() & (text != "")).groupBy(text.alias("value")).agg(F.min(F.struct(*order)).alias("__o"))
    return first.select("value", (F.row_number().over(Window.orderBy("__o")) - 1).alias("id"))


def priority_tag(rows: DataFrame, key: list[str], tag: str, priority: list[str]) -> DataFrame:
    """(key, tag): the best tag that each key qualifies for."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(tag))
    best = rows.where(rank > 0).groupBy(*key).agg(F.min(rank).alias("__r"))
    return best.select(*key, F.array(*map(F.lit, priority))[F.col("__r").cast("int") - 1].alias(tag))


def incremental_merge(rows: DataFrame, source: str, item: str, amount: str, order: list[str]) -> DataFrame:
    """Per source in order of trust: what it holds alone, what it adds to those before, and the running total.

    Items that several sources hold are credited to the first. ``amount`` is that of the item.
    """
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(source)).cast("int")
    held = rows.where(rank > 0).select(rank.alias("rank"), F.col(item).alias("item"), F.col(amount).alias("amount")).groupBy("rank", "item").agg(F.max("amount").alias("amount"))
    first = held.groupBy("item").agg(F.min("rank").alias("rank"), F.min_by("amount", "rank").alias("amount"))
    alone = held.groupBy("rank").agg(F.sum("amount").alias("alone"))
    adds = first.groupBy("rank").agg(F.sum("amount").alias("adds"))
    w = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)  # a row a source
    both = alone.join(adds, "rank", "left").withColumn("adds", F.coalesce("adds", F.lit(0.0)))
    return both.select(F.array(*map(F.lit, order))[F.col("rank") - 1].alias(source), "alone", "adds", F.sum("adds").over(w).alias("running"))


def unpivoted(rows: DataFrame, keep: list[str], pairs: list[tuple[str, str]], status: str, value: str) -> DataFrame:
    """One row for each (label, column) whose value is not null."""
    parts = ", ".join(f"'{label}', `{column}`" for label, column in pairs)
    return rows.selectExpr(*keep, f"stack({len(pairs)}, {parts}) as ({status}, {value})").where(F.col(value).isNotNull())
