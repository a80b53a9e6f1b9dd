"""Distance joins and coverage by grid cells.

The points of a segment within r of another segment make one interval, for the set of all points within r of a segment (a
rectangle and two discs) is convex. So coverage is a union of intervals per segment, and only segments that share a grid cell
are compared: an equi-join on the cell, never a product. A union takes the same interval twice without harm.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import in_polygon, segment_distance
from .joins import shuffled

_ENDS = ["ax", "ay", "bx", "by"]


def cells_along(ax: Column, ay: Column, bx: Column, by: Column, size: float, reach: float = 0.0) -> Column:
    """array<struct<cx, cy>> of the cells in which a point can lie that is within ``reach`` of the segment.

    Column by column of the grid, the part of the segment that its points can be near to: a long diagonal has cells along it,
    not those of its box.
    """

    def column(x: Column) -> Column:
        run = F.nullif(bx - ax, F.lit(0.0))
        ends = F.array(F.coalesce((x * size - reach - ax) / run, F.lit(0.0)), F.coalesce(((x + 1) * size + reach - ax) / run, F.lit(1.0)))
        inside = F.transform(ends, lambda t: ay + F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)) * (by - ay))
        rows = F.sequence(F.floor((F.array_min(inside) - reach) / size), F.floor((F.array_max(inside) + reach) / size))
        return F.transform(rows, lambda y: F.struct(x.alias("cx"), y.alias("cy")))

    x0, x1 = F.floor((F.least(ax, bx) - reach) / size), F.floor((F.greatest(ax, bx) + reach) / size)
    return F.flatten(F.transform(F.sequence(x0, x1), column))


def points_near_segments(points: DataFrame, segments: DataFrame, radius: float, size: float | None = None) -> DataFrame:
    """Every (point, segment) within the radius, with the distance. A point has one cell, so no pair is met twice."""
    size = size or max(4 * radius, 1e-9)
    left = points.withColumns({"cx": F.floor(F.col("px") / size), "cy": F.floor(F.col("py") / size)})
    right = segments.withColumn("__c", F.explode(cells_along(*[F.col(c) for c in ("ax", "ay", "bx", "by")], size, radius))).select(*segments.columns, "__c.cx", "__c.cy")
    gap = segment_distance(*[F.col(c) for c in ("px", "py", "ax", "ay", "bx", "by")])
    return left.join(right, ["cx", "cy"]).withColumn("distance", gap).where(F.col("distance") <= radius).drop("cx", "cy")


def _linear(f0: str, f1: str, low: str, high: str) -> tuple[str, str]:
    """Where low <= f0 + f1 t <= high: the ends of an interval of t, crossed where it is empty."""
    start = f"case when {f1} <> 0 then least(({low} - {f0}) / {f1}, ({high} - {f0}) / {f1}) when {f0} between {low} and {high} then 0d else 2d end"
    return start, f"case when {f1} <> 0 then greatest(({low} - {f0}) / {f1}, ({high} - {f0}) / {f1}) when {f0} between {low} and {high} then 1d else -1d end"


def with_near_interval(pairs: DataFrame, radius: float) -> DataFrame:
    """``pairs`` of segments a-b and c-d with (t0, t1): which part of a-b lies within the radius of c-d; null where none does.

    The steps are columns of their own, so that each is computed once.
    """
    step = pairs.selectExpr("*", "bx - ax as __vx", "by - ay as __vy", "dx - cx as __wx", "dy - cy as __wy").selectExpr("*", "__vx * __vx + __vy * __vy as __q", "hypot(__wx, __wy) as __s")
    ends = [(f"__vx * (ax - {x}) + __vy * (ay - {y})", f"(ax - {x}) * (ax - {x}) + (ay - {y}) * (ay - {y}) - {float(radius) ** 2}") for x, y in (("cx", "cy"), ("dx", "dy"))]
    step = step.selectExpr(
        "*", *[f"{h} as __h{k}" for k, (h, _) in enumerate(ends)], *[f"{e} as __e{k}" for k, (_, e) in enumerate(ends)],
        *[f"try_divide({n}, __s) as {c}" for n, c in (("(ax - cx) * __wx + (ay - cy) * __wy", "__f0"), ("__vx * __wx + __vy * __wy", "__f1"), ("(ax - cx) * __wy - (ay - cy) * __wx", "__g0"), ("__vx * __wy - __vy * __wx", "__g1"))],
    )
    step = step.selectExpr("*", *[f"case when __q > 0 and __h{k} * __h{k} >= __q * __e{k} then sqrt(__h{k} * __h{k} - __q * __e{k}) end as __r{k}" for k in (0, 1)])
    along, across = _linear("__f0", "__f1", "0d", "__s"), _linear("__g0", "__g1", f"{-float(radius)}d", f"{float(radius)}d")
    step = step.selectExpr("*", *[f"greatest(0d, (-__h{k} - __r{k}) / __q) as __a{k}" for k in (0, 1)], *[f"least(1d, (-__h{k} + __r{k}) / __q) as __b{k}" for k in (0, 1)], f"greatest(0d, {along[0]}, {across[0]}) as __a2", f"least(1d, {along[1]}, {across[1]}) as __b2")
    # greatest and least pass over nulls: a disc that is not met must not count as the whole segment
    good = [f"__r{k} is not null and __a{k} <= __b{k}" for k in (0, 1)] + ["__s > 0 and __a2 <= __b2"]
    ends = [f"least({', '.join(f'case when {g} then __a{k} end' for k, g in enumerate(good))}) as t0", f"greatest({', '.join(f'case when {g} then __b{k} end' for k, g in enumerate(good))}) as t1"]
    return step.selectExpr(*pairs.columns, *ends)


def merged_cover(cover: DataFrame, by: list[str]) -> DataFrame:
    """``cover`` (*by, ax, ay, bx, by) without copies, where segments parallel to an axis that meet on one line are one segment.

    What lies within a radius of either lies within it of both together, so a union of intervals stays the same.
    """
    once = cover.select(*by, *_ENDS).distinct()
    flat, high = F.col("ay") == F.col("by"), F.col("ax") == F.col("bx")
    line = once.withColumn("__k", F.when(flat, F.struct(F.lit(0).alias("axis"), F.col("ay").alias("at"))).when(high, F.struct(F.lit(1).alias("axis"), F.col("ax").alias("at"))))
    low, most = F.when(flat, F.least("ax", "bx")).otherwise(F.least("ay", "by")), F.when(flat, F.greatest("ax", "bx")).otherwise(F.greatest("ay", "by"))
    spans = line.where("__k is not null").select(*by, "__k", low.alias("__lo"), most.alias("__hi"))
    on = Window.partitionBy(*by, "__k").orderBy("__lo", "__hi")
    reach = F.max("__hi").over(on.rowsBetween(Window.unboundedPreceding, -1))
    chain = spans.withColumn("__new", F.when(F.col("__lo") <= reach, 0).otherwise(1)).withColumn("__n", F.sum("__new").over(on.rowsBetween(Window.unboundedPreceding, 0)))
    whole = chain.groupBy(*by, "__k", "__n").agg(F.min("__lo").alias("lo"), F.max("__hi").alias("hi"))
    level = F.col("__k.axis") == 0
    ends = [F.when(level, a).otherwise(b).alias(c) for c, a, b in zip(_ENDS, map(F.col, ("lo", "__k.at", "hi", "__k.at")), map(F.col, ("__k.at", "lo", "__k.at", "hi")), strict=True)]
    return line.where("__k is null").drop("__k").unionByName(whole.select(*by, *ends))


def covered(lines: DataFrame, cover: DataFrame, radius: float, by: list[str] | None = None, size: float | None = None) -> DataFrame:
    """(id, *by, covered): metres of each line within the radius of the cover's segments (of the same ``by``).

    ``lines``: id, seg, ax, ay, bx, by; ``cover``: *by, ax, ay, bx, by. Lines that nothing covers are not in the result.
    Each different segment is compared once, however many lines have it.
    """
    by = by or []
    size = size or max(4 * radius, 50.0)
    # cells along the segments, not those of their boxes; two that share several cells meet in each, which adds nothing below
    lines = lines.select("id", "seg", *_ENDS).distinct()
    left = lines.select(*_ENDS).distinct().withColumn("__c", F.explode(cells_along(*map(F.col, _ENDS), size)))
    right = merged_cover(cover, by).select(*by, F.col("ax").alias("cx"), F.col("ay").alias("cy"), F.col("bx").alias("dx"), F.col("by").alias("dy"))
    right = right.withColumn("__d", F.explode(cells_along(*[F.col(c) for c in ("cx", "cy", "dx", "dy")], size, radius)))
    # boxes that are further apart than the radius need no interval
    boxes = [F.least(a, b) - radius <= F.greatest(c, d) for a, b, c, d in (("ax", "bx", "cx", "dx"), ("cx", "dx", "ax", "bx"), ("ay", "by", "cy", "dy"), ("cy", "dy", "ay", "by"))]
    met = left.join(shuffled(right), F.col("__c") == F.col("__d")).where(boxes[0] & boxes[1] & boxes[2] & boxes[3]).drop("__c", "__d")
    spans = with_near_interval(met, radius).where("t0 is not null").select(*_ENDS, *by, F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")).alias("len"), "t0", "t1")
    before = Window.partitionBy(*_ENDS, *by).orderBy("t0", "t1").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("__p", F.max("t1").over(before))
    fresh = F.greatest(F.lit(0.0), F.col("t1") - F.greatest(F.col("t0"), F.coalesce("__p", F.col("t0"))))
    shapes = spans.withColumn("__m", fresh * F.col("len")).groupBy(*_ENDS, *by).agg(F.sum("__m").alias("covered")).where("covered > 0")
    return lines.join(shuffled(shapes), _ENDS).groupBy("id", *by).agg(F.sum("covered").alias("covered"))


def covered_more_than(lines: DataFrame, lengths: DataFrame, cover: DataFrame, radius: float, share: float, by: list[str] | None = None) -> DataFrame:
    """(id, *by) of the lines covered for more than the share of their length."""
    return covered(lines, cover, radius, by).join(shuffled(lengths), "id").where(F.col("covered") > share * F.col("length")).select("id", *(by or []))


def in_first_polygon(points: DataFrame, px: str, py: str, polygons: list[tuple[str, list[tuple[float, float]]]], out: str) -> DataFrame:
    """Points with the name of the first polygon that holds them; the others are dropped."""
    name = F.coalesce(*[F.when(in_polygon(F.col(px), F.col(py), ring), F.lit(label)) for label, ring in polygons])
    return points.withColumn(out, name).where(F.col(out).isNotNull())


def greedy_kept(rows: DataFrame, group: str, order: list[str], pairs: DataFrame, share: float) -> DataFrame:
    """Lines kept in order: one is left out where those kept before it cover more than the share of its length.

    ``pairs`` has an interval for every two near lines: (group, id, other, seg, t0, t1, len). Order makes it sequential, so
    each group (a city) is one task; only its near pairs come with it.
    """

    def run(key, mine: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        spans: dict = {}
        for r in near.itertuples(index=False):
            spans.setdefault(r.id, []).append((r.seg, r.t0, r.t1, r.len, r.other))
        kept: set = set()
        out = []
        for r in mine.sort_values(order).itertuples(index=False):
            total, last, reach = 0.0, None, 0.0
            for seg, t0, t1, size, other in sorted(spans.get(r.id, [])):
                if other in kept:
                    reach = reach if seg == last else 0.0
                    total += max(0.0, t1 - max(t0, reach)) * size
                    last, reach = seg, max(reach, t1)
            if total <= share * r.length:
                kept.add(r.id)
                out.append(r.id)
        return pd.DataFrame({group: [key[0]] * len(out), "id": out})

    kind = f"{group} {rows.schema[group].dataType.simpleString()}, id {rows.schema['id'].dataType.simpleString()}"
    # new names for both sides' columns: they may come from the same rows
    near = pairs.select(*[F.col(c).alias("__g" if c == group else c) for c in pairs.columns])
    return rows.toDF(*rows.columns).groupBy(group).cogroup(near.toDF(*near.columns).groupBy("__g")).applyInPandas(run, kind)
