"""Linear referencing: records placed between cross streets along their own street."""

from __future__ import annotations

import math
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.names import is_soft, is_terminal, label_alternatives, normalize
from .joins import resolve_names, shuffled
from .network import Street, between, lot, size_of
from .staging import staged

_OUT = "row_id long, ok boolean, reason string, method string, length_err double, matched_ft long, xs array<double>, ys array<double>"


def labelled(rows: DataFrame) -> DataFrame:
    """Rows (row_id, street_name, beg_location, end_location, length_ft) with canonical names and what their limits mean."""
    out = rows.withColumn("name", normalize(F.col("street_name"))).withColumn("target", F.nullif(F.col("length_ft").cast("double"), F.lit(0.0)) / K.FT_PER_M)
    for side in ("beg", "end"):
        label = F.col(f"{side}_location")
        wants = F.array_distinct(F.filter(F.transform(label_alternatives(label), lambda a: normalize(a)), lambda w: w != ""))
        out = out.withColumns({f"{side}_wants": wants, f"{side}_terminal": is_terminal(label), f"{side}_soft": is_soft(label)})
    return out


def _core(name: str) -> str:
    return name.rpartition(" ")[0] or name


def _near_share(points: list, taken: list, radius: float) -> float:
    """Which share of a line lies within the radius of other lines' segments."""
    total = size_of(points)
    if not total:
        return 0.0
    inside = 0.0
    for a, b in zip(points, points[1:], strict=False):
        spans = sorted(s for line in taken for c, d in zip(line, line[1:], strict=False) if (s := _interval(a, b, c, d, radius)))
        reach = 0.0
        for t0, t1 in spans:
            inside += max(0.0, t1 - max(t0, reach)) * math.dist(a, b)
            reach = max(reach, t1)
    return inside / total


def _interval(a, b, c, d, radius: float):
    vx, vy, wx, wy = b[0] - a[0], b[1] - a[1], d[0] - c[0], d[1] - c[1]
    found = []
    square = vx * vx + vy * vy
    for o in (c, d):
        h, e = vx * (a[0] - o[0]) + vy * (a[1] - o[1]), (a[0] - o[0]) ** 2 + (a[1] - o[1]) ** 2 - radius**2
        if square > 0 and h * h >= square * e:
            root = math.sqrt(h * h - square * e)
            found.append(((-h - root) / square, (-h + root) / square))
    size = math.hypot(wx, wy)
    if size > 0:
        low, high = 0.0, 1.0
        for f0, f1, least, most in (
            (((a[0] - c[0]) * wx + (a[1] - c[1]) * wy) / size, (vx * wx + vy * wy) / size, 0.0, size),
            (((a[0] - c[0]) * wy - (a[1] - c[1]) * wx) / size, (vx * wy - vy * wx) / size, -radius, radius),
        ):
            if f1 == 0:
                low, high = (low, high) if least <= f0 <= most else (2.0, -1.0)
            else:
                ends = sorted(((least - f0) / f1, (most - f0) / f1))
                low, high = max(low, ends[0]), min(high, ends[1])
        found.append((low, high))
    found = [(max(0.0, s), min(1.0, e)) for s, e in found if max(0.0, s) <= min(1.0, e)]
    return (min(s for s, _ in found), max(e for _, e in found)) if found else None


class _Placer:
    """Places the records of one group of streets."""

    def __init__(self, edges: pd.DataFrame):
        edges = edges.sort_values(["name", "ord"])
        self.street = Street([(r.u, r.v, r.w, list(zip(r.xs, r.ys, strict=True))) for r in edges.itertuples()])
        self.names: dict[str, set] = {}
        for r in edges.itertuples():
            self.names.setdefault(r.u, set()).update(r.u_names)
            self.names.setdefault(r.v, set()).update(r.v_names)
            self.names[r.u].add(r.name_)
            self.names[r.v].add(r.name_)
        self.by_name, self.by_core = defaultdict(set), defaultdict(set)
        for n, here in self.names.items():
            for h in here:
                self.by_name[h].add(n)
                self.by_core[_core(h)].add((h, n))
        self.ends = self.street.terminals()
        self.reached: dict[str, dict] = {}

    def reach(self, source: str) -> dict:
        """Ways from a node to all others, found once for all records that start there."""
        if source not in self.reached:
            self.reached[source] = self.street.reach(source)
        return self.reached[source]

    def anchors(self, wants, terminal: bool, resolved: str) -> list[str]:
        named = {n for w in wants for n in self.by_name.get(w, ())} | {n for w in wants for h, n in self.by_core.get(_core(w), ()) if h != resolved}
        return sorted(named) or (self.ends if terminal else [])

    def walks(self, source: str, target: float) -> list:
        """For every way out of the node: the line of the target's length, if some node fits it well enough."""
        best, ways = self.street.reach(source, 2.5 * target), {}
        for n, (d, _, _, first) in sorted(best.items(), key=lambda x: (x[1][0], x[0])):
            if n != source and d >= 0.9 * target:
                err = abs(d - target) / target
                if first not in ways or err < ways[first][0]:
                    ways[first] = (err, n)
        return [between(self.street.line(best, n), 0, target) for err, n in ways.values() if err <= K.LENGTH_TOL]

    def place(self, r, taken: list | None):
        """(points, reason, method, error, matched feet) of a record."""
        target = r.target if r.target and not math.isnan(r.target) else None
        ends = {s: self.anchors(getattr(r, f"{s}_wants"), getattr(r, f"{s}_terminal"), r.resolved) for s in ("beg", "end")}
        if ends["beg"] and set(ends["beg"]) == set(ends["end"]):
            side = "end" if r.end_soft else "beg" if r.beg_soft else None
            if side:
                ends[side] = self.ends
        soft, routes = r.beg_soft or r.end_soft, []
        for s in ends["beg"]:
            best = self.reach(s) if ends["end"] else {}
            routes += [(best[t][0], s, t, best) for t in ends["end"] if t != s and t in best]
        if routes:
            return self._route(r, routes, target, soft)
        for side in ("beg", "end") if target else ():
            for s in ends[side]:
                ways = self.walks(s, target)
                if len(ways) > 1 and taken is not None:
                    ways = [w for w in ways if _near_share(w, taken, K.OVERLAP_M) <= 0.5]
                if len(ways) == 1:
                    return ways[0], "ok", "one-ended walk", 0.0, round(target * K.FT_PER_M)
        missing = next((w for s, w in (("beg", "begin"), ("end", "end")) if not ends[s]), None)
        return None, f"{missing} cross street not found on street" if missing else "no path between cross streets along this street", None, None, None

    def _route(self, r, routes: list, target: float | None, soft: bool):
        def least(of, by):
            return min(of, key=lambda x: (by(x), x[1], x[2]))

        if target is None:
            size, _, t, best = least(routes, lambda x: x[0])
            return self.street.line(best, t), "ok", "cross-streets", None, round(size * K.FT_PER_M)
        enough = [x for x in routes if x[0] >= 0.98 * target] if soft else []
        size, _, t, best = least(enough, lambda x: x[0]) if enough else least(routes, lambda x: abs(x[0] - target))
        points, method = self.street.line(best, t), "cross-streets"
        if soft and size > 1.02 * target:
            whole = size_of(points)
            points = between(points, whole - target, whole) if r.beg_soft and not r.end_soft else between(points, 0, target)
            size, method = size_of(points), "trimmed"
        err = abs(size - target) / target
        if err > K.LENGTH_TOL:
            return None, f"length mismatch ({err:.0%})", method, round(err, 3), round(size * K.FT_PER_M)
        return points, "ok", method, round(err, 3), round(size * K.FT_PER_M)


def _edges_for(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """The edges of every group's member streets, without structs."""
    flat = edges.select(F.col("name").alias("street"), F.col("name").alias("name_"), F.col("name"), F.struct(F.col("edge.line").isNull(), "edge").alias("o"), "u", "v", "w", F.transform("pts", lambda p: p["x"]).alias("xs"), F.transform("pts", lambda p: p["y"]).alias("ys"), "u_names", "v_names")
    return groups.join(shuffled(flat), "street").withColumn("ord", F.to_json("o")).drop("o", "street")


def match_rows(rows: DataFrame, edges: DataFrame, occupied: DataFrame | None = None) -> DataFrame:
    """A result for every row: placed or not, why, how, and the line. A group of streets is one task's work; small ones come many at a time.

    ``occupied`` (name, xs, ys) holds lines already placed on a row's street.
    """
    records = staged(labelled(rows))
    members = resolve_names(records, edges.select("name").distinct().withColumnRenamed("name", "street").select(F.col("street").alias("name")), "name")
    names = members.groupBy("row_id").agg(F.min("resolved").alias("resolved"), F.array_join(F.array_sort(F.collect_set("street")), "|").alias("grp"))
    known = records.join(shuffled(names), "row_id").select("grp", "row_id", "name", "resolved", "target", *[f"{s}_{x}" for s in ("beg", "end") for x in ("wants", "terminal", "soft")])
    if occupied is not None:
        taken = occupied.groupBy("name").agg(F.collect_list(F.struct("xs", "ys")).alias("taken"))
        known = known.join(shuffled(taken), "name", "left")
    else:
        known = known.withColumn("taken", F.lit(None).cast("array<struct<xs:array<double>,ys:array<double>>>"))
    groups = names.select(F.col("grp").alias("group")).distinct().select("group", F.explode(F.split("group", r"\|")).alias("street"))

    def run(key, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out, edges_of = [], dict(iter(theirs.groupby("group", sort=False)))
        for grp, rows in mine.groupby("grp", sort=True):
            placer = _Placer(edges_of[grp])
            for r in rows.sort_values("row_id").itertuples(index=False):
                taken = None if r.taken is None else [list(zip(x["xs"], x["ys"], strict=True)) for x in r.taken]
                points, reason, method, err, feet = placer.place(r, taken)
                out.append((r.row_id, points is not None, reason, method, err, feet, [p[0] for p in points] if points else None, [p[1] for p in points] if points else None))
        frame = pd.DataFrame(out, columns=["row_id", "ok", "reason", "method", "length_err", "matched_ft", "xs", "ys"])
        return frame.astype({"length_err": "float64", "matched_ft": "Int64"})

    spark = rows.sparkSession
    placed = known.groupBy(lot(F.col("grp"), spark).alias("lot")).cogroup(_edges_for(edges, groups).groupBy(lot(F.col("group"), spark).alias("lot"))).applyInPandas(run, _OUT)
    lost = records.join(shuffled(names), "row_id", "left_anti").select("row_id", F.lit(False).alias("ok"), F.lit("street name not in centerlines").alias("reason"), *[F.lit(None).cast(t).alias(c) for c, t in (("method", "string"), ("length_err", "double"), ("matched_ft", "long"), ("xs", "array<double>"), ("ys", "array<double>"))])
    return placed.unionByName(lost)


def match_two_pass(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows that the first pass does not place are tried again beside what it placed on their street."""
    first = staged(match_rows(rows, edges))
    named = rows.select("row_id", normalize(F.col("street_name")).alias("name"))
    occupied = first.where("ok").join(shuffled(named), "row_id").select("name", "xs", "ys")
    second = match_rows(rows.join(shuffled(first.where("not ok").select("row_id")), "row_id", "left_semi"), edges, occupied)
    return first.where("ok").withColumn("pass", F.lit(1)).unionByName(second.withColumn("pass", F.lit(2)))
