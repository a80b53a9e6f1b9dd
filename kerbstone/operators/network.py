"""A road network from centerlines: noding, snapping, names at nodes, bridging."""

from __future__ import annotations

import heapq
import math
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.geometry import _along, interpolate, length, nearest_share, segment_distance
from ..functions.names import core_of, normalize
from .coverage import cells_along
from .joins import shuffled
from .staging import staged

_POINT = "struct<x:double,y:double>"


def node_key(point):
    """The cell of a point: a grid cell of SNAP_M, not a radius; ties half to even."""
    return F.struct(F.rint(point["x"] / K.SNAP_M).cast("long").alias("i"), F.rint(point["y"] / K.SNAP_M).cast("long").alias("j"))


def noded(lines: DataFrame) -> DataFrame:
    """(line, name, piece, pts): lines (line, name, pts) cut where an end of any line comes within NODE_M of them."""
    lines = lines.where(F.size("pts") > 1).withColumn("total", length(F.col("pts")))
    ends = lines.select(F.explode(F.array(F.get("pts", F.lit(0)), F.element_at("pts", -1))).alias("p")).select(F.col("p.x").alias("px"), F.col("p.y").alias("py")).distinct()
    size = 50.0
    parts = lines.select("line", "total", F.explode(_along(F.col("pts"))).alias("s")).select("line", "total", "s.*")
    right = parts.withColumn("__c", F.explode(cells_along(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"), size, K.NODE_M)))
    left = ends.withColumn("__c", F.struct(F.floor(F.col("px") / size).alias("cx"), F.floor(F.col("py") / size).alias("cy")))
    args = [F.col(c) for c in ("px", "py", "ax", "ay", "bx", "by")]
    near = left.join(shuffled(right), "__c").withColumn("gap", segment_distance(*args)).where(F.col("gap") <= K.NODE_M).withColumn("at", F.col("d") + F.col("w") * nearest_share(*args))
    best = near.groupBy("line", "total", "px", "py").agg(F.min(F.struct("gap", "at")).alias("b"))
    cut = best.where((F.col("b.at") > K.NODE_M) & (F.col("b.at") < F.col("total") - K.NODE_M)).groupBy("line").agg(F.array_sort(F.collect_set(F.bround("b.at", 2))).alias("cuts"))
    both = lines.join(shuffled(cut), "line", "left").withColumn("bounds", F.concat(F.array(F.lit(0.0)), F.coalesce("cuts", F.array().cast("array<double>")), F.array("total")))
    spans = both.select("line", "name", "pts", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("bounds") - 2), lambda i: F.struct(F.col("bounds")[i].alias("a"), F.col("bounds")[i + 1].alias("b")))).alias("piece", "s"))
    inner = F.transform(F.filter(_along(F.col("pts")), lambda s: (s["d"] > F.col("s.a")) & (s["d"] < F.col("s.b"))), lambda s: F.struct(s["ax"].alias("x"), s["ay"].alias("y")))
    points = F.concat(F.array(interpolate(F.col("pts"), F.col("s.a"))), inner, F.array(interpolate(F.col("pts"), F.col("s.b"))))
    return spans.where("s.b - s.a >= 0.5").select("line", "name", "piece", points.alias("pts"))


def edges_of(lines: DataFrame) -> DataFrame:
    """(name, u, v, w, pts, edge): noded pieces between snapped nodes; loops to the same node are dropped."""
    pieces = noded(lines)
    u, v = node_key(F.get("pts", F.lit(0))), node_key(F.element_at("pts", -1))
    made = pieces.select("name", u.alias("u"), v.alias("v"), length(F.col("pts")).alias("w"), "pts", F.struct("line", "piece").alias("edge"))
    return made.where("u <> v")


def node_names(edges: DataFrame) -> DataFrame:
    """(node, names, x, y): the streets at a node, and its coordinates as first seen."""
    ends = edges.select("name", "edge", F.explode(F.array(F.struct(F.col("u").alias("n"), F.get("pts", F.lit(0)).alias("p"), F.lit(0).alias("k")), F.struct(F.col("v").alias("n"), F.element_at("pts", -1).alias("p"), F.lit(1).alias("k")))).alias("e"))
    return ends.groupBy(F.col("e.n").alias("node")).agg(F.array_sort(F.collect_set("name")).alias("names"), F.min_by("e.p", F.struct("edge", "e.k")).alias("p")).select("node", "names", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def degrees(edges: DataFrame) -> DataFrame:
    """(name, node, degree) over each street's own edges."""
    return edges.select("name", F.explode(F.array("u", "v")).alias("node")).groupBy("name", "node").agg(F.count("*").alias("degree"))


def bridges(nodes: list[tuple[float, float]], links: list[tuple[int, int]], most: float = K.BRIDGE_M) -> list[tuple[float, int, int]]:
    """Kruskal over one street's pieces: the shortest gaps of at most ``most`` that join them, ties by node."""
    up = list(range(len(nodes)))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in links:
        up[root(a)] = root(b)
    grid = defaultdict(list)
    for k, (x, y) in enumerate(nodes):
        grid[int(x // most), int(y // most)].append(k)
    gaps = []
    for (i, j), here in grid.items():
        near = [q for di in (-1, 0, 1) for dj in (-1, 0, 1) for q in grid.get((i + di, j + dj), ())]
        gaps += [(math.dist(nodes[p], nodes[q]), p, q) for p in here for q in near if p < q and root(p) != root(q) and math.dist(nodes[p], nodes[q]) <= most]
    out = []
    for d, p, q in sorted(gaps):
        if root(p) != root(q):
            up[root(p)] = root(q)
            out.append((d, p, q))
    return out


def lot(key: Column, spark: SparkSession) -> Column:
    """The lot that a street is dealt to: some for each shuffle partition, so that a kernel gets many small streets at a time."""
    return F.pmod(F.xxhash64(key), F.lit(8 * int(spark.conf.get("spark.sql.shuffle.partitions")))).cast("int")


def bridged(edges: DataFrame, nodes: DataFrame, most: float = K.BRIDGE_M) -> DataFrame:
    """``edges`` with straight edges over the gaps of streets that come in pieces; one street is one task's work.

    A street of one edge has no gap. The others come to the kernel many at a time.
    """
    at = nodes.select("node", "x", "y")
    several = edges.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    ends = edges.select("name", "u", "v").join(shuffled(several), "name", "left_semi").join(shuffled(at.select(F.col("node").alias("u"), F.col("x").alias("ux"), F.col("y").alias("uy"))), "u").join(shuffled(at.select(F.col("node").alias("v"), F.col("x").alias("vx"), F.col("y").alias("vy"))), "v")
    flat = ends.select("name", F.col("u.i").alias("ui"), F.col("u.j").alias("uj"), F.col("v.i").alias("vi"), F.col("v.j").alias("vj"), "ux", "uy", "vx", "vy")

    def run(many: pd.DataFrame) -> pd.DataFrame:
        out = []
        for name, rows in many.groupby("name", sort=False):
            point = {(r.ui, r.uj): (r.ux, r.uy) for r in rows.itertuples()} | {(r.vi, r.vj): (r.vx, r.vy) for r in rows.itertuples()}
            keys = sorted(point)
            index = {k: n for n, k in enumerate(keys)}
            made = bridges([point[k] for k in keys], [(index[r.ui, r.uj], index[r.vi, r.vj]) for r in rows.itertuples()], most)
            out += [(name, *keys[p], *keys[q], d, *point[keys[p]], *point[keys[q]], n) for n, (d, p, q) in enumerate(made)]
        return pd.DataFrame(out, columns=["name", "ui", "uj", "vi", "vj", "w", "ux", "uy", "vx", "vy", "nth"])

    made = flat.groupBy(lot(F.col("name"), edges.sparkSession).alias("lot")).applyInPandas(run, "name string, ui long, uj long, vi long, vj long, w double, ux double, uy double, vx double, vy double, nth int")
    line = edges.schema["edge"].dataType["line"].dataType.simpleString()
    extra = made.select(
        "name", F.struct(F.col("ui").alias("i"), F.col("uj").alias("j")).alias("u"), F.struct(F.col("vi").alias("i"), F.col("vj").alias("j")).alias("v"), "w",
        F.array(F.struct(F.col("ux").alias("x"), F.col("uy").alias("y")), F.struct(F.col("vx").alias("x"), F.col("vy").alias("y"))).alias("pts"),
        F.struct(F.lit(None).cast(line).alias("line"), (-1 - F.col("nth")).alias("piece")).alias("edge"),
    )
    return edges.unionByName(extra)


def network(features: DataFrame, name: str = "FULLNAME") -> DataFrame:
    """Edges of a layer (line, name column, pts in metres) with the names at both nodes; blank names are left out."""
    lines = features.select("line", normalize(F.col(name)).alias("name"), "pts").where("name <> ''")
    edges = staged(edges_of(staged(lines)))
    nodes = staged(node_names(edges))
    whole = bridged(edges, nodes)
    names = nodes.select("node", "names")
    return staged(
        whole.join(shuffled(names.select(F.col("node").alias("u"), F.col("names").alias("u_names"))), "u")
        .join(shuffled(names.select(F.col("node").alias("v"), F.col("names").alias("v_names"))), "v")
        .select("name", core_of(F.col("name")).alias("core"), "edge", F.concat_ws(",", "u.i", "u.j").alias("u"), F.concat_ws(",", "v.i", "v.j").alias("v"), "w", "pts", "u_names", "v_names")
    )


class Street:
    """One street's own edges: paths never leave them."""

    def __init__(self, edges: list[tuple[str, str, float, list[tuple[float, float]]]]):
        self.edges = edges
        self.at: dict[str, list[tuple[str, float, int]]] = defaultdict(list)
        for k, (u, v, w, _) in enumerate(edges):
            self.at[u].append((v, w, k))
            self.at[v].append((u, w, k))

    def terminals(self) -> list[str]:
        return sorted(n for n, ways in self.at.items() if len(ways) == 1)

    def reach(self, source: str, most: float = math.inf) -> dict[str, tuple[float, str | None, int, int]]:
        """Per node: (distance, node before, edge to it, first edge out of the source); nodes beyond ``most`` are not passed."""
        best: dict[str, tuple[float, str | None, int, int]] = {source: (0.0, None, -1, -1)}
        queue, settled = [(0.0, source)], set()
        while queue:
            d, n = heapq.heappop(queue)
            if n in settled or d > most:
                continue
            settled.add(n)
            for m, w, k in self.at[n]:
                if d + w < best.get(m, (math.inf,))[0]:
                    best[m] = (d + w, n, k, k if n == source else best[n][3])
                    heapq.heappush(queue, (d + w, m))
        return best

    def line(self, best: dict, goal: str) -> list[tuple[float, float]]:
        """The points from the source to the goal."""
        steps, n = [], goal
        while best[n][1] is not None:
            _, n, k, _ = best[n]
            steps.append((n, k))
        out: list[tuple[float, float]] = []
        for n, k in reversed(steps):
            u, _, _, points = self.edges[k]
            points = points if u == n else points[::-1]
            out += points[1:] if out else points
        return out


def _by_street(edges: DataFrame) -> DataFrame:
    """(name, u, v, w) with the nodes as text, as the grouped kernels take them."""
    return edges.select("name", F.concat_ws(",", "u.i", "u.j").alias("u"), F.concat_ws(",", "v.i", "v.j").alias("v"), "w")


def components(edges: DataFrame) -> DataFrame:
    """(name, node, component): the connected pieces of each street's own edges, named by their least node. A street is in one task; streets come many at a time."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        up: dict[tuple[str, str], tuple[str, str]] = {}

        def root(n: tuple[str, str]) -> tuple[str, str]:
            up.setdefault(n, n)
            while up[n] != n:
                up[n] = up[up[n]]
                n = up[n]
            return n

        for name, u, v in zip(rows["name"], rows.u, rows.v, strict=True):
            a, b = sorted((root((name, u)), root((name, v))))
            up[b] = a
        return pd.DataFrame([(*n, root(n)[1]) for n in up], columns=["name", "node", "component"])

    return _by_street(edges).groupBy(lot(F.col("name"), edges.sparkSession).alias("lot")).applyInPandas(run, "name string, node string, component string")


def distances(edges: DataFrame) -> DataFrame:
    """(name, node, length): the way along each street's own edges from its least node to every node that it reaches."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        street = Street([(r.u, r.v, r.w, []) for r in rows.itertuples()])
        best = street.reach(min(street.at))
        return pd.DataFrame([(rows["name"].iloc[0], n, v[0]) for n, v in best.items()], columns=["name", "node", "length"])

    return _by_street(edges).groupBy("name").applyInPandas(run, "name string, node string, length double")


def size_of(points: list[tuple[float, float]]) -> float:
    return sum(math.dist(a, b) for a, b in zip(points, points[1:], strict=False))


def between(points: list[tuple[float, float]], low: float, high: float) -> list[tuple[float, float]]:
    """The part of a line from one distance along it to another."""
    out: list[tuple[float, float]] = []

    def add(p: tuple[float, float]) -> None:
        if not out or math.dist(out[-1], p) > 1e-6:
            out.append(p)

    done = 0.0
    low, high = max(0.0, low), min(size_of(points), high)
    for a, b in zip(points, points[1:], strict=False):
        w = math.dist(a, b)
        if w > 0 and done + w >= low and done <= high:
            for t in (max(0.0, (low - done) / w), min(1.0, (high - done) / w)):
                add((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
        done += w
    return out
