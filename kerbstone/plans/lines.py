"""Polylines, grids, coverage, the road network and linear referencing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import geometry as G
from ..operators import coverage, match, network
from ..sources.tables import table
from . import fixture

QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _line(e: str = "embedding", scale: float = 1.0) -> Column:
    """A vector as a polyline of its consecutive pairs."""
    return F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct((F.col(e)[2 * i].cast("double") * scale).alias("x"), (F.col(e)[2 * i + 1].cast("double") * scale).alias("y")))


_X, _Y = "embedding[2 * i + 1]::double", "embedding[2 * i + 2]::double"


@query
def polyline_length(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.round(G.length(_line()), 9).alias("length"))


SQL["polyline_length"] = "select vec_id, round(list_sum([sqrt((embedding[2 * i + 3]::double - embedding[2 * i + 1]::double) ** 2 + (embedding[2 * i + 4]::double - embedding[2 * i + 2]::double) ** 2) for i in range(31)]), 9) as length from embeddings"


@query
def quantize_delta(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", G.quantised(_line()).alias("flat")).select("vec_id", F.posexplode("flat").alias("nth", "step"))


SQL["quantize_delta"] = f"""with q as (select vec_id, flatten([[round_even({_X} * 100000, 0)::bigint, round_even({_Y} * 100000, 0)::bigint] for i in range(32)]) as v from embeddings),
s as (select vec_id, [v[k] - case when k > 2 then v[k - 2] else 0 end for k in range(1, 65)] as flat from q)
select vec_id, unnest(range(64))::int as nth, unnest(flat) as step from s"""


@query
def decode_delta(spark: SparkSession, d: str) -> DataFrame:
    """The points that decoding gives back: the quantised ones."""
    back = table(spark, d, "embeddings").select("vec_id", F.posexplode(G.dequantised(G.quantised(_line()))).alias("nth", "p"))
    return back.select("vec_id", "nth", F.round("p.x", 9).alias("x"), F.round("p.y", 9).alias("y"))


SQL["decode_delta"] = f"select vec_id, unnest(range(32))::int as nth, unnest([round(round_even({_X} * 100000, 0) / 100000 + 0.0, 9) for i in range(32)]) as x, unnest([round(round_even({_Y} * 100000, 0) / 100000 + 0.0, 9) for i in range(32)]) as y from embeddings"


@query
def interpolated(spark: SparkSession, d: str) -> DataFrame:
    """The middle of every line, and where a point beside it projects to it."""
    rows = table(spark, d, "embeddings").select("vec_id", _line().alias("l"))
    middle, near = G.interpolate(F.col("l"), F.lit(0.5), normalised=True), G.project(F.col("l"), F.lit(0.05), F.lit(-0.02))
    return rows.select("vec_id", middle.alias("m"), near.alias("p")).select("vec_id", F.round("m.x", 8).alias("mx"), F.round("m.y", 8).alias("my"), F.round("p.gap", 8).alias("gap"), F.round("p.at", 8).alias("at"))


SQL["interpolated"] = f"""with p as (select vec_id, unnest(range(32)) as i, unnest([{_X} for i in range(32)]) as x, unnest([{_Y} for i in range(32)]) as y from embeddings),
s as (select vec_id, i, x as ax, y as ay, lead(x) over w as bx, lead(y) over w as by_ from p window w as (partition by vec_id order by i)),
l as (select *, sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) as len, greatest(0, least(1, ((0.05 - ax) * (bx - ax) + (-0.02 - ay) * (by_ - ay)) / ((bx - ax) ** 2 + (by_ - ay) ** 2))) as t from s where bx is not null),
c as (select *, sum(len) over (partition by vec_id order by i) - len as before, sum(len) over (partition by vec_id) / 2 as half, sqrt((0.05 - ax - t * (bx - ax)) ** 2 + (-0.02 - ay - t * (by_ - ay)) ** 2) as gap from l),
m as (select vec_id, arg_max(ax + (half - before) / len * (bx - ax), i) as mx, arg_max(ay + (half - before) / len * (by_ - ay), i) as my from c where before <= half group by vec_id),
g as (select vec_id, min(gap) as gap, arg_min(before + t * len, (gap, i)) as at from c group by vec_id)
select vec_id, round(mx, 8) as mx, round(my, 8) as my, round(gap, 8) as gap, round(g.at, 8) as "at" from m join g using (vec_id)""".replace(" as at from c", " as at_ from c").replace("g.at,", "at_,")


@query
def projected(spark: SparkSession, d: str) -> DataFrame:
    """Degrees to metres to the millimetre, and whether they come back."""
    rows = table(spark, d, "embeddings").select("vec_id", (F.lit(-122.27) + F.col("embedding")[0].cast("double") / 10).alias("lon"), (F.lit(37.87) + F.col("embedding")[1].cast("double") / 10).alias("lat"))
    there = rows.select("*", G.to_utm(F.col("lon"), F.col("lat")).alias("m"))
    back = there.select("*", G.to_degrees(F.col("m.x"), F.col("m.y")).alias("g"))
    return back.select("vec_id", F.round("m.x", 3).alias("x"), F.round("m.y", 3).alias("y"), F.round("g.x", 9).alias("lon"), F.round("g.y", 9).alias("lat"))


# the meridian distance and the series in powers of the difference of longitude (not the series of the operator)
SQL["projected"] = """with c as (select 6378137.0 as a, 2 / 298.257222101 - (1 / 298.257222101) ** 2 as e2),
r as (select vec_id, -122.27 + embedding[1]::double / 10 as lon, 37.87 + embedding[2]::double / 10 as lat, a, e2, e2 / (1 - e2) as ep from embeddings, c),
q as (select *, radians(lat) as p, tan(radians(lat)) ** 2 as t, ep * cos(radians(lat)) ** 2 as c2, radians(lon + 123) * cos(radians(lat)) as w, a / sqrt(1 - e2 * sin(radians(lat)) ** 2) as nn from r),
m as (select *, a * ((1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256 - 175 * e2 ** 4 / 16384) * p - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024 + 105 * e2 ** 4 / 4096) * sin(2 * p) + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024 + 525 * e2 ** 4 / 16384) * sin(4 * p) - (35 * e2 ** 3 / 3072 + 175 * e2 ** 4 / 12288) * sin(6 * p) + 315 * e2 ** 4 / 131072 * sin(8 * p)) as md from q)
select vec_id, round(500000 + 0.9996 * nn * (w + (1 - t + c2) * w ** 3 / 6 + (5 - 18 * t + t ** 2 + 14 * c2 - 58 * t * c2 + 13 * c2 ** 2 - 64 * c2 ** 2 * t) * w ** 5 / 120 + (61 - 479 * t + 179 * t ** 2 - t ** 3) * w ** 7 / 5040), 3) as x,
  round(0.9996 * (md + nn * sqrt(t) * (w ** 2 / 2 + (5 - t + 9 * c2 + 4 * c2 ** 2) * w ** 4 / 24 + (61 - 58 * t + t ** 2 + 270 * c2 - 330 * t * c2 + 445 * c2 ** 2 - 680 * t * c2 ** 2) * w ** 6 / 720 + (1385 - 3111 * t + 543 * t ** 2 - t ** 3) * w ** 8 / 40320)), 3) as y, round(lon, 9) as lon, round(lat, 9) as lat from m"""


@query
def wkt_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of one part and of two, all points."""
    one, two = F.array(_line()), F.array(F.slice(_line(), 1, 16), F.slice(_line(), 17, 16))
    return table(spark, d, "embeddings").select("vec_id", F.when(F.col("vec_id") % 2 == 0, G.wkt(one)).otherwise(G.wkt(two)).alias("wkt"))


SQL["wkt_lines"] = f"""with t as (select vec_id, [format('{{:.6f}} {{:.6f}}', {_X}, {_Y}) for i in range(32)] as p from embeddings)
select vec_id, case when vec_id % 2 = 0 then 'LINESTRING (' || array_to_string(p, ', ') || ')' else 'MULTILINESTRING ((' || array_to_string(p[1:16], ', ') || '), (' || array_to_string(p[17:32], ', ') || '))' end as wkt from t"""


@query
def distance_join(spark: SparkSession, d: str) -> DataFrame:
    """Points of some vectors within 0.01 of segments of others."""
    e = table(spark, d, "embeddings")
    points = e.select(F.col("vec_id").alias("point"), F.col("embedding")[0].cast("double").alias("px"), F.col("embedding")[1].cast("double").alias("py"))
    segments = e.select(F.col("vec_id").alias("segment"), *[F.col("embedding")[k].cast("double").alias(c) for k, c in enumerate(("ax", "ay", "bx", "by"), 2)])
    return coverage.points_near_segments(points, segments, 0.01).select("point", "segment", F.round("distance", 9).alias("distance"))


SQL["distance_join"] = """with p as (select vec_id as point, embedding[1]::double as px, embedding[2]::double as py from embeddings), s as (select vec_id as segment, embedding[3]::double as ax, embedding[4]::double as ay, embedding[5]::double as bx, embedding[6]::double as by_ from embeddings),
t as (select *, greatest(0, least(1, coalesce(((px - ax) * (bx - ax) + (py - ay) * (by_ - ay)) / nullif((bx - ax) ** 2 + (by_ - ay) ** 2, 0), 0))) as t from p, s), g as (select point, segment, sqrt((px - ax - t * (bx - ax)) ** 2 + (py - ay - t * (by_ - ay)) ** 2) as g from t)
select point, segment, round(g, 9) as distance from g where g <= 0.01"""


def _streets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Parts as lines along x, suppliers as cover at their own heights, with a tier."""
    lines = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.lit(0).alias("seg"), (F.col("p_partkey") * 37 % 1000).cast("double").alias("ax"), (F.col("p_partkey") * 91 % 500).cast("double").alias("ay"), (F.col("p_partkey") * 37 % 1000 + F.col("p_size") * 4).cast("double").alias("bx"))
    lines = lines.withColumn("by", F.col("ay"))
    cover = table(spark, d, "supplier").select(F.when(F.col("s_nationkey") % 2 == 0, "painted").otherwise("shared").alias("tier"), (F.col("s_suppkey") * 53 % 1000).cast("double").alias("ax"), (F.col("s_suppkey") * 29 % 500).cast("double").alias("ay"), (F.col("s_suppkey") * 53 % 1000 + F.col("s_nationkey") * 9 + 1).cast("double").alias("bx"))
    return lines, cover.withColumn("by", F.col("ay"))


_STREETS = """l as (select p_partkey as id, (p_partkey * 37 % 1000)::double as ax, (p_partkey * 91 % 500)::double as y, (p_size * 4)::double as len from part),
c as (select distinct case when s_nationkey % 2 = 0 then 'painted' else 'shared' end as tier, (s_suppkey * 53 % 1000)::double as cx, (s_suppkey * 29 % 500)::double as cy, (s_suppkey * 53 % 1000 + s_nationkey * 9 + 1)::double as dx from supplier),
i as (select id, tier, len, greatest(ax, cx - sqrt(144 - (y - cy) ** 2)) as a, least(ax + len, dx + sqrt(144 - (y - cy) ** 2)) as b from l join c on abs(y - cy) <= 12 and ax <= dx + sqrt(144 - (y - cy) ** 2) and ax + len >= cx - sqrt(144 - (y - cy) ** 2)),
m as (select *, greatest(0, b - greatest(a, coalesce(max(b) over (partition by id, tier order by a, b rows between unbounded preceding and 1 preceding), a))) as new from i),
k as (select id, tier, any_value(len) as len, sum(new) as covered from m group by id, tier)"""


@query
def coverage_len(spark: SparkSession, d: str) -> DataFrame:
    """Metres of each line within 12 of the cover, by tier."""
    lines, cover = _streets(spark, d)
    return coverage.covered(lines, cover, 12.0, ["tier"]).select("id", "tier", F.round("covered", 6).alias("covered"))


SQL["coverage_len"] = f"with {_STREETS} select id, tier, round(covered, 6) as covered from k where covered > 0"


@query
def coverage_tag(spark: SparkSession, d: str) -> DataFrame:
    """The best tier that covers more than half of a line."""
    from ..operators.sequences import priority_tag

    lines, cover = _streets(spark, d)
    lengths = lines.select("id", (F.col("bx") - F.col("ax")).alias("length"))
    return priority_tag(coverage.covered_more_than(lines, lengths, cover, 12.0, 0.5, ["tier"]), ["id"], "tier", ["protected", "painted", "shared"])


SQL["coverage_tag"] = f"with {_STREETS} select id, min(tier) as tier from k where covered > 0.5 * len group by id"


@query
def point_in_poly(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return coverage.in_first_polygon(rows, "x", "y", [("inner", [(0.0, 0.0), (0.15, 0.02), (0.1, 0.2), (-0.05, 0.1)]), ("outer", [(-0.1, -0.1), (0.2, -0.1), (0.2, 0.2), (-0.1, 0.2)])], "city").select("vec_id", "city")


def _ray_sql(ring: list[tuple[float, float]]) -> str:
    return "(" + " + ".join(f"(case when ({y1} > y) <> ({y2} > y) and x < ({x2 - x1}) * (y - ({y1})) / ({(y2 - y1) or 1.0}) + ({x1}) then 1 else 0 end)" for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True)) + ") % 2 = 1"


SQL["point_in_poly"] = f"""select vec_id, city from (select vec_id, case when {_ray_sql([(0.0, 0.0), (0.15, 0.02), (0.1, 0.2), (-0.05, 0.1)])} then 'inner' when {_ray_sql([(-0.1, -0.1), (0.2, -0.1), (0.2, 0.2), (-0.1, 0.2)])} then 'outer' end as city
from (select vec_id, embedding[1]::double as x, embedding[2]::double as y from embeddings)) where city is not null"""


@query
def grid_snap(spark: SparkSession, d: str) -> DataFrame:
    """Snapped cells with the first point seen in each."""
    p = table(spark, d, "embeddings").select("vec_id", F.struct((F.col("embedding")[0].cast("double") * 100).alias("x"), (F.col("embedding")[1].cast("double") * 100).alias("y")).alias("p"))
    cells = p.select("vec_id", "p", network.node_key(F.col("p")).alias("k")).groupBy("k").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    return cells.select("k.i", "k.j", "n", "first")


SQL["grid_snap"] = "select round_even(embedding[1]::double * 100 / 2, 0)::bigint as i, round_even(embedding[2]::double * 100 / 2, 0)::bigint as j, count(*) as n, min(vec_id) as first from embeddings group by 1, 2"


def _grid(spark: SparkSession, d: str) -> DataFrame:
    """Nations as nodes of a 5 by 5 grid; each row is a street of its region's name, and columns cross them."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_regionkey")
    point = lambda i: F.struct((F.pmod(i, F.lit(5)) * 100.0).alias("x"), (F.floor(i / 5) * 100.0).alias("y"))
    k = F.col("k")
    across = n.where("k % 5 < 4").select(k.cast("long").alias("line"), F.concat(F.lit("ROW "), F.floor(k / 5).cast("string"), F.lit(" ST")).alias("FULLNAME"), F.array(point(k), point(k + 1)).alias("pts"))
    up = n.where("k < 20").select((k + 100).cast("long").alias("line"), F.concat(F.lit("COL "), F.pmod(k, F.lit(5)).cast("string"), F.lit(" AVE")).alias("FULLNAME"), F.array(point(k), point(k + 5)).alias("pts"))
    return across.unionByName(up)


@query
def node_degree(spark: SparkSession, d: str) -> DataFrame:
    """Degrees of nodes within each street's own edges."""
    edges = network.edges_of(_grid(spark, d).withColumnRenamed("FULLNAME", "name"))
    return network.degrees(edges).select("name", F.col("node.i").alias("i"), F.col("node.j").alias("j"), "degree")


SQL["node_degree"] = """with e as (select 'ROW ' || (n_nationkey // 5) || ' ST' as name, n_nationkey as a, n_nationkey + 1 as b from nation where n_nationkey % 5 < 4 union all select 'COL ' || (n_nationkey % 5) || ' AVE', n_nationkey, n_nationkey + 5 from nation where n_nationkey < 20),
x as (select name, a as n from e union all select name, b from e) select name, (n % 5 * 50)::bigint as i, (n // 5 * 50)::bigint as j, count(*) as degree from x group by name, n"""


@query
def node_names(spark: SparkSession, d: str) -> DataFrame:
    """The streets that meet at each node."""
    edges = network.edges_of(_grid(spark, d).withColumnRenamed("FULLNAME", "name"))
    return network.node_names(edges).select(F.col("node.i").alias("i"), F.col("node.j").alias("j"), F.array_join("names", "|").alias("names"))


SQL["node_names"] = "select (n_nationkey % 5 * 50)::bigint as i, (n_nationkey // 5 * 50)::bigint as j, 'COL ' || (n_nationkey % 5) || ' AVE|ROW ' || (n_nationkey // 5) || ' ST' as names from nation"


@query
def noded_lines(spark: SparkSession, d: str) -> DataFrame:
    """One long street cut where short ones end beside it."""
    k = F.col("n_nationkey")
    long = spark.createDataFrame([(1000, "ELM ST", [(0.0, 0.0), (1250.0, 0.0), (2600.0, 0.0)])], "line long, name string, pts array<struct<x:double,y:double>>")
    side = table(spark, d, "nation").select(k.cast("long").alias("line"), F.concat(F.lit("SIDE "), k.cast("string")).alias("name"), F.array(F.struct((k * 100.0 + 50).alias("x"), (F.pmod(k, F.lit(5)) * 0.75).alias("y")), F.struct((k * 100.0 + 50).alias("x"), F.lit(80.0).alias("y"))).alias("pts"))
    pieces = network.noded(long.unionByName(side)).where("line = 1000")
    return pieces.select("piece", F.round(G.length(F.col("pts")), 6).alias("length"))


SQL["noded_lines"] = """with c as (select 0.0::double as pos union all select n_nationkey * 100 + 50 from nation where (n_nationkey % 5) * 0.75 <= 2 union all select 2600)
select (row_number() over (order by pos) - 1)::int as piece, round(size, 6) as length from (select pos, lead(pos) over (order by pos) - pos as size from c) where size is not null"""


@query
def gap_bridge(spark: SparkSession, d: str) -> DataFrame:
    """Streets in pieces 15 apart are bridged, those 31 apart are not."""
    k = F.col("n_nationkey")
    start = F.when(F.col("n_regionkey") % 2 == 0, 115.0).otherwise(131.0)
    y = k * 500.0
    rows = table(spark, d, "nation").select((k * 2).cast("long").alias("line"), F.concat(F.col("n_name"), F.lit(" ST")).alias("name"), F.array(F.struct(F.lit(0.0).alias("x"), y.alias("y")), F.struct(F.lit(100.0).alias("x"), y.alias("y"))).alias("pts"))
    more = table(spark, d, "nation").select((k * 2 + 1).cast("long").alias("line"), F.concat(F.col("n_name"), F.lit(" ST")).alias("name"), F.array(F.struct(start.alias("x"), y.alias("y")), F.struct((start + 100).alias("x"), y.alias("y"))).alias("pts"))
    edges = network.edges_of(rows.unionByName(more))
    made = network.bridged(edges, network.node_names(edges))
    return made.groupBy("name").agg(F.count("*").alias("edges"), F.round(F.sum("w"), 6).alias("length"))


SQL["gap_bridge"] = "select n_name || ' ST' as name, case when n_regionkey % 2 = 0 then 3 else 2 end::bigint as edges, case when n_regionkey % 2 = 0 then 215.0 else 200.0 end::double as length from nation"


@query
def shortest_path(spark: SparkSession, d: str) -> DataFrame:
    """Ways along one street that branches: the grid without every seventh row edge and sixth column edge, so that most ways are detours."""
    edges = network.edges_of(_grid(spark, d).where("not (line < 100 and line % 7 = 3) and not (line >= 100 and line % 6 = 1)").withColumn("name", F.lit("GRID ST")).drop("FULLNAME"))
    return network.distances(edges)


SQL["shortest_path"] = """with recursive e as (select n_nationkey as a, n_nationkey + 1 as b from nation where n_nationkey % 5 < 4 and n_nationkey % 7 <> 3 union all select n_nationkey, n_nationkey + 5 from nation where n_nationkey < 20 and (n_nationkey + 100) % 6 <> 1),
x as (select a, b from e union all select b, a from e),
w as (select 0::bigint as n, 0 as length union select x.b, w.length + 100 from w join x on x.a = w.n where w.length < 2400)
select 'GRID ST' as name, (n % 5 * 50)::bigint || ',' || (n // 5 * 50)::bigint as node, min(length)::double as length from w group by n"""


@query
def components(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of every street before its gaps are bridged."""
    return network.components(network.edges_of(fixture.streets(spark, d).withColumnRenamed("FULLNAME", "name")))


SQL["components"] = """with s as (select s_suppkey as s, unnest(range(9)) as i from supplier),
n as (select 'B' || s || ' ST' as name, s, i * 100 as x, case when s % 5 in (1, 2) and i > 4 then 1 else 0 end as piece from s union all select 'B' || s || ' ST', s, 415, 1 from s where i = 0 and s % 5 = 2),
k as (select name, piece, round_even(x / 2, 0)::bigint || ',' || (s * 500) as node from n),
c as (select name, node, min(node) over (partition by name, piece) as component from k),
x as (select 'C' || s || 'X' || case when s % 5 = 3 and i = 6 then 2 else i end || ' AVE' as name, (i * 50) || ',' || (s * 500) as a, (i * 50) || ',' || (s * 500 + 25) as b from s)
select * from c union all select name, unnest([a, b]) as node, least(a, b) as component from x"""


def _shown(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select("row_id", "ok", "reason", "method", "length_err", "matched_ft", F.round(F.get("xs", F.lit(0)), 2).alias("x0"), F.round(F.element_at("xs", -1), 2).alias("x1"), *more)


@query
def linref_match(spark: SparkSession, d: str) -> DataFrame:
    """A record for every customer, placed on the streets of all suppliers."""
    return _shown(match.match_rows(fixture.records(spark, d), network.network(fixture.streets(spark, d))))


SQL["linref_match"] = fixture.MATCH_SQL


@query
def linref_two_pass(spark: SparkSession, d: str) -> DataFrame:
    """The same, where records that could lie on either side are tried again beside what the first pass placed."""
    return _shown(match.match_two_pass(fixture.records(spark, d), network.network(fixture.streets(spark, d))), "pass")


SQL["linref_two_pass"] = fixture.TWO_PASS_SQL


@query
def simplify(spark: SparkSession, d: str) -> DataFrame:
    """Points that stay of every line at a tolerance of 0.2; the first and the last always do."""
    from ..functions.simplify import simplified

    pairs = F.sequence(F.lit(0), F.lit(31))
    xs, ys = F.transform(pairs, lambda i: F.col("embedding")[2 * i].cast("double")), F.transform(pairs, lambda i: F.col("embedding")[2 * i + 1].cast("double"))
    return table(spark, d, "embeddings").select("vec_id", F.explode(simplified(0.2)(xs, ys)).alias("point"))


SQL["simplify"] = f"""with recursive p as materialized (select vec_id, unnest(range(32)) as i, unnest([{_X} for i in range(32)]) as x, unnest([{_Y} for i in range(32)]) as y from embeddings),
r as (select vec_id, 0::bigint as lo, 31::bigint as hi from embeddings
  union all select vec_id, case s when 0 then lo else k end, case s when 0 then k else hi end from (
    select vec_id, lo, hi, arg_max(i, (gap, -i)) as k from (
      select r.vec_id, r.lo, r.hi, p.i, sqrt((p.x - a.x - t.t * (b.x - a.x)) ** 2 + (p.y - a.y - t.t * (b.y - a.y)) ** 2) as gap
      from r join p a on a.vec_id = r.vec_id and a.i = r.lo join p b on b.vec_id = r.vec_id and b.i = r.hi join p on p.vec_id = r.vec_id and p.i > r.lo and p.i < r.hi,
        lateral (select greatest(0, least(1, ((p.x - a.x) * (b.x - a.x) + (p.y - a.y) * (b.y - a.y)) / ((b.x - a.x) ** 2 + (b.y - a.y) ** 2))) as t) t
    ) group by vec_id, lo, hi having max(gap) > 0.2), (values (0), (1)) v(s))
select distinct vec_id, unnest([lo, hi])::int as point from r"""


def _bikes(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as bikeways of two cities and four sources."""
    k = F.col("s_suppkey")
    y = (F.pmod(k, F.lit(10)) * 40 + F.floor(k / 10) % 3 * 8).cast("double")
    return table(spark, d, "supplier").select(
        k.cast("long").alias("id"), F.when(k % 2 == 0, "Berkeley").otherwise("Oakland").alias("city"), F.element_at(F.array(*map(F.lit, K.MERGE_ORDER)), (F.floor(k / 10) % 4 + 1).cast("int")).alias("source"),
        F.lit("existing").alias("status"), F.when(F.col("s_nationkey") % 3 == 0, "I").when(F.col("s_nationkey") % 3 == 1, "II").otherwise("III").alias("bikeway_class"), F.col("s_name").alias("street"),
        F.array(F.struct(F.lit(0.0).alias("x"), y.alias("y")), F.struct((F.lit(60.0) + F.col("s_nationkey") * 5).alias("x"), y.alias("y"))).alias("pts"),
    )


#: The suppliers' bikeways as horizontal lines from x = 0: their height, length, tier and rank of source.
_BIKES = """bikes as (select s_suppkey as id, case when s_suppkey % 2 = 0 then 'Berkeley' else 'Oakland' end as city, (s_suppkey % 10 * 40 + s_suppkey // 10 % 3 * 8)::double as y, (60 + s_nationkey * 5)::double as len,
  s_suppkey // 10 % 4 as m, s_nationkey % 3 as c from supplier)"""


@query
def greedy_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Bikeways that no section and no better one kept before them accounts for."""
    from ..operators import bikeways

    bikes = _bikes(spark, d)
    sections = bikes.where("id % 7 = 0").select((F.col("id") + 100000).alias("id"), "city", "pts")
    return bikeways.off_street(bikes, bikeways.tagged(sections, bikes)).select("id", "city", "tier", "miles")


SQL["greedy_dedup"] = f"""with recursive {_BIKES},
open as (select *, row_number() over (partition by city order by c, [2, 3, 4, 5][m + 1], id) as n from bikes b where not exists (select 1 from bikes s where s.id % 7 = 0 and s.city = b.city and abs(s.y - b.y) <= 12 and least(b.len, s.len + sqrt(144 - (s.y - b.y) ** 2)) > 0.6 * b.len)),
g as (select distinct city, 0::bigint as n, []::struct(y double, len double)[] as kept, null::bigint as id from open
  union all select o.city, o.n, case when o.fits then list_append(o.kept, {{'y': o.y, 'len': o.len}}) else o.kept end, case when o.fits then o.id end
  from (select p.*, g.kept, coalesce(list_max([case when abs(k.y - p.y) <= 15 then least(p.len, k.len + sqrt(225 - (k.y - p.y) ** 2)) end for k in g.kept]), 0) <= 0.6 * p.len as fits from g join open p on p.city = g.city and p.n = g.n + 1) o)
select id, city, ['protected', 'painted', 'shared'][c + 1] as tier, round_even(len / 1609.344, 3) as miles from g join bikes using (id, city)"""


@query
def merged_miles(spark: SparkSession, d: str) -> DataFrame:
    """Miles that each source adds beyond 15 of those trusted more, in each city."""
    from ..operators import bikeways

    found = bikeways.merged_miles(_bikes(spark, d), by="city")
    return found.select("city", "source", F.round("alone", 6).alias("alone"), F.round("adds", 6).alias("adds"), F.round("running", 6).alias("running"))


def _merged_sql(keys: str, using: str) -> str:
    return f"""merged as (select {keys}, m, sum(len) / 1609.344 as alone, sum(len - coalesce((select max(least(b.len, o.len + sqrt(225 - (o.y - b.y) ** 2))) from bikes o where o.m < b.m and abs(o.y - b.y) <= 15{using}), 0)) / 1609.344 as adds from bikes b group by {keys}, m)"""


_SOURCES = "[" + ", ".join(f"'{s}'" for s in K.MERGE_ORDER) + "]"
SQL["merged_miles"] = f"with {_BIKES}, {_merged_sql('city', ' and o.city = b.city')} select city, {_SOURCES}[m + 1] as source, round(alone, 6) as alone, round(adds, 6) as adds, round(sum(adds) over (partition by city order by m), 6) as running from merged"


@query
def merge_table(spark: SparkSession, d: str) -> DataFrame:
    """The merge by class and for any class, beside what a plan states for each class."""
    from ..operators import bikeways

    found = bikeways.merge_table(_bikes(spark, d), {"I": 2.0, "III": 1.5, "Total": 4.0})
    return found.select("bikeway_class", "source", *[F.round(c, 6).alias(c) for c in ("alone", "adds", "running", "target", "share")])


SQL["merge_table"] = f"""with {_BIKES}, {_merged_sql('c', ' and o.c = b.c')}, total as (select -1 as c, * exclude (c) from ({_merged_sql('0 as c', '').removeprefix('merged as (').removesuffix(')').replace('group by 0 as c, m', 'group by m')})),
u as (select ['any', 'I', 'II', 'III'][c + 2] as bikeway_class, * exclude (c) from (select * from merged union all select * from total)),
w as (select *, sum(adds) over (partition by bikeway_class order by m) as running, sum(adds) over (partition by bikeway_class) as merged, case bikeway_class when 'I' then 2.0 when 'III' then 1.5 when 'any' then 4.0 end::double as target from u)
select bikeway_class, {_SOURCES}[m + 1] as source, round(alone, 6) as alone, round(adds, 6) as adds, round(running, 6) as running, target, round(merged / target, 6) as share from w"""
