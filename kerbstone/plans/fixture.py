"""A road network and records on it, made from suppliers and customers, and their closed-form placement in SQL.

Every supplier is a straight street of eight blocks of 100 m with a cross street at each corner. Of five streets one lacks
its fifth block, one has a gap of 15 m that is bridged, and one meets the same cross street twice. Every customer is a
record on one of them: between corners, to an end, beside a corner, by a name of another kind, to streets that aren't there,
on streets that aren't there, with lengths that fit, nearly fit or don't, or with none. Of seven streets one is quiet: its
records lie on its first half, or go out from its middle without saying which way, which the second pass can tell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..sources.tables import table

FT = K.FT_PER_M


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _cross(s: Column, i: Column) -> Column:
    """The name of the i-th cross street, without its suffix."""
    return F.concat(F.lit("C"), s.cast("string"), F.lit("X"), F.when((s % 5 == 3) & (i == 6), F.lit(2)).otherwise(i).cast("string"))


def streets(spark: SparkSession, d: str) -> DataFrame:
    """(line, FULLNAME, pts)."""
    s, i = F.col("s_suppkey").cast("long"), F.col("i").cast("long")
    y = s * 1000
    blocks = table(spark, d, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("i")).where(~((s % 5 == 1) & (i == 4)))
    start = i * 100 + F.when((s % 5 == 2) & (i == 4), 15).otherwise(0)
    along = blocks.select((s * 100 + i).alias("line"), F.concat(F.lit("B"), s.cast("string"), F.lit(" ST")).alias("FULLNAME"), F.array(_point(start, y), _point(i * 100 + 100, y)).alias("pts"))
    corners = table(spark, d, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("i"))
    across = corners.select((s * 100 + 50 + i).alias("line"), F.concat(_cross(s, i), F.lit(" AVE")).alias("FULLNAME"), F.array(_point(i * 100, y), _point(i * 100, y + 50)).alias("pts"))
    return along.unionByName(across)


def records(spark: SparkSession, d: str) -> DataFrame:
    """(row_id, street_name, beg_location, end_location, length_ft)."""
    n = table(spark, d, "supplier").agg(F.count("*").alias("n"))
    c = F.col("c_custkey").cast("long")
    rows = table(spark, d, "customer").crossJoin(F.broadcast(n)).select(c.alias("row_id"), (c % (F.col("n") + 2)).alias("s"), (F.floor(c / 7) % 9).alias("i"), ((F.floor(c / 63) + c) % 9).alias("j"), (F.floor(c / 3) % 10).alias("kind"))  # n is one row
    quiet, alone = F.col("s") % 7 == 0, F.floor(F.col("row_id") / 7) % 3 == 0
    rows = rows.withColumns({"i": F.when(quiet, F.when(alone, 4).otherwise(F.floor(F.col("row_id") / 7) % 4)).otherwise(F.col("i")), "kind": F.when(quiet, F.when(alone, 4).otherwise(0)).otherwise(F.col("kind"))})
    rows = rows.withColumn("j", F.when(quiet, F.when(alone, F.floor(F.col("row_id") / 63) % 2).otherwise(F.col("i") + 1)).otherwise(F.col("j")))
    k, s, i, j = (F.col(x) for x in ("kind", "s", "i", "j"))
    own, other = _cross(s, i), _cross(s, j)
    beg = F.when(k == 6, "NOWHERE RD").when(k == 7, F.concat(F.lit("50 FT NO "), own, F.lit(" AVE"))).when(k == 8, F.concat(own, F.lit(" WAY"))).otherwise(F.concat(own, F.lit(" AV")))
    end = F.when(k == 3, "DEAD END").when(k == 4, "NOWHERE RD").when(k == 6, "ELSEWHERE RD").when(k == 8, F.concat(other, F.lit(" WAY"))).when(k == 9, F.concat(F.lit("CITY LIMIT ("), own, F.lit(" AVE)"))).otherwise(F.concat(other, F.lit(" AVENUE")))
    metres = F.when(k.isin(0, 8), F.abs(i - j) * 100).when(k == 1, F.abs(i - j) * 150).when(k == 2, F.abs(i - j) * 200).when(k.isin(3, 4, 9), (j + 1) * 100).when(k == 6, 100).when(k == 7, F.abs(i - j) * 70)
    return rows.select("row_id", F.concat(F.lit("B"), s.cast("string"), F.when(F.col("row_id") % 11 == 0, " AVE").otherwise(" ST")).alias("street_name"), beg.alias("beg_location"), end.alias("end_location"), F.floor(metres * 328 / 100).cast("double").alias("length_ft"))


#: The placement of the records by position along their street: anchors, routes, walks and what is chosen of them.
PLACED = f"""
n as (select count(*) as n from supplier),
r9 as (select c_custkey as row_id, c_custkey % (n + 2) as s, c_custkey // 7 % 9 as i, (c_custkey // 63 + c_custkey) % 9 as j, c_custkey // 3 % 10 as kind, n from customer, n),
r8 as (select * replace (case when s % 7 <> 0 then i when row_id // 7 % 3 = 0 then 4 else row_id // 7 % 4 end as i, case when s % 7 <> 0 then kind when row_id // 7 % 3 = 0 then 4 else 0 end as kind) from r9),
r0 as (select * replace (case when s % 7 <> 0 then j when row_id // 7 % 3 = 0 then row_id // 63 % 2 else i + 1 end as j) from r8),
r1 as (select *, 'B' || s || case when row_id % 11 = 0 then ' AVE' else ' ST' end as name, s < n as there, kind = 7 as beg_soft, kind in (3, 9) as end_soft,
  nullif(case when kind in (0, 8) then abs(i - j) * 100 when kind = 1 then abs(i - j) * 150 when kind = 2 then abs(i - j) * 200 when kind in (3, 4, 9) then (j + 1) * 100 when kind = 6 then 100 when kind = 7 then abs(i - j) * 70 end * 328 // 100, 0) / {FT} as t,
  case when s % 5 = 3 and i in (2, 6) then [200, 600] else [i * 100] end as ai, case when s % 5 = 3 and j in (2, 6) then [200, 600] else [j * 100] end as aj, case when s % 5 = 1 then [0, 400, 500, 800] else [0, 800] end as ends from r0),
r as (select *, case when kind = 6 then [] when kind = 7 and ai = aj then ends else ai end as bs, case when kind in (3, 9) then ends when kind in (4, 6) then [] else aj end as es from r1),
ab as (select row_id, s, t, beg_soft, end_soft, a, unnest(es) as b from (select *, unnest(bs) as a from r where there)),
routes as (select *, abs(a - b)::double as d, (a // 2) || ',' || (s * 500) as ka, (b // 2) || ',' || (s * 500) as kb from ab where a <> b and not (s % 5 = 1 and (a >= 500) <> (b >= 500))),
ranked as (select *, row_number() over (partition by row_id order by case when (beg_soft or end_soft) and d < 0.98 * t then 1 else 0 end, case when t is null or ((beg_soft or end_soft) and d >= 0.98 * t) then d else abs(d - t) end, ka, kb) as k from routes),
cut as (select *, (beg_soft or end_soft) and d > 1.02 * t as trimmed, sign(b - a) as dir from ranked where k = 1),
routed as (select row_id, t, case when trimmed then t else d end as size, case when trimmed then 'trimmed' else 'cross-streets' end as method,
  case when trimmed and beg_soft then b - dir * t else a end::double as x0, case when trimmed and not beg_soft then a + dir * t else b end::double as x1 from cut),
r_out as (select row_id, abs(size - t) / t as err, * exclude (row_id) from routed),
nodes as (select s_suppkey as s, unnest(case when s_suppkey % 5 = 2 then [0, 100, 200, 300, 400, 415, 500, 600, 700, 800] else [0, 100, 200, 300, 400, 500, 600, 700, 800] end) as x from supplier),
starts as (select row_id, name, s, t, 0 as side, unnest(bs) as a from r where there and t is not null union all select row_id, name, s, t, 1, unnest(es) from r where there and t is not null),
w0 as (select st.*, sign(x - a) as dir, abs(x - a)::double as d from starts st join nodes using (s) where x <> a and not (s % 5 = 1 and (a >= 500) <> (x >= 500)) and abs(x - a) >= 0.9 * t and row_id not in (select row_id from routes)),
ways as (select row_id, name, side, a, dir, t, (a // 2) || ',' || (s * 500) as ka, arg_min(d, (abs(d - t) / t, d)) as d from w0 group by all having min(abs(d - t) / t) <= 0.35),
lone as (select row_id, side, ka, any_value(a) as a, any_value(dir) as dir, any_value(t) as t, any_value(d) as d from ways group by row_id, side, ka having count(*) = 1),
walked as (select *, row_number() over (partition by row_id order by side, ka) as k from lone),
p1 as (select r.row_id, r.name, case when not there then false when q.row_id is not null then q.t is null or q.err <= 0.35 else v.row_id is not null end as ok,
  case when not there then 'street name not in centerlines' when q.row_id is not null then case when q.t is null or q.err <= 0.35 then 'ok' else 'length mismatch (' || round_even(q.err * 100, 0)::int || '%)' end
    when v.row_id is not null then 'ok' when len(bs) = 0 then 'begin cross street not found on street' when len(es) = 0 then 'end cross street not found on street' else 'no path between cross streets along this street' end as reason,
  case when q.row_id is not null then q.method when v.row_id is not null then 'one-ended walk' end as method,
  case when q.row_id is not null then round_even(q.err, 3) when v.row_id is not null then 0.0 end as length_err,
  case when q.row_id is not null then round_even(q.size * {FT}, 0) when v.row_id is not null then round_even(v.t * {FT}, 0) end::bigint as matched_ft,
  case when q.row_id is not null then case when q.t is null or q.err <= 0.35 then q.x0 end else v.a end as x0,
  case when q.row_id is not null then case when q.t is null or q.err <= 0.35 then q.x1 end else v.a + v.dir * least(v.t, v.d) end as x1
  from r left join r_out q using (row_id) left join (select * from walked where k = 1) v using (row_id))
"""

_SHOWN = "row_id, ok, reason, method, length_err, matched_ft, round(x0, 2)::double as x0, round(x1, 2)::double as x1"

MATCH_SQL = f"with {PLACED} select {_SHOWN} from p1"

#: The second pass: of several ways out of a corner, those that first-pass lines of the same name mostly cover don't count.
TWO_PASS_SQL = f"""with {PLACED},
taken as (select name, least(x0, x1) - {K.OVERLAP_M} as lo, greatest(x0, x1) + {K.OVERLAP_M} as hi from p1 where ok),
again as (select w.*, least(w.a, w.a + w.dir * least(w.t, w.d))::double as p, greatest(w.a, w.a + w.dir * least(w.t, w.d))::double as q from ways w join p1 using (row_id) where not ok),
met as (select a.*, greatest(p, lo) as lo, least(q, hi) as hi from again a join taken using (name) where hi >= p and lo <= q),
fresh as (select *, greatest(0, hi - greatest(lo, coalesce(max(hi) over (partition by row_id, side, ka, dir order by lo, hi rows between unbounded preceding and 1 preceding), lo))) as m from met),
share as (select row_id, side, ka, dir, sum(m) / any_value(q - p) as share from fresh group by all),
open as (select a.* from again a left join share using (row_id, side, ka, dir) where coalesce(share, 0) <= 0.5 and name in (select name from taken)),
lone2 as (select row_id, side, ka, any_value(a) as a, any_value(dir) as dir, any_value(t) as t, any_value(d) as d from open group by row_id, side, ka having count(*) = 1),
walked2 as (select *, row_number() over (partition by row_id order by side, ka) as k from lone2),
p2 as (select p1.row_id, v.row_id is not null as ok, case when v.row_id is not null then 'ok' else reason end as reason, case when v.row_id is not null then 'one-ended walk' else method end as method,
  case when v.row_id is not null then 0.0 else length_err end as length_err, case when v.row_id is not null then round_even(v.t * {FT}, 0)::bigint else matched_ft end as matched_ft, v.a::double as x0, (v.a + v.dir * least(v.t, v.d))::double as x1
  from p1 left join (select * from walked2 where k = 1) v using (row_id) where not p1.ok)
select {_SHOWN}, 1 as pass from p1 where ok union all select {_SHOWN}, 2 from p2"""
