"""Sections, overlays, features and the map's views over the star schema and the generated streets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import geometry as G
from ..operators import bikeways, joins, match, network, overlays
from ..sources import features
from ..sources.sinks import feature
from ..sources.tables import table
from . import fixture

QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def city_sections(spark: SparkSession, d: str) -> DataFrame:
    """A city joined to its streets: the records placed in two passes, in the section schema."""
    rows = fixture.records(spark, d)
    found = match.match_two_pass(rows, network.network(fixture.streets(spark, d))).where("ok")
    both = rows.join(joins.shuffled(found.select("row_id", "length_err", "method", "xs", "ys")), "row_id").withColumn("score", F.when(F.col("row_id") % 9 != 0, F.col("row_id") % 101).cast("string"))
    made = overlays.sections(both, "Town", {"street": "street_name", "section_id": "row_id", "from": "beg_location", "to": "end_location", "pci": "score", "length_ft": "length_ft", "match_length_err": "length_err", "match_method": "method"})
    return made.select(*[c for c in made.columns if c not in ("xs", "ys", "from", "to")], F.size("xs").alias("points"))


SQL["city_sections"] = f"""with m as ({fixture.TWO_PASS_SQL}),
r as (select c_custkey as row_id, (c_custkey % (n + 2))::bigint as s, c_custkey // 7 % 9 as i, (c_custkey // 63 + c_custkey) % 9 as j, c_custkey // 3 % 10 as kind from customer, (select count(*) as n from supplier)),
q as (select row_id, s, case when s % 7 <> 0 then i when row_id // 7 % 3 = 0 then 4 else row_id // 7 % 4 end as i, case when s % 7 <> 0 then kind when row_id // 7 % 3 = 0 then 4 else 0 end as kind, j from r),
z as (select row_id, s, i, kind, case when s % 7 <> 0 then j when row_id // 7 % 3 = 0 then row_id // 63 % 2 else i + 1 end as j from q),
l as (select row_id, 'B' || s || case when row_id % 11 = 0 then ' AVE' else ' ST' end as street, s, nullif(case when kind in (0, 8) then abs(i - j) * 100 when kind = 1 then abs(i - j) * 150 when kind = 2 then abs(i - j) * 200 when kind in (3, 4, 9) then (j + 1) * 100 when kind = 6 then 100 when kind = 7 then abs(i - j) * 70 end * 328 // 100, null)::double as length_ft from z),
k as (select m.*, l.street, l.length_ft, least(x0, x1) as lo, greatest(x0, x1) as hi, case when s % 5 = 2 then [100, 200, 300, 400, 415, 500, 600, 700] else [100, 200, 300, 400, 500, 600, 700] end as corners from m join l using (row_id) where ok)
select 'Town' as city, street, row_id::varchar as section_id, case when row_id % 9 <> 0 then row_id % 101 end::int as pci, null::double as rsl_years, null as functional_class, null as surface_type, length_ft, null::double as width_ft, null::double as area_sqft,
  null as survey_date, null as last_treatment, null as last_treatment_date, length_err as match_length_err, method as match_method, (2 + len(list_filter(corners, lambda x: x > lo + 1e-6 and x < hi - 1e-6)))::int as points from k"""


def _plan_rows(spark: SparkSession, d: str) -> DataFrame:
    """Records as plan projects, with the miles of their length."""
    rows = fixture.records(spark, d)
    return rows.select("row_id", "street_name", "beg_location", "end_location", (F.col("length_ft") / K.FT_PER_MILE).alias("miles"), F.lit("5-Year").alias("plan"), (2026 + F.col("row_id") % 5).cast("string").alias("fiscal_year"), F.when(F.col("row_id") % 3 == 0, "").otherwise((F.col("row_id") % 100).cast("string")).alias("pci"), F.when(F.col("row_id") % 4 == 0, "").otherwise("Overlay").alias("treatment"), F.when(F.col("row_id") % 6 == 0, "").otherwise("$9").alias("cost"))


@query
def plan_placed(spark: SparkSession, d: str) -> DataFrame:
    """A plan's projects placed by their miles, as features and as the map shows them."""
    found = overlays.placed(_plan_rows(spark, d), network.network(fixture.streets(spark, d)), "miles")
    made = overlays.plan_features(found)
    shown = overlays.as_plan(made.withColumn("key", F.col("row_id")), "Town", F.concat(F.col("row_id").cast("string"), F.lit(": "), F.coalesce(overlays.treatment_and_cost(), F.lit("?"))), F.concat_ws(" ", "plan", F.col("fiscal_year").cast("string"))).select("detail", "label")
    shown = joins.shuffled(shown)
    return made.select("fiscal_year", "pci", F.round("miles", 6).alias("miles"), F.concat(F.col("row_id").cast("string"), F.lit(": "), F.coalesce(overlays.treatment_and_cost(), F.lit("?"))).alias("detail")).join(shown, "detail")


SQL["plan_placed"] = f"""with m as ({fixture.MATCH_SQL}), c as (select * from (with {fixture.PLACED} select row_id, case when kind <> 5 then coalesce(t, 0) end as t from r))
select (2026 + row_id % 5)::int as fiscal_year, case when row_id % 3 <> 0 then row_id % 100 end::int as pci, round(t * {K.FT_PER_M} / 5280, 6) as miles,
  row_id || ': ' || case when row_id % 4 <> 0 and row_id % 6 <> 0 then 'Overlay - $9' when row_id % 4 <> 0 then 'Overlay' when row_id % 6 <> 0 then '$9' else '?' end as detail, '5-Year ' || (2026 + row_id % 5) as label from m join c using (row_id) where ok"""


@query
def moratorium_placed(spark: SparkSession, d: str) -> DataFrame:
    """Streets that may not be cut, placed by the shortest way between their limits, with how many still hold."""
    rows = fixture.records(spark, d).withColumns({"begins": F.lit("1/2/2020"), "ends": F.concat((1 + F.col("row_id") % 12).cast("string"), F.lit("/15/2026"))})
    found = overlays.placed(rows.drop("length_ft"), network.network(fixture.streets(spark, d)))
    made = overlays.moratorium_features(found, "2026-06-15")
    shown = overlays.as_moratorium(made, "Town")
    return overlays.overlay_report(found).crossJoin(F.broadcast(shown.agg(F.count_if("active").alias("active"), F.count("*").alias("shown"))))  # one row each


_NO_LENGTH = fixture.MATCH_SQL.replace("r1 as (", "r1 as (select * replace (null::double as t) from (").replace("as ends from r0),", "as ends from r0)),")
SQL["moratorium_placed"] = f"select count(*) as rows, count(*) filter (where ok) as matched, count(*) filter (where ok and 1 + row_id % 12 >= 6) as active, count(*) filter (where ok) as shown from ({_NO_LENGTH})"


@query
def plan_codes(spark: SparkSession, d: str) -> DataFrame:
    """Sections with a plan code: the category of the code, and the raw composite id."""
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        k.cast("string").alias("STREETID"), F.lpad((k % 40).cast("string"), 3, "0").alias("SECTIONID"), F.when(k % 9 == 0, " ").otherwise(F.concat(F.lit(" S"), (k % 50).cast("string"))).alias("STREET"), F.lit("").alias("BEGLOCATIO"), F.col("o_orderpriority").alias("ENDLOCATIO"),
        F.when(k % 4 == 0, "  ").when(k % 4 == 1, " A ").when(k % 4 == 2, "Z").alias("PLAN_2022"),
    )
    return bikeways.plan_overlay(rows, {"A": "Arterial", "B": "Bike"})


SQL["plan_codes"] = """select o_orderkey || '-' || lpad((o_orderkey % 40)::varchar, 3, '0') as section_id, case when o_orderkey % 9 <> 0 then 'S' || (o_orderkey % 50) end as street, null as "from", o_orderpriority as "to", case o_orderkey % 4 when 1 then 'Arterial' else 'Z' end as category from orders where o_orderkey % 4 in (1, 2)"""


@query
def cut_moratorium(spark: SparkSession, d: str) -> DataFrame:
    """A service's moratorium: days of epoch milliseconds, a name or else a location, and the overlay that the map shows."""
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("N"), k.cast("string"))).alias("NAME"), F.concat(F.lit("L"), k.cast("string")).alias("LOCATION"), ms.alias("M_DATEPAVE"), F.when(k % 7 == 0, 0).otherwise(ms + 86_400_000 * 400).alias("M_DATEEND"), F.concat(F.lit("P"), k.cast("string")).alias("M_PROJNUM"), F.lit("3YP").alias("M_3YP"))
    return overlays.as_moratorium(bikeways.moratorium_overlay(rows, "1997-06-01"), "Oak", "project", "program").withColumnsRenamed({"from": "project", "to": "program"})


SQL["cut_moratorium"] = """select 'Oak' as city, case when o_orderkey % 3 = 0 then 'L' else 'N' end || o_orderkey as street, 'P' || o_orderkey as project, '3YP' as program,
  case when o_orderkey % 7 <> 0 then (o_orderdate::date + 400)::date::varchar end as ends, case when o_orderkey % 7 <> 0 then o_orderdate::date + 400 >= date '1997-06-01' end as active from orders"""


def _views(spark: SparkSession, d: str) -> DataFrame:
    """Parts as sections: city, score, tier, feet."""
    k = F.col("p_partkey")
    return table(spark, d, "part").select(k.alias("id"), F.col("p_type").alias("city"), (F.col("p_size") * 3).alias("pci"), F.when(k % 3 == 0, "protected").when(k % 3 == 1, "shared").alias("bike_tier"), F.when(k % 10 != 0, k * 7.0).alias("length_ft"))


def _off_street(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as off-street lines."""
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(k.alias("id"), F.when(k % 2 == 0, "SMALL").otherwise("PROMO").alias("city"), F.when(k % 5 == 0, "protected").otherwise("painted").alias("tier"), (k / 7).alias("miles"))


_VIEWS = """v as (select p_partkey as id, p_type as city, p_size * 3 as pci, case p_partkey % 3 when 0 then 'protected' when 1 then 'shared' end as bike_tier, case when p_partkey % 10 <> 0 then p_partkey * 7.0 end as length_ft from part),
o as (select s_suppkey as id, case when s_suppkey % 2 = 0 then 'SMALL' else 'PROMO' end as city, case when s_suppkey % 5 = 0 then 'protected' else 'painted' end as tier, s_suppkey / 7 as miles from supplier),
st as (select city, bike_tier as tier, sum(coalesce(length_ft, 0)) / 5280 as a from v where bike_tier is not null group by all), ot as (select city, tier, sum(round_even(miles, 3)) as b from o group by all),
bs as (select city, tier, coalesce(a, 0) as a, coalesce(b, 0) as b, round_even(coalesce(a, 0) + coalesce(b, 0), 1) as miles from st full join ot using (city, tier))"""


@query
def bike_miles(spark: SparkSession, d: str) -> DataFrame:
    """Street, off-street and total miles by city and tier."""
    found = overlays.bike_summary(_views(spark, d), _off_street(spark, d))
    return found.select("city", "tier", F.round("street_miles", 6).alias("street_miles"), F.round("off_street_miles", 6).alias("off_street_miles"), "miles")


SQL["bike_miles"] = f"with {_VIEWS} select city, tier, round(a, 6)::double as street_miles, round(b, 6)::double as off_street_miles, miles::double as miles from bs"


@query
def tier_miles(spark: SparkSession, d: str) -> DataFrame:
    """Miles by tier of the chosen cities, one of which has no summary."""
    return overlays.tier_miles(overlays.bike_summary(_views(spark, d), _off_street(spark, d)), ["SMALL", "PROMO", "NOWHERE"]).withColumn("miles", F.round("miles", 6))


SQL["tier_miles"] = f"with {_VIEWS} select t.tier, round(coalesce(sum(miles), 0), 6)::double as miles from (values ('protected'), ('painted'), ('shared')) t(tier) left join (select * from bs where city in ('SMALL', 'PROMO', 'NOWHERE')) b on b.tier = t.tier group by 1"


@query
def view_lines(spark: SparkSession, d: str) -> DataFrame:
    """Bike lines, on and off the street, of the chosen tiers and cities."""
    on = _views(spark, d).where("bike_tier is not null").select("id", "city", F.col("bike_tier").alias("tier"))
    return overlays.shown_lines(on.unionByName(_off_street(spark, d).select((-F.col("id") - 1).alias("id"), "city", "tier")), ["protected", "painted"], ["SMALL", "ECONOMY"])


SQL["view_lines"] = f"with {_VIEWS} select * from (select id, city, bike_tier as tier from v union all select -id - 1, city, tier from o) where tier in ('protected', 'painted') and city in ('SMALL', 'ECONOMY')"


@query
def view_overlays(spark: SparkSession, d: str) -> DataFrame:
    """Two overlays of which one is off."""
    rows = _views(spark, d).select("id", "city")
    return overlays.shown_overlay(rows, ["SMALL", "PROMO"]).unionByName(overlays.shown_overlay(rows, ["ECONOMY"], visible=False))


SQL["view_overlays"] = "select p_partkey as id, p_type as city from part where p_type in ('SMALL', 'PROMO')"


@query
def legend_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sections by band of the chosen cities, on the bike network only, bands without any too."""
    return overlays.legend(_views(spark, d), ["SMALL", "PROMO"], True)


SQL["legend_counts"] = f"""with {_VIEWS}, b(lo, hi, band) as (values {', '.join(f"({a}, {b}, '{n}')" for a, b, n in K.BANDS)})
select band, count(id) as n from b left join (select * from v where city in ('SMALL', 'PROMO') and bike_tier is not null) v on pci between lo and hi or (band = 'Failed' and not exists (select 1 from b where pci between lo and hi)) group by band"""


@query
def city_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Tiles of cities that have a summary, and the others without."""
    v = _views(spark, d)
    summary = v.where("city <> 'PROMO'").groupBy("city").agg(F.count("*").alias("sections_in_report"), F.count("bike_tier").alias("sections_mapped"), F.bround(1 - F.count("bike_tier") / F.count("*"), 4).alias("unmatched_rate"), F.bround(F.avg("pci"), 1).alias("weighted_pci_mapped"))
    return overlays.with_summary(v, overlays.tiles(summary))


SQL["city_tiles"] = f"""with {_VIEWS}, s as (select city, count(*) as n, count(bike_tier) as m, round_even(1 - count(bike_tier) / count(*), 4) as u, round_even(avg(pci), 1) as score from v where city <> 'PROMO' group by city)
select c.city, score::varchar as score, format('{{:,}}', m) || ' of ' || format('{{:,}}', n) || ' sections mapped (' || format('{{:.1f}}', 100 * (1 - u)) || '%)' as mapped from (select distinct city from v) c left join s using (city)"""


@query
def name_counts(spark: SparkSession, d: str) -> DataFrame:
    """Distinct names in each group."""
    return overlays.distinct_names(table(spark, d, "part"), ["p_brand"], "p_name")


SQL["name_counts"] = "select p_brand, count(distinct p_name) as names from part group by p_brand"


@query
def length_errors(spark: SparkSession, d: str) -> DataFrame:
    """Relative errors of measured against reported lengths; none where nothing is reported."""
    q = F.when(F.col("l_linenumber") == 1, 0.0).when(F.col("l_linenumber") != 2, F.col("l_extendedprice"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(G.relative_error(F.col("l_quantity") * 1000, q), 9).alias("error"))


SQL["length_errors"] = "select l_orderkey, l_linenumber, case when l_linenumber > 2 then round(abs(l_quantity * 1000 - l_extendedprice) / l_extendedprice, 9) end as error from lineitem"


@query
def json_features(spark: SparkSession, d: str) -> DataFrame:
    """Features written as JSON text and read again: lines, several lines, and none."""
    line = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(F.col("embedding")[2 * i].cast("double").alias("x"), F.col("embedding")[2 * i + 1].cast("double").alias("y")))
    parts = F.when(F.col("vec_id") % 5 == 0, F.array().cast("array<array<struct<x:double,y:double>>>")).when(F.col("vec_id") % 2 == 0, F.array(line)).otherwise(F.array(F.slice(line, 1, 3), F.slice(line, 4, 29)))
    text = table(spark, d, "embeddings").select(feature(parts, F.struct("vec_id", F.lit(None).cast("string").alias("none"))).alias("f"))
    read = text.select(F.from_json("f", "geometry struct<type:string,coordinates:string>, properties map<string,string>").alias("f")).where("f.geometry.type is not null")
    got = read.select(F.col("f.properties")["vec_id"].cast("long").alias("vec_id"), F.col("f.geometry.type").alias("kind"), F.posexplode(features.parts(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))).alias("part", "line"))
    return got.select("vec_id", "kind", "part", F.size("line").alias("points"), F.round(G.length(F.col("line")), 9).alias("length"))


_STEP = "sqrt((embedding[2 * i + 3]::double - embedding[2 * i + 1]::double) ** 2 + (embedding[2 * i + 4]::double - embedding[2 * i + 2]::double) ** 2)"
SQL["json_features"] = f"""select vec_id, 'LineString' as kind, 0 as part, 32 as points, round(list_sum([{_STEP} for i in range(31)]), 9) as length from embeddings where vec_id % 5 <> 0 and vec_id % 2 = 0
union all select vec_id, 'MultiLineString', 0, 3, round(list_sum([{_STEP} for i in range(2)]), 9) from embeddings where vec_id % 5 <> 0 and vec_id % 2 = 1
union all select vec_id, 'MultiLineString', 1, 29, round(list_sum([{_STEP} for i in range(3, 31)]), 9) from embeddings where vec_id % 5 <> 0 and vec_id % 2 = 1"""


@query
def service_geometry(spark: SparkSession, d: str) -> DataFrame:
    """Paths of a service's own format: paths of one point go, and a feature without any has no geometry."""
    k = F.col("vec_id")
    point = lambda i: F.array(F.col("embedding")[2 * i].cast("double"), F.col("embedding")[2 * i + 1].cast("double"), F.lit(9.0))
    paths = F.when(k % 4 == 0, F.array(F.array(point(0)))).when(k % 4 == 1, F.array(F.array(point(0)), F.array(point(1), point(2)))).when(k % 4 == 2, F.array(F.array(point(0), point(1), point(2)), F.array(point(3), point(4))))
    rows = table(spark, d, "embeddings").select(k, features.esri_parts(paths).alias("parts"))
    return rows.where("parts is not null").select(k, F.posexplode("parts").alias("part", "line")).select("vec_id", "part", F.size("line").alias("points"), F.round(F.element_at("line", -1)["x"], 9).alias("last_x"))


SQL["service_geometry"] = """select vec_id, 0 as part, 2 as points, round(embedding[5]::double, 9) as last_x from embeddings where vec_id % 4 = 1
union all select vec_id, 0, 3, round(embedding[5]::double, 9) from embeddings where vec_id % 4 = 2 union all select vec_id, 1, 2, round(embedding[9]::double, 9) from embeddings where vec_id % 4 = 2"""


@query
def named_ways(spark: SparkSession, d: str) -> DataFrame:
    """Named ways of two points at least, with their own number among the tags."""
    k = F.col("event_id")
    way = F.when(k % 5 == 0, F.array(F.struct(F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat")))).when(k % 7 != 0, F.transform(F.sequence(F.lit(1), (k % 4 + 2).cast("int")), lambda i: F.struct((k + i).cast("double").alias("lon"), i.cast("double").alias("lat"))))
    tags = F.map_filter(F.create_map(F.lit("name"), F.when(k % 3 == 0, "").when(k % 3 == 1, F.col("event_type")), F.lit("highway"), F.lit("road")), lambda _, v: v.isNotNull())
    found = features.named_ways(table(spark, d, "events").select(k.alias("id"), F.when(k % 11 != 0, tags).alias("tags"), way.alias("geometry")))
    return found.select("osm_id", F.col("tags")["name"].alias("name"), F.col("tags")["osm_id"].alias("tag"), F.size("tags").alias("tags"), F.size("pts").alias("points"), F.col("pts")[1]["x"].alias("x1"))


SQL["named_ways"] = "select event_id as osm_id, event_type as name, event_id::varchar as tag, 3 as tags, (event_id % 4 + 2)::int as points, (event_id + 2)::double as x1 from events where event_id % 5 <> 0 and event_id % 7 <> 0 and event_id % 3 = 1 and event_id % 11 <> 0"


@query
def bike_sources(spark: SparkSession, d: str) -> DataFrame:
    """Four sources in one schema: two classes of one row, a layer of one class, an old layer's codes, tagged ways."""
    k = F.col("s_suppkey")
    pts = F.array(F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), F.struct((k * 10.0 + 10).alias("x"), F.lit(0.0).alias("y")))
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("n"), pts.alias("pts"))
    pick = lambda *v: F.element_at(F.array(*[F.lit(x).cast("string") for x in v]), (k % len(v) + 1).cast("int"))
    one = bikeways.from_network(s.select(pick("2B", "0", "3A", None).alias("EXISTINGCL"), pick("1", "0.0", "2.4").alias("PROPOSEDCL"), F.col("n").alias("ROADWAY"), F.lit("A ST").alias("BEGINNING"), F.lit("").alias("ENDING"), pick("2011", "0").alias("YEARCURREN"), "pts"))
    two = bikeways.from_layer(s.select(F.col("n").alias("BB_STRNAM"), F.lit("x").alias("BB_FRO"), F.lit("y").alias("BB_TO"), "pts"), K.SOURCE_ORDER[1], "IV")
    three = bikeways.from_2004(s.select(pick(" 2", "BB - 3", "9").alias("EX2004"), F.col("n").alias("STREET"), F.lit("").alias("FROM_"), F.lit("").alias("TO_"), "pts"))
    four = bikeways.from_osm(s.select(F.when(k % 3 != 0, "Berkeley").alias("city"), F.create_map(F.lit("highway"), F.when(k % 2 == 0, "cycleway").otherwise("road"), F.lit("name"), F.col("n")).alias("tags"), "pts"))
    whole = one.unionByName(two).unionByName(three).unionByName(four)
    return whole.groupBy("source", "status", "bikeway_class", "class_secondary", "year").agg(F.count("*").alias("n"), F.round(F.sum("miles"), 4).alias("miles"))


SQL["bike_sources"] = """with s as (select s_suppkey as k, round_even((s_suppkey * 10.0 + 10)::double / 1609.344, 4) as m from supplier),
a as (select 'Oakland GIS: BikeNetwork' as source, 'existing' as status, case k % 4 when 0 then 'IIB' else 'IIIA' end as bikeway_class, null as class_secondary, case when k % 2 = 0 then '2011' end as year, m from s where k % 4 in (0, 2)
  union all select 'Oakland GIS: BikeNetwork', 'proposed', case k % 3 when 0 then 'I' else 'II' end, case when k % 3 = 2 then 'IV' end, null, m from s where k % 3 in (0, 2)
  union all select 'Berkeley GIS: Separated Bikeways', 'existing', 'IV', null, null, m from s
  union all select 'Berkeley GIS: Bikeways (2004 classes)', 'existing', case k % 3 when 0 then 'II' else 'IIIB' end, null, '2004', m from s where k % 3 < 2
  union all select 'OpenStreetMap', 'existing', 'I', null, null, m from s where k % 3 <> 0 and k % 2 = 0)
select source, status, bikeway_class, class_secondary, year, count(*) as n, round(sum(m), 4) as miles from a group by all"""
