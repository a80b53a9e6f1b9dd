"""Scores, bands, key joins, gates and summaries over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.scalars import section_key, shown_band
from ..operators import gates, joins, layout, summaries
from ..sources.tables import table

QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _bands_sql(score: str) -> str:
    return "case " + " ".join(f"when {score} between {a} and {b} then '{n}'" for a, b, n in K.BANDS) + " end"


@query
def condition_summary(spark: SparkSession, d: str) -> DataFrame:
    """Per region: customers matched to orders, unmatched share, order-weighted score, poor or failed."""
    nation, region, customer = table(spark, d, "nation"), table(spark, d, "region"), table(spark, d, "customer")
    spent = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("area"))
    rows = customer.join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
    # nation and region are 25 and 5 rows by the schema
    rows = rows.join(F.broadcast(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))), F.col("c_nationkey") == F.col("n_nationkey"))
    score = F.pmod(F.col("c_custkey"), F.lit(101)).cast("int")
    rows = rows.select("r_name", "area", score.alias("score"))
    return rows.groupBy("r_name").agg(
        F.count("*").alias("rows"), F.count_if(F.col("area").isNotNull()).alias("matched"), F.bround(1 - F.count_if(F.col("area").isNotNull()) / F.count("*"), 4).alias("unmatched_rate"),
        F.round(summaries.weighted(F.col("score"), F.col("area")), 4).alias("weighted_score"), F.count_if(shown_band(F.col("score")).isin("Poor", "Failed")).alias("poor_or_failed"),
    )


SQL["condition_summary"] = f"""
with s as (select o_custkey, sum(o_totalprice) as area from orders group by 1),
t as (select r_name, area, c_custkey % 101 as score from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey left join s on c_custkey = o_custkey)
select r_name, count(*) as rows, count(area) as matched, round_even(1 - count(area) / count(*), 4) as unmatched_rate,
  round(sum(score * coalesce(area, 0)) / nullif(sum(coalesce(area, 0)), 0), 4) as weighted_score,
  count(*) filter (where coalesce({_bands_sql('score')}, 'Failed') in ('Poor', 'Failed')) as poor_or_failed
from t group by 1"""


@query
def weighted_mean(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(summaries.weighted(F.col("l_quantity"), F.col("l_extendedprice")), 6).alias("weighted"))


SQL["weighted_mean"] = "select l_returnflag, round(sum(l_quantity * coalesce(l_extendedprice, 0)) / nullif(sum(coalesce(l_extendedprice, 0)), 0), 6) as weighted from lineitem group by 1"


@query
def band_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_brand", (F.col("p_size") * 2 + F.when(F.col("p_partkey") % 9 == 0, 0.5).otherwise(0)).alias("score"))
    return summaries.band_counts(rows, ["p_brand"], "score")


SQL["band_counts"] = f"select p_brand, {_bands_sql('s')} as band, count(*) as n from (select p_brand, p_size * 2 + case when p_partkey % 9 = 0 then 0.5 else 0 end as s from part) group by 1, 2"


def _keyed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Rows with zero-padded keys, and a layer with repeats that lacks some of them."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", section_key(F.lpad(F.col("l_partkey").cast("string"), 9, "0"), F.lpad(F.col("l_linenumber").cast("string"), 3, "0")).alias("key"))
    part = table(spark, d, "part").where("p_partkey % 5 <> 0")
    layer = part.select(F.explode(F.sequence(F.lit(1), F.lit(7))).alias("section"), "*").select(section_key(F.col("p_partkey"), F.col("section")).alias("key"), "p_size", (F.col("p_retailprice") * F.col("section")).alias("ord"))
    return rows, layer.unionByName(layer.withColumns({"p_size": F.col("p_size") + 100, "ord": F.col("ord") + 1}))


_KEYED = """with r as (select l_orderkey, l_linenumber, l_quantity, ltrim(l_partkey::varchar, '0') || '-' || l_linenumber::varchar as key from lineitem),
p as (select ltrim(p_partkey::varchar, '0') || '-' || s::varchar as key, p_size, p_retailprice * s as ord from part, range(1, 8) t(s) where p_partkey % 5 <> 0),
layer as (select * from p union all select key, p_size + 100, ord + 1 from p) """


@query
def key_join_first(spark: SparkSession, d: str) -> DataFrame:
    rows, layer = _keyed(spark, d)
    return joins.key_join(rows, layer, "key", ["ord", "p_size"]).groupBy("key").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"), F.min("p_size").alias("first_size"))


SQL["key_join_first"] = _KEYED + "select key, count(*) as n, sum(l_quantity) as quantity, min(p_size) as first_size from r join (select key, arg_min(p_size, (ord, p_size)) as p_size from layer group by key) using (key) group by key"


@query
def key_join_unmatched(spark: SparkSession, d: str) -> DataFrame:
    rows, layer = _keyed(spark, d)
    return joins.unmatched(rows, layer, "key", "no geometry for this key").select("key", "l_orderkey", "l_linenumber", "l_quantity", "reason")


SQL["key_join_unmatched"] = _KEYED + "select key, l_orderkey, l_linenumber, l_quantity, 'no geometry for this key' as reason from r where key not in (select key from layer)"


@query
def match_stats(spark: SparkSession, d: str) -> DataFrame:
    kept = table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey")
    both = table(spark, d, "orders").join(kept, F.col("o_custkey") == F.col("c_custkey"), "left")
    return summaries.match_stats(both, ["o_orderpriority"], F.col("c_custkey").isNotNull())


SQL["match_stats"] = "select o_orderpriority, count(*) as rows, count(c_custkey) as matched, round_even(1 - count(c_custkey) / count(*), 4) as unmatched_rate from orders left join (select c_custkey from customer where c_acctbal > 0) on o_custkey = c_custkey group by 1"


@query
def reason_hist(spark: SparkSession, d: str) -> DataFrame:
    reason = F.concat(F.element_at(F.array(*map(F.lit, ("length mismatch", "no path", "begin cross street not found"))), (F.col("o_orderkey") % 3 + 1).cast("int")), F.lit(" ("), F.col("o_orderkey").cast("string"), F.lit("%)"))
    return summaries.reason_histogram(table(spark, d, "orders").select(reason.alias("reason"))).orderBy(F.desc("n"), "reason")


SQL["reason_hist"] = "select split_part(r, ' (', 1) as reason, count(*) as n from (select (['length mismatch', 'no path', 'begin cross street not found'])[(o_orderkey % 3 + 1)::int] || ' (' || o_orderkey || '%)' as r from orders) group by 1"


@query
def delta_hist(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("gis", F.when(F.col("l_partkey") % 11 != 0, F.col("l_quantity")))
    return gates.delta_histogram(rows, F.col("l_linenumber"), F.col("gis"))


SQL["delta_hist"] = "select l_linenumber - trunc(l_quantity)::int as delta, count(*) as n from lineitem where l_partkey % 11 <> 0 group by 1"


@query
def delta_share(spark: SparkSession, d: str) -> DataFrame:
    hist = delta_hist(spark, d)
    return hist.agg(F.sum("n").alias("n"), F.bround(F.sum(F.when(F.abs("delta") <= 1, F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("within_one"))


SQL["delta_share"] = "select count(*)::bigint as n, round_even(count(*) filter (where abs(l_linenumber - trunc(l_quantity)::int) <= 1) / count(*), 6) as within_one from lineitem where l_partkey % 11 <> 0"


@query
def control_totals(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity")
    found = gates.totals(table(spark, d, "lineitem"), {"quantity": (F.sum(q), 1_500_000, 0.05), "least": (F.min(q), 1, 0.0), "most": (F.max(q), 50, 0.005), "mean": (F.avg(q), 25, 0.05)})
    return found.withColumn("got", F.round("got", 6))


SQL["control_totals"] = """select label, round(got, 6) as got, want, abs(got - want) / nullif(want, 0) <= tol as passed from (
select 'quantity' as label, sum(l_quantity)::double as got, 1500000.0::double as want, 0.05 as tol from lineitem union all select 'least', min(l_quantity), 1, 0 from lineitem
union all select 'most', max(l_quantity), 50, 0.005 from lineitem union all select 'mean', avg(l_quantity), 25, 0.05 from lineitem)"""


@query
def group_totals(spark: SparkSession, d: str) -> DataFrame:
    """Areas by band and by class against stated areas, as one gate a group."""
    rows = table(spark, d, "part").select(F.col("p_brand").alias("fc"), F.col("p_retailprice").alias("area"))
    stated = rows.groupBy("fc").agg(F.count("*").alias("want_n"), F.round(F.sum("area") * F.when(F.right("fc", F.lit(1)) == "1", 1.1).otherwise(1), 2).alias("want_total")).where("fc <> 'Brand#55'")
    out = gates.grouped(rows, ["fc"], F.count("*"), F.round(F.sum("area"), 2), stated, 0.1)
    return out


SQL["group_totals"] = """with g as (select p_brand as fc, count(*) as got_n, round(sum(p_retailprice), 2) as got_total, round(sum(p_retailprice) * case when right(p_brand, 1) = '1' then 1.1 else 1 end, 2) as want_total from part group by 1)
select fc, got_n, got_n as want_n, got_total, want_total, abs(got_total - want_total) <= 0.1 as passed from g where fc <> 'Brand#55'"""


@query
def group_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Counts exactly and totals within 0.1 of what headers state, by plan and year; only stated groups are held."""
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", F.round(F.col("l_discount") * 10, 1).alias("miles"))
    stated = rows.where("not (l_returnflag = 'R')").groupBy("l_returnflag", "l_linestatus").agg((F.count("*") + F.when(F.first("l_linestatus") == "O", 1).otherwise(0)).alias("want_n"), F.round(F.sum("miles"), 1).alias("want_total"))
    return gates.grouped(rows, ["l_returnflag", "l_linestatus"], F.count("*"), F.round(F.sum("miles"), 1), stated, 0.1)


SQL["group_reconcile"] = """with g as (select l_returnflag, l_linestatus, count(*) as n, round(sum(round(l_discount * 10, 1)), 1) as total from lineitem where l_returnflag <> 'R' group by 1, 2)
select l_returnflag, l_linestatus, n as got_n, n + case when l_linestatus = 'O' then 1 else 0 end as want_n, total as got_total, total as want_total, l_linestatus <> 'O' as passed from g"""


@query
def blank_keys(spark: SparkSession, d: str) -> DataFrame:
    """Names that are blank, white or null (of texts, some are) against none, by the text as it is."""
    return gates.blank_keys(table(spark, d, "documents").select(F.when(F.col("doc_id") % 11 != 0, F.col("text")).otherwise(F.lit("  ")).alias("name")), "name")


SQL["blank_keys"] = "select count(*) as blank, count(*) = 0 as passed from documents where doc_id % 11 = 0 or text is null or not regexp_matches(text, '[^ ]')"


@query
def component_sum(spark: SparkSession, d: str) -> DataFrame:
    """A printed table: classes' miles against the printed total, and an exact count and cost of another list."""
    tenth = F.floor(F.abs(F.col("s_acctbal").cast("decimal(12,2)")) / 100)
    lines = table(spark, d, "supplier").select(F.col("s_suppkey").alias("page"), F.concat(F.lit("Facility (Class I)  1.5 "), (tenth / 10).cast("decimal(12,1)").cast("string"), F.when(F.col("s_suppkey") % 2 == 0, "*").otherwise("")).alias("line"))
    # the total is printed after rounding to whole miles
    total = lines.select(F.col("page"), F.regexp_extract("line", r"([0-9.-]+)\*?$", 1).cast("decimal(12,1)").alias("m")).agg(F.round(F.sum("m"), 0).cast("string").alias("t")).select(F.lit(-1).cast("long").alias("page"), F.concat(F.lit("Total 0.0 "), "t").alias("line"))
    costs = table(spark, d, "part").select(F.concat(F.lit("$ "), F.format_number(F.floor("p_retailprice"), 0)).alias("cost"))
    return gates.component_sum(layout.mileage_rows(lines.unionByName(total), "line"), "miles", "facility", 0.15).crossJoin(F.broadcast(gates.exact(costs, "cost", 2000, 1_899_000)))


SQL["component_sum"] = """with m as (select floor(abs(s_acctbal::decimal(12,2)) / 100) / 10 as m from supplier), p as (select count(*) as n, sum(floor(p_retailprice)::bigint)::bigint as cost from part)
select round(sum(m), 1)::double as summed, round(sum(m))::double as stated, abs(round(sum(m), 1) - round(sum(m))) <= 0.15 as sums, any_value(n) as n, any_value(cost) as cost, any_value(n = 2000 and cost = 1899000) as exact from m, p"""


@query
def range_totals(spark: SparkSession, d: str) -> DataFrame:
    """Areas by printed ranges of scores (not the bands) and by class, against stated areas within half a percent."""
    rows = table(spark, d, "part").select((F.col("p_partkey") % 101).alias("pci"), F.col("p_type").alias("fc"), F.col("p_retailprice").alias("area"))
    by_range = gates.within(rows.withColumn("label", gates.score_range(F.col("pci"))), "label", "area", {"Excellent": 2e5, "Good": 9e5, "Fair": 5e5, "Poor": 4e5, "Failed": 9e5, "None": 1.0}, 0.005)
    by_class = gates.within(rows, "fc", "area", {"ECONOMY": 6e5, "SMALL": 6e5, "STANDARD": 6e5, "absent": 0.0}, 0.005).withColumnRenamed("fc", "label")
    return by_range.unionByName(by_class).select("label", F.round("got", 4).alias("got"), "want", "passed")


SQL["range_totals"] = """with r as (select p_partkey % 101 as pci, p_type as fc, p_retailprice as area from part),
l as (select case when pci >= 91 then 'Excellent' when pci >= 71 then 'Good' when pci >= 51 then 'Fair' when pci >= 31 then 'Poor' else 'Failed' end as label, area from r union all select fc, area from r),
w(label, want) as (values ('Excellent', 2e5), ('Good', 9e5), ('Fair', 5e5), ('Poor', 4e5), ('Failed', 9e5), ('None', 1.0), ('ECONOMY', 6e5), ('SMALL', 6e5), ('STANDARD', 6e5), ('absent', 0.0))
select label, round(coalesce(sum(area), 0), 4) as got, any_value(want)::double as want, case when any_value(want) <> 0 then abs(coalesce(sum(area), 0) - any_value(want)) / any_value(want) <= 0.005 else coalesce(sum(area), 0) = 0 end as passed
from w left join l using (label) group by label"""


@query
def fallback_union(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").select(F.col("n_name").alias("name"), F.lit("city").alias("source"), "n_regionkey")
    other = table(spark, d, "nation").select(F.col("n_name").alias("name"), F.lit("osm").alias("source"), "n_regionkey")
    return joins.fallback_union(joins.of_municipality(nation.withColumns({"MUNILEFT": F.col("n_regionkey").cast("string"), "MUNIRIGHT": F.lit("9")}), "1").select("name", "source"), other.select("name", "source"), "name")


SQL["fallback_union"] = "select n_name as name, case when n_regionkey = 1 then 'city' else 'osm' end as source from nation"


@query
def name_core_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A name is itself if there is such a street, else every street of its core, else those whose core it is."""
    streets = table(spark, d, "part").where("p_partkey % 3 = 0").select(F.col("p_name").alias("name"))
    rows = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"))
    return joins.resolve_names(rows, streets).select("p_partkey", "street", "resolved")


_CORE = "regexp_replace({0}, ' [^ ]+$', '')"
SQL["name_core_lookup"] = f"""with s as (select distinct p_name as street, {_CORE.format('p_name')} as core from part where p_partkey % 3 = 0),
r as (select p_partkey, p_name as name, {_CORE.format('p_name')} as core from part),
g as (select core, min(street) as least from s group by core)
select p_partkey, name as street, name as resolved from r where name in (select street from s)
union all select p_partkey, s.street, g.least from r join s on s.core = r.core join g on g.core = r.core where name not in (select street from s)
union all select p_partkey, s.street, g.least from r join s on s.core = r.name join g on g.core = r.name where name not in (select street from s) and r.core not in (select core from s)"""


@query
def tier_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(
        F.col("l_linestatus").alias("city"), F.when(F.col("l_returnflag") == "A", "protected").when(F.col("l_returnflag") == "N", F.when(F.col("l_linenumber") > 3, "painted")).otherwise("shared").alias("tier"),
        (F.col("l_quantity") * 2).cast("int").alias("pci"), F.col("l_extendedprice").alias("area"), F.when(F.col("l_linenumber") < 7, F.col("l_quantity")).alias("feet"),
    )
    return summaries.tier_summary(rows, "city", "tier", "pci", "area", "feet")


SQL["tier_summary"] = f"""with t as (select l_linestatus as city, case l_returnflag when 'A' then 'protected' when 'N' then case when l_linenumber > 3 then 'painted' end else 'shared' end as tier,
  trunc(l_quantity * 2)::int as pci, l_extendedprice as area, case when l_linenumber < 7 then l_quantity end as feet from lineitem)
select city, count(tier) as sections_on_network, round_even(sum(pci * area) filter (where tier is not null) / sum(area) filter (where tier is not null), 1) as weighted_on_network,
  round_even(sum(pci * area) / sum(area), 1) as weighted_citywide, count(*) filter (where tier is not null and {_bands_sql('pci')} in ('Poor', 'Failed')) as poor_or_failed,
  {", ".join(f"round_even(coalesce(sum(coalesce(feet, 0)) filter (where tier = '{t}'), 0) / 5280, 1) as {t}_miles" for t in K.TIERS)} from t group by city"""


@query
def source_miles(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", (F.col("l_quantity") / 7).alias("miles"))
    return summaries.miles_by_class(rows, ["l_returnflag", "l_linestatus", "l_linenumber"])


SQL["source_miles"] = "select l_returnflag, l_linestatus, l_linenumber, round_even(sum(round_even(l_quantity / 7, 4)), 1) as miles from lineitem group by 1, 2, 3"


@query
def project_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.when(F.col("p_size") > 10, "segment").otherwise("spot").alias("kind"), F.substring("p_brand", 7, 1).alias("class_raw"), F.when(F.col("p_size") > 10, F.col("p_size") / 8).alias("miles"))
    return summaries.project_summary(rows)


SQL["project_summary"] = "select case when p_size > 10 then 'segment' else 'spot' end as kind, substr(p_brand, 7, 1) as class_raw, count(*) as n, round_even(sum(case when p_size > 10 then p_size / 8 end), 1) as miles from part group by 1, 2"


@query
def view_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", (F.col("p_size") * 2).alias("pci"), F.col("p_brand").alias("city"), F.when(F.col("p_partkey") % 4 == 0, "shared").alias("bike_tier"))
    return summaries.visible(rows, ["Poor", "Failed"], ["Brand#11", "Brand#12", "Brand#13"], tier="bike_tier").select("p_partkey", "pci", "city")


SQL["view_filter"] = f"select p_partkey, p_size * 2 as pci, p_brand as city from part where p_partkey % 4 = 0 and p_brand in ('Brand#11', 'Brand#12', 'Brand#13') and coalesce({_bands_sql('p_size * 2')}, 'Failed') in ('Poor', 'Failed')"


@query
def view_counts(spark: SparkSession, d: str) -> DataFrame:
    """Legend counts of the chosen cities; a score outside every band shows as Failed."""
    rows = table(spark, d, "part").select((F.col("p_size") * 3).alias("pci"), "p_brand").where(F.col("p_brand").isin("Brand#11", "Brand#21"))
    return rows.groupBy(shown_band(F.col("pci")).alias("band")).agg(F.count("*").alias("n"))


SQL["view_counts"] = f"select coalesce({_bands_sql('p_size * 3')}, 'Failed') as band, count(*) as n from part where p_brand in ('Brand#11', 'Brand#21') group by 1"


@query
def view_detail(spark: SparkSession, d: str) -> DataFrame:
    """One section's fields, without those that are null."""
    rows = table(spark, d, "part").select("p_partkey", "p_brand", F.when(F.col("p_size") > 25, F.col("p_size")).alias("p_size"))
    return rows.select("p_partkey", F.map_entries(summaries.detail(rows, ["p_brand", "p_size"])).alias("fields")).select("p_partkey", F.array_join(F.transform("fields", lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("fields"))


SQL["view_detail"] = "select p_partkey, concat_ws(';', 'p_brand=' || p_brand, case when p_size > 25 then 'p_size=' || p_size end) as fields from part"
