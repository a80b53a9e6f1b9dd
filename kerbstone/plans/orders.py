"""Order-dependent operators over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins, sequences
from ..sources.tables import table

QUERIES, SQL = {}, {}
_PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def first_seen_dict(spark: SparkSession, d: str) -> DataFrame:
    return sequences.first_seen_ids(table(spark, d, "part"), "p_brand", ["p_partkey"])


SQL["first_seen_dict"] = "select p_brand as value, (row_number() over (order by min(p_partkey)) - 1)::int as id from part where p_brand <> '' group by p_brand"


@query
def dict_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Dictionary ids turned back to their texts, counted."""
    part = table(spark, d, "part")
    ids = sequences.first_seen_ids(part, "p_type", ["p_partkey"])
    coded = part.join(ids, F.col("p_type") == F.col("value")).select("p_partkey", "id")
    return coded.join(ids, "id").groupBy("id", "value").agg(F.count("*").alias("n"))


SQL["dict_lookup"] = "select (row_number() over (order by min(p_partkey)) - 1)::int as id, p_type as value, count(*) as n from part where p_type <> '' group by p_type"


@query
def first_wins_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return joins.first_wins(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_extendedprice", "l_quantity"])


SQL["first_wins_dedup"] = "select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_extendedprice, l_quantity) = 1"


@query
def priority_tag(spark: SparkSession, d: str) -> DataFrame:
    return sequences.priority_tag(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", _PRIORITY)


SQL["priority_tag"] = "select o_custkey, min(o_orderpriority) as o_orderpriority from orders where o_orderpriority in (" + ", ".join(f"'{p}'" for p in _PRIORITY) + ") group by 1"


@query
def incremental_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").withColumn("miles", F.pmod("o_custkey", F.lit(17)).cast("double"))
    return sequences.incremental_merge(rows, "o_orderpriority", "o_custkey", "miles", _PRIORITY)


SQL["incremental_merge"] = """with h as (select distinct o_orderpriority as p, o_custkey as k, (o_custkey % 17)::double as m from orders), f as (select k, min(p) as p, any_value(m) as m from h group by k),
a as (select p, sum(m) as alone from h group by p), b as (select p, sum(m) as adds from f group by p)
select a.p as o_orderpriority, alone, coalesce(adds, 0) as adds, sum(coalesce(adds, 0)) over (order by a.p rows unbounded preceding) as running from a left join b using (p)"""


@query
def merge_targets(spark: SparkSession, d: str) -> DataFrame:
    """The merged amounts against a plan's targets, only where there is a target."""
    merged = incremental_merge(spark, d).select(F.col("o_orderpriority").alias("class"), "running")
    targets = spark.createDataFrame([("1-URGENT", 1000.0), ("5-LOW", 4000.0)], "class string, target double")
    return merged.join(F.broadcast(targets), "class", "left").select("class", "running", "target", F.round(F.col("running") / F.col("target"), 6).alias("share"))


SQL["merge_targets"] = f"""select class, running, target, round(running / target, 6) as share from (select o_orderpriority as class, running from ({SQL['incremental_merge']})) left join (values ('1-URGENT', 1000.0::double), ('5-LOW', 4000.0::double)) t(class, target) using (class)"""


@query
def unpivot_classes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("existing"), F.when(F.col("l_linestatus") == "O", F.col("l_linestatus")).alias("proposed"))
    return sequences.unpivoted(rows, ["l_orderkey", "l_partkey", "l_linenumber"], [("existing", "existing"), ("proposed", "proposed")], "status", "class")


SQL["unpivot_classes"] = """select l_orderkey, l_partkey, l_linenumber, 'existing' as status, l_returnflag as class from lineitem where l_returnflag <> 'N'
union all select l_orderkey, l_partkey, l_linenumber, 'proposed', l_linestatus from lineitem where l_linestatus = 'O'"""
