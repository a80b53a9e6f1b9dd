"""Names, labels, cells and classes: scalar functions over literal rows and table columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import names, scalars
from ..sources.features import json_tags
from ..sources.tables import table

QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


NAMES = [
    "1 AV", "11 ST", "112 ST", "02 ST", "SHATTUCK AVE (SB)", "M.L. KING JR WAY", "EAST BOLIVAR DR", "E 12th St, WB", "FLORANCE ST", "PARK", "SOUTH HOSPITAL DRIVE", "FIRST AVENUE", "22 AV", "101 AV",
    "MC GEE AV", "SHATTUCK AVE SB", "MARTIN LUTHER KING JR W", "THE UPLANDS", "O'FARRELL ST", "WEST ST", "N ST", "(SB)", "", "Main & Elm Blvd.", "THE THE N PATH", "113 STREET", "0 ROAD", "120 PL", "MC", "ELM ST (old) NB EB",
]
LABELS = ["", "(GATE)", "CITY LIMIT (DOVER ST)", "DEAD END (ACTON ST)", "CUL-DE-SAC", "WEST END", "END OF PAVEMENT", "BEG OF X", "AQUATIC PARK", "RRX", "WESTEND", "ACTON ST", "MLK/ ADELINE ST", "374' E/O MARTIN LUTHER KING JR WAY", "100 FT NO PRINCE ST", "OPP ELM ST", "260' NORTH OF PRIVATE PROP", "A & B AND C, A", "near x. st."]
CODES = ["2.3A", "2B", "3.0", "0.2", " 4 ", "0", "", "NONE", "9", "0.0", "3b.1", "1.9"]


def literal(spark: SparkSession, values: list[str]) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], "x string").coalesce(1)


def values_sql(values: list[str]) -> str:
    return "(values " + ", ".join("('" + v.replace("'", "''") + "')" for v in values) + ") t(x)"


def map_sql(table_: dict[str, str], key: str) -> str:
    return f"case {key} " + " ".join(f"when '{a}' then '{b}'" for a, b in table_.items()) + " end"


def ordinal_sql(t: str) -> str:
    digits = f"(case when ltrim({t}, '0') = '' then '0' else ltrim({t}, '0') end)"
    return f"""case when regexp_full_match({t}, '[0-9]+') then {digits} || case when {digits}::bigint % 100 between 10 and 20 then 'TH' when {digits}::bigint % 10 = 1 then 'ST'
when {digits}::bigint % 10 = 2 then 'ND' when {digits}::bigint % 10 = 3 then 'RD' else 'TH' end else coalesce({map_sql(K.ORDINAL_WORDS, t)}, {t}) end"""


def normalize_sql(source: str, keep: str) -> str:
    """Common table expressions that end in n(keep..., name)."""
    lead, tail = "|".join(K.LEADING), "|".join(K.BOUNDS)
    return f"""
n1 as (select *, regexp_replace(trim(regexp_replace(replace(regexp_replace(upper(coalesce(x, '')), '\\(.*?\\)', ' ', 'g'), '&', ' AND '), '[^A-Z0-9]+', ' ', 'g')), '(?: (?:{tail}))+$', '') as s from {source}),
n2 as (select *, {map_sql(K.SUFFIXES, "regexp_extract(s, ' ([A-Z0-9]+)$', 1)")} as suffix from n1),
n3 as (select *, regexp_replace(regexp_replace(case when suffix is null then s else regexp_replace(s, ' [A-Z0-9]+$', '') end, '^MC ', 'MC'), '^(?:(?:{lead}) )+', '') as c from n2),
n4 as (select *, array_to_string([{ordinal_sql('t')} for t in string_split(c, ' ')], ' ') as c2 from n3),
n5 as (select *, trim(concat_ws(' ', coalesce({map_sql(K.CORE_ALIASES, 'c2')}, c2), suffix)) as o from n4),
n as (select {keep}, coalesce({map_sql(K.FULL_ALIASES, 'o')}, o) as name from n5)"""


@query
def norm_names(spark: SparkSession, d: str) -> DataFrame:
    """Canonical names of literal and of table texts, with the core and the variants."""
    rows = literal(spark, NAMES).unionByName(table(spark, d, "customer").select(F.concat_ws(" ", F.lpad((F.col("c_custkey") % 130).cast("string"), 3, "0"), "c_mktsegment", F.element_at(F.array(*map(F.lit, ("St.", "AVEN", "(x) Bl", "N"))), (F.col("c_custkey") % 4 + 1).cast("int"))).alias("x")).distinct())
    name = names.normalize(F.col("x"))
    return rows.select("x", name.alias("name"), names.core_of(name).alias("core"), F.size(names.variants(F.col("x"))).alias("n_variants"))


SQL["norm_names"] = f"""with r as (select * from {values_sql(NAMES)} union all select distinct lpad((c_custkey % 130)::varchar, 3, '0') || ' ' || c_mktsegment || ' ' || (['St.', 'AVEN', '(x) Bl', 'N'])[(c_custkey % 4 + 1)::int] from customer),
{normalize_sql('r', 'x')} select x, name, regexp_replace(name, ' [^ ]+$', '') as core, case when contains(name, ' ') then 2 else 1 end as n_variants from n"""


@query
def ordinals(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("x")).unionByName(literal(spark, [*K.ORDINAL_WORDS, "007", "OTHER", "000"]))
    return rows.select("x", names.ordinal(F.col("x")).alias("ordinal"))


SQL["ordinals"] = f"select x, {ordinal_sql('x')} as ordinal from (select p_partkey::varchar as x from part union all select x from {values_sql([*K.ORDINAL_WORDS, '007', 'OTHER', '000'])})"


@query
def label_terminal(spark: SparkSession, d: str) -> DataFrame:
    return literal(spark, LABELS).select("x", names.is_terminal(F.col("x")).alias("terminal"))


_CLEAN = "trim(regexp_replace(translate(regexp_replace(upper(x), '\\(.*?\\)', ' ', 'g'), '.-', '  '), '\\s+', ' ', 'g'))"
_TERMINAL = f"({_CLEAN} = '' or {_CLEAN} in ({', '.join(repr(t) for t in K.TERMINALS)}) or regexp_matches({_CLEAN}, 'CITY LIMIT|CUL DE SAC|DEAD END| END$|^(?:END|BEG|BEGIN|START) '))"
_OFF = "^\\s*[0-9]+\\s*''?\\s*(?:FT\\.?|FEET)?\\s*[NSEW]{1,2}\\s*/?O\\s+"
SQL["label_terminal"] = f"select x, {_TERMINAL} as terminal from {values_sql(LABELS)}"


@query
def label_soft(spark: SparkSession, d: str) -> DataFrame:
    return literal(spark, LABELS).select("x", names.is_soft(F.col("x")).alias("soft"), names.is_offset(F.col("x")).alias("is_offset"))


SQL["label_soft"] = f"select x, {_TERMINAL} or o as soft, o as is_offset from (select x, regexp_matches(trim(regexp_replace(upper(x), '\\(.*?\\)', ' ', 'g')), '{_OFF}.+$') as o from {values_sql(LABELS)})"


@query
def label_alts(spark: SparkSession, d: str) -> DataFrame:
    rows = literal(spark, LABELS).select("x", names.label_alternatives(F.col("x")).alias("a"))
    return rows.select("x", F.posexplode("a").alias("nth", "name"))


SQL["label_alts"] = f"""with c as (select x, list_concat(regexp_extract_all(upper(x), '\\((.*?)\\)', 1), [regexp_replace(upper(x), '\\(.*?\\)', ' ', 'g')]) as chunks from {values_sql(LABELS)}),
p as (select x, flatten([regexp_split_to_array(regexp_replace(k, '^\\s*(?:OPP|OPPOSITE|APPROX|NEAR|AT)\\s+', ' '), '[/&,]| AND ') for k in chunks]) as pieces from c),
q as (select x, [trim(v, ' .') for v in pieces if trim(v, ' .') <> ''] as pieces from p),
r as (select x, [case when regexp_matches(v, '{_OFF}.+$') then trim(regexp_replace(v, '{_OFF}', '')) else v end for v in pieces] as pieces from q),
s as (select x, unnest(pieces) as name, generate_subscripts(pieces, 1) as i from r),
u as (select x, name, min(i) as i from s group by x, name)
select x, (row_number() over (partition by x order by i) - 1)::int as nth, name from u"""


@query
def title_case(spark: SparkSession, d: str) -> DataFrame:
    rows = literal(spark, ["MLK JR WAY", "62ND ST", "ST. MARY'S", "mary's o-neil  x", ""]).unionByName(table(spark, d, "part").select(F.col("p_name").alias("x")).distinct())
    return rows.select("x", scalars.title(F.col("x")).alias("title"))


SQL["title_case"] = f"""select x, case when regexp_matches(s, '^[0-9]') then s else array_to_string([upper(p[1]) || lower(p[2:]) for p in regexp_extract_all(s, '[A-Za-z]+|[^A-Za-z]+')], '') end as title
from (select x, trim(regexp_replace(x, '\\s+', ' ', 'g')) as s from (select x from {values_sql(["MLK JR WAY", "62ND ST", "ST. MARY'S", "mary's o-neil  x", ""])} union all select distinct p_name from part))"""

_CELLS = ["1,234.5", " 12 ", "", "x", "$1,200", "-3", "A - Arterial", "B-Collector - Major", "Slurry  Seal", "SLURRYSEAL!", "Poor (12) (x)", "ST. A."]
_TREAT = {"slurryseal": "Slurry seal", "overlay": "Overlay"}


@query
def clean_cells(spark: SparkSession, d: str) -> DataFrame:
    """Numbers, codes, treatments, notes and blanks of report cells."""
    x = F.col("x")
    return literal(spark, _CELLS).select(
        "x", scalars.blank_to_null(x).alias("value"), scalars.number(x).alias("number"), scalars.coded({"x": "Unknown"}, x).alias("code"), scalars.clean_treatment(_TREAT, x).alias("treatment"),
        scalars.after_dash(x).alias("fc"), scalars.without_parenthetical(x).alias("condition"), F.trim(F.replace(x, F.lit("."), F.lit(""))).alias("name"), scalars.html_escape(F.concat(x, F.lit("<&>"))).alias("html"),
    )


SQL["clean_cells"] = f"""select x, nullif(x, '') as value, try_cast(replace(trim(x), ',', '') as double) as number, case x when 'x' then 'Unknown' else x end as code,
  coalesce({map_sql(_TREAT, "regexp_replace(lower(x), '[^a-z]', '', 'g')")}, trim(regexp_replace(x, '\\s+', ' ', 'g'))) as treatment, trim(regexp_replace(x, '^[^-]*-', '')) as fc,
  regexp_replace(x, '\\s*\\(.*\\)', '') as condition, trim(replace(x, '.', '')) as name, replace(replace(replace(x || '<&>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;') as html from {values_sql(_CELLS)}"""


@query
def oakland_class(spark: SparkSession, d: str) -> DataFrame:
    return literal(spark, CODES).select("x", scalars.oakland_class(F.col("x")).alias("c")).select("x", "c.primary", "c.secondary", names.lookup(K.CLASS_LABEL, F.col("c.primary")).alias("label"), names.lookup(K.TIER_OF, F.col("c.primary")).alias("tier"))


SQL["oakland_class"] = f"""with c as (select x, case when upper(trim(x)) in ('', '0', '0.0', 'NONE') then [] else [t for t in string_split(upper(trim(x)), '.') if t not in ('', '0')] end as t from {values_sql(CODES)}),
p as (select x, {map_sql(K.OAKLAND_CLASS, 't[1]')} as c1, {map_sql(K.OAKLAND_CLASS, 't[2]')} as c2 from c)
select x, c1 as "primary", c2 as "secondary", {map_sql(K.CLASS_LABEL, 'c1')} as label, {map_sql(K.TIER_OF, 'c1')} as tier from p"""


@query
def osm_class(spark: SparkSession, d: str) -> DataFrame:
    """Classes of tags that stand for events' types and properties."""
    k = F.get_json_object("props", "$.k").cast("int")
    side = F.element_at(F.array(*map(F.lit, ("track", "lane", "shared_lane", "no", "buffered_lane", ""))), (k % 6 + 1).cast("int"))
    key = F.element_at(F.array(*map(F.lit, ("cycleway", "cycleway:left", "cycleway:right", "cycleway:both"))), (F.col("event_id") % 4 + 1).cast("int"))
    tags = F.map_filter(
        F.create_map(key, side, F.lit("highway"), F.when(F.col("event_type") == "purchase", "cycleway").otherwise("residential"), F.lit("cyclestreet"), F.when(F.col("event_id") % 10 == 0, "yes"), F.lit("cycleway:buffer"), F.when(F.col("event_id") % 7 == 0, "yes")),
        lambda _, v: v.isNotNull(),
    )
    return table(spark, d, "events").select("event_id", scalars.osm_class(tags).alias("class"), scalars.tag_dump(tags, "^cycle").alias("dump"))


SQL["osm_class"] = """with e as (select event_id, event_type, (['track', 'lane', 'shared_lane', 'no', 'buffered_lane', ''])[((props->>'$.k')::int % 6 + 1)::int] as side, (['cycleway', 'cycleway:left', 'cycleway:right', 'cycleway:both'])[(event_id % 4 + 1)::int] as key from events)
select event_id, case when event_type = 'purchase' then 'I' when event_id % 10 = 0 then 'IIIB' when side = 'track' then 'IV' when side in ('lane', 'buffered_lane') then case when event_id % 7 = 0 or side = 'buffered_lane' then 'IIB' else 'II' end
  when side = 'shared_lane' then 'IIIA' end as class,
  array_to_string([t.k || '=' || t.v for t in list_sort([{'k': key, 'v': side}, {'k': 'cyclestreet', 'v': case when event_id % 10 = 0 then 'yes' end}, {'k': 'cycleway:buffer', 'v': case when event_id % 7 = 0 then 'yes' end}]) if t.v is not null], ';') as dump from e"""


@query
def plan_class(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.element_at(F.array(*map(F.lit, ("Cycletrack", "Bike Boulevard", "Upgraded lane", "Path", "Route"))), (F.col("p_partkey") % 5 + 1).cast("int")).alias("t"), F.element_at(F.array(*map(F.lit, ("iv", "II", "I", "III", ""))), (F.col("p_size") % 5 + 1).cast("int")).alias("raw"))
    return rows.select("p_partkey", scalars.plan_class(F.col("t"), F.col("raw")).alias("class"), scalars.coded(K.BERKELEY_2004, F.element_at(F.array(*map(F.lit, ("BB - 3", "1", "x"))), (F.col("p_partkey") % 3 + 1).cast("int"))).alias("class_2004"))


SQL["plan_class"] = """with r as (select p_partkey, (['Cycletrack', 'Bike Boulevard', 'Upgraded lane', 'Path', 'Route'])[(p_partkey % 5 + 1)::int] as t, (['IV', 'II', 'I', 'III', ''])[(p_size % 5 + 1)::int] as raw from part)
select p_partkey, case when raw = 'IV' or t = 'Cycletrack' then 'IV' when t = 'Bike Boulevard' then 'IIIB' when raw = 'II' then case when t = 'Upgraded lane' then 'IIB' else 'II' end when raw in ('I', 'III') then raw end as class,
  (['IIIB', 'I', 'x'])[(p_partkey % 3 + 1)::int] as class_2004 from r"""


@query
def epoch_active(spark: SparkSession, d: str) -> DataFrame:
    """Days of epoch milliseconds, and whether written days are still to come."""
    day = scalars.epoch_date(F.when(F.col("event_id") % 50 != 0, F.unix_millis(F.col("ts").cast("timestamp"))).otherwise(F.lit(0)))
    written = F.when(F.col("event_id") % 9 == 0, "soon").otherwise(F.date_format("ts", "M/d/yyyy"))
    return table(spark, d, "events").select("event_id", day.alias("day"), scalars.active(written, "2024-01-15").alias("active"))


SQL["epoch_active"] = "select event_id, case when event_id % 50 <> 0 then ts::date end as day, case when event_id % 9 <> 0 then ts::date >= date '2024-01-15' end as active from events"


@query
def json_props(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", json_tags(F.col("props")).alias("tags"))
    return rows.select("event_id", F.col("tags")["k"].alias("k"), F.size("tags").alias("n"))


SQL["json_props"] = "select event_id, props->>'$.k' as k, len(json_keys(props))::int as n from events"


@query
def reasons(spark: SparkSession, d: str) -> DataFrame:
    """Mismatch reasons from relative errors, with their group."""
    error = F.abs(F.col("l_quantity") - 20) / 20
    rows = table(spark, d, "lineitem").select(scalars.mismatch_reason(error).alias("reason")).distinct()
    return rows.select("reason", scalars.reason_group(F.col("reason")).alias("reason_group"))


SQL["reasons"] = "select distinct 'length mismatch (' || round_even(abs(l_quantity - 20) / 20 * 100, 0)::int || '%)' as reason, 'length mismatch' as reason_group from lineitem"


@query
def rounded(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_quantity").cast("int").alias("q")).distinct()
    return rows.select("q", scalars.round_even(F.col("q") / 4, 1).alias("r"), scalars.thousands(F.col("q") * 1234).alias("shown"))


SQL["rounded"] = "select distinct trunc(l_quantity)::int as q, round_even(trunc(l_quantity)::int / 4, 1) as r, format('{:,}', trunc(l_quantity)::int * 1234) as shown from lineitem"
