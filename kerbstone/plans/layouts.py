"""Layout reconstruction over events, conversations, pages and documents as stand-ins for report words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gates, layout
from ..sources.features import html_cells, pages_with, text_lines
from ..sources.tables import table

QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _minutes(spark: SparkSession, d: str) -> DataFrame:
    """Events as words: the user is the page, the hours since the first of the year the position."""
    hours = F.floor((F.unix_timestamp("ts") - F.unix_timestamp(F.lit("2024-01-01").cast("timestamp"))) / 3600).cast("double")
    return table(spark, d, "events").select(F.col("user_id").alias("page"), hours.alias("top"), "event_id", "event_type", "value")


_WORDS = "w as (select user_id as page, floor(epoch(ts - timestamp '2024-01-01') / 3600)::double as top, event_id, event_type, value from events)"


@query
def anchor_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines whose words lie within 24 of the line's first word."""
    return layout.group_lines(_minutes(spark, d), ["page"], tolerance=24.0).groupBy("page", "line").agg(F.min("top").alias("first"), F.max("top").alias("last"), F.count("*").alias("n"))


SQL["anchor_lines"] = f"""with recursive {_WORDS}, v as (select distinct page, top from w), o as (select page, top, row_number() over (partition by page order by top) as k from v),
f as (select page, k, top, top as first, 0 as line from o where k = 1
  union all select o.page, o.k, o.top, case when abs(o.top - f.first) <= 24 then f.first else o.top end, case when abs(o.top - f.first) <= 24 then f.line else f.line + 1 end from f join o on o.page = f.page and o.k = f.k + 1)
select page, line, min(w.top) as first, max(w.top) as last, count(*) as n from w join f using (page, top) group by page, line"""


@query
def gap_groups(spark: SparkSession, d: str) -> DataFrame:
    """Groups whose words lie less than 16 from the one before."""
    return layout.gap_groups(_minutes(spark, d), ["page"], "top").groupBy("page", "group").agg(F.min("top").alias("first"), F.max("top").alias("last"), F.count("*").alias("n"))


SQL["gap_groups"] = f"""with {_WORDS}, g as (select *, case when top - lag(top) over (partition by page order by top) < 16 then 0 else 1 end as new from w),
s as (select *, (sum(new) over (partition by page order by top range between unbounded preceding and current row) - 1)::bigint as "group" from g)
select page, "group", min(top) as first, max(top) as last, count(*) as n from s group by 1, 2"""


@query
def column_cut(spark: SparkSession, d: str) -> DataFrame:
    """Words to columns by their middle, joined from left to right."""
    words = _minutes(spark, d).select("page", F.floor(F.col("top") / 100).alias("line"), (F.col("value") - 1).alias("x0"), (F.col("value") + 1).alias("x1"), F.col("event_type").alias("text"))
    return layout.cut_columns(words, ["page", "line"], [("low", 5.0), ("mid", 20.0), ("high", 1e9)])


SQL["column_cut"] = f"""with {_WORDS}, x as (select page, floor(top / 100)::bigint as line, value - 1 as x0, value + 1 as x1, event_type as text, case when (value - 1 + value + 1) / 2 < 5 then 'low' when (value - 1 + value + 1) / 2 < 20 then 'mid' else 'high' end as c from w)
select page, line, coalesce(string_agg(text, ' ' order by x0, x1, text) filter (where c = 'low'), '') as low, coalesce(string_agg(text, ' ' order by x0, x1, text) filter (where c = 'mid'), '') as mid,
coalesce(string_agg(text, ' ' order by x0, x1, text) filter (where c = 'high'), '') as high from x group by page, line"""


@query
def noise_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return layout.without_noise(rows, ["role", "text"], "assistant A|user [B-D]")


SQL["noise_filter"] = "select conv_id, turn, role, text from conversations where not regexp_matches(trim(regexp_replace(concat_ws(' ', role, text), ' +', ' ', 'g')), '^(?:assistant A|user [B-D])')"


@query
def continuation_rows(spark: SparkSession, d: str) -> DataFrame:
    """A user's turn starts a row, and the turns that answer it add their text."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    found = layout.continued(rows, ["conv_id"], ["turn", "role", "text"], F.col("role") == "user", F.col("role") == "assistant", ["role"], ["text"])
    return found


SQL["continuation_rows"] = """with r as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
n as (select *, sum((role = 'user')::int) over (partition by conv_id order by turn, role, text) as "row" from r where role in ('user', 'assistant'))
select conv_id, "row"::bigint as "row", max(role) filter (where role = 'user') as role, coalesce(string_agg(text, ' ' order by turn, role, text) filter (where text <> ''), '') as text from n where "row" > 0 group by 1, 2"""


@query
def carry_forward(spark: SparkSession, d: str) -> DataFrame:
    """The last banner (a purchase) that an event stands under, or the first plan's name."""
    banner = F.when(F.col("event_type") == "purchase", F.concat(F.lit("FY"), F.col("event_id").cast("string")))
    return _minutes(spark, d).select("page", "event_id", layout.carried(banner, ["page"], ["top", "event_id"], "5-Year Rehab").alias("banner"))


SQL["carry_forward"] = f"""with {_WORDS} select page, event_id, coalesce(last_value(case when event_type = 'purchase' then 'FY' || event_id end ignore nulls) over (partition by page order by top, event_id rows between unbounded preceding and current row), '5-Year Rehab') as banner from w"""


@query
def split_limits(spark: SparkSession, d: str) -> DataFrame:
    begin = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.col("o_orderpriority"), F.lit(" to "), F.col("o_orderstatus"), F.lit(" to x"))).otherwise(F.col("o_orderpriority"))
    a, b = layout.split_limits(begin, F.when(F.col("o_orderkey") % 6 == 0, F.lit("END")).otherwise(F.lit("")))
    return table(spark, d, "orders").select("o_orderkey", a.alias("beg"), b.alias("end"))


SQL["split_limits"] = """select o_orderkey, case when o_orderkey % 6 = 0 then o_orderpriority || ' to ' || o_orderstatus || ' to x' else o_orderpriority end as beg,
case when o_orderkey % 6 = 0 then 'END' when o_orderkey % 3 = 0 then o_orderstatus || ' to x' else '' end as "end" from orders"""


@query
def dated_lines(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose last cell is a day, against a recount of lines with two days."""
    text = F.concat_ws(" ", F.date_format("o_orderdate", "M/d/yyyy"), F.when(F.col("o_orderkey") % 4 != 0, F.date_format("o_orderdate", "M/d/yyyy")).otherwise("open"))
    rows = table(spark, d, "orders").select(F.split(text, " ")[1].alias("ends"), text.alias("line"))
    kept = layout.dated_rows(rows).agg(F.count("*").alias("kept"))
    return kept.crossJoin(F.broadcast(gates.recount(rows, "line", r"\d{1,2}/\d{1,2}/\d{4}", 2)))  # one row each


SQL["dated_lines"] = "select count(*) filter (where o_orderkey % 4 <> 0) as kept, count(*) filter (where o_orderkey % 4 <> 0) as recount from orders"


@query
def nearest_attach(spark: SparkSession, d: str) -> DataFrame:
    """Each error event with the nearest purchase of its user, the earlier of two as near."""
    words = _minutes(spark, d)
    fragments = words.where("event_type = 'error'").select("page", "top", "event_id")
    anchors = words.where("event_type = 'purchase'").groupBy("page", "top").agg(F.min("event_id").alias("anchor"))
    return layout.nearest_anchor(fragments, anchors, ["page"], "top", "anchor")


SQL["nearest_attach"] = f"""with {_WORDS}, f as (select page, top, event_id from w where event_type = 'error'), a as (select page, top, min(event_id) as anchor from w where event_type = 'purchase' group by 1, 2),
j as (select f.*, a.anchor, a.top as anchor_at, row_number() over (partition by f.event_id order by abs(f.top - a.top), a.top) as k from f left join a on f.page = a.page)
select page, top, event_id, anchor, anchor_at from j where k = 1"""


@query
def project_fields(spark: SparkSession, d: str) -> DataFrame:
    own = F.when(F.col("p_size") % 3 == 0, F.round(F.col("p_size") / 10, 1).cast("string")).otherwise(F.when(F.col("p_size") % 4 == 0, F.lit("")).otherwise(F.lit("-")))
    other = F.when(F.col("p_size") % 3 == 1, F.lit("0.0")).otherwise(F.lit("1.5"))
    cls = F.concat(F.lit("Class "), F.element_at(F.array(*map(F.lit, ("I", "II", "III", "IV", "V"))), (F.col("p_size") % 5 + 1).cast("int")), F.lit(" lane"))
    return table(spark, d, "part").select("p_partkey", *layout.project_fields(own, other, cls))


SQL["project_fields"] = """with r as (select p_partkey, p_size, case p_size % 3 when 0 then round(p_size / 10, 1) end as miles from part)
select p_partkey, miles, (['I', 'II', 'III', 'IV', ''])[(p_size % 5 + 1)::int] as class_raw, case when miles <> 0 then 'segment' else 'spot' end as kind from r
where p_size % 4 <> 0 union all select p_partkey, case p_size % 3 when 0 then round(p_size / 10, 1) when 1 then 0.0 else 1.5 end as miles, (['I', 'II', 'III', 'IV', ''])[(p_size % 5 + 1)::int],
  case when p_size % 3 = 1 or (p_size % 3 = 0 and p_size = 0) then 'spot' else 'segment' end from part where p_size % 4 = 0"""


def _plan_lines(spark: SparkSession, d: str) -> DataFrame:
    """Events as lines of a project list, one for each user and hour: purchases are projects, errors labels, others fragments."""
    one = _minutes(spark, d).groupBy("page", "top").agg(F.min(F.struct("event_id", "event_type", "value")).alias("e")).select("page", "top", "e.*")
    e, kind = F.col("event_id"), F.col("event_type")
    text = lambda p, when: F.when(when, F.concat(F.lit(p), e.cast("string")))
    other = ~kind.isin("purchase", "error")
    return one.select(
        "page", "top", text("C", (kind == "error") | ((kind == "purchase") & (e % 3 == 0))).alias("corridor"),
        F.when(other & (e % 4 == 0), F.concat(F.lit("class  "), F.element_at(F.array(*map(F.lit, ("II", "IV", "iii", "V"))), (e % 4 + F.floor(e / 4) % 4 + 1).cast("int")), F.lit(" t"), e.cast("string"))).when(kind == "purchase", F.concat(F.lit("p"), e.cast("string"))).alias("treatment"),
        text("L", other).alias("location"), text("a", other & (e % 5 == 0)).alias("cross_a"), F.lit(None).cast("string").alias("cross_b"),
        F.when(other & (e % 6 == 0), F.concat(F.lit("1."), (e % 10).cast("string"))).when((kind == "purchase") & (e % 7 == 0), F.lit("0.0")).when((kind == "purchase") & (e % 11 == 0), F.lit("n/a")).alias("miles"),
        F.when(kind == "purchase", F.concat(F.lit("$ "), F.format_number(F.floor(F.col("value") * 1000), 0))).alias("cost"),
    )


@query
def plan_projects(spark: SparkSession, d: str) -> DataFrame:
    """Projects of a wrapped list: fragments and labels of each page attached to the nearest cost."""
    return layout.projects(_plan_lines(spark, d))


SQL["plan_projects"] = f"""with {_WORDS}, o as (select page, top, arg_min({{'e': event_id, 'k': event_type, 'v': value}}, event_id) as x from w group by 1, 2),
l as (select page, top, x.e as e, x.k as k, x.v as v, x.k not in ('purchase', 'error') as other from o),
a as (select page, top, e, case when e % 3 = 0 then 'C' || e end as corridor, case when e % 7 = 0 then '0.0' when e % 11 = 0 then 'n/a' end as own, floor(v * 1000)::bigint::varchar as cost from l where k = 'purchase'),
f as (select page, top, case when e % 4 = 0 then 'class  ' || (['II', 'IV', 'iii', 'V'])[(e // 4 % 4 + 1)::int] || ' t' || e end as treatment, 'L' || e as location, case when e % 5 = 0 then 'a' || e end as cross_a, case when e % 6 = 0 then '1.' || (e % 10) end as miles from l where other),
n as (select f.*, a.top as near, row_number() over (partition by f.page, f.top order by abs(f.top - a.top), a.top) as r from f join a on f.page = a.page),
p as (select page, near, top, treatment, location, cross_a, miles from n where r = 1 union all select page, top, top, 'p' || e, null, null, null from a),
t as (select page, near, coalesce(string_agg(treatment, ' ' order by top), '') as treatment, coalesce(string_agg(location, ' ' order by top), '') as location, coalesce(string_agg(cross_a, ' ' order by top), '') as cross_a, arg_min(miles, top) filter (where miles is not null) as fm from p group by 1, 2),
g0 as (select page, top, 'C' || e as c, case when top - lag(top) over (partition by page order by top) < 16 then 0 else 1 end as new from l where k = 'error'),
g1 as (select *, sum(new) over (partition by page order by top) as g from g0), g as (select page, g, max(top) as last, string_agg(c, ' ' order by top) as label from g1 group by 1, 2),
b as (select a.page, a.top, g.label, row_number() over (partition by a.page, a.top order by abs(g.last - a.top), g.last) as r from a join g on a.page = g.page),
m as (select a.page, a.top, coalesce(a.corridor, b.label, '') as corridor, t.treatment, t.location, t.cross_a, coalesce(a.own, t.fm) as mt, a.cost from a join t on t.page = a.page and t.near = a.top left join b on b.page = a.page and b.top = a.top and b.r = 1),
z as (select *, case when regexp_full_match(mt, '[0-9.]+') then mt::double end as mi from m)
select page, top, corridor, treatment, location, cross_a, '' as cross_b, mi as miles, upper(regexp_extract(treatment, '(?i)class\\s+(IV|III|II|I)\\b', 1)) as class_raw, case when coalesce(mi, 0) <> 0 then 'segment' else 'spot' end as kind, cost from z"""


@query
def ruled_table(spark: SparkSession, d: str) -> DataFrame:
    """Rows of ruled tables from their cells: short rows, headers, and rows without a score or a cost are left out."""
    k = F.col("o_orderkey")
    street = F.when(k % 50 == 0, "Street Name").when(k % 51 == 0, "").otherwise(F.concat(F.lit("S "), F.col("o_custkey").cast("string")))
    cost = F.concat(F.when(k % 17 == 0, "").otherwise(F.lit("$")), F.floor("o_totalprice").cast("string"))
    texts = [street, F.lit("from"), F.lit("to  x"), F.col("o_orderstatus"), F.when(k % 13 == 0, "12a").otherwise((k % 1200).cast("string")), F.lit("slurry"), cost]
    cells = table(spark, d, "orders").select("o_orderkey", F.posexplode(F.when(k % 19 == 0, F.array(*texts[:6])).otherwise(F.array(*texts))).alias("col", "text"))
    return layout.ruled_rows(cells, ["o_orderkey"], ["street", "beg", "end", "fc", "pci", "treatment", "cost"])


SQL["ruled_table"] = """with r as (select *, o_orderkey as k from orders)
select o_orderkey, 'S ' || o_custkey as street, 'from' as beg, 'to x' as "end", o_orderstatus as fc, (k % 1200)::varchar as pci, 'slurry' as treatment, '$' || floor(o_totalprice)::bigint as cost
from r where k % 50 <> 0 and k % 51 <> 0 and k % 13 <> 0 and k % 17 <> 0 and k % 19 <> 0 and k % 1200 < 1000"""


@query
def html_list(spark: SparkSession, d: str) -> DataFrame:
    """The cells of pages' list elements and links, in order."""
    rows = table(spark, d, "pages").select("page_id", F.explode(F.array(*[F.struct(F.lit(t).alias("tag"), html_cells(F.col("html"), t).alias("cells")) for t in ("li", "a")])).alias("x"))
    return rows.select("page_id", "x.tag", F.posexplode("x.cells").alias("nth", "cell"))


SQL["html_list"] = """with r as (select page_id, tag, regexp_extract_all(html, p, 1) as found from pages, (values ('li', '<li(?: [^>]*)?>(.*?)</li>'), ('a', '<a(?: [^>]*)?>(.*?)</a>')) t(tag, p)),
s as (select page_id, tag, unnest(found) as c, generate_subscripts(found, 1) - 1 as nth from r)
select page_id, tag, nth::int as nth, trim(regexp_replace(regexp_replace(c, '<[^>]*>', '', 'g'), '\\s+', ' ', 'g')) as cell from s"""


@query
def text_lines_regex(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents that name a licence version, by number of line."""
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(text_lines(F.col("text"))).alias("line", "text"))
    kept = rows.where(F.col("text").rlike("(?:Version|version) [0-9]"))
    return kept.select("doc_id", "line", F.regexp_extract("text", "[Vv]ersion ([0-9](?:\\.[0-9])?)", 1).alias("version"))


SQL["text_lines_regex"] = """with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as t, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 as line from documents)
select doc_id, line::int as line, regexp_extract(t, '[Vv]ersion ([0-9](?:\\.[0-9])?)', 1) as version from l where regexp_matches(t, '(?:Version|version) [0-9]')"""


@query
def marked_pages(spark: SparkSession, d: str) -> DataFrame:
    """Words of the pages (conversations) some line (turn) of which holds a marker."""
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("page"), "turn", "text")
    words = turns.select("page", "turn", F.posexplode(F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")).alias("nth", "word"))
    return pages_with(words, turns, "text", "the ")


SQL["marked_pages"] = """with w as (select conv_id as page, turn, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') as words from conversations where conv_id in (select conv_id from conversations where contains(text, 'the ')))
select page, turn, unnest(range(len(words)))::int as nth, unnest(words) as word from w"""
