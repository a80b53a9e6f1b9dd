"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Documents are summed to cells (source, language, topic) of tokens, on the map side first. The cells' token weights are
raked: scaled to each margin's target shares in turn, until the margins hold. A cell's documents are kept with a
probability in proportion to its raked over its actual weight, the largest being 1; the draw is a hash of the doc_id, so it
does not depend on partitions or attempts.

A target that is not given is the actual share to the power of ``temper``, made to sum to 1: rarer values gain. A value
that given targets don't name has target 0.

Raking goes on until the margins hold or come no nearer; where targets contradict each other, what is left of the
gap is told in a warning.

All of it is DataFrame operations. Defined results: a null source or language is the value ``(none)``; a text without words
has the topic ``empty`` and no tokens, weighs nothing and is kept; rows that share a doc_id are kept or left together in a
cell, as are those without one; ties don't matter; very long texts are counted whole; an empty table gives no rows. Other
columns pass as they are, whatever their names: the ones added here give way by longer names (see ``mixed``).
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import cut_lineage, unused

MARGINS = ("source", "lang", "topic")
#: Cells that are few enough to broadcast (four short columns each).
BROADCAST_CELLS = 100_000
_WORD = "[^ \\t-\\r]+"


def tokens(text: Column) -> Column:
    """Words (runs of characters other than ASCII white space) of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def topic(text: Column, n: Column) -> Column:
    """The kind of text, by the first rule that holds; n is its number of tokens."""
    return (
        F.when(n == 0, "empty")
        .when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("@")) | F.contains(text, F.lit("://")), "contact")
        .when(n < 100, "short")
        .when(n < 1000, "article")
        .otherwise("book")
    )


#: The columns that are added to the documents.
ADDED = ("__source", "__lang", "__topic", "__tokens", "__p", "__kept")


def celled(docs: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The documents with __source, __lang, __topic and __tokens, or the columns of these ``names``."""
    source, lang, kind, count = (names or ADDED)[:4]
    n = tokens(F.col("text"))
    return docs.withColumns({count: n, source: F.coalesce(F.col("source").cast("string"), F.lit("(none)")), lang: F.coalesce(F.col("lang").cast("string"), F.lit("(none)"))}).withColumn(kind, topic(F.col("text"), F.col(count)))


def rake(spark: SparkSession, cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: dict[str, float] | None = None, tolerance: float = 1e-10) -> DataFrame:
    """``cells`` (__source, __lang, __topic, t) with ``w``, whose margins are the target shares within ``tolerance``."""
    targets, temper = targets or {}, temper or {}
    now = cells.where("t > 0").withColumn("w", F.col("t").cast("double"))
    for m in MARGINS:
        if m in targets:
            given = F.create_map(*[F.lit(x) for pair in targets[m].items() for x in pair])
            total = sum(targets[m].values())
            now = now.withColumn(f"g_{m}", F.coalesce(given[F.col(f"__{m}")], F.lit(0.0)) / total)
        else:
            sums = now.groupBy(f"__{m}").agg(F.sum("t").cast("double").alias("s"))
            powered = cut_lineage(spark, sums.withColumn("s", F.pow("s", F.lit(float(temper.get(m, 1.0))))))
            total = powered.agg(F.sum("s")).first()[0] or 1.0
            now = now.join(powered.select(f"__{m}", (F.col("s") / F.lit(total)).alias(f"g_{m}")), f"__{m}")
    now = cut_lineage(spark, now)
    before = float("inf")
    while True:
        for m in MARGINS:
            now = now.withColumn("w", F.expr(f"coalesce(w * g_{m} / nullif(sum(w) over (partition by __{m}), 0), 0)"))
        now = cut_lineage(spark, now)
        gaps = [now.groupBy(f"__{m}").agg(F.abs(F.sum("w") - F.first(f"g_{m}")).alias("gap")).agg(F.max("gap").alias("gap")) for m in MARGINS]
        worst = gaps[0].unionByName(gaps[1]).unionByName(gaps[2]).agg(F.max("gap")).first()[0]
        if worst is None or worst <= tolerance:
            return now
        if worst > 0.999 * before:
            warnings.warn(f"the targets contradict each other: margins hold within {worst:.3g} only", stacklevel=2)
            return now
        before = worst


def probabilities(spark: SparkSession, docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: dict[str, float] | None = None) -> DataFrame:
    """(__source, __lang, __topic, t, w, p): each cell's tokens, raked weight and probability of keeping a document."""
    cells = cut_lineage(spark, celled(docs.select("text", "source", "lang")).groupBy("__source", "__lang", "__topic").agg(F.sum("__tokens").alias("t")))
    raked = rake(spark, cells, targets, temper)
    most = raked.agg(F.max(F.col("w") / F.col("t"))).first()[0] or 1.0
    return cut_lineage(spark, raked.select("__source", "__lang", "__topic", "t", "w", F.least(F.lit(1.0), F.col("w") / F.col("t") / F.lit(most)).alias("p")))


def draw(doc_id: Column, seed: int) -> Column:
    """A number from 0 up to 1 by a hash of the id."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def mixed(spark: SparkSession, docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: dict[str, float] | None = None, seed: int = 7) -> DataFrame:
    """``docs`` with __source, __lang, __topic, __tokens, __p (probability) and __kept as the last columns.

    Where ``docs`` has a column of such a name, the added one has more underscores.
    """
    names = unused(docs.columns, *ADDED)
    source, lang, kind, _, p, kept = names
    cells = probabilities(spark, docs, targets, temper).select(F.col("__source").alias(source), F.col("__lang").alias(lang), F.col("__topic").alias(kind), F.col("p").alias(p))
    few = cells.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
    both = celled(docs, names).join(F.broadcast(cells) if few else cells, [source, lang, kind], "left")
    return both.withColumn(p, F.coalesce(p, F.lit(1.0))).withColumn(kept, draw(F.col("doc_id"), seed) < F.col(p)).select(*docs.columns, *names)


def mix(spark: SparkSession, docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: dict[str, float] | None = None, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` that are kept, columns as they are."""
    found = mixed(spark, docs, targets, temper, seed)
    return found.where(F.col(found.columns[-1])).select(*docs.columns)


def mixed_sql(temper: dict[str, float], seed: int = 7, sweeps: int = 30) -> str:
    """The same in DuckDB's SQL, with tempered targets and so many sweeps."""
    steps, k = [], 0
    for _ in range(sweeps):
        for m in MARGINS:
            steps.append(f"w{k + 1} as materialized (select * replace (coalesce(w * g_{m} / nullif(sum(w) over (partition by {m}), 0), 0) as w) from w{k})")
            k += 1
    goals = ", ".join(f"s_{m} as (select {m}, pow(sum(t)::double, {float(temper.get(m, 1.0))}) as s from cells where t > 0 group by {m}), g_{m} as (select {m}, s / sum(s) over () as g_{m} from s_{m})" for m in MARGINS)
    return f"""
with c as (select *, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+'))::bigint as tokens from documents),
d as (select doc_id, coalesce(source, '(none)') as source, coalesce(lang, '(none)') as lang, tokens,
  case when tokens = 0 then 'empty' when contains(text, ' | ') then 'table' when contains(text, '@') or contains(text, '://') then 'contact'
    when tokens < 100 then 'short' when tokens < 1000 then 'article' else 'book' end as topic from c),
cells as (select source, lang, topic, sum(tokens)::bigint as t from d group by all), {goals},
w0 as materialized (select cells.*, t::double as w, g_source, g_lang, g_topic from cells join g_source using (source) join g_lang using (lang) join g_topic using (topic) where t > 0),
{", ".join(steps)},
p as (select source, lang, topic, least(1, w / t / max(w / t) over ()) as p from w{k})
select doc_id, source, lang, topic, tokens, round(coalesce(p, 1.0), 6) as probability,
  ('0x' || substr(md5('{seed}:' || doc_id::varchar), 1, 13))::ubigint::bigint / 4503599627370496.0 < coalesce(p, 1.0) as kept
from d left join p using (source, lang, topic)
"""
