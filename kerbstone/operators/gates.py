"""Control totals (Q01-Q08): a gate is a row (label, got, want, passed), and ``require`` stops before any output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ControlTotalError(ValueError):
    """A control total does not hold."""


def totals(rows: DataFrame, wanted: dict[str, tuple[Column, float, float]]) -> DataFrame:
    """One row a total: its aggregate, what is stated, and whether they agree within a relative tolerance."""
    got = rows.agg(*[c.cast("double").alias(k) for k, (c, _, _) in wanted.items()])
    stated = F.array(*[F.struct(F.lit(k).alias("label"), F.col(k).alias("got"), F.lit(float(w)).alias("want"), F.lit(float(t)).alias("tol")) for k, (_, w, t) in wanted.items()])
    return got.select(F.explode(stated).alias("x")).select("x.label", "x.got", "x.want", (F.abs(F.col("x.got") - F.col("x.want")) / F.nullif(F.col("x.want"), F.lit(0.0)) <= F.col("x.tol")).alias("passed"))


def grouped(rows: DataFrame, keys: list[str], n: Column, total: Column, stated: DataFrame, tolerance: float) -> DataFrame:
    """Only stated groups are held: counts exactly, totals within an absolute tolerance."""
    got = rows.groupBy(*keys).agg(n.alias("got_n"), total.alias("got_total"))
    both = stated.join(got, keys, "left")
    held = (F.coalesce("got_n", F.lit(0)) == F.col("want_n")) & (F.abs(F.coalesce("got_total", F.lit(0.0)) - F.col("want_total")) <= tolerance)
    return both.select(*keys, F.coalesce("got_n", F.lit(0)).alias("got_n"), "want_n", F.coalesce("got_total", F.lit(0.0)).alias("got_total"), "want_total", held.alias("passed"))


def blank_keys(rows: DataFrame, column: str) -> DataFrame:
    n = F.count_if(F.coalesce(F.trim(column), F.lit("")) == "")
    return rows.agg(n.alias("blank"), (n == 0).alias("passed"))


def delta_histogram(rows: DataFrame, left: Column, right: Column) -> DataFrame:
    """Counts of the whole-number differences where both sides have one."""
    return rows.select((left.cast("int") - right.cast("int")).alias("delta")).where("delta is not null").groupBy("delta").agg(F.count("*").alias("n"))


#: Ranges of scores that one report states areas for, which are not the condition bands.
SCORE_RANGES = [(91, "Excellent"), (71, "Good"), (51, "Fair"), (31, "Poor"), (0, "Failed")]


def score_range(score: Column) -> Column:
    out = F
    for low, name in SCORE_RANGES:
        out = out.when(score >= low, name)
    return out


def within(rows: DataFrame, key: str, amount: str, stated: dict[str, float], tolerance: float) -> DataFrame:
    """(key, got, want, passed): sums by key against stated ones within a relative tolerance; a stated 0 must be 0."""
    want = F.explode(F.array(*[F.struct(F.lit(k).alias(key), F.lit(float(v)).alias("want")) for k, v in stated.items()]))
    wanted = rows.sparkSession.range(1).select(want.alias("x")).select("x.*")
    sums = rows.groupBy(key).agg(F.sum(amount).cast("double").alias("got"))
    both = F.broadcast(wanted).join(sums, key, "left").withColumn("got", F.coalesce("got", F.lit(0.0)))  # the stated groups: a printed table
    return both.withColumn("passed", F.when(F.col("want") != 0, F.abs(F.col("got") - F.col("want")) / F.col("want") <= tolerance).otherwise(F.col("got") == 0))


def component_sum(rows: DataFrame, amount: str, label: str, tolerance: float, total: str = "Total") -> DataFrame:
    """(summed, stated, sums): the parts of a printed table to one decimal against its total row."""
    found = rows.agg(F.round(F.sum(F.when(F.col(label) != total, F.col(amount))), 1).alias("summed"), F.max(F.when(F.col(label) == total, F.col(amount))).alias("stated"))
    return found.withColumn("sums", F.abs(F.col("summed") - F.col("stated")) <= tolerance)


def exact(rows: DataFrame, cost: str, want_n: int, want_cost: int) -> DataFrame:
    """(n, cost, exact): rows and the sum of printed costs, of which only the digits count, as stated to the unit."""
    digits = F.nullif(F.regexp_replace(F.coalesce(F.col(cost), F.lit("")), "[^0-9]", ""), F.lit("")).cast("long")
    found = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(digits), F.lit(0)).alias("cost"))
    return found.withColumn("exact", (F.col("n") == want_n) & (F.col("cost") == want_cost))


def recount(lines: DataFrame, text: str, pattern: str, times: int) -> DataFrame:
    """(recount): lines in which the pattern stands so many times; an independent count of the rows of a list."""
    return lines.agg(F.count_if(F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(pattern), F.lit(0))) == times).alias("recount"))


def require(gates: DataFrame) -> None:
    """Raise with the gates that fail (a handful of rows)."""
    failed = gates.where(~F.coalesce("passed", F.lit(False))).limit(50).collect()
    if failed:
        raise ControlTotalError("; ".join(str(r.asDict()) for r in failed))
