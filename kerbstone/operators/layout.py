"""Report words to rows (L01-L12): everything is per page, and order is by explicit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K


def anchor_groups(values: Column, tolerance: float) -> Column:
    """Per value of a sorted array, the number of its group: one joins while it is within tolerance of the group's *first*."""
    start = F.struct(F.lit(None).cast("double").alias("first"), F.lit(-1).alias("group"), F.array().cast("array<int>").alias("out"))

    def step(t: Column, v: Column) -> Column:
        joins = F.coalesce(F.abs(v - t["first"]) <= tolerance, F.lit(False))
        group = F.when(joins, t["group"]).otherwise(t["group"] + 1)
        return F.struct(F.when(joins, t["first"]).otherwise(v).alias("first"), group.alias("group"), F.concat(t["out"], F.array(group)).alias("out"))

    return F.aggregate(values, start, step, lambda t: t["out"])


def group_lines(words: DataFrame, keys: list[str], at: str = "top", tolerance: float = K.LINE_TOLERANCE, out: str = "line") -> DataFrame:
    """``words`` with the number of its line on its page (``keys``).

    A page's distinct positions are folded in one row, so what a task holds is a page, not the report.
    """
    positions = words.groupBy(*keys).agg(F.array_sort(F.collect_set(F.col(at).cast("double"))).alias("__v"))
    numbered = positions.select(*keys, F.explode(F.arrays_zip("__v", anchor_groups(F.col("__v"), tolerance).alias("__g"))).alias("__z"))
    return words.join(numbered.select(*keys, F.col("__z.__v").alias("__at"), F.col("__z.__g").alias(out)).withColumnRenamed("__at", "__t"), [*keys]).where(F.col(at).cast("double") == F.col("__t")).drop("__t")


def column_of(mid: Column, columns: list[tuple[str, float]]) -> Column:
    """The first column whose right bound lies beyond the word's middle, else the last."""
    out = F
    for name, bound in columns[:-1]:
        out = out.when(mid < bound, name)
    return out.otherwise(columns[-1][0]) if len(columns) > 1 else F.lit(columns[0][0])


def cut_columns(words: DataFrame, keys: list[str], columns: list[tuple[str, float]]) -> DataFrame:
    """One row a line: the words of each column joined by spaces from left to right; an empty column is an empty string."""
    placed = words.withColumn("__c", column_of((F.col("x0") + F.col("x1")) / 2, columns))
    cells = [F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("__c") == name, F.struct("x0", "x1", "text")))), lambda w: w["text"]), " ").alias(name) for name, _ in columns]
    return placed.groupBy(*keys).agg(*cells)


def without_noise(rows: DataFrame, columns: list[str], pattern: str) -> DataFrame:
    """Rows that are not empty and whose joined text does not start with the pattern."""
    joined = F.trim(F.regexp_replace(F.concat_ws(" ", *columns), " +", " "))
    return rows.where((joined != "") & ~joined.rlike(f"^(?:{pattern})"))


def continued(rows: DataFrame, page: list[str], order: list[str], starts: Column, blank: Column, first: list[str], more: list[str]) -> DataFrame:
    """Rows with their continuations: a line that ``starts`` is a row, and ``blank`` lines after it add to its ``more`` columns.

    Lines before a page's first row, and lines that are neither, are left out.
    """
    w = Window.partitionBy(*page).orderBy(*order)
    numbered = rows.withColumn("__s", F.coalesce(starts, F.lit(False))).where(F.col("__s") | F.coalesce(blank, F.lit(False)))
    numbered = numbered.withColumn("__r", F.sum(F.col("__s").cast("int")).over(w)).where("__r > 0")

    def joined(column: str) -> Column:
        texts = F.array_sort(F.collect_list(F.struct(*order, F.col(column).alias("__t"))))
        return F.array_join(F.filter(F.transform(texts, lambda x: x["__t"]), lambda v: v != ""), " ").alias(column)

    parts = [joined(c) for c in more]
    kept = [F.max(F.when(F.col("__s"), F.col(c))).alias(c) for c in first]
    return numbered.groupBy(*page, F.col("__r").alias("row")).agg(*kept, *parts)


def carried(column: Column, keys: list[str], order: list[str], default: str | None = None) -> Column:
    """The last value that is not null, up to and with this row; ``default`` before the first."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = F.last(column, ignorenulls=True).over(w)
    return found if default is None else F.coalesce(found, F.lit(default))


def split_limits(begin: Column, end: Column) -> tuple[Column, Column]:
    """Both limits where they stand in the first cell as ``A to B``."""
    both = (F.coalesce(end, F.lit("")) == "") & F.contains(begin, F.lit(" to "))
    parts = F.split(begin, " to ", 2)
    return F.when(both, F.trim(parts[0])).otherwise(begin), F.when(both, F.trim(parts[1])).otherwise(end)


def gap_groups(rows: DataFrame, keys: list[str], at: str, gap: float = K.LABEL_GAP, out: str = "group") -> DataFrame:
    """``rows`` with group numbers: one joins while it is less than ``gap`` from the *previous* one."""
    w = Window.partitionBy(*keys).orderBy(at)
    new = F.coalesce((F.col(at) - F.lag(at).over(w)) >= gap, F.lit(True))
    return rows.withColumn("__n", new.cast("int")).withColumn(out, F.sum("__n").over(w.rangeBetween(Window.unboundedPreceding, 0)) - 1).drop("__n")


def nearest_anchor(fragments: DataFrame, anchors: DataFrame, keys: list[str], at: str, name: str, bucket: float | None = None) -> DataFrame:
    """Each fragment with the ``name`` and position of the anchor nearest on its page; ties to the lesser position.

    Per page, the last anchor before and the first one after the fragment are carried to it in order, so no pairs are made.
    """
    both = fragments.select(*keys, F.col(at).alias("__y"), F.lit(None).cast("double").alias("__a"), F.lit(None).alias(name), F.struct(*fragments.columns).alias("__f")).unionByName(
        anchors.select(*keys, F.col(at).alias("__y"), F.col(at).cast("double").alias("__a"), name, F.lit(None).alias("__f"))
    )
    back = Window.partitionBy(*keys).orderBy("__y").rangeBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy("__y").rangeBetween(0, Window.unboundedFollowing)
    # of anchors at one position the least name stands
    mark = F.when(F.col("__a").isNotNull(), F.struct(F.col("__a").alias("y"), (-F.col("__a")).alias("down"), F.col(name).alias("n")))
    low = F.max_by(mark, F.col("__a")).over(back)
    high = F.min_by(mark, F.col("__a")).over(ahead)
    found = both.select("*", low.alias("__l"), high.alias("__h")).where(F.col("__f").isNotNull())
    nearer = F.when(F.col("__l").isNull(), F.col("__h")).when(F.col("__h").isNull(), F.col("__l")).when(F.col("__y") - F.col("__l.y") <= F.col("__h.y") - F.col("__y"), F.col("__l")).otherwise(F.col("__h"))
    return found.withColumn("__best", nearer).select("__f.*", F.col("__best.n").alias(name), F.col("__best.y").alias("anchor_at"))


def project_fields(own_miles: Column, fragment_miles: Column, class_text: Column) -> list[Column]:
    """miles, class_raw and kind of a project: its own miles' text, or where blank the fragment's; a spot has none or nothing."""
    text = F.coalesce(F.nullif(own_miles, F.lit("")), F.nullif(fragment_miles, F.lit("")))
    miles = F.when(text.rlike(r"^[0-9.]+$"), text.try_cast("double"))
    return [miles.alias("miles"), F.upper(F.regexp_extract(F.coalesce(class_text, F.lit("")), r"(?i)Class\s+(IV|III|II|I)\b", 1)).alias("class_raw"), F.when(F.coalesce(miles, F.lit(0.0)) != 0, "segment").otherwise("spot").alias("kind")]


PROJECT_TEXTS = ["treatment", "location", "cross_a", "cross_b"]


def projects(lines: DataFrame, page: str = "page", y: str = "top") -> DataFrame:
    """Projects of a list whose rows wrap: (page, y, corridor, treatment, location, cross_a, cross_b, miles, class_raw, kind, cost).

    A line (a page and its position are unique) with a dollar amount is a project. A line with nothing but a corridor is a
    piece of a label that is drawn beside several projects: pieces less than LABEL_GAP apart are one label. Every other
    line is a fragment of the nearest project, the upper of two as near. Texts are joined from top to bottom; a project
    without a corridor takes the label whose last line is nearest. Miles are the project's own or the first fragment's.
    """
    texts = ["corridor", *PROJECT_TEXTS, "miles", "cost"]
    clean = lines.select(page, F.col(y).cast("double").alias("__y"), *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in texts])
    lone = F.col("corridor") != ""
    for c in texts[1:]:
        lone = lone & (F.col(c) == "")
    told = clean.withColumn("__k", F.when(F.col("cost").rlike(r"\$\s*[0-9,]+"), "project").when(lone, "label").otherwise("fragment"))
    anchors = told.where("__k = 'project'").drop("__k")
    fragments = nearest_anchor(told.where("__k = 'fragment'").select(page, "__y", *PROJECT_TEXTS, "miles"), anchors.select(page, "__y", F.lit(True).alias("__of")), [page], "__y", "__of")
    pieces = fragments.where("__of").select(page, F.col("anchor_at").alias("__at"), "__y", *PROJECT_TEXTS, "miles")
    own = anchors.select(page, F.col("__y").alias("__at"), "__y", *PROJECT_TEXTS, F.lit("").alias("miles"))

    def joined(c: str) -> Column:
        parts = F.array_sort(F.collect_list(F.when(F.col(c) != "", F.struct("__y", c))))
        return F.array_join(F.transform(parts, lambda x: x[c]), " ").alias(c)

    made = pieces.unionByName(own).groupBy(page, "__at").agg(*[joined(c) for c in PROJECT_TEXTS], F.min_by(F.when(F.col("miles") != "", F.col("miles")), F.when(F.col("miles") != "", F.col("__y"))).alias("__miles"))
    labels = gap_groups(told.where("__k = 'label'").select(page, "__y", "corridor"), [page], "__y")
    groups = labels.groupBy(page, "group").agg(F.max("__y").alias("__y"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__y", "corridor"))), lambda x: x["corridor"]), " ").alias("__label"))
    labelled = nearest_anchor(anchors.select(page, "__y"), groups.select(page, "__y", "__label"), [page], "__y", "__label").select(page, F.col("__y").alias("__at"), "__label")
    rows = anchors.select(page, F.col("__y").alias("__at"), "corridor", F.col("miles").alias("__own"), "cost").join(made, [page, "__at"]).join(labelled, [page, "__at"])
    corridor = F.when(F.col("corridor") != "", F.col("corridor")).otherwise(F.coalesce("__label", F.lit(""))).alias("corridor")
    return rows.select(page, F.col("__at").alias(y), corridor, *PROJECT_TEXTS, *project_fields(F.col("__own"), F.col("__miles"), F.col("treatment")), F.regexp_replace("cost", "[^0-9]", "").alias("cost"))


_DAY = r"^\d{1,2}/\d{1,2}/\d{4}$"


def dated_rows(rows: DataFrame, ends: str = "ends") -> DataFrame:
    """Rows of a list whose last cell is a day and nothing else."""
    return rows.where(F.trim(F.coalesce(F.col(ends), F.lit(""))).rlike(_DAY))


def ruled_rows(cells: DataFrame, keys: list[str], columns: list[str], header: str = "street") -> DataFrame:
    """Rows of ruled tables from cells (keys..., col, text): with at least as many cells as ``columns``, of which the first names
    a street and no header, ``pci`` is a number of one to three digits, and ``cost`` has a dollar sign."""
    n = len(columns)
    rows = cells.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.max(F.when(F.col("col") == k, F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")))).alias(c) for k, c in enumerate(columns)])
    kept = (F.col("__n") >= n) & (F.col(columns[0]) != "") & ~F.lower(F.col(columns[0])).startswith(header) & F.col("pci").rlike("^[0-9]{1,3}$") & F.contains("cost", F.lit("$"))
    return rows.where(kept).select(*keys, *columns)


def mileage_rows(lines: DataFrame, text: str = "line") -> DataFrame:
    """(facility, before, miles) of a printed table's lines: a facility with its class and two numbers, or the total and two."""
    line = F.trim(F.col(text))
    kind = F.regexp_extract(line, r"^(.+?\(Class\s+(?:IV|III|II|I)\))\s+[0-9.]+\s+[0-9.]+\*?\s*$", 1)
    numbers = [F.regexp_extract(line, r"\s([0-9.]+)\s+([0-9.]+)\*?\s*$", k).try_cast("double") for k in (1, 2)]
    name = F.when(kind != "", F.trim(F.regexp_replace(kind, r"\s+", " "))).when(line.rlike(r"^Total\s+[0-9.]+\s+[0-9.]+\s*$"), "Total")
    return lines.select(name.alias("facility"), numbers[0].alias("before"), numbers[1].alias("miles")).where("facility is not null")
