"""Document fingerprints: a homomorphic multiset hash over paragraphs (lines).

Each paragraph is hashed to a wide vector, and the vectors are summed modulo 2**32 lane by lane:

* DENSE lanes: the words of the paragraph's SHA-256. They tell multisets of paragraphs apart.
* SIGN lanes: the paragraph is cut into pieces of up to PIECE words, counted from its start; each piece adds its length in
  code points to the lanes where a bit of its MD5 is set. One more lane has all lengths. Twice a lane less the total is a
  random-sign sum, so the cosine of two such vectors estimates which share of their pieces, by length, two texts have in common.

No piece crosses a paragraph, so a paragraph's vector depends on the paragraph alone. The sum does not depend on the
paragraphs' order, and a paragraph is inserted or deleted by adding or subtracting its vector (``combined``). The
fingerprint is the lanes in hexadecimal.

All of it is Column expressions and one aggregation. Defined results: a null text counts as empty, which is one empty
paragraph; equal texts have equal fingerprints; the likeness of texts without pieces is 1 to each other and 0 to any
other; very long texts are hashed whole; the text after the last doc_id is the first one's, so a single document follows
itself; rows that share a doc_id are edited each by itself with the least text of the next doc_id; a null doc_id sorts
first; other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import materialise

DENSE, SIGN = 8, 64
#: Words of a piece at most, and characters of a word; a longer word counts as several.
PIECE, WORD = 4, 24
_MASK = 0xFFFFFFFF
_NO_ID = -(1 << 63)
#: A piece of a text, for Java's patterns and RE2 alike.
PIECES = f"[^ \\t-\\r]{{1,{WORD}}}(?:[ \\t]*[^ \\t-\\r]{{1,{WORD}}}){{0,{PIECE - 1}}}"


def _word(hexadecimal: Column, k: int) -> Column:
    """The k-th unsigned 32-bit word of a digest."""
    return F.conv(F.substring(hexadecimal, 8 * k + 1, 8), 16, 10).cast("long")


def with_lanes(rows: DataFrame, keys: list[str], text: str, out: str = "lanes") -> DataFrame:
    """(keys..., out): the lanes of each row's text, array<long> of DENSE + SIGN + 1 numbers under 2**32.

    The ``keys`` must tell the rows apart. Texts become paragraphs and pieces, each a few numbers, which are summed before
    they are shuffled: what a shuffle gets is a vector a text, and no task holds more than a text at once.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    units = F.concat(
        F.transform(F.split(whole, "\n", -1), lambda p: F.struct(F.lit(True).alias("whole"), p.alias("unit"))),
        F.transform(F.regexp_extract_all(whole, F.lit(PIECES), F.lit(0)), lambda p: F.struct(F.lit(False).alias("whole"), p.alias("unit"))),
    )
    # names of its own, so that the keys may have any
    told = rows.select(*keys, F.explode(units).alias("__u")).select(
        *keys, F.when(F.col("__u.whole"), F.sha2("__u.unit", 256)).alias("__sha"), F.when(~F.col("__u.whole"), F.md5("__u.unit")).alias("__md5"), F.char_length("__u.unit").cast("long").alias("__n")
    )
    told = told.select(*keys, *[_word(F.col("__sha"), k).alias(f"__d{k}") for k in range(DENSE)], *[_word(F.col("__md5"), k).alias(f"__m{k}") for k in (0, 1)], F.when(F.col("__md5").isNotNull(), F.col("__n")).alias("__n"))
    # sums of lengths stay under 2**31, so that two lanes share a long
    half = SIGN // 2
    pairs = [F.expr(f"((__m0 >> {k}) & 1L) * __n + shiftleft(((__m1 >> {k}) & 1L) * __n, 32)") for k in range(half)]
    zero = F.lit(0).cast("long")
    sums = told.groupBy(*keys).agg(
        *[F.sum(f"__d{k}").alias(f"__d{k}") for k in range(DENSE)], *[F.coalesce(F.sum(x), zero).alias(f"__p{k}") for k, x in enumerate(pairs)], F.coalesce(F.sum("__n"), zero).alias("__n")
    )
    lanes = [F.col(f"__d{k}").bitwiseAND(F.lit(_MASK)) for k in range(DENSE)] + [F.col(f"__p{k}").bitwiseAND(F.lit(_MASK)) for k in range(half)]
    return sums.select(*keys, F.array(*lanes, *[F.shiftrightunsigned(f"__p{k}", 32) for k in range(half)], F.col("__n").bitwiseAND(F.lit(_MASK))).alias(out))


def rendered(values: Column) -> Column:
    """Lanes as hexadecimal, eight digits each."""
    return F.array_join(F.transform(values, lambda v: F.lower(F.lpad(F.hex(v), 8, "0"))), "")


def combined(left: Column, right: Column, sign: int = 1) -> Column:
    """The lanes of ``left`` with the paragraphs of ``right`` inserted (sign 1) or deleted (sign -1)."""
    return F.zip_with(left, right, lambda a, b: F.pmod(a + sign * b, F.lit(1 << 32)))


def likeness(left: Column, right: Column) -> Column:
    """Cosine of the two random-sign sums, no less than 0; 1 for equal lanes."""
    both = F.zip_with(F.slice(left, DENSE + 1, SIGN), F.slice(right, DENSE + 1, SIGN), lambda a, b: F.struct(
        (2 * a - F.element_at(left, -1)).cast("double").alias("a"), (2 * b - F.element_at(right, -1)).cast("double").alias("b")))
    sums = F.aggregate(
        both,
        F.struct(F.lit(0.0).alias("ab"), F.lit(0.0).alias("aa"), F.lit(0.0).alias("bb")),
        lambda t, x: F.struct((t["ab"] + x["a"] * x["b"]).alias("ab"), (t["aa"] + x["a"] * x["a"]).alias("aa"), (t["bb"] + x["b"] * x["b"]).alias("bb")),
        lambda t: F.when((t["aa"] > 0) & (t["bb"] > 0), F.greatest(F.lit(0.0), F.least(F.lit(1.0), t["ab"] / F.sqrt(t["aa"] * t["bb"])))).otherwise(F.lit(0.0)),
    )
    return F.when(left == right, F.lit(1.0)).otherwise(sums)


def neighbours(spark: SparkSession, ids: DataFrame) -> DataFrame:
    """(id, next_id) over distinct ids in descending order, the first after the last.

    Ids are dealt by range, and each range's rows look within it; the ranges' ends meet in one row a range.
    """
    dealt = materialise(spark, ids.select("id").distinct().repartitionByRange("id").select("id", F.spark_partition_id().alias("part")), "ids")
    ends = dealt.groupBy("part").agg(F.max("id").alias("most"))
    before = ends.selectExpr("part", "lag(most) over (order by part) as below", "max(most) over () as last")
    inside = dealt.selectExpr("part", "id", "lag(id) over (partition by part order by id) as next_id")
    return inside.join(before, "part").select("id", F.coalesce("next_id", "below", "last").alias("next_id"))


def fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_chars, the edited text's SHA-256, both fingerprints, and the two likenesses.

    The edited text is the text whose last half (code points) is replaced by as many of the next document's first.
    """
    kind = docs.schema["doc_id"].dataType
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    after = materialise(spark, neighbours(spark, rows), "neighbours")
    sizes = rows.groupBy("id").agg((F.max(F.char_length("text")) / 2).cast("long").alias("need"))
    wanted = after.join(sizes, "id").select(F.col("next_id").alias("id"), F.col("id").alias("for"), "need")
    # each document sends the start that the one before it needs
    repeats = _repeats(rows)
    least = rows.groupBy("id").agg(F.min("text").alias("text")) if repeats else rows
    sent = least.join(wanted, "id").select(F.col("for").alias("id"), F.expr("left(text, cast(need as int))").alias("start"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 2) as int))"), F.expr("left(start, cast(floor(char_length(text) / 2) as int))"))
    # the digests travel as 32 bytes; that of the text itself only tells rows of one id apart
    own_sha = F.unhex(F.sha2("text", 256)) if repeats else F.lit(None).cast("binary")
    both = rows.join(sent, "id").select("id", n.cast("long").alias("n_chars"), own_sha.alias("sha"), "text", F.when(half > 0, edited).otherwise(F.col("text")).alias("edited"))
    # a row's units stay in the task that reads it, so a number made there tells it apart even if the task runs again
    kinds = F.array(F.struct(F.lit(False).alias("changed"), F.col("text").alias("text")), F.struct(F.lit(True).alias("changed"), F.col("edited").alias("text")))
    keys = ["id", "n_chars", *(["sha"] if repeats else []), "edited_sha", "row", "changed"]
    told = both.select("id", "n_chars", "sha", F.unhex(F.sha2("edited", 256)).alias("edited_sha"), F.monotonically_increasing_id().alias("row"), "text", "edited")
    texts = told.select(*keys[:-1], F.explode(kinds).alias("x")).select(*keys[:-1], F.col("x.changed").alias("changed"), F.col("x.text").alias("text"))
    made = materialise(spark, with_lanes(texts, keys, "text"), "lanes", "zstd")
    own = made.groupBy(*keys[:-1]).agg(F.max_by("lanes", ~F.col("changed")).alias("own"), F.max_by("lanes", "changed").alias("edited"))
    following = made.where("not changed").withColumnRenamed("lanes", "next_lanes")
    if repeats:
        first = least.select("id", F.unhex(F.sha2("text", 256)).alias("sha"))
        following = following.join(first, ["id", "sha"]).groupBy("id").agg(F.first("next_lanes").alias("next_lanes"))
    following = following.select("id", "next_lanes").join(after.select(F.col("next_id").alias("id"), F.col("id").alias("for")), "id").select(F.col("for").alias("id"), "next_lanes")
    return own.join(following, "id").select(
        F.when(F.col("id") != _NO_ID, F.col("id")).cast(kind).alias("doc_id"), "n_chars", F.lower(F.hex("edited_sha")).alias("edited_sha256"), rendered(F.col("own")).alias("fingerprint"), rendered(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("next_lanes")).alias("near_next"),
    )


def _repeats(rows: DataFrame) -> bool:
    """Whether rows share an id (two numbers come to the driver)."""
    n, distinct = rows.groupBy("id").agg(F.count("*").alias("n")).agg(F.sum("n"), F.count("*")).first()
    return n != distinct
