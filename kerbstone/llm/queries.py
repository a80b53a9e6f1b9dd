"""The contract queries: each applies one operator to its whole table and derives the digest columns from its output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprint, licences, linededup, minhash, mixing, packing, quality, sharding, toxicity, vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    """The path of the public word-piece vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, paragraph or text that names a licence: doc_id, level, position, licence, dice, segment."""
    return licences.scan(_table(spark, sf_dir, "documents"), threshold=0.8)


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links of cosine 0.95, component and whether it is kept."""
    found = vectors.near_duplicate_vectors(spark, _table(spark, sf_dir, "embeddings"), threshold=0.95)
    return found.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP2_SQL = """
with recursive v as materialized (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), link as materialized (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95
), reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join link l on r.b = l.a),
least as (select a, min(b) as component_id from reach group by a)
select vec_id, (select count(*) from link where a = vec_id)::bigint as n_links, component_id, vec_id = component_id as kept from embeddings join least on a = vec_id
"""


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of at most 2048 ids."""
    pieces = packing.pack(spark, _table(spark, sf_dir, "documents"), word_bpe(), end=1, capacity=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 8 and slot, by near equal bytes."""
    placed = sharding.shard_by_bytes(spark, _table(spark, sf_dir, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: Powers of the actual shares that are op5's targets.
TEMPER = {"source": 0.8, "lang": 0.8, "topic": 0.95}


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cell, tokens, probability (six digits) and whether it is kept."""
    found = mixing.mixed(spark, _table(spark, sf_dir, "documents"), temper=TEMPER)
    named = [F.col(f"__{m}").alias(m) for m in mixing.MARGINS]
    return found.select("doc_id", *named, F.col("__tokens").alias("tokens"), F.round("__p", 6).alias("probability"), F.col("__kept").alias("kept"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id (least doc_id of its near-duplicates), kept (one row a class) of every document: five words, similarity 0.8."""
    found = minhash.near_duplicates(spark, _table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "kept")


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and the likenesses."""
    found = fingerprint.fingerprints(spark, _table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumns({c: F.round(c, 6) for c in ("near_edited", "near_next")})


def _op7_sql() -> str:
    dense, half = fingerprint.DENSE, fingerprint.SIGN // 2
    digit = "('0x' || substr({0}, {1}, 8))::ubigint::bigint"
    paragraphs = [f"(sum({digit.format('sha256(p)', 8 * k + 1)}) % 4294967296)::bigint" for k in range(dense)]
    pieces = [f"coalesce(sum(((m{w} >> {k}) & 1) * n), 0)::bigint" for w in (0, 1) for k in range(half)] + ["coalesce(sum(n), 0)::bigint"]
    hexed = "array_to_string([lpad(lower(to_hex(v)), 8, '0') for v in {0}], '')"
    signs = "[(2 * v - {0}[73])::double for v in {0}[9:72]]"
    near = f"case when {{0}} = {{1}} then 1.0 when {{0}}[73] = 0 or {{1}}[73] = 0 then 0.0 else greatest(0.0, least(1.0, list_inner_product({signs.format('{0}')}, {signs.format('{1}')}) / sqrt(list_inner_product({signs.format('{0}')}, {signs.format('{0}')}) * list_inner_product({signs.format('{1}')}, {signs.format('{1}')})))) end"
    return f"""
with d as (select doc_id, coalesce(text, '') as t, coalesce(lag(coalesce(text, '')) over (order by doc_id), max_by(coalesce(text, ''), doc_id) over ()) as nt from documents),
e as materialized (select doc_id, t, left(t, length(t) - length(t) // 2) || left(nt, length(t) // 2) as edited from d),
x as (select doc_id, false as changed, t as x from e union all select doc_id, true, edited from e),
a as (select doc_id, changed, [{', '.join(paragraphs)}] as v from (select doc_id, changed, unnest(string_split(x, chr(10))) as p from x) group by all),
u as (select doc_id, changed, unnest(regexp_extract_all(x, '{fingerprint.PIECES}')) as p from x),
w as (select doc_id, changed, {digit.format('md5(p)', 1)} as m0, {digit.format('md5(p)', 9)} as m1, length(p) as n from u),
b as (select doc_id, changed, [{', '.join(pieces)}] as v from w group by doc_id, changed),
v as materialized (select doc_id, changed, list_concat(a.v, coalesce(b.v, [0::bigint for i in range({2 * half + 1})])) as v from a left join b using (doc_id, changed)),
own as (select doc_id, v from v where not changed), chg as (select doc_id, v from v where changed),
nxt as (select doc_id, coalesce(lag(v) over (order by doc_id), max_by(v, doc_id) over ()) as v from own)
select doc_id, length(t)::bigint as n_chars, sha256(edited) as edited_sha256, {hexed.format('own.v')} as fingerprint, {hexed.format('chg.v')} as edited_fingerprint,
  round({near.format('own.v', 'chg.v')}, 6) as near_edited, round({near.format('own.v', 'nxt.v')}, 6) as near_next
from e join own using (doc_id) join chg using (doc_id) join nxt using (doc_id)
"""


def op8_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and the hash of the kept text of every document."""
    kept = linededup.dedup_lines(spark, _table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=3, min_chars=20, counted=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = r"""
with lines as (
  select doc_id, i, line, lower_ascii(trim(line, E' \t\n\x0b\f\r')) as key
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents)
), held as (
  select key, max(doc_id) as keeper from lines where length(key) >= 20 group by key having count(distinct doc_id) >= 3
)
select doc_id, count(*) as n_lines, count(keeper) filter (where doc_id <> keeper) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where keeper is null or doc_id = keeper), '')) as kept_sha256
from lines left join held using (key) group by doc_id
""".replace("lower_ascii(", "translate(").replace("\\r'))", "\\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of 0.3) of every document."""
    docs = _table(spark, sf_dir, "documents")
    scored, _ = quality.classify(spark, docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of 0.5) of every document."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(spark, docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(spark, docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_licences": op1_licences,
        "op2_vectors": op2_vectors,
        "op3_packing": op3_packing,
        "op4_sharding": op4_sharding,
        "op5_mixing": op5_mixing,
        "op6_minhash": op6_minhash,
        "op7_fingerprint": op7_fingerprint,
        "op8_linededup": op8_linededup,
        "op9_quality": op9_quality,
        "op10_toxicity": op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_licences": licences.scan_sql(0.8), "op2_vectors": OP2_SQL, "op5_mixing": mixing.mixed_sql(TEMPER), "op7_fingerprint": _op7_sql(), "op8_linededup": OP8_SQL}
