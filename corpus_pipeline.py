"""A corpus from raw documents to packed sequences: toxicity, line dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns
of ``docs``; the last returns the pieces of the packed sequences. No stage drops clean rows: toxicity leaves out what the
model rejects, line dedup shortens texts, near-dedup keeps one document a group, mixing samples to its targets.

Every stage takes empty tables (and gives one), null ids, null and empty texts, ties, repeated rows, texts of any length,
and more columns than the documents have, whatever their names: those pass as they are. What it makes of each is said below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbstone.llm import linededup, minhash, mixing, packing, toxicity
from kerbstone.llm.queries import word_bpe
from kerbstone.llm.workspace import materialise

#: Powers of the actual token shares that the mixture aims at: a little less of what there is most of.
TEMPER = {"source": 0.95, "lang": 0.95, "topic": 1.0}


def _sized(docs: DataFrame) -> DataFrame:
    """n_chars, where there is such a column, is that of the text as it now is."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model (learned on these documents' labels) scores under a half.

    Null and empty texts have the score of the bias; equal texts are kept or rejected together; rows without an id are
    scored as the others. Without any labelled document nothing is known to be toxic, and all are kept.
    """
    model = toxicity.fit_toxicity(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject_toxic(spark, docs, model, threshold=0.5) if model.fitted else docs


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more of them hold, but for one copy; no document goes.

    A null text becomes an empty one; rows that share an id keep or lose a line together; a null id is the least, so its
    rows keep a shared line only where no other row has it.
    """
    return _sized(linededup.dedup_lines(spark, docs, min_docs=3, min_chars=20))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row (the first of the least doc_id) of each group of near-duplicates, whether or not rows share or lack an id.

    Texts without words (null, empty, white) are one group; repeated rows are of one; a row without an id stays where none
    of its group has one.
    """
    rows = minhash.numbered(spark, docs)
    kept = materialise(spark, minhash.near_duplicates(spark, rows).where("kept").select(minhash.ROW), "kept")
    few = kept.count() <= minhash.BROADCAST_IDS
    return rows.join(F.broadcast(kept) if few else kept, minhash.ROW, "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents whose tokens meet the target shares of source, language and topic.

    Documents without words weigh nothing and stay; a null source or language is a value of its own; rows of one cell that
    share or lack an id are drawn together.
    """
    return mixing.mix(spark, docs, temper=TEMPER)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece.

    A null or empty text is its end id alone; rows that share or lack an id are documents of their own, each with its pieces.
    """
    pieces = packing.pack(spark, docs, word_bpe(), end=1, capacity=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A learned model, signatures and a tokenizer are not SQL: tests/llm holds the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(spark, stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}", "zstd")
    return STAGES[-1][1](spark, docs, sf_dir)
