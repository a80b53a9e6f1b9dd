"""Line dedup: a sharded minimal perfect hash over distinct line hashes indexes fingerprint, count and keeper arrays.

A line's key is the line stripped of ASCII white space at both ends with A-Z in lower case. A key of at least
``min_chars`` code points that at least ``min_docs`` rows hold loses all its lines but those of the row with the
largest doc_id. All distinct keys are indexed (their 128-bit hashes, dealt to shards); each takes about three and a half
bytes, and a repeated one eight more for its keeper. A line's count says whether it is repeated.

The documents probe the shards, and no line is joined with a line. While the index's measured size is at most
``broadcast_bytes`` every task has all shards; beyond that the lines' hashes are dealt to the shards and probed there, a
shard with many lines in several copies (LINES hashes a task, so a line that a third of all rows hold is no hot task), and
only the hashes of lines that go come back to their documents. Both ways give the same rows.

Defined results: a null or empty text is one empty line and stays as an empty text; a row is a document (rows that
share a doc_id count one by one and keep or lose a line together); a null doc_id counts as the smallest; of ties there
are none, since the keeper is an id; very long texts are read whole; a document all of whose lines go keeps an empty
text; other columns pass as they are, whatever their names, but for n_lines and n_dropped, which ``counted`` replaces; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .mphf import Index
from .workspace import bounded_batches, materialise, unused

#: The largest index that is broadcast.
BROADCAST_BYTES = 32 << 20
#: Keys that a shard of the index holds, and lines that one copy of it is probed with, about.
SHARD_KEYS, LINES = 100_000, 500_000
_STRIP = " \t\n\x0b\x0c\r"
_NO_ID = -(1 << 63)


def split_keys(text: str | None, min_chars: int) -> tuple[list[str], list[int], bytes]:
    """The lines of a text, the numbers of those long enough, and the 16-byte hashes of these lines' keys."""
    lines, at, keys = (text or "").split("\n"), [], []
    for k, line in enumerate(lines):
        line = line.strip(_STRIP)
        if len(line) >= min_chars:
            at.append(k)
            keys.append(xxhash.xxh3_128_digest(line.encode().lower()))
    return lines, at, b"".join(keys)


def _hashes(keys: bytes) -> np.ndarray:
    return np.frombuffer(keys, np.uint64).reshape(-1, 2)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _emit(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """(h1, h2, doc, row) of the distinct keys of each row (doc_id, hash of the text, text)."""
    for batch in batches:
        hashes, size = [], []
        for text in batch.column(2).to_pylist():
            h = _hashes(split_keys(text, min_chars)[2])
            h = np.unique(h, axis=0) if len(h) > 1 else h
            hashes.append(h)
            size.append(len(h))
        if sum(size):
            h = np.concatenate(hashes).view(np.int64)
            doc, row = np.repeat(_ids(batch.column(0)), size), np.repeat(batch.column(1).to_numpy(), size)
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(doc), pa.array(row)], ["h1", "h2", "doc", "row"])


def _build(rows: pd.DataFrame, min_docs: int) -> pd.DataFrame:
    """A shard of the index, with its size in bytes and how many lines will probe it."""
    h = rows[["h1", "h2"]].to_numpy(np.int64).view(np.uint64)
    made = Index.build(h[:, 0], h[:, 1], rows.n_docs.to_numpy(np.int64), rows.keeper.to_numpy(np.int64), min_docs).arrays()
    return pd.DataFrame([{"shard": rows["shard"].iloc[0], "bytes": sum(map(len, made.values())), "lines": rows.n_docs.sum(), **made}])


_SHARD = "shard int, bytes long, lines long, sizes binary, bits binary, fingerprint binary, count binary, keeper binary"


def _probe(key, lines: pd.DataFrame, index: pd.DataFrame, min_docs: int) -> pd.DataFrame:
    """(doc, row, h1, h2) of the lines dealt to one copy of a shard that go."""
    table = Index.of(index.iloc[0], min_docs)
    h = lines[["h1", "h2"]].to_numpy(np.int64).view(np.uint64)
    _, count, keeper = table.probe(h[:, 0], h[:, 1])
    return lines.loc[(count >= min_docs) & (lines.doc.to_numpy(np.int64) != keeper), ["doc", "row", "h1", "h2"]]


def _shard(shards: int) -> Column:
    """The unsigned remainder of h1."""
    return F.pmod(F.pmod("h1", F.lit(shards)) + F.when(F.col("h1") < 0, F.lit((1 << 64) % shards)).otherwise(F.lit(0)), F.lit(shards)).cast("int")


def _drop(batches: Iterator[pa.RecordBatch], sent, shards: int, min_docs: int, min_chars: int, counted: bool) -> Iterator[pa.RecordBatch]:
    """Probe the arrays with the lines of each row, and leave out the lines that go."""
    index = {row["shard"]: Index.of(row, min_docs) for row in sent.value}
    for batch in batches:
        ids, split = _ids(batch.column("doc_id")), [split_keys(t, min_chars) for t in batch.column("text").to_pylist()]
        h = _hashes(b"".join(x[2] for x in split))
        of = np.repeat(np.arange(len(split)), [len(x[1]) for x in split])
        gone = np.zeros(len(h), bool)
        shard = (h[:, 0] % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            if len(part) and (table := index.get(int(shard[part[0]]))):
                _, count, keeper = table.probe(h[part, 0], h[part, 1])
                gone[part] = (count >= min_docs) & (ids[of[part]] != keeper)
        lost = np.bincount(of[gone], minlength=len(split))
        texts, at = [], 0
        for k, (lines, numbers, _) in enumerate(split):
            if lost[k]:
                away = {n for n, g in zip(numbers, gone[at : at + len(numbers)], strict=True) if g}
                lines = [x for n, x in enumerate(lines) if n not in away]
            texts.append("\n".join(lines))
            at += len(numbers)
        yield _with(batch, texts, [len(x[0]) for x in split], lost, counted)


def _with(batch: pa.RecordBatch, texts: list[str], lines: list[int], lost: np.ndarray, counted: bool) -> pa.RecordBatch:
    columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | {"text": pa.array(texts, pa.string())}
    columns |= {"n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(lost, pa.int64())} if counted else {}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _drop_listed(batches: Iterator[pa.RecordBatch], away_name: str, min_chars: int, counted: bool) -> Iterator[pa.RecordBatch]:
    """As ``_drop``, where each row brings the hashes that it loses."""
    for batch in batches:
        texts, n, lost = [], [], []
        for text, away in zip(batch.column("text").to_pylist(), batch.column(away_name).to_pylist(), strict=True):
            lines, numbers, keys = split_keys(text, min_chars)
            n.append(len(lines))
            if away:
                bad = {(x["h1"], x["h2"]) for x in away}
                gone = {k for k, h in zip(numbers, map(tuple, _hashes(keys).view(np.int64).tolist()), strict=True) if h in bad}
                lines = [x for k, x in enumerate(lines) if k not in gone]
            lost.append(n[-1] - len(lines))
            texts.append("\n".join(lines))
        yield _with(batch.drop_columns([away_name]), texts, n, np.array(lost, np.int64), counted)


def line_keys(spark: SparkSession, docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """(h1, h2, doc, row) of the distinct keys of each row; ``row`` is a hash of the text, which tells rows of one doc_id apart."""
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("row"), F.col("text"))
    return rows.mapInArrow(partial(_emit, min_chars=min_chars), "h1 long, h2 long, doc long, row long")


def line_index(spark: SparkSession, docs: DataFrame, min_docs: int = 3, min_chars: int = 20, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """The shards of the index over all distinct keys, one row each, and their number; keys are counted on the map side first."""
    keys = line_keys(spark, docs, min_chars).groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))
    found = materialise(spark, keys, "lines")
    shards = max(1, -(-found.count() // shard_keys))
    return materialise(spark, found.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(partial(_build, min_docs=min_docs), _SHARD), "index"), shards


def gone_lines(spark: SparkSession, docs: DataFrame, index: DataFrame, shards: int, min_docs: int = 3, min_chars: int = 20, lines: int = LINES) -> DataFrame:
    """(doc, row, h1, h2) of the lines that go, found by probing each shard in as many copies as its lines ask."""
    copies = materialise(spark, index.select("shard", F.ceil(F.col("lines") / lines).cast("int").alias("copies")), "copies")
    # one small row a shard
    dealt = line_keys(spark, docs, min_chars).withColumn("shard", _shard(shards)).join(copies, "shard")
    dealt = dealt.select("shard", F.pmod(F.xxhash64("doc", "row"), F.col("copies")).cast("int").alias("copy"), "doc", "row", "h1", "h2")
    spread = index.join(copies, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies", "lines", "bytes")
    return dealt.groupBy("shard", "copy").cogroup(spread.groupBy("shard", "copy")).applyInPandas(partial(_probe, min_docs=min_docs), "doc long, row long, h1 long, h2 long")


def dedup_lines(
    spark: SparkSession, docs: DataFrame, min_docs: int = 3, min_chars: int = 20, counted: bool = False, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``docs`` with the repeated lines left out of ``text``; ``counted`` adds n_lines and n_dropped. ``min_docs`` is from 1 to 255."""
    index, shards = line_index(spark, docs, min_docs, min_chars)
    size = index.agg(F.sum("bytes")).first()[0] or 0
    schema = T.StructType([f for f in docs.schema.fields if not (counted and f.name in ("n_lines", "n_dropped"))])
    docs = docs.select(*schema.names)
    out = T.StructType([T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType) for f in schema.fields])
    if counted:
        out = out.add("n_lines", "long").add("n_dropped", "long")
    if size <= broadcast_bytes:
        sent = spark.sparkContext.broadcast([r.asDict() for r in index.collect()])  # at most broadcast_bytes, as measured
        return docs.mapInArrow(partial(_drop, sent=sent, shards=shards, min_docs=min_docs, min_chars=min_chars, counted=counted), out)
    key, row, list_ = unused(docs.columns, "__id", "__row", "__away")
    gone = gone_lines(spark, docs, index, shards, min_docs, min_chars)
    # a row's own lines, even where a third of all rows share an id
    away = gone.groupBy(F.col("doc").alias(key), F.col("row").alias(row)).agg(F.collect_set(F.struct("h1", "h2")).alias(list_))
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), row: F.xxhash64("text")})
    both = keyed.join(away, [key, row], "left").select(*schema.names, list_)
    return both.mapInArrow(partial(_drop_listed, away_name=list_, min_chars=min_chars, counted=counted), out)
