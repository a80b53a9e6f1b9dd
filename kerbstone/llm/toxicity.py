"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Per-coordinate rates and the L1 term leave a few weights that are not zero; only those are broadcast, and there
are at most ``2 ** BITS`` of them (12 MB) whatever the corpus holds.

Defined results: a null text counts as empty; a text without words has the score of the bias alone; equal texts
have equal scores, whatever other models a worker has scored with; a very long text is read whole; an empty table gives no
rows; with no labelled row at all the model scores 0.5 everywhere, which the default threshold rejects. Rows of ``labels``
with a null label or a null doc_id are ignored, repeated ones count once; rows that share a labelled doc_id are all
learned from while the bound on the sample allows. Rows with a null doc_id are scored, and count as not held out. Other
columns pass as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import NOT_ALNUM, Words, chunks, mix, utf8_column
from .workspace import bounded_batches

#: Hash space of the features.
BITS = 20
#: Labelled texts that the model is fitted on at most.
MAX_TRAIN = 12_000


@dataclass
class Ftrl:
    """Parameters of the fit; ``max_train`` bounds the labelled sample.

    Features in fewer than ``min_docs`` of the sample's texts are left out (inclusion by count, as is usual with FTRL);
    the last ``calibration`` share of the sample only sets the scale and bias of the margin (Platt).
    """

    alpha: float = 0.2
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 1.0
    epochs: int = 3
    min_docs: int = 4
    calibration: float = 0.2
    max_train: int = MAX_TRAIN


@dataclass
class ToxicityModel:
    """Sparse weights over the hash space, and the bias; whether there were any labelled texts."""

    index: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    bias: float = 0.0
    fitted: bool = False


def features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashed index, row) of the unigrams, the bigrams and the bigrams that skip one word."""
    h, doc, shift = words.hash, words.doc, np.uint64(64 - BITS)
    yield (mix(h) >> shift).astype(np.int64), doc
    for gap, salt in ((1, 0xA5A5), (2, 0x5A5A)):
        if len(h) > gap:
            pair = mix(mix(h[:-gap] + np.uint64(salt)) + h[gap:] * np.uint64(3))
            same = doc[:-gap] == doc[gap:]
            yield (pair[same] >> shift).astype(np.int64), doc[:-gap][same]


def _platt(margin: np.ndarray, y: np.ndarray, bias: float) -> tuple[float, float]:
    """Scale and bias of the margins that make their log loss least (Newton steps, slightly damped)."""
    a, b = 1.0, bias
    if not 0 < y.sum() < len(y):
        return a, b
    x = np.column_stack([margin, np.ones(len(y))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ np.array([a, b]), -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2), x.T @ (p - y) + 1e-2 * np.array([a - 1, b - bias]))
        a, b = a - max(-1.0, min(1.0, step[0])), b - max(-1.0, min(1.0, step[1]))
    return float(a), float(b)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ord, doc_id, toxic, size, features): each labelled text's distinct feature numbers as little-endian 32-bit integers."""
    for batch in batches:
        data, at = utf8_column(batch.column("text"))
        out = []
        for low, high in chunks(at):
            words = Words(data[at[low] : at[high]], at[low : high + 1] - at[low], NOT_ALNUM)
            found = list(features(words))
            key = np.unique(np.concatenate([(doc.astype(np.int64) << BITS) | i for i, doc in found] or [np.zeros(0, np.int64)]))
            cut = np.searchsorted(key, np.arange(high - low + 1) << BITS)
            index = (key & ((1 << BITS) - 1)).astype("<i4")
            out += [index[cut[k] : cut[k + 1]].tobytes() for k in range(high - low)]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("ord", "doc_id", "toxic")], pa.array(np.diff(at)), pa.array(out, pa.binary())], ["ord", "doc_id", "toxic", "size", "features"])


def _fit(batches: Iterator[pa.RecordBatch], how: Ftrl) -> Iterator[pa.RecordBatch]:
    """The weights that are not zero, and the bias, of the bounded sample."""
    rows: list[tuple[int, int, np.ndarray]] = []
    for batch in batches:
        order, toxic = batch.column("ord").to_numpy(), batch.column("toxic").to_numpy()
        rows += [(int(o), int(y), np.frombuffer(i.as_buffer(), "<i4")) for o, y, i in zip(order, toxic, batch.column("features"), strict=True)]
    if not rows:
        return
    w, bias = ftrl(rows, how)
    kept = np.flatnonzero(w)
    yield pa.RecordBatch.from_pydict({"i": np.append(kept, -1), "w": np.append(w[kept], bias)})


def ftrl(rows: list[tuple[int, int, np.ndarray]], how: Ftrl) -> tuple[np.ndarray, float]:
    """(weights, bias) after some epochs over (order, label, distinct features), in their order, and Platt scaling."""
    rows.sort(key=lambda r: r[0])
    seen = np.zeros(1 << BITS, np.int32)
    for _, _, i in rows:
        seen[i] += 1
    rows = [(o, y, i[seen[i] >= how.min_docs]) for o, y, i in rows]
    apart = int(len(rows) * (1 - how.calibration))
    z, n, bias, bias_n = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0
    for _ in range(how.epochs):
        for _, y, i in rows[:apart]:
            zi, ni = z[i], n[i]
            rate = (how.beta + np.sqrt(ni)) / how.alpha
            w = np.where(np.abs(zi) <= how.l1, 0.0, (np.sign(zi) * how.l1 - zi) / (rate + how.l2))
            p = 1 / (1 + np.exp(-max(-30.0, min(30.0, bias + w.sum()))))
            g = p - y
            z[i] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / how.alpha * w
            n[i] = ni + g * g
            bias_n += g * g
            bias -= how.alpha * g / (how.beta + np.sqrt(bias_n))
    w = np.where(np.abs(z) <= how.l1, 0.0, (np.sign(z) * how.l1 - z) / ((how.beta + np.sqrt(n)) / how.alpha + how.l2))
    scale, shift = _platt(np.array([w[i].sum() for _, _, i in rows[apart:]]), np.array([y for _, y, _ in rows[apart:]], float), bias)
    return w * scale, shift if rows else 0.0


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of all documents whose labels are never learned from; a null id is not of it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fit_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, how: Ftrl | None = None) -> ToxicityModel:
    """Fit on at most ``how.max_train`` labelled documents outside the held-out fifth, least hash of the id first."""
    how = how or Ftrl()
    bounded_batches(spark)
    sample = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id").alias("ord")).distinct()
        .orderBy("ord", "doc_id", "toxic").limit(how.max_train)
    )
    # at most max_train rows of three numbers
    train = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("ord", "doc_id", "toxic", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    hashed = train.mapInArrow(_hashed, f"ord long, doc_id {kind}, toxic int, size long, features binary")
    # rows that share an id may be many: of all there are, max_train reach the one task that fits, and no texts do
    bounded = hashed.orderBy("ord", "doc_id", "toxic", "size", "features").limit(how.max_train).select("ord", "toxic", "features")
    weights = bounded.repartition(1).mapInArrow(partial(_fit, how=how), "i long, w double").toPandas()
    table = weights[weights.i >= 0].sort_values("i")
    bias = weights[weights.i < 0].w
    return ToxicityModel(table.i.to_numpy(np.int64), table.w.to_numpy(np.float32), float(bias.sum()), len(weights) > 0)


def dense(model: ToxicityModel) -> np.ndarray:
    """The weights over the whole hash space; made once a task, and never kept for another model."""
    table = np.zeros(1 << BITS, np.float32)
    table[model.index] = model.weight
    return table


def _scores(column: pa.Array, model: ToxicityModel, table: np.ndarray) -> np.ndarray:
    data, at = utf8_column(column)
    out = np.full(len(at) - 1, model.bias)
    for low, high in chunks(at):
        words = Words(data[at[low] : at[high]], at[low : high + 1] - at[low], NOT_ALNUM)
        hits = []
        for index, doc in features(words):
            there = np.flatnonzero(table[index])
            hits.append((doc[there].astype(np.int64) << BITS) | index[there])
        seen = np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
        out[low:high] += np.bincount(seen >> BITS, table[seen & ((1 << BITS) - 1)], minlength=high - low)
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def score_toxicity(spark: SparkSession, docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        table = dense(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(batch.column("text"), model, table))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def reject_toxic(spark: SparkSession, docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is under ``threshold``."""
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        table = dense(model)
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column("text"), model, table) < threshold))

    return docs.mapInArrow(run, docs.schema)
