"""Quality classifier: positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are documents labelled 1 outside the held-out fifth; every document outside that fifth is unlabelled
text; the class prior is estimated. Rows labelled 0 are never used.

The model is additive: a weight for each quantile bin of each statistic of a text, and a bias. With the squared loss
l(z) = (1 - z)^2 / 4 the means that the risk is made of depend on the data through the first two moments of the bins alone:

    R(w) = prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)])

so the unlabelled risk is that of all documents, whatever their number: one pass sums a matrix of fixed size, and the
driver descends on the moments. Bin edges are quantiles over all documents. The prior is the share of unlabelled values over
the median value of positives, twice that: documents are halved by hash, a first model is fitted on each half and
measured on the other one, so no text is measured by a model that saw it, and the mean is taken. A last pass counts
the model's values in narrow bins, and the logistic curve that turns a value into a score is the one of least unbiased
logistic risk over these counts.

Defined results: a null text counts as empty; an empty text gets the score of its own (all zero) statistics; equal
texts have equal scores; very long texts are read whole; an empty table gives no rows; without positives every text
scores 0.5. A null doc_id is unlabelled text and not held out; repeated labels count once; rows that share a doc_id are
documents of their own. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .toxicity import held_out
from .words import WHITE, Words, chunks, utf8_column
from .workspace import bounded_batches, materialise

#: Labelled positives that the model is fitted on at most.
MAX_POSITIVE = 8_000
#: Quantile bins of each statistic.
BINS = 12
#: Bins of the model's value to each side of nothing, and their width.
VALUE_BINS, VALUE_STEP = 300, 0.01


@dataclass
class QualityModel:
    """Per statistic the bin edges and the bins' weights, the bias, the estimated class prior, and slope and shift of the scores."""

    edges: np.ndarray
    weight: np.ndarray
    bias: float
    prior: float
    slope: float = 1.0
    shift: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.value(x) + self.shift)

    def value(self, x: np.ndarray) -> np.ndarray:
        """The model's value of each row of statistics."""
        return self.weight[one_hot(x, self.edges)].sum(1) + self.bias if len(x) else np.zeros(0)


def _members(chars: str) -> np.ndarray:
    table = np.zeros(256, np.float32)
    table[[ord(c) for c in chars]] = 1
    return table


_CLASSES = {
    "lower": _members("abcdefghijklmnopqrstuvwxyz"), "upper": _members("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digit": _members("0123456789"),
    "stop": _members(".?"), "comma": _members(",;:'\""), "shout": _members("!"), "bar": _members("|"), "symbol": _members("#$%&*@^~<>{}[]\\/=+_`"),
    "line": _members("\n"), "wide": np.concatenate([np.zeros(128, np.float32), np.ones(128, np.float32)]),
}
STATISTICS = [f"{k}_share" for k in _CLASSES] + ["log_bytes", "word_length", "distinct_words", "repeated_lines", "line_words", "top_word"]
#: Bins of all statistics.
SIZE = len(STATISTICS) * (BINS + 1)


def _per_row(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[at[1:]] - total[at[:-1]]


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text, from its bytes, words and lines."""
    data, at = utf8_column(column)
    out = np.zeros((len(at) - 1, len(STATISTICS)), np.float64)
    for low, high in chunks(at):
        part, cut = data[at[low] : at[high]], at[low : high + 1] - at[low]
        size = np.maximum(np.diff(cut), 1)
        got = [_per_row(table[part], cut) / size for table in _CLASSES.values()]
        words = Words(part, cut, WHITE)
        n = np.maximum(words.count, 1)
        rows = high - low
        order = np.lexsort((words.hash, words.doc))
        h, d = words.hash[order], words.doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        runs = np.diff(np.append(np.flatnonzero(new), len(h)))
        most = np.zeros(rows)
        np.maximum.at(most, d[new], runs)
        breaks = np.zeros(256, bool)
        breaks[10] = True
        lines = Words(part, cut, breaks)
        keys = lines.hash ^ (lines.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, first = np.unique(keys, return_index=True)
        distinct = np.bincount(lines.doc[first], minlength=rows)
        out[low:high] = np.column_stack(
            [*got, np.log1p(np.diff(cut)), _per_row(~WHITE[part], cut) / n, np.bincount(d[new], minlength=rows) / n,
             1 - distinct / np.maximum(lines.count, 1), n / np.maximum(lines.count, 1), most / n]
        )
    # rounded, so that equal texts have equal statistics wherever they stand in a chunk
    return np.round(out, 9)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = statistics(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(table[:, k]) for k in range(len(STATISTICS))]], ["doc_id", *[f"s{k}" for k in range(len(STATISTICS))]])


def _table(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(f"s{k}").to_numpy() for k in range(len(STATISTICS))]) if batch.num_rows else np.zeros((0, len(STATISTICS)))


def one_hot(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Column numbers of each row's bins, one per statistic."""
    return np.column_stack([np.searchsorted(edges[k], x[:, k], "right") + k * (BINS + 1) for k in range(x.shape[1])])


def moments_of(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The sum over rows of v v', where v has a 1 for each bin that the row is in and, last, a 1 for the bias."""
    out = np.zeros((SIZE + 1, SIZE + 1))
    for low in range(0, len(x), 8192):
        columns = one_hot(x[low : low + 8192], edges)
        v = np.zeros((len(columns), SIZE + 1), np.float32)
        v[np.arange(len(columns))[:, None], columns] = 1
        v[:, -1] = 1
        out += v.T @ v  # counts under 2 ** 24, exact in float32
    return out


def _moments(batches: Iterator[pa.RecordBatch], edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(part, row, v): the task's moments by part, a row of the matrix in each."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        part, x = batch.column("part").to_numpy(), _table(batch)
        for p in np.unique(part):
            total[int(p)] = total.get(int(p), 0) + moments_of(x[part == p], edges)
    for p, m in total.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), p, np.int32)), pa.array(np.arange(len(m), dtype=np.int32)), pa.array(list(m), pa.list_(pa.float64()))], ["part", "row", "v"])


def _summed(rows: DataFrame, edges: np.ndarray) -> dict[int, np.ndarray]:
    """The moments of each ``part`` of the rows; what comes to the driver has a fixed size."""
    tasks = rows.mapInArrow(partial(_moments, edges=edges), "part int, row int, v array<double>")
    width = SIZE + 1
    sums = tasks.groupBy("part", "row").agg(*[F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(width)]).collect()
    out: dict[int, np.ndarray] = {}
    for r in sums:
        out.setdefault(r["part"], np.zeros((width, width)))[r["row"]] = r[2:]
    return out


def risk(w: np.ndarray, prior: float, p: np.ndarray, u: np.ndarray) -> tuple[float, float]:
    """(positives' part, negatives' part) of the unbiased risk, from the moments (bias last) of positives and unlabelled."""
    n_p, n_u = max(p[-1, -1], 1.0), max(u[-1, -1], 1.0)
    quad_p, quad_u, mean_p, mean_u = w @ p @ w / n_p, w @ u @ w / n_u, w @ p[-1] / n_p, w @ u[-1] / n_u
    return prior * (1 - 2 * mean_p + quad_p) / 4, (1 + 2 * mean_u + quad_u) / 4 - prior * (1 + 2 * mean_p + quad_p) / 4


def gradients(w: np.ndarray, prior: float, p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gradients of both parts of ``risk``."""
    n_p, n_u = max(p[-1, -1], 1.0), max(u[-1, -1], 1.0)
    return prior * (p @ w - p[-1]) / (2 * n_p), (u @ w + u[-1]) / (2 * n_u) - prior * (p @ w + p[-1]) / (2 * n_p)


def _descend(step, rounds: int, rate: float = 0.03) -> np.ndarray:
    """Adam, from nothing."""
    w, m, v = np.zeros(SIZE + 1), np.zeros(SIZE + 1), np.zeros(SIZE + 1)
    for t in range(1, rounds + 1):
        g = step(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (0.1 if t > rounds * 0.7 else 1.0) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _ridge(p: np.ndarray) -> float:
    """The weight of the squared weights: more where there are few positives."""
    return 1e-4 + 1 / max(p[-1, -1], 1.0)


def fit_apart(p: np.ndarray, u: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """A model that tells positives from unlabelled texts, both of equal weight."""
    l2 = _ridge(p)

    def step(w: np.ndarray) -> np.ndarray:
        return (p @ w - p[-1]) / max(p[-1, -1], 1) + (u @ w + u[-1]) / max(u[-1, -1], 1) + l2 * w

    return _descend(step, rounds)


def fit_risk(prior: float, p: np.ndarray, u: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Descend on the non-negative risk: where the negatives' part is under nothing, climb back along it alone."""
    l2 = _ridge(p)

    def step(w: np.ndarray) -> np.ndarray:
        own, rest = gradients(w, prior, p, u)
        return (own + rest if risk(w, prior, p, u)[1] >= 0 else -rest) + l2 * w

    return _descend(step, rounds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def prior_of(unlabelled_over: float, positive_over: float) -> float:
    """The class prior from the shares of unlabelled and of positive scores over a bar that hardly a negative reaches."""
    return float(np.clip(unlabelled_over / positive_over if positive_over else 0.5, 0.05, 0.99))


def fit_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE) -> QualityModel:
    """Fit on all documents as unlabelled text and a bounded hash sample of the positives (least hash of the id first)."""
    return _fit(spark, _statistics(spark, docs), labels, max_positive)


def _statistics(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, s0, s1 ...) of every document, written once: everything else reads these few numbers."""
    bounded_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ", ".join(f"s{k} double" for k in range(len(STATISTICS)))
    return materialise(spark, docs.select("doc_id", "text").mapInArrow(_stats, f"doc_id {kind}, {columns}"), "statistics")


def _fit(spark: SparkSession, table: DataFrame, labels: DataFrame, max_positive: int) -> QualityModel:
    names = [f"s{k}" for k in range(len(STATISTICS))]
    learn = table.where(~held_out())
    shares = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
    found = learn.agg(*[F.percentile_approx(c, shares, F.lit(10_000)).alias(c) for c in names]).first()
    if found is None or found[0] is None:
        return QualityModel(np.zeros((len(STATISTICS), BINS - 1)), np.zeros(SIZE), 0.0, 0.5)
    edges = np.array([list(found[c]) for c in names])
    sample = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id").distinct()
    # at most max_positive ids
    sample = materialise(spark, sample.select("doc_id", F.xxhash64("doc_id").alias("ord")).orderBy("ord", "doc_id").limit(max_positive).select("doc_id"), "positives")
    half = F.pmod(F.xxhash64(*names), F.lit(2)).cast("int")
    positive = learn.join(F.broadcast(sample), "doc_id").select(*names, (half + 2).alias("part"))
    unlabelled = learn.select(*names, half.alias("part"))
    sums = _summed(positive.unionByName(unlabelled), edges)
    none = np.zeros((SIZE + 1, SIZE + 1))
    (u0, u1, p0, p1) = (sums.get(k, none) for k in range(4))
    p, u = p0 + p1, u0 + u1
    if not p[-1, -1] or not u[-1, -1]:
        return QualityModel(edges, np.zeros(SIZE), 0.0, 0.5)
    if all(m[-1, -1] for m in (u0, u1, p0, p1)):
        halves = [(fit_apart(p0, u0), 1), (fit_apart(p1, u1), 0)]
    else:  # too few to tell halves apart
        halves = [(fit_apart(p, u), None)]
    priors = []
    for w, k in halves:
        own, rest = (positive, unlabelled) if k is None else (positive.where(F.col("part") == k + 2), unlabelled.where(F.col("part") == k))
        priors.append(_prior(own, rest, QualityModel(edges, w[:-1], float(w[-1]), 0.5)))
    prior = float(np.mean(priors))
    w = fit_risk(prior, p, u)
    model = QualityModel(edges, w[:-1], float(w[-1]), prior)
    model.slope, model.shift = curve(prior, _histogram(positive, model), _histogram(learn, model))
    return model


def _histogram(rows: DataFrame, model: QualityModel) -> np.ndarray:
    """Counts of the rows' values; values beyond the last bins count in them."""
    f = rows.select(*[f"s{k}" for k in range(len(STATISTICS))]).mapInArrow(partial(_values, model=model), "f double")
    at = F.greatest(F.lit(-VALUE_BINS), F.least(F.lit(VALUE_BINS), F.rint(F.col("f") / VALUE_STEP))).cast("int")
    out = np.zeros(2 * VALUE_BINS + 1)
    for r in f.groupBy(at.alias("at")).count().collect():
        out[r["at"] + VALUE_BINS] = r["count"]
    return out


def curve(prior: float, p: np.ndarray, u: np.ndarray, l2: float = 1e-3) -> tuple[float, float]:
    """Slope and shift of least unbiased logistic risk E_u[log(1 + e^g)] - prior * E_p[g], by Newton steps, from histograms."""
    x = np.column_stack([np.arange(-VALUE_BINS, VALUE_BINS + 1) * VALUE_STEP, np.ones(len(u))])
    p, u, ab = p / max(p.sum(), 1), u / max(u.sum(), 1), np.array([2.0, 0.0])
    for _ in range(100):
        q = _sigmoid(x @ ab)
        step = np.linalg.solve((x * (u * q * (1 - q))[:, None]).T @ x + l2 * np.eye(2), x.T @ (u * q - prior * p) + l2 * ab)
        ab = ab - np.clip(step, -1, 1)
    return float(ab[0]), float(ab[1])


def _values(batches: Iterator[pa.RecordBatch], model: QualityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(model.value(_table(batch)))], ["f"])


def _prior(positive: DataFrame, unlabelled: DataFrame, model: QualityModel) -> float:
    names = [f"s{k}" for k in range(len(STATISTICS))]
    run = partial(_values, model=model)
    own = positive.select(*names).mapInArrow(run, "f double")
    bar = own.agg(F.percentile_approx("f", 0.5, 10_000)).first()[0]
    over = F.avg(F.when(F.col("f") >= bar, 1.0).otherwise(0.0))
    return prior_of(unlabelled.select(*names).mapInArrow(run, "f double").agg(over).first()[0], own.agg(over).first()[0])


def _scored(table: DataFrame, model: QualityModel) -> DataFrame:
    sent = table.sparkSession.sparkContext.broadcast(model)  # a few kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sent.value.score(_table(batch)))], ["doc_id", "score"])

    return table.mapInArrow(run, f"doc_id {table.schema['doc_id'].dataType.simpleString()}, score double")


def score_quality(spark: SparkSession, docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    return _scored(_statistics(spark, docs), model)


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE) -> tuple[DataFrame, QualityModel]:
    """(doc_id, score) of every row of ``docs`` by the model fitted on them; the texts are read once."""
    table = _statistics(spark, docs)
    model = _fit(spark, table, labels, max_positive)
    return _scored(table, model), model
