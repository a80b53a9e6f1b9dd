"""MinHash near-dedup with BagMinHash signatures over the multiset of a text's word 5-grams.

Signature. A shingle of weight w (its count) covers the unit levels (0, w]. The levels are cut into the dyadic
intervals (0,1], (1,2], (2,4], (4,8] ...; each interval of a shingle is a Poisson process of its length as rate, seeded by
shingle and interval alone. A point takes a random level of its interval and counts only if that is at most w, and a
random component; a component keeps its earliest point. Two texts agree on a component with the probability of their
weighted Jaccard similarity. A process is followed only until its next point is later than every component's earliest.

Candidates. Texts of equal words are one representative. Representatives that share a band of the signature meet in a
bucket. Every bucket's least member is compared with each other member (as many comparisons as members, never all
pairs); a comparison is exact: sum of minima over sum of maxima of the shingle counts. Buckets whose members are then
still in different components are compared across these components, in blocks of members, exactly as well, and the
components made anew. So pairs that a bucket holds are left out only where both are already in one component. What is lost
are pairs that share no band (one in 2,500 of similarity 0.8, fewer above); ``recall`` measures that by brute force.

Words are runs of characters other than ASCII white space, A-Z in lower case. A text of one to four words is one shingle.
Every row has a number of its own, by which it is signed, linked and kept. Defined results: null, empty and white texts
have no words and are one class; a class is named by its least doc_id and keeps one row, the first of those with that
doc_id; rows that share a doc_id but not a class are rows of their own; a null doc_id names a class only where no row of
it has another, as null; long texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components
from .words import Words, chunks, mix, shingles, utf8_column
from .workspace import bounded_batches, materialise

WORDS, THRESHOLD = 5, 0.8
#: Twenty bands of five: a pair of similarity 0.8 shares one with probability 0.9996, one of 0.5 with 0.47.
BANDS, BAND_ROWS = 20, 5
COMPONENTS = BANDS * BAND_ROWS
#: Members of a bucket that one block of the cross-component comparison holds.
BLOCK = 512
#: Comparisons that one copy of a bucket's leader takes part in, about.
LEADER_PAIRS = 256
#: The column of the rows' numbers.
ROW = "__row"
#: Ids that are few enough to broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def counted(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, row, count), sorted by row and shingle."""
    shingle, doc = shingles(words, WORDS)
    order = np.lexsort((shingle, doc))
    shingle, doc = shingle[order], doc[order]
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return shingle[first], doc[first], np.diff(np.append(first, len(shingle)))


def bag_minhash(shingle: np.ndarray, doc: np.ndarray, count: np.ndarray, rows: int, size: int = COMPONENTS) -> np.ndarray:
    """Signatures (rows x size) of unsigned 32-bit numbers; a row without shingles has all ones."""
    element, row, low, width, limit = [shingle], [doc], [np.zeros(len(doc), np.int64)], [np.ones(len(doc), np.int64)], [count]
    level = 1
    while len(more := np.flatnonzero(count > level)):
        element.append(mix(mix(shingle[more] ^ np.uint64(0x94D049BB133111EB)) + np.uint64(level)))
        row.append(doc[more])
        low.append(np.full(len(more), level))
        width.append(np.full(len(more), level))
        limit.append(count[more])
        level *= 2
    element, row, low, width, limit = map(np.concatenate, (element, row, low, width, limit))
    # earliest points: the time as the bits of a positive float32 (which sort as the floats do), then the point's name
    best = np.full(rows * size, np.uint64(0xFFFFFFFFFFFFFFFF))
    time, state = np.zeros(len(element)), element.copy()
    while len(element):
        state = mix(state + _GOLD)
        uniform = ((state >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)
        time = time - np.log(uniform) / width
        name = mix(state ^ np.uint64(0x5851F42D4C957F2D))
        counts = low + ((name >> np.uint64(40)).astype(np.int64) * width >> 24) < limit
        key = (time.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (name & np.uint64(0xFFFFFFFF))
        slot = row * size + (mix(name + np.uint64(1)) % np.uint64(size)).astype(np.int64)
        np.minimum.at(best, slot[counts], key[counts])
        latest = best.reshape(rows, size).max(1)
        stop = np.where(latest == np.uint64(0xFFFFFFFFFFFFFFFF), np.inf, (latest >> np.uint64(32)).astype(np.uint32).view(np.float32))
        on = time <= stop[row]
        element, row, low, width, limit, time, state = (x[on] for x in (element, row, low, width, limit, time, state))
    return (best & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(rows, size)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, doc_id, h1, h2, n_words, sig): the 128-bit hash of the words in order, and the signature."""
    for batch in batches:
        data, at = utf8_column(batch.column("text"))
        rows = len(at) - 1
        whole, sig, n = np.zeros((rows, 2), np.uint64), np.zeros((rows, COMPONENTS), np.uint32), np.zeros(rows, np.int64)
        for low, high in chunks(at):
            words = Words(data[at[low] : at[high]], at[low : high + 1] - at[low])
            place = (np.arange(len(words.doc)) - words.first[words.doc]).astype(np.uint64)
            for k, salt in enumerate((1, 2)):
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words.hash * np.uint64(2 * salt + 1) + mix(place + np.uint64(salt))), dtype=np.uint64)])
                whole[low:high, k] = total[words.first + words.count] - total[words.first]
            n[low:high] = words.count
            sig[low:high] = bag_minhash(*counted(words), high - low)
        h = whole.view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("doc_id"), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(n), pa.array([r.tobytes() for r in sig], pa.binary())], [ROW, "doc_id", "h1", "h2", "n_words", "sig"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id): a 64-bit key of band number and band."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
        key = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(7)), sig.shape[:2]).copy()
        for k in range(BAND_ROWS):
            key = mix(key + sig[:, :, k] * _GOLD)
        ids = np.repeat(batch.column("id").to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(ids)], ["key", "id"])


def similarities(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Multiset Jaccard similarity of the texts of two (bytes, offsets) columns, row by row; 1 where both have no words."""
    rows = len(left[1]) - 1
    out = np.ones(rows)
    joint = left[1] + right[1]
    for low, high in chunks(joint):
        n = high - low
        got = []
        for data, at in (left, right):
            got.append(counted(Words(data[at[low] : at[high]], at[low : high + 1] - at[low])))
        shingle, doc, count = (np.concatenate([a, b]) for a, b in zip(*got, strict=True))
        order = np.lexsort((shingle, doc))
        shingle, doc, count = shingle[order], doc[order], count[order]
        pair = np.flatnonzero((shingle[1:] == shingle[:-1]) & (doc[1:] == doc[:-1]))
        least = np.bincount(doc[pair], np.minimum(count[pair], count[pair + 1]), minlength=n)
        total = np.bincount(doc, count, minlength=n)
        out[low:high] = np.where(total > 0, least / np.maximum(total - least, 1), 1.0)
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sim = similarities(utf8_column(batch.column("text_a")), utf8_column(batch.column("text_b")))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sim)], ["a", "b", "similarity"])


def verified(spark: SparkSession, pairs: DataFrame, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, similarity) of the ``pairs`` (a, b) of row numbers whose texts are similar enough."""
    ids = pairs.select(F.col("a").alias(ROW)).unionByName(pairs.select(F.col("b").alias(ROW))).distinct()
    texts = _texts(docs, ids)
    # a leader of many pairs is copied, so that they are compared in as many tasks as they ask
    copies = pairs.groupBy("a").agg(F.ceil(F.count("*") / LEADER_PAIRS).cast("int").alias("copies"))
    left = texts.select(F.col(ROW).alias("a"), F.col("text").alias("text_a")).join(copies, "a").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    dealt = pairs.join(copies, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int").alias("copy"))
    both = dealt.join(texts.select(F.col(ROW).alias("b"), F.col("text").alias("text_b")), "b").join(left, ["a", "copy"])
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long, similarity double").where(F.col("similarity") >= threshold)


def _cross(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between components among the members of two blocks: exact similarities, and a spanning forest of the links.

    A multiset is the set of its shingles numbered by occurrence, so the intersections are products of 0/1 matrices,
    taken over the elements that several members share, some columns at a time.
    """
    rows = rows.drop_duplicates("id").sort_values("id", ignore_index=True)
    ids, comp = rows.id.to_numpy(), rows.component.to_numpy()
    data, at = utf8_column(pa.array(rows.text, pa.large_string()))
    found = []
    for low, high in chunks(at):
        shingle, doc, count = counted(Words(data[at[low] : at[high]], at[low : high + 1] - at[low]))
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        found.append((mix(np.repeat(shingle, count) + nth.astype(np.uint64) * _GOLD), np.repeat(doc, count) + low))
    element, doc = (np.concatenate(x) for x in zip(*found, strict=True))
    total = np.bincount(doc, minlength=len(ids)).astype(np.float64)
    _, column, holders = np.unique(element, return_inverse=True, return_counts=True)
    shared = holders[column] > 1
    place = np.cumsum(holders > 1) - 1
    column, doc = place[column[shared]], doc[shared]
    order = np.argsort(column, kind="stable")
    column, doc = column[order], doc[order]
    both = np.zeros((len(ids), len(ids)), np.float64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        part = slice(*np.searchsorted(column, [low, low + 4096]))
        held = np.zeros((len(ids), 4096), np.float32)
        held[doc[part], column[part] - low] = 1
        both += held @ held.T
    similar = both / np.maximum(total[:, None] + total[None, :] - both, 1) >= threshold
    similar &= comp[:, None] != comp[None, :]
    names, start = np.unique(comp, return_inverse=True)
    up = list(range(len(names)))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    for i, j in zip(*np.nonzero(np.triu(similar)), strict=True):
        p, q = root(start[i]), root(start[j])
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((ids[i], ids[j]))
    return pd.DataFrame(np.array(out, np.int64).reshape(-1, 2), columns=["a", "b"])


def numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row, which stays as it is however often the rows are read."""
    return materialise(spark, docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered", "zstd")


def recall(spark: SparkSession, docs: DataFrame, found: DataFrame, queries: int = 200, threshold: float = THRESHOLD) -> float:
    """Mean share of a query's links whose other end is in the query's class, by brute force.

    ``docs`` is numbered, ``found`` what ``near_duplicates`` gives of it. The queries are a bounded hash sample of the
    rows that have words, compared with all rows exactly; a query without links to other texts does not count.
    """
    bounded_batches(spark)
    picked = found.where("n_words > 0").select(ROW).orderBy(F.xxhash64(ROW, F.lit(5))).limit(queries)
    sample = docs.select(ROW, "text").join(F.broadcast(picked), ROW).orderBy(ROW).collect()
    if not sample:
        return 1.0
    data, at = utf8_column(pa.array([r["text"] for r in sample], pa.large_string()))
    shingle, query, count = counted(Words(data, at))
    total = np.bincount(query, count, minlength=len(sample))
    order = np.argsort(shingle, kind="stable")
    sent = spark.sparkContext.broadcast((shingle[order], query[order], count[order], total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, of, weight, sizes = sent.value
        for batch in batches:
            data, at = utf8_column(batch.column("text"))
            numbers = batch.column(ROW).to_numpy()
            for low, high in chunks(at):
                shingle, doc, count = counted(Words(data[at[low] : at[high]], at[low : high + 1] - at[low]))
                first, last = np.searchsorted(names, shingle, "left"), np.searchsorted(names, shingle, "right")
                size = last - first
                which = np.repeat(np.arange(len(shingle)), size)
                place = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(len(which))
                both = np.bincount(doc[which] * len(sizes) + of[place], np.minimum(count[which], weight[place]), minlength=(high - low) * len(sizes)).reshape(high - low, -1)
                own = np.bincount(doc, count, minlength=high - low)
                d, q = np.nonzero(both >= threshold * np.maximum(own[:, None] + sizes[None, :] - both, 1) - 1e-9)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(numbers[low + d])], ["q", ROW])

    kind = found.select("class_id", "n_words", ROW)
    links = docs.select(ROW, "text").mapInArrow(run, f"q long, {ROW} long").join(kind, ROW)
    numbered_queries = spark.createDataFrame([(k, r[ROW]) for k, r in enumerate(sample)], f"q long, {ROW} long").join(kind, ROW).select("q", F.col("class_id").alias("own"), F.col(ROW).alias("of"))
    shares = links.join(F.broadcast(numbered_queries), "q").where(F.col(ROW) != F.col("of")).groupBy("q").agg(F.avg(F.col("class_id").eqNullSafe(F.col("own")).cast("double")).alias("share"))
    mean = shares.agg(F.avg("share")).first()[0]
    return 1.0 if mean is None else float(mean)


def near_duplicates(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(row number, doc_id, class_id, n_words, kept) of every row.

    class_id is the least doc_id that links reach, the own one included; kept is true for one row of each class.
    The numbers are those of ``numbered``, where ``docs`` comes from there.
    """
    bounded_batches(spark)
    if ROW not in docs.columns:
        docs = numbered(spark, docs.select("doc_id", "text"))
    docs = docs.select(ROW, F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialise(spark, docs.mapInArrow(_sign, f"{ROW} long, doc_id long, h1 long, h2 long, n_words long, sig binary"), "signatures")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col(ROW).alias("row"))
    same = signed.groupBy("h1", "h2", "n_words").agg(F.min(ROW).alias("id"), F.min_by("sig", ROW).alias("sig"), F.min(first).alias("first"))
    same = materialise(spark, same, "representatives")
    reps = same.where("n_words > 0").select("id", "sig")
    bands = materialise(spark, reps.mapInArrow(_bands, "key long, id long"), "bands")
    buckets = materialise(spark, bands.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("leader")).where("n > 1"), "buckets")
    members = materialise(spark, bands.join(buckets.select("key", "leader"), "key"), "members")
    stars = materialise(spark, members.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), "stars")
    links = materialise(spark, verified(spark, stars, docs, threshold).select("a", "b"), "links")
    comp = materialise(spark, connected_components(spark, links), "components")

    placed = members.join(comp.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("who")).where("c0 <> c1")
    # buckets of the same members are one
    once = mixed.groupBy("n", "who").agg(F.min("key").alias("key")).select("key", "n")
    more = materialise(spark, _across(materialise(spark, placed.join(once, "key"), "mixed"), docs, threshold), "links")
    if more.limit(1).count():
        comp = materialise(spark, connected_components(spark, links.unionByName(more)), "components")

    # components are of representatives' numbers; each is named and kept by the first row of any of them
    linked = same.select("id", "first").join(comp.withColumnRenamed("node", "id"), "id")
    named = linked.groupBy("component").agg(F.min("first").alias("head"))
    heads = linked.join(named, "component").select("id", "head")
    classes = same.join(heads, "id", "left").select("h1", "h2", "n_words", F.coalesce("head", "first").alias("head"))
    rows = signed.select(ROW, "doc_id", "h1", "h2", "n_words").join(classes, ["h1", "h2", "n_words"])
    return rows.select(ROW, "doc_id", F.col("head.doc_id").alias("class_id"), "n_words", (F.col(ROW) == F.col("head.row")).alias("kept"))


def _across(mixed: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between components that share a bucket, from blocks of its members.

    Members of a component of at least a block are dealt to blocks of its own, and two blocks that hold the same single
    component don't meet. So a large group of copies with a few strangers costs as many block pairs as it has blocks.
    """
    size = mixed.groupBy("key", "component").agg(F.count("*").alias("size"))
    own = F.concat_ws("-", "component", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK)).cast("string"))
    shared = F.concat(F.lit("+"), F.pmod(F.xxhash64("component"), F.ceil(F.col("n") / BLOCK)).cast("string"))
    dealt = mixed.join(size, ["key", "component"]).withColumn("block", F.when(F.col("size") >= BLOCK, own).otherwise(shared))
    blocks = dealt.groupBy("key", "block").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
    left = blocks.select("key", F.col("block").alias("bi"), F.col("c0").alias("l0"), F.col("c1").alias("l1"))
    right = blocks.select("key", F.col("block").alias("bj"), F.col("c0").alias("r0"), F.col("c1").alias("r1"))
    meet = left.join(right, "key").where("bi <= bj and not (l0 = l1 and r0 = r1 and l0 = r0)").select("key", "bi", "bj")
    sides = meet.withColumn("block", F.explode(F.array_distinct(F.array("bi", "bj"))))
    rows = sides.join(dealt.select("key", "block", "id", "component"), ["key", "block"])
    texts = _texts(docs, mixed.select("id").distinct()).withColumnRenamed(ROW, "id")
    rows = rows.join(texts, "id").select("key", "bi", "bj", "id", "component", "text")
    return rows.groupBy("key", "bi", "bj").applyInPandas(partial(_cross, threshold=threshold), "a long, b long").distinct()


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(row number, text) of the rows whose numbers are the ``ids`` (one column)."""
    ids = ids.toDF(ROW)
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.select(ROW, "text").join(F.broadcast(ids) if few else ids, ROW, "left_semi")
