"""Sharding: Karmarkar-Karp differencing over groups of equal texts, for near equal bytes in each shard.

Groups (rows of equal text) are indivisible. Their sizes are summed on the map side first, so a hot group is one number.
Each bucket of groups is differenced by itself: a group is a partial partition (its size, and zeros); the two partial
partitions of largest spread are combined in opposite order, until one is left. The buckets' results are partial
partitions again, one row of ``shards`` numbers each: they are dealt to fewer buckets and differenced in the same way, level
by level, until one is left. No task holds more than about BUCKET_GROUPS partial partitions, however many there are.

Defined results: a null text counts as an empty one (size 1, crc of the empty text) and is of its group; equal
texts have one shard; rows that share a doc_id, or have none, are rows of their own; ties fall by size and then by the
group's hash, so the result does not depend on the partitioning beyond the number of buckets; very long texts are hashed
whole; other columns are ignored, whatever their names; an empty table gives no rows. A group larger than its fair share
makes its shard that much larger: it is never cut.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import bounded_batches, materialise

#: Partial partitions in a bucket, about.
BUCKET_GROUPS = 20_000
#: Rows in a block of the numbering within a shard, about.
SLOT_ROWS = 50_000


def difference(sums: np.ndarray, names: list) -> np.ndarray:
    """Karmarkar-Karp: for each partial partition (a row of ``sums``) the order in which its parts go to the result's.

    Returns ``place`` of the same shape: part j of row i is in part ``place[i, j]`` of the whole. Ties by name.
    """
    n, k = sums.shape
    place = np.tile(np.arange(k), (n, 1))
    # a partial partition holds, per part, the (row, part) pairs in it as a linked tree of merges
    heap: list = []
    nodes: list = []

    def push(values: np.ndarray, parts: list, name) -> None:
        order = sorted(range(k), key=lambda j: (-values[j], j))
        nodes.append(([values[j] for j in order], [parts[j] for j in order]))
        heapq.heappush(heap, (-(values[order[0]] - values[order[-1]]), name, len(nodes) - 1))

    for i in range(n):
        push(sums[i].tolist(), [(i, j) for j in range(k)], names[i])
    while len(heap) > 1:
        _, name, a = heapq.heappop(heap)
        _, other, b = heapq.heappop(heap)
        (va, pa), (vb, pb) = nodes[a], nodes[b]
        nodes[a] = nodes[b] = None
        push([x + y for x, y in zip(va, reversed(vb), strict=True)], [(x, y) for x, y in zip(pa, reversed(pb), strict=True)], min(name, other))
    if n:
        _, parts = nodes[heap[0][2]]
        for part, tree in enumerate(parts):
            todo = [tree]
            while todo:
                x, y = todo.pop()
                if isinstance(x, tuple):
                    todo += [x, y]
                else:
                    place[x, y] = part
    return place


def _bucket(shards: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """(bucket, h1, h2, part, p0..) : each group's part of the bucket, and the bucket's sums in every row."""
        rows = rows.sort_values(["size", "h1", "h2"], ascending=[False, True, True], ignore_index=True)
        sums = np.zeros((len(rows), shards), np.int64)
        sums[:, 0] = rows["size"]
        place = difference(sums, list(range(len(rows))))
        total = np.bincount(place[:, 0], rows["size"], minlength=shards).astype(np.int64)
        return pd.DataFrame({"bucket": rows.bucket, "h1": rows.h1, "h2": rows.h2, "part": place[:, 0].astype(np.int32), "sums": [total] * len(rows)})

    return run


def _level(shards: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """(up, bucket, place, sums): for each bucket of a bucket of the next level, where its parts go, and the whole's sums."""
        rows = rows.sort_values("bucket", ignore_index=True)
        sums = np.array(rows.sums.tolist(), np.int64).reshape(-1, shards)
        place = difference(sums, list(range(len(rows))))
        total = np.zeros(shards, np.int64)
        np.add.at(total, place.ravel(), sums.ravel())
        return pd.DataFrame({"up": rows.up, "bucket": rows.bucket, "place": list(place.astype(np.int32)), "sums": [total] * len(rows)})

    return run


def shard_by_bytes(spark: SparkSession, docs: DataFrame, shards: int = 8, buckets: int | None = None, fan: int = BUCKET_GROUPS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row: size is the text's bytes plus 1, slot is gapless in a shard.

    ``buckets`` is the number of buckets of the first level, ``fan`` how many buckets of a level meet in one of the next.
    """
    bounded_batches(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text, F.lit(1)).alias("h1"),
        F.xxhash64(F.lit(2), text).alias("h2"),
    )
    rows = materialise(spark, rows, "sizes")
    groups = materialise(spark, rows.groupBy("h1", "h2").agg(F.sum("size").alias("size")), "groups")
    if buckets is None:
        buckets = max(1, -(-groups.count() // BUCKET_GROUPS))
    dealt = groups.withColumn("bucket", F.pmod(F.xxhash64("h2", "h1"), F.lit(buckets)).cast("int"))
    parts = materialise(spark, dealt.groupBy("bucket").applyInPandas(_bucket(shards), "bucket int, h1 long, h2 long, part int, sums array<long>"), "parts")
    placed = parts.select("bucket", "h1", "h2", F.col("part").alias("shard"))
    sums = parts.groupBy("bucket").agg(F.first("sums").alias("sums"))
    while True:
        buckets = -(-buckets // fan)
        level = sums.withColumn("up", F.pmod("bucket", F.lit(buckets)).cast("int")).groupBy("up").applyInPandas(_level(shards), "up int, bucket int, place array<int>, sums array<long>")
        level = materialise(spark, level, "level")
        # a row of ``shards`` small numbers a bucket: the first level has one for 20,000 groups
        placed = placed.join(level.select("bucket", "up", "place"), "bucket").select(F.col("up").alias("bucket"), "h1", "h2", F.col("place")[F.col("shard")].alias("shard"))
        if buckets == 1:
            break
        sums = level.groupBy(F.col("up").alias("bucket")).agg(F.first("sums").alias("sums"))
    placed = placed.select("h1", "h2", "shard")
    out = materialise(spark, rows.join(placed, ["h1", "h2"]).select("doc_id", "size", "text_crc32", "shard"), "placed")
    return number(spark, out)


def number(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard: rows are numbered in hash blocks, and the blocks' counts summed up."""
    blocks = max(1, -(-rows.count() // SLOT_ROWS)) * 4
    keyed = rows.withColumn("__block", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(blocks)).cast("int"))
    counts = keyed.groupBy("shard", "__block").agg(F.count("*").alias("__n"))
    base = counts.selectExpr("shard", "__block", "sum(__n) over (partition by shard order by __block rows between unbounded preceding and current row) - __n as __base")
    numbered = keyed.selectExpr("*", "row_number() over (partition by shard, __block order by doc_id, size, text_crc32) - 1 as __at")
    return numbered.join(base, ["shard", "__block"]).select(*[c for c in rows.columns], (F.col("__base") + F.col("__at")).cast("long").alias("slot"))
