"""Embedding near-dedup over a robust-pruned flat graph.

1. Equal vectors become one representative with a number of its own and a count.
2. Representatives are dealt to shards: the cells of spherical k-means centres (fitted on a bounded hash sample), each
   representative to its nearest centres, so shards overlap: ``overlap`` and one more for each power of ten of centres.
   A shard of too many members gets centres of its own until none is left that can be split.
3. Every shard builds its part of the graph: a node's candidates are its nearest members and some random ones, robustly
   pruned (a candidate goes if one already taken is closer to it, by the factor ALPHA, than the node is).
4. The shards' adjacency lists of a node are united.
5. Every shard searches the united graph for each of its members: greedily with a beam over visited nodes from the shard's
   medoids and the member itself, then expanding every node found in range until nothing new is in range. The walk crosses
   shards: neighbours in other shards that are close enough to lie on a way between two vectors in range come to the
   shard with their vectors. Cosines are taken in double precision. A shard gives a spanning forest of the links it
   found, so its rows never outgrow its nodes.
6. The links' connected components are what range expansion reaches across shards. Within each component the cosines of
   its members are verified in blocks, which counts every member's links; no pair leaves a task.
7. Recall is audited against brute force for a bounded sample of queries, taken evenly from all rows, against all rows. The
   links counted are verified ones, so a query's count is a subset of its true links and their ratio is its recall; a
   query counts as much as any other however many links it has. Below ``audit`` it is all done again with more overlap,
   and after the last overlap by comparing all blocks of representatives with each other, which misses nothing.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of
different lengths don't link; equal vectors link; rows that share a vec_id are rows of their own, with counts of their
own; a null vec_id names a component only where no member has another, as null; other columns are ignored, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components
from .workspace import bounded_batches, materialise

THRESHOLD = 0.95


@dataclass
class Graph:
    """Parameters.

    shard_rows: representatives for each centre, as long as the centres take no more than ``centre_bytes`` (they are
    broadcast); with more rows than that, shards grow. crowd: a shard of so many times shard_rows members is split.
    sampled: vectors of the fit for each centre.
    """

    shard_rows: int = 1000
    crowd: int = 6
    sampled: int = 8
    centre_bytes: int = 64 << 20
    overlap: int = 2
    nearest: int = 40
    random: int = 12
    degree: int = 20
    alpha: float = 1.2
    beam: int = 32
    entries: int = 24
    block: int = 1024
    audit_queries: int = 2000
    audit: float = 0.95
    #: True links up to which an audited query is of a small group.
    small: int = 8
    most_overlap: int = 16


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, dim, vec): the unit vector as doubles; no vec where the row links with nothing."""
    for batch in batches:
        dims, out = [], []
        for row in batch.column("embedding"):
            v = row.values
            made = None
            if v is not None and len(v) and v.null_count == 0:
                x = v.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                norm = np.sqrt(np.square(x / (top := np.abs(x).max())).sum()) * top if np.isfinite(x).all() and x.any() else 0.0
                made = (x / norm).tobytes() if norm > 0 and np.isfinite(norm) else None
            dims.append(len(v) if v is not None else 0)
            out.append(made)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").cast(pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], ["vec_id", "dim", "vec"])


def matrix(vecs) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), np.float64).reshape(len(vecs), -1)


def centres_of(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced rows of a hash sample."""
    k = max(1, min(k, len(x)))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        home = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        norm = np.linalg.norm(total, axis=1)
        c[norm > 0] = total[norm > 0] / norm[norm > 0, None]
    return c


def tree_centres(x: np.ndarray, k: int, fan: int = 64) -> np.ndarray:
    """``k`` centres, about: k-means with at most ``fan`` centres at a time, its cells divided again by their sizes."""
    if k <= fan or len(x) <= fan:
        return centres_of(x, k)
    coarse = centres_of(x[:: max(1, len(x) // (32 * fan))], fan)
    home = np.concatenate([(x[i : i + 4096] @ coarse.T).argmax(1) for i in range(0, len(x), 4096)])
    cells = [x[home == c] for c in range(len(coarse))]
    cells = [c for c in cells if len(c)]
    if len(cells) == 1:
        return cells[0][:: max(1, len(x) // k)]
    return np.concatenate([tree_centres(c, max(1, round(k * len(c) / len(x))), fan) for c in cells])


def robust_prune(x: np.ndarray, how: Graph, rng: np.random.Generator) -> list[np.ndarray]:
    """Each member's neighbours: candidates taken nearest first, unless one taken before covers them."""
    n = len(x)
    near = min(how.nearest, n - 1)
    out: list[np.ndarray] = []
    for low in range(0, n, 256):
        part = x[low : low + 256]
        cosine = part @ x.T
        cosine[np.arange(len(part)), np.arange(low, low + len(part))] = -2
        top = np.argpartition(-cosine, near - 1, axis=1)[:, :near] if near > 0 else np.zeros((len(part), 0), int)
        cand = np.concatenate([top, rng.integers(0, n, (len(part), how.random))], axis=1)
        c = np.take_along_axis(cosine, cand, 1)
        order = np.argsort(-c, axis=1, kind="stable")
        cand, c = np.take_along_axis(cand, order, 1), np.take_along_axis(c, order, 1)
        open_ = c > -2
        vec = x[cand]
        between = np.sqrt(np.maximum(0, 2 - 2 * (vec @ vec.transpose(0, 2, 1))))
        own = np.sqrt(np.maximum(0, 2 - 2 * c))
        taken = np.zeros_like(open_)
        for _ in range(how.degree):
            first = open_.argmax(1)
            rows = np.flatnonzero(open_[np.arange(len(part)), first])
            if not len(rows):
                break
            f = first[rows]
            taken[rows, f] = True
            covered = how.alpha * between[rows, f] <= own[rows]
            open_[rows] &= ~covered
            open_[rows, f] = False
        out += [np.unique(cand[k][taken[k]]) for k in range(len(part))]
    return out


def _build(how: Graph, threshold: float):
    # two vectors in range of a third are at least this close to each other
    close = 2 * threshold * threshold - 1 if threshold > 0 else -1.0

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """(id, next, close): a member's neighbours in this shard, edges both ways, and those of them that are close."""
        rows = rows.sort_values("id", ignore_index=True)
        ids = rows.id.to_numpy(np.int64)
        n, x = len(ids), matrix(rows.vec)
        none = [np.zeros(0, np.int64)] * n
        if n < 2:
            return pd.DataFrame({"id": ids, "next": none, "close": none})
        made = robust_prune(x, how, np.random.default_rng(n))
        a = np.repeat(np.arange(n), [len(v) for v in made])
        b = np.concatenate(made)
        both = np.unique(np.concatenate([a * n + b, b * n + a]))
        a, b = both // n, both % n
        near = np.concatenate([np.einsum("ij,ij->i", x[a[i : i + 65536]], x[b[i : i + 65536]]) for i in range(0, len(a), 65536)]) >= close

        def lists(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
            return np.split(ids[b], np.searchsorted(a, np.arange(1, n)))

        return pd.DataFrame({"id": ids, "next": lists(a, b), "close": lists(a[near], b[near])})

    return run


@dataclass
class Adjacency:
    """Neighbours of each node: ``to[start[i] : start[i + 1]]``."""

    start: np.ndarray
    to: np.ndarray

    @classmethod
    def of(cls, lists: list[np.ndarray]) -> Adjacency:
        return cls(np.concatenate([[0], np.cumsum([len(v) for v in lists])]).astype(np.int64), np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64))

    def expand(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``nodes``, neighbour) of every edge out of them."""
        size = self.start[nodes + 1] - self.start[nodes]
        which = np.repeat(np.arange(len(nodes)), size)
        return which, self.to[np.repeat(self.start[nodes] - (np.cumsum(size) - size), size) + np.arange(len(which))]


def search(x: np.ndarray, graph: Adjacency, queries: np.ndarray, entries: np.ndarray, beam: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``queries``, node) pairs in range.

    Greedily first: a query keeps its ``beam`` best visited nodes and expands the best that it has not expanded, until there is
    none. Then every node in range is expanded, until nothing new is in range.
    """
    n, q = len(x), len(queries)
    seen, expanded, hit = np.zeros((q, n), bool), np.zeros((q, n), bool), np.zeros((q, n), bool)

    def visit(row: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Cosines of pairs that have not been seen."""
        if len(row) * 4 > q * n:
            cosine = (x[queries] @ x.T)[row, node]
        else:
            cosine = np.concatenate([np.zeros(0), *[np.einsum("ij,ij->i", x[queries[row[i : i + 65536]]], x[node[i : i + 65536]]) for i in range(0, len(row), 65536)]])
        seen[row, node] = True
        found = cosine >= threshold
        hit[row[found], node[found]] = True
        return cosine

    first = np.concatenate([np.tile(entries, (q, 1)), queries[:, None]], axis=1)
    repeated = np.zeros(first.shape, bool)
    repeated[:, :-1] = first[:, :-1] == queries[:, None]
    row, col = np.nonzero(~repeated)
    value = np.full(first.shape, -2.0)
    value[row, col] = visit(row, first[row, col])
    node = np.where(repeated, -1, first)
    active = np.arange(q)
    while len(active):
        open_ = np.where((node >= 0) & ~expanded[active[:, None], np.maximum(node, 0)], value, -2.0)
        best = open_.argmax(1)
        go = open_[np.arange(len(active)), best] > -2.0
        active, node, value, best = active[go], node[go], value[go], best[go]
        if not len(active):
            break
        at = node[np.arange(len(active)), best]
        expanded[active, at] = True
        which, to = graph.expand(at)
        new = ~seen[active[which], to]
        which, to = which[new], to[new]
        cosine = visit(active[which], to)
        # a row for each query: its beam and what is new, of which the best stay
        count = np.bincount(which, minlength=len(active))
        place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        more, more_node = np.full((len(active), int(count.max(initial=0))), -2.0), np.full((len(active), int(count.max(initial=0))), -1)
        more[which, place], more_node[which, place] = cosine, to
        value, node = np.concatenate([value, more], 1), np.concatenate([node, more_node], 1)
        if value.shape[1] > beam:
            top = np.argpartition(-value, beam - 1, axis=1)[:, :beam]
            value, node = np.take_along_axis(value, top, 1), np.take_along_axis(node, top, 1)
    while True:
        row, node_ = np.nonzero(hit & ~expanded)
        if not len(row):
            break
        expanded[row, node_] = True
        reached = np.zeros((q, n), bool)
        for i in range(0, len(row), 100_000):
            which, to = graph.expand(node_[i : i + 100_000])
            reached[row[i : i + 100_000][which], to] = True
        row, node_ = np.nonzero(reached & ~seen)
        visit(row, node_)
    return np.nonzero(hit)


class Forest:
    """A spanning forest over 0..n-1 of links that come node by node."""

    def __init__(self, n: int):
        self.label, self.links = np.arange(n), []

    def add(self, node: int, others: np.ndarray) -> None:
        mine = self.label[others]
        names, first = np.unique(mine, return_index=True)
        for name, k in zip(names, first, strict=True):
            own = self.label[node]
            if name != own:
                self.links.append((node, int(others[k])))
                self.label[self.label == max(name, own)] = min(name, own)

    def add_pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs sorted by ``a``."""
        cut = np.flatnonzero(np.diff(a)) + 1
        for part_a, part_b in zip(np.split(a, cut), np.split(b, cut), strict=True):
            if len(part_a):
                self.add(int(part_a[0]), part_b)

    def frame(self, ids: np.ndarray) -> pd.DataFrame:
        made = np.array(self.links, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": ids[made[:, 0]], "b": ids[made[:, 1]]})


def _search(how: Graph, threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """(a, b): a spanning forest of the links that the shard's members find. Nodes from other shards bring no neighbours."""
        rows = rows.sort_values("id", ignore_index=True)
        ids, x = rows.id.to_numpy(np.int64), matrix(rows.vec)
        members = np.flatnonzero(rows.member.to_numpy(bool))
        if not len(members):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        lists = []
        for v in rows["next"]:
            v = np.asarray(v if v is not None else [], np.int64)
            at = np.minimum(np.searchsorted(ids, v), len(ids) - 1)
            lists.append(at[ids[at] == v])
        graph = Adjacency.of(lists)
        middle = centres_of(x[members], how.entries, 4)
        entries = np.unique(members[(x[members] @ middle.T).argmax(0)])
        forest = Forest(len(ids))
        for low in range(0, len(members), 256):
            queries = members[low : low + 256]
            a, b = search(x, graph, queries, entries, how.beam, threshold)
            forest.add_pairs(queries[a], b)
        return forest.frame(ids)

    return run


def _count(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """(id, n): weights of the members of the other block that each member links with; within a block, of the others."""
        bi, bj = rows.bi.iloc[0], rows.bj.iloc[0]
        left, right = rows[rows.block == bi], rows[rows.block == bj]
        close = matrix(left.vec) @ matrix(right.vec).T >= threshold
        if bi == bj:
            np.fill_diagonal(close, False)
            return pd.DataFrame({"id": left.id, "n": close @ right.n.to_numpy(np.int64)})
        return pd.DataFrame({"id": pd.concat([left.id, right.id]), "n": np.concatenate([close @ right.n.to_numpy(np.int64), close.T @ left.n.to_numpy(np.int64)])})

    return run


def _deal(reps: DataFrame, centres: dict[int, np.ndarray], overlap: int) -> DataFrame:
    """(shard, id, vec): each representative in the shards of its nearest centres; a length without centres is one shard."""
    sent = reps.sparkSession.sparkContext.broadcast(centres)  # at most Graph.centre_bytes, and what crowded shards added

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, vec = batch.column("dim").to_numpy(), batch.column("vec").to_pylist()
            row, shard = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for d in np.unique(dim):
                there = np.flatnonzero(dim == d)
                c = sent.value.get(int(d))
                if c is None:
                    row.append(there)
                    shard.append(np.full(len(there), int(d) << 32))
                    continue
                k = min(overlap, len(c))
                for part in np.array_split(there, -(-len(there) * len(c) // (1 << 23))):
                    cosine = matrix([vec[i] for i in part]) @ c.T
                    top = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
                    row.append(np.repeat(part, k))
                    shard.append((int(d) << 32) + top.ravel())
            r, s = np.concatenate(row), np.concatenate(shard)
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), batch.column("id").take(pa.array(r)), batch.column("vec").take(pa.array(r))], ["shard", "id", "vec"])

    return reps.select("id", "dim", "vec").mapInArrow(run, "shard long, id long, vec binary")


def _fit_centres(spark: SparkSession, members: DataFrame, sizes: DataFrame, how: Graph) -> dict[int, np.ndarray]:
    """Centres by length for the shards of ``sizes`` (shard, n, k), each fitted in a task on a bounded hash sample of its members."""
    picked = members.join(sizes, "shard").where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) < F.col("k") * how.sampled * F.lit(float(1 << 30)) / F.col("n"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", ignore_index=True)
        made = tree_centres(matrix(rows.vec), int(rows.k.iloc[0]))
        return pd.DataFrame({"shard": int(rows["shard"].iloc[0]), "centre": [c.tobytes() for c in made]})

    out: dict[int, list] = {}
    found = picked.select("shard", "k", "id", "vec").groupBy("shard").applyInPandas(run, "shard long, centre binary")
    for r in found.orderBy("shard", "centre").collect():  # centres: see Graph.centre_bytes
        out.setdefault(r["shard"] >> 32, []).append(bytes(r["centre"]))
    return {dim: matrix(c) for dim, c in out.items()}


def _rows_a_centre(reps: DataFrame, how: Graph) -> int:
    """shard_rows, or more where centres for so few rows would take more than ``centre_bytes``."""
    total = reps.agg(F.sum(F.octet_length("vec"))).first()[0] or 0
    return max(how.shard_rows, -(-total // how.centre_bytes))


def _dealt(spark: SparkSession, reps: DataFrame, how: Graph, overlap: int | None = None) -> tuple[DataFrame, int]:
    """(shard, id, vec) of the members of all shards, and the overlap, which is found from the centres where it is not given."""
    rows = _rows_a_centre(reps, how)
    whole = reps.select((F.col("dim").cast("long") * (1 << 32)).alias("shard"), "id", "vec")
    sizes = whole.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > rows).withColumn("k", F.ceil(F.col("n") / rows))
    centres = _fit_centres(spark, whole, sizes, how)
    overlap = overlap or how.overlap + _more_overlap(centres)
    before = None
    while True:
        members = materialise(spark, _deal(reps, centres, overlap), "members")
        hot = members.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > how.crowd * rows).withColumn("k", 2 * F.ceil(F.col("n") / rows))
        crowd = hot.agg(F.sum("n")).first()[0]
        # done when no shard is crowded, or where more centres hardly thin the crowds out
        if not crowd or before is not None and crowd > 0.9 * before:
            return members, overlap
        before = crowd
        for dim, more in _fit_centres(spark, members, materialise(spark, hot, "crowded"), how).items():
            centres[dim] = np.concatenate([centres[dim], more]) if dim in centres else more


def near_duplicate_vectors(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD, how: Graph | None = None) -> DataFrame:
    """(vec_id, n_links, component_id) of every row of ``vectors`` (vec_id, embedding)."""
    how = how or Graph()
    bounded_batches(spark)
    rows = materialise(spark, vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(_clean, "vec_id long, dim int, vec binary"), "vectors")
    usable = rows.where(F.col("vec").isNotNull())
    same = usable.groupBy("vec", "dim").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    reps = materialise(spark, same.select(F.monotonically_increasing_id().alias("id"), "dim", "vec", "least", "n"), "representatives")
    overlap = None
    while True:
        members, overlap = _dealt(spark, reps, how, overlap)
        counts, comp = _linked(spark, reps, _shard_links(spark, reps, members, threshold, how), threshold, how)
        if audit(spark, reps, counts, threshold, how.audit_queries, how.small) >= how.audit:
            break
        if overlap >= how.most_overlap:
            counts, comp = _linked(spark, reps, _all_links(reps, threshold, how), threshold, how)
            break
        overlap = min(2 * overlap, how.most_overlap)
    # components are of representatives' numbers; each is named by the least vec_id of its rows
    placed = reps.select("id", "least").join(comp.withColumnRenamed("node", "id"), "id")
    named = placed.join(placed.groupBy("component").agg(F.min("least").alias("name")), "component").select("id", "name")
    labelled = reps.join(named, "id", "left").join(counts, "id", "left")
    known = labelled.select("vec", "dim", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("name", "least").alias("component_id"))
    out = usable.join(known, ["vec", "dim"]).select("vec_id", "n_links", "component_id")
    return out.unionByName(rows.where(F.col("vec").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))


def _more_overlap(centres: dict[int, np.ndarray]) -> int:
    """One for each power of ten of centres, begun ones included: the more cells, the more borders a pair may lie across."""
    return max([len(str(len(c) - 1)) for c in centres.values() if len(c) > 1], default=0)


def _shard_links(spark: SparkSession, reps: DataFrame, members: DataFrame, threshold: float, how: Graph) -> DataFrame:
    """(a, b): spanning forests of the links that the shards find in the united graph."""
    lists = members.groupBy("shard").applyInPandas(_build(how, threshold), "id long, next array<long>, close array<long>")
    united = lists.groupBy("id").agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("next", "close")])
    united = materialise(spark, united, "adjacency")
    mine = members.select("shard", "id")
    beyond = mine.join(united.select("id", "close"), "id").select("shard", F.explode("close").alias("id")).distinct()
    beyond = beyond.join(mine, ["shard", "id"], "left_anti").join(reps.select("id", "vec"), "id")
    nodes = members.join(united.select("id", "next"), "id").select("shard", "id", "vec", "next", F.lit(True).alias("member"))
    nodes = nodes.unionByName(beyond.select("shard", "id", "vec", F.lit(None).cast("array<long>").alias("next"), F.lit(False).alias("member")))
    return nodes.groupBy("shard").applyInPandas(_search(how, threshold), "a long, b long")


def _forest(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """(a, b): a spanning forest of the links between two blocks, or within one."""
        bi, bj = rows.bi.iloc[0], rows.bj.iloc[0]
        left, right = rows[rows.block == bi], rows[rows.block == bj]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        a, b = np.nonzero(matrix(left.vec) @ matrix(right.vec).T >= threshold)
        ids = np.concatenate([left.id.to_numpy(np.int64), right.id.to_numpy(np.int64)])
        forest = Forest(len(ids))
        forest.add_pairs(a, b if bi == bj else b + len(left))
        return forest.frame(ids)

    return run


def _pairs(dealt: DataFrame) -> DataFrame:
    """Every row of ``dealt`` (block, blocks, ...) once for each pair of blocks (bi, bj) that its block is in."""
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("bi"), F.greatest(k, F.col("block")).alias("bj")))
    return dealt.select("*", F.explode(others).alias("pair")).select("*", "pair.bi", "pair.bj")


def _all_links(reps: DataFrame, threshold: float, how: Graph) -> DataFrame:
    """(a, b): spanning forests of the links of all pairs of blocks of a length; as many block pairs as the rows' square asks."""
    size = reps.groupBy("dim").agg(F.ceil(F.count("*") / (2 * how.block)).cast("int").alias("blocks"))
    dealt = reps.join(F.broadcast(size), "dim").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    return _pairs(dealt).select("dim", "bi", "bj", "block", "id", "vec").groupBy("dim", "bi", "bj").applyInPandas(_forest(threshold), "a long, b long")


def _linked(spark: SparkSession, reps: DataFrame, links: DataFrame, threshold: float, how: Graph) -> tuple[DataFrame, DataFrame]:
    """((id, links), (node, component)) of the representatives that link."""
    comp = materialise(spark, connected_components(spark, links), "components")
    placed = comp.select(F.col("node").alias("id"), "component").join(reps.select("id", "vec", "n"), "id")
    size = placed.groupBy("component").agg(F.ceil(F.count("*") / how.block).cast("int").alias("blocks"))
    dealt = placed.join(size, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    sides = _pairs(dealt).select("component", "bi", "bj", "block", "id", "vec", "n")
    counted = sides.groupBy("component", "bi", "bj").applyInPandas(_count(threshold), "id long, n long").groupBy("id").agg(F.sum("n").alias("links"))
    return materialise(spark, counted, "counts"), comp


def audit(spark: SparkSession, reps: DataFrame, counts: DataFrame, threshold: float, queries: int, small: int = 8) -> float:
    """Mean share of a query's links that were found, by brute force of a bounded sample of all representatives against all rows.

    The lesser of the means over all queries that have links and over those that have at most ``small``, so that neither
    a large group's links nor its members hide what small groups lose.
    """
    picked = reps.select("id").orderBy(F.xxhash64("id", F.lit(5))).limit(queries)
    sample = reps.join(F.broadcast(picked), "id").join(counts, "id", "left").select("id", "dim", "vec", F.coalesce("links", F.lit(0)).alias("links")).collect()
    if not sample:
        return 1.0
    sent = spark.sparkContext.broadcast([(r["id"], r["dim"], bytes(r["vec"])) for r in sample])  # ``queries`` vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            dim, ids, n = (batch.column(c).to_numpy() for c in ("dim", "id", "n"))
            vec = batch.column("vec").to_pylist()
            for d in np.unique(dim):
                mine = [k for k, q in enumerate(sent.value) if q[1] == d]
                for there in np.array_split(np.flatnonzero(dim == d), -(-len(dim) // 1000)) if mine else ():
                    if not len(there):
                        continue
                    close = matrix([sent.value[k][2] for k in mine]) @ matrix([vec[i] for i in there]).T >= threshold
                    close &= np.array([sent.value[k][0] for k in mine])[:, None] != ids[there][None, :]
                    total[mine] += close @ n[there]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "n"])

    got = {r["k"]: r["n"] for r in reps.select("id", "dim", "vec", "n").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()}
    shares = [(n, min(n, sample[k]["links"]) / n) for k, n in got.items() if n]
    return min((float(np.mean(s)) for s in ([f for _, f in shares], [f for n, f in shares if n <= small]) if s), default=1.0)
