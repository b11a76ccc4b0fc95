"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard, searched with a beam.

Nearness is the largest inner product. A shard has vectors of about the same length, no two further apart than
a factor of two. Within it each vector gets one more coordinate that makes all lengths equal, so that distance
between vectors orders them as the inner product with a query does.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaymark.llm import common

#: Vectors per shard, and bytes of their components as doubles; a task holds one shard with its graph at a time.
SHARD, SHARD_BYTES = 1 << 15, 128 << 20
#: Edges of a node, candidates that an insertion keeps, the relaxation of pruning.
DEGREE, BUILD_BEAM, RELAX = 32, 64, 1.2
#: Bytes of queries that are broadcast at a time, and queries that walk a graph in step.
QUERY_BYTES, IN_STEP = 64 << 20, 512


def beam_search(vectors: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int, edged: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, inner products) of the ``beam`` best nodes that each query's walk from ``entry`` saw, best first; -1 fills up.

    Each step expands every query's best node that isn't expanded yet, until there is none among its beam.
    """
    n, q = len(vectors), len(queries)
    seen = np.zeros((q, n + 1), dtype=bool)
    ids = np.full((q, beam), -1, dtype=np.int64)
    gain = np.full((q, beam), -np.inf, dtype=np.float32)
    todo = np.zeros((q, beam), dtype=bool)
    ids[:, 0], gain[:, 0], todo[:, 0] = entry, queries @ vectors[entry], True
    seen[:, entry] = True
    live = np.arange(q)
    while len(live):
        best = np.where(todo[live], gain[live], -np.inf).argmax(axis=1)
        todo[live, best] = False
        near = edges[ids[live, best]]
        new = ~seen[live[:, None], near] & (near >= 0)
        seen[live[:, None], near] = True
        found = np.where(new, np.einsum("qrd,qd->qr", vectors[near], queries[live], optimize=False), -np.inf).astype(np.float32)
        all_gain = np.concatenate([gain[live], found], axis=1)
        all_ids = np.concatenate([ids[live], np.where(new, near, -1)], axis=1)
        all_todo = np.concatenate([todo[live], new], axis=1)
        top = np.argpartition(-all_gain, beam - 1, axis=1)[:, :beam]
        gain[live] = np.take_along_axis(all_gain, top, axis=1)
        ids[live] = np.take_along_axis(all_ids, top, axis=1)
        todo[live] = np.take_along_axis(all_todo, top, axis=1)
        live = live[todo[live].any(axis=1)]
    order = np.argsort(-gain, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(gain, order, axis=1)


def robust_prune(vectors: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """For each node up to ``degree`` of its candidates (-1: none): the nearest, then again the nearest of those
    to which no chosen one is ``relax`` times nearer than the node is. -1 fills up."""
    base = vectors[np.maximum(candidates, 0)]
    own = ((base - vectors[nodes][:, None, :]) ** 2).sum(axis=2)
    # Only the first of equal candidates counts, and never the node itself.
    order = np.argsort(candidates, axis=1, kind="stable")
    by_id = np.take_along_axis(candidates, order, axis=1)
    again = np.zeros_like(candidates, dtype=bool)
    np.put_along_axis(again, order[:, 1:], by_id[:, 1:] == by_id[:, :-1], axis=1)
    open_ = (candidates >= 0) & ~again & (candidates != nodes[:, None])
    norms = (base**2).sum(axis=2)
    between = np.maximum(norms[:, :, None] + norms[:, None, :] - 2 * base @ base.transpose(0, 2, 1), 0)
    out = np.full((len(nodes), degree), -1, dtype=np.int64)
    rows = np.arange(len(nodes))
    for k in range(degree):
        left = np.where(open_, own, np.inf)
        pick = left.argmin(axis=1)
        some = np.isfinite(left[rows, pick])
        if not some.any():
            break
        out[some, k] = candidates[rows, pick][some]
        open_ &= ~((relax * relax * between[rows, pick] <= own) | ~some[:, None])
        open_[rows, pick] = False
    return out


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX, seed: int = 5) -> tuple[np.ndarray, int]:
    """(edges, entry) of a graph over distinct vectors. Nodes come in batches that double, each searched from the entry."""
    n = len(vectors)
    edges = np.full((n, degree), -1, dtype=np.int64)
    entry = int(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(seed).permutation(n)
    order = np.r_[entry, order[order != entry]]
    held = 1
    while held < n:
        batch = order[held : held + min(max(held, 16), IN_STEP)]
        near, _ = beam_search(vectors, edges, entry, vectors[batch], beam)
        if held < 64:  # the first nodes also see one another
            near = np.concatenate([near, np.broadcast_to(batch, (len(batch), len(batch)))], axis=1)
        edges[batch] = robust_prune(vectors, batch, near, degree, relax)
        # Edges back: those that don't fit are pruned together with what is there.
        source, target = np.repeat(batch, degree), edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, starts, counts = np.unique(target, return_index=True, return_counts=True)
        most = counts.max() if len(counts) else 0
        back = np.full((len(nodes), most), -1, dtype=np.int64)
        back[np.repeat(np.arange(len(nodes)), counts), np.arange(len(target)) - np.repeat(starts, counts)] = source
        for at in range(0, len(nodes), IN_STEP):
            some = nodes[at : at + IN_STEP]
            both = np.concatenate([edges[some], back[at : at + IN_STEP]], axis=1)
            room = (both >= 0).sum(axis=1)
            width = max(int(room.max()), degree)
            both = -np.sort(-both, axis=1)[:, :width]
            fits = room <= degree
            new = both[:, :degree].copy()
            if (~fits).any():
                new[~fits] = robust_prune(vectors, some[~fits], both[~fits], degree, relax)
            edges[some] = new
        held += len(batch)
    return _joined(vectors, edges, entry).astype(np.int32), entry


def _joined(vectors: np.ndarray, edges: np.ndarray, entry: int) -> np.ndarray:
    """``edges`` with a column more, through which all nodes can be reached from the entry: a node that can't is hung
    on the nearest of those that can and hold none yet."""
    n = len(vectors)
    edges = np.hstack([edges, np.full((n, 1), -1, dtype=edges.dtype)])
    reached = np.zeros(n, dtype=bool)

    def reach(node: int) -> None:
        reached[node], front = True, np.array([node])
        while len(front):
            near = np.unique(edges[front])
            front = near[(near >= 0) & ~reached[near]]
            reached[front] = True

    reach(entry)
    while not reached.all():
        lost = int(np.flatnonzero(~reached)[0])
        near, _ = beam_search(vectors, edges, entry, vectors[[lost]], 32)
        free = [x for x in near[0].tolist() if x >= 0 and edges[x, -1] < 0]
        host = free[0] if free else int(np.flatnonzero(reached & (edges[:, -1] < 0))[0])
        edges[host, -1] = lost
        reach(lost)
    return edges


@dataclass
class Shard:
    """Distinct vectors, the ids that have each, and their graph."""

    vectors: np.ndarray  # as given, float32 where that holds them exactly
    level: np.ndarray  # with the coordinate that makes lengths equal, float32
    ids: np.ndarray
    starts: np.ndarray
    edges: np.ndarray
    entry: int

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray, **how) -> Shard:
        distinct, which = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, which.ravel()))
        starts = np.r_[0, np.cumsum(np.bincount(which.ravel(), minlength=len(distinct)))]
        # Lengths are scaled by a power of two, which changes no order, so that squares stay in range.
        scaled = distinct / 2.0 ** np.frexp(np.abs(distinct).max())[1]
        squares = (scaled**2).sum(axis=1)
        level = np.hstack([scaled, np.sqrt(np.maximum(squares.max() - squares, 0))[:, None]]).astype(np.float32)
        narrow = distinct.astype(np.float32)
        kept = narrow if np.array_equal(narrow, distinct) else distinct
        return cls(kept, level, ids[order], starts, *build(level, **how))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of the query, vector's id, inner product) of the k best that each query's walk finds, its own id apart."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        scale = np.abs(queries).max(axis=1, keepdims=True)
        flat = np.hstack([queries / scale, np.zeros((len(queries), 1))]).astype(np.float32)
        beam = max(beam, k + 1)
        for at in range(0, len(queries), IN_STEP):
            if len(self.level) <= beam:  # all of them are seen
                near = np.broadcast_to(np.arange(len(self.level)), (len(flat[at : at + IN_STEP]), len(self.level)))
            else:
                near, _ = beam_search(self.level, self.edges, self.entry, flat[at : at + IN_STEP], beam)
            row, column = np.nonzero(near >= 0)
            node = near[row, column]
            score = np.einsum("ij,ij->i", self.vectors[node].astype(np.float64), queries[at + row])
            # Of each vector the k + 1 smallest ids are enough.
            sizes = np.minimum(self.starts[node + 1] - self.starts[node], k + 1)
            row, score = np.repeat(row, sizes), np.repeat(score, sizes)
            within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            ids = self.ids[np.repeat(self.starts[node], sizes) + within]
            other = ids != query_ids[at + row]
            row, score, ids = row[other], score[other], ids[other]
            order = np.lexsort((ids, -score, row))
            row, score, ids = row[order], score[order], ids[order]
            first = np.searchsorted(row, np.arange(len(near)))
            keep = np.arange(len(row)) - first[row] < k
            found.append((at + row[keep], ids[keep], score[keep]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(``id`` long, ``vector`` array<double>) of rows with an id and a vector with finite components that aren't all zero or null."""
    v = F.col(vector_col).cast("array<double>")
    infinite = F.lit(float("inf"))
    good = F.col(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)) & F.exists(v, lambda x: x != 0)
    return vectors.filter(F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("vector"))


def octave(vector: Column) -> Column:
    """The power of two that a vector's length is nearest to, by its logarithm; lengths of one octave are at most a factor of two apart."""
    size = F.transform(vector, F.abs)
    most = F.array_max(size)
    squares = F.aggregate(size, F.lit(0.0), lambda a, x: a + (x / most) * (x / most))
    return F.floor(F.log2(most) + F.log2(squares) / 2 + 0.5).cast("int")


def _lists(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(components end to end, number of each vector's)."""
    return lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD, **how) -> DataFrame:
    """(``dim``, ``graph`` binary): a staged table with a row for each shard.

    Vectors of a number of components and an octave of lengths are dealt evenly, by row and not by a key, over
    as many shards as hold ``shard`` rows (or SHARD_BYTES) each; equal vectors of a shard are one node. Every
    usable row is indexed, however many there are.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col).withColumn("dim", F.size("vector")).withColumn("octave", octave(F.col("vector")))
    rows = common.staged(rows.withColumn("at", F.monotonically_increasing_id()), "vectors")
    most = F.least(F.lit(shard), F.ceil(F.lit(SHARD_BYTES) / (8 * F.col("dim"))))
    sizes = common.staged(rows.groupBy("dim", "octave").agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / most)), "vector-octaves")
    shards = max(sizes.agg(F.sum("parts")).first()[0] or 1, 1)
    dealt = common.lookup(rows, sizes, ["dim", "octave"], "n", rows.count()).withColumn("part", F.pmod(F.xxhash64("at"), F.col("parts")))
    by = ["dim", "octave", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, parts = None, [], []

        def made() -> pa.RecordBatch:
            graph = Shard.of(np.concatenate(ids), np.concatenate(parts), **how)
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([pickle.dumps(graph, protocol=5)], pa.binary())], names=["dim", "graph"])

        for b in batches:
            if not b.num_rows:
                continue
            keys = np.column_stack([b.column(i).to_numpy() for i in range(3)])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if tuple(keys[x]) != key:
                    if key is not None:
                        yield made()
                    key, ids, parts = tuple(keys[x].tolist()), [], []
                flat, _ = _lists(b.column(4).slice(x, y - x))
                ids.append(b.column(3).slice(x, y - x).to_numpy())
                parts.append(flat.reshape(y - x, -1))
        if key is not None:
            yield made()

    placed = dealt.select(*by, "id", "vector").repartition(shards, *by).sortWithinPartitions(*by)
    with common.batches_of(spark, 4096):
        return common.staged(placed.mapInArrow(run, "dim int, graph binary"), "vector-graphs")


def search(index: DataFrame, queries: DataFrame, k: int = 20, beam: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", block: int = QUERY_BYTES) -> DataFrame:
    """(``query_id``, ``rank`` from 1, ``vec_id``, ``score``): of each query the k nearest found, ties to smaller ids.

    Queries go to the shards in blocks of ``block`` bytes; a shard answers with its k best, so that what meets
    for a query is k rows per shard, cut to k before the shuffle wherever several are in one task. A shard of no
    more than ``beam`` vectors is searched whole. Scores are inner products in double precision of the vectors
    as given. A query never finds its own id; it is compared with vectors of its own number of components only.
    Unusable vectors (null, zero, with null or non-finite components) and null ids take no part; a query that
    repeats gets its rows once for each; an empty table gives an empty result.
    """
    asked = usable(queries, id_col, vector_col)
    asked = common.staged(asked.withColumn("q", F.monotonically_increasing_id()), "queries")
    total = asked.agg(F.sum(F.size("vector") * 8 + 16)).first()[0] or 0
    spark, shards = index.sparkSession, max(1, index.count())
    blocks = max(1, -(-total // block))
    found = None
    for i in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == i).toArrow().sort_by("q")
        by_dim: dict[int, tuple] = {}
        if rows.num_rows:
            vectors = rows["vector"].combine_chunks()
            sizes = _lists(vectors)[1]
            for dim in np.unique(sizes).tolist():
                some = np.flatnonzero(sizes == dim)
                by_dim[dim] = (rows["q"].to_numpy()[some], rows["id"].to_numpy()[some], _lists(vectors.take(pa.array(some)))[0].reshape(len(some), dim))
        held = spark.sparkContext.broadcast(by_dim)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for dim, graph in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    if dim not in held.value:
                        continue
                    q, ids, vectors = held.value[dim]
                    row, near, score = pickle.loads(graph.as_buffer()).search(ids, vectors, k, beam)
                    for at in range(0, len(row), 1 << 16):
                        r = row[at : at + (1 << 16)]
                        yield pa.RecordBatch.from_arrays([pa.array(q[r]), pa.array(ids[r]), pa.array(near[at : at + (1 << 16)]), pa.array(score[at : at + (1 << 16)])], names=["q", "query_id", "vec_id", "score"])

        answers = index.repartition(shards).mapInArrow(run, "q long, query_id long, vec_id long, score double")
        best = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        answers = answers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        with common.batches_of(spark, 1):  # a shard is a row
            answers = common.staged(answers, "neighbours")
        found = answers if found is None else found.unionByName(answers)
    return found
