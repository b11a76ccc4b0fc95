"""Near copies by the Jaccard similarity of word-shingle sets: SimHash links for candidates, exact verification, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymark.llm import common, simhash

#: Sets that are compared in one cell, and of all together the shingles; larger groups are dealt into several cells.
CELL, CELL_SHINGLES = 1024, 1 << 22
#: A cell has that share of all sets to compare, so that no task stands out, but so many sets where there are few.
CELL_SHARE, CELL_LEAST = 256, 128


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct XXH64 (seed 42) of the text's shingles, words and shingles as ``simhash.fingerprint`` has them; no word: none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    digest = xxhash.xxh64_intdigest
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    return np.unique(np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], dtype=np.uint64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets as ``shingles`` gives them; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, words: int) -> DataFrame:
    """(``id``, ``key``: the row's ``common.row_key``, ``node`` long: a hash of its set, ``size`` of the set, ``words``: its wide fingerprint) of each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t.as_py(), width) for t in b.column(1)]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes(), 7) for s in sets], dtype=np.uint64).view(np.int64)
            prints = np.array([simhash.wide_fingerprint(s, words) for s in sets], dtype=np.uint64).reshape(-1).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(range(0, len(prints) + 1, words), pa.int32()), pa.array(prints))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(node), pa.array([len(s) for s in sets], pa.int64()), lists], names=["id", "key", "node", "size", "words"])

    return docs.select(docs[id_col], docs[text_col].cast("string"), common.row_key(id_col, text_col)).mapInArrow(run, f"id {kind}, key string, node long, size long, words array<long>")


def forest(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Edges that connect what pairs of at least that Jaccard similarity connect, one less than members.

    Sets as ``shingles`` gives them. What a set has in common with all others is counted from the places of its shingles.
    """
    n, sizes = len(sets), np.array([len(s) for s in sets], dtype=np.int64)
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owners = np.repeat(np.arange(n), sizes)[np.argsort(inverse, kind="stable")]
    starts, ends = np.cumsum(counts) - counts, np.cumsum(sizes)
    left, edges = np.ones(n, dtype=bool), []
    for first in range(n):
        queue = [first] if left[first] else []
        left[first] = False
        while queue and left.any():
            u = queue.pop()
            held = inverse[ends[u] - sizes[u] : ends[u]]
            held = held[counts[held] > 1]
            each = counts[held]
            places = np.repeat(starts[held] - np.cumsum(each) + each, each) + np.arange(each.sum())
            both = np.bincount(owners[places], minlength=n)
            near = np.flatnonzero(left & (both / np.maximum(sizes[u] + sizes - both, 1) >= similarity))
            left[near] = False
            edges += [(u, int(v)) for v in near]
            queue += near.tolist()
    return edges


def _cell_edges(batches: Iterator[pa.RecordBatch], width: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Edges within each run of rows (group, a, b, node, text) of the same cell. Rows come sorted by cell; a cell is bounded, so is the memory."""

    def edges(nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        found = [(nodes[i], nodes[j]) for i, j in forest(sets, similarity)] if len(sets) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([f(e) for e in found], pa.int64()) for f in (min, max)], names=["u", "v"])

    cell, nodes, sets = None, [], []
    for b in batches:
        for *at, node, text in zip(*(b.column(i).to_pylist() for i in range(4)), b.column(4), strict=True):
            if at != cell:
                if nodes:
                    yield edges(nodes, sets)
                cell, nodes, sets = at, [], []
            nodes.append(node)
            sets.append(shingles(text.as_py(), width))
    if nodes:
        yield edges(nodes, sets)


def edges(members: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Edges (``u``, ``v``) that connect all members of a group connected by pairs of at least that similarity, by exact comparison.

    members: ``node``, ``size``, ``key``, ``group``; texts: ``key``, ``text``. A cell gives the edges of a spanning
    forest, not its pairs. Larger groups are dealt into chunks, and each two chunks meet in a cell.
    """
    total = members.count()
    cell = min(CELL, max(CELL_LEAST, total // CELL_SHARE))
    chunks = F.greatest(F.ceil(F.col("members") / (cell // 2)), F.ceil(F.col("shingles") / (CELL_SHINGLES // 2)))
    chunks = F.when((F.col("members") <= cell) & (F.col("shingles") <= CELL_SHINGLES), F.lit(1).cast("long")).otherwise(chunks)
    groups = members.groupBy("group").agg(F.count(F.lit(1)).alias("members"), F.sum("size").alias("shingles"))
    groups = common.staged(groups.select("group", "members", chunks.alias("chunks")), "jaccard-groups")
    sized = common.lookup(members.select("group", "node", "key"), groups, ["group"], "members", total)
    sized = common.staged(sized.select("group", "node", "key", "chunks", F.xxhash64("key").alias("hash")), "jaccard-sized")
    # Only texts of members are shuffled, each of them once here.
    some = common.Bitmap(sized.select("hash").distinct()).mark(texts.withColumn("hash", F.xxhash64("key")), "hash", "hit").filter("hit").select("key", "text")
    held = common.staged(some.join(sized, "key").dropDuplicates(["node"]), "jaccard-texts")
    none, own = F.lit(0).cast("long"), F.pmod(F.xxhash64("node"), F.col("chunks"))
    dealt = held.withColumn("own", own).withColumn("other", F.explode(F.sequence(none, F.col("chunks") - 1)))
    by = ["group", "a", "b"]
    cells = dealt.select("group", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "node", "text")
    with common.batches_of(members.sparkSession, 256):
        placed = cells.repartition(*by).sortWithinPartitions(*by, "node")
        return common.staged(placed.mapInArrow(lambda batches: _cell_edges(batches, width, similarity), "u long, v long").distinct(), "jaccard-edges")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row per input row: id, ``component_id``, ``key``, ``first``, as ``simhash.near_duplicates`` has them.

    Rows whose sets of shingles have at least that Jaccard similarity are linked if links of the sets' wide SimHash
    connect them (see ``simhash.blocks_for``), and no others: what those links connect is a group, within which sets
    are compared exactly. Rows with equal sets are one node; null texts and those without words have the empty set.
    """
    blocks, bits, distance = simhash.blocks_for(docs.count(), similarity)
    made = common.staged(sketches(docs, id_col, text_col, width, simhash.words_for(blocks, bits)), "jaccard-sketches")
    order = F.struct(F.col("id").isNull().alias("null"), F.col("id").alias("id"), F.col("key").alias("key"))
    nodes = made.groupBy("node").agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("rows"), F.first("size").alias("size"), F.first("words").alias("words"))
    nodes = common.staged(nodes, "jaccard-nodes")
    groups = common.staged(simhash.components(simhash.wide_links(nodes, blocks, bits, distance, similarity)), "jaccard-linked")
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    members = common.staged(nodes.join(groups, "node").select("node", "size", F.col("least.key").alias("key"), F.col("root").alias("group")), "jaccard-members")
    texts = docs.select(common.row_key(id_col, text_col).alias("key"), docs[text_col].cast("string").alias("text"))
    reach = common.staged(simhash.components(edges(members, texts, width, similarity)), "jaccard-reach")
    rooted = nodes.join(reach, "node", "left").select("node", "least", "rows", F.coalesce("root", "node").alias("root"))
    rooted = common.staged(rooted, "jaccard-rooted")
    sums = common.staged(rooted.groupBy("root").agg(F.min("least").alias("best"), F.count(F.lit(1)).alias("members")), "jaccard-roots")
    named = common.lookup(rooted.select("node", "rows", "root"), sums, ["root"], "members", rooted.count()).select("node", "rows", "best")
    found = common.lookup(made.select("id", "key", "node"), common.staged(named, "jaccard-named"), ["node"], "rows", made.count())
    return found.select(F.col("id").alias(id_col), F.col("best.id").alias("component_id"), "key", (F.col("key") == F.col("best.key")).alias("first"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are first of their component, one of each."""
    return common.rows_kept(docs, near_duplicates(docs, id_col, text_col, width, similarity).withColumnRenamed("first", "kept"), id_col, text_col)
