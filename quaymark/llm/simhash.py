"""SimHash near-dedup: fingerprints, pigeonhole blocks, verified Hamming links, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymark.llm import common

#: Blocks that a fingerprint is split into. A pair that differs in up to d bits shares BLOCKS - d of them.
BLOCKS = 6
#: Fingerprints that one task compares with one another; larger buckets are dealt into cells.
CELL = 4096
#: Wide fingerprints: words that are compared, standard deviations that a pair may differ by more than it is expected to.
WORDS, SPREAD = 4, 4.5
#: Wide fingerprints: how many share a key by chance, the share of pairs at the similarity that share one.
SHARING, FOUND = 512, 0.9999


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned 64-bit SimHash: a bit is 1 if set in over half of the shingles' XXH64 (seed 42).

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing ``A-Z``; shingles are ``width`` words joined by a
    space, repeats included; fewer words make one shingle; no word (or null) gives 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        digest = xxhash.xxh64_intdigest
        starts = [0, *(ends[: len(words) - width] + 1).tolist()]
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)]
    of = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(of), 65536):
        ones += np.unpackbits(of[at : at + 65536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(of), bitorder="little").view("<u8")[0])


def blocks_for(rows: int, similarity: float) -> tuple[int, int, int]:
    """(blocks, bits of a block, distance) for wide fingerprints of so many sets, to be linked from that Jaccard similarity on.

    Sets of similarity s differ in a bit with a probability of up to t = arccos(2s / (1 + s)) / pi, so they share a
    block of k bits with (1 - t)^k: as many blocks as FOUND asks for, of bits that grow with the number of rows.
    The distance is over 64 * WORDS bits.
    """
    t = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    bits = max(0, math.ceil(math.log2(max(rows, 1) / SHARING)))
    alike = (1 - t) ** bits
    blocks = 1 if alike == 1 else math.ceil(math.log(1 - FOUND) / math.log(1 - alike))
    return blocks, bits, math.floor(64 * WORDS * t + SPREAD * math.sqrt(64 * WORDS * t * (1 - t)))


def words_for(blocks: int, bits: int) -> int:
    """Words of a wide fingerprint: those that are compared, then those that are split into blocks."""
    return WORDS + -(-blocks * bits // 64)


def wide_fingerprint(hashes: np.ndarray, words: int) -> np.ndarray:
    """SimHash of ``words`` words of 64 bits (uint64): of each hash as many are derived; a bit is 1 if set in over half of them."""
    ones = np.zeros(64 * words, dtype=np.int64)
    seeds = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(hashes), 255):  # so that a byte holds a count
        x = hashes[at : at + 255, None] + seeds
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        set_ = np.unpackbits(x.astype("<u8", copy=False).view(np.uint8), axis=1, bitorder="little")
        ones += np.add.reduce(set_, axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8").astype(np.uint64, copy=False)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(``id_col``, ``key``: the row's ``common.row_key``, ``fp`` long: the fingerprint's bits) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, width) for t in (x.as_py() for x in b.column(1))), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps.view(np.int64))], names=[id_col, "key", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], docs[text_col], common.row_key(id_col, text_col).alias("key")).mapInArrow(run, f"`{id_col}` {kind}, key string, fp long")


def _masks(distance: int, blocks: int) -> list[int]:
    """Bits of each choice of the blocks that a pair within the distance must share."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    bits = [sum(1 << k for k in range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
    return [reduce(int.__or__, some) for some in combinations(bits, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges (smaller, larger) that connect what links within ``distance`` connect, one less than members."""
    edges, left = [], np.sort(fps)
    while len(left):
        root, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count((left ^ queue.pop()).view(np.uint64)) <= distance
            if near.any():
                found, left = left[near], left[~near]
                edges += [(int(root), int(x)) for x in found]
                queue += list(found)
    return edges


def _cell_edges(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Edges within each run of rows of the same cell. Rows come sorted by cell; a cell is bounded, so is the memory."""
    held = None

    def edges(cells: np.ndarray, fps: np.ndarray) -> list[tuple[int, int]]:
        cuts = np.flatnonzero(np.any(cells[1:] != cells[:-1], axis=1)) + 1
        starts, sizes = np.r_[0, cuts], np.diff(np.r_[0, cuts, len(fps)])
        two = starts[sizes == 2]
        a, b = np.minimum(fps[two], fps[two + 1]), np.maximum(fps[two], fps[two + 1])
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= distance
        out = list(zip(a[near].tolist(), b[near].tolist(), strict=True))
        for at, n in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            out += _forest(fps[at : at + n], distance)
        return out

    def batch(out: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([e[i] for e in out], pa.int64()) for i in (0, 1)], names=["u", "v"])

    for b in batches:
        rows = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(5)])
        rows = rows if held is None else np.concatenate([held, rows])
        if not len(rows):
            continue
        last = np.flatnonzero(np.any(rows[:, :4] != rows[-1, :4], axis=1))
        cut = last[-1] + 1 if len(last) else 0
        held = rows[cut:]
        if cut:
            yield batch(edges(rows[:cut, :4], rows[:cut, 4]))
    if held is not None and len(held) > 1:
        yield batch(edges(held[:, :4], held[:, 4]))


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """Edges (``u``, ``v``; u < v) that connect all distinct ``fp`` within ``distance`` bits of each other.

    A pair within the distance shares all but ``distance`` of the blocks, so it meets under one of the
    choices of that many blocks. A bucket gives the edges of a spanning forest, not its pairs. Buckets of
    over CELL fingerprints are dealt into chunks, and each two chunks meet in a cell: no task gets more
    than two chunks and no pair goes unseen.
    """
    masks = _masks(distance, max(BLOCKS, distance + 1))
    keys = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])).alias("k")).select("k.choice", "k.key", "fp")
    keys = common.staged(keys, "simhash-keys")
    large = common.staged(keys.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL).withColumn("chunks", F.ceil(F.col("n") / (CELL // 2))), "simhash-large")
    none = F.lit(0).cast("long")
    n_large = large.count()
    if not n_large:
        cells = keys.select("choice", "key", none.alias("a"), none.alias("b"), "fp")
    else:
        # A broadcast of a size that was looked at; beyond it a shuffle.
        sized = keys.join(F.broadcast(large) if n_large <= 100_000 else large, ["choice", "key"], "left")
        small = sized.filter("chunks IS NULL").select("choice", "key", none.alias("a"), none.alias("b"), "fp")
        own = F.pmod(F.xxhash64("fp"), F.col("chunks"))
        dealt = sized.filter("chunks IS NOT NULL").withColumn("own", own).withColumn("other", F.explode(F.sequence(none, F.col("chunks") - 1)))
        cells = small.unionByName(dealt.select("choice", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp"))
    by = ["choice", "key", "a", "b"]
    placed = cells.repartition(*by).sortWithinPartitions(*by)
    return placed.mapInArrow(lambda batches: _cell_edges(batches, distance), "u long, v long").distinct()


def _runs(batches: Iterator[pa.RecordBatch], columns: int, of: int) -> Iterator[np.ndarray]:
    """Rows (long columns) of each run of rows with the same first ``of`` columns, as they come sorted."""
    held = None
    for b in batches:
        rows = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(columns)])
        rows = rows if held is None else np.concatenate([held, rows])
        if not len(rows):
            continue
        cuts = np.flatnonzero(np.any(rows[1:, :of] != rows[:-1, :of], axis=1)) + 1
        for x, y in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=False):
            yield rows[x:y]
        held = rows[cuts[-1] :] if len(cuts) else rows
    if held is not None and len(held):
        yield held


def _wide_forest(nodes: np.ndarray, sizes: np.ndarray, words: np.ndarray, distance: int, similarity: float) -> list[tuple[int, int]]:
    """Edges that connect what pairs within ``distance``, of sizes that may be that similar, connect; one less than members."""
    each, busy = np.ascontiguousarray(words.T), []
    for at in range(0, len(nodes), 256):  # most rows are near to no other
        apart = sum(np.bitwise_count(w[at : at + 256, None] ^ w).astype(np.uint16) for w in each)
        busy.append(np.count_nonzero(apart <= distance, axis=1) > 1)
    some = np.concatenate(busy)
    nodes, sizes, words = nodes[some], sizes[some], words[some]
    edges = []
    while len(nodes):
        queue, nodes, sizes, words = [(nodes[0], sizes[0], words[0])], nodes[1:], sizes[1:], words[1:]
        while queue and len(nodes):
            node, size, word = queue.pop()
            near = np.bitwise_count(words ^ word).sum(axis=1, dtype=np.int64) <= distance
            near &= np.minimum(sizes, size) >= similarity * np.maximum(sizes, size)
            if near.any():
                edges += [(int(node), int(x)) for x in nodes[near]]
                queue += list(zip(nodes[near], sizes[near], words[near], strict=True))
                nodes, sizes, words = nodes[~near], sizes[~near], words[~near]
    return edges


def wide_links(prints: DataFrame, blocks: int, bits: int, distance: int, similarity: float) -> DataFrame:
    """Edges (``u``, ``v``) that connect all wide fingerprints which share a block and differ in up to ``distance`` bits.

    prints: ``node`` (long, distinct), ``size`` of the set, ``words`` (array<long>, ``words_for`` them). Pairs of sizes
    that can't be ``similarity`` alike aren't linked. Buckets are treated as in ``links``.
    """

    def keyed(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        each = words_for(blocks, bits)
        for b in batches:
            n = b.num_rows
            words = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, each)
            flat = np.unpackbits(np.ascontiguousarray(words[:, WORDS:], dtype="<i8").view(np.uint8), axis=1, bitorder="little")[:, : blocks * bits]
            keys = flat.reshape(n, blocks, bits) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros((n, blocks), dtype=np.int64)
            keys = (keys + (np.arange(blocks, dtype=np.int64) << 40)).reshape(-1)
            if not whole:
                yield pa.RecordBatch.from_arrays([pa.array(keys)], names=["bucket"])
                continue
            columns = [keys, *(np.repeat(c, blocks) for c in (b.column(0).to_numpy(), b.column(1).to_numpy(), *words[:, :WORDS].T))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, 5 + WORDS, 3):
            if len(rows) > 1:
                found = _wide_forest(rows[:, 3], rows[:, 4], rows[:, 5:].view(np.uint64), distance, similarity)
                yield pa.RecordBatch.from_arrays([pa.array([f(e) for e in found], pa.int64()) for f in (min, max)], names=["u", "v"])

    names = ["bucket", "node", "size", *(f"w{i}" for i in range(WORDS))]
    given = prints.select("node", "size", "words")
    sizes = given.mapInArrow(lambda batches: keyed(batches, False), "bucket long").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    large = common.staged(sizes.filter(F.col("n") > CELL).select("bucket", F.ceil(F.col("n") / (CELL // 2)).alias("chunks")), "simhash-large")
    rows = given.mapInArrow(lambda batches: keyed(batches, True), ", ".join(f"{n} long" for n in names))
    none = F.lit(0).cast("long")
    n_large = large.count()
    if not n_large:
        cells = rows.select("bucket", none.alias("a"), none.alias("b"), *names[1:])
    else:
        # A broadcast of a size that was looked at; beyond it a shuffle.
        sized = rows.join(F.broadcast(large) if n_large <= 100_000 else large, "bucket", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1).cast("long")))
        own = F.pmod(F.xxhash64("node"), F.col("chunks"))
        dealt = sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(none, F.col("chunks") - 1)))
        cells = dealt.select("bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), *names[1:])
    by = ["bucket", "a", "b"]
    return cells.repartition(*by).sortWithinPartitions(*by, "node").mapInArrow(edges, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``: the smallest node reachable) of each node of the edges, by large-star and small-star.

    Alternates the two until nothing changes; a round halves what is left of long chains. A node with many
    neighbours is looked up, not gathered: see ``common.lookup``.
    """

    def hook(pairs: DataFrame, strict: bool) -> DataFrame:
        # Each neighbour of u gets the smallest of u's neighbourhood; strict: only those larger than u.
        total = pairs.count()
        least = common.staged(pairs.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("n")).withColumn("low", F.least("u", "low")), "star-low")
        near = common.lookup(pairs, least, ["u"], "n", total)
        if strict:
            return near.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v")
        own = least.filter("u <> low").select("u", F.col("low").alias("v"))
        return near.select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").unionByName(own)

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = common.staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = common.staged(hook(common.staged(both, "edges-both"), True).distinct(), "large-star")
        now = common.staged(hook(large, False).distinct(), "small-star")
        if (after := state(now)) == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3) -> DataFrame:
    """One row per input row: id, ``fp`` (long), ``component_id`` (smallest id reachable by links, its own
    included), ``key`` (``common.row_key``), ``first`` (whether it stays if one of each component does).

    Rows with fingerprints at ``distance`` or fewer differing bits are linked. Equal fingerprints count as
    one node from the start. Null texts have fingerprint 0 like texts without words, and are linked like any
    other. Null ids come after all others. Of rows with the same smallest id the smallest ``key`` is
    first; rows alike in both are first together. Other columns aren't read. An empty table gives an empty
    result.
    """
    prints = common.staged(fingerprints(docs, id_col, text_col, width), "simhash-prints")
    order = F.struct(F.col(id_col).isNull().alias("null"), F.col(id_col).alias("id"), F.col("key").alias("key"))
    distinct = common.staged(prints.groupBy("fp").agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("rows")), "simhash-distinct")
    reach = common.staged(components(links(distinct.select("fp"), distance)), "simhash-reach")
    rooted = distinct.join(reach, distinct["fp"] == reach["node"], "left").select("fp", "least", "rows", F.coalesce("root", "fp").alias("root"))
    rooted = common.staged(rooted, "simhash-rooted")
    sums = common.staged(rooted.groupBy("root").agg(F.min("least").alias("best"), F.count(F.lit(1)).alias("members")), "simhash-roots")
    named = common.lookup(rooted.select("fp", "rows", "root"), sums, ["root"], "members", rooted.count()).select("fp", "rows", "best")
    found = common.lookup(prints, common.staged(named, "simhash-named"), ["fp"], "rows", prints.count())
    return found.select(id_col, "fp", F.col("best.id").alias("component_id"), "key", (F.col("key") == F.col("best.key")).alias("first"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are first of their component, one of each."""
    return common.rows_kept(docs, near_duplicates(docs, id_col, text_col, width, distance).withColumnRenamed("first", "kept"), id_col, text_col)
