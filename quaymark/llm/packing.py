"""Best-fit packing of token sequences, after Martello-Toth dominance has fixed what can be fixed.

Which pieces share a sequence depends only on how many pieces have which length, a table of at most
``size`` rows. The driver packs that table; pieces then find their place by their rank within a length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaymark.llm import common

#: (copies, lengths): so many sequences that hold pieces of these lengths, as (length, number) pairs.
Pattern = tuple[int, list[tuple[int, int]]]


class _Lengths:
    """How many pieces are left of each length, with the questions that dominance asks."""

    def __init__(self, counts: dict[int, int], size: int):
        self.n = [0] * (size + 1)
        for length, c in counts.items():
            self.n[length] += c
        self.size = size

    def below(self, most: int, without: int = 0) -> int:
        """The largest length left up to ``most`` (0: none); one piece of ``without`` doesn't count."""
        for x in range(min(most, self.size), 0, -1):
            if self.n[x] > (x == without):
                return x
        return 0

    def smallest(self, k: int, without: int) -> list[int]:
        out: list[int] = []
        for x in range(1, self.size + 1):
            out += [x] * min(self.n[x] - (x == without), k - len(out))
            if len(out) == k:
                break
        return out

    def best_pair(self, most: int, without: int) -> int:
        """The largest sum up to ``most`` of two pieces besides one of ``without``."""
        have = [x for x in range(1, most) if self.n[x] > (x == without)]
        twice = {x for x in have if self.n[x] - (x == without) > 1}
        best, i, j = 0, 0, len(have) - 1
        while i <= j:
            total = have[i] + have[j]
            if total > most:
                j -= 1
            else:
                if total > best and (i < j or have[i] in twice):
                    best = total
                i += 1
        return best


def reduce_dominated(counts: dict[int, int], size: int) -> tuple[list[Pattern], dict[int, int]]:
    """Sequences that some best packing has (Martello and Toth's reduction), and the counts that remain.

    For the longest pieces first: a piece that nothing fits beside is alone; one that fills a sequence with
    another is paired; one that at most one other fits beside takes the largest that fits; one that at most
    two fit beside takes the largest that fits, if that is no less than any pair. Each set dominates every
    other set with that piece. Runs until nothing more can be fixed.
    """
    left, fixed, changed = _Lengths(counts, size), [], True
    while changed:
        changed = False
        for x in range(size, 0, -1):
            while left.n[x]:
                room = size - x
                least = left.smallest(3, x)
                mate = left.below(room, x)
                if not mate:
                    take, pattern = left.n[x], [(x, 1)]
                else:
                    beside = sum(sum(least[: k + 1]) <= room for k in range(len(least)))
                    if not (mate == room or beside == 1 or beside == 2 and mate >= left.best_pair(room, x)):
                        break
                    take = left.n[x] // 2 if mate == x else min(left.n[x], left.n[mate])
                    pattern = [(x, 2)] if mate == x else [(x, 1), (mate, 1)]
                for length, k in pattern:
                    left.n[length] -= k * take
                fixed.append((take, pattern))
                changed = True
    return fixed, {x: c for x, c in enumerate(left.n) if c}


def best_fit(counts: dict[int, int], size: int) -> list[Pattern]:
    """Best-fit decreasing over counts: sequences alike are handled together, so work doesn't grow with pieces."""
    open_at: dict[int, list[Pattern]] = {}  # by room left
    for x in sorted(counts, reverse=True):
        c = counts[x]
        for room in sorted(r for r in open_at if r >= x):
            k = room // x
            kept: list[Pattern] = []
            for copies, held in open_at.pop(room):
                full = min(copies, c // k)
                if full:
                    open_at.setdefault(room - k * x, []).append((full, [*held, (x, k)]))
                    c -= full * k
                if copies > full and 0 < c < k:
                    open_at.setdefault(room - c * x, []).append((1, [*held, (x, c)]))
                    full, c = full + 1, 0
                if copies > full:
                    kept.append((copies - full, held))
            if kept:
                open_at.setdefault(room, []).extend(kept)
            if not c:
                break
        k = size // x
        if c // k:
            open_at.setdefault(size - k * x, []).append((c // k, [(x, k)]))
        if c % k:
            open_at.setdefault(size - c % k * x, []).append((1, [(x, c % k)]))
    return [p for _, group in sorted(open_at.items()) for p in group]


def plan(counts: dict[int, int], size: int) -> list[Pattern]:
    """Patterns that hold exactly ``counts`` pieces of each length from 1 to ``size``."""
    fixed, rest = reduce_dominated(counts, size)
    return fixed + best_fit(rest, size)


def slots(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces of that length in a sequence, offset of the first)."""
    out, used, sequence = [], {}, 0
    for copies, held in patterns:
        offset = 0
        for length, k in held:
            out.append((length, used.get(length, 0), sequence, k, offset))
            used[length] = used.get(length, 0) + k * copies
            offset += k * length
        sequence += copies
    table = np.array(out, dtype=np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def pieces(docs: DataFrame, encoder, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``[, ``ids``]) and, for ``place``, ``part``, ``nth``.

    encoder: called once in each worker, gives a function from text to a uint32 array. Each document ends
    with ``end_id``. Only documents of over ``size`` ids are cut, so that all pieces but the first are full.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, {'ids array<long>, ' if keep_ids else ''}part int, nth long"
    types = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.list_(pa.int64()), "part": pa.int32(), "nth": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder(), TaskContext.get().partitionId(), [0] * (size + 1)
        for b in batches:
            at, cols = [], {c: [] for c in types}
            for row, text in enumerate(b.column(1)):
                ids = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
                for piece, (start, stop) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    length = stop - start
                    at.append(row)
                    values = (piece, start, length, zlib.crc32(ids[start:stop].tobytes()), ids[start:stop] if keep_ids else None, part, seen[length])
                    for c, v in zip(types, values, strict=True):
                        cols[c].append(v)
                    seen[length] += 1
            names = [c for c in types if keep_ids or c != "ids"]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *(pa.array(cols[c], types[c]) for c in names)], names=[id_col, *names])

    return docs.select(docs[id_col], docs[text_col].cast("string")).mapInArrow(run, schema)


def place(cut: DataFrame, size: int = 2048) -> DataFrame:
    """``cut`` (of ``pieces``) with ``sequence_id`` and ``offset`` in place of ``part`` and ``nth``.

    The table of ranks has a row per task and length, which grows with the input: it is merged, not broadcast.
    """
    cut = common.staged(cut, "pack-pieces")  # fixes part and nth
    held = common.staged(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    totals = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    table = slots(plan(totals, size))
    before = held.withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    ranked = cut.join(before.select("part", "length", F.coalesce("before", F.lit(0)).alias("before")).hint("shuffle_merge"), ["part", "length"])
    out = [c for c in cut.columns if c not in ("part", "nth")]
    length_at = out.index("length")
    key = table[:, 0] << 48 | table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(length_at).to_numpy(), b.column(len(out)).to_numpy()
            slot = table[np.searchsorted(key, length << 48 | rank, side="right") - 1] if b.num_rows else table[:0]
            n = rank - slot[:, 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(slot[:, 2] + n // np.maximum(slot[:, 3], 1)), pa.array(slot[:, 4] + n % np.maximum(slot[:, 3], 1) * length)], names=[*out, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {cut.schema[c].dataType.simpleString()}" for c in out) + ", sequence_id long, offset long"
    return ranked.select(*out, (F.col("before") + F.col("nth")).alias("rank")).mapInArrow(run, schema)


def pack(docs: DataFrame, encoder, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Every document's ids in as few sequences of at most ``size`` as the method finds; one row per piece.

    Null and empty texts give one piece that holds ``end_id`` alone. Rows that repeat are packed each by
    itself; null ids are kept. Pieces of equal length are interchangeable: which goes where follows the
    order of partitions and rows. Other columns aren't read. An empty table gives an empty result.
    """
    return place(pieces(docs, encoder, size, end_id, id_col, text_col, keep_ids), size)
