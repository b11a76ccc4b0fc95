"""Document quality by a linear-chain conditional random field that labels every line good or bad."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymark.llm import common

#: The bounded sample of labelled documents that the field is fitted on: documents, and lines of all of them together.
FIT_DOCS, FIT_LINES = 6000, 2_000_000
#: Lines whose features are made at once.
_BLOCK = 4096
#: Classes of bytes whose share of a line is a feature; what is in none of them counts as letters of other scripts.
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\v\f\r", b".,;:", b"!?", b"|<>{}[]=\\/_~^`", b"#$%&*@+", b"'\"()-")
_BY_CLASS = bytes(next((i for i, c in enumerate(_CLASSES) if b in c), len(_CLASSES)) for b in range(256))
_TAGS = [bytes([i]) for i in range(len(_CLASSES) + 1)]
#: Features of a line by itself; with its two neighbours' and a constant there are three times as many and one.
WIDTH = len(_TAGS) + 9


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights): a row of WIDTH features per line, and each line's length in bytes plus one."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    out = np.zeros((len(lines), WIDTH), dtype=np.float32)
    seen: set[bytes] = set()
    rows: list[list] = []
    for i, line in enumerate(lines):
        n = len(line)
        words = line.split()
        kinds = line.translate(_BY_CLASS)
        counts = [kinds.count(t) for t in _TAGS]
        k = len(words)
        ended = sum(map(bytes.isalpha, [w[-1:] for w in words])) if k else 0
        begin = line[:1]
        rows.append(
            [
                *[c / (n or 1) for c in counts],
                math.log1p(n) / 8, math.log1p(k) / 8, n / (k or 1) / 16, len(set(words)) / (k or 1), ended / (k or 1),
                line in seen, begin.isupper(), line[-1:] == b".", n == 0,
            ]
        )
        seen.add(line)
        if len(rows) == _BLOCK or i + 1 == len(lines):
            out[i + 1 - len(rows) : i + 1] = rows
            rows.clear()
    return out, np.fromiter((len(x) + 1 for x in lines), dtype=np.float64, count=len(lines))


def emissions(x: np.ndarray, sizes: list[int], weights: np.ndarray) -> np.ndarray:
    """Score of good against bad of each line of chains laid end to end, from its own features, those of the line
    before and of the line after (nothing at a chain's ends), and a constant."""
    own, before, after = x @ weights[:WIDTH], x @ weights[WIDTH : 2 * WIDTH], x @ weights[2 * WIDTH : -1]
    ends = np.cumsum(sizes)
    before[ends - 1], after[ends - np.array(sizes)] = 0, 0
    own[1:] += before[:-1]
    own[:-1] += after[1:]
    return own.astype(np.float64) + weights[-1]


def gradient(x: np.ndarray, sizes: list[int], miss: np.ndarray) -> np.ndarray:
    """Of the sum of ``miss`` times ``emissions``, by the weights."""
    ends = np.cumsum(sizes)
    ahead, back = np.r_[miss[1:], 0.0], np.r_[0.0, miss[:-1]]
    ahead[ends - 1], back[ends - np.array(sizes)] = 0, 0
    return np.concatenate([x.T @ miss, x.T @ ahead, x.T @ back, [miss.sum()]])


class Chains:
    """Chains of different lengths side by side, the longest first, so that step t has the first ``live[t]`` of them."""

    def __init__(self, sizes: list[int]):
        sizes_ = np.array(sizes, dtype=np.int64)
        self.order = np.argsort(-sizes_, kind="stable")
        self.starts = (np.cumsum(sizes_) - sizes_)[self.order]
        self.sizes = sizes_[self.order]
        self.live = np.searchsorted(-self.sizes, -np.arange(1, self.sizes[0] + 1), side="right") if len(sizes) else np.zeros(0, dtype=int)

    def marginals(self, u: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability of good per line, expected transitions 2x2 over all chains), by scaled forward-backward.

        u: score of good against bad of each line; trans: score of going from label to label.
        """
        # Odds in a form that can't overflow: the larger of both labels' weights is 1.
        emit = np.stack([np.exp(np.minimum(-u, 0)), np.exp(np.minimum(u, 0))], axis=1)
        step = np.exp(trans - trans.max())
        fore = np.empty((len(u), 2))
        back = np.ones((len(u), 2))
        alone = int(np.searchsorted(-self.live, -1))  # from here on only the longest chain is left
        for t, n in enumerate(self.live[:alone]):
            at = self.starts[:n] + t
            now = emit[at] * (fore[at - 1] @ step if t else 1.0)
            fore[at] = now / now.sum(axis=1, keepdims=True)
        pairs = np.zeros((2, 2))
        if alone < len(self.live):
            pairs += self._alone(alone, emit, step, fore, back)
        for t in range(min(alone, len(self.live)) - 2, -1, -1):
            n = self.live[t + 1]
            at = self.starts[:n] + t
            ahead = emit[at + 1] * back[at + 1]
            now = ahead @ step.T
            back[at] = now / now.sum(axis=1, keepdims=True)
            both = fore[at][:, :, None] * step * ahead[:, None, :]
            pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        both = fore * back
        return both[:, 1] / both.sum(axis=1), pairs

    def _alone(self, begin: int, emit: np.ndarray, step: np.ndarray, fore: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Steps ``begin`` on of the longest chain, number by number; the expected transitions into them."""
        first, last = int(self.starts[0]) + begin, int(self.starts[0] + self.sizes[0])
        (aa, ab), (ba, bb) = step.tolist()
        weights = emit[first:last].tolist()
        x, y = fore[first - 1].tolist() if begin else (0.0, 0.0)
        ahead: list[tuple[float, float]] = []
        for k, (a, b) in enumerate(weights):
            if k or begin:
                a, b = a * (x * aa + y * ba), b * (x * ab + y * bb)
            x, y = a / (a + b), b / (a + b)
            ahead.append((x, y))
        fore[first:last] = ahead
        x, y, behind = 1.0, 1.0, [(1.0, 1.0)]
        sums = [0.0] * 4
        for k in range(len(weights) - 1, -1 if begin else 0, -1):
            a, b = weights[k][0] * x, weights[k][1] * y
            u, v = ahead[k - 1] if k else fore[first - 1].tolist()
            p = (u * aa * a, u * ab * b, v * ba * a, v * bb * b)
            total = sum(p)
            sums = [s + q / total for s, q in zip(sums, p, strict=True)]
            x, y = aa * a + ab * b, ba * a + bb * b
            x, y = x / (x + y), y / (x + y)
            behind.append((x, y))
        behind.reverse()
        if begin:
            back[first - 1 : last] = behind
        else:
            back[first:last] = behind
        return np.array(sums).reshape(2, 2)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Field:
    """Fitted weights: features standardised by mean and scale, emission weights, transitions, calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    trans: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def line_quality(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per text: the probability of good and the weight of each line."""
        feats, weights = zip(*map(line_features, texts), strict=True) if texts else ((), ())
        if not texts:
            return [], []
        sizes = [len(x) for x in feats]
        x = np.concatenate(feats)
        x -= self.mean
        x /= self.scale
        good, _ = Chains(sizes).marginals(emissions(x, sizes, self.weights), self.trans)
        return np.split(good, np.cumsum(sizes)[:-1]), list(weights)

    def raw(self, texts: list[str]) -> np.ndarray:
        """Mean of the lines' marginals, weighted by length."""
        good, weights = self.line_quality(texts)
        return np.array([float((g * w).sum() / w.sum()) for g, w in zip(good, weights, strict=True)])

    def score(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(self.slope * _logit(self.raw(texts)) + self.shift) if texts else np.zeros(0)


def fit(feats: list[np.ndarray], weights: list[np.ndarray], labels: list[int], steps: int = 200, decay: float = 1e-3, rate: float = 0.05) -> Field:
    """Maximise the likelihood of chains whose lines all have the document's label, then calibrate by document."""
    width = 3 * WIDTH + 1
    if not feats or len(set(labels)) < 2:  # nothing to tell apart: the share of good ones
        p = (sum(labels) + 1) / (len(labels) + 2)
        return Field(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(width), np.zeros((2, 2)), 1.0, float(_logit(p)))
    x = np.concatenate(feats)
    mean, scale = x.mean(axis=0, dtype=np.float64).astype(np.float32), (x.std(axis=0, dtype=np.float64) + 1e-3).astype(np.float32)
    x = (x - mean) / scale
    sizes = [len(f) for f in feats]
    y = np.repeat(np.array(labels, dtype=np.float64), sizes)
    chains = Chains(sizes)
    seen = np.zeros((2, 2))
    for n, label in zip(sizes, labels, strict=True):
        seen[label, label] += n - 1
    w, trans, total = np.zeros(width), np.zeros((2, 2)), len(y)
    m = [np.zeros_like(w), np.zeros_like(trans)]
    v = [np.zeros_like(w), np.zeros_like(trans)]
    for t in range(1, steps + 1):
        good, pairs = chains.marginals(emissions(x, sizes, w), trans)
        grads = [gradient(x, sizes, good - y) / total + decay * w, (pairs - seen) / total + decay * trans]
        for p, g, a, b in zip((w, trans), grads, m, v, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-8)
    good, _ = chains.marginals(emissions(x, sizes, w), trans)
    held = np.array([(g * k).sum() / k.sum() for g, k in zip(np.split(good, np.cumsum(sizes)[:-1]), weights, strict=True)])
    z, target, slope, shift = _logit(held), np.array(labels, dtype=np.float64), 1.0, 0.0
    for _ in range(50):  # Newton's steps of a logistic regression on one number
        p = _sigmoid(slope * z + shift)
        r = p * (1 - p) + 1e-6
        a = np.array([[(r * z * z).sum() + 1.0, (r * z).sum()], [(r * z).sum(), r.sum() + 1.0]])
        d = np.linalg.solve(a, [((p - target) * z).sum() + slope - 1.0, (p - target).sum() + shift])
        slope, shift = slope - float(d[0]), shift - float(d[1])
        if abs(d).max() < 1e-6:
            break
    return Field(mean, scale, w, trans, slope, shift)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_docs: int = FIT_DOCS) -> Field:
    """Fit on ``fit_docs`` labelled documents, the first by a hash of their id, whole, however long they are.

    ``labels`` has the rows to learn from. The sample's bounds are ``fit_docs`` and FIT_LINES lines of all its
    documents together (one that doesn't fit beside those before it is left out): ids come from a bounded list
    that is broadcast, and only the chosen documents' lines are turned into features, of which no more than
    FIT_LINES rows reach the driver. Ids or labels that are null are left out; an id that repeats with another
    text counts again, one that repeats with the same text doesn't. Without both labels the field gives the
    share of good ones.
    """
    some = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(fit_docs)
    )
    some = some.select(F.col(id_col).alias("id"), "label")
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = named.join(F.broadcast(some), "id").withColumn("sha", F.sha2("text", 256))
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = keyed.select("id", "sha").distinct().orderBy(order, "id", "sha").limit(fit_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                x, w = line_features(b.column(0)[at].as_py())
                part = b.slice(at, 1)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), part.column(3), pa.array([len(x)], pa.int64()), pa.array([x.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary())], names=["at", "sha", "label", "lines", "x", "w"])

    made = keyed.join(F.broadcast(chosen), ["id", "sha"]).select("text", order.alias("at"), "sha", "label").mapInArrow(run, "at long, sha string, label int, lines long, x binary, w binary")
    made = common.staged(made.groupBy("at", "sha").agg(*[F.first(c).alias(c) for c in ("label", "lines", "x", "w")]), "quality-fit")
    room, keep = FIT_LINES, set()
    for r in sorted(made.select("at", "sha", "lines").collect()):
        if r["lines"] <= room:
            room -= r["lines"]
            keep.add((r["at"], r["sha"]))
    rows = sorted((r for r in made.filter(F.col("lines") <= FIT_LINES).toLocalIterator() if (r["at"], r["sha"]) in keep), key=lambda r: (r["at"], r["sha"]))
    feats = [np.frombuffer(r["x"], dtype=np.float32).reshape(-1, WIDTH) for r in rows]
    return fit(feats, [np.frombuffer(r["w"], dtype=np.float64) for r in rows], [r["label"] for r in rows])


def score(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: the id) and ``score``, 0 to 1, of every whole text.

    Null counts as empty, an empty text is one empty line; rows that repeat get the same score, an empty
    table gives an empty result. Kept columns may have any name but ``score``.
    """
    keep = [id_col] if keep is None else keep
    if "score" in {c.lower() for c in keep}:
        raise ValueError("column score would appear twice")
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(field.score([t.as_py() or "" for t in part.columns[-1]]), pa.float64())], names=[*keep, "score"])

    return docs.select(*[docs[c] for c in keep], docs[text_col].alias("__text")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, field: Field, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, whose text the field scores ``least`` or more; columns may have any names."""
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                good = field.score([t.as_py() or "" for t in part.columns[-1]]) >= least
                yield pa.RecordBatch.from_arrays([part.column(0)], names=["row"]).filter(pa.array(good, pa.bool_()))

    row = F.struct(*columns)
    kept = docs.select(row.alias("row"), F.col(text_col).cast("string")).mapInArrow(run, T.StructType([T.StructField("row", docs.schema, False)]))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def line_labels(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``line`` from 0, ``good``: probability, ``n_bytes``) of every line, as the field labels it."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good, weights = field.line_quality([t.as_py() or "" for t in b.column(1)])
            sizes = [len(g) for g in good]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int64())),
                    pa.array([i for n in sizes for i in range(n)], pa.int32()),
                    pa.array(np.concatenate(good) if good else [], pa.float64()),
                    pa.array((np.concatenate(weights) - 1).astype(np.int64) if weights else [], pa.int64()),
                ],
                names=[id_col, "line", "good", "n_bytes"],
            )

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(run, f"`{id_col}` {kind}, line int, good double, n_bytes long")
