"""Exact token counts at every prefix, by dynamic programming, for piece vocabularies merged by score.

The last token of a prefix is the one token that ends there and may follow the last token of the prefix
before it; so each prefix's count is one more than that of a shorter prefix. Which two tokens may follow
each other is a property of the pair: they may if the pair's own text is encoded as just these two.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quaymark.llm.tokenizers_used import vocabulary_path

#: What stands for a space in pieces.
SPACE = "▁"
#: A chunk that no piece reaches over: spaces and what follows up to the next space, or a line end.
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
#: Chunks and pairs that a worker remembers before it starts afresh.
REMEMBERED = 1 << 20


class PieceModel:
    """A sentencepiece BPE vocabulary with byte fallback and no normalisation beyond escaped spaces."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, trained = model.normalizer_spec, model.trainer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or trained.model_type != 2 or not trained.byte_fallback or trained.treat_whitespace_as_suffix:
            raise ValueError("not a plain BPE model with byte fallback")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        kinds = pb.ModelProto.SentencePiece
        if any(p.type == kinds.USER_DEFINED for p in model.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.score):
            raise ValueError("a piece goes on after a space or line end")
        self.longest = max(map(len, self.score))
        self.chars = {p for p in self.score if len(p) == 1}
        self.counts: dict[str, int] = {}
        self.follows: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """The pieces of a text by merging the best-scored pair again and again, leftmost first."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i, pair in enumerate(zip(parts, parts[1:], strict=False)):
                s = score.get(pair[0] + pair[1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, last: str, piece: str) -> bool:
        """Whether ``piece`` after ``last`` (empty: at the beginning) can stand in an encoding."""
        known = self.follows.get((last, piece))
        if known is None:
            known = self.merge(last + piece) == ([last, piece] if last else [piece])
            if len(self.follows) > REMEMBERED:
                self.follows.clear()
            self.follows[last, piece] = known
        return known

    def extend(self, chunk: str, last: list[str], count: list[int]) -> None:
        """Carry ``last`` piece and ``count`` of each prefix of ``chunk`` on to its end."""
        score, follows = self.score, self.follows
        for end in range(len(count), len(chunk) + 1):
            if chunk[end - 1] not in self.chars:
                count.append(count[-1] + len(chunk[end - 1].encode("utf-8", "surrogatepass")))
                last.append("")
                continue
            for start in range(max(0, end - self.longest), end):
                piece = chunk[start:end]
                if piece in score:
                    before = last[start]
                    known = follows.get((before, piece))
                    if known or known is None and self.may_follow(before, piece):
                        last.append(piece)
                        count.append(count[start] + 1)
                        break
            else:
                raise AssertionError(f"no piece ends {chunk[:end]!r}")

    def prefixes(self, chunk: str) -> list[int]:
        """Count at each prefix of a chunk, from the empty one."""
        last, count = [""], [0]
        self.extend(chunk, last, count)
        return count

    def learn(self, chunks: set[str]) -> None:
        """Whole counts of chunks; of neighbours in order, what their beginnings share is done once."""
        if len(self.counts) > REMEMBERED:
            self.counts.clear()
        last, count, before = [""], [0], ""
        for chunk in sorted(chunks):
            same = len(os.path.commonprefix((before, chunk))) + 1
            del last[same:], count[same:]
            self.extend(chunk, last, count)
            self.counts[chunk] = count[-1]
            before = chunk

    def chunks(self, text: str) -> list[str]:
        return _CHUNK.findall(self.prefix + text.replace(" ", SPACE)) if text else []

    def count_all(self, texts: list[str]) -> list[int]:
        """Token counts of whole texts."""
        out = []
        for text in texts:
            found = self.chunks(text)
            try:
                out.append(sum(map(self.counts.__getitem__, found)))
            except KeyError:
                self.learn({c for c in found if c not in self.counts})
                known = self.counts
                out.append(sum(known[c] if c in known else self.prefixes(c)[-1] for c in found))
        return out

    def table(self, text: str) -> np.ndarray:
        """Tokens of ``text[:i]`` at place i, for i from 0 to its length."""
        out, done = [0], 0
        for chunk in self.chunks(text):
            out += [done + c for c in self.prefixes(chunk)[1:]]
            done = out[-1]
        # The leading space that the model adds is no prefix of its own; without text there is nothing to encode.
        table = np.array(out[len(self.prefix) :] if text else out, dtype=np.int64)
        table[0] = 0
        return table


@lru_cache(maxsize=2)
def piece_model(name: str) -> PieceModel:
    """The model of a file, one in each worker."""
    return PieceModel(vocabulary_path(name))


def _mapped(docs: DataFrame, id_col: str, text_col: str, schema: str, columns) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arrays = columns([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays.values()], names=[id_col, *arrays])

    return docs.select(docs[id_col], docs[text_col].cast("string")).mapInArrow(run, f"`{id_col}` {kind}, {schema}")


def token_counts(docs: DataFrame, limit: int, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``n_bytes``, ``n_tokens``, ``over_limit``) of every whole text.

    Null counts as empty and has no token. Rows that repeat give repeated rows, null ids stay, other columns
    aren't read, an empty table gives an empty result. A worker's memory is bounded by its batch and by
    REMEMBERED chunks.
    """

    def columns(texts: list[str]) -> dict:
        n = piece_model(model).count_all(texts)
        return {"n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()), "n_tokens": pa.array(n, pa.int64()), "over_limit": pa.array([x > limit for x in n], pa.bool_())}

    return _mapped(docs, id_col, text_col, "n_bytes long, n_tokens long, over_limit boolean", columns)


def prefix_tables(docs: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``counts`` array<int>): tokens of the first i characters at place i, from 0. Null counts as empty."""
    return _mapped(docs, id_col, text_col, "counts array<int>", lambda texts: {"counts": pa.array([piece_model(model).table(t).astype(np.int32) for t in texts], pa.list_(pa.int32()))})


def truncate(docs: DataFrame, budget: int, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``n_chars``, ``n_tokens``, ``text``): the longest prefix of at most ``budget`` tokens. Null counts as empty.

    A longer prefix can have fewer tokens, so it is the last place within the budget that counts.
    """

    def columns(texts: list[str]) -> dict:
        tables = [piece_model(model).table(t) for t in texts]
        ends = [int(np.flatnonzero(t <= max(budget, 0))[-1]) for t in tables]
        return {"n_chars": pa.array(ends, pa.int64()), "n_tokens": pa.array([int(t[e]) for t, e in zip(tables, ends, strict=True)], pa.int64()), "text": pa.array([t[:e] for t, e in zip(texts, ends, strict=True)], pa.string())}

    return _mapped(docs, id_col, text_col, "n_chars long, n_tokens long, text string", columns)
