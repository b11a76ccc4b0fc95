"""BPE by a lexicon: frequent words in a minimal acyclic transducer that gives their ids, other words merged exactly.

The transducer shares suffixes as a minimal automaton does; a word's ids are found by its number, which
is the sum of what its transitions count. It is one file of integer arrays that workers map into memory.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymark.llm import common
from quaymark.llm.tokenizers_used import vocabulary_path

#: Words that the transducer holds; with WORD_CHARS it bounds what is collected and sent to the workers.
LEXICON_WORDS = 1 << 16
WORD_CHARS = 32
#: Other words that a worker remembers before it starts afresh.
REMEMBERED = 1 << 19
#: Characters in which neither NFC, nor case, nor classes of characters differ between libraries.
_PLAIN = re.compile("[\t\n\r -~¡-©«-±´¶-¸»¿-ÿŒœ‘-”–—…€]*")
#: The tokenizer's own split, for texts of plain characters in lower case.
_SPLIT = re.compile("[a-zß-öø-ÿœ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^ \t\n\r0-9a-zß-öø-ÿœ]+")


class Transducer:
    """Minimal acyclic automaton over words, numbering them in order; arrays ``keys`` (state, character), ``next``, ``skip``, ``base``."""

    NAMES = ("keys", "next", "skip", "final", "starts", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        for name in self.NAMES:
            setattr(self, name, arrays[name])

    @classmethod
    def build(cls, words: dict[str, list[int]]) -> Transducer:
        """Of words with their ids. Words in order are added; what a new word leaves behind is shared with its equal."""
        edges: list[dict[str, int]] = [{}]
        final = [False]
        register: dict[tuple, int] = {}
        path = [0]
        before = ""

        def settle(down_to: int) -> None:
            for depth in range(len(path) - 1, down_to, -1):
                state, parent = path[depth], path[depth - 1]
                shape = (final[state], tuple(edges[state].items()))
                edges[parent][before[depth - 1]] = register.setdefault(shape, state)
            del path[down_to + 1 :]

        for word in sorted(words):
            same = len(os.path.commonprefix((before, word)))
            settle(same)
            for c in word[same:]:
                edges.append({})
                final.append(False)
                edges[path[-1]][c] = len(edges) - 1
                path.append(len(edges) - 1)
            final[path[-1]] = True
            before = word
        settle(0)
        # Number the states that are left, children first, with the words below each.
        order: dict[int, int] = {}
        below: dict[int, int] = {}
        stack = [(0, False)]
        while stack:
            state, ready = stack.pop()
            if ready:
                order.setdefault(state, len(order))
                below[state] = final[state] + sum(below[t] for t in edges[state].values())
            elif state not in below:
                stack += [(state, True), *((t, False) for t in edges[state].values() if t not in below)]
        rank = {s: len(order) - 1 - i for s, i in order.items()}  # the root is 0
        rows = []
        for state in order:
            passed = int(final[state])
            for c, to in sorted(edges[state].items()):
                rows.append((rank[state] << 21 | ord(c), rank[to], passed))
                passed += below[to]
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
        ends = np.zeros(len(order), dtype=np.int64)
        ends[[rank[s] for s in order if final[s]]] = 1
        lists = [words[w] for w in sorted(words)]
        starts = np.cumsum([0, *map(len, lists)], dtype=np.int64)
        ids = np.array([i for one in lists for i in one], dtype=np.int64)
        return cls(dict(zip(cls.NAMES, (*(np.ascontiguousarray(table[:, i]) for i in range(3)), ends, starts, ids), strict=True)))

    def packed(self) -> bytes:
        """The content of the file that ``mapped`` maps."""
        sizes = np.array([len(self.arrays[n]) for n in self.NAMES], dtype="<i8")
        return b"".join([sizes.tobytes(), *(self.arrays[n].astype("<i8").tobytes() for n in self.NAMES)])

    @classmethod
    def mapped(cls, path: str) -> Transducer:
        """The file as it is, mapped into memory: pages are read when they are touched and shared by workers."""
        whole = np.memmap(path, dtype="<i8", mode="r")
        cuts = np.cumsum([len(cls.NAMES), *whole[: len(cls.NAMES)]])
        return cls({n: whole[a:b] for n, a, b in zip(cls.NAMES, cuts, cuts[1:], strict=False)})

    def numbers(self, words: list[str]) -> np.ndarray:
        """Each word's number, or -1; all words walk the automaton in step."""
        out = np.full(len(words), -1, dtype=np.int64)
        if not words or not len(self.keys):
            return out
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        live, state, number = np.arange(len(words)), np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        depth = 0
        while len(live):
            ended = sizes[live] == depth
            done = live[ended]
            out[done] = np.where(self.final[state[done]] == 1, number[done], -1)
            live = live[~ended]
            key = state[live] << 21 | letters[begins[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            live, at = live[found], at[found]
            number[live] += self.skip[at]
            state[live] = self.next[at]
            depth += 1
        return out

    def output(self, number: int) -> list[int]:
        return self.ids[self.starts[number] : self.starts[number + 1]].tolist()


class WordBpe:
    """The merges, ids and text rules of a word-end BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["dropout"] or model["byte_fallback"] or spec["decoder"] is not None:
            raise ValueError("not a word-end BPE file without a decoder")
        self.library = Tokenizer.from_file(path)
        self.end = model["end_of_word_suffix"]
        self.vocab = model["vocab"]
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.rank = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in special.items()}
        self.shown = {i: str(i) for i in self.tokens}
        self.special = special
        self.special_split = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        # Byte to the character that stands for it, as the byte-level rule deals them.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte_char = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in set(shown))}
        assert set(self.byte_char.values()) == set(ByteLevel.alphabet())
        self.known: dict[str, tuple[int, str, str]] = {}

    def words(self, text: str) -> list[str]:
        """The words of a text without special strings, as the byte-level rule writes them if not plain ASCII."""
        if _PLAIN.fullmatch(text):
            return _SPLIT.findall(text.lower())
        lib = self.library
        return ["\0" + w for w, _ in lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(text))]

    def merge(self, word: str) -> list[int]:
        """Ids of a word by its merges in order of rank."""
        chars = word[1:] if word[0] == "\0" else word if word.isascii() else "".join([self.byte_char[b] for b in word.encode()])
        parts = list(chars)
        parts[-1] += self.end
        if len(parts) > 64:
            parts = self._merge_long(parts)
        get, never, vocab = self.rank.get, len(self.rank), self.vocab
        ranks = [get(p, never) for p in zip(parts, parts[1:], strict=False)]
        while ranks and (low := min(ranks)) < never:
            at = ranks.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = get((parts[at - 1], parts[at]), never)
            if at < len(ranks):
                ranks[at] = get((parts[at], parts[at + 1]), never)
        return [vocab[p] for p in parts]

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same merges from a heap, for words of which the square of the length is too much."""
        n = len(parts)
        after, before, gone = [*range(1, n), -1], [-1, *range(n - 1)], [False] * n
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], gone[j], after[i] = a + b, True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := self.rank.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p, g in zip(parts, gone, strict=True) if not g]

    def entry(self, ids: list[int]) -> tuple[int, str, str]:
        shown, tokens = self.shown, self.tokens
        return len(ids), " ".join([shown[i] for i in ids]), " ".join([tokens[i] for i in ids])

    def learn(self, words: set[str], lexicon: Transducer) -> None:
        """Look new words up in the lexicon, merge those that it hasn't."""
        new = list(words)
        for word, number in zip(new, lexicon.numbers(new).tolist(), strict=True):
            self.known[word] = self.entry(lexicon.output(number) if number >= 0 else self.merge(word))

    def pieces(self, text: str) -> list[str]:
        """Words of a whole text in order; special strings as themselves, marked."""
        if "<|" not in text or not self.special:
            return self.words(text)
        out: list[str] = []
        for k, part in enumerate(self.special_split.split(text)):
            out += ["\0\0" + part] if k % 2 else self.words(part)
        return out

    def encode_all(self, texts: list[str], lexicon: Transducer) -> list[tuple[int, str, str]]:
        """(number of ids, ids joined by a space, decoded text) of each text; their new words are learned together."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        found = [self.pieces(t) for t in texts]
        need: set[str] = set()
        for words in found:
            need.update(words)
        need.difference_update(known.keys())
        marked = {w for w in need if w.startswith("\0\0")}
        known.update((w, self.entry([self.special[w[2:]]])) for w in marked)
        self.learn(need - marked, lexicon)
        out = []
        for words in found:
            if words:
                n, ids, decoded = zip(*map(known.__getitem__, words), strict=True)
                out.append((sum(n), " ".join(ids), " ".join(decoded)))
            else:
                out.append((0, "", ""))
        return out


@lru_cache(maxsize=2)
def word_bpe(name: str) -> WordBpe:
    """The tokenizer of a file, one in each worker."""
    return WordBpe(vocabulary_path(name))


@lru_cache(maxsize=2)
def _mapped_lexicon(name: str) -> Transducer:
    return Transducer.mapped(SparkFiles.get(name))


def word_counts(docs: DataFrame, text_col: str = "text", vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    """(``word``, ``n``) over all texts, of words up to WORD_CHARS characters; tasks send sums, not words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, found = word_bpe(vocabulary), Counter()

        def batch() -> pa.RecordBatch:
            held = [w for w in found if len(w) <= WORD_CHARS and not w.startswith("\0\0")]
            return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array([found[w] for w in held], pa.int64())], names=["word", "n"])

        for b in batches:
            for t in b.column(0):
                found.update(split.pieces(t.as_py() or ""))
                if len(found) > REMEMBERED:
                    yield batch()
                    found.clear()
        if found:
            yield batch()

    return docs.select(docs[text_col].cast("string")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(docs: DataFrame, text_col: str = "text", vocabulary: str = "word_bpe_49k.json", words: int = LEXICON_WORDS) -> str:
    """Build the transducer of the most frequent words of all texts; the name under which workers find its file."""
    frequent = [r["word"] for r in common.most_frequent(word_counts(docs, text_col, vocabulary), "n", words)]
    return ship(docs.sparkSession, Transducer.build({w: word_bpe(vocabulary).merge(w) for w in frequent}))


def ship(spark: SparkSession, lexicon: Transducer) -> str:
    """Write the file to the shared folder and have Spark copy it to each executor; its name there."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(common.shared_file(spark, name, lexicon.packed()))
    return name


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "word_bpe_49k.json", lexicon: str | None = None, whole: bool = True) -> DataFrame:
    """(id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``[, ``ids`` array<int>, ``decoded``]) of every whole text.

    Ids are those of the tokenizers library without added special tokens, ``decoded`` its decoding of them
    with special tokens kept. ``lexicon``: name of a file given to Spark, else compiled from ``docs`` itself;
    it changes the speed, never the ids. Null counts as empty and has no id. Rows that repeat give repeated
    rows, null ids stay, other columns aren't read, an empty table gives an empty result.
    """
    name = lexicon or compile_lexicon(docs, text_col, vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, held = word_bpe(vocabulary), _mapped_lexicon(name)
        for b in batches:
            for at in range(0, b.num_rows, 512):  # what goes out is as bounded as what came in
                part = b.slice(at, 512)
                coded = bpe.encode_all([t.as_py() or "" for t in part.column(1)], held)
                columns = {"n_tokens": pa.array([n for n, _, _ in coded], pa.int64())}
                for k, c in ((1, "ids_sha256"), (2, "decoded_sha256")):
                    columns[c] = pa.array([sha256(x[k].encode()).hexdigest() for x in coded], pa.string())
                if whole:
                    columns["ids"] = pa.array([[int(i) for i in x.split()] for _, x, _ in coded], pa.list_(pa.int32()))
                    columns["decoded"] = pa.array([x for _, _, x in coded], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *columns.values()], names=[id_col, *columns])

    more = ", ids array<int>, decoded string" if whole else ""
    return docs.select(docs[id_col], docs[text_col].cast("string")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
