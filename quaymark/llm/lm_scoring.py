"""Language-model scores of whole texts by online logistic context mixing, learned from the corpus itself.

A text is a stream of tokens: its words (``[^\\x20\\x09-\\x0D]+``, ``A-Z`` lower-cased), then an end. Frequent
words, the end and an escape are symbols of one code; the bytes of a word after an escape are symbols of
another. Contexts of a symbol: the topic that the text has shown so far, the last word, the last two words.
Contexts of a byte: the topic, with it the last two and three bytes of the word, the last five. A passage that
training texts have shown after the same symbols is predicted as a whole, as one more bit.

Everything is gathered from all training texts: counts of all words, topics, counts of all bits in their
contexts, weights and maps, continuations. Counts of words and continuations are tables that grow with the
corpus; the hashed tables grow with it up to a bound.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quaymark.llm import common
from quaymark.llm.context_mixing import Code, Mixer, Predictors, Topics, mixed

#: Words with a symbol of their own, their longest size in bytes.
LEXICON, LEXICON_BYTES = 1 << 16, 64
#: Slots of a hashed table, as powers of two: four a training symbol (or byte) between these.
SLOT_BITS = (16, 22)
#: Topics, frequent words that tell them, passes over the corpus in which they are found.
TOPICS, TOPIC_WORDS, TOPIC_ROUNDS = 8, 1024, 6
#: Symbols, and words to spell, that one task learns: its tables, of a bounded size, pay for themselves.
TASK_SYMBOLS, TASK_WORDS = 1 << 23, 1 << 19
#: Bytes of texts that are laid end to end in a row.
ROW_BYTES = 1 << 21
#: A context in so many begins a passage; symbols of its context.
ANCHORS, REACH = 32, 8
#: Numbers of bytes before one that are its contexts; up to how many the topic is part of them.
ORDERS, SHORT = (2, 3, 5), 3
#: Slots that travel together when tables of tasks are added up.
_CHUNK = 1 << 16
_LOG2_10 = math.log2(10)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of texts (strings), one after the other, and how many each has; null counts as empty."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = parts.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # white space at a text's ends leaves empty ones
    before = np.r_[0, np.cumsum(some.to_numpy(zero_copy_only=False), dtype=np.int64)]
    return words.filter(some).cast(pa.binary()), np.diff(before[parts.offsets.to_numpy()])


def _listed(words: pa.Array) -> list[bytes]:
    """A list of words; several times as fast as ``to_pylist``."""
    return words.to_numpy(zero_copy_only=False).tolist()


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Places from and up to which texts of ROW_BYTES or so are read at once."""
    if len(texts):
        row = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // ROW_BYTES
        cuts = [0, *(np.flatnonzero(row[1:] != row[:-1]) + 1).tolist(), len(row)]
        yield from zip(cuts, cuts[1:], strict=False)


def slot_bits(symbols: int) -> int:
    return min(max((4 * symbols).bit_length(), SLOT_BITS[0]), SLOT_BITS[1])


class Lexicon:
    """Frequent words as symbols 0 to n - 1, the escape as n, the end as n + 1."""

    def __init__(self, words: list[bytes], counts: list[int], escapes: int, ends: int):
        self.words, self.escape, self.end = words, len(words), len(words) + 1
        self.counts = np.array([*counts, escapes, ends], dtype=np.int64)
        self.code = Code(self.counts.tolist())
        self.hashes = mixed(np.array([*map(zlib.crc32, words), 0, 1], dtype=np.uint32))
        letters = np.full(257, 1, dtype=np.int64)  # the shape of the bytes' code; all have one
        for w, c in zip(words, counts, strict=True):
            np.add.at(letters, np.frombuffer(w, dtype=np.uint8), np.int64(c))
            letters[256] += c
        self.letters = Code(letters.tolist())


class Streams:
    """Texts as symbols, laid end to end; words outside the lexicon, each once, and which of them each escape stands for."""

    def __init__(self, lexicon: Lexicon, sizes: np.ndarray, symbols: np.ndarray, rare: list[bytes], ids: np.ndarray | None = None):
        self.lexicon, self.sizes, self.symbols, self.rare = lexicon, sizes, symbols, rare
        self.ids = np.zeros(0, dtype=np.int64) if ids is None else ids
        self.starts = np.cumsum(sizes) - sizes
        self.escaped = symbols == lexicon.escape

    @classmethod
    def of(cls, lexicon: Lexicon, known: pa.Array, texts: pa.Array) -> Streams:
        """known: the lexicon's words."""
        words, sizes = words_of(texts)
        coded = words.dictionary_encode()
        place = coded.indices.to_numpy()
        symbol = pc.index_in(coded.dictionary, value_set=known)
        outside = symbol.is_null().to_numpy(zero_copy_only=False)
        symbol = pc.fill_null(symbol, lexicon.escape).to_numpy().astype(np.int64)
        sizes = sizes + 1
        ends = np.cumsum(sizes)
        symbols = np.full(ends[-1] if len(ends) else 0, lexicon.end, dtype=np.int64)
        inside = np.ones(len(symbols), dtype=bool)
        inside[ends - 1] = False
        symbols[inside] = symbol[place]
        ids = np.cumsum(outside) - 1
        return cls(lexicon, sizes, symbols, _listed(coded.dictionary.filter(pa.array(outside))), ids[place[outside[place]]])

    def packed(self) -> dict:
        """What ``unpacked`` needs, as columns of a table's row."""
        return {"sizes": self.sizes.astype("<i4").tobytes(), "symbols": self.symbols.astype("<i4").tobytes(), "rare": b" ".join(self.rare), "ids": self.ids.astype("<i4").tobytes()}

    @classmethod
    def unpacked(cls, lexicon: Lexicon, row: pa.RecordBatch) -> Streams:
        sizes, symbols, ids = (np.frombuffer(row.column(k)[0].as_buffer(), dtype="<i4").astype(np.int64) for k in ("sizes", "symbols", "ids"))
        return cls(lexicon, sizes, symbols, row.column("rare")[0].as_py().split(), ids)

    def of_texts(self, some: np.ndarray) -> Streams:
        """Only these texts."""
        if some.all():
            return self
        mask = np.repeat(some, self.sizes)
        return Streams(self.lexicon, self.sizes[some], self.symbols[mask], self.rare, self.ids[mask[self.escaped]])

    def frequent(self, words: int) -> dict:
        """Of each text the symbols below ``words`` that it has, and how often, as columns of a table's row."""
        at = np.flatnonzero(self.symbols < words)
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)[at]
        key, times = np.unique(text * max(words, 1) + self.symbols[at], return_counts=True)
        text, symbol = np.divmod(key, max(words, 1))
        kinds = np.bincount(text, minlength=len(self.sizes))
        return {"kinds": kinds[kinds > 0].astype("<i4").tobytes(), "frequent": symbol.astype("<i4").tobytes(), "times": times.astype("<i4").tobytes()}

    def contexts(self, topics: Topics) -> list[np.ndarray]:
        """Topic, last word, last two words before each symbol; an end stands before a text."""
        own = self.lexicon.hashes.take(self.symbols, mode="clip")
        if self.rare:
            own[self.escaped] = mixed(np.fromiter(map(zlib.crc32, self.rare), dtype=np.uint32, count=len(self.rare)))[self.ids]
        end = self.lexicon.hashes[-1]
        last = np.r_[end, own[:-1]]
        second = np.r_[end, last[:-1]]
        second[self.starts] = end
        return [topics.before(self.symbols, self.sizes), mixed(last + np.uint32(1)), mixed(last * np.uint32(0x9E3779B1) + second)]

    def entries(self, topic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text, word outside the lexicon and topic that go together: text, word's place, topic, number."""
        text = np.repeat(np.arange(len(self.sizes)), np.add.reduceat(self.escaped, self.starts, dtype=np.int64))
        key, n = np.unique((text * max(len(self.rare), 1) + self.ids) * (TOPICS + 1) + topic[self.escaped], return_counts=True)
        key, topic = np.divmod(key, TOPICS + 1)
        text, ids = np.divmod(key, max(len(self.rare), 1))
        return text, ids, topic, n

    def passages(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each passage its first symbol, its text, the hash of the symbols before it and of its own.

        Passages begin where the hash of the last two symbols says so, and end with the next or the text.
        """
        n = len(self.symbols)
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        place = np.arange(n) - self.starts[text]
        wide = _mixed64(self.symbols.astype(np.uint64))
        begins = np.zeros(n, dtype=bool)
        begins[2:] = _mixed64(wide[1:-1] + wide[:-2] * np.uint64(3))[: max(n - 2, 0)] % np.uint64(ANCHORS) == 0
        at = np.flatnonzero(begins & (place >= 2))
        if not len(at):
            return at, at, np.zeros(0, np.int64), np.zeros(0, np.int64)
        before = np.zeros(len(at), dtype=np.uint64)
        for k in range(1, REACH + 1):
            inside = place[at] >= k
            before += np.where(inside, _mixed64(wide[np.maximum(at - k, 0)] + np.uint64(k)), np.uint64(k))
        # A passage goes up to the next one or its text's end: runs from the first passage of each text on.
        first = np.r_[True, text[at][1:] != text[at][:-1]]
        stops = np.where(np.r_[first[1:], True], (self.starts + self.sizes)[text[at]], np.r_[at[1:], n])
        cuts = np.column_stack([at, stops]).ravel()
        offset = np.zeros(n, dtype=np.uint64)
        offset[at[0] :] = np.arange(at[0], n) - np.repeat(at, np.diff(np.r_[at, n]))
        of = _mixed64(wide + offset * np.uint64(0x9E3779B97F4A7C15))
        own = np.add.reduceat(np.r_[of, np.uint64(0)], cuts)[::2]
        return at, text[at], before.view(np.int64), own.view(np.int64)


def _mixed64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spelled(words: list[bytes], topics: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Bytes of words and an end (256) after each as symbols, their contexts, and the words' sizes with the end."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(sizes)
    symbols = np.full(ends[-1] if len(ends) else 0, 256, dtype=np.int64)
    inside = np.ones(len(symbols), dtype=bool)
    inside[ends - 1] = False
    symbols[inside] = np.frombuffer(b"".join(words), dtype=np.uint8)
    place = np.arange(len(symbols)) - np.repeat(ends - sizes, sizes)
    topic = np.repeat(topics.astype(np.uint32), sizes)
    contexts, h = [topic], np.full(len(symbols), 11, dtype=np.uint32)
    for k in range(1, max(ORDERS) + 1):
        before = np.full(len(symbols), 257, dtype=np.uint32)
        before[k:] = np.where(place[k:] >= k, symbols[:-k], 257)
        h = (h ^ before) * np.uint32(0x01000193) + np.uint32(k)
        if k in ORDERS:
            contexts.append(mixed(h * np.uint32(16) + topic if k <= SHORT else h))
    return symbols, contexts, sizes


def _word_model(lexicon: Lexicon, bits: int) -> Predictors:
    return Predictors(lexicon.code, TOPICS + 1, 3, bits)


def _byte_model(lexicon: Lexicon, bits: int) -> Predictors:
    return Predictors(lexicon.letters, TOPICS + 1, len(ORDERS) + 1, bits)


def _packed(counts: np.ndarray) -> bytes:
    """Whole counts in as few bytes as the largest needs."""
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if counts.max(initial=0) < 2 ** (8 * int(k[2])))
    return kind[2].encode() + zlib.compress(counts.astype(kind).tobytes(), 1)


def _unpacked(blob) -> np.ndarray:
    raw = bytes(blob)
    return np.frombuffer(zlib.decompress(raw[1:]), dtype=f"<u{raw[:1].decode()}")


_TABLES = "table int, chunk int, task int, blob binary"


def _table_rows(model: Predictors) -> Iterator[pa.RecordBatch]:
    """A task's count tables in chunks, without those that have no counts, and what its mixer adds to the mean (table -1)."""
    task = TaskContext.get().partitionId()

    def row(table: int, chunk: int, blob: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], pa.int32()) for x in (table, chunk, task)] + [pa.array([blob], pa.binary())], names=["table", "chunk", "task", "blob"])

    if model.counts:
        yield row(-1, 0, model.mixer.sums().astype("<f8").tobytes())
    for t, counts in enumerate(model.counts):
        for c in range(0, len(counts), 2 * _CHUNK):
            part = counts[c : c + 2 * _CHUNK]
            if part.any():
                yield row(t, c // (2 * _CHUNK), _packed(part))


def _added_up(rows: DataFrame, model: Predictors) -> Predictors:
    """The model, frozen, from all tasks' tables: a chunk's parts are added one by one in 64 bits, and only the stored
    form, two bytes a slot, reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def made() -> pa.RecordBatch:
            first, second = (total.astype("<f8").tobytes(), b"") if key[0] < 0 else (x.tobytes() for x in Predictors.stored(total))
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([first], pa.binary()), pa.array([second], pa.binary())], names=["table", "chunk", "odds", "sure"])

        for b in batches:
            for t, c, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3), strict=True):
                part = np.frombuffer(blob.as_buffer(), dtype="<f8") if t < 0 else _unpacked(blob.as_buffer())
                if (t, c) != key:
                    if key is not None:
                        yield made()
                    key, total = (t, c), np.zeros(len(part), dtype=np.float64 if t < 0 else np.int64)
                total += part.astype(total.dtype)
        if key is not None:
            yield made()

    odds, sure, mixer = [np.zeros(n, dtype=np.int8) for n in model.sizes], np.zeros(model.sizes[-1], dtype=np.uint8), None
    with common.batches_of(rows.sparkSession, 64):
        sums = common.staged(rows.repartition("table", "chunk").sortWithinPartitions("table", "chunk", "task").mapInArrow(run, "table int, chunk int, odds binary, sure binary"), "lm-tables")
    for r in sums.toLocalIterator():  # of a bounded size, whatever the corpus
        if r["table"] < 0:
            mixer = np.frombuffer(r["odds"], dtype="<f8")
            continue
        at, part = r["chunk"] * _CHUNK, np.frombuffer(r["odds"], dtype=np.int8)
        odds[r["table"]][at : at + len(part)] = part
        if r["table"] == model.tables - 1:
            sure[at : at + len(part)] = np.frombuffer(r["sure"], dtype=np.uint8)
    return model.frozen(odds, sure, Mixer.mean(model.tables, mixer))


def _tasks(df: DataFrame, units: int, each: int) -> DataFrame:
    """As many tasks as ``units`` of work ask for, ``each`` to a task, and no fewer than there are cores."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-units // each)))


def word_counts(docs: DataFrame) -> DataFrame:
    """(``word`` binary, ``c``) of every word of every training text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def added() -> pa.Table:
            return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns({"c_sum": "c"}).select(["word", "c"])

        for b in batches:
            for x, y in slices(b.column(0)):
                found = words_of(b.column(0).slice(x, y - x))[0].value_counts()
                held.append(pa.table({"word": found.field(0), "c": found.field(1)}))
                rows += len(found)
                if rows > 1 << 20:
                    whole = added()
                    held, rows = [whole], len(whole)
                    if rows > 1 << 19:
                        yield from whole.to_batches(1 << 16)
                        held, rows = [], 0
        if held:
            yield from added().to_batches(1 << 16)

    return docs.filter("NOT held_out").select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``n_bytes``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``bits_per_byte``.

    held_out: condition on ``docs``; rows for which it holds (null counts as false) are scored but not
    learned from. ``base_score`` is the add-one unigram log10 probability, ``score`` the model's. Null texts
    count as empty and have an end only. Rows that repeat count and are scored each for itself; null ids
    stay. Other columns aren't read. An empty table gives an empty result. Very long texts and words are
    learned and scored whole.

    Words outside the lexicon and continuations of passages, of which there are ever more, are never broadcast:
    what they cost is joined to the rows that have them. Lexicon, topics and hashed tables have bounds and are.
    """
    docs = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    ends = docs.filter("NOT held_out").count()
    counted = common.staged(word_counts(docs), "lm-words")
    words, kinds = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    total, distinct = words + ends, kinds + (ends > 0)
    scale = math.log10(total + distinct + 1)
    frequent = common.most_frequent(counted.filter(F.octet_length("word") <= LEXICON_BYTES), "c", LEXICON)
    frequent.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    lexicon = Lexicon([bytes(r["word"]) for r in frequent], [r["c"] for r in frequent], words - sum(r["c"] for r in frequent), ends)
    del frequent

    streams = common.staged(_streams(docs, lexicon), "lm-streams")
    topics = _topics(streams, lexicon)
    bits = slot_bits(total)
    learned = common.staged(_tasks(streams.select("sizes", "symbols", "rare", "ids", F.col("docs.held_out").alias("held")), total, TASK_SYMBOLS).mapInArrow(_learner(docs.sparkSession, lexicon, topics, bits), _TABLES), "lm-learned")
    model = _added_up(learned, _word_model(lexicon, bits))
    common.discard(learned)

    with common.batches_of(docs.sparkSession, 4):
        main = common.staged(_scored(streams, docs.schema["id"].dataType.simpleString(), lexicon, topics, model), "lm-scored")
    common.discard(streams)

    used = main.select("rid", "held_out", F.explode("rare").alias("r")).select("rid", "held_out", "r.word", "r.topic", F.col("r.n").alias("times"))
    # Of each word how often training texts have it, and in how many texts it is, by topic: sums that are formed before the shuffle.
    own, one = F.when(F.col("held_out"), 0).otherwise(F.col("times")), F.lit(1).cast("long")
    rare = used.groupBy("word").agg(F.sum(own).alias("c"), *[F.sum(F.when(F.col("topic") == k, x).otherwise(0)).alias(f"{name}{k}") for name, x in (("own", own), ("uses", one)) for k in range(TOPICS + 1)])
    rare = common.staged(rare, "lm-rare")
    uses = [F.col(c) for c in _numbers("uses")]
    used_in = sum(((x > 0).cast("long") for x in uses), F.lit(0).cast("long"))
    totals = [used_in, used_in * (F.octet_length("word") + 1), sum(uses, F.lit(0).cast("long"))]
    pairs, n_bytes, n_used, most = rare.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in totals], F.coalesce(F.max(F.greatest(*uses)), F.lit(0))).first()
    bits = slot_bits(n_bytes)
    # In an order that has nothing to do with their spelling, as online learning needs it.
    taught = _tasks(rare.filter("c > 0").select("word", *_numbers("own")), pairs, TASK_WORDS).sortWithinPartitions(F.xxhash64("word"))
    spelling = common.staged(taught.mapInArrow(_speller(lexicon, bits), _TABLES), "lm-spelling")
    letters = _added_up(spelling, _byte_model(lexicon, bits))
    common.discard(spelling)
    cost = common.staged(_spelled_cost(rare, letters), "lm-spelled")
    common.discard(rare)
    priced = common.lookup(used.drop("held_out"), cost, ["word", "topic"], "uses", n_used, most)
    sums = priced.groupBy("rid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("base"),
        F.sum(F.col("times") * F.col("bits")).alias("bits"),
    )
    n_passages = main.agg(F.coalesce(F.sum(F.size("passages")), F.lit(0))).first()[0]
    saved = _saved(main.select("rid", "held_out", F.explode("passages").alias("p")).select("rid", "held_out", "p.*"), n_passages)
    zero = F.lit(0.0)
    bits = F.greatest(F.col("main_bits") + F.coalesce("bits", zero) - F.coalesce("saved", zero), zero)
    return main.drop("rare", "passages").join(sums, "rid", "left").join(saved, "rid", "left").select(
        F.col("id").alias(id_col), "held_out", "n_bytes", "n_tokens",
        (F.col("main_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("main_base") + F.coalesce("base", zero) - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        (-bits / F.lit(_LOG2_10)).alias("score"),
        F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"),
    )


def _streams(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All texts as symbols, ROW_BYTES of them to a row, so that later passes need not read and split them again."""
    held = docs.sparkSession.sparkContext.broadcast(lexicon)
    id_kind = docs.schema["id"].dataType
    schema = f"""docs array<struct<rid: long, id: {id_kind.simpleString()}, held_out: boolean, n_bytes: long>>, sizes binary, symbols binary, rare binary, ids binary,
        kinds binary, frequent binary, times binary"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = held.value
        known, rid = pa.array(lexicon.words, pa.binary()), TaskContext.get().partitionId() << 40
        for b in batches:
            for x, y in slices(b.column(0)):
                part = b.slice(x, y - x)
                laid = Streams.of(lexicon, known, part.column(0))
                n = part.num_rows
                of = pa.StructArray.from_arrays([pa.array(range(rid, rid + n), pa.int64()), part.column(2), part.column(1), pc.binary_length(part.column(0)).cast(pa.int64())], names=["rid", "id", "held_out", "n_bytes"])
                rid += n
                columns = laid.packed() | laid.of_texts(_learned(part.column(1))).frequent(_topic_words(lexicon))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), of), *(pa.array([v], pa.binary()) for v in columns.values())], names=["docs", *columns])

    return docs.select("text", "held_out", F.col("id")).mapInArrow(run, schema)


def _learned(held_out: pa.Array) -> np.ndarray:
    return ~held_out.to_numpy(zero_copy_only=False).astype(bool)


def _topic_words(lexicon: Lexicon) -> int:
    return min(TOPIC_WORDS, len(lexicon.words))


def _topics(streams: DataFrame, lexicon: Lexicon) -> Topics:
    """Classes of all training texts, found in passes over all of them; a pass sends a number per word and class."""
    words = _topic_words(lexicon)
    topics = Topics(words, TOPICS).begin(lexicon.counts[:words])
    for _ in range(TOPIC_ROUNDS if words else 0):

        def run(batches: Iterator[pa.RecordBatch], topics=topics) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((topics.words, topics.n), dtype=np.int64)
            for b in batches:
                for at in range(b.num_rows):
                    sums += topics.count(*(np.frombuffer(b.column(k)[at].as_buffer(), dtype="<i4") for k in ("frequent", "times", "kinds")))
            cell = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(sums.ravel()[cell])], names=["cell", "n"])

        found = streams.select("frequent", "times", "kinds").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
        sums = np.zeros(topics.words * topics.n, dtype=np.int64)
        for r in found.collect():  # words times classes at most
            sums[r["cell"]] = r["n"]
        before = topics.weight.copy()
        topics = topics.moved(sums.reshape(topics.words, topics.n))
        if (before == topics.weight).all():
            break
    return topics


def _learner(spark, lexicon: Lexicon, topics: Topics, bits: int):
    held = spark.sparkContext.broadcast((lexicon, topics))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, topics = held.value
        model = _word_model(lexicon, bits)
        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1)
                laid = Streams.unpacked(lexicon, row).of_texts(_learned(row.column("held")[0].values))
                if len(laid.symbols):
                    model.learn(laid.symbols, laid.contexts(topics))
        yield from _table_rows(model)

    return run


def _numbers(name: str) -> list[str]:
    """Columns with a number for each topic."""
    return [f"{name}{k}" for k in range(TOPICS + 1)]


def _by_topic(rows: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, topic and number wherever there is one."""
    of = np.column_stack([rows.column(c).to_numpy() for c in _numbers(name)])
    row, topic = np.nonzero(of)
    return row, topic, of[row, topic]


def _speller(lexicon: Lexicon, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _byte_model(lexicon, bits)
        for b in batches:
            for at in range(0, b.num_rows, 1 << 13):
                part = b.slice(at, 1 << 13)
                row, topic, own = _by_topic(part, "own")
                symbols, contexts, sizes = spelled(_listed(part.column(0).take(pa.array(row))), topic)
                model.learn(symbols, contexts, np.repeat(own, sizes))
        yield from _table_rows(model)

    return run


def _scored(streams: DataFrame, id_kind: str, lexicon: Lexicon, topics: Topics, model: Predictors) -> DataFrame:
    """A row per text: what its symbols cost, its words outside the lexicon, its passages and what each costs."""
    held = streams.sparkSession.sparkContext.broadcast((lexicon, topics, model))
    names = ["rid", "id", "held_out", "n_bytes", "n_tokens", "main_known", "main_base", "main_bits", "rare", "passages"]
    schema = f"""rid long, id {id_kind}, held_out boolean, n_bytes long, n_tokens long, main_known long, main_base double, main_bits double,
        rare array<struct<word: binary, topic: int, n: int>>, passages array<struct<context: long, passage: long, bits: float>>"""

    def lists(of: list[pa.Array], fields: list[str], text: np.ndarray, n: int) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32()), pa.StructArray.from_arrays(of, names=fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, topics, model = held.value
        counts = lexicon.counts.copy()
        counts[lexicon.escape] = 0
        price, known = np.log10(counts + 1.0), (counts > 0).astype(np.int64)
        for b in batches:
            for at in range(b.num_rows):
                part = b.slice(at, 1)
                laid = Streams.unpacked(lexicon, part)
                n = len(laid.sizes)
                contexts = laid.contexts(topics)
                each = model.bits_of(laid.symbols, contexts)
                text, ids, topic, times = laid.entries(contexts[0])
                rare = lists([pa.array(laid.rare, pa.binary()).take(pa.array(ids)), pa.array(topic, pa.int32()), pa.array(times, pa.int32())], ["word", "topic", "n"], text, n)
                begin, text, before, own = laid.passages()
                ends = np.r_[0.0, np.cumsum(each)]
                last = np.r_[text[1:] != text[:-1], True] if len(text) else np.zeros(0, dtype=bool)
                stop = np.where(last, (laid.starts + laid.sizes)[text], np.r_[begin[1:], 0][: len(begin)])
                passages = lists([pa.array(before, pa.int64()), pa.array(own, pa.int64()), pa.array((ends[stop] - ends[begin]).astype(np.float32))], ["context", "passage", "bits"], text, n)
                sums = [np.add.reduceat(x, laid.starts) for x in (known.take(laid.symbols), price.take(laid.symbols), each)]
                yield pa.RecordBatch.from_arrays([*part.column("docs").flatten().flatten(), pa.array(laid.sizes), *map(pa.array, sums), rare, passages], names=names)

    return streams.select("docs", "sizes", "symbols", "rare", "ids").mapInArrow(run, schema)


def _saved(passages: DataFrame, total: int) -> DataFrame:
    """(``rid``, ``saved``): bits by which texts are cheaper where the corpus predicts whole passages.

    A context that training texts have at least twice predicts its most frequent passage, as one bit before the
    passage: if it isn't that one, its symbols follow. How likely it is depends on how often context and passage
    were seen, and is learned from all training passages, each predicted from all others. Contexts are as many as
    the corpus has; passages are joined to them by key, those whose context has no prediction not at all.
    """
    counts = passages.groupBy("context", "passage").agg(F.sum((~F.col("held_out")).cast("long")).alias("k"), F.count(F.lit(1)).alias("rows"))
    best = F.max(F.struct("k", "passage")).alias("best")
    seen = counts.groupBy("context").agg(F.sum("k").alias("n"), F.sum("rows").alias("rows"), best).filter("n > 1")
    seen = common.staged(seen.select("context", "n", "rows", F.col("best.k").alias("k"), F.col("best.passage").alias("likely")), "lm-passages")
    most = seen.agg(F.coalesce(F.max("rows"), F.lit(0))).first()[0]

    def state(n: Column, k: Column) -> Column:
        return (F.least(F.floor(F.log2(n)), F.lit(15)) * 9 + F.floor(k * 8 / n)).cast("int")

    others = seen.filter("n > 2").select(F.explode(F.array(
        F.struct(state(F.col("n") - 1, F.col("k") - 1).alias("state"), F.col("k").alias("hits"), F.lit(0).cast("long").alias("misses")),
        F.struct(state(F.col("n") - 1, F.least("k", F.col("n") - 1)).alias("state"), F.lit(0).cast("long").alias("hits"), (F.col("n") - F.col("k")).alias("misses")),
    )).alias("s")).groupBy("s.state").agg(F.sum("s.hits").alias("hits"), F.sum("s.misses").alias("misses"))
    chance = [0.1] * (16 * 9)
    for r in others.collect():  # a row per state
        chance[r["state"]] = (r["hits"] + 0.2) / (r["hits"] + r["misses"] + 2)
    near = common.Bitmap(seen.select("context")).mark(passages, "context", "hit").filter("hit").drop("hit", "held_out")
    found = common.lookup(near, seen, ["context"], "rows", total, most).filter("n IS NOT NULL")
    p, bits = F.element_at(F.array(*map(F.lit, chance)), state(F.col("n"), F.col("k")) + 1), F.col("bits").cast("double")
    now = F.when(F.col("passage") == F.col("likely"), -F.log2(p + (1 - p) * F.pow(F.lit(2.0), -bits))).otherwise(bits - F.log2(1 - p))
    return found.groupBy("rid").agg(F.sum(bits - now).alias("saved"))


def _spelled_cost(rare: DataFrame, letters: Predictors) -> DataFrame:
    """(``word``, ``topic``, ``c``, ``uses``, ``bits``) of each word outside the lexicon in each topic that has it."""
    held = rare.sparkSession.sparkContext.broadcast(letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                row, topic, uses = _by_topic(part, "uses")
                words = part.column(0).take(pa.array(row))
                symbols, contexts, sizes = spelled(_listed(words), topic)
                bits = np.add.reduceat(model.bits_of(symbols, contexts), np.cumsum(sizes) - sizes)
                yield pa.RecordBatch.from_arrays([words, pa.array(topic, pa.int32()), part.column(1).take(pa.array(row)), pa.array(uses), pa.array(bits)], names=["word", "topic", "c", "uses", "bits"])

    return rare.select("word", "c", *_numbers("uses")).mapInArrow(run, "word binary, topic int, c long, uses long, bits double")
