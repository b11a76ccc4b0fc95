import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quaymark.llm import lexicon_bpe, packing, prefix_counts, queries, tokenizers_used

SF = "/root/testdata/sf0.001"
path = tokenizers_used.vocabulary_path
PIECES = [" ", "\n", "\t", "the", "'s", "ion", "_", "é", "ü.", ",", "\x00", "\x1c", "²", "ª", "Σ", "İ", "œ", "×", "▁", "<s>", "<|endoftext|>", "<|startoftext|>", "<|", "日本"]
TEXTS = st.lists(st.one_of(st.sampled_from(PIECES), st.characters(exclude_categories=["Cs"]))).map("".join)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def piece_library():
    return sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))


# The lexicon


def test_transducer():
    words = ["the", "then", "thing", "nothing", "in", "ing", "über", "a"]
    outputs = {w: [i, len(w)] for i, w in enumerate(words)}
    made = lexicon_bpe.Transducer.build(outputs)
    asked = [*words, "", "t", "thin", "nothings", "z"]
    numbers = made.numbers(asked).tolist()
    assert [made.output(n) for n in numbers[: len(words)]] == list(outputs.values()) and set(numbers[len(words) :]) == {-1}
    assert sorted(numbers[: len(words)]) == list(range(len(words)))
    # Minimal: as many states as the words have distinct sets of endings.
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    assert len(made.final) == len({frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes})
    assert lexicon_bpe.Transducer.build({}).numbers(["a"]).tolist() == [-1]


def test_transducer_as_a_mapped_file(tmp_path):
    made = lexicon_bpe.Transducer.build({"ab": [1, 2], "b": [3]})
    (tmp_path / "l").write_bytes(made.packed())
    again = lexicon_bpe.Transducer.mapped(str(tmp_path / "l"))
    assert again.numbers(["b", "ab", "x"]).tolist() == [1, 0, -1] and again.output(0) == [1, 2]


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_word_bpe_equals_the_library(word_library, text):
    bpe = lexicon_bpe.word_bpe("word_bpe_49k.json")
    lexicon = lexicon_bpe.Transducer.build({w: bpe.merge(w) for w in ("the", "ion", "a")})
    ids = word_library.encode(text, add_special_tokens=False).ids
    assert bpe.encode_all([text], lexicon) == [(len(ids), " ".join(map(str, ids)), word_library.decode(ids, skip_special_tokens=False))]


def test_op3_equals_the_library(spark, word_library, documents, odd_docs, no_docs):
    from hashlib import sha256

    def check(rows, found):
        want = []
        for r in rows:
            ids = word_library.encode(r["text"] or "", add_special_tokens=False).ids
            want.append((r["doc_id"], len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(word_library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found if r["doc_id"] is not None) == sorted(w for w in want if w[0] is not None)
        assert len(found) == len(want)

    check(documents.collect(), queries.op3_lexicon_bpe(spark, SF).collect())
    check(odd_docs.collect(), lexicon_bpe.encode(odd_docs).collect())
    assert lexicon_bpe.encode(no_docs).count() == 0


# Prefix counts


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_prefix_counts_equal_the_library(piece_library, text):
    model = prefix_counts.piece_model("piece_bpe_32k.model")
    assert model.count_all([text]) == [len(piece_library.encode(text))]
    assert model.table(text).tolist() == [len(piece_library.encode(text[:i])) for i in range(len(text) + 1)]


def test_op8_equals_the_library(spark, piece_library, documents, odd_docs, no_docs):
    for df, found in ((documents, queries.op8_prefix_token_counts(spark, SF)), (odd_docs, prefix_counts.token_counts(odd_docs, 4096))):
        want = [(str(r["doc_id"]), len((r["text"] or "").encode()), len(n := piece_library.encode(r["text"] or "")), len(n) > 4096) for r in df.collect()]
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in found.collect()) == sorted(want)
    assert prefix_counts.token_counts(no_docs, 4096).count() == 0


def test_truncation_answers_from_the_table(spark, piece_library):
    df = spark.createDataFrame([(0, "the cat sat on the windowsill\nand slept"), (1, None), (2, "日本語 text")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in prefix_counts.truncate(df, 5).collect()}
    text = "the cat sat on the windowsill\nand slept"
    longest = max(i for i in range(len(text) + 1) if len(piece_library.encode(text[:i])) <= 5)
    assert rows[0]["text"] == text[:longest] and rows[1]["n_tokens"] == 0
    tables = {r["doc_id"]: r["counts"] for r in prefix_counts.prefix_tables(df).collect()}
    assert tables[1] == [0] and tables[0][-1] == len(piece_library.encode(text))


# Packing


@settings(max_examples=60, deadline=None)
@given(st.integers(8, 64), st.lists(st.integers(1, 64), max_size=200))
def test_plans_hold_every_piece_once(size, lengths):
    counts = {}
    for x in lengths:
        x = min(x, size)
        counts[x] = counts.get(x, 0) + 1
    made = packing.plan(counts, size)
    held = {}
    for copies, pattern in made:
        assert copies > 0 and sum(a * k for a, k in pattern) <= size
        for a, k in pattern:
            held[a] = held.get(a, 0) + k * copies
    assert held == counts


def fewest(lengths, size):
    """By trying everything."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in sorted({r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values()):
            place(i + 1, [r - lengths[i] * (j == k) for j, r in enumerate(rooms)])
        place(i + 1, [*rooms, size - lengths[i]])

    place(0, [])
    return best[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_never_costs_a_sequence(lengths):
    size = 20
    counts = {x: lengths.count(x) for x in lengths}
    fixed, rest = packing.reduce_dominated(counts, size)
    left = sorted((x for x, c in rest.items() for _ in range(c)), reverse=True)
    assert sum(c for c, _ in fixed) + (fewest(left, size) if left else 0) == fewest(sorted(lengths, reverse=True), size)


def check_packed(rows, found, library, size=2048):
    import zlib

    ids = [np.append(library.encode(r["text"] or "", add_special_tokens=False).ids, 0).astype("<u4") for r in rows]
    want = []
    for r, x in zip(rows, ids, strict=True):
        cuts = [0, *range(len(x) % size or size, len(x) + 1, size)]
        want += [(str(r["doc_id"]), k, a, b - a, zlib.crc32(x[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted((str(p["doc_id"]), p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in found) == sorted(want)
    by_sequence = {}
    for p in found:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for held in by_sequence.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= size
    assert len(by_sequence) <= 1.02 * sum(map(len, ids)) / size + 1


def test_op6_equals_the_library(spark, byte_library, documents, odd_docs, no_docs):
    check_packed(documents.collect(), queries.op6_best_fit_packing(spark, SF).collect(), byte_library)
    check_packed(odd_docs.collect(), packing.pack(odd_docs, tokenizers_used.byte_bpe()).collect(), byte_library)
    assert packing.pack(no_docs, tokenizers_used.byte_bpe()).count() == 0
    whole = packing.pack(odd_docs, tokenizers_used.byte_bpe(), keep_ids=True).filter("doc_id = 4").first()
    assert whole["ids"][-1] == 0 and len(whole["ids"]) == whole["length"]


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_byte_bpe_equals_the_library(byte_library, text):
    assert tokenizers_used.byte_bpe()()(text).tolist() == byte_library.encode(text, add_special_tokens=False).ids
