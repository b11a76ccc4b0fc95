"""Texts of two million characters, of white space or of one word, go whole through every operator over documents."""

import hashlib
import zlib

import numpy as np
import pytest

import corpus_pipeline
from quaymark.llm import html_main_text, queries, quality_crf, tokenizers_used, url_filter

N = 2_000_000
LONG = [(0, "a short text, to learn from. It has two sentences."), (1, " " * N), (2, "\t" * N), (3, "\n" * N), (4, "x" * N), (5, "a" + " " * N + "b"), (7, None), (8, "another one | 1 2 3")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("long"))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in LONG], "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (8, 0, 0), (3, 0, 0), (4, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def rows(spark, folder, name):
    return sorted(queries.QUERIES[name](spark, folder).collect(), key=lambda r: r["doc_id"])


def test_packing_gives_the_library_s_ids(spark, folder):
    import tokenizers

    library = tokenizers.Tokenizer.from_file(tokenizers_used.vocabulary_path("byte_bpe_50k.json"))
    found = {}
    for r in rows(spark, folder, "op6_best_fit_packing"):
        found.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    for i, t in LONG:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        assert sum(n for _, n, _ in found[i]) == len(ids)
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == c for a, n, c in found[i])


def test_encoding_gives_the_library_s_ids(spark, folder):
    import tokenizers

    library = tokenizers.Tokenizer.from_file(tokenizers_used.vocabulary_path("word_bpe_49k.json"))
    for r in rows(spark, folder, "op3_lexicon_bpe"):
        text = dict(LONG)[r["doc_id"]] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_counts_are_the_library_s(spark, folder):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizers_used.vocabulary_path("piece_bpe_32k.model"))
    for r in rows(spark, folder, "op8_prefix_token_counts"):
        assert r["n_tokens"] == len(library.encode(dict(LONG)[r["doc_id"]] or ""))


def test_the_other_operators_and_the_pipeline(spark, folder):
    scored = rows(spark, folder, "op1_quality_crf")
    assert len(scored) == len(LONG) and all(0 <= r["score"] <= 1 for r in scored)
    prints = {r["doc_id"]: r for r in rows(spark, folder, "op2_simhash_near_dedup")}
    assert {prints[i]["fingerprint"] for i in (1, 2, 3, 7)} == {"0" * 16} and {prints[i]["component_id"] for i in (1, 2, 3, 7)} == {1}
    modelled = {r["doc_id"]: r for r in rows(spark, folder, "op4_context_mixing")}
    assert {i: modelled[i]["n_tokens"] for i in (1, 4, 5)} == {1: 1, 4: 2, 5: 3} and all(np.isfinite(r["score"]) for r in modelled.values())
    exact = {r["doc_id"]: r for r in rows(spark, folder, "op10_exact_dedup")}
    assert [exact[i]["keep_id"] for i in (1, 2, 3, 4, 5, 7)] == [1, 1, 1, 4, 5, 7]
    assert corpus_pipeline.run(spark, folder).filter("length < 1 OR length > 2048").count() == 0


def test_long_lines_urls_and_pages():
    field = quality_crf.Field(np.zeros(quality_crf.WIDTH, np.float32), np.ones(quality_crf.WIDTH, np.float32), np.ones(3 * quality_crf.WIDTH + 1) / 9, np.array([[0.4, 0.0], [0.1, 0.3]]))
    text = "\n".join(["a line.", "another", ""] * 2000)
    both, alone = field.line_quality([text, text])[0], field.line_quality([text])[0]
    assert np.allclose(both[0], alone[0]) and np.allclose(both[1], alone[0])  # step by step side by side, number by number alone
    trie = url_filter.RuleTrie([("block", "a.net/" + "x" * 100_000), ("allow", "net/")])
    assert trie.match("a.net", "/" + "x" * N)[0] == "block" and trie.match("a.net", "/" + "x" * 99_999)[0] == "allow"
    assert len(html_main_text.trained().extract(["<article><p>" + "word " * 400_000 + "</article>"])[0]) == 400_000 * 5 - 1
