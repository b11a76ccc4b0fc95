import random
from collections import defaultdict

import numpy as np

import corpus_pipeline
from quaymark.llm import common, shingle_sets, simhash

SCHEMA = "doc_id long, text string"


def sets_of(text, width=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def components_by_hand(rows):
    """Smallest id of each row's component, from all pairs."""
    made, root = [sets_of(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for j in range(len(rows)):
        for i in range(j):
            if alike(made[i], made[j]) >= 0.8:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        groups[top(i)].append(doc)
    return {rows[i][0]: min(groups[top(i)]) for i in range(len(rows))}


def edited():
    """Texts of 300 invented words, each with copies of which words are changed, put in or left out in six places."""
    rng = random.Random(4)
    rows = []
    for k in range(20):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        rows.append((len(rows), " ".join(words)))
        for how in ("change", "insert", "drop"):
            copy = list(words)
            for at in rng.sample(range(300), 6):
                if how == "change":
                    copy[at] = f"new{k}"
                elif how == "insert":
                    copy[at] += f" new{k}"
                else:
                    copy[at] = ""
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_edited_inserted_and_dropped_words_are_found(spark):
    rows = edited()
    want = components_by_hand(rows)
    kept = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert {r["doc_id"] for r in kept.collect()} == {d for d, least in want.items() if d == least}
    assert set(want.values()) == {4 * k for k in range(20)}


def test_components_equal_all_pairs(spark, documents, monkeypatch):
    """Also where hubs leave pairs of a bucket to be compared, in buckets dealt into cells."""
    monkeypatch.setattr(shingle_sets, "CELL", 4)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    rows = [(1_000_000 + k, " ".join(base[: 60 + rng.randrange(60)])) for k in range(40)]  # chains of lengths
    rows += [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = shingle_sets.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == components_by_hand(rows)


def test_odd_rows_and_no_rows(spark, odd_docs, no_docs):
    found = shingle_sets.near_duplicates(odd_docs).collect()
    kept = shingle_sets.keep_first(odd_docs)
    assert len(found) == odd_docs.count() and kept.columns == odd_docs.columns
    assert kept.count() == len({r["component_id"] for r in found})
    assert {r["component_id"] for r in found if r["doc_id"] in (1, 2, 3)} == {1} and {r["component_id"] for r in found if r["doc_id"] in (0, 6, 7)} == {0}
    assert shingle_sets.near_duplicates(no_docs).count() == 0 and shingle_sets.keep_first(no_docs).count() == 0


def test_wide_fingerprints_meet_at_the_similarity():
    """The SimHash blocks that the stage links by find pairs of similarity 0.8, among many rows as among few."""
    rng = np.random.default_rng(5)
    for rows in (300, 50_000, 12_000_000):
        blocks, bits, distance = simhash.blocks_for(rows, 0.8)
        found = 0
        for _ in range(500):
            hashes = rng.integers(0, 1 << 63, 100, dtype=np.uint64) * np.uint64(2)
            a, b = (simhash.wide_fingerprint(h, simhash.words_for(blocks, bits)) for h in (hashes[:90], np.r_[hashes[:80], hashes[90:]]))
            parts = np.unpackbits((a ^ b)[simhash.WORDS :].view(np.uint8), bitorder="little")[: blocks * bits].reshape(blocks, bits)
            found += np.bitwise_count(a ^ b)[: simhash.WORDS].sum() <= distance and not parts.any(axis=1).all()
        assert found >= 498


def test_a_group_that_nothing_links_takes_rows_in_proportion(spark, monkeypatch):
    """300 texts, each pair some 0.71 alike and few 0.8: what isn't linked is not compared by way of tables of pairs."""
    rng = random.Random(6)
    words, rows = [f"w{k}" for k in range(300)], []
    for k in range(1, 301):
        some = [5 * x for x in rng.sample(range(1, 59), 5)]
        rows.append((k, " ".join(f"x{k}" if i in some else w for i, w in enumerate(words))))
    rows += [(1000 + k, " ".join(f"r{rng.randrange(9000)}" for _ in range(20))) for k in range(800)]
    made, staged = [], common.staged

    def counted(df, name):
        made.append(staged(df, name))
        return made[-1]

    monkeypatch.setattr(common, "staged", counted)
    want = components_by_hand(rows)
    found = shingle_sets.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == want
    assert max(t.count() for t in made) <= 5 * len(rows)
    assert "simhash" in {t._staged_at.rsplit("/", 1)[1].partition("-")[0] for t in made}
