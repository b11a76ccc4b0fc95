import re
from collections import defaultdict

import numpy as np
import xxhash

from quaymark.llm import common, exact_dedup, queries, simhash
from tests.compare import assert_equal, database

SF = "/root/testdata/sf0.001"


def test_op10_equals_its_sql(spark):
    assert_equal(queries.op10_exact_dedup(spark, SF), database(SF), queries.ORACLE_SQL["op10_exact_dedup"])


def norm(t):
    return re.sub(r"[\x20\x09-\x0d]+", " ", t or "")


def test_exact_dedup_of_odd_rows(spark, odd_docs, no_docs):
    rows = odd_docs.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r["text"])].append(r["doc_id"])
    found = exact_dedup.exact_dedup(odd_docs, digest=True).collect()
    assert len(found) == len(rows)
    by_digest = defaultdict(list)
    for f in found:
        by_digest[f["text_sha256"]].append(f)
    assert sorted(map(len, by_digest.values())) == sorted(map(len, groups.values()))
    for group in by_digest.values():
        assert sum(f["kept"] for f in group) == 1 and {f["group_size"] for f in group} == {len(group)}
        ids = [f["doc_id"] for f in group if f["doc_id"] is not None]
        assert {f["keep_id"] for f in group} == {min(ids) if ids else None}
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    kept = exact_dedup.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(groups)
    assert exact_dedup.keep_first(no_docs).count() == 0


def test_prefixes_that_agree_are_told_apart(spark):
    df = spark.createDataFrame([(i, "p" * 500 + str(i % 3)) for i in range(9)], "doc_id long, text string")
    found = exact_dedup.exact_dedup(df).collect()
    assert {f["keep_id"] for f in found} == {0, 1, 2} and {f["group_size"] for f in found} == {3}


def test_a_hot_group_is_looked_up(spark):
    df = spark.range(3000).selectExpr("id doc_id", "if(id % 3 = 0, 'same', concat('t', id)) text")
    found = exact_dedup.exact_dedup(df)
    assert found.filter("kept").count() == 2001 and found.filter("keep_id = 0").count() == 1000


def plain_fingerprint(text, width=3):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable by links, from all pairs."""
    n = len(prints)
    fps = np.array([p for _, p in prints], dtype=np.uint64)
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3):
            a, b = top(i), top(int(j))
            root[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(n):
        groups[top(i)].append(prints[i][0])
    return {top(i): min((x for x in groups[top(i)] if x is not None), default=None) for i in range(n)}, [top(i) for i in range(n)]


def check_components(df):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in df.collect()]
    least, top = plain_components(rows)
    want = sorted(((i, p if p < 1 << 63 else p - (1 << 64), least[top[k]]) for k, (i, p) in enumerate(rows)), key=str)
    have = sorted(((r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=str)
    assert have == want


def test_simhash_equals_brute_force(spark, documents, odd_docs, no_docs):
    check_components(documents)
    check_components(odd_docs)
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_first(no_docs).count() == 0


def test_one_row_of_each_component_stays(spark, odd_docs):
    found = simhash.near_duplicates(odd_docs).collect()
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len({r["component_id"] for r in found})


def fingerprints_frame(spark, fps):
    return spark.createDataFrame([(int(np.int64(np.uint64(f))),) for f in fps], "fp long")


def test_links_connect_what_all_pairs_connect(spark, monkeypatch):
    """Dense clusters and chains, with cells so small that buckets are dealt into several."""
    monkeypatch.setattr(simhash, "CELL", 8)
    rng = np.random.default_rng(3)
    fps = set()
    for _ in range(12):
        centre = int(rng.integers(0, 2**63))
        for _ in range(25):
            fps.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)))
        chain = centre
        for _ in range(20):
            chain ^= sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            fps.add(chain)
    fps = sorted(fps)
    edges = simhash.links(fingerprints_frame(spark, fps))
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    least, top = plain_components([(int(np.int64(np.uint64(f))), f) for f in fps])
    for i, f in enumerate(fps):
        signed = int(np.int64(np.uint64(f)))
        assert roots.get(signed, signed) == least[top[i]]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5000, 5000)]
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(found[i] == 0 for i in range(1, 101)) and all(found[1000 + i] == 1000 for i in range(1, 60))
    assert simhash.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_lookup_of_hot_keys(spark):
    rows = spark.range(5000).selectExpr("if(id % 2 = 0, 7, id) k", "id")
    table = rows.groupBy("k").count().withColumnRenamed("count", "n")
    found = common.lookup(rows, table, ["k"], "n", 5000)
    assert found.count() == 5000 and found.filter("k = 7 and n <> 2501").count() == 0 and found.filter("n is null").count() == 0
