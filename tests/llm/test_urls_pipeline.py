from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quaymark.llm import common, exact_dedup, quality_crf, queries, simhash, tokenizers_used, url_filter
from tests.compare import assert_equal, database
from tests.llm.test_dedup import norm
from tests.llm.test_near_copies import components_by_hand

SF = "/root/testdata/sf0.001"


def test_op7_equals_its_sql(spark):
    assert_equal(queries.op7_url_filter(spark, SF), database(SF), queries.ORACLE_SQL["op7_url_filter"])


def test_urls_are_split():
    assert url_filter.split_url("HTTP://WWW.Ex.NET:80/a/B?c#d") == ("www.ex.net:80", "/a/B")
    assert url_filter.split_url("x://h?q") == ("h", "") and url_filter.split_url("x://h#f/g") == ("h", "")
    assert url_filter.split_url(None) == url_filter.split_url("no scheme") == ("", "") and url_filter.split_url("://É/p") == ("É", "/p")


@pytest.mark.parametrize(
    "url,want",
    [
        ("http://a.net/x", "net/"), ("http://net/x", "net/"), ("http://xnet/x", None), ("http://a.example.net/en/x", "example.net/en/"), ("http://example.net/enx", "net/"),
        ("http://example.net", None), ("http://e.org/fr/", "org/fr/"), ("http://x.org/frx", None), ("http://deep.org/a/bc", "deep.org/a/b"),
    ],
)
def test_longest_rule_wins(url, want):
    trie = url_filter.RuleTrie([*queries.URL_RULES, ("block", "deep.org/a/b"), ("block", "deep.org/a"), ("block", "org/fr/")])
    found = trie.match(*url_filter.split_url(url))
    assert (found and found[1]) == want
    if want == "org/fr/":
        assert found[0] == "allow"  # of equal rules


def test_random_rules_equal_brute_force():
    import random

    rng = random.Random(5)
    hosts, paths = ["a", "b.a", "c.b.a", "x.a", "b"], ["", "/", "/p", "/p/", "/p/q", "/pq/", "/p/q/r/"]
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts) + rng.choice(paths)) for _ in range(25)]
    trie = url_filter.RuleTrie(rules)
    for h in [*hosts, "z.c.b.a", "q"]:
        for p in [*paths, "/p/qq", "/p/q/r/s"]:
            fits = []
            for verdict, rule in rules:
                host, slash, path = rule.partition("/")
                if (h == host or h.endswith("." + host)) and p.startswith(slash + path):
                    fits.append((len(rule), len(host), verdict == "allow", rule))
            found = trie.match(h, p)
            assert (found and found[1]) == (max(fits)[3] if fits else None)


def test_odd_pages(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "", None), (2, "http://A.NET/", "y")], "page_id long, url string, label string")
    found = url_filter.judge(df, queries.URL_RULES)
    assert found.count() == 4 and found.filter("verdict = 'block'").first()["rule"] == "net/" and url_filter.judge(df.limit(0), queries.URL_RULES).count() == 0
    with pytest.raises(ValueError):
        url_filter.judge(df.withColumnRenamed("label", "Host"), queries.URL_RULES)
    with pytest.raises(ValueError):
        url_filter.RuleTrie([("maybe", "net/")])


def test_pipeline_equals_its_stages_by_hand(spark, tmp_path):
    folder = str(tmp_path)
    given = spark.read.parquet(f"{SF}/documents.parquet")
    near = given.filter("doc_id % 3 = 0").withColumns({"doc_id": F.col("doc_id") + 10_000, "text": F.concat(F.lower(F.substring("text", 1, 1)), F.expr("substring(text, 2)"))})
    given.unionByName(near).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    field = queries.quality_field(spark, docs, folder)
    rows = docs.orderBy("doc_id").collect()
    good = [r for r, s in zip(rows, field.score([r["text"] or "" for r in rows]), strict=True) if s >= 0.7]
    first = {}
    for r in good:
        first.setdefault(norm(r["text"]), r["doc_id"])
    unique = [r for r in good if first[norm(r["text"])] == r["doc_id"]]
    least = components_by_hand([(r["doc_id"], r["text"]) for r in unique])
    left = [r for r in unique if least[r["doc_id"]] == r["doc_id"]]
    encode = tokenizers_used.byte_bpe()()
    want = {r["doc_id"]: len(encode(r["text"] or "")) + 1 for r in left}
    have = {}
    for p in corpus_pipeline.run(spark, folder).collect():
        have[p["doc_id"]] = have.get(p["doc_id"], 0) + p["length"]
    assert have == want and len(left) < len(unique) < len(good) < len(rows)


def test_stages_on_odd_rows(spark, odd_docs, no_docs, tmp_path):
    labels = spark.createDataFrame([(0, 1, 0), (9, 0, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, str(tmp_path))
            assert name == "pack" or made.columns == docs.columns
            if name != "pack":  # whole rows, whatever the columns' names
                assert {tuple(r) for r in made.collect()} <= {tuple(r) for r in docs.collect()}
            assert made.count() <= max(docs.count() * 12, 0)


def test_nothing_is_left_staged(spark, odd_docs, tmp_path):
    """A finished query leaves its result, and no other table, until it is released."""
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0), (9, 0, 0), (6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    folder = Path(common.shared_dir(spark).removeprefix("file:")) / "quaymark"
    common.release()
    for name in ("op2_simhash_near_dedup", "op6_best_fit_packing", "op10_exact_dedup"):
        before = set(folder.iterdir()) if folder.exists() else set()
        queries.QUERIES[name](spark, str(tmp_path)).collect()
        assert [p.name.rpartition("-")[0] for p in set(folder.iterdir()) - before] == [name]
    before = set(folder.iterdir())
    corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [p.name.rpartition("-")[0] for p in set(folder.iterdir()) - before] == ["pipeline-pack"]
    common.release()
    assert not {p for p in set(folder.iterdir()) - before if p.is_dir()}


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "pack"]
    assert {exact_dedup.__name__, simhash.__name__, quality_crf.__name__} and "pipeline" in __import__("__spark_entry__").queries()
