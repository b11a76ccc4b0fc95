import hashlib
import hmac

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymark.functions import canonical, digest, protect, redaction
from quaymark.plans.spec import ColumnSpec, Logical, Plan, Protection, TableSpec, load_plan, load_settings


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def key(**values):
    kinds = {int: T.LongType(), float: T.DoubleType(), str: T.StringType(), bool: T.BooleanType(), type(None): T.StringType()}
    return canonical.canonical_key({k: (F.lit(v).cast(kinds[type(v)]), kinds[type(v)]) for k, v in values.items()})


def test_key_is_independent_of_order_and_of_number_types(spark):
    row = one(spark, key(a=1, b="x"), key(b="x", a=1), key(a=1.0, b="x"))
    assert row[0] == row[1] == row[2] == "1:a=1:1;1:b=1:x;"


def test_key_lengths_keep_values_apart(spark):
    row = one(spark, key(a="1;1:b=1:2", b="3"), key(a="1", b="2;1:b=1:3"), key(a="é"))
    assert row[0] != row[1] and row[2] == "1:a=2:é;"


def test_null_is_not_empty(spark):
    row = one(spark, key(a=None), key(a=""))
    assert row[0] == "1:a=5:\x00NULL;" and row[1] == "1:a=0:;"


@pytest.mark.parametrize("value,text", [(42.0, "42"), (-0.5, "-0.5"), (123456.5, "123456.5"), (1234567.5, "1.2345675e+06"), (0.00001, "1e-05"), (1e21, "1e+21"), (0.1, "0.1"), (1e300, "1e+300")])
def test_floats_in_shortest_digits(spark, value, text):
    assert canonical.shortest_float(value) == text
    assert one(spark, canonical.canonical_value(F.lit(value).cast("double"), T.DoubleType()))[0] == text


def test_partition_is_bounded_and_even(spark):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    found = rows.select(canonical.key_partition(F.col("k"), 8).alias("p")).groupBy("p").count().collect()
    assert sorted(r["p"] for r in found) == list(range(8)) and min(r["count"] for r in found) > 180
    assert one(spark, canonical.key_partition(F.lit("x"), 1), canonical.key_partition(F.lit("x"), 0))[:] == (0, 0)


def test_hash_shows_nothing_of_the_key(spark):
    found = one(spark, canonical.key_hash(F.lit("secret")))[0]
    assert len(found) == 12 and "secret" not in found


def test_row_digest_texts(spark):
    columns = [ColumnSpec("a", Logical.DECIMAL, scale=2), ColumnSpec("b", trim_trailing_space=True), ColumnSpec("c", Logical.BOOL), ColumnSpec("d", nullable=True)]
    df = spark.createDataFrame([("1.5", "BR01    ", None, None)], "a string, b string, c boolean, d string")
    want = hashlib.md5("\x1f".join(["1.50", "BR01", "0", "\\x00NULL"]).encode()).hexdigest()
    assert df.select(digest.row_digest(df, columns)).first()[0] == want


def test_range_digest_ignores_order_and_sees_a_cent(spark):
    columns = [ColumnSpec("id", Logical.INT), ColumnSpec("v", Logical.DECIMAL, scale=2)]
    rows = [(i, f"{i}.25") for i in range(50)]

    def made(r):
        df = spark.createDataFrame(r, "id long, v string")
        return df.select(digest.row_digest(df, columns).alias("d")).agg(*digest.range_digest(F.col("d"))).first()

    assert made(rows) == made(rows[::-1])
    changed = made([*rows[:-1], (49, "49.26")])
    assert changed != made(rows) and changed["row_count"] == 50
    assert made([])[:] == (0, 0, 0)


KEY = bytes(range(32))


def test_tokens(spark):
    row = one(spark, protect.token(KEY, "s.t.c", F.lit("alice")), protect.token(KEY, "s.t.d", F.lit("alice")), protect.token(KEY, "s.t.c", F.lit("")), protect.token(KEY, "s.t.c", F.lit(None).cast("string")))
    import base64

    mac = hmac.digest(KEY, len("s.t.c").to_bytes(8, "big") + b"s.t.c" + b"alice", "sha256")
    assert row[0] == base64.b32encode(mac[:20]).decode() and row[1] != row[0] and row[2] == "" and row[3] is None


def test_shaped_tokens_keep_shape_and_are_even():
    t = protect.shaped_token(KEY, "d", "123-45-6789")
    assert t[3] == t[6] == "-" and t.replace("-", "").isdecimal() and t != "123-45-6789"
    assert protect.shaped_token(KEY, "d", "Ab-é9")[:3][2] == "-"
    assert protect.shaped_token(KEY, "d", "Ab1", letters=False).isdecimal()
    counts = [0] * 10
    for i in range(400):
        for c in protect.shaped_token(KEY, "d", f"{i:016d}"):
            counts[int(c)] += 1
    assert max(counts) < 1.15 * min(counts)


def test_avalanche():
    a, b = (int.from_bytes(protect.prf_bytes(KEY, "d", v), "big") for v in (b"value-1", b"value-2"))
    assert 90 < (a ^ b).bit_count() < 166


def test_encryption(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,)], "v string")
    made = df.select("v", protect.encrypt(KEY, "d", df["v"]).alias("r"), protect.encrypt_deterministic(KEY, "d", df["v"]).alias("e"))
    rows = made.collect()
    assert rows[0]["r"] != rows[1]["r"] and rows[0]["e"] == rows[1]["e"] and rows[2]["r"] is None
    assert rows[0]["r"].startswith("enc:v1:") and "=" not in rows[0]["r"]
    sealed = spark.createDataFrame([(r["r"],) for r in rows[:2]] + [(rows[0]["e"],), ("enc:v1:AAAA",), ("plain",), (rows[0]["e"][:-2] + "zz",)], "c string")
    opened = [r[0] for r in sealed.select(protect.decrypt(KEY, "d", F.col("c"))).collect()]
    assert opened == ["x", "x", "x", None, None, None]
    assert sealed.select(protect.decrypt(KEY, "other", F.col("c"))).first()[0] is None


def test_protect_drops_what_is_not_declared_or_redacted(spark):
    spec = TableSpec("s.t", "s.t", ("id",), (ColumnSpec("id", protect=Protection.TOKENIZE), ColumnSpec("n", target_name="note", protect=Protection.ENCRYPT), ColumnSpec("r", protect=Protection.REDACT)))
    df = spark.createDataFrame([("1", "hello", "pan", "new")], "id string, n string, r string, surprise string")
    made = protect.protect(df, spec, KEY, KEY)
    assert made.columns == ["id", "note"] and made.first()["note"].startswith("enc:v1:")


def test_key_sources():
    with pytest.raises(ValueError):
        protect.StaticKey(KEY)
    now, asked = [0.0], []
    source = protect.EnvelopeKey(b"wrapped", lambda w: asked.append(w) or KEY, 60, lambda: now[0])
    assert source.key("a") == protect.expand_key(KEY, b"a") != source.key("b") and len(asked) == 1
    now[0] = 61
    source.key("a")
    assert len(asked) == 2
    source.forget()
    assert source._held is None


def test_hkdf_expand_is_the_standard_one():
    # RFC 5869, test case 1.
    prk = bytes.fromhex("077709362c2e32df0ddc3f0dc47bba6390b6c73bb50f9c3122ec844ad7c2b3e5")
    okm = "3cb25f25faacd57a90434f64d0362f2a2d2d0a90cf1a5a4c5db02d56ecc4c5bf34007208d5b887185865"
    assert protect.expand_key(prk, bytes.fromhex("f0f1f2f3f4f5f6f7f8f9"), 42).hex() == okm


def test_redaction(spark):
    m = spark.createDataFrame([({"PASSWORD": "x", "n": "1"},)], "m map<string,string>")
    assert m.select(redaction.redact(F.col("m"))).first()[0] == {"PASSWORD": "[redacted]", "n": "1"}
    assert redaction.redact_nested({"a": {"Token": 1, "b": [{"dsn": 2}]}}) == {"a": {"Token": "[redacted]", "b": [{"dsn": "[redacted]"}]}}


def test_plan():
    text = """{"name": "p", "tables": [{"source": "app.accounts", "target": "core.accounts", "primary_key": ["id"],
      "columns": [{"name": "id", "protect": "tokenize"}, {"name": "balance", "type": "decimal", "scale": 2}]}]}"""
    plan = load_plan(text)
    assert plan.find("app.accounts") is plan.find("accounts") is plan.tables[0] and plan.find("nothing") is None
    assert plan.tables[0].column("balance").scale == 2
    for bad in (text.replace('"name": "p"', '"nome": "p"'), text.replace("tokenize", "encrypt"), text.replace('["id"]', "[]"), text.replace('"balance"', '"id"')):
        with pytest.raises(ValueError):
            load_plan(bad)
    assert Plan("p").names() == []


def test_texts_of_all_lengths_can_be_opened(spark):
    key = bytes(range(32))
    texts = spark.range(300).select(F.expr("repeat('é', cast(id as int))").alias("v")).repartition(2)
    for seal in (protect.encrypt, protect.encrypt_deterministic):
        sealed = texts.select("v", seal(key, "d", F.col("v")).alias("s"))
        opened = sealed.select("v", "s", protect.decrypt(key, "d", F.col("s")).alias("o"))
        assert opened.filter("NOT (v <=> o) OR s rlike '[\\r\\n=]'").count() == 0


def test_row_keys_are_protected_as_the_plan_says(spark):
    spec = TableSpec("a.t", "b.t", ("id", "part"), (ColumnSpec("id", protect=Protection.TOKENIZE), ColumnSpec("part"), ColumnSpec("gone", protect=Protection.REDACT)))
    keys = spark.createDataFrame([({"id": "7", "part": "x", "other": "y", "gone": "z"},), (None,)], "k map<string,string>")
    found = keys.select(protect.protect_key(F.col("k"), spec, b"k" * 32).alias("k"), protect.token(b"k" * 32, "a.t.id", F.lit("7")).alias("t")).collect()
    assert found[0]["k"] == {"id": found[0]["t"], "part": "x", "other": "y"} and found[1]["k"] is None


def test_settings_from_file_and_environment():
    made = load_settings('{"max_findings": 5, "migration_id": "a"}', {"QUAYMARK_MIGRATION_ID": "b", "QUAYMARK_LEAF_ROWS": "7", "HOME": "/"})
    assert (made.max_findings, made.migration_id, made.leaf_rows, made.max_depth) == (5, "b", 7, 48)
    for text, environ in (('{"oops": 1}', {}), ("{}", {"QUAYMARK_OOPS": "1"}), ("{}", {"QUAYMARK_LEAF_ROWS": "x"}), ('{"max_depth": 0}', {}), ('{"max_lag_seconds": -1}', {})):
        with pytest.raises(ValueError):
            load_settings(text, environ)
