"""What the operators share: the shared folder, staged tables, joins that no hot key can hold up."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A key is hot from this share of all rows on, so that no more than HOT_KEYS keys can be hot.
HOT_KEYS = 1000

#: Bits of a map of hashes: at least, at most (32 MB when full). Sixteen for each hash where the bound allows it.
MAP_BITS = (15, 28)
#: Bits that one row of bitmap_construct_agg holds.
_ROW_BITS = 32768

_own: dict[str, str] = {}
_held = threading.local()
#: Folders of results that are left staged, with the session that wrote them: no table is held, nor its plan.
_left: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a local session, as in tests, may do without."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="quaymark-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
        spark.sparkContext.setCheckpointDir(_own[app])
    return _own[app]


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again.

    It cuts lineage, survives lost executors, and fixes what else could differ between two evaluations of a plan.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quaymark/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    scopes = getattr(_held, "scopes", None)
    (scopes[-1] if scopes else _left).append((spark, path))
    return out


def discard(table: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    _delete(table.sparkSession, table._staged_at)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def finished(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` gives, staged; all tables that were staged on the way are deleted once it is written.

    Calls nest: what an inner call leaves is deleted with what the outer one staged.
    """
    if not hasattr(_held, "scopes"):
        _held.scopes = []
    scopes = _held.scopes
    scopes.append([])
    out = None
    try:
        out = staged(make(), name)
    finally:
        for spark, folder in scopes.pop():
            if out is None or folder != out._staged_at:
                _delete(spark, folder)
    (scopes[-1] if scopes else _left).append((out.sparkSession, out._staged_at))
    return out


def release() -> None:
    """Delete what queries of this process left staged: their results, which nothing reads any more."""
    while _left:
        with contextlib.suppress(Exception):  # a session that has ended deletes nothing
            _delete(*_left.pop())


atexit.register(release)


class Bitmap:
    """Which hashes a table may have: a broadcast of at most 32 MB, however many there are. A miss is certain."""

    def __init__(self, hashes: DataFrame):
        """hashes: one column, long, distinct."""
        self.bits = min(max((16 * hashes.count() - 1).bit_length(), MAP_BITS[0]), MAP_BITS[1])
        place = F.pmod(F.col(hashes.columns[0]), F.lit(1 << self.bits))
        self.rows = hashes.groupBy(F.floor(place / _ROW_BITS).alias("__row")).agg(F.bitmap_construct_agg(F.pmod(place, F.lit(_ROW_BITS))).alias("__bits"))

    def mark(self, df: DataFrame, hash_: str, name: str) -> DataFrame:
        """``df`` with a boolean column ``name``: whether the hash may be there."""
        place = F.pmod(F.col(hash_), F.lit(1 << self.bits))
        bit = F.pmod(place, F.lit(_ROW_BITS))
        octet = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.coalesce(F.getbit(octet, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))
        return df.withColumn("__row", F.floor(place / _ROW_BITS)).join(F.broadcast(self.rows), "__row", "left").withColumn(name, hit).drop("__row", "__bits")


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of no more rows while a table of large rows is read and staged; the session's own setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def most_frequent(counts: DataFrame, count: str, most: int) -> list:
    """Rows of up to ``most`` of the most frequent keys, no more than that, however many tasks hold them.

    Counts are put into classes of an eighth of an octave; as many whole classes as fit are taken. Keys that
    occur once never are. Only these rows and the classes' sizes reach the driver.
    """
    held = staged(counts.filter(F.col(count) > 1), "frequent")
    kind = F.floor(F.log2(F.col(count)) * 8).cast("int")
    taken, least = 0, None
    for r in sorted(held.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        if taken + r["n"] > most:
            break
        taken, least = taken + r["n"], r["kind"]
    return [] if least is None else held.filter(kind >= least).collect()


def shared_file(spark: SparkSession, name: str, data: bytes) -> str:
    """``data`` as a file in the shared folder, by way of Spark's file systems; its address."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/quaymark/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(data)
    out.close()
    return path.toString()


def crc32_of(column: str) -> Column:
    """crc32 of a column's text, as the contracts' folds take it; null where the column is."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def row_key(id_col: str, text_col: str) -> Column:
    """A hash of a row's id and text (nulls have their own, but a null text is as empty) that is never null."""
    return F.sha2(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))), 256)


def rows_kept(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs``, whole, whose ``row_key`` was ``kept``; ``decided`` has a ``key`` and ``kept`` for each row.

    Of several rows with the same id and text, whatever else they hold, one stays. Only rows whose key is in
    ``decided`` as dropped or more than once (or seems so: see ``Bitmap``) are shuffled, and of those with the
    same key one per task. Columns may have any names: they travel as one struct.
    """
    marks = decided.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept")).filter("n > 1 OR NOT kept")
    marks = staged(marks.select("key", "kept", F.xxhash64("key").alias("hash")), "marks")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(id_col, text_col).alias("key"))
    own = Bitmap(marks.select("hash").distinct()).mark(own.withColumn("hash", F.xxhash64("key")), "hash", "hit")
    nth = F.row_number().over(W.partitionBy("key").orderBy("key"))
    first = own.filter("hit").withColumn("nth", nth).filter("nth = 1").join(marks.select("key", "kept").hint("shuffle_merge"), "key", "left")
    rows = own.filter("NOT hit").select("row").unionByName(first.filter("coalesce(kept, true)").select("row"))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], count: str, total: int, most: int | None = None) -> DataFrame:
    """``rows`` left-joined with ``table``, one row of it a key at most, however many rows a key has.

    count: column of ``table`` with the key's number of rows; total: of all rows. Keys with more than a
    thousandth of the rows, hence under a thousand of them, are broadcast; the others, of which none is
    large, are joined by a shuffle. ``count`` stays in the result. Null keys find nothing.
    most: the largest ``count``, where it is known; if no key is hot, ``rows`` are read once, not for each of the two.
    """
    bar = max(total // HOT_KEYS, 1)
    if most is not None and most <= bar:
        return rows.join(table, keys, "left").select(*rows.columns, *[c for c in table.columns if c not in keys])
    columns = [c for c in table.columns if c not in keys]
    hot = table.filter(F.col(count) > bar).select(*keys, F.struct(*columns).alias("__hot"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    rest = table.filter(F.col(count) <= bar).select(*keys, F.struct(*columns).alias("__rest"))
    joined = _rest_join(marked, rest, keys)
    return joined.select(
        *[F.col(c) for c in rows.columns],
        *[F.coalesce(F.col(f"__hot.{c}"), F.col(f"__rest.{c}")).alias(c) for c in columns],
    )


def _rest_join(marked: DataFrame, rest: DataFrame, keys: list[str]) -> DataFrame:
    found = marked.filter(F.col("__hot").isNotNull()).withColumn("__rest", F.lit(None).cast(rest.schema["__rest"].dataType))
    other = marked.filter(F.col("__hot").isNull()).join(rest, keys, "left")
    return found.unionByName(other)
