"""Extract parts: delimited files of bounded size with a manifest that says what each must hold."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymark.functions.canonical import canonical_value
from quaymark.operators import apply
from quaymark.plans.spec import META_DELETED, META_LSN, META_UPDATED, Protection, TableSpec
from quaymark.sources.control import SCHEMAS
from quaymark.sources.versioned import VersionedStore

# How parts are written, when they are closed, the manifest's version.
DELIMITER, QUOTE, NULL_SENTINEL = ",", '"', "\\N"
ROLL_BYTES, ROLL_ROWS = 2 << 30, 20_000_000
MANIFEST_VERSION = 1

PART = "index int, file string, bytes long, rows long, sha256 string, gzip boolean, first_key string, last_key string, state string"
MANIFEST = f"version int, source_table string, target_table string, columns array<string>, delimiter string, null_sentinel string, quote string, extract_start_lsn long, extract_end_lsn long, parts array<struct<{PART.replace(' ', ':').replace(',:', ',')}>>, total_rows long, complete boolean"


def slug(table: str) -> str:
    """A table's name as part of a file's."""
    return table.replace("/", "_").replace(" ", "_")


def encode_null(value: Column, kind: T.DataType) -> Column:
    """A field's text: null as the sentinel, a text that is the sentinel escaped by a backslash."""
    text = canonical_value(value, kind)
    return F.when(value.isNull(), NULL_SENTINEL).when(text == NULL_SENTINEL, "\\" + NULL_SENTINEL).otherwise(text)


def decode_null(text: Column) -> Column:
    """What ``encode_null`` wrote, as it was; a reader gives an empty field as null."""
    return F.when(text.isNull(), "").when(text == NULL_SENTINEL, F.lit(None)).when(text == "\\" + NULL_SENTINEL, NULL_SENTINEL).otherwise(text)


def _quoted(text: str) -> str:
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in ',"\n\r') or text.startswith(" ") else text


class _Hashed:
    """A file of which size and SHA-256 are known when it is written."""

    def __init__(self, name: str):
        self.name, self.size, self.digest, self._out = name, 0, hashlib.sha256(), open(name, "wb")  # noqa: SIM115

    def write(self, data: bytes) -> int:
        self.size += len(data)
        self.digest.update(data)
        return self._out.write(data)

    def flush(self) -> None:
        self._out.flush()

    def close(self) -> None:
        self._out.close()


def write_parts(df: DataFrame, folder: str, table: str, columns: list[str], key: str, rows_per_part: int = ROLL_ROWS, bytes_per_part: int = ROLL_BYTES, compress: bool = False) -> DataFrame:
    """Write ``df`` in key order as parts into a folder that all executors share; a row of PART for each.

    Rows are dealt by key range; each task closes a part when it is full. Files have their final names only
    when they are complete, and a task that is run again writes the same names.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = df.select(F.col(key).alias("__key"), *[encode_null(F.col(c), kinds[c]).alias(c) for c in columns])
    placed = texts.repartitionByRange("__key").sortWithinPartitions("__key").withColumn("__task", F.spark_partition_id())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from itertools import count

        numbers, part = count(), None
        done = []

        def close(p: dict) -> None:
            if compress:
                p["out"].close()
            p["file"].close()
            os.replace(p["file"].name, p["path"])
            done.append((0, os.path.basename(p["path"]), p["file"].size, p["rows"], p["file"].digest.hexdigest(), compress, p["first"], p["last"], "sealed"))

        for frame in frames:
            lines = frame[columns].apply(lambda c: c.map(_quoted)).agg(DELIMITER.join, axis=1) if len(frame) else []
            for task, at, line in zip(frame["__task"], frame["__key"], lines, strict=True):
                data = (line + "\n").encode()
                if part and (part["rows"] >= rows_per_part or part["size"] + len(data) > bytes_per_part):
                    close(part)
                    part = None
                if part is None:
                    name = f"{slug(table)}.dat.{task:05d}-{next(numbers):05d}" + (".gz" if compress else "")
                    path = os.path.join(folder, name)
                    file = _Hashed(f"{path}.{TaskContext.get().taskAttemptId()}.tmp")
                    # Without a time or a name in it, so that a task that is run again writes the same bytes.
                    out = gzip.GzipFile(filename="", mode="wb", fileobj=file, mtime=0) if compress else file
                    part = {"path": path, "file": file, "out": out, "rows": 0, "size": 0, "first": str(at), "last": ""}
                part["out"].write(data)
                part["rows"] += 1
                part["size"] += len(data)
                part["last"] = str(at)
        if part:
            close(part)
        yield pd.DataFrame(done, columns=["index", "file", "bytes", "rows", "sha256", "gzip", "first_key", "last_key", "state"])

    return placed.mapInPandas(run, PART)


def manifest(parts: list, table: str, target: str, columns: list[str], start_lsn: int, end_lsn: int) -> dict:
    """A complete manifest of parts in the order of their names."""
    numbered = [{**p.asDict(), "index": i} for i, p in enumerate(sorted(parts, key=lambda p: p["file"]))]
    return {
        "version": MANIFEST_VERSION, "source_table": table, "target_table": target, "columns": columns, "delimiter": DELIMITER, "null_sentinel": NULL_SENTINEL, "quote": QUOTE,
        "extract_start_lsn": start_lsn, "extract_end_lsn": end_lsn, "parts": numbered, "total_rows": sum(p["rows"] for p in numbered), "created_at": datetime.now(UTC).isoformat(), "complete": True,
    }


def manifest_problem(m: dict) -> str | None:
    """What is wrong with a manifest, or None."""
    if m.get("version") != MANIFEST_VERSION:
        return f"version {m.get('version')} is not supported"
    for name in ("source_table", "target_table", "columns", "delimiter"):
        if not m.get(name):
            return f"{name} is missing"
    seen = set()
    for p in m.get("parts", []):
        if p["index"] in seen:
            return f"part {p['index']} is there twice"
        seen.add(p["index"])
        if p["state"] == "sealed" and (not p["sha256"] or p["rows"] < 0):
            return f"part {p['index']} is sealed without digest or rows"
    if m.get("complete"):
        if any(p["state"] == "writing" for p in m.get("parts", [])):
            return "complete, but a part is still being written"
        if sum(p["rows"] for p in m.get("parts", [])) != m.get("total_rows"):
            return "total_rows is not the sum of the parts' rows"
        if m["extract_end_lsn"] < m["extract_start_lsn"]:
            return "the extract ends before it starts"
    return None


def write_manifest(m: dict, path: str) -> None:
    if problem := manifest_problem(m):
        raise ValueError(problem)
    with open(path + ".tmp", "w", encoding="utf-8") as out:
        json.dump(m, out, indent=2)
    os.replace(path + ".tmp", path)


def read_manifests(spark: SparkSession, pattern: str) -> DataFrame:
    """Manifests by name; a file that can't be read gives a row of nulls and stops nobody."""
    return spark.read.schema(MANIFEST).option("multiLine", True).option("mode", "PERMISSIVE").json(pattern)


def eligible(parts: DataFrame) -> DataFrame:
    """Parts that may be loaded, in order: closed ones with a digest."""
    return parts.filter((F.col("state") == "sealed") & (F.coalesce("sha256", F.lit("")) != "")).orderBy("index")


def unloaded(parts: DataFrame, part_state: DataFrame, by: list[str]) -> DataFrame:
    return eligible(parts).join(part_state.filter("state = 'loaded'").select(*by), by, "left_anti").orderBy("index")


def verify_parts(spark: SparkSession, parts: list, folder: str) -> DataFrame:
    """(``file``, ``problem``) of files that aren't what the manifest says: missing, of another size, changed.

    Each task reads its files a megabyte at a time.
    """
    listed = spark.createDataFrame([(p["file"], p["bytes"], p["sha256"]) for p in parts], "file string, bytes long, sha256 string").repartition(max(1, len(parts)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, size, digest in frame.itertuples(index=False):
                path = os.path.join(folder, name)
                if not os.path.exists(path):
                    out.append((name, "missing"))
                elif os.path.getsize(path) != size:
                    out.append((name, f"{os.path.getsize(path)} bytes, not {size}"))
                else:
                    with open(path, "rb") as stored:
                        if hashlib.file_digest(stored, "sha256").hexdigest() != digest:
                            out.append((name, "sha256 differs"))
            yield pd.DataFrame(out, columns=["file", "problem"])

    return listed.mapInPandas(run, "file string, problem string")


def read_parts(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Rows of parts, typed as declared; gzip by its name."""
    names = [f.name for f in schema.fields]
    texts = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(paths, sep=DELIMITER, quote=QUOTE, escape=QUOTE, multiLine=True, nullValue="\x01", emptyValue="")
    return texts.select(*[decode_null(F.col(f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def part_bounds(rows: DataFrame, part: str, key: str) -> DataFrame:
    """(``part``, ``rows``, ``first_key``, ``last_key``) of numbered parts in key order."""
    return rows.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def manifest_totals(parts: DataFrame) -> DataFrame:
    """One row: rows in sealed parts, in all parts, parts, and whether an index is there twice."""
    good = (F.col("state") == "sealed") & (F.coalesce("sha256", F.lit("")) != "")
    return parts.agg(
        F.coalesce(F.sum(F.when(good, F.col("rows"))), F.lit(0)).alias("sealed_rows"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("parts"), (F.count(F.lit(1)) > F.countDistinct("index")).alias("index_repeats"),
    )


def part_progress(parts: DataFrame) -> DataFrame:
    loaded = F.coalesce(F.sum(F.when(F.col("state") == "loaded", 1).otherwise(0)), F.lit(0))
    return parts.agg(F.count(F.lit(1)).alias("parts_total"), loaded.alias("parts_loaded"))


def load(spark: SparkSession, store: VersionedStore, listed: dict, folder: str, spec: TableSpec, migration_id: str, at: Column) -> int:
    """Verify, read, merge and mark the parts of a manifest that aren't loaded yet; how many were loaded.

    A manifest or file that isn't as it should be is an error, and nothing of it is loaded. Rows go in under the
    fence with the extract's first sequence number; rows and part states are one version, so that a part is
    loaded and marked or neither. Columns come as they are in the parts, protected if they are to be.
    """
    if problem := manifest_problem(listed):
        raise ValueError(f"manifest of {spec.source}: {problem}")
    name, schema = spec.target.replace(".", "_"), T.StructType.fromDDL(SCHEMAS["part_state"])
    states = store.table("part_state", schema)
    mine = states.filter((F.col("migration_id") == migration_id) & (F.col("source_table") == spec.source))
    parts = spark.createDataFrame([tuple(p[c] for c in ("index", "file", "bytes", "rows", "sha256", "state")) for p in listed["parts"]], "index int, file string, bytes long, rows long, sha256 string, state string")
    todo = unloaded(parts, mine.withColumnRenamed("part_index", "index"), ["index"]).collect()  # a row per file
    if not todo:
        return 0
    if bad := verify_parts(spark, todo, folder).collect():
        raise ValueError(f"parts of {spec.source}: " + "; ".join(f"{r['file']}: {r['problem']}" for r in bad))
    kinds = T.StructType([T.StructField(c, T.StringType() if spec.column(c).protect != Protection.NONE else spec.column(c).spark_type()) for c in listed["columns"]])
    rows = read_parts(spark, [os.path.join(folder, p["file"]) for p in todo], kinds).select(*[F.col(c).alias(spec.column(c).target) for c in listed["columns"]])
    pk = [spec.column(k).target for k in spec.primary_key]
    payload = [f for f in rows.columns if f not in pk]
    meta = T.StructType.fromDDL(f"{META_LSN} long, {META_DELETED} boolean, {META_UPDATED} timestamp")
    stored = store.rows_of(name, T.StructType([*rows.schema.fields, *meta.fields]), rows, pk)
    merged = apply.merge_part(stored, rows, pk, payload, listed["extract_start_lsn"], at)
    done = spark.createDataFrame([(migration_id, spec.source, p["index"], "loaded", p["rows"], p["sha256"], None) for p in todo], schema).withColumn("loaded_at", at)
    store.commit({}, changes={name: (merged, pk), "part_state": (done, ["migration_id", "source_table", "part_index"])})
    return len(todo)
