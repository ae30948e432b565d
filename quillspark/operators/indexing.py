"""An index as versioned tables: names, creation, upserts, usage logs, batches."""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators.chunking import CHUNKING_VERSION
from quillspark.operators.ordering import numbered
from quillspark.operators.retrieval import checked_index

INDEX_VERSION = "index-v2"


def index_name(prefix: str, dataset_version: str, chunking: str = CHUNKING_VERSION, index: str = INDEX_VERSION) -> str:
    """A name in which a change of data, chunks or mapping shows."""
    parts = [prefix, dataset_version, chunking, index]
    return "-".join("".join(c if c.isalnum() else "-" for c in p.lower()).strip("-") for p in parts)


#: Buckets of a new index; the size of what an upsert rewrites is a bucket's.
BUCKETS = 64


class IndexMissing(LookupError):
    """There is no index where one is asked for."""


class IndexConflict(RuntimeError):
    """Another writer has published the version that this one was about to."""


def _bucket(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)).cast("int")


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, path: str) -> list[int]:
    """The published versions of an index, the oldest first."""
    fs, at = _fs(spark, f"{path}/_versions")
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "_")


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """What a version (the newest) consists of: its schema, key, number of buckets and the folder of each bucket that has rows."""
    known = versions(spark, path)
    if not known or version is not None and version not in known:
        raise IndexMissing(f"no index at {path}" if not known else f"no version {version} of the index at {path}")
    fs, at = _fs(spark, f"{path}/_versions/{version if version is not None else known[-1]:09}.json")
    stream = fs.open(at)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, made: dict) -> None:
    """The manifest under its version's name, whole or not at all; a version that is there already is another writer's."""
    fs, at = _fs(spark, f"{path}/_versions/_{uuid.uuid4().hex}")
    out = fs.create(at, False)
    out.write(bytearray(json.dumps(made).encode()))
    out.close()
    _, final = _fs(spark, f"{path}/_versions/{made['version']:09}.json")
    if fs.exists(final) or not fs.rename(at, final):
        fs.delete(at, False)
        raise IndexConflict(f"version {made['version']} of {path} was published by another writer")


def create(spark: SparkSession, path: str, documents: DataFrame, key: str = "chunk_id", buckets: int = BUCKETS) -> bool:
    """Makes an empty index of the documents' columns, in buckets by hash of the key, if there is none; whether it did."""
    if versions(spark, path):
        return False
    _publish(spark, path, {"version": 0, "key": key, "buckets": buckets, "schema": documents.schema.json(), "folders": {}})
    return True


def read_index(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The documents of a version of the index, the newest if none is named."""
    made = manifest(spark, path, version)
    schema = T.StructType.fromJson(json.loads(made["schema"]))
    if not made["folders"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/{f}" for f in made["folders"].values()))


def upsert(path: str, documents: DataFrame, key: str = "chunk_id", buckets: int = BUCKETS) -> int:
    """Puts documents in place of those with their keys, or beside the others; returns the version that has them.

    Keys must be there and differ. Only buckets that the documents' keys fall in are rewritten, into folders of their own;
    the version that names them is published last, so that readers see the old version or the new one, whatever ends the job in between.
    """
    spark = documents.sparkSession
    bad = documents.groupBy(key).count().filter(f"count > 1 OR `{key}` IS NULL").limit(20).collect()
    if bad:
        raise ValueError(f"rejected documents: {[r[0] for r in bad]}")
    create(spark, path, documents, key, buckets)
    made = manifest(spark, path)
    if made["key"] != key:
        raise ValueError(f"the index at {path} has the key {made['key']}, not {key}")
    known = T.StructType.fromJson(json.loads(made["schema"]))
    new = documents.withColumn("~bucket", _bucket(key, made["buckets"]))
    touched = sorted(r[0] for r in new.select("~bucket").distinct().collect())  # at most as many as there are buckets
    if not touched:
        return made["version"]
    folders = [made["folders"][str(b)] for b in touched if str(b) in made["folders"]]
    if folders:
        old = spark.read.schema(known).parquet(*(f"{path}/{f}" for f in folders)).withColumn("~bucket", _bucket(key, made["buckets"]))
        new = old.join(documents.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)
    version, folder = made["version"] + 1, f"data/{made['version'] + 1:09}-{uuid.uuid4().hex}"
    columns = [*(f.name for f in known.fields), *(c for c in documents.columns if c not in known.names)]
    out = new.select("~bucket", *(F.col(f"`{c}`") if c in new.columns else F.lit(None).cast(known[c].dataType).alias(c) for c in columns))
    out.repartition("~bucket").write.partitionBy("~bucket").parquet(f"{path}/{folder}")
    made = made | {"version": version, "schema": out.drop("~bucket").schema.json(), "folders": made["folders"] | {str(b): f"{folder}/~bucket={b}" for b in touched}}
    _publish(spark, path, made)
    return version


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Removes all but the newest versions and the folders that none of these names, of writers that failed too; how many folders went. Not while others write."""
    known = versions(spark, path)
    used = {f.split("/~bucket=")[0] for v in known[-keep:] for f in manifest(spark, path, v)["folders"].values()}
    for v in known[:-keep]:
        fs, at = _fs(spark, f"{path}/_versions/{v:09}.json")
        fs.delete(at, False)
    fs, at = _fs(spark, f"{path}/data")
    gone = [f.getPath() for f in fs.listStatus(at) if f"data/{f.getPath().getName()}" not in used] if fs.exists(at) else []
    for f in gone:
        fs.delete(f, True)
    return len(gone)


def ready(spark: SparkSession, path: str, dimension: int, vector: str = "embedding") -> DataFrame:
    """The newest version of an index, if there is one and its vectors have that dimension; IndexMissing or a ValueError before anything costly otherwise."""
    return checked_index(read_index(spark, path), dimension, vector)


def with_vectors(chunks: DataFrame, vectors: DataFrame, order: str, position: str = "pos", vector: str = "embedding") -> DataFrame:
    """chunks with the vector of their place in order (vectors: position from 0, vector).

    Another number of vectors, or positions that aren't 0 to n - 1, raise a ValueError. Chunks that tie in order share out their places.
    """
    n = chunks.count()
    seen = vectors.agg(F.count(F.lit(1)).alias("m"), F.count_distinct(position).alias("places"), F.min(position).alias("low"), F.max(position).alias("high")).first()
    if n != seen["m"]:
        raise ValueError(f"{seen['m']} vectors for {n} chunks")
    if n and (seen["places"], seen["low"], seen["high"]) != (n, 0, n - 1):
        raise ValueError(f"{n} vectors have {seen['places']} places from {seen['low']} to {seen['high']}")
    placed = numbered(chunks, [order], "~pos")
    return placed.join(vectors.select(F.col(position).alias("~pos"), F.col(vector).alias("~vector")), "~pos").select(*(F.col(f"`{c}`") for c in chunks.columns), F.col("~vector").alias(vector))


def in_batches(rows: DataFrame, order: list[str], size: int, within: list[str]) -> DataFrame:
    """rows with `batch`, size of them in each, in order, counted within groups."""
    n = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
    return rows.withColumn("batch", F.floor((n - 1) / size))


@contextmanager
def usage_log(spark: SparkSession, path: str, **facts):
    """Appends one JSON row about what is done inside, whether it succeeds or not; facts may be added to the dictionary that it gives."""
    began, outcome = time.time(), "success"
    try:
        yield facts
    except BaseException as e:
        outcome = f"failure: {type(e).__name__}"
        raise
    finally:
        row = json.dumps(facts | {"outcome": outcome, "seconds": round(time.time() - began, 3)}, default=str)
        spark.createDataFrame([(row,)], "value string").write.mode("append").text(path)
