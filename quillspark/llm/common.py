"""What the operators of this subpackage share: reading, scratch tables, hashing."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session.

    Only where that is unset and the master is local, as in tests, a temporary folder is made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='quillspark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


#: Scratch tables written in this process and not removed yet.
_WRITTEN: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table of the shared folder: lineage ends there, and a lost executor costs no more than the reader's own tasks."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/quillspark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """Removes the scratch tables written inside it when it ends; results that read them must be written by then."""
    first = len(_WRITTEN)
    try:
        yield
    finally:
        remove(spark, _WRITTEN[first:])
        del _WRITTEN[first:]


def remove(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def crc32_mod(column, mod: int):
    """crc32 of the column as text, modulo mod; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod


def crc32_of(value, mod: int) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode()) % mod


def mix64(x):
    """A bijective finaliser on numpy uint64 arrays, in place."""
    import numpy as np

    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class WordHashes(dict):
    """Word (bytes) to a stable 64-bit hash; forgets all once it holds `most` words."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word):
        import xxhash

        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h
