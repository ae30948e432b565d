"""Tables that a job writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset and the master is local, as in tests, a temporary folder is made and set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='quillspark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read from there: its lineage ends, and every reading sees the same rows in the same files."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quillspark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def cleaned(spark: SparkSession):
    """Removes what kept() wrote inside it; results that read it must be written by then."""
    first = len(_WRITTEN)
    try:
        yield
    finally:
        for path in _WRITTEN[first:]:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        del _WRITTEN[first:]
