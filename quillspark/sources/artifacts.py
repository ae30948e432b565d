"""Raw responses as files whose names are their contents' hashes, written by tasks."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.sources.readers import publish
from quillspark.sources.scratch import kept

# Fixed value: the folder of artifacts beside the collected rows.
FOLDER = "source-native"
STAGING = "_staging"


class CorruptArtifact(RuntimeError):
    """The file of a hash holds something else."""


def artifact_hash(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def artifact_path(content: Column, kind: Column | str, suffix: str = ".xml") -> Column:
    """Where the artifact of a kind of response is, under the folder of what is collected."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(F.lit(f"{FOLDER}/"), kind, F.lit("/"), F.sha2(content, 256), F.lit(suffix))


def opened(root: str):
    """(files, base): the store of a folder that tasks reach by themselves, and the folder in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def read_whole(files, path: str) -> bytes | None:
    """What a file holds, or None if there is none."""
    from pyarrow import fs

    if files.get_file_info(path).type == fs.FileType.NotFound:
        return None
    with files.open_input_stream(path) as f:
        return f.read()


def write_whole(files, base: str, path: str, content: bytes) -> None:
    """A file under base that has its name when it is whole; one that ends early leaves nothing under it."""
    final, part = f"{base}/{path}", f"{base}/{STAGING}/{uuid.uuid4().hex}"
    for name in (final, part):
        files.create_dir(name.rpartition("/")[0], recursive=True)
    with files.open_output_stream(part) as f:
        f.write(content)
    files.move(part, final)


def _store(root: str):
    """(row, stored): writes the rows' files that aren't there."""

    def run(batches):
        import pyarrow as pa

        files, base = opened(root)
        for batch in batches:
            stored = []
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                path, content = path.as_py(), content.as_py()
                if content is None:
                    raise ValueError("an artifact without content")
                there = read_whole(files, f"{base}/{path}")
                if there is None:
                    write_whole(files, base, path, content)  # another attempt's file of this name has the same content
                elif hashlib.sha256(there).digest() != hashlib.sha256(content).digest():
                    raise CorruptArtifact(f"{path} holds something else")
                stored.append(there is None)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(stored, pa.bool_())], names=["row", "stored"])

    return run


def collect_to(rows: DataFrame, root: str, name: str, content: str = "raw", kind: str = "precedent", complete: bool = True) -> dict:
    """Publishes rows as root/name (JSON lines) and the responses that they come from (column content) as artifacts, with rawArtifactPath and rawArtifactHash in place of the content.

    Tasks write the artifacts, whole or not at all, and may run again; the driver publishes the rows when all are there, so no published row
    names a missing file. Artifacts that are there stay, one that holds something else raises, and so does an incomplete collection, before anything is written.
    Gives the numbers of rows, artifacts named and files written. root is a folder that driver and executors share.
    """
    if not complete:
        raise ValueError("an incomplete collection is not published")
    spark = rows.sparkSession
    body = F.col(content).cast("binary")
    named = kept(rows.select(*(c for c in rows.columns if c != content), artifact_path(body, kind).alias("rawArtifactPath"), artifact_hash(body).alias("rawArtifactHash"), body.alias("~content")), "collected")
    stored = kept(named.select(F.lit(1).alias("row"), F.col("rawArtifactPath").alias("path"), F.col("~content").alias("content")).mapInArrow(_store(root), "row int, stored boolean"), "stored")
    counts = stored.agg(F.count(F.lit(1)).alias("rows"), F.count_if("stored").alias("written")).first()
    publish(named.drop("~content"), f"{root}/{name}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{STAGING}")
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return {"rows": counts["rows"], "artifacts": named.select("rawArtifactPath").distinct().count(), "written": counts["written"]}
