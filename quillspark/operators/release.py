"""Release manifests, verification reports and reproducible archives."""

from __future__ import annotations

import gzip
import hashlib
import io
import tarfile
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators import validation

#: Time of every archive entry: the start of 2020, UTC.
STAMP = 1577836800


def manifest(records: DataFrame, files: DataFrame, version: str, schema_version: str, frozen_at: str, delivery: str, by: str) -> DataFrame:
    """One manifest row: coverage counted from records, files (path, kind, sha256, byteSize, recordCount) in order."""
    in_order = lambda *cols: F.sort_array(F.collect_list(F.struct(*cols)))
    out = files.agg(in_order("path", "kind", "sha256", "byteSize", "recordCount").alias("files"))
    for axis, key in validation.AXES.items():
        out = out.crossJoin(validation.coverage(records, F.col(key)).agg(in_order("key", "recordCount").alias(f"coverageBy{axis}")))  # one row each
    constants = {"datasetVersion": version, "schemaVersion": schema_version, "deliveryId": delivery, "deliveredBy": by}
    return out.select(
        *(F.lit(v).alias(k) for k, v in constants.items()),
        F.lit(frozen_at).cast("timestamp").alias("frozenAt"),
        "*",
        F.array().cast("array<struct<subject:string,included:boolean,reason:string>>").alias("dispositions"),
        F.array().cast("array<struct<subject:string,terms:string,attributionRequired:boolean,restrictedUse:boolean>>").alias("licences"),
        F.array().cast("array<string>").alias("knownGaps"),
    )


def total_records(m: DataFrame) -> DataFrame:
    return m.select(F.explode("files").alias("f")).agg(F.sum(F.when(F.col("f.kind") == "records", F.col("f.recordCount")).otherwise(0)).alias("total_records"))


def report(records: DataFrame, m: DataFrame, chunks: DataFrame) -> DataFrame:
    """(measure, n): findings by code, sizes of the corpus, chunks by type."""
    parts = [
        validation.summary(validation.release_findings(records, m)).select(F.concat(F.lit("finding "), "code").alias("measure"), "n"),
        records.groupBy("inDefaultCorpus").agg(F.count(F.lit(1)).alias("n")).select(F.when(F.col("inDefaultCorpus"), "default corpus").otherwise("outside").alias("measure"), "n"),
        chunks.groupBy("chunk_type").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("chunks "), "chunk_type").alias("measure"), "n"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def tar_bytes(files: dict[str, bytes]) -> bytes:
    """A .tar.gz whose bytes depend only on names and contents."""
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", mtime=0) as z, tarfile.open(fileobj=z, mode="w", format=tarfile.PAX_FORMAT) as tar:
        for name in sorted(files):
            info = tarfile.TarInfo(name)
            info.size, info.mtime, info.mode = len(files[name]), STAMP, 0o644
            tar.addfile(info, io.BytesIO(files[name]))
    return out.getvalue()


def zip_bytes(files: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(files):
            info = zipfile.ZipInfo(name, (2020, 1, 1, 0, 0, 0))
            info.compress_type, info.external_attr = zipfile.ZIP_DEFLATED, 0o644 << 16
            z.writestr(info, files[name])
    return out.getvalue()


def checksums(files: dict[str, bytes]) -> str:
    return "".join(f"{hashlib.sha256(files[n]).hexdigest()}  {n}\n" for n in sorted(files))
