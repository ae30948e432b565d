"""Commands for spark-submit: validate, chunk, index, search, label."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quillspark.operators import chunking, indexing, retrieval, selection, validation
from quillspark.sources import readers, schemas


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quillspark", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, args in {
        "validate": ["records", "manifest"],
        "chunk": ["records", "out", "--version"],
        "index": ["chunks", "index"],
        "search": ["questions", "index", "out"],
        "label": ["rows", "out"],
    }.items():
        sub = commands.add_parser(name)
        for a in args:
            sub.add_argument(a, **({"default": "v1"} if a == "--version" else {}))
    o = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if o.command == "validate":
        records = validation.checked(schemas.read_records(spark, [o.records]))
        manifest = spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(o.manifest)
        findings = validation.release_findings(records, manifest)
        validation.summary(findings).orderBy("code").show(100, False)
        return int(not findings.filter("severity = 'error'").isEmpty())
    if o.command == "chunk":
        records = validation.records_for_index(schemas.read_records(spark, [o.records]), [])
        docs = chunking.index_documents(chunking.chunk_judgements(records, o.version)).unionByName(chunking.index_documents(chunking.chunk_statutes(records, o.version)), allowMissingColumns=True)
        docs.write.mode("overwrite").parquet(o.out)
    elif o.command == "index":
        docs = spark.read.parquet(o.chunks)
        indexing.create(spark, o.index, docs)
        indexing.upsert(o.index, docs)
    elif o.command == "search":
        docs = indexing.read_index(spark, o.index).withColumn("doc", F.col("chunk_id"))
        questions = readers.read_questions(spark, o.questions, None).select("id", F.col("question").alias("text"))
        boosts = {f: b for f, b in retrieval.BOOSTS.items() if f in docs.columns}
        retrieval.bm25(questions, docs, "id", "text", "doc", boosts).write.mode("overwrite").parquet(o.out)
    else:
        rows = spark.read.json(o.rows)
        readers.write_by_label(selection.label_precedents(rows), o.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
