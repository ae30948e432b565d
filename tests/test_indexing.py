"""Places in one order, vectors by place, and the index in buckets and versions."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from quillspark.operators import indexing, ordering, retrieval


def test_vectors_of_many_shuffled_chunks(spark):
    """More rows than the sample that bounds of ranges are drawn from."""
    n = 400_000
    chunks = spark.range(n).select(F.format_string("c%09d", F.col("id")).alias("chunk_id"), F.col("id").alias("n")).repartition(7)
    vectors = spark.range(n).select(F.col("id").alias("pos"), F.array(F.col("id").cast("double")).alias("embedding")).repartition(5)
    got = indexing.with_vectors(chunks, vectors, "chunk_id")
    assert got.columns == ["chunk_id", "n", "embedding"]
    seen = got.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("n").alias("chunks"), F.count_if(F.col("embedding")[0] == F.col("n")).alias("right")).first()
    assert tuple(seen) == (n, n, n)


def test_wrong_vectors_raise(spark):
    chunks = spark.range(3).select(F.col("id").alias("chunk_id"))
    with pytest.raises(ValueError, match="2 vectors for 3"):
        indexing.with_vectors(chunks, spark.createDataFrame([(0, [1.0]), (1, [1.0])], "pos long, embedding array<double>"), "chunk_id")
    with pytest.raises(ValueError, match="2 places"):
        indexing.with_vectors(chunks, spark.createDataFrame([(0, [1.0]), (1, [1.0]), (1, [2.0])], "pos long, embedding array<double>"), "chunk_id")
    with pytest.raises(ValueError, match="1 to 3"):
        indexing.with_vectors(chunks, spark.createDataFrame([(1, [1.0]), (2, [1.0]), (3, [2.0])], "pos long, embedding array<double>"), "chunk_id")


def test_numbered_with_ties_nulls_and_clashing_names(spark):
    rows = [(None, 1), (2, 2), (2, 3), (1, 4), (None, 5)] * 20
    got = ordering.numbered(spark.createDataFrame(rows, "`a b` int, n int").repartition(6), [F.col("`a b`").desc_nulls_first()], "place", start=1).collect()
    assert sorted(r["place"] for r in got) == list(range(1, 101))
    assert [r["a b"] for r in sorted(got, key=lambda r: r["place"])] == [None] * 40 + [2] * 40 + [1] * 20
    assert ordering.numbered(spark.range(0), ["id"]).count() == 0


def docs(spark, rows):
    return spark.createDataFrame(rows, "chunk_id string, text string")


def folders(spark, path, version=None):
    return indexing.manifest(spark, path, version)["folders"]


def test_an_upsert_rewrites_its_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [(f"k{i}", f"t{i}") for i in range(200)]
    assert indexing.upsert(path, docs(spark, rows), buckets=8) == 1
    first = folders(spark, path)
    assert len(first) == 8
    assert indexing.upsert(path, docs(spark, [("k7", "new")])) == 2
    second = folders(spark, path)
    assert sum(first[b] != second[b] for b in first) == 1
    want = dict(rows) | {"k7": "new"}
    assert {r["chunk_id"]: r["text"] for r in indexing.read_index(spark, path).collect()} == want
    assert {r["chunk_id"]: r["text"] for r in indexing.read_index(spark, path, 1).collect()} == dict(rows)
    indexing.upsert(path, docs(spark, [("new", None)]).withColumn("more", F.lit(3)))
    got = {r["chunk_id"]: (r["text"], r["more"]) for r in indexing.read_index(spark, path).collect()}
    assert got["new"] == (None, 3) and got["k7"] == ("new", None) and len(got) == 201
    assert indexing.upsert(path, docs(spark, [])) == 3
    assert indexing.vacuum(spark, path) >= 0
    assert indexing.versions(spark, path) == [3] and indexing.read_index(spark, path).count() == 201
    with pytest.raises(indexing.IndexMissing):
        indexing.read_index(spark, path, 1)


def test_a_crash_between_steps_leaves_a_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    indexing.upsert(path, docs(spark, [("a", "1"), ("b", "2")]), buckets=4)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(indexing, "_publish", crash)
        with pytest.raises(OSError):
            indexing.upsert(path, docs(spark, [("a", "changed"), ("c", "3")]))
    assert {tuple(r) for r in indexing.read_index(spark, path).collect()} == {("a", "1"), ("b", "2")}
    assert indexing.vacuum(spark, path) == 1
    assert {tuple(r) for r in indexing.read_index(spark, path).collect()} == {("a", "1"), ("b", "2")}
    indexing.upsert(path, docs(spark, [("a", "changed"), ("c", "3")]))
    assert {tuple(r) for r in indexing.read_index(spark, path).collect()} == {("a", "changed"), ("b", "2"), ("c", "3")}


def test_another_writer_wins_or_loses_whole(spark, tmp_path):
    path = str(tmp_path / "index")
    indexing.upsert(path, docs(spark, [("a", "1")]), buckets=2)
    made = indexing.manifest(spark, path)
    with pytest.raises(indexing.IndexConflict):
        indexing._publish(spark, path, made)
    assert not [f for f in os.listdir(f"{path}/_versions") if f.startswith("_")]
    assert json.loads(open(f"{path}/_versions/000000001.json").read()) == made


def test_readiness_meets_a_missing_index(spark, tmp_path):
    path = str(tmp_path / "none")
    with pytest.raises(indexing.IndexMissing):
        indexing.ready(spark, path, 2)
    assert indexing.create(spark, path, spark.createDataFrame([], "chunk_id string, embedding array<float>"))
    assert indexing.ready(spark, path, 2).count() == 0
    indexing.upsert(path, spark.createDataFrame([("a", [1.0, 2.0])], "chunk_id string, embedding array<float>"))
    assert indexing.ready(spark, path, 2).count() == 1
    with pytest.raises(ValueError, match="3 are expected"):
        indexing.ready(spark, path, 3)
    with pytest.raises(ValueError, match="has the key"):
        indexing.upsert(path, spark.createDataFrame([("b",)], "other string"), key="other")
