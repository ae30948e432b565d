"""Queries beside their SQL, the pipeline stage by stage, and what they leave alone."""

import os
import re

import pytest

from quillspark.llm import queries, sql

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def canonical(rows, columns):
    show = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[c]) for c in sorted(columns)) for r in rows)


@pytest.mark.parametrize("name", sorted(sql.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    want = c.execute(sql.ORACLE_SQL[name]).df()
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical((r.asDict() for r in got.collect()), got.columns) == canonical(want.astype(object).where(want.notna(), None).to_dict("records"), got.columns)


def test_pipeline(spark):
    import corpus_pipeline as P
    from quillspark.llm import decontamination, minhash, secrets, toxicity

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    at = docs
    for name, stage in P.STAGES[:-1]:
        before, at = at, spark.createDataFrame(stage(spark, at, SF).collect(), docs.schema)
        assert at.columns == docs.columns
        ids = {r["doc_id"] for r in at.collect()}
        if name == "toxicity":
            assert ids == {r["doc_id"] for r in toxicity.toxicity(before, labels).filter("predicted = 0").collect()}
        elif name == "minhash_near_dedup":
            classes = minhash.near_duplicates(before).collect()
            assert ids == {r["class_id"] for r in classes}
        elif name == "benchmark_decontamination":
            assert ids == {r["doc_id"] for r in decontamination.contamination(before, bench).filter("not contaminated").collect()}
        else:
            assert ids == {r["doc_id"] for r in before.collect()}
            assert not any(secrets.base_spans(r["text"]) for r in at.collect())
    out = P.run(spark, SF)
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in at.collect()}


def test_no_cross_joins_or_local_checkpoints():
    import pathlib

    for f in pathlib.Path(queries.__file__).parent.glob("*.py"):
        text = f.read_text()
        assert "localCheckpoint" not in text
        for line in text.splitlines():
            assert not re.search(r"crossJoin", line) or "one row" in line


def test_pipeline_of_no_documents(spark, tmp_path):
    """Every stage takes an empty table, and labels and a benchmark that are empty too."""
    import corpus_pipeline as P

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    out = P.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == spark.read.parquet(f"{SF}/documents.parquet").columns
