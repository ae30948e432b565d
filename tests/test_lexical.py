"""The kept lexical index against the ranking that reads all documents."""

import random

import pytest
from pyspark.sql import functions as F

from quillspark.operators import lexical, retrieval


def corpus(spark, n=300):
    r = random.Random(4)
    words = [f"w{int(r.paretovariate(0.7)) % 400}" for _ in range(5000)]
    rows = [(i, " ".join(r.choices(words, k=r.randrange(0, 60))), r.choice(["w1 w2", "w7", "", None])) for i in range(n)]
    rows += [(n, None, None), (n + 1, "", ""), (n + 2, "only here: zebra", None), (n + 3, rows[5][1], rows[5][2])]
    return spark.createDataFrame(rows, "doc long, text string, title string")


def asked(spark):
    return spark.createDataFrame([(1, "w1 w2 w3 w1"), (2, "Zebra!"), (3, "nothing known"), (4, None), (5, "w7 w9 w11 w13 w15 w17 w19 zebra"), (6, "w1")], "question int, text string")


@pytest.mark.parametrize("boosts", [{"text": 1.0}, {"text": 1.0, "title": 0.5}])
@pytest.mark.parametrize("k", [3, 50])
def test_same_hits_as_reading_all(spark, tmp_path, boosts, k):
    docs, q = corpus(spark), asked(spark)
    path = str(tmp_path / "index")
    lexical.build(docs, path, boosts=boosts, size=4)
    found = lexical.Search(q, path, k=k)
    want = retrieval.bm25(q, docs, boosts=boosts, k=k)
    assert found.hits.columns == want.columns
    assert sorted(map(tuple, found.hits.collect())) == sorted(map(tuple, want.collect()))
    share = found.read_share().first()
    assert share["questions_read"] <= share["questions_met"] and share["batch_read"] <= share["batch_met"] <= share["postings"]
    if k == 3:
        assert share["questions_read"] < share["questions_met"]


def test_ids_missing_indexes_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "index")
    with pytest.raises(FileNotFoundError):
        lexical.Search(asked(spark), path)
    with pytest.raises(ValueError, match="missing or repeat"):
        lexical.build(corpus(spark).withColumn("doc", F.lit(1)), path)
    lexical.build(corpus(spark).limit(0), path)
    assert lexical.Search(asked(spark), path).hits.count() == 0
    with pytest.raises(FileExistsError):
        lexical.build(corpus(spark), path)


def test_no_posting_is_shuffled(spark):
    docs, q = corpus(spark), asked(spark)
    plan = retrieval.bm25(q, docs, k=3)._jdf.queryExecution().optimizedPlan().toString()
    # What is ranked comes from a pass over the documents that keeps k rows of a question: no aggregation by document.
    assert "MapInArrow" in plan and "Aggregate" not in plan


def test_rows_of_one_id_ties_and_no_questions(spark):
    docs = spark.createDataFrame([(2, "cat dog"), (1, "cat dog"), (3, "cat"), (3, "cat"), (None, "dog dog dog")], "doc int, text string")
    q = spark.createDataFrame([("a", "cat dog"), ("b", "?")], "question string, text string")
    hits = retrieval.bm25(q, docs).orderBy("rank").collect()
    assert sorted(h["doc"] for h in hits if h["doc"] is not None) == [1, 2, 3] and len(hits) == 4
    assert [h["doc"] for h in hits if h["doc"] in (1, 2)] == [1, 2]
    assert retrieval.bm25(q.limit(0), docs).count() == 0


def test_questions_in_blocks(spark, monkeypatch):
    docs, q = corpus(spark, 60), asked(spark)
    want = sorted(map(tuple, retrieval.bm25(q, docs, k=3).collect()))
    monkeypatch.setattr(retrieval, "FEW", 3)
    monkeypatch.setattr(retrieval, "CELLS", 7)
    assert sorted(map(tuple, retrieval.bm25(q, docs, k=3).collect())) == want


def test_postings_are_not_shuffled_one_by_one(spark, tmp_path):
    path = str(tmp_path / "index")
    lexical.build(corpus(spark), path, size=4)
    found = lexical.Search(asked(spark), path, k=3)
    plan = found.hits._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Aggregate" not in plan  # a task sums up and keeps k rows of a question
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.filter("n > 4 OR size(docs) <> n").count() == 0 and "w" not in blocks.columns
