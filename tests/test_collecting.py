"""Artifacts written by tasks, findings in order, evaluation documents, nearest vectors."""

import hashlib
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from quillspark.operators import evaluation, retrieval, selection, validation
from quillspark.plans import queries as plans
from quillspark.sources import artifacts, readers, services

SF = "/root/testdata/sf0.001"


def files(root):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if not f.endswith(".crc")}


def test_artifacts_are_whole_and_named_by_content(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.createDataFrame([(i, f"<x>{i % 3}</x>", "kept") for i in range(12)], "serial int, raw string, path string").repartition(4)
    made = artifacts.collect_to(rows, root, "cases")
    assert made["rows"] == 12 and made["artifacts"] == 3 and made["written"] >= 3
    want = {f"source-native/precedent/{hashlib.sha256(f'<x>{i}</x>'.encode()).hexdigest()}.xml" for i in range(3)}
    assert {f for f in files(root) if f.startswith("source-native")} == want and not os.path.exists(f"{root}/_staging")
    got = spark.read.json(f"{root}/cases").collect()
    assert len(got) == 12
    for r in got:
        content = open(f"{root}/{r['rawArtifactPath']}", "rb").read()
        assert content == f"<x>{r['serial'] % 3}</x>".encode() and r["rawArtifactHash"] == "sha256:" + hashlib.sha256(content).hexdigest() and r["path"] == "kept"
    assert artifacts.collect_to(rows, root, "cases")["written"] == 0


def test_a_task_that_ends_early_leaves_no_half_file(spark, tmp_path):
    root = str(tmp_path / "out")
    good = spark.createDataFrame([(1, "<a/>")], "serial int, raw string")
    artifacts.collect_to(good, root, "cases")
    bad = spark.createDataFrame([(2, "<b/>"), (3, None)], "serial int, raw string").coalesce(1)
    with pytest.raises(Exception, match="without content"):
        artifacts.collect_to(bad, root, "cases")
    assert [r["serial"] for r in spark.read.json(f"{root}/cases").collect()] == [1]
    for f in files(root):
        if f.startswith("source-native"):
            assert hashlib.sha256(open(f"{root}/{f}", "rb").read()).hexdigest() in f
    os.makedirs(f"{root}/_staging", exist_ok=True)
    with open(f"{root}/_staging/left", "w") as f:  # by a task that was killed while it wrote
        f.write("<hal")
    assert artifacts.collect_to(spark.createDataFrame([(2, "<b/>")], "serial int, raw string"), root, "cases")["artifacts"] == 1
    assert not os.path.exists(f"{root}/_staging")
    with pytest.raises(ValueError, match="incomplete"):
        artifacts.collect_to(good, root, "cases", complete=False)
    assert [r["serial"] for r in spark.read.json(f"{root}/cases").collect()] == [2]


def test_a_broken_artifact_raises(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.createDataFrame([(1, "<a/>")], "serial int, raw string")
    artifacts.collect_to(rows, root, "cases")
    path = f"{root}/source-native/precedent/{hashlib.sha256(b'<a/>').hexdigest()}.xml"
    with open(path, "w") as f:
        f.write("other")
    with pytest.raises(Exception, match="holds something else"):
        artifacts.collect_to(rows, root, "cases")


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_findings_come_in_the_order_of_rules_and_records(spark):
    r = plans.records(spark, SF).filter("CAST(documentId AS INT) < 12").withColumn("pos", -F.col("documentId").cast("long"))
    r = r.unionByName(r.filter("documentId IN ('3', '10')").withColumn("pos", F.lit(99).cast("long")))
    manifest = spark.createDataFrame([([("a", "records", "x", 1, 3)], [("judgement", 3)], [("p", 1)], [("index_eligible", 14)])], "files array<struct<path:string,kind:string,sha256:string,byteSize:long,recordCount:long>>, coverageByDocumentKind array<struct<key:string,recordCount:long>>, coverageByProvider array<struct<key:string,recordCount:long>>, coverageByUsage array<struct<key:string,recordCount:long>>")
    got = validation.ordered_findings(r, manifest).orderBy("place").collect()
    assert [x["place"] for x in got] == list(range(len(got)))
    assert [(x["code"], x["document_id"]) for x in got[:2]] == [("duplicate_document_id", "10"), ("duplicate_document_id", "3")]
    assert [x["code"] for x in got[2:4]] == ["ungrouped_duplicate_decision"] * 2
    of_records = [x for x in got if x["document_id"] is not None][2:]
    places = {}
    for row in r.select("documentId", "pos").collect():
        places.setdefault(row["documentId"], []).append(row["pos"])
    seen = [max(places[x["document_id"]]) if len(places[x["document_id"]]) == 1 else None for x in of_records]
    assert [s for s in seen if s is not None] == sorted(s for s in seen if s is not None)
    tail = [x["code"] for x in got if x["document_id"] is None][2:]
    assert tail[0] == "record_count_mismatch" and tail[1] == "coverage_mismatch" and tail[-1] == "coverage_total_mismatch" and tail.count("coverage_total_mismatch") == 1
    keys = [x["message"].split(": ")[1].split(" ")[0] for x in got if x["message"].startswith("coverageByProvider")]
    assert keys == sorted(keys) and "p" in keys
    assert sorted(map(tuple, validation.release_findings(r, manifest).collect()), key=str) == sorted((tuple(x)[1:] for x in got), key=str)


def test_an_evaluation_document(spark, tmp_path):
    path = str(tmp_path / "evaluation")
    rows = spark.range(300).select(F.col("id"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") / 4).alias("rr"), F.lit('é "q"').alias("a b")).repartition(5)
    one = rows.agg(F.avg("rr").alias("mrr"), F.lit(None).cast("string").alias("note"))
    for _ in range(2):  # the second takes the first one's place
        evaluation.write_document(path, {"aggregate": one, 'per "domain"': rows.agg(F.map_from_arrays(F.array(F.lit("x")), F.array(F.lit(1))).alias("d"))}, {"per_question": (rows, [F.desc("id")]), "lexical_overlap": (rows.limit(0), ["id"])})
    text = "".join(open(f"{path}/{f}", encoding="utf-8").read() for f in sorted(os.listdir(path)) if f.startswith("part-"))
    got = json.loads(text)
    assert list(got) == ["aggregate", 'per "domain"', "per_question", "lexical_overlap"]
    assert got["per_question"] == [{"id": i, "rr": None if i % 3 == 0 else i / 4, "a b": 'é "q"'} for i in range(299, -1, -1)] and got["lexical_overlap"] == []
    assert got["aggregate"] == {"mrr": one.first()["mrr"], "note": None} and got['per "domain"'] == {"d": {"x": 1}}
    whole = evaluation.read_document(spark, path, "aggregate struct<mrr:double>, per_question array<struct<id:long>>").first()
    assert [q["id"] for q in whole["per_question"]][:2] == [299, 298]
    with pytest.raises(ValueError, match="one row"):
        evaluation.write_document(path, {"aggregate": rows}, {})


def test_nearest_of_partitions_with_ties_and_zeros(spark):
    r = random.Random(1)
    points = [[float(r.randrange(-2, 3)) for _ in range(3)] for _ in range(400)]
    v = spark.createDataFrame([(f"d{i:03}", p) for i, p in enumerate(points)] + [("none", None)], "doc string, embedding array<double>").repartition(6)
    q = spark.createDataFrame([(i, p) for i, p in enumerate(points[:9])] + [(9, [0.0, 0.0, 0.0])], "question int, embedding array<double>")
    got = {(x["question"], x["rank"]): x["doc"] for x in retrieval.knn(q, v, k=7).collect()}

    def cosine(a, b):
        import numpy as np

        a, b = np.array(a), np.array(b)
        n = np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())
        return (b * a).sum() / n if n else 0.0

    for i, p in [*enumerate(points[:9]), (9, [0.0, 0.0, 0.0])]:
        want = sorted(range(400), key=lambda j: (-cosine(p, points[j]), j))[:7]
        assert [got[i, k + 1] for k in range(7)] == [f"d{j:03}" for j in want]
    with pytest.raises(Exception, match="finite numbers"):
        retrieval.knn(q, spark.createDataFrame([("a", [1.0, None, 2.0])], "doc string, embedding array<double>")).collect()


def test_collection_details(spark):
    rows = spark.createDataFrame([("1", ""), ("2", "x")], "serial string, p string")
    known = spark.createDataFrame([("1", "b"), ("1", "a"), ("1", "")], "serial string, p string")
    assert sorted(map(tuple, readers.hydrated(rows, known, "serial", "p").collect())) == [("1", "a"), ("2", "x")]
    assert [r[0] for r in selection.allowed(rows, "p", ["x"]).select("serial").collect()] == ["1"] and selection.allowed(rows, "p") is rows
    assert spark.range(1).select(readers.page_ranges(F.lit(0)).alias("r")).first()["r"] == []
    with pytest.raises(services.IncompleteSearch, match="how many"):
        list(services.pages(lambda k, p: "<r><prec/></r>", "k"))


def test_one_row_of_a_key_stays_where_order_ties(spark):
    from quillspark.operators import cleaning

    df = spark.createDataFrame([("k", "aa", "2", 1), ("k", "bb", "1", 1), ("k", "b", "0", 0), ("z", None, None, 1)], "key string, text string, serial string, pos int")
    got = {r["serial"]: (r["kept"], r["excluded_reason"]) for r in cleaning.dedupe_by_longest(df, "key", "text", "serial", "pos").collect()}
    assert [s for s, (k, _) in got.items() if k and s] == ["1"] and "1" in got["2"][1] and got[None] == (True, None)
