"""What keeps work and memory in proportion to the input."""

import pyarrow as pa
from pyspark.sql import functions as F

from quillspark.operators import answering, chunking, cleaning, selection
from quillspark.operators.batches import bounded
from quillspark.plans import collected


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_citations_are_searched_once(spark):
    d = spark.createDataFrame([("민법 제1조", "의료법 제27조 x"), ("", "구 약사법 제1조, y"), ("화장품법 제2조", None), (None, "none")], "refs string, content string")
    labelled = selection.label_precedents(d, "refs", "content")
    assert plan(labelled).count("regexp_extract_all") == 2  # references, body
    got = labelled.select("domain_label", "matched_laws").collect()
    assert [(r[0], list(r[1])) for r in got] == [("candidate", ["의료법"]), ("core", ["약사법"]), ("core", ["화장품법"]), ("excluded", [])]


def test_responses_are_dealt_out(spark, tmp_path):
    spark.createDataFrame([(i, "a", "b", "c", i) for i in range(10)], "p_partkey long, p_name string, p_type string, p_brand string, p_size long").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert collected.responses(spark, str(tmp_path)).rdd.getNumPartitions() == collected.PER_CORE * spark.sparkContext.defaultParallelism


def test_batches_in_parts():
    batch = pa.record_batch([pa.array(["aaa", None, "b" * 9, "c", "d"]), pa.array(range(5))], names=["text", "n"])
    parts = [p.column("n").to_pylist() for p in bounded([batch, batch.slice(0, 0)], "text", 4)]
    assert parts == [[0, 1], [2], [3, 4], []]


def test_pieces_leave_the_text_behind(spark):
    d = spark.createDataFrame([("t", "x<br/>y")], "title string, text string")
    assert "text" not in chunking._pieces(d, lambda r: chunking.judgement_pieces(r["text"]), "ordinal int, locator string, piece string").columns


def test_models_and_references_see_no_whole_batch(spark):
    d = spark.createDataFrame([("a &lt; b",), (None,), ("c",)], "text string")
    assert "MapInArrow" in plan(answering.replied(d, lambda p, n: answering.Reply(p), 5, "text"))
    assert "MapInArrow" in plan(answering.paced(d, lambda t: [[0.0]] * len(t), 1, limit=100, tasks=2))
    shown = d.select(cleaning.html_unescape(F.col("text")).alias("t"))
    assert "contains" in plan(shown).lower()  # only what has a reference is sent
    assert sorted(r["t"] or "" for r in shown.collect()) == ["", "a < b", "c"]
