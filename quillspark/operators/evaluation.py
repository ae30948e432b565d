"""Retrieval and answer metrics over whole result tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.operators.ordering import numbered
from quillspark.sources.readers import replace_folder

CURVE = (1, 3, 5, 10, 20)


def scored(questions: DataFrame, ranked: DataFrame, question: str = "question", doc: str = "doc", k: int = 10) -> DataFrame:
    """questions (question, relevant) with hit (0 or 1) and reciprocal rank within the first k."""
    best = (
        ranked.filter(F.col("rank") <= k)
        .join(questions.select(question, F.explode("relevant").alias(doc)), [question, doc])
        .groupBy(question)
        .agg(F.min("rank").alias("~rank"))
    )
    return questions.join(best, question, "left").select(*questions.columns, F.when(F.col("~rank").isNull(), 0.0).otherwise(1.0).alias("hit"), F.coalesce(1.0 / F.col("~rank"), F.lit(0.0)).alias("rr"))


def recall_mrr(scores: DataFrame, by: list[str] = ()) -> DataFrame:
    return scores.groupBy(*by).agg(F.avg("hit").alias("recall"), F.avg("rr").alias("mrr"), F.count(F.lit(1)).alias("n"))


def document_ranks(ranked: DataFrame, documents: DataFrame, question: str = "question", doc: str = "doc") -> DataFrame:
    """(question, doc, rank) over documents instead of chunks, each where its first chunk is; documents maps doc to document_id."""
    first = ranked.join(documents.select(doc, "document_id"), doc).groupBy(question, "document_id").agg(F.min("rank").alias("~first"))
    w = Window.partitionBy(question).orderBy("~first", "document_id")
    return first.select(question, F.col("document_id").alias(doc), F.row_number().over(w).alias("rank"))


def recall_curve(questions: DataFrame, ranked: DataFrame, question: str = "question", doc: str = "doc", ks: tuple[int, ...] = CURVE) -> DataFrame:
    """(k, recall): of one aggregation over the first relevant rank of each question."""
    first = ranked.join(questions.select(question, F.explode("relevant").alias(doc)), [question, doc]).groupBy(question).agg(F.min("rank").alias("~rank"))
    rows = questions.join(first, question, "left").agg(*(F.avg(F.when(F.col("~rank") <= k, 1.0).otherwise(0.0)).alias(f"k{k}") for k in ks))
    return rows.select(F.inline(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("recall")) for k in ks))))


def either_retriever(questions: DataFrame, lists: list[DataFrame], question: str = "question", doc: str = "doc", k: int = 50) -> DataFrame:
    """(recall): share of the questions that any of the lists answers within k."""
    every = None
    for r in lists:
        part = r.filter(F.col("rank") <= k).select(question, doc)
        every = part if every is None else every.unionByName(part)
    found = every.join(questions.select(question, F.explode("relevant").alias(doc)), [question, doc], "left_semi").select(question).distinct()
    n = questions.join(found.withColumn("~f", F.lit(1.0)), question, "left")
    return n.agg(F.avg(F.coalesce("~f", F.lit(0.0))).alias("recall"))


def overlap(questions: DataFrame, chunks: DataFrame, question: str = "question", text: str = "text", source: str = "source_chunk_id", chunk: str = "chunk_id", high: float = 0.5) -> DataFrame:
    """(question, ratio, high_overlap) of each question with its source chunk; one without source is left out."""
    joined = questions.select(question, F.col(text).alias("~q"), F.col(source).alias("~c")).join(chunks.select(F.col(chunk).alias("~c"), F.col(text).alias("~t")), "~c")
    return joined.select(question, tx.bigram_overlap("~q", "~t").alias("ratio")).withColumn("high_overlap", F.col("ratio") > high)


def answer_metrics(results: DataFrame, usd_in: float = 3.0, usd_out: float = 15.0) -> DataFrame:
    """One row over results (expected_status, status, limitations, grounding, judge_error, tokens_in, tokens_out)."""
    right = F.col("status") == F.col("expected_status")
    of = lambda s: F.col("expected_status") == s
    rate = lambda s: F.avg(F.when(of(s), right.cast("double")))
    verdict = lambda v: F.count_if(F.col("grounding") == v)
    return results.agg(
        F.count(F.lit(1)).alias("question_count"),
        rate("answered").alias("answered_status_match_rate"),
        rate("insufficient_evidence").alias("insufficient_evidence_refusal_accuracy"),
        rate("out_of_scope").alias("out_of_scope_refusal_accuracy"),
        F.count_if(of("insufficient_evidence") & (F.col("status") == "out_of_scope")).alias("insufficient_evidence_misclassified_as_out_of_scope"),
        F.count_if(of("insufficient_evidence") & (F.col("status") == "answered")).alias("insufficient_evidence_misclassified_as_answered"),
        F.count_if(of("answered") & ~right).alias("false_refusal_count"),
        F.count_if(F.col("status") == "dependency_unavailable").alias("dependency_unavailable_count"),
        F.count_if(F.size(F.coalesce("limitations", F.array().cast("array<string>"))) > 0).alias("limitations_fired_count"),
        F.count("grounding").alias("judged_answer_count"),
        verdict("grounded").alias("grounded_count"),
        verdict("partially_grounded").alias("partially_grounded_count"),
        verdict("unsupported").alias("unsupported_count"),
        F.count("judge_error").alias("judge_parse_error_count"),
        F.sum("tokens_in").alias("input_tokens"),
        F.sum("tokens_out").alias("output_tokens"),
        tx.token_cost(F.sum("tokens_in"), F.sum("tokens_out"), usd_in, usd_out).alias("estimated_cost_usd"),
    )


def latencies(results: DataFrame, column: str = "latency_ms") -> DataFrame:
    q = F.percentile(column, F.array(*map(F.lit, (0.5, 0.95, 0.99))))
    return results.agg(F.min(column).alias("min"), q.alias("~q"), F.max(column).alias("max")).select("min", *(F.col("~q")[i].alias(n) for i, n in enumerate(("p50", "p95", "p99"))), "max")


def write_document(path: str, parts: dict[str, DataFrame], lists: dict[str, tuple[DataFrame, list]]) -> None:
    """One JSON document in a folder of text files that are its pieces in order: an object for each part (a table of one row), then an array for each list (rows, order).

    Lists are written by as many tasks as they have ranges, each row a line, so nothing is gathered in one place; concatenated in the order of
    their names, the files are the document. Nulls are written. A part of another number of rows raises. The new document takes the old one's
    place when it is whole.
    """
    lines, names = None, [*parts, *lists]
    if not names:
        raise ValueError("a document needs a part or a list")

    def add(df: DataFrame) -> None:
        nonlocal lines
        lines = df if lines is None else lines.unionByName(df)

    spark = None
    piece = lambda df, section, at, text: df.select(F.lit(section).alias("section"), at.cast("long").alias("at"), text.alias("value"))
    as_json = lambda df: F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"})
    for i, name in enumerate(names):
        head = ("{" if i == 0 else ",") + json.dumps(name, ensure_ascii=False) + ":"
        if name in parts:
            df = parts[name]
            spark = df.sparkSession
            rows = df.limit(2).collect()
            if len(rows) != 1:
                raise ValueError(f"{name} must have one row")
            one = spark.createDataFrame(rows, df.schema)
            add(piece(one, 2 * i, F.lit(0), F.concat(F.lit(head), as_json(one))))
        else:
            df, order = lists[name]
            spark = df.sparkSession
            placed = numbered(df, order, "~place")
            add(piece(spark.range(1), 2 * i, F.lit(-1), F.lit(head + "[")))
            comma = F.when(F.col("~place") > 0, ",").otherwise("")
            add(piece(placed, 2 * i, F.col("~place"), F.concat(comma, as_json(df))))
            add(piece(spark.range(1), 2 * i + 1, F.lit(0), F.lit("]")))
    add(piece(spark.range(1), 2 * len(names), F.lit(0), F.lit("}")))
    lines.orderBy("section", "at").select("value").write.mode("overwrite").text(f"{path}.staging")
    replace_folder(spark, f"{path}.staging", path)


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A document that write_document wrote, as one row; for documents that fit a row."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    whole = files.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("file", "value"))), lambda f: f["value"]), "").alias("value"))
    return whole.select(F.from_json("value", schema).alias("d")).select("d.*")
