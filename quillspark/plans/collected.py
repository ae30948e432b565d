"""Queries over operators of collection: statutes, identifiers, reviews, releases, grounding.

part plays laws, whose XML responses are built here; documents, labels and
events play records, admissions and logs, as in plans.queries.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import identity as ids
from quillspark.functions import responses as rs
from quillspark.functions import text as tx
from quillspark.operators import answering, chunking, evaluation, indexing, ordering, release, retrieval, validation
from quillspark.operators import records as recs
from quillspark.plans import queries as base
from quillspark.plans.registry import query, table
from quillspark.sources import artifacts, readers
from quillspark.sources.scratch import kept, shared_folder

_ACQUIRED = "2024-01-01 00:00:00"
#: Tasks of responses for each core.
PER_CORE = 4


def responses(spark, sf) -> DataFrame:
    """For each part a law's response: a heading that is no article, an article with paragraphs, items and sub-items, one with a branch, one without text, and an appendix."""
    tag = lambda name, *inside: F.concat(F.lit(f"<{name}>"), *inside, F.lit(f"</{name}>"))
    safe = lambda c: F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    key = F.col("p_partkey").cast("string")
    header = tag("기본정보", tag("법령명_한글", safe("p_name")), tag("법종구분", safe("p_type")), tag("소관부처", F.lit("부처")), tag("공포일자", F.lit("20200101")), tag("시행일자", F.lit("20200301")), tag("법령ID", key))
    article = lambda number, kind, body, *more: tag("조문단위", tag("조문번호", F.lit(number)), tag("조문여부", F.lit(kind)), tag("조문내용", body), *more)
    paragraph = tag("항", tag("항내용", F.lit("① "), safe("p_type")), F.lit("\n"), tag("호", tag("호내용", F.lit("1. "), safe("p_brand")), tag("목", tag("목내용", F.lit(" 가. "), key))))
    body = tag("조문", article("1", "전문", F.lit("제1장 총칙")), article("1", "조문", safe("p_name"), paragraph), article("2", "조문", safe("p_brand"), tag("조문가지번호", F.lit("3")), tag("조문제목", F.lit("제목"))), article("4", "조문", F.lit("")))
    appendix = tag("별표", tag("별표단위", tag("별표번호", F.lit("0001")), tag("별표구분", F.when(F.col("p_size") % 2 == 0, "별표").otherwise("서식")), tag("별표내용", safe("p_name")), tag("별표내용", F.lit("<b>"), safe("p_brand"), F.lit("</b> 끝"))))
    # A row of part is a small fraction of its response, and its file few tasks; the responses are dealt out.
    parts = table(spark, sf, "part").repartition(PER_CORE * spark.sparkContext.defaultParallelism, "p_partkey")
    return parts.select(key.alias("MST"), tag("법령", header, body, appendix).alias("xml"))


_ARTICLES = """a AS (SELECT CAST(p_partkey AS VARCHAR) AS mst, p_name AS law, '1' AS number, '' AS branch, '' AS title, p_name || chr(10) || '① ' || p_type || chr(10) || '1. ' || p_brand || ' 가. ' || p_partkey AS content FROM part
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, '2', '3', '제목', p_brand FROM part)"""


@query(f"WITH {_ARTICLES} SELECT mst, law, number, branch, title, content FROM a")
def statute_articles(spark, sf):
    a = readers.law_articles(responses(spark, sf))
    return a.select(F.col("MST").alias("mst"), F.col("법령명").alias("law"), F.col("조문번호").alias("number"), F.col("조문가지번호").alias("branch"), F.col("조문제목").alias("title"), "content")


@query("SELECT CAST(p_partkey AS VARCHAR) AS mst, p_type AS kind, '부처' AS ministry, '20200101' AS promulgated, '20200301' AS effective, CAST(p_partkey AS VARCHAR) AS law_id, 2 AS n FROM part")
def law_headers(spark, sf):
    a = readers.law_articles(responses(spark, sf))
    fields = {"kind": "법령구분", "ministry": "소관부처", "promulgated": "공포일자", "effective": "시행일자", "law_id": "법령ID"}
    return a.groupBy(F.col("MST").alias("mst"), *(F.col(c).alias(n) for n, c in fields.items())).agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS mst, '별표 1' AS locator, p_name || chr(10) || p_brand || ' 끝' AS content, CASE WHEN p_size % 2 = 0 THEN '' ELSE 'form' END AS reason FROM part")
def statute_appendices(spark, sf):
    return readers.law_appendices(responses(spark, sf)).select(F.col("MST").alias("mst"), "locator", "content", F.coalesce("reason", F.lit("")).alias("reason"))


def _statutes(spark, sf) -> DataFrame:
    a = readers.law_articles(responses(spark, sf)).withColumn("rawArtifactPath", F.concat(F.lit("source-native/"), "MST")).withColumn("rawArtifactHash", ids.content_hash("content"))
    for missing in ("별표번호", "별표가지번호", "별표제목", "별표시행일자", "contentCleaned", "locator"):
        a = a.withColumn(missing, F.lit(None).cast("string"))
    return recs.statutes(a, F.lit(_ACQUIRED).cast("timestamp"))


_STATUTES = f"""{_ARTICLES}, s AS (SELECT 'doc-' || substr(sha256('법령' || chr(31) || mst || chr(31) || number || chr(31) || CASE WHEN branch = '' THEN '0' ELSE branch END), 1, 24) AS document_id,
    law || ' 제' || number || '조' || CASE WHEN branch = '' THEN '' ELSE '의' || branch END AS title, content, mst FROM a)"""


@query(f"WITH {_STATUTES} SELECT document_id, title, 'sha256:' || sha256(content) AS content_hash, '국가법령정보센터 ' || title || ' (MST ' || mst || ')' AS reference FROM s")
def statute_records(spark, sf):
    return _statutes(spark, sf).select(F.col("documentId").alias("document_id"), "title", F.col("contentHash").alias("content_hash"), F.col("provenance.sourceReference").alias("reference"))


@query(f"WITH {_STATUTES} SELECT document_id, title AS locator, content AS text, 'current' AS status FROM s")
def statute_chunks(spark, sf):
    """Units under the size of a chunk are one chunk each, under their title."""
    c = chunking.chunk_statutes(_statutes(spark, sf), "v1")
    return c.select("document_id", "locator", "text", "fields.status")


@query(
    """SELECT doc_id, 'doc-' || substr(sha256(concat_ws(chr(31), '법령', CAST(doc_id AS VARCHAR), CAST(n_chars AS VARCHAR), '0')), 1, 24) AS article, 'doc-' || substr(sha256(concat_ws(chr(31), '별표', CAST(doc_id AS VARCHAR), CAST(n_chars AS VARCHAR), '7')), 1, 24) AS appendix,
    'chunk-' || substr(sha256(concat_ws(chr(31), lang, source, CAST(doc_id AS VARCHAR), 'a', 'b')), 1, 24) AS chunk, 'rec-' || substr(sha256(concat_ws(chr(31), lang, source)), 1, 24) AS record FROM documents"""
)
def family_ids(spark, sf):
    d, key, n = table(spark, sf, "documents"), F.col("doc_id").cast("string"), F.col("n_chars").cast("string")
    return d.select(
        "doc_id", ids.article_id(key, n, F.lit("")).alias("article"), ids.appendix_id(key, n, F.lit("007")).alias("appendix"),
        ids.family_id("chunk", F.col("lang"), F.col("source"), key, F.lit("a"), F.lit("b")).alias("chunk"), ids.family_id("record", F.col("lang"), F.col("source")).alias("record"),
    )


@query(
    """SELECT p_partkey, '제' || p_size || '조' || CASE WHEN p_size % 3 = 0 THEN '' ELSE '의' || p_size % 3 END AS article, '별표 ' || p_size || CASE WHEN p_size % 3 = 0 THEN '' ELSE '의' || p_size % 3 END AS appendix FROM part WHERE p_size > 0"""
)
def unit_locators(spark, sf):
    p = table(spark, sf, "part").filter("p_size > 0")
    number, branch = F.format_string("%04d", "p_size"), (F.col("p_size") % 3).cast("string")
    return p.select("p_partkey", tx.article_locator(number, branch).alias("article"), tx.appendix_locator(number, branch).alias("appendix"))


@query(r"SELECT doc_id, md5(regexp_replace(text, '[\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\\]+', '', 'g')) AS digest FROM documents")
def squashed(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(tx.squash("text")).alias("digest"))


@query(
    """WITH r AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '제' || doc_id || '조 삭제' WHEN 1 THEN '제' || doc_id || '조의2 (정의) 삭제 <2020>' WHEN 2 THEN '제' || doc_id || '조 삭제된 것은 아니다' || text ELSE text END AS t FROM documents)
    SELECT doc_id, doc_id % 4 < 3 AS article, doc_id % 4 < 3 AS appendix FROM r"""
)
def deleted_units(spark, sf):
    d = table(spark, sf, "documents")
    number = F.col("doc_id").cast("string")
    t = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("제"), number, F.lit("조 삭제")))
        .when(F.col("doc_id") % 4 == 1, F.concat(F.lit("제"), number, F.lit("조의2 (정의) 삭제 <2020>")))
        .when(F.col("doc_id") % 4 == 2, F.concat(F.lit("제"), number, F.lit("조 삭제된 것은 아니다"), "text"))
        .otherwise(F.col("text"))
    )
    return d.select("doc_id", t.alias("t")).select("doc_id", tx.deleted_article("t").alias("article"), tx.deleted_appendix("t").alias("appendix"))


@query("SELECT o.o_orderkey AS serial, o.o_orderstatus AS status FROM orders o WHERE o.o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) AND o.o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity < 10)")
def pending_reviews(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "serial")
    raw = table(spark, sf, "orders").select(F.col("o_orderkey").alias("serial"), F.col("o_orderstatus").alias("status"))
    return readers.to_review(lines.filter("l_quantity > 45"), raw, lines.filter("l_quantity < 10"))


@query("SELECT doc_id, lang, n_chars FROM documents WHERE source = 'src3'")
def term_lookup(spark, sf):
    return retrieval.term_lookup(table(spark, sf, "documents"), "source", "src3", "doc_id").select("doc_id", "lang", "n_chars")


@query("WITH e AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS pos, embedding FROM embeddings) SELECT e.vec_id, CAST(f.embedding[1] AS DOUBLE) AS head FROM e JOIN e f ON f.pos = e.pos")
def vectors_by_place(spark, sf):
    """Vectors that come back from a service in the order of the chunks, joined by place."""
    e = table(spark, sf, "embeddings")
    back = ordering.numbered(e.select("vec_id", "embedding"), ["vec_id"]).select("pos", "embedding")
    return indexing.with_vectors(e.select("vec_id", "label"), back, "vec_id").select("vec_id", F.col("embedding")[0].cast("double").alias("head"))


@query("SELECT CAST(count(*) - count(DISTINCT text) AS BIGINT) AS shared FROM documents WHERE text IS NOT NULL")
def shared_groups(spark, sf):
    return validation.shared_groups(table(spark, sf, "documents").select(F.sha2("text", 256).alias("sourceGroupId")))


@query("SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS at FROM events")
def moments(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("t"))
    return e.select("event_id", F.unix_timestamp(readers.moment(F.col("t"))).alias("at"))


@query("SELECT doc_id, 'source-native/' || source || '/' || sha256(text) || '.xml' AS path, 'sha256:' || sha256(text) AS hash FROM documents")
def artifact_paths(spark, sf):
    content = F.col("text").cast("binary")
    return table(spark, sf, "documents").select("doc_id", artifacts.artifact_path(content, F.col("source")).alias("path"), artifacts.artifact_hash(content).alias("hash"))


@query("SELECT doc_id, CAST(i * 20 + 1 AS INTEGER) AS first, CAST(least(i * 20 + 20, greatest(n_chars % 97, 0)) AS INTEGER) AS last FROM documents, unnest(generate_series(0, greatest(n_chars % 97 - 1, 0) // 20)) AS t(i) WHERE n_chars % 97 > 0")
def page_ranges(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.explode(readers.page_ranges((F.col("n_chars") % 97).cast("int"))).alias("r"))
    return d.select("doc_id", F.col("r.first").alias("first"), F.col("r.last").alias("last"))


@query("SELECT doc_id, 'answered' AS status, lang AS answer, CAST(doc_id AS VARCHAR) || ',' || source AS cited FROM documents")
def parsed_answers(spark, sf):
    raw = F.concat(F.lit("```json\n"), F.to_json(F.struct(F.lit("answered").alias("status"), F.col("lang").alias("answer"), F.array(F.col("doc_id").cast("string"), "source").alias("cited_chunk_ids"))), F.lit("\n```"))
    d = table(spark, sf, "documents").select("doc_id", rs.parse_answer(raw).alias("a"))
    return d.select("doc_id", "a.status", "a.answer", F.array_join("a.cited_chunk_ids", ",").alias("cited"))


def _released(spark, sf):
    r = base.records(spark, sf)
    r = r.unionByName(r.filter(F.col("documentId").cast("long") < 20))
    files = spark.range(1).select(F.lit("a.jsonl").alias("path"), F.lit("records").alias("kind"), F.lit("sha256:0").alias("sha256"), F.lit(1).cast("long").alias("byteSize"), F.lit(7).cast("long").alias("recordCount"))
    claimed = r.filter("provenance.provider <> 'src4'")
    return r, release.manifest(claimed, files, "v1", "s1", "2024-01-01", "d", "me")


@query(
    """WITH d AS (SELECT * FROM documents UNION ALL SELECT * FROM documents WHERE doc_id < 20), f AS (
    SELECT 'warning' AS severity, 'sentinel_decision_date' AS code, count(*) AS n FROM d WHERE lang = 'fr' UNION ALL SELECT 'warning', 'body_only_judgement', count(*) FROM d WHERE lang = 'de'
    UNION ALL SELECT 'error', 'content_hash_mismatch', count(*) FROM d WHERE lang = 'es' UNION ALL SELECT 'warning', 'no_core_linkage', count(*) FROM d WHERE source = 'src2'
    UNION ALL SELECT 'error', 'duplicate_document_id', count(*) FROM documents WHERE doc_id < 20 UNION ALL SELECT 'warning', 'ungrouped_duplicate_decision', count(*) FROM documents WHERE doc_id < 20
    UNION ALL SELECT 'error', 'record_count_mismatch', 1 UNION ALL SELECT 'error', 'coverage_mismatch', 2 + count(DISTINCT source) FROM d WHERE source = 'src4' UNION ALL SELECT 'error', 'coverage_total_mismatch', 2)
    SELECT severity, code, n FROM f WHERE n > 0"""
)
def release_report(spark, sf):
    """A release whose manifest claims seven records and no provider src4, and whose records repeat some ids."""
    return validation.release_findings(*_released(spark, sf)).groupBy("severity", "code").agg(F.count(F.lit(1)).alias("n"))


def _cited(spark, sf) -> DataFrame:
    """Of each benchmark item that documents contain: an answer that cites these documents and one that doesn't exist, with its lexical hits."""
    hit = F.struct(F.col("doc").cast("string").alias("chunk_id"), "rank", F.lit("judgement").alias("document_kind"), F.array().cast("array<string>").alias("record_limitations"))
    hits = base.lexical(spark, sf).groupBy("item_id").agg(F.collect_list(hit).alias("fused"))
    cited = F.array_append(F.array_sort(F.transform("relevant", lambda d: d.cast("string"))), F.concat(F.lit("zz"), F.col("item_id").cast("string")))
    answer = F.struct(F.lit("answered").alias("status"), F.lit("x").alias("answer"), cited.alias("cited_chunk_ids"))
    return answering.grounded(base.gold(spark, sf).join(hits, "item_id").select("item_id", answer.alias("parsed"), "fused", F.col("fused").alias("known")))


@query(f"WITH {base.BM25}, {base.GOLD} SELECT g.item_id, g.doc_id FROM gold g SEMI JOIN bm ON g.item_id = bm.item_id AND g.doc_id = bm.doc_id")
def cited_semi(spark, sf):
    return _cited(spark, sf).select("item_id", F.explode("citations").alias("c")).select("item_id", F.col("c.chunk_id").cast("long").alias("doc_id"))


@query(
    f"""WITH {base.BM25}, {base.GOLD}, c AS (SELECT item_id, CAST(doc_id AS VARCHAR) AS id FROM gold UNION ALL SELECT DISTINCT item_id, 'zz' || item_id FROM gold), h AS (SELECT item_id, CAST(doc_id AS VARCHAR) AS id FROM bm),
    m AS (SELECT c.item_id, string_agg(c.id, ', ' ORDER BY c.id) FILTER (h.id IS NULL) AS gone, string_agg(c.id, ', ' ORDER BY c.id) AS every, count(h.id) AS n FROM c LEFT JOIN h ON c.item_id = h.item_id AND c.id = h.id WHERE c.item_id IN (SELECT item_id FROM bm) GROUP BY c.item_id)
    SELECT item_id, CASE WHEN n > 0 THEN 'answered' ELSE 'insufficient_evidence' END AS status,
    CASE WHEN n > 0 THEN 'Model cited unknown chunk_id(s), dropped: ' || gone ELSE 'Model claimed status=answered with zero real citations (claimed chunk_id(s) never retrieved: ' || every || ').' END AS limitation FROM m"""
)
def cited_anti(spark, sf):
    return _cited(spark, sf).select("item_id", "status", F.array_join("limitations", "|").alias("limitation"))


@query(
    """SELECT doc_id, length(text) AS tokens_in, least(length(text), 400) AS tokens_out, length(text) > 400 AS truncated, CASE WHEN length(text) <= 400 THEN left(text, 20) END AS said
    FROM documents WHERE text IS NOT NULL"""
)
def model_accounting(spark, sf):
    """What a model reads, writes and is cut off at, a call for each document; it repeats the document's start."""

    reply = answering.Reply

    def model(prompt, max_tokens):
        whole = len(prompt) <= max_tokens
        return reply(prompt[:20], len(prompt), min(len(prompt), max_tokens), "end_turn" if whole else "max_tokens")

    said = answering.replied(table(spark, sf, "documents").filter("text IS NOT NULL").select("doc_id", "text"), model, 400, "text")
    return said.select("doc_id", F.col("tokens_in"), F.col("tokens_out"), F.col("error").isNotNull().alias("truncated"), F.col("raw").alias("said"))


@query("SELECT doc_id, CAST(length(coalesce(text, '')) AS DOUBLE) AS head, length(coalesce(text, '')) AS tokens FROM documents")
def paced_vectors(spark, sf):
    """Vectors of all documents within a limit that eight tasks share; the vector of a text is its length."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    vectors = answering.paced(d, lambda texts: [[float(len(t))] for t in texts], 1, limit=10**12, tasks=8)
    return vectors.select("doc_id", F.col("embedding")[0].cast("double").alias("head"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("tokens"))


@query(
    """WITH d AS (SELECT doc_id AS pos, * FROM documents UNION ALL SELECT 1000000000 + doc_id, * FROM documents WHERE doc_id < 20), n AS (SELECT count(*) AS n, count(*) FILTER (source <> 'src4') AS c FROM d),
    p AS (SELECT source, count(*) AS n FROM d WHERE source = 'src4' GROUP BY source), f AS (
    SELECT 0 AS rule, 0 AS pos, 0 AS sub, CAST(doc_id AS VARCHAR) AS key, 'error' AS severity, 'duplicate_document_id' AS code, 'documentId appears 2 times; it must be unique' AS message, CAST(doc_id AS VARCHAR) AS document_id FROM documents WHERE doc_id < 20
    UNION ALL SELECT 1, 0, 0, CAST(doc_id AS VARCHAR), 'warning', 'ungrouped_duplicate_decision',
        'one decision (' || source || ' ' || doc_id || ' ' || CASE WHEN lang = 'fr' THEN '00010101' ELSE '20200101' END || ') in ' || doc_id || ', ' || doc_id, NULL FROM documents WHERE doc_id < 20
    UNION ALL SELECT 2, pos, 0, '', 'error', 'content_hash_mismatch', 'contentHash does not match the supplied text', CAST(doc_id AS VARCHAR) FROM d WHERE lang = 'es'
    UNION ALL SELECT 2, pos, 1, '', 'warning', 'sentinel_decision_date', 'decidedOn is the placeholder 00010101', CAST(doc_id AS VARCHAR) FROM d WHERE lang = 'fr'
    UNION ALL SELECT 2, pos, 3, '', 'warning', 'body_only_judgement', 'no summary fields; only the body is supplied', CAST(doc_id AS VARCHAR) FROM d WHERE lang = 'de'
    UNION ALL SELECT 2, pos, 4, '', 'warning', 'no_core_linkage', 'linked laws, but none of them core', CAST(doc_id AS VARCHAR) FROM d WHERE source = 'src2'
    UNION ALL SELECT 3, 0, 0, '', 'error', 'record_count_mismatch', 'manifest claims 7 record(s) across its files, but ' || n || ' were supplied', NULL FROM n WHERE n <> 7
    UNION ALL SELECT 4, 0, 0, 'judgement', 'error', 'coverage_mismatch', 'coverageByDocumentKind: judgement is claimed ' || c || ' times and supplied ' || n || ' times', NULL FROM n WHERE n <> c
    UNION ALL SELECT 5, 0, 0, source, 'error', 'coverage_mismatch', 'coverageByProvider: ' || source || ' is claimed 0 times and supplied ' || n || ' times', NULL FROM p
    UNION ALL SELECT 6, 0, 0, 'index_eligible', 'error', 'coverage_mismatch', 'coverageByUsage: index_eligible is claimed ' || c || ' times and supplied ' || n || ' times', NULL FROM n WHERE n <> c
    UNION ALL SELECT 7, 0, 0, '', 'error', 'coverage_total_mismatch', 'coverageByDocumentKind totals ' || c || ', but ' || n || ' record(s) were supplied', NULL FROM n WHERE n <> c
    UNION ALL SELECT 8, 0, 0, '', 'error', 'coverage_total_mismatch', 'coverageByUsage totals ' || c || ', but ' || n || ' record(s) were supplied', NULL FROM n WHERE n <> c)
    SELECT row_number() OVER (ORDER BY rule, pos, sub, key) - 1 AS place, severity, code, message, document_id FROM f"""
)
def ordered_release(spark, sf):
    """The findings of that release in the order in which the rules report them, with messages and documents."""
    r = base.records(spark, sf).withColumn("pos", F.col("documentId").cast("long"))
    r = r.unionByName(r.filter("pos < 20").withColumn("pos", F.col("pos") + 1_000_000_000))
    return validation.ordered_findings(r, _released(spark, sf)[1])


@query(
    f"""WITH {base.BM25}, {base.GOLD}, r AS (SELECT g.item_id, min(b.rank) AS first FROM gold g LEFT JOIN bm b ON g.item_id = b.item_id AND g.doc_id = b.doc_id AND b.rank <= 10 GROUP BY g.item_id)
    SELECT avg(CASE WHEN first IS NULL THEN 0.0 ELSE 1.0 END) AS recall, avg(coalesce(1.0 / first, 0.0)) AS mrr, count(*) AS n, count(*) AS questions, CAST(sum(item_id) AS BIGINT) AS ids FROM r"""
)
def evaluation_document(spark, sf):
    """An evaluation written as one JSON document and read back: its aggregate, and how many questions it lists."""
    scores = kept(evaluation.scored(base.gold(spark, sf), base.lexical(spark, sf), "item_id"), "scores")
    path = f"{shared_folder(spark)}/quillspark/evaluation-{uuid.uuid4().hex}"
    evaluation.write_document(path, {"aggregate": evaluation.recall_mrr(scores)}, {"per_question": (scores.select("item_id", "hit", "rr"), ["item_id"])})
    whole = evaluation.read_document(spark, path, "aggregate struct<recall:double,mrr:double,n:long>, per_question array<struct<item_id:long,hit:double,rr:double>>")
    ids = F.aggregate("per_question", F.lit(0).cast("long"), lambda s, q: s + q["item_id"])
    return whole.select("aggregate.*", F.size("per_question").cast("long").alias("questions"), ids.alias("ids"))
