"""The operators over the driver's tables.

documents play records and chunks, benchmark the questions, labels admissions,
pages marked-up sources, conversations ordered paragraphs, events a log. Every
query works on all rows and whole texts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import identity as ids
from quillspark.functions import text as tx
from quillspark.operators import answering, chunking, cleaning, containment, evaluation, retrieval, selection, validation
from quillspark.operators import lexical as lexical_index
from quillspark.plans.registry import query, table
from quillspark.sources import readers, schemas
from quillspark.sources.scratch import kept, shared_folder

TERMS = ["the", "token", "secret", "idiot", "der", "que"]
_TERM_LIST = "[" + ", ".join(f"'{t}'" for t in TERMS) + "]"


@query("SELECT doc_id, 'sha256:' || sha256(text) AS content_hash FROM documents")
def content_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", ids.content_hash("text").alias("content_hash"))


@query("SELECT doc_id, 'doc-' || substr(sha256(concat_ws(chr(31), trim(lang), trim(source), CAST(doc_id AS VARCHAR))), 1, 24) AS stable_id FROM documents")
def stable_id(spark, sf):
    return table(spark, sf, "documents").select("doc_id", ids.identifier("doc", F.col("lang"), F.col("source"), F.col("doc_id")).alias("stable_id"))


@query("SELECT min(doc_id) AS first_id, count(*) AS n, sha256(text) AS digest FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_text_groups(spark, sf):
    d = table(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("digest"))
    return d.agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")


@query(
    """SELECT doc_id, row_number() OVER w = 1 AS kept, CASE WHEN row_number() OVER w > 1 THEN '사건번호 중복(보존본: 판례일련번호 ' || first_value(doc_id) OVER w || ')' END AS excluded_reason
    FROM documents WINDOW w AS (PARTITION BY source || '/' || lang ORDER BY length(text) DESC, doc_id)"""
)
def dedupe_longest(spark, sf):
    d = table(spark, sf, "documents").withColumn("key", F.concat_ws("/", "source", "lang"))
    return cleaning.dedupe_by_longest(d, "key", "text", "doc_id", "doc_id").select("doc_id", "kept", "excluded_reason")


@query(
    """WITH r AS (SELECT doc_id AS serial, first_value(doc_id) OVER (PARTITION BY lang, source, n_chars ORDER BY (lang = 'en') DESC, length(text) DESC, CAST(doc_id AS VARCHAR) DESC) AS duplicate_of FROM documents)
    SELECT CAST(serial AS VARCHAR) AS serial, CAST(duplicate_of AS VARCHAR) AS duplicate_of FROM r WHERE serial <> duplicate_of"""
)
def representative_rank(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "source", F.col("n_chars").cast("string").alias("size"), "text")
    return selection.duplicates(d, F.col("lang") == "en", ("lang", "source", "size"), (), "text", "doc_id")


@query("SELECT page_id, regexp_replace(html, '</?[A-Za-z][A-Za-z0-9]*[^>]*>', ' ', 'g') AS text, CAST(len(regexp_extract_all(html, '</?[A-Za-z][A-Za-z0-9]*[^>]*>')) AS BIGINT) AS n FROM pages")
def strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.strip_tags("html").alias("text"), tx.tag_count("html").alias("n"))


@query("SELECT page_id, regexp_replace(html, '<br\\s*/?>', chr(10), 'gi') AS text, CAST(len(regexp_extract_all(html, '(?i)<br\\s*/?>')) AS BIGINT) AS n FROM pages")
def replace_br(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.br_to_newline("html").alias("text"), tx.br_count("html").alias("n"))


@query(
    r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[\t \x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'), '[ \r\f\v]*\n[ \r\f\v]*', chr(10), 'g'), '\n{2,}', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS text FROM documents"""
)
def normalize_ws(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.squeeze_space("text").alias("text"))


@query("SELECT doc_id, translate(text, '·ᆞ‧∙•・', 'ㆍㆍㆍㆍㆍㆍ') AS text, CAST(length(text) - length(translate(text, '·ᆞ‧∙•・', '')) AS BIGINT) AS n FROM documents")
def unify_dots(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.unify_chars("text").alias("text"), tx.dot_variants("text").alias("n"))


@query()
def item_breaks(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.restore_item_breaks("text").alias("text"))


@query()
def clean_pages(spark, sf):
    return cleaning.clean_column(table(spark, sf, "pages").select("page_id", "html"), cleaning.clean_precedent, "html", "counts").select("page_id", "html", "counts.*")


@query()
def clean_law_pages(spark, sf):
    return cleaning.clean_column(table(spark, sf, "pages").select("page_id", "html"), cleaning.clean_instrument, "html", "counts").select("page_id", "html", "counts.*")


@query()
def idempotency(spark, sf):
    cleaned = cleaning.clean_column(table(spark, sf, "pages").select("page_id", "html"), cleaning.clean_precedent, "html")
    return cleaning.idempotency_violations(cleaned, cleaning.clean_precedent, "html")


@query(f"SELECT doc_id, array_to_string(list_filter({_TERM_LIST}, lambda t: contains(text, t)), ',') AS hits FROM documents")
def vocab_hits(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(tx.vocabulary_hits(F.col("text"), TERMS), ",").alias("hits"))


_DECIDED = """WITH h AS (SELECT doc_id, lang, text, list_filter(['the', 'der'], lambda t: contains(text, t)) AS d, list_filter(['token', 'idiot'], lambda t: contains(text, t)) AS i,
    list_filter(['zu', 'que'], lambda t: contains(text, t)) AS o, CASE WHEN lang = 'en' THEN 'core' WHEN lang = 'de' THEN 'candidate' ELSE 'excluded' END AS label FROM documents),
    l AS (SELECT *, CASE WHEN label = 'core' THEN 'TARGET_LAW_CORE' ELSE 'TARGET_LAW_CANDIDATE' END AS link FROM h),
    r AS (SELECT doc_id, CASE WHEN trim(text) = '' THEN 'exclude' WHEN label = 'excluded' THEN 'exclude' WHEN len(o) > 0 AND len(d) = 0 THEN 'exclude' WHEN len(d) > 0 AND len(i) > 0 THEN 'include' ELSE 'review' END AS decision,
    CASE WHEN trim(text) = '' THEN 'MISSING_FULL_TEXT' WHEN label = 'excluded' THEN 'TARGET_LAW_UNLINKED' WHEN len(o) > 0 AND len(d) = 0 THEN link || ',OUTSIDE_AESTHETIC_DOMAIN'
    WHEN len(d) > 0 AND len(i) > 0 THEN link || ',AESTHETIC_SUBJECT_MATCH,LEGAL_ISSUE_MATCH'
    ELSE link || CASE WHEN len(d) > 0 THEN '' ELSE ',AESTHETIC_SUBJECT_UNCLEAR' END || CASE WHEN len(i) > 0 THEN '' ELSE ',LEGAL_ISSUE_UNCLEAR' END END AS reasons FROM l) """


def _decided(spark, sf):
    label = F.when(F.col("lang") == "en", "core").when(F.col("lang") == "de", "candidate").otherwise("excluded")
    d = selection.decision(label, F.array("lang"), F.lit(None).cast("string"), F.col("text"), F.col("text"), ["the", "der"], ["token", "idiot"], ["zu", "que"])
    return table(spark, sf, "documents").select("doc_id", d.alias("d")).select("doc_id", "d.decision", F.array_join("d.reason_codes", ",").alias("reasons"))


@query(_DECIDED + "SELECT * FROM r")
def rule_ledger(spark, sf):
    return _decided(spark, sf)


@query(_DECIDED + "SELECT decision, reasons, count(*) AS n FROM r GROUP BY ALL")
def reason_counts(spark, sf):
    return _decided(spark, sf).groupBy("decision", "reasons").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH c AS (SELECT doc_id, CASE lang WHEN 'en' THEN '의료법' WHEN 'de' THEN '약사법' END AS body, CASE source WHEN 'src1' THEN '화장품법' WHEN 'src2' THEN '민법' END AS ref FROM documents)
    SELECT doc_id, CASE WHEN ref = '화장품법' THEN 'core' WHEN ref = '민법' THEN CASE WHEN body IS NULL THEN 'excluded' ELSE 'candidate' END WHEN body IS NOT NULL THEN 'core' ELSE 'excluded' END AS domain_label,
    CASE WHEN ref = '화장품법' THEN ref ELSE coalesce(body, '') END AS laws FROM c"""
)
def linkage_label(spark, sf):
    """The texts with law citations of our own added, so that each branch of the rule has rows."""
    cite = F.when(F.col("lang") == "en", F.concat(F.lit("의료법 제27조 "), "text")).when(F.col("lang") == "de", F.concat(F.lit("구 약사법 제1조, "), "text")).otherwise(F.col("text"))
    refs = F.when(F.col("source") == "src1", "화장품법 제2조").when(F.col("source") == "src2", "민법 제1조").otherwise("")
    d = table(spark, sf, "documents").select("doc_id", cite.alias("content"), refs.alias("refs"))
    return selection.label_precedents(d, "refs", "content").select("doc_id", "domain_label", F.array_join("matched_laws", ",").alias("laws"))


@query("SELECT d.doc_id, d.lang FROM documents d SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) l ON d.doc_id = l.doc_id")
def default_corpus(spark, sf):
    good = table(spark, sf, "labels").filter("quality = 1").select("doc_id").distinct().withColumn("inDefaultCorpus", F.lit(True))
    return validation.default_corpus(table(spark, sf, "documents").join(good, "doc_id", "left")).select("doc_id", "lang")


@query(
    """SELECT d.doc_id, array_to_string(list_filter([CASE WHEN l.quality = 0 THEN 'usage' END, CASE WHEN l.toxic = 1 THEN 'admission' END, CASE WHEN d.source = 'src1' OR d.source LIKE 'src1/%' THEN 'artifact under src1' END], lambda x: x IS NOT NULL), ',') AS reasons
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 0 OR l.toxic = 1 OR d.source = 'src1' OR d.source LIKE 'src1/%'"""
)
def admission_boundary(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").select(
        F.col("doc_id").alias("documentId"),
        F.when(F.col("quality") == 0, "evaluation_only").otherwise("index_eligible").alias("usage"),
        F.when(F.col("toxic") == 1, "restricted").otherwise("exempt").alias("admission"),
        F.struct(F.col("source").alias("rawArtifactPath")).alias("provenance"),
    )
    return validation.leaks(d, ["src1"]).select(F.col("documentId").alias("doc_id"), F.array_join("reasons", ",").alias("reasons"))


_RECORDS_SQL = """WITH f AS (
    SELECT 'warning' AS severity, 'sentinel_decision_date' AS code, CAST(doc_id AS VARCHAR) AS document_id FROM documents WHERE lang = 'fr'
    UNION ALL SELECT 'warning', 'body_only_judgement', CAST(doc_id AS VARCHAR) FROM documents WHERE lang = 'de'
    UNION ALL SELECT 'error', 'content_hash_mismatch', CAST(doc_id AS VARCHAR) FROM documents WHERE lang = 'es'
    UNION ALL SELECT 'warning', 'no_core_linkage', CAST(doc_id AS VARCHAR) FROM documents WHERE source = 'src2') """


def records(spark, sf) -> DataFrame:
    """documents as judgement records: the languages and sources decide what is wrong with them."""
    d = table(spark, sf, "documents")
    lang = F.col("lang")
    identity = F.struct(
        F.struct(
            F.col("doc_id").cast("string").alias("caseSerial"), F.lit("case").alias("caseName"), F.col("doc_id").cast("string").alias("caseNumber"), F.col("source").alias("court"), F.lit("x").alias("caseCategory"),
            F.when(lang == "fr", "00010101").otherwise("20200101").alias("decidedOn"), F.lit("판결").alias("judgementType"), F.when(lang == "de", "").otherwise("[1] first / [2] second").alias("headnote"), F.lit("").alias("holding"),
            F.when(lang == "de", "").otherwise("[1][2] law 1; law 2").alias("referencedProvisions"), F.lit("").alias("referencedPrecedents"),
        ).alias("judgement"),
        *(F.lit(None).cast(schemas.RECORD["identity"].dataType[k].dataType).alias(k) for k in ("official_guide", "statute")),
    )
    p = schemas.RECORD["provenance"].dataType
    given = {"provider": F.col("source"), "publisherStatement": F.lit("x"), "sourceReference": F.col("doc_id").cast("string"), "acquiredAt": F.lit("2024-01-01").cast("timestamp")}
    provenance = F.struct(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in p.fields))
    linked = F.when(F.col("source") == "src2", F.array(F.struct(F.lit("law").alias("lawName"), F.lit("candidate").alias("strength")))).otherwise(F.array().cast(schemas.RECORD["linkedLaws"].dataType))
    return d.select(
        F.col("doc_id").cast("string").alias("documentId"), F.lit(None).cast("string").alias("sourceGroupId"), F.lit("judgement").alias("documentKind"), F.lit("title").alias("title"), F.regexp_replace("text", "\n", "<br/>").alias("text"),
        F.when(lang == "es", "sha256:0").otherwise(ids.content_hash(F.regexp_replace("text", "\n", "<br/>"))).alias("contentHash"), identity.alias("identity"), provenance.alias("provenance"), F.lit("exempt").alias("admission"),
        F.lit("x").alias("attribution"), F.lit("index_eligible").alias("usage"), F.lit(True).alias("inDefaultCorpus"), linked.alias("linkedLaws"), F.array().cast("array<string>").alias("limitations"),
    )


@query(_RECORDS_SQL + "SELECT * FROM f")
def findings_report(spark, sf):
    return validation.record_findings(records(spark, sf)).select("severity", "code", "document_id")


@query(_RECORDS_SQL + "SELECT code, count(*) AS n FROM f GROUP BY code")
def findings_summary(spark, sf):
    return validation.summary(validation.record_findings(records(spark, sf)))


@query(
    """WITH c AS (SELECT lang AS key, count(*) AS claimed FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang UNION ALL SELECT 'xx', 5), a AS (SELECT lang AS key, count(*) AS actual FROM documents GROUP BY lang)
    SELECT coalesce(c.key, a.key) AS key, coalesce(claimed, 0) AS claimed, coalesce(actual, 0) AS actual FROM c FULL JOIN a ON c.key = a.key WHERE coalesce(claimed, 0) <> coalesce(actual, 0)"""
)
def coverage_full_outer(spark, sf):
    d = table(spark, sf, "documents")
    claimed = validation.coverage(d.join(table(spark, sf, "labels"), "doc_id"), F.col("lang")).unionByName(spark.range(1).select(F.lit("xx").alias("key"), F.lit(5).cast("long").alias("recordCount")))
    return validation.coverage_difference(claimed, validation.coverage(d, F.col("lang")))


@query("SELECT 'lang' AS axis, lang AS key, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source")
def manifest_coverage(spark, sf):
    d = table(spark, sf, "documents")
    axis = lambda c: validation.coverage(d, F.col(c)).select(F.lit(c).alias("axis"), "key", F.col("recordCount").alias("n"))
    return axis("lang").unionByName(axis("source"))


@query(
    r"""WITH p AS (SELECT page_id, list_filter(list_transform(string_split(html, '<br/>'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ps FROM pages)
    SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, md5(ps[i]) AS digest FROM p, unnest(generate_series(1, len(ps))) AS t(i)"""
)
def split_paragraphs(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.posexplode(tx.paragraphs("html")).alias("pos", "p")).select("page_id", "pos", F.md5("p").alias("digest"))


@query(
    r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), n AS (SELECT doc_id, i, ls[i] AS line FROM l, unnest(generate_series(1, len(ls))) AS t(i)),
    o AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos, contains(line, '|') AS boxed FROM n),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, boxed ORDER BY i) AS g FROM o)
    SELECT doc_id, CAST(min(pos) AS INTEGER) AS a, CAST(max(pos + length(line)) AS INTEGER) AS b FROM g WHERE boxed GROUP BY doc_id, g"""
)
def table_spans(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.inline(tx.table_spans("text", "|")))


@query(
    """WITH m AS (SELECT *, CASE WHEN role = 'system' THEN CAST(turn AS VARCHAR) END AS d, CASE WHEN role = 'user' THEN CAST(turn AS VARCHAR) END AS h, CASE WHEN role = 'assistant' THEN CAST(turn AS VARCHAR) END AS p,
    sum(CAST(role = 'system' AS INT)) OVER w AS g1, sum(CAST(role IN ('system', 'user') AS INT)) OVER w AS g2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    f AS (SELECT conv_id, turn, last_value(d IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS d, last_value(h IGNORE NULLS) OVER (PARTITION BY conv_id, g1 ORDER BY turn) AS h,
    last_value(p IGNORE NULLS) OVER (PARTITION BY conv_id, g1, g2 ORDER BY turn) AS p FROM m) SELECT conv_id, turn, concat_ws(' > ', d, h, p) AS locator FROM f"""
)
def hierarchy_forward_fill(spark, sf):
    c = table(spark, sf, "conversations")
    doc = Window.partitionBy("conv_id").orderBy("turn")
    label = lambda role: F.when(F.col("role") == role, F.col("turn").cast("string"))
    c = c.withColumn("g1", F.sum((F.col("role") == "system").cast("int")).over(doc)).withColumn("g2", F.sum(F.col("role").isin("system", "user").cast("int")).over(doc))
    last = lambda role, *keys: F.last(label(role), ignorenulls=True).over(Window.partitionBy("conv_id", *keys).orderBy("turn"))
    return c.select("conv_id", "turn", tx.locator(last("system"), last("user", "g1"), last("assistant", "g1", "g2")).alias("locator"))


@query(
    """WITH r AS (SELECT *, turn - row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS g FROM conversations)
    SELECT conv_id, role, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS n FROM r GROUP BY conv_id, role, g"""
)
def digit_islands(spark, sf):
    c = table(spark, sf, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    new = (F.lag("role").over(w).isNull() | (F.lag("role").over(w) != F.col("role")) | (F.lag("turn").over(w) != F.col("turn") - 1)).cast("int")
    runs = c.withColumn("new", new).withColumn("run", F.sum("new").over(w))
    return runs.groupBy("conv_id", "run", "role").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.count(F.lit(1)).alias("n")).drop("run")


@query(
    """WITH RECURSIVE lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
    g AS (
        SELECT doc_id, i, 0 AS ordinal, length(line) AS n FROM lines WHERE i = 1
        UNION ALL SELECT l.doc_id, l.i, CASE WHEN g.n + 1 + length(l.line) > 1500 THEN ordinal + 1 ELSE ordinal END, CASE WHEN g.n + 1 + length(l.line) > 1500 THEN length(l.line) ELSE g.n + 1 + length(l.line) END
        FROM g JOIN lines l ON l.doc_id = g.doc_id AND l.i = g.i + 1)
    SELECT doc_id, ordinal, string_agg(line, chr(10) ORDER BY i) AS piece FROM g JOIN lines USING (doc_id, i) GROUP BY doc_id, ordinal"""
)
def greedy_pack(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.posexplode(tx.pack_lines("text")).alias("ordinal", "piece"))


@query("SELECT conv_id, turn, CASE WHEN n = 1 THEN role ELSE role || ' (' || n || ')' END AS locator FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM conversations)")
def dedupe_locator(spark, sf):
    n = F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn"))
    c = table(spark, sf, "conversations").withColumn("n", n)
    return c.select("conv_id", "turn", F.when(F.col("n") == 1, F.col("role")).otherwise(F.format_string("%s (%d)", "role", "n")).alias("locator"))


@query("SELECT conv_id, turn, printf('%d#%s-%03d', conv_id, role, turn) AS chunk_id FROM conversations")
def chunk_ids(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", ids.chunk_id(F.col("conv_id").cast("string"), "role", "turn").alias("chunk_id"))


@query(
    r"""WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(replace(text, ', ', '; '), '; '), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ps FROM documents)
    SELECT doc_id, CAST(len(ps) AS INTEGER) AS n, ps[1] AS first_part FROM p"""
)
def citation_list_split(spark, sf):
    parts = tx.citation_list(F.replace("text", F.lit(", "), F.lit("; ")))
    return table(spark, sf, "documents").select("doc_id", F.size(parts).alias("n"), F.try_element_at(parts, F.lit(1)).alias("first_part"))


@query("SELECT doc_id, CASE WHEN length(text) > 2000 THEN substr(text, 1, 1997) || '...' ELSE text END AS excerpt FROM documents")
def excerpt_trim(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.excerpt("text").alias("excerpt"))


_TERMS = r"""t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ts FROM documents), e AS (SELECT doc_id, len(ts) AS dl, unnest(ts) AS term FROM t), p AS (SELECT doc_id, term, count(*) AS tf, any_value(dl) AS dl FROM e GROUP BY doc_id, term)"""


@query(f"WITH {_TERMS} SELECT doc_id AS doc, term, tf, CAST(dl AS BIGINT) AS dl FROM p")
def postings(spark, sf):
    return retrieval.postings(table(spark, sf, "documents"), "doc_id", ["text"]).select("doc", "term", "tf", F.col("dl").cast("long").alias("dl"))


@query(f"WITH {_TERMS} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM p GROUP BY term")
def term_stats(spark, sf):
    p = retrieval.postings(table(spark, sf, "documents"), "doc_id", ["text"])
    return p.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


_BM25 = rf"""{_TERMS}, s AS (SELECT count(*) AS n, avg(len(ts)) AS avgdl FROM t WHERE len(ts) > 0),
    q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')) AS term FROM benchmark) GROUP BY item_id, term),
    df AS (SELECT term, count(*) AS df FROM p GROUP BY term),
    sc AS (SELECT item_id, doc_id, sum(times * CAST(round(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))) * 1e12) AS BIGINT)) AS whole FROM q JOIN p USING (term) JOIN df USING (term), s GROUP BY item_id, doc_id),
    bm AS (SELECT item_id, doc_id, round(CAST(whole AS DOUBLE) / 1e12, 6) AS score, row_number() OVER (PARTITION BY item_id ORDER BY whole DESC, doc_id) AS rank FROM sc QUALIFY rank <= 50)"""


def _lexical(spark, sf, k=50):
    """k rows for each item, written once: all that reads them sees how few they are."""
    return kept(retrieval.bm25(table(spark, sf, "benchmark"), table(spark, sf, "documents").withColumnRenamed("doc_id", "doc"), "item_id", k=k), "lexical")


@query(f"WITH {_BM25} SELECT item_id, doc_id AS doc, score, CAST(rank AS INTEGER) AS rank FROM bm")
def bm25_topk(spark, sf):
    return _lexical(spark, sf)


@query(f"WITH {_BM25} SELECT item_id, doc_id AS doc, score, CAST(rank AS INTEGER) AS rank FROM bm")
def bm25_kept(spark, sf):
    """The same hits from an index that is built once and read in part."""
    path = f"{shared_folder(spark)}/quillspark/lexical-{uuid.uuid4().hex}"
    lexical_index.build(table(spark, sf, "documents").withColumnRenamed("doc_id", "doc"), path)
    return lexical_index.Search(table(spark, sf, "benchmark"), path, "item_id").hits


def _prototypes(spark, sf):
    """Of each label the componentwise greatest vector."""
    e = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.max("x").alias("x"))
    return e.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("embedding"))


_KNN = """px AS (SELECT label, i, max(embedding[i]) AS x FROM embeddings, unnest(generate_series(1, len(embedding))) AS t(i) GROUP BY label, i), pr AS (SELECT label, list(x ORDER BY i)::DOUBLE[] AS qv FROM px GROUP BY label),
    kn AS (SELECT p.label AS q, e.vec_id AS doc, list_cosine_similarity(e.embedding::DOUBLE[], p.qv) AS whole, round(whole, 4) AS score, row_number() OVER (PARTITION BY p.label ORDER BY whole DESC, e.vec_id) AS rank FROM embeddings e, pr p QUALIFY rank <= 50)"""


@query(f"WITH {_KNN} SELECT q AS label, doc, score, CAST(rank AS INTEGER) AS rank FROM kn")
def knn_exact_topk(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc"), "embedding")
    return retrieval.knn(_prototypes(spark, sf), e, "label")


_SHORT = """sh AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY n_chars, doc_id) AS short FROM bm JOIN documents USING (doc_id) QUALIFY short <= 20)"""


def _fused_sql(w1: str, w2: str) -> str:
    return f"""WITH {_BM25}, {_SHORT}, u AS (SELECT item_id, doc_id, 0 AS l, rank, {w1} / (60 + rank) AS part FROM bm UNION ALL SELECT item_id, doc_id, 1, short, {w2} / (60 + short) FROM sh),
    f AS (SELECT item_id, doc_id, round(sum(part), 9) AS score, min(l * 1000 + rank) AS seen FROM u GROUP BY item_id, doc_id)
    SELECT item_id, doc_id AS doc, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, seen) AS INTEGER) AS rank FROM f QUALIFY rank <= 10"""


def _fused(spark, sf, weights):
    lexical = _lexical(spark, sf)
    sized = lexical.join(table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "n_chars"), "doc")
    short = sized.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy("n_chars", "doc"))).filter("rank <= 20")
    return kept(retrieval.rank_fusion([lexical, short], "item_id", weights=weights, digits=9), "fused")


@query(_fused_sql("1.0::DOUBLE", "1.0::DOUBLE"))
def rrf_fusion(spark, sf):
    return _fused(spark, sf, None)


@query(_fused_sql("1.0::DOUBLE", "3.0::DOUBLE"))
def rrf_weighted(spark, sf):
    return _fused(spark, sf, retrieval.WEIGHTS)


@query("SELECT label, vec_id, score, CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM (SELECT label, vec_id, CAST(list_max(embedding) AS DOUBLE) AS score FROM embeddings) QUALIFY rank <= 8")
def batch_topk_per_group(spark, sf):
    e = table(spark, sf, "embeddings").select("label", "vec_id", F.array_max("embedding").cast("double").alias("score"))
    return retrieval.top_per_group(e, "label", "score", "vec_id")


_GOLD = "gold AS (SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text) WHERE b.text <> '')"


def _gold(spark, sf):
    """What documents hold an item, written once, as the texts are read through for it."""
    found = containment.containing(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "doc_id", "item_id")
    return kept(found.groupBy(F.col("item").cast("long").alias("item_id")).agg(F.collect_set("doc").alias("relevant")), "gold")


@query(f"WITH {_GOLD} SELECT item_id, doc_id FROM gold")
def benchmark_containment(spark, sf):
    return containment.containing(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "doc_id", "item_id").select(F.col("doc").alias("doc_id"), F.col("item").cast("long").alias("item_id"))


_FIRST = f"WITH {_BM25}, {_GOLD}, fr AS (SELECT item_id, min(CASE WHEN bm.doc_id IS NOT NULL THEN rank END) AS r FROM gold LEFT JOIN bm USING (item_id, doc_id) GROUP BY item_id) "


@query(_FIRST + "SELECT round(avg(CASE WHEN r <= 10 THEN 1.0 ELSE 0.0 END), 9) AS recall, round(avg(CASE WHEN r <= 10 THEN 1.0::DOUBLE / r ELSE 0 END), 9) AS mrr, count(*) AS n FROM fr")
def recall_mrr(spark, sf):
    s = evaluation.scored(_gold(spark, sf), _lexical(spark, sf), "item_id")
    return evaluation.recall_mrr(s).select(F.round("recall", 9).alias("recall"), F.round("mrr", 9).alias("mrr"), "n")


@query(_FIRST + "SELECT k, round(avg(CASE WHEN r <= k THEN 1.0 ELSE 0.0 END), 9) AS recall FROM fr, (SELECT CAST(unnest([1, 3, 5, 10, 20]) AS INTEGER) AS k) GROUP BY k")
def recall_curve(spark, sf):
    return evaluation.recall_curve(_gold(spark, sf), _lexical(spark, sf), "item_id").select("k", F.round("recall", 9).alias("recall"))


@query(
    f"""WITH {_BM25}, {_GOLD}, dm AS (SELECT b.item_id, d.source AS s, min(rank) AS f FROM bm b JOIN documents d USING (doc_id) GROUP BY ALL), dr AS (SELECT item_id, s, row_number() OVER (PARTITION BY item_id ORDER BY f, s) AS rank FROM dm),
    gs AS (SELECT DISTINCT item_id, source AS s FROM gold JOIN documents USING (doc_id)), fr AS (SELECT item_id, min(dr.rank) AS r FROM gs LEFT JOIN dr USING (item_id, s) GROUP BY item_id)
    SELECT round(avg(CASE WHEN r <= 10 THEN 1.0 ELSE 0.0 END), 9) AS recall, round(avg(CASE WHEN r <= 10 THEN 1.0::DOUBLE / r ELSE 0 END), 9) AS mrr, count(*) AS n FROM fr"""
)
def doc_level_recall(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), F.col("source").alias("document_id"))
    ranked = evaluation.document_ranks(_lexical(spark, sf), docs, "item_id")
    gold = _gold(spark, sf).select("item_id", F.explode("relevant").alias("doc")).join(docs, "doc").groupBy("item_id").agg(F.collect_set("document_id").alias("relevant"))
    return evaluation.recall_mrr(evaluation.scored(gold, ranked, "item_id")).select(F.round("recall", 9).alias("recall"), F.round("mrr", 9).alias("mrr"), "n")


@query(
    f"""WITH {_BM25}, x AS (SELECT b.item_id, b.text AS q, d.text AS t FROM bm JOIN benchmark b USING (item_id) JOIN documents d USING (doc_id) WHERE rank = 1),
    g AS (SELECT item_id, list_distinct(list_transform(generate_series(1, length(q) - 1), lambda i: substr(q, i, 2))) AS qb, list_distinct(list_transform(generate_series(1, length(t) - 1), lambda i: substr(t, i, 2))) AS tb FROM x)
    SELECT item_id, round(len(list_intersect(qb, tb)) / len(qb), 9) AS ratio FROM g"""
)
def bigram_overlap(spark, sf):
    top = _lexical(spark, sf, 1).select("item_id", F.col("doc").alias("source_chunk_id"))
    q = kept(table(spark, sf, "benchmark").join(top, "item_id"), "asked")  # a row for each item; its size decides that no text is shuffled
    chunks = table(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    return evaluation.overlap(q, chunks, "item_id").select("item_id", F.round("ratio", 9).alias("ratio"))


@query(
    """WITH s AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 200), f AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
    SELECT user_id, event_id, epoch_us(ts) AS at FROM f WHERE n = 1 AND user_id NOT IN (SELECT user_id FROM s)"""
)
def resume_antijoin(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return readers.unseen(e, table(spark, sf, "events").filter("event_type = 'purchase' AND value > 200"), "user_id", "event_id")


@query("SELECT user_id AS serial, arg_min(event_type, event_id) AS publisher FROM events GROUP BY user_id")
def first_seen(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("serial"), F.col("event_type").alias("publisher"), F.col("event_id").alias("pos"))
    return readers.first_publisher(e)


@query("SELECT doc_id, round((n_chars * 3.0 + length(text) * 15.0) / 1e6, 6) AS usd FROM documents")
def token_cost(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.token_cost("n_chars", F.length("text"), 3.0, 15.0).alias("usd"))


@query(
    """SELECT round(min(value), 6) AS min, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, round(max(value), 6) AS max FROM events"""
)
def latency_percentiles(spark, sf):
    return evaluation.latencies(table(spark, sf, "events"), "value").select(*(F.round(c, 6).alias(c) for c in ("min", "p50", "p95", "p99", "max")))


@query()
def judgement_chunks(spark, sf):
    c = chunking.chunk_judgements(records(spark, sf), "v1")
    return c.select("chunk_id", "document_id", "chunk_type", "ordinal", "locator", "content_hash", F.length("text").alias("n"))


@query()
def index_projection(spark, sf):
    d = chunking.index_documents(chunking.chunk_judgements(records(spark, sf), "v1"))
    return d.select("chunk_id", "document_kind", "locator", "case_number", "decided_on", F.array_join("referenced_provisions", "|").alias("provisions"), F.array_join("linked_law_names_candidate", "|").alias("candidates"))


@query(
    rf"""WITH hit AS ({_fused_sql("1.0::DOUBLE", "3.0::DOUBLE")}),
    p AS (SELECT item_id, count(*) AS n_hits, string_agg('[' || doc || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY rank) AS passages FROM hit JOIN documents d ON d.doc_id = hit.doc GROUP BY item_id),
    a AS (SELECT item_id, n_hits, split_part(substr(passages, strpos(passages, chr(10)) + 1), '. ', 1) AS said FROM p),
    s AS (SELECT b.item_id, coalesce(n_hits, 0) AS n_hits, said, coalesce(regexp_matches(said, '[^\s]'), false) AS stands FROM benchmark b LEFT JOIN a USING (item_id))
    SELECT item_id, CASE WHEN stands THEN 'answered' ELSE 'insufficient_evidence' END AS status, CASE WHEN stands THEN said END AS answer, CASE WHEN stands THEN 1 ELSE 0 END AS n_citations, n_hits FROM s"""
)
def grounded_answers(spark, sf):
    """Each benchmark item as a question, answered from its fused hits by the extractive generator."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("chunk_id"), F.col("source").alias("document_id"), "text", F.lit("judgement").alias("document_kind"), F.array().cast("array<string>").alias("record_limitations")
    )
    a = answering.answers(table(spark, sf, "benchmark").select("item_id", "text"), _fused(spark, sf, retrieval.WEIGHTS), docs.withColumn("chunk_id", F.col("chunk_id").cast("string")), question="item_id")
    return a.select("item_id", "status", "answer", F.size("citations").alias("n_citations"), F.size("hits").alias("n_hits"))


#: What the other modules of this package ask for.
lexical, gold, BM25, GOLD = _lexical, _gold, _BM25, _GOLD
