"""Collected rows as records: judgements, statute units, guides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import identity as ids
from quillspark.functions import text as tx
from quillspark.sources.schemas import RECORD, VARIANTS, typed

# Fixed values.
PARSER_VERSION = "law-open-api-xml-v1"
NULL_TEXT = "null"


def _required(name: str) -> Column:
    value = tx.strip(F.coalesce(F.col(name).cast("string"), F.lit("")))
    return F.when(value == "", F.raise_error(F.lit(f"missing {name}")).cast("string")).otherwise(value)


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _identity(kind: str, fields: dict[str, Column]) -> Column:
    parts = []
    for k, spec in VARIANTS.items():
        schema = typed(spec)
        own = F.struct(*(fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))
        parts.append((own if k == kind else F.lit(None).cast(schema)).alias(k))
    return F.struct(*parts)


def _shaped(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*(columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD.fields))


def group_ids(df: DataFrame, serial: str = "판례일련번호", key: tuple[str, ...] = ("사건번호", "법원명", "선고일자")) -> DataFrame:
    """df with sourceGroupId: 'group-' and the serial, as it is written, that is the least number of its decision."""
    least = df.groupBy(*key).agg(F.min_by(serial, F.col(serial).cast("bigint")).alias("~least"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key]
    joined = df.alias("a").join(least.alias("b"), same)
    return joined.select("a.*", F.concat(F.lit("group-"), F.col("~least")).alias("sourceGroupId"))


def sentinel_type(c: Column) -> Column:
    return F.lower(tx.strip(c)) == NULL_TEXT


def judgements(rows: DataFrame, artifacts: DataFrame, source_url: str, outside: list[str] = (), all_in_default: bool = False) -> DataFrame:
    """Judgement records of raw rows (with sourceGroupId, ragTargets, linkage) and their artifacts (path, sha256, modified); an artifact with another hash, or none, raises."""
    serial = F.col("판례일련번호")
    path = F.coalesce(F.nullif(tx.strip(_text("rawArtifactPath")), F.lit("")), F.concat(F.lit("source-native/"), serial, F.lit(".xml")))
    held = rows.withColumn("~path", path).join(artifacts.select(F.col("path").alias("~path"), F.col("sha256").alias("~hash"), F.col("modified").alias("~at")), "~path", "left")
    given = tx.strip(_text("rawArtifactHash"))
    wrong = held.filter(F.col("~hash").isNull() | ((given != "") & (given != F.col("~hash"))))
    if bad := [r[0] for r in wrong.select(serial).limit(20).collect()]:
        raise ValueError(f"raw artifact missing or with another hash: {bad}")
    summary = ["판시사항", "판결요지", "참조조문", "참조판례"]
    bare = F.lit(True)
    for c in summary:
        bare &= _text(c) == ""
    note = lambda cond, text: F.when(cond, F.array(F.lit(text))).otherwise(F.array().cast("array<string>"))
    limitations = F.concat(
        note(F.col("선고일자") == ids.SENTINEL_DATE, f"선고일자가 자리표시자 {ids.SENTINEL_DATE}이며 실제 선고일이 아니다. 날짜 필터가 이 레코드를 조용히 제외한다"),
        note(sentinel_type(_text("판결유형")), f"판결유형이 문자열 '{NULL_TEXT}'이며 실제 심급 표기가 아니다"),
        note(bare, "판시사항·판결요지·참조조문·참조판례가 모두 비어 있어 본문만 제공된다"),
    )
    names = {
        "caseSerial": "판례일련번호", "caseName": "사건명", "caseNumber": "사건번호", "court": "법원명", "caseCategory": "사건종류명", "decidedOn": "선고일자", "judgementType": "판결유형",
        "headnote": "판시사항", "holding": "판결요지", "referencedProvisions": "참조조문", "referencedPrecedents": "참조판례",
    }
    provenance = F.struct(
        F.col("데이터출처명").alias("provider"), F.col("source").alias("publisherStatement"), F.concat(F.lit(source_url), serial).alias("sourceUrl"),
        F.concat(F.lit("국가법령정보 판례일련번호 "), serial, F.lit(" ("), F.col("사건번호"), F.lit(")")).alias("sourceReference"), F.col("~at").cast("timestamp").alias("acquiredAt"),
        F.lit(None).cast(RECORD["provenance"].dataType["extraction"].dataType).alias("extraction"), F.col("~path").alias("rawArtifactPath"), F.col("~hash").alias("rawArtifactHash"),
    )
    return _shaped(
        held,
        {
            "documentId": F.concat(F.lit("precedent-"), serial),
            "sourceGroupId": F.col("sourceGroupId"),
            "documentKind": F.lit("judgement"),
            "title": F.col("사건명"),
            "text": F.col("content"),
            "contentHash": ids.content_hash("content"),
            "identity": _identity("judgement", {k: F.col(v) for k, v in names.items()}),
            "provenance": provenance,
            "admission": F.lit("exempt"),
            "attribution": F.col("source"),
            "usage": F.lit("index_eligible"),
            "inDefaultCorpus": F.lit(True) if all_in_default or not outside else ~F.coalesce(F.col("데이터출처명").isin(*outside), F.lit(False)),
            "linkedLaws": F.transform("ragTargets", lambda law: F.struct(law.alias("lawName"), F.element_at(F.col("linkage"), law).alias("strength"))),
            "limitations": limitations,
        },
    )


def statutes(rows: DataFrame, acquired_at: Column, source_label: str = "국가법령정보센터", provider: str = "법제처") -> DataFrame:
    """Statute records of articles and appendices; missing fields and other kinds of units raise, and so do units with one id."""
    article, appendix = F.col("doc_type") == "law_article", F.col("doc_type") == "law_appendix"
    other = F.raise_error(F.concat(F.lit("unsupported unit: "), F.coalesce("doc_type", F.lit("null")))).cast("string")
    pick = lambda a, b: F.when(article, a).when(appendix, b).otherwise(other)
    law, law_id, mst = _required("법령명"), _required("법령ID"), _required("MST")
    number = pick(_required("조문번호"), _required("별표번호"))
    branch = tx.strip(pick(_text("조문가지번호"), _text("별표가지번호")))
    title = F.nullif(tx.strip(pick(_text("조문제목"), _text("별표제목"))), F.lit(""))
    effective = _required("시행일자")
    unit_date = F.coalesce(F.nullif(pick(_text("조문시행일자"), _text("별표시행일자")), F.lit("")), effective)
    text = pick(_required("content"), _required("contentCleaned"))
    where = pick(tx.article_locator(number, branch), _required("locator"))
    extraction = F.struct(
        F.lit("quillspark XML reader").alias("tool"), F.lit(None).cast("string").alias("engine"), F.lit(None).cast("string").alias("model"), F.lit("text").alias("outputFormat"),
        acquired_at.cast("timestamp").alias("performedAt"), F.array(F.lit(PARSER_VERSION)).alias("settings"),
    )
    fields = {
        "unitKind": F.when(article, "article").otherwise("appendix"), "lawName": law, "lawId": law_id, "mst": mst, "instrumentKind": _required("법령구분"), "responsibleMinistry": _required("소관부처"),
        "promulgatedOn": _required("공포일자"), "effectiveOn": effective, "unitEffectiveOn": unit_date,
        **{f"article{k}": F.when(article, v) for k, v in (("Number", number), ("BranchNumber", branch), ("Title", title))},
        **{f"appendix{k}": F.when(appendix, v) for k, v in (("Number", number), ("BranchNumber", branch), ("Title", title))},
    }
    out = _shaped(
        rows,
        {
            "documentId": F.when(article, ids.article_id(law_id, number, branch)).when(appendix, ids.appendix_id(law_id, number, branch)).otherwise(other),
            "documentKind": F.lit("statute"),
            "title": F.concat_ws(" ", law, where),
            "text": text,
            "contentHash": ids.content_hash(text),
            "identity": _identity("statute", fields),
            "provenance": F.struct(
                F.lit(provider).alias("provider"), F.lit(source_label).alias("publisherStatement"), F.concat(F.lit("https://www.law.go.kr/법령/"), law).alias("sourceUrl"),
                F.concat(F.lit("국가법령정보센터 "), law, F.lit(" "), where, F.lit(" (MST "), mst, F.lit(")")).alias("sourceReference"), acquired_at.cast("timestamp").alias("acquiredAt"),
                extraction.alias("extraction"), _required("rawArtifactPath").alias("rawArtifactPath"), _required("rawArtifactHash").alias("rawArtifactHash"),
            ),
            "admission": F.lit("exempt"),
            "attribution": F.lit(source_label),
            "usage": F.lit("index_eligible"),
            "inDefaultCorpus": F.lit(True),
            "linkedLaws": F.array().cast(RECORD["linkedLaws"].dataType),
            "limitations": F.array().cast("array<string>"),
        },
    )
    if twice := [r[0] for r in out.groupBy("documentId").count().filter("count > 1").limit(20).collect()]:
        raise ValueError(f"several units have one id: {twice}")
    return out


def check_guide(markdown: str, quotes: list[str], pages: int, front_pages: int) -> None:
    """Raises unless each quotation is in a guide's text, its page marks are 1 to pages, and the file has as many pages."""
    import re

    plain = lambda s: re.sub(r"[\s\\]+", "", s)
    lost = [q for q in quotes if plain(q) not in plain(markdown)]
    marks = sorted(set(map(int, re.findall(r"<!--\s*page\s+(\d+)\s*-->", markdown))))
    if lost or marks != list(range(1, pages + 1)) or pages != front_pages:
        raise ValueError(f"guide text: missing quotations {lost}, {len(marks)} page marks, {front_pages} pages in the file, {pages} stated")


def guides(rows: DataFrame) -> DataFrame:
    """Guide records of rows (document_id, title, text, provenance and the identity's fields)."""
    fields = list(VARIANTS["official_guide"])
    return _shaped(
        rows,
        {
            **{c: F.col(c) for c in ("title", "text", "provenance", "attribution")},
            "documentId": F.col("document_id"), "documentKind": F.lit("official_guide"), "contentHash": ids.content_hash("text"), "identity": _identity("official_guide", {f: F.col(f) for f in fields}),
            "admission": F.lit("exempt"), "usage": F.lit("index_eligible"), "inDefaultCorpus": F.lit(True), "linkedLaws": F.array().cast(RECORD["linkedLaws"].dataType),
            "limitations": F.array().cast("array<string>"),
        },
    )
