"""Which collected cases enter a corpus: law linkage, duplicates, the rule ledger, reviews."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.sources.schemas import texts, typed

# The laws of the corpus and the terms of the selection policy.
LAWS = ["약사법", "의료법", "개인정보 보호법", "의료기기법", "표시ㆍ광고의 공정화에 관한 법률", "화장품법", "공중위생관리법", "안마사에 관한 규칙"]
DOMAIN_TERMS = ["미용", "에스테틱", "피부관리", "성형", "피부과", "미용시술", "반영구", "문신", "제모", "안마", "마사지", "화장품", "레이저", "고주파", "초음파", "시술사진"]
ISSUE_TERMS = [
    "무면허 의료행위", "의료행위", "의료광고", "표시광고", "과대광고", "거짓광고", "광고", "위생관리", "영업신고", "업무범위", "자격", "개인정보", "민감정보", "얼굴정보", "효능", "판매",
]
OUTSIDE_TERMS = ["숙박업", "숙박업소", "목욕장업", "세탁업", "위생관리용역업"]
# What decisions are searched by, and publishers whose decisions are left out (none so far).
KEYWORDS = ["약사법", "의료법", "개인정보 보호법", "의료기기법", "표시광고", "화장품", "공중위생관리법", "안마사", "미용", "과대광고", "무면허 의료행위"]
DENIED_PUBLISHERS: list[str] = []
SEARCHED = ["사건명", "판시사항", "판결요지", "참조조문", "content"]
POLICY = "precedent-selection-v1"

# Fixed value: the pattern of a law's name before an article number.
LAW_NAME = r"(?U)(?:^|[\s,/])(?:구\s+)?([가-힣ㆍ·][가-힣ㆍ·\s]*?(?:법률|법|규칙))\s*(?:\([^)]*\))?\s*제\d+조"


def canonical_name(c: Column) -> Column:
    return F.replace(F.translate(c, tx.DOT_VARIANTS, tx.DOT * len(tx.DOT_VARIANTS)), F.lit(" "), F.lit(""))


def law_names(c: Column | str) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(tx.col(c), F.lit("")), F.lit(LAW_NAME), F.lit(1)), tx.strip)


def names_law(name: Column, law: Column) -> Column:
    """Whether a canonical name is that law, or ends in it after something that is no law's name itself."""
    before = F.substring(name, F.lit(1), F.length(name) - F.length(law))
    return (name == law) | (F.endswith(name, law) & ~F.right(before, F.lit(1)).isin("법", "률", "칙"))


def cited_laws(c: Column | str, laws: list[str] = LAWS) -> Column:
    """Those of `laws`, in that order, that a text cites with an article."""
    # A text without an article number cites none.
    text = F.coalesce(tx.col(c), F.lit(""))
    found = F.when(F.contains(text, F.lit("조")), law_names(text)).otherwise(F.array().cast("array<string>"))
    names = F.array_distinct(F.transform(found, canonical_name))
    return _once(names, lambda ns: F.filter(F.array(*map(F.lit, laws)), lambda law: F.exists(ns, lambda n: names_law(n, canonical_name(law)))))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), the value being computed once a row however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def linkage(references: Column | str, body: Column | str, laws: list[str] = LAWS) -> Column:
    """struct<domain_label, matched_laws>: what the references cite is core; else what the body cites is core without references, and a candidate beside them."""
    given = tx.strip(F.coalesce(tx.col(references), F.lit("")))

    def labelled(by_reference: Column) -> Column:
        none = F.array().cast("array<string>")
        by_body = F.when(F.size(by_reference) > 0, none).otherwise(cited_laws(body, laws))  # it is asked only without references to laws
        label = lambda b: F.when(F.size(by_reference) > 0, "core").when(F.size(b) == 0, "excluded").when(given == "", "core").otherwise("candidate")
        return _once(by_body, lambda b: F.struct(label(b).alias("domain_label"), F.when(F.size(by_reference) > 0, by_reference).otherwise(b).alias("matched_laws")))

    return _once(cited_laws(given, laws), labelled)


def label_precedents(df: DataFrame, references: str = "참조조문", body: str = "content", laws: list[str] = LAWS) -> DataFrame:
    return df.withColumn("~linkage", linkage(references, body, laws)).select(*df.columns, "~linkage.*")


def law_linkage(references: Column | str, body: Column | str, law: str) -> Column:
    """core, candidate or unlinked for one law: cited by the references, by the body, or not."""
    cites = lambda c: F.size(cited_laws(c, [law])) > 0
    return F.when(cites(references), "core").when(cites(body), "candidate").otherwise("unlinked")


def duplicates(df: DataFrame, preferred: Column, key: tuple[str, ...] = ("법원명", "사건번호", "선고일자"), structured: tuple[str, ...] = ("판시사항", "판결요지", "참조조문", "참조판례"), body: str = "content", serial: str = "판례일련번호") -> DataFrame:
    """(serial, duplicate_of): rows of one decision, all key fields filled, and its representative.

    The representative is of a preferred publisher, then has most summary fields, the longest body, the greatest serial.
    """
    filled = F.lit(True)
    for k in key:
        filled &= tx.strip(F.coalesce(F.col(k), F.lit(""))) != ""
    fields = sum((F.when(tx.strip(F.coalesce(F.col(c), F.lit(""))) != "", 1).otherwise(0) for c in structured), F.lit(0))
    best = Window.partitionBy(*(tx.strip(F.col(k)) for k in key)).orderBy(F.desc(preferred.cast("int")), F.desc(fields), F.desc(F.length(F.coalesce(F.col(body), F.lit("")))), F.desc(serial))
    return df.filter(filled).select(F.col(serial).alias("serial"), F.first(serial).over(best).alias("duplicate_of")).filter(F.col("serial") != F.col("duplicate_of"))


def decision(label: Column, laws: Column, duplicate_of: Column, body: Column, searched: Column, domain: list[str] = DOMAIN_TERMS, issue: list[str] = ISSUE_TERMS, outside: list[str] = OUTSIDE_TERMS) -> Column:
    """struct<decision, reason_codes, matched_laws, domain_signals, issue_signals, duplicate_of>: one ordered list of rules; an unknown label raises."""
    none = F.array().cast("array<string>")
    d, i, o = (tx.vocabulary_hits(searched, v) for v in (domain, issue, outside))
    has = lambda a: F.size(a) > 0
    link = F.when(label == "core", "TARGET_LAW_CORE").when(label == "candidate", "TARGET_LAW_CANDIDATE").otherwise(F.raise_error(F.concat(F.lit("unknown linkage: "), label)).cast("string"))

    def row(kind: str, reasons: Column, law: Column = laws, dom: Column = none, iss: Column = none, dup: Column | None = None) -> Column:
        return F.struct(
            F.lit(kind).alias("decision"), reasons.alias("reason_codes"), law.alias("matched_laws"), dom.alias("domain_signals"), iss.alias("issue_signals"),
            (F.lit(None).cast("string") if dup is None else dup).alias("duplicate_of"),
        )

    unclear = F.concat(
        F.array(link),
        F.when(has(d), none).otherwise(F.array(F.lit("AESTHETIC_SUBJECT_UNCLEAR"))),
        F.when(has(i), none).otherwise(F.array(F.lit("LEGAL_ISSUE_UNCLEAR"))),
    )
    return (
        F.when(duplicate_of.isNotNull(), row("exclude", F.array(F.lit("DUPLICATE_DECISION")), dup=duplicate_of))
        .when(tx.strip(F.coalesce(body, F.lit(""))) == "", row("exclude", F.array(F.lit("MISSING_FULL_TEXT"))))
        .when((label.isin("unlinked", "excluded")) | (F.size(laws) == 0), row("exclude", F.array(F.lit("TARGET_LAW_UNLINKED")), law=none))
        .when(has(o) & ~has(d), row("exclude", F.array(link, F.lit("OUTSIDE_AESTHETIC_DOMAIN")), iss=i))
        .when(has(d) & has(i), row("include", F.array(link, F.lit("AESTHETIC_SUBJECT_MATCH"), F.lit("LEGAL_ISSUE_MATCH")), dom=d, iss=i))
        .otherwise(row("review", unclear, dom=d, iss=i))
    )


def ledger(df: DataFrame, preferred: Column | None = None, laws: list[str] = LAWS, serial: str = "판례일련번호", body: str = "content", references: str = "참조조문", searched: list[str] = SEARCHED) -> DataFrame:
    """One row per candidate: (case_serial, decision, reason_codes, matched_laws, domain_signals, issue_signals, duplicate_of, policy_version)."""
    dup = duplicates(df, F.lit(False) if preferred is None else preferred, serial=serial, body=body)
    text = F.concat_ws("\n", *(F.coalesce(F.col(c), F.lit("")) for c in searched))
    rows = label_precedents(df, references, body, laws).join(dup.withColumnRenamed("serial", "~serial"), F.col(serial) == F.col("~serial"), "left")
    decided = rows.select(F.coalesce(F.col(serial), F.lit("")).alias("case_serial"), decision(F.col("domain_label"), F.col("matched_laws"), F.col("duplicate_of"), F.col(body), text).alias("~d"))
    return decided.select("case_serial", "~d.*", F.lit(POLICY).alias("policy_version"))


def selected(df: DataFrame, decisions: DataFrame, serial: str = "판례일련번호") -> DataFrame:
    return df.join(decisions.filter("decision = 'include'").select(F.col("case_serial").alias(serial)), serial, "left_semi")


# The fields of a review and of its evidence, and the fields that are reviewed.
REVIEW_FIELDS = ["decision", "confidence", "domainCategory", "legalIssue", "rationale"]
EVIDENCE_FIELDS = ["field", "quote"]
REVIEWED_FIELDS = ["caseName", "headnote", "holding", "referencedProvisions", "body"]
REVIEW = typed(texts(REVIEW_FIELDS) | {"evidence": [texts(EVIDENCE_FIELDS)]})


def review_case(df: DataFrame) -> DataFrame:
    """What a reviewer sees of a case: bounded fields, a long body without its middle."""
    cut = lambda c, n: F.substring(F.coalesce(F.col(c), F.lit("")), 1, n)
    return df.select(
        F.coalesce("판례일련번호", F.lit("")).alias("caseSerial"), cut("사건명", 500).alias("caseName"), cut("판시사항", 4000).alias("headnote"), cut("판결요지", 4000).alias("holding"),
        cut("참조조문", 3000).alias("referencedProvisions"), tx.clipped_case(F.coalesce("content", F.lit("")), mark="\n[...중간 생략...]\n").alias("body"),
    )


def reviewed(cases: DataFrame, review: str = "review", fields: list[str] = REVIEWED_FIELDS) -> DataFrame:
    """Review results held against their cases: only evidence that its field holds counts, and only with it and high confidence a case is included."""
    r = F.col(review)
    of = F.create_map(*(x for f in fields for x in (F.lit(f), F.coalesce(F.col(f), F.lit("")))))
    quote = lambda e: tx.strip(F.coalesce(e["quote"], F.lit("")))
    valid = F.filter(F.coalesce(r["evidence"], F.array().cast("array<struct<field:string,quote:string>>")), lambda e: e["field"].isin(fields) & (quote(e) != "") & F.contains(F.try_element_at(of, e["field"]), quote(e)))
    valid = F.transform(valid, lambda e: F.struct(e["field"].alias("field"), quote(e).alias("quote")))
    asked = F.when(r["decision"].isin("include", "exclude", "review"), r["decision"]).otherwise("review")
    sure = F.when(r["confidence"].isin("high", "medium", "low"), r["confidence"]).otherwise("low")
    usable = (asked == "include") & (sure == "high") & (F.size(valid) > 0)
    return cases.select(
        "caseSerial",
        F.when((asked == "include") & ~usable, "review").otherwise(asked).alias("decision"),
        sure.alias("confidence"),
        usable.alias("usableCandidate"),
        F.coalesce(r["domainCategory"], F.lit("")).alias("domainCategory"),
        F.coalesce(r["legalIssue"], F.lit("")).alias("legalIssue"),
        valid.alias("evidence"),
        F.substring(F.coalesce(r["rationale"], F.lit("")), 1, 1000).alias("rationale"),
    )


def approve(decisions: DataFrame, approved: DataFrame, serial: str = "case_serial") -> DataFrame:
    """decisions with the approved serials included; raises if one of them isn't there."""
    missing = [r[0] for r in approved.select(serial).join(decisions, serial, "left_anti").limit(20).collect()]
    if missing:
        raise ValueError(f"approved but not among the decisions: {missing}")
    yes = approved.select(F.col(serial).alias("~yes")).distinct()
    joined = decisions.join(yes, F.col(serial) == F.col("~yes"), "left")
    return joined.withColumn("decision", F.when(F.col("~yes").isNotNull(), "include").otherwise(F.col("decision"))).drop("~yes")


def target_linkage(found: DataFrame, rows: DataFrame, serial: str = "판례일련번호", references: str = "참조조문", body: str = "content", laws: list[str] = LAWS) -> DataFrame:
    """rows with ragTargets (the laws whose searches found a serial) and linkage (law to strength), from found (serial, law, pos)."""
    targets = found.groupBy("serial", "law").agg(F.min("pos").alias("pos")).groupBy("serial").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "law"))), lambda x: x["law"]).alias("ragTargets"))
    all_links = F.map_from_arrays(F.array(*map(F.lit, laws)), F.array(*(law_linkage(references, body, law) for law in laws)))
    joined = rows.join(targets, F.col(serial) == F.col("serial")).withColumn("~links", all_links)
    return joined.withColumn("linkage", F.map_from_arrays(F.col("ragTargets"), F.transform("ragTargets", lambda t: F.coalesce(F.try_element_at(F.col("~links"), t), F.lit("unlinked"))))).drop("~links", "serial")


def allowed(rows: DataFrame, publisher: str, denied: list[str] = DENIED_PUBLISHERS) -> DataFrame:
    """rows but those of publishers that are left out; a row without publisher stays."""
    return rows.filter(~tx.strip(F.coalesce(F.col(publisher), F.lit(""))).isin(denied)) if denied else rows
