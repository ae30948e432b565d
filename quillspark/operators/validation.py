"""Checks of records and releases, and the boundary before an index.

A check is a DataFrame of findings (severity, code, message, document_id). The
boundary is an action: a column that raises could be optimised away.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import identity as ids
from quillspark.functions import text as tx
from quillspark.operators.ordering import numbered
from quillspark.operators.records import sentinel_type

# Fixed values.
ENUMS = {
    "documentKind": ["judgement", "official_guide", "statute"],
    "usage": ["index_eligible", "evaluation_only"],
    "admission": ["exempt", "licensed", "restricted"],
    "strength": ["core", "candidate", "unlinked"],
    "unitKind": ["article", "appendix"],
    "fileKind": ["records", "artifacts", "metadata"],
    "scheme": ["publication_registration", "guidance_document"],
}
DOCUMENT_ID = r"^[A-Za-z0-9][A-Za-z0-9._:\-]{0,127}$"
SHA256 = r"^sha256:[0-9a-f]{64}$"
COMPACT_DATE = r"^\d{8}$"
PARTIAL_DATE = r"^\d{4}(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\d|3[01]))?)?$"


def _filled(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def constraints() -> dict[str, Column]:
    """Name to a condition that each record must meet."""
    j, g, s = (F.col(f"identity.{k}") for k in ENUMS["documentKind"])
    p, kind = F.col("provenance"), F.col("documentKind")
    names = F.transform("linkedLaws", lambda x: x["lawName"])
    article = _filled(s["articleNumber"]) & ~_filled(s["appendixNumber"]) & ~_filled(s["appendixTitle"]) & ~_filled(s["appendixBranchNumber"])
    appendix = _filled(s["appendixNumber"]) & ~_filled(s["articleNumber"]) & ~_filled(s["articleTitle"]) & ~_filled(s["articleBranchNumber"])
    variants = {"judgement": j, "official_guide": g, "statute": s}
    own = reduce(lambda a, k: a | ((kind == k) & reduce(lambda x, y: x & y, [variants[o].isNotNull() == F.lit(o == k) for o in variants])), variants, F.lit(False))
    implies = lambda a, b: ~a | b
    return {
        "document_id": F.col("documentId").rlike(DOCUMENT_ID),
        "content_hash_form": F.col("contentHash").rlike(SHA256),
        "title": F.length("title") >= 1,
        "text": F.length("text") >= 1,
        "kind": kind.isin(ENUMS["documentKind"]),
        "usage": F.col("usage").isin(ENUMS["usage"]),
        "admission": F.col("admission").isin(ENUMS["admission"]),
        "linkage_strength": F.forall("linkedLaws", lambda x: x["strength"].isin(ENUMS["strength"])),
        "artifact_pair": (p["rawArtifactPath"].isNull() == p["rawArtifactHash"].isNull()) & implies(p["rawArtifactHash"].isNotNull(), p["rawArtifactHash"].rlike(SHA256)),
        "unit_fields": implies(s.isNotNull(), F.when(s["unitKind"] == "article", article).when(s["unitKind"] == "appendix", appendix).otherwise(False)),
        "identity_kind": own,
        "distinct_laws": F.size(F.array_distinct(names)) == F.size(names),
        "restricted_use": implies(F.col("admission") == "restricted", F.col("usage") == "evaluation_only"),
        "evaluation_outside": implies(F.col("usage") == "evaluation_only", ~F.col("inDefaultCorpus")),
        "guide_extraction": implies(kind == "official_guide", p["extraction"].isNotNull()),
        "licensed_attribution": implies(F.col("admission") == "licensed", _filled(F.col("attribution"))),
        "decided_on": implies(j.isNotNull(), j["decidedOn"].rlike(COMPACT_DATE)),
        "guide_facts": implies(g.isNotNull(), g["issuedOn"].rlike(PARTIAL_DATE) & (g["pageCount"] >= 1) & ~g["legallyBinding"] & g["officialNumberScheme"].isin(ENUMS["scheme"])),
    }


def violations(records: DataFrame) -> DataFrame:
    """(documentId, broken): the constraints that a record breaks; a null condition is a broken one."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), n) for n, c in constraints().items())))
    return records.select("documentId", broken.alias("broken")).filter(F.size("broken") > 0)


def checked(records: DataFrame) -> DataFrame:
    bad = violations(records).limit(20).collect()
    if bad:
        raise ValueError("records that break constraints: " + "; ".join(f"{r['documentId']}: {', '.join(r['broken'])}" for r in bad))
    return records


def manifest_violations(manifest: DataFrame) -> DataFrame:
    """(code, detail) of repeated paths and coverage keys, keys that no record can have, and empty parts."""
    parts = [manifest.select(F.explode("files.path").alias("detail")).groupBy("detail").count().filter("count > 1").select(F.lit("repeated_path").alias("code"), "detail")]
    for axis, enum in (("DocumentKind", "documentKind"), ("Provider", None), ("Usage", "usage")):
        keys = manifest.select(F.explode(f"coverageBy{axis}.key").alias("detail"))
        parts.append(keys.groupBy("detail").count().filter("count > 1").select(F.lit(f"repeated_{axis}").alias("code"), "detail"))
        parts.append(manifest.filter(F.size(f"coverageBy{axis}") < 1).select(F.lit(f"empty_{axis}").alias("code"), F.lit("").alias("detail")))
        if enum:
            parts.append(keys.filter(~F.col("detail").isin(ENUMS[enum])).select(F.lit(f"unknown_{axis}").alias("code"), "detail"))
    return reduce(DataFrame.unionByName, parts)


#: The rules of a release in the order in which they report.
RULES = [
    "duplicate_ids", "duplicate_decisions", "records", "record_count", "coverageByDocumentKind", "coverageByProvider", "coverageByUsage", "totalByDocumentKind", "totalByUsage",
]


def _order(rule: str, pos: Column | None = None, sub: Column | None = None, keys: list[Column] = ()) -> Column:
    """Where a finding stands among all: by rule, then the record's place and the rule's number within it, then keys."""
    none = F.array().cast("array<string>")
    return F.struct(
        F.lit(RULES.index(rule)).alias("rule"), (F.lit(0) if pos is None else pos).cast("long").alias("pos"), (F.lit(0) if sub is None else sub).cast("int").alias("sub"), (F.array(*(k.cast("string") for k in keys)) if keys else none).alias("keys"),
    )


FINDING = ["severity", "code", "message", "document_id"]


def _findings(df: DataFrame, severity: str, code: str | Column, message: Column, document: Column | None = None, order: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(severity).alias("severity"), (F.lit(code) if isinstance(code, str) else code).alias("code"), message.alias("message"), (F.lit(None) if document is None else document).cast("string").alias("document_id"), order.alias("~order")
    )


def _duplicate_ids(records: DataFrame) -> DataFrame:
    seen = records.groupBy("documentId").count().filter("count > 1")
    message = F.format_string("documentId appears %d times; it must be unique", "count")
    return _findings(seen, "error", "duplicate_document_id", message, F.col("documentId"), _order("duplicate_ids", keys=[F.col("documentId")]))


def _duplicate_decisions(records: DataFrame) -> DataFrame:
    j = F.col("identity.judgement")
    clusters = (
        records.filter(j.isNotNull())
        .groupBy(j["caseNumber"].alias("n"), j["court"].alias("c"), j["decidedOn"].alias("d"))
        .agg(F.sort_array(F.collect_list("documentId")).alias("docs"), (F.count_distinct("sourceGroupId") + F.max(F.col("sourceGroupId").isNull().cast("int"))).alias("groups"), F.count_if(F.col("sourceGroupId").isNull()).alias("none"))
        .filter(F.size("docs") > 1)
    )
    what = F.concat(F.lit("one decision ("), F.concat_ws(" ", "c", "n", "d"), F.lit(") in "), F.array_join("docs", ", "))
    grouped = (F.col("groups") == 1) & (F.col("none") == 0)
    code = F.when(grouped, "duplicate_decision").otherwise("ungrouped_duplicate_decision")
    return _findings(clusters, "warning", code, what, None, _order("duplicate_decisions", keys=[F.col("n"), F.col("c"), F.col("d")]))


def _record_findings(records: DataFrame, position: str | None = None) -> DataFrame:
    j, doc = F.col("identity.judgement"), F.col("documentId")
    bare = reduce(lambda a, f: a & (F.coalesce(j[f], F.lit("")) == ""), ("headnote", "holding", "referencedProvisions", "referencedPrecedents"), F.lit(True))
    rules = [
        ("error", "content_hash_mismatch", F.col("contentHash") != ids.content_hash("text"), F.lit("contentHash does not match the supplied text")),
        ("warning", "sentinel_decision_date", j["decidedOn"] == ids.SENTINEL_DATE, F.concat(F.lit("decidedOn is the placeholder "), j["decidedOn"])),
        ("warning", "sentinel_judgement_type", sentinel_type(j["judgementType"]), F.concat(F.lit("judgementType is the literal text "), j["judgementType"])),
        ("warning", "body_only_judgement", j.isNotNull() & bare, F.lit("no summary fields; only the body is supplied")),
        ("warning", "no_core_linkage", (F.size("linkedLaws") > 0) & ~F.exists("linkedLaws", lambda x: x["strength"] == "core"), F.lit("linked laws, but none of them core")),
    ]
    place = None if position is None else F.col(position)
    one = lambda i, s, c, m: F.struct(F.lit(s).alias("severity"), F.lit(c).alias("code"), m.alias("message"), F.lit(i).alias("~sub"))
    fired = F.array_compact(F.array(*(F.when(cond, one(i, s, c, m)) for i, (s, c, cond, m) in enumerate(rules))))
    rows = records.select(F.inline(fired), doc.alias("document_id"), (F.lit(0) if place is None else place).alias("~pos"))
    return rows.select(*FINDING, _order("records", F.col("~pos"), F.col("~sub")).alias("~order"))


def duplicate_ids(records: DataFrame) -> DataFrame:
    return _duplicate_ids(records).select(*FINDING)


def duplicate_decisions(records: DataFrame) -> DataFrame:
    """Judgements with one number, court and date: a warning that says whether they share a group (no group being one of its own)."""
    return _duplicate_decisions(records).select(*FINDING)


def record_findings(records: DataFrame) -> DataFrame:
    return _record_findings(records).select(*FINDING)


def coverage(records: DataFrame, key: Column) -> DataFrame:
    return records.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("recordCount"))


def coverage_difference(claimed: DataFrame, actual: DataFrame) -> DataFrame:
    """(key, claimed, actual) where two tables (key, recordCount) differ, a missing key being 0."""
    both = claimed.groupBy("key").agg(F.sum("recordCount").alias("claimed")).join(actual.groupBy("key").agg(F.sum("recordCount").alias("actual")), "key", "full_outer")
    return both.select("key", F.coalesce("claimed", F.lit(0)).alias("claimed"), F.coalesce("actual", F.lit(0)).alias("actual")).filter("claimed <> actual")


AXES = {"DocumentKind": "documentKind", "Provider": "provenance.provider", "Usage": "usage"}


def _release_findings(records: DataFrame, manifest: DataFrame, position: str | None = None) -> DataFrame:
    found = [_duplicate_ids(records), _duplicate_decisions(records), _record_findings(records, position)]
    total = records.agg(F.count(F.lit(1)).alias("n"))
    claimed = manifest.select(F.coalesce(F.aggregate(F.filter("files", lambda f: f["kind"] == "records"), F.lit(0).cast("long"), lambda s, f: s + f["recordCount"]), F.lit(0)).alias("c"))
    off = total.crossJoin(claimed).filter("n <> c")  # one row each
    found.append(_findings(off, "error", "record_count_mismatch", F.format_string("manifest claims %d record(s) across its files, but %d were supplied", "c", "n"), order=_order("record_count")))
    for axis, key in AXES.items():
        entries = manifest.select(F.inline(f"coverageBy{axis}"))
        diff = coverage_difference(entries, coverage(records, F.col(key)))
        what = F.format_string(f"coverageBy{axis}: %s is claimed %d times and supplied %d times", "key", "claimed", "actual")
        found.append(_findings(diff, "error", "coverage_mismatch", what, order=_order(f"coverageBy{axis}", keys=[F.col("key")])))
        if axis != "Provider":
            off = total.crossJoin(entries.agg(F.coalesce(F.sum("recordCount"), F.lit(0)).alias("c"))).filter("n <> c")  # one row each
            found.append(_findings(off, "error", "coverage_total_mismatch", F.format_string(f"coverageBy{axis} totals %d, but %d record(s) were supplied", "c", "n"), order=_order(f"totalBy{axis}")))
    return reduce(DataFrame.unionByName, found)


def release_findings(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """All findings of a release, in no order; never raises for what it finds."""
    return _release_findings(records, manifest).select(*FINDING)


def ordered_findings(records: DataFrame, manifest: DataFrame, position: str = "pos") -> DataFrame:
    """(place, severity, code, message, document_id): all findings, numbered from 0 in the order in which the rules report.

    Repeated ids come first, by id, then decisions by number, court and date, then what each record breaks, in the records' order (column position), then
    counts, coverages by key, and totals. Code points order texts.
    """
    return numbered(_release_findings(records, manifest, position), ["~order", "code", "message"], "place").select("place", *FINDING)


def summary(findings: DataFrame) -> DataFrame:
    return findings.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def assert_supplied(records: DataFrame, manifest: DataFrame) -> None:
    bad = release_findings(records, manifest).filter("severity = 'error'").orderBy("code", "document_id").limit(20).collect()
    if bad:
        raise ValueError("; ".join(f"{r['code']}: {r['message']}" for r in bad))


class EvaluationLeak(ValueError):
    """Records that must not reach an index."""


def under(path: Column, root: str) -> Column:
    """Whether a path is a root or beneath it; a sibling that begins alike is not."""
    root = root.rstrip("/")
    return F.coalesce((path == root) | F.startswith(path, F.lit(f"{root}/")), F.lit(False))


def leaks(records: DataFrame, roots: list[str]) -> DataFrame:
    """(documentId, reasons) of records that are for evaluation, restricted, or from an evaluation artifact."""
    path = F.col("provenance.rawArtifactPath")
    reasons = F.array_compact(
        F.array(
            F.when(F.col("usage") != "index_eligible", F.lit("usage")),
            F.when(F.col("admission") == "restricted", F.lit("admission")),
            *(F.when(under(path, r), F.lit(f"artifact under {r}")) for r in roots),
        )
    )
    return records.select("documentId", reasons.alias("reasons")).filter(F.size("reasons") > 0)


def index_inputs(records: DataFrame, roots: list[str]) -> DataFrame:
    """All records, or EvaluationLeak with how many violate the boundary and the first 20 of them; leaks() gives all."""
    bad = leaks(records, roots).select(F.concat("documentId", F.lit(": "), F.array_join("reasons", ", ")).alias("what"))
    first = [r["what"] for r in bad.orderBy("what").limit(20).collect()]
    if first:
        raise EvaluationLeak(f"{bad.count()} records: " + "; ".join(first))
    return records


def default_corpus(records: DataFrame) -> DataFrame:
    return records.filter("inDefaultCorpus")


def records_for_index(records: DataFrame, roots: list[str]) -> DataFrame:
    """The default corpus, once it is past the boundary; records outside it don't raise."""
    return index_inputs(default_corpus(records), roots)


def sentinel_findings(findings: DataFrame, records: DataFrame) -> DataFrame:
    """Findings of placeholder dates and types about records of the default corpus."""
    scope = default_corpus(records).select(F.col("documentId").alias("document_id"))
    return findings.filter(F.col("code").isin("sentinel_decision_date", "sentinel_judgement_type")).join(scope, "document_id", "left_semi")


class ExpectedTextMissing(ValueError):
    """A text without what it must hold."""


def assert_expected(bodies: DataFrame, expected: DataFrame, key: list[str]) -> None:
    """Raises where a body (key, body) lacks snippets (key, expected array), or where a key has no body or no snippets."""
    empty = expected.filter((F.size("expected") < 1) | F.exists("expected", lambda s: tx.strip(s) == ""))
    if not empty.isEmpty():
        raise ValueError("an expectation must be a list of non-blank snippets")
    joined = expected.join(bodies, key, "left")
    missing = joined.select(*key, F.when(F.col("body").isNull(), F.col("expected")).otherwise(tx.missing_text("body", "expected")).alias("missing")).filter(F.size("missing") > 0)
    bad = missing.limit(20).collect()
    if bad:
        raise ExpectedTextMissing("; ".join(f"{[r[k] for k in key]}: {r['missing']}" for r in bad))


def shared_groups(records: DataFrame, group: str = "sourceGroupId") -> DataFrame:
    """(shared): rows less distinct groups, counting a row without a group as a group of its own."""
    by_group = records.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return by_group.agg(F.coalesce(F.sum(F.when(F.col(group).isNotNull(), F.col("n") - 1)), F.lit(0)).alias("shared"))
