"""Types of records, manifests and raw rows, and a reader that takes no others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}


def typed(spec) -> T.DataType:
    """A type from a name, a list (array) or a dictionary (struct). DDL would ask for a session."""
    if isinstance(spec, str):
        return _KINDS[spec]
    if isinstance(spec, list):
        return T.ArrayType(typed(spec[0]))
    return T.StructType([T.StructField(n, typed(s)) for n, s in spec.items()])


def texts(names: list[str]) -> dict:
    return {n: "string" for n in names}


# The fields of records, of their parts and of manifests.
JUDGEMENT_FIELDS = [
    "caseSerial", "caseName", "caseNumber", "court", "caseCategory", "decidedOn", "judgementType", "headnote", "holding", "referencedProvisions", "referencedPrecedents",
]
GUIDE_FIELDS = ["issuingAuthority", "issuingDivision", "officialNumber", "officialNumberScheme", "edition", "issuedOn"]
STATUTE_FIELDS = [
    "unitKind", "lawName", "lawId", "mst", "instrumentKind", "responsibleMinistry", "promulgationNumber", "promulgatedOn", "effectiveOn", "unitEffectiveOn", "chapterTitle", "sectionTitle",
    "articleNumber", "articleBranchNumber", "articleTitle", "appendixNumber", "appendixBranchNumber", "appendixTitle",
]
EXTRACTION_FIELDS = ["tool", "engine", "model", "outputFormat"]
PROVENANCE_FIELDS = ["provider", "publisherStatement", "sourceUrl", "sourceReference"]
HEAD_FIELDS = ["documentId", "sourceGroupId", "documentKind", "title", "text", "contentHash"]
ADMISSION_FIELDS = ["admission", "attribution", "usage"]
LINKED_LAW_FIELDS = ["lawName", "strength"]
FILE_FIELDS = ["path", "kind", "sha256"]
LICENCE_FIELDS = ["subject", "terms"]

JUDGEMENT = texts(JUDGEMENT_FIELDS)
GUIDE = texts(GUIDE_FIELDS) | {"pageCount": "int", "legallyBinding": "boolean", "nonBindingStatement": "string"}
STATUTE = texts(STATUTE_FIELDS)
VARIANTS = {"judgement": JUDGEMENT, "official_guide": GUIDE, "statute": STATUTE}
EXTRACTION = texts(EXTRACTION_FIELDS) | {"performedAt": "timestamp", "settings": ["string"]}
PROVENANCE = texts(PROVENANCE_FIELDS) | {"acquiredAt": "timestamp", "extraction": EXTRACTION, "rawArtifactPath": "string", "rawArtifactHash": "string"}
#: A record; its identity holds one of three variants, the others being null.
RECORD = typed(
    texts(HEAD_FIELDS) | {"identity": VARIANTS, "provenance": PROVENANCE} | texts(ADMISSION_FIELDS) | {"inDefaultCorpus": "boolean", "linkedLaws": [texts(LINKED_LAW_FIELDS)], "limitations": ["string"]}
)
_COUNTS = [{"key": "string", "recordCount": "bigint"}]
MANIFEST = typed(
    {"datasetVersion": "string", "schemaVersion": "string", "frozenAt": "timestamp", "deliveryId": "string", "deliveredBy": "string"}
    | {"files": [texts(FILE_FIELDS) | {"byteSize": "bigint", "recordCount": "bigint"}]}
    | {f"coverageBy{k}": _COUNTS for k in ("DocumentKind", "Provider", "Usage")}
    | {"dispositions": [{"subject": "string", "included": "boolean", "reason": "string"}], "licences": [texts(LICENCE_FIELDS) | {"attributionRequired": "boolean", "restrictedUse": "boolean"}], "knownGaps": ["string"]}
)


def _unknown(text: Column, path: str, known: list[str]) -> Column:
    """Keys of the JSON object at a path that aren't known."""
    part = text if path == "$" else F.get_json_object(text, path)
    keys = F.coalesce(F.json_object_keys(part), F.array().cast("array<string>"))
    return F.array_except(keys, F.array(*map(F.lit, known)))


def unknown_keys(text: Column) -> Column:
    """Keys of a record's JSON that its type doesn't have, at the top and in its parts."""
    fields = {f.name: f for f in RECORD.fields}
    variant = F.get_json_object(text, "$.documentKind")
    own = F.array().cast("array<string>")
    for kind, spec in VARIANTS.items():
        names = ["documentKind", *spec]
        own = F.when(variant == kind, _unknown(text, "$.identity", names)).otherwise(own)
    provenance = [f.name for f in fields["provenance"].dataType.fields]
    return F.concat(_unknown(text, "$", list(fields)), own, _unknown(text, "$.provenance", provenance), _unknown(text, "$.provenance.extraction", list(EXTRACTION)))


def parse_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """(record fields, unknown): lines of JSON as records, blank lines left out; the identity goes to the struct of its kind."""
    text = F.col(column)
    kind = F.get_json_object(text, "$.documentKind")
    flat = T.StructType([f for f in RECORD.fields if f.name != "identity"])
    parsed = lines.filter(F.trim(text) != "").select(
        F.from_json(text, flat).alias("r"),
        F.struct(*(F.when(kind == k, F.from_json(F.get_json_object(text, "$.identity"), typed(v))).alias(k) for k, v in VARIANTS.items())).alias("identity"),
        unknown_keys(text).alias("unknown"),
    )
    return parsed.select(*("identity" if f.name == "identity" else F.col(f"r.{f.name}") for f in RECORD.fields), "unknown")


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of JSON lines files; unknown keys anywhere raise a ValueError before anything else is done."""
    rows = parse_records(spark.read.text(paths))
    bad = rows.filter((F.size("unknown") > 0) | F.col("documentId").isNull()).select("documentId", "unknown").limit(20).collect()
    if bad:
        raise ValueError("records with unknown keys or without an id: " + "; ".join(f"{r['documentId']}: {', '.join(r['unknown'])}" for r in bad))
    return rows.drop("unknown")
