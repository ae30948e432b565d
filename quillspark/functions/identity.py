"""Hashes and identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import col, strip

# Fixed values.
SENTINEL_DATE = "00010101"
SEPARATOR = "\u001f"


def content_hash(c: Column | str) -> Column:
    """'sha256:' and the hex digest of the text's UTF-8 bytes (or of binary content)."""
    return F.concat(F.lit("sha256:"), F.sha2(col(c).cast("binary"), 256))


def identifier(prefix: str, *parts: Column) -> Column:
    """prefix, '-' and 24 hex digits that stand for the stripped parts."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(F.concat_ws(SEPARATOR, *(F.coalesce(strip(p.cast("string")), F.lit("")) for p in parts)), 256), 1, 24))


def number_part(c: Column | str) -> Column:
    """A number without leading zeros; blank is '0'; what is no number raises."""
    text = strip(F.coalesce(col(c), F.lit("")))
    return F.when(text == "", F.lit("0")).otherwise(text.cast("bigint").cast("string"))


def document_id(kind: Column | str, url: Column | str, reference: Column | str) -> Column:
    return identifier("doc", col(kind), col(url), col(reference))


def article_id(law: Column | str, number: Column | str, branch: Column | str) -> Column:
    return identifier("doc", F.lit("법령"), col(law), col(number).cast("bigint"), number_part(branch))


def appendix_id(law: Column | str, number: Column | str, branch: Column | str) -> Column:
    return identifier("doc", F.lit("별표"), col(law), col(number).cast("bigint"), number_part(branch))


#: Other families of identifiers: name to (prefix, number of parts). Fixed values.
FAMILIES = {
    "capture": ("capture", 2),
    "source_case": ("case", 3),
    "source_group": ("group", 2),
    "record": ("rec", 2),
    "mapping_result": ("unmapped", 2),
    "rejection": ("rejected", 3),
    "curation_row": ("curation", 2),
    "chunk": ("chunk", 5),
    "query": ("qry", 1),
}


def family_id(family: str, *parts: Column) -> Column:
    prefix, n = FAMILIES[family]
    if n != len(parts):
        raise ValueError(f"{family} identifiers have {n} parts")
    return identifier(prefix, *parts)


def chunk_id(document: Column | str, kind: Column | str, ordinal: Column | str) -> Column:
    """document#kind-000: three digits at least."""
    return F.format_string("%s#%s-%03d", col(document), col(kind), col(ordinal).cast("int"))


def decided_date(c: Column | str) -> Column:
    """A compact date; the sentinel, blanks and what is no date are null."""
    return F.when(col(c) == SENTINEL_DATE, None).otherwise(F.try_to_timestamp(F.when(col(c).rlike(r"^\d{8}$"), col(c)), F.lit("yyyyMMdd")).cast("date"))
