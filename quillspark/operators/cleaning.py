"""Cleaning of collected texts, with a count for each rule.

Each cleaner takes a column and returns a struct of the cleaned text and the
counts. Counts are columns, so that sums over any number of rows are one
aggregation.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import text as tx
from quillspark.operators.batches import bounded

# Fixed value.
VERSION = "kit-clean-v2"
AMENDMENT = r"(?U)\s*<(?:개정|신설|전문개정)[^>]*>"
_TOKEN = r"(?:[①-⑮]|\d{1,3}\.|[가-힣]\.)"
# Fixed value: a line with nothing but a number before a line that begins with it.
TWICE = rf"(?md)^({_TOKEN})[ \t]*\n(?=\1)"


@F.arrow_udf(T.StringType())
def _unescaped(values: pa.Array) -> pa.Array:
    from html import unescape

    import pyarrow as pa

    parts = [pa.array([v if v is None else unescape(v) for v in part.column("v").to_pylist()], pa.string()) for part in bounded([pa.record_batch([values.cast(pa.string())], names=["v"])], "v")]
    return pa.concat_arrays(parts)


def html_unescape(c: Column | str) -> Column:
    """Character references as HTML5 reads them, of which there are too many for an expression; only texts with an & are sent to Python."""
    c = tx.col(c)
    return F.coalesce(_unescaped(F.when(F.contains(c, F.lit("&")), c)), c)


def _chars_and_space(c: Column) -> Column:
    return tx.squeeze_space(tx.unify_chars(c))


def clean_law(c: Column | str) -> Column:
    """struct<text, images_indexed, amend_removed, dots_unified, numbers_deduped>."""
    c = tx.col(c)
    marked = tx.image_markers(c)
    unamended = F.regexp_replace(marked, AMENDMENT, "")
    even = _chars_and_space(unamended)
    return F.struct(
        F.regexp_replace(even, TWICE, "").alias("text"),
        tx.image_count(c).alias("images_indexed"),
        F.regexp_count(marked, F.lit(AMENDMENT)).cast("long").alias("amend_removed"),
        tx.dot_variants(unamended).alias("dots_unified"),
        F.regexp_count(even, F.lit(TWICE)).cast("long").alias("numbers_deduped"),
    )


def clean_instrument(c: Column | str) -> Column:
    """clean_law of a text whose item markers are first put on lines of their own."""
    return clean_law(tx.restore_item_breaks(c))


def clean_precedent(c: Column | str) -> Column:
    """struct<text, images_indexed, br_replaced, residual_tags, entities_unescaped, dots_unified>."""
    c = tx.col(c)
    marked = tx.image_markers(c)
    lines = tx.br_to_newline(marked)
    bare = tx.strip_tags(lines)
    plain = html_unescape(bare)
    return F.struct(
        _chars_and_space(plain).alias("text"),
        tx.image_count(c).alias("images_indexed"),
        tx.br_count(marked).alias("br_replaced"),
        tx.tag_count(lines).alias("residual_tags"),
        (plain != bare).cast("long").alias("entities_unescaped"),
        tx.dot_variants(plain).alias("dots_unified"),
    )


def clean_column(df: DataFrame, cleaner: Callable[[Column | str], Column], column: str, counts: str | None = None) -> DataFrame:
    """df with a column cleaned; its counts go to a struct column `counts` if that is named."""
    done = df.withColumn("~done", cleaner(column))
    fields = [f.name for f in done.schema["~done"].dataType.fields if f.name != "text"]
    if counts:
        done = done.withColumn(counts, F.struct(*(F.col(f"~done.{f}").alias(f) for f in fields)))
    return done.withColumn(column, F.col("~done.text")).drop("~done")


#: Fields of a precedent that are cleaned, the last one the full text.
PRECEDENT_FIELDS = ("판시사항", "판결요지", "참조조문", "참조판례", "content")


def clean_precedents(df: DataFrame, fields: tuple[str, ...] = PRECEDENT_FIELDS) -> DataFrame:
    for f in fields:
        if f in df.columns:
            df = clean_column(df, clean_precedent, f)
    return df


def cleaning_totals(df: DataFrame, counts: str) -> DataFrame:
    fields = [f.name for f in df.schema[counts].dataType.fields]
    return df.agg(*(F.sum(F.col(f"{counts}.{f}")).alias(f) for f in fields))


def idempotency_violations(df: DataFrame, cleaner: Callable[[Column | str], Column], column: str) -> DataFrame:
    """How many cleaned texts a second cleaning changes: (violations)."""
    return df.withColumn("~again", cleaner(column)["text"]).agg(F.count_if(F.col("~again") != F.col(column)).alias("violations"))


def dedupe_by_longest(df: DataFrame, key: str = "사건번호", text: str = "content", serial: str = "판례일련번호", order: str = "pos") -> DataFrame:
    """df with kept (boolean) and excluded_reason: of the rows of a key, blank keys being one, the longest text stays, the earliest among equals, then that of the least serial.

    Rows that have the same length, place and serial are one row that is repeated; they stay or go together.
    """
    name = F.coalesce(F.col(key), F.lit(""))
    # Null texts come last, and null serials after others.
    rank = F.struct((-F.coalesce(F.length(text), F.lit(-1))).alias("n"), F.col(order).alias("at"), F.col(serial).isNull().alias("none"), F.col(serial).alias("serial"))
    # The longest is found by sums that tasks make in part, so a key that many rows share is nobody's alone.
    best = df.groupBy(name.alias("~key")).agg(F.min(rank).alias("~best"))
    ranked = df.withColumn("~key", name).join(best, "~key").withColumn("kept", rank.eqNullSafe(F.col("~best")))
    reason = F.concat(F.lit("사건번호 중복(보존본: 판례일련번호 "), F.coalesce(F.col("~best.serial").cast("string"), F.lit("?")), F.lit(")"))
    return ranked.withColumn("excluded_reason", F.when(~F.col("kept"), reason)).drop("~key", "~best")
