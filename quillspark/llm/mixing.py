"""Mixing sources to target weights by systematic sampling, in DataFrame operations alone.

Each source has a target: its weight's share of all words, at most `most` times
what it has, the excess shared again by weight among the others. Every document
of a source is expected target / size times. Within a source the expected
copies are summed along (size, id), one random offset is added, and a document
is taken once for each integer that the sum crosses at it. So a document's
chance of one more copy is the fraction in what is expected of it, and in this
order the words taken miss the target by little more than the longest text.

A document's place in its source comes from its place in the order of all rows
by (source, size, id): rows are dealt to tasks by ranges of that order, sorted
there and numbered, and the ranges' counts are added up. Rows that are equal in
all of that are told apart by where they were read, which changes nothing that
is returned. So no source, size or id is one task's, whatever its share is, and
sources are ordered likewise. Null texts have size 0, null sources are a source
of their own, and repeated rows, of any type of id, are numbered like others.
Empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
#: Sources whose table is broadcast and put in order by one task, of about 300 bytes a row.
FEW_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running(rows: DataFrame, order: list, sums: dict[str, Column]) -> DataFrame:
    """rows with the sums, in the given order, of what comes before each row; of more than FEW_SOURCES rows by ranges of that order, of which each is a task's."""
    if rows.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES:
        before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.select(*rows.columns, *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(n) for n, c in sums.items()))
    ranged = written(rows.repartitionByRange(*order).withColumn("~part", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("~part").agg(*(F.sum(c).alias(f"~{n}") for n, c in sums.items()))
    earlier = Window.orderBy("~part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    totals = totals.select("~part", *(F.coalesce(F.sum(f"~{n}").over(earlier), F.lit(0)).alias(f"~{n}") for n in sums))
    before = Window.partitionBy("~part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(F.broadcast(totals), "~part").select(*rows.columns, *((F.col(f"~{n}") + F.coalesce(F.sum(c).over(before), F.lit(0))).alias(n) for n, c in sums.items()))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(key, source, source_size, target) of a table with columns key, source and source_size, one row per source.

    A source is held at most * source_size when its ratio most * source_size / weight is under the
    level that the rest reaches; sources in the order of that ratio are held up to the first whose
    ratio reaches the level of those from it on. Sums are of integers, so the order of adding is nothing.
    """
    cycle = F.array(*(F.lit(w) for w in weights))
    by_code = running(sizes, [F.col("source").asc_nulls_last()], {"number": F.lit(1)})
    weighed = by_code.withColumn("weight", F.element_at(cycle, (F.col("number") % len(weights) + 1).cast("int")).cast("long"))
    weighed = weighed.withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = [F.col("ratio").asc(), F.col("source").asc_nulls_last()]
    level = written(running(weighed, order, {"held": F.col("cap"), "held_weight": F.col("weight")}), "levels")
    whole = level.agg(F.sum("weight").alias("weight"), F.sum("source_size").alias("size")).first()
    level = level.withColumn("left_weight", F.lit(whole["weight"] or 0) - F.col("held_weight")).withColumn("pool", F.lit(whole["size"] or 0) - F.col("held"))
    # The first free source in that order sets the pool and the weights that all free ones share.
    first = level.filter(F.col("cap") * F.col("left_weight") >= F.col("weight") * F.col("pool")).orderBy(*order).select("ratio", "pool", "left_weight").first()
    cap = F.col("cap").cast("double")
    target = cap if first is None else F.when(F.col("ratio") >= first["ratio"], (F.col("weight") * first["pool"]).cast("double") / first["left_weight"]).otherwise(cap)
    return level.select("key", "source", "source_size", F.least(target, cap).alias("target"))


def offset(source: Column, seed: str) -> Column:
    """In [0, 1), from seed and source: 32 bits of SHA-256."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(seed), F.coalesce(source, F.lit("\\N"))), 256), 1, 8), 16, 10).cast("double") / 4294967296.0


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    seed: str = "mix:",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken, then the columns of docs named in keep as a struct `kept`), one row per row of docs."""
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n"))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), key.alias("key"), F.monotonically_increasing_id().alias("row"),
        *([F.struct(*keep).alias("kept"), F.xxhash64(*keep).alias("tie")] if keep else [F.lit(0).alias("tie")]),
    )
    if not keep:  # texts are split once, and not again for the ranges' bounds
        rows = written(rows, "sizes")
    order = ["key", "size", "id", "tie", "row"]
    ranged = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()).drop("tie", "row"), "ranges")
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    ranged = ranged.withColumn("part", part).withColumn("at", within)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = ranged.join(F.broadcast(parts), "part").withColumn("at", F.col("at") + F.col("before"))
    by_source = written(placed.groupBy("key", "source").agg(F.sum("size").alias("source_size"), F.min("at").alias("first")), "sources")
    targets = source_targets(by_source.select("key", "source", "source_size"), weights, most)
    sources = targets.join(by_source.select("key", "first"), "key").select("key", "source_size", "target", "first", offset(F.col("source"), seed).alias("u"))
    # Sources are names, a table of few rows as a rule; counted, it is sent to all tasks, and joined by key beyond.
    few = F.broadcast if by_source.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES else lambda df: df
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = F.col("at") - F.col("first")
    copies = (F.floor(rate * (place + 1) + F.col("u")) - F.floor(rate * place + F.col("u"))).cast("long")
    return (
        placed.join(few(sources), "key")
        .withColumn("copies", copies)
        .select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(["kept"] if keep else []))
    )


def emitted(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of docs as often as mix() takes it, with its columns."""
    m = mix(docs, keep=tuple(docs.columns), **options)
    return m.filter("copies > 0").select("kept", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("kept.*")
