"""Dense places in one order of all rows, without a window over all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.sources.scratch import kept


def numbered(rows: DataFrame, order: list[str | Column], name: str = "pos", start: int = 0) -> DataFrame:
    """rows with their place in an order, counted from start; which of two rows that tie comes first is decided once.

    Ranges of the order are sorted and written by as many tasks as there are ranges; a row for each of them says how
    many rows come before. A range partitioning draws its bounds anew each time it is run, so it is run once.
    """
    ranged = kept(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("~at", F.monotonically_increasing_id()), "ranges")
    part, within = F.shiftright("~at", 33), F.col("~at").bitwiseAND((1 << 33) - 1)
    earlier = Window.orderBy("~part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    before = ranged.groupBy(part.alias("~part")).agg(F.count(F.lit(1)).alias("~n")).select("~part", F.coalesce(F.sum("~n").over(earlier), F.lit(0)).alias("~before"))
    place = F.col("~before") + within + start
    return ranged.withColumn("~part", part).join(F.broadcast(before), "~part").select(*(F.col(f"`{c}`") for c in rows.columns), place.alias(name))
