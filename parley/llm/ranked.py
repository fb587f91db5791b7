"""Positions of rows in a global order, without a hot group or one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.plans.workspace import written

#: Low bits of Spark's growing ids: the place of a row in its task.
ROW_BITS = 33


def numbered(rows: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """The rows with `pos`, which counts 0, 1, ... within each group in this order.

    Ranges of (group, order) are dealt out, so a large group is spread over tasks; a task
    numbers its rows as they lie, and what the tasks before it hold of a group is added.
    Group columns must not be null; nulls come first in `order`.  Rows that tie in all of it
    get different numbers and, being dealt out by a number of their own too, may be as many
    as they like.  No rows give no rows.
    """
    kept = rows.columns
    apart = written(rows.withColumn("__own", F.monotonically_increasing_id()), label)
    by = [*group, *order, "__own"]
    laid = written(apart.repartitionByRange(*by).sortWithinPartitions(*by)
                   .withColumn("__at", F.monotonically_increasing_id()), label)
    laid = laid.withColumn("__task", F.shiftright("__at", ROW_BITS))
    runs = laid.groupBy(*group, "__task").agg(F.min("__at").alias("__least"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    shift = runs.select(*group, "__task", (
        F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__least")).alias("__shift"))
    return laid.join(shift, [*group, "__task"]).select(
        *kept, (F.col("__at") + F.col("__shift")).alias("pos"))
