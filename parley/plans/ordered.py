"""Ordered work inside a call, without ever placing a whole call in one task.

A call can be arbitrarily long, so nothing here partitions by the call alone.
Positions are cut into blocks of `TURN_BLOCK` turns and the work is shuffled by
(call, block):

* neighbours   - a block also receives the few rows next to its edges;
* running sums - summed inside blocks, plus the totals of the blocks before;
* folds        - run block by block; the state a block starts from is the state
                 the block before it ends with, repeated until nothing changes.

Calls shorter than a block, i.e. ordinary ones, are one block, and the results
are the same as those of one window over the call.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.plans.workspace import written

TURN_BLOCK = 4096
BLOCK, HALO = "__block", "__halo"


def block_of(position, size: int | None = None) -> Column:
    size = size or TURN_BLOCK
    position = F.col(position) if isinstance(position, str) else position
    return F.floor(position / F.lit(size)).cast("bigint")


def part_of(position, size: int | None) -> Column:
    """The part of a call that a position is in: one part unless a size is given."""
    return block_of(position, size) if size else F.lit(0).cast("bigint")


def with_edges(df: DataFrame, position: str, before: int = 0, after: int = 0,
               size: int | None = None) -> DataFrame:
    """Give every block the `before`/`after` rows around it, flagged as halo.

    `position` must count 0, 1, 2, ... inside each call.
    """
    size = size or TURN_BLOCK
    if max(before, after) > size:
        raise ValueError("a block must hold the rows its neighbours need")
    own = block_of(position, size)
    offset = F.pmod(F.col(position), F.lit(size))
    copies = [F.struct(own.alias("b"), F.lit(False).alias("h"))]
    if before:
        copies.append(F.when(offset >= size - before,
                             F.struct((own + 1).alias("b"), F.lit(True).alias("h"))))
    if after:
        copies.append(F.when((offset < after) & (own > 0),
                             F.struct((own - 1).alias("b"), F.lit(True).alias("h"))))
    return (df.withColumn("__copy", F.explode(F.array_compact(F.array(*copies))))
            .withColumn(BLOCK, F.col("__copy.b")).withColumn(HALO, F.col("__copy.h"))
            .drop("__copy"))


def edge_window(keys: Sequence[str], position: str) -> Window:
    return Window.partitionBy(*keys, BLOCK).orderBy(position)


def without_edges(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(BLOCK, HALO)


def _add_block_offsets(df: DataFrame, keys, totals: DataFrame, columns) -> DataFrame:
    """Add to each `columns` value the totals of the blocks before it."""
    w = (Window.partitionBy(*keys).orderBy(BLOCK)
         .rowsBetween(Window.unboundedPreceding, -1))
    shift = {c: f"__before_{c}" for c in columns}
    before = totals.select(*keys, BLOCK, *[F.sum(c).over(w).alias(s)
                                           for c, s in shift.items()])
    before = before.filter(F.greatest(*[F.coalesce(F.col(s), F.lit(0))
                                        for s in shift.values()]) > 0) \
        if len(shift) > 1 else before.filter(F.col(next(iter(shift.values()))) > 0)
    out = df.join(before, [*keys, BLOCK], "left")
    for c, s in shift.items():
        out = out.withColumn(c, F.col(c) + F.coalesce(F.col(s), F.lit(0)))
    return out.drop(BLOCK, *shift.values())


def in_one_block(bound: DataFrame | None, order: str, size: int | None = None) -> bool:
    """Whether all positions of `bound` lie in the first block; unknown, hence no, without a table to read."""
    if bound is None:
        return False
    first, last = bound.agg(F.min(order), F.max(order)).first()
    return last is None or (first >= 0 and last < (size or TURN_BLOCK))


def dense_position(df: DataFrame, keys: Sequence[str], order: str, out: str = "pos",
                   size: int | None = None, ties: Sequence[str] = (),
                   bound: DataFrame | None = None) -> DataFrame:
    """Number the rows of each key 0, 1, 2, ... in `order` (then `ties`).

    `order` is an integer position such as the original turn number, so blocks
    of it are bounded.  `bound` is a cheaper table with at least the same positions:
    where none is beyond a block, `df` is not computed again for the blocks' totals.
    """
    if in_one_block(bound, order, size):
        w = Window.partitionBy(*keys).orderBy(order, *ties)
        return df.withColumn(out, (F.row_number().over(w) - 1).cast("bigint"))
    blocked = df.withColumn(BLOCK, block_of(order, size))
    w = Window.partitionBy(*keys, BLOCK).orderBy(order, *ties)
    ranked = blocked.withColumn(out, (F.row_number().over(w) - 1).cast("bigint"))
    totals = blocked.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias(out))
    return _add_block_offsets(ranked, keys, totals, [out])


def running_total(df: DataFrame, keys: Sequence[str], order: str, value: Column, out: str,
                  size: int | None = None, bound: DataFrame | None = None) -> DataFrame:
    """Inclusive running sum of a non-negative integer expression; `bound` as in `dense_position`."""
    if in_one_block(bound, order, size):
        w = (Window.partitionBy(*keys).orderBy(order)
             .rowsBetween(Window.unboundedPreceding, 0))
        return df.withColumn(out, F.sum(value.cast("bigint")).over(w))
    blocked = df.withColumn(BLOCK, block_of(order, size)).withColumn(out, value.cast("bigint"))
    totals = blocked.groupBy(*keys, BLOCK).agg(F.sum(out).alias(out))
    w = (Window.partitionBy(*keys, BLOCK).orderBy(order)
         .rowsBetween(Window.unboundedPreceding, 0))
    return _add_block_offsets(blocked.withColumn(out, F.sum(out).over(w)), keys, totals, [out])


def fold(df: DataFrame, keys: Sequence[str], order: str, inputs: Sequence[str],
         step: Callable, initial, out: str, size: int | None = None,
         bound: DataFrame | None = None) -> DataFrame:
    """Add a boolean column computed by an order-dependent fold over each key.

    `step(state, *inputs) -> (state, flag)` is a small pure function whose state
    is JSON.  Blocks are folded in parallel.  Each starts from the end state of
    the block before it; blocks whose start state turned out different are
    folded again until all starts agree, so the flags equal those of one
    sequential pass.  Whether any key is longer than a block is read from
    `bound` (default: `df`), which must hold at least the same positions.
    """
    keys, size = list(keys), size or TURN_BLOCK
    blocked = df.withColumn(BLOCK, block_of(order, size))
    last = (df if bound is None else bound).agg(F.max(order)).first()[0]
    start = "__start"
    if last is None or last < size:
        rows = blocked.withColumn(start, F.lit(json.dumps(initial)))
    else:
        rows = blocked.join(_block_starts(blocked, keys, order, inputs, step, initial),
                            [*keys, BLOCK], "left")
        rows = rows.withColumn(start, F.coalesce(F.col(start), F.lit(json.dumps(initial))))
    schema = T.StructType([f for f in df.schema.fields] + [T.StructField(out, T.BooleanType())])
    names = df.columns

    def flag_rows(batches):
        """Only what the step reads becomes Python objects; rows go back as they came."""
        import pyarrow as pa
        current, state = None, None
        for batch in batches:
            values = {c: batch.column(c).to_pylist() for c in {*keys, BLOCK, start, *inputs}}
            flags = []
            for key, begin, given in zip(zip(*[values[k] for k in [*keys, BLOCK]]), values[start],
                                         zip(*[values[c] for c in inputs])):
                if key != current:
                    current, state = key, json.loads(begin)
                state, flag = step(state, *given)
                flags.append(bool(flag))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(flags, pa.bool_())],
                                             names=[*names, out])

    return (rows.repartition(*keys, BLOCK).sortWithinPartitions(*keys, BLOCK, order)
            .mapInArrow(flag_rows, schema))


def _block_starts(blocked, keys, order, inputs, step, initial) -> DataFrame:
    """Start state of every block after the first, by repeated parallel passes."""
    start, end = "__start", "__end"
    fields = [f for f in blocked.schema.fields if f.name in (*keys, BLOCK)]
    schema = T.StructType(fields + [T.StructField(end, T.StringType())])
    names = [f.name for f in fields]

    def end_states(batches):
        current, state = None, None
        for pdf in batches:
            ends = []
            for row in zip(*[pdf[k] for k in names], pdf[start], *[pdf[c] for c in inputs]):
                key = row[:len(names)]
                if key != current:
                    if current is not None:
                        ends.append((*current, json.dumps(state)))
                    current, state = key, json.loads(row[len(names)])
                state, _ = step(state, *row[len(names) + 1:])
            if ends:
                yield type(pdf)(ends, columns=[*names, end])
        if current is not None:
            import pandas as pd
            yield pd.DataFrame([(*current, json.dumps(state))], columns=[*names, end])

    narrow = written(blocked.select(*{c: None for c in [*keys, BLOCK, order, *inputs]}),
                     "fold-rows")
    blocks = narrow.select(*keys, BLOCK).distinct()
    starts = written(blocks.withColumn(start, F.lit(json.dumps(initial))), "fold-starts")
    todo, ends = starts, None
    while True:
        fresh = (narrow.join(todo, [*keys, BLOCK]).repartition(*keys, BLOCK)
                 .sortWithinPartitions(*keys, BLOCK, order).mapInPandas(end_states, schema))
        fresh = written(fresh, "fold-ends")
        ends = fresh if ends is None else written(
            ends.join(fresh.select(*keys, BLOCK), [*keys, BLOCK], "left_anti")
            .unionByName(fresh), "fold-ends")
        # the state before block b is the end state of the nearest block before it
        w = Window.partitionBy(*keys).orderBy(BLOCK)
        wanted = ends.select(*keys, BLOCK, F.coalesce(
            F.lag(end).over(w), F.lit(json.dumps(initial))).alias("__want"))
        wanted = written(starts.join(wanted, [*keys, BLOCK]), "fold-check")
        changed = wanted.filter(F.col(start) != F.col("__want"))
        starts = wanted.select(*keys, BLOCK, F.col("__want").alias(start))
        if changed.isEmpty():
            return starts
        todo = changed.select(*keys, BLOCK, F.col("__want").alias(start))
