"""Exact token counts: a histogram of encoded lengths and its running sums."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm.common import text_of
from parley.llm.tokens import encoder
from parley.plans.workspace import written

#: Lengths whose running sums are taken in one task.
BLOCK = 1024


def length_histogram(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """(length, n_docs): how many documents have so many tokens, over whole texts.

    Null text is empty, with no tokens; an empty table gives no rows.  Each task sums its
    documents by length before anything is shuffled, so no length is a hot key.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, counts = encoder(ranks), Counter()
        for b in batches:
            counts.update(len(enc.all_ids(x.as_py())) // 4 for x in b.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()),
                                          pa.array(list(counts.values()), pa.int64())],
                                         ["length", "n_docs"])
    return docs.select(text_of().alias("text")).mapInArrow(run, "length long, n_docs long") \
        .groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def limits(histogram: DataFrame) -> DataFrame:
    """One row per length as a context limit, from running sums over the histogram.

    limit, n_docs of that length, docs_within and tokens_within the limit, docs_over it,
    tokens_truncated (the total if longer documents are cut at the limit), tokens_lost by
    that, and quantile (the share of documents within).  Between two lengths the counts of
    documents stay and truncated totals grow by docs_over a token, so `at_limits` answers
    any limit.  Sums run over blocks of lengths first, then within each block.
    """
    rows = written(histogram, "histogram").withColumn("block", F.floor(F.col("length") / BLOCK))
    words = F.sum(F.col("length") * F.col("n_docs"))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), words.alias("w"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    base = blocks.select("block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0")
                                    for c in "dw"],
                         *[F.sum(c).over(every).alias(f"{c}_all") for c in "dw"])
    inside = Window.partitionBy("block").orderBy("length")
    summed = rows.join(base, "block").select(
        "length", "n_docs", "d_all", "w_all",
        (F.col("d0") + F.sum("n_docs").over(inside)).alias("docs_within"),
        (F.col("w0") + F.sum(F.col("length") * F.col("n_docs")).over(inside)).alias("tokens_within"))
    over = F.col("d_all") - F.col("docs_within")
    cut = F.col("tokens_within") + over * F.col("length")
    return summed.select(F.col("length").alias("limit"), "n_docs", "docs_within", "tokens_within",
                         over.alias("docs_over"), cut.alias("tokens_truncated"),
                         (F.col("w_all") - cut).alias("tokens_lost"),
                         (F.col("docs_within") / F.col("d_all")).alias("quantile"))


def at_limits(table: DataFrame, asked: list[int]) -> DataFrame:
    """(limit, docs_within, docs_over, tokens_truncated) at any limits, from `limits`."""
    spark = table.sparkSession
    wanted = spark.createDataFrame([(int(x),) for x in asked], "asked long")
    # the asked limits are the caller's list
    known = table.join(F.broadcast(wanted), F.col("limit") <= F.col("asked")) \
        .groupBy("asked").agg(F.max(F.struct("limit", "docs_within", "docs_over", "tokens_truncated")).alias("x"))
    total = table.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"))
    return (wanted.join(known, "asked", "left").join(F.broadcast(total))
            .select(F.col("asked").alias("limit"),
                    F.coalesce("x.docs_within", F.lit(0)).alias("docs_within"),
                    F.coalesce("x.docs_over", "n").alias("docs_over"),
                    F.coalesce(F.col("x.tokens_truncated") + F.col("x.docs_over") * (F.col("asked") - F.col("x.limit")),
                               F.col("n") * F.col("asked")).alias("tokens_truncated")))


def quantile_lengths(table: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length within which at least that share of documents is."""
    wanted = table.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    return table.join(F.broadcast(wanted), F.col("quantile") >= F.col("share")) \
        .groupBy("share").agg(F.min("limit").alias("length"))
