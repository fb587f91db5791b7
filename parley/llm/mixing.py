"""Mixing of sources to target weights by Pareto order sampling, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm.common import WORD, id_of, in_rows, out_rows, text_of
from parley.plans.workspace import written

WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
#: Slices of the rank scale whose sums are taken first; only one slice per source is sorted.
SLICES = 4096


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, source_size, target): what each source is to give.

    sizes: source, size.  Sources in code point order, null last, take the weights in turn
    and share `share` of all sizes.  None gives over `most` times its size; what is over
    goes to the others by weight, until none is above.  With sources in order of cap per
    weight, that is one level L for which the sum of min(cap, L * weight) is the whole: the
    first source whose cap per weight reaches the level that the rest would need; from there
    on the needed level only falls, so that of the first is the greatest.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(place) - 1, F.lit(len(weights)))
    capped = by_source.select(
        "source", "source_size", F.get(F.array(*map(F.lit, weights)), turn).alias("weight"),
        (F.lit(most) * F.col("source_size")).alias("cap"))
    up = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, after = (up.rowsBetween(Window.unboundedPreceding, -1),
                     up.rowsBetween(0, Window.unboundedFollowing))
    total = F.lit(share) * F.sum("source_size").over(Window.partitionBy())
    level = ((total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    levels = capped.withColumn("need", level)
    reached = F.max(F.when(F.col("need") <= F.col("cap") / F.col("weight"), F.col("need"))) \
        .over(Window.partitionBy())
    return levels.select("source", "source_size",
                         F.least("cap", reached * F.col("weight")).alias("target"))


def _chance(d: Column, seed: int) -> Column:
    """A fixed random number in (0, 1) for each doc_id."""
    digits = F.substring(F.md5(F.concat_ws(":", F.coalesce(d.cast("string"), F.lit("null")),
                                           F.lit(str(seed)))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def size_bits(size: Column) -> Column:
    """The class of a size: its binary digits."""
    return F.length(F.bin(size))


def inclusion_odds(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, odds): for each source with a rest, the probability of a document by its size class.

    Longer documents are likelier: a class of b binary digits has min(1, L * b), with L such that the
    expected words are the rest.  That is one level again, found over the classes of a source,
    63 at most, from the largest, which reach 1 first.
    """
    classes = sizes.groupBy("source", size_bits(F.col("size")).alias("bits")).agg(F.sum("size").alias("words"))
    rows = _per_source(classes, goals.filter("odds > 0 AND rest > 0").select("source", "rest"))
    down = Window.partitionBy("source").orderBy(F.desc("bits"))
    before = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum(F.col("bits") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing))
    needs = rows.withColumn("need", F.try_divide(F.col("rest") - before, after))
    level = F.max(F.when(F.col("need") <= F.lit(1.0) / F.col("bits"), F.col("need"))).over(Window.partitionBy("source"))
    odds = needs.withColumn("odds", F.least(F.lit(1.0), level * F.col("bits")))
    return odds.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("bits", "odds"))).alias("odds"))


def mix_plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST,
             seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The narrow table (doc_id, source, size, u) and the plan with one row per source.

    See `mix` for the method.
    """
    sizes = written(docs.select("doc_id", "source", word_count(text_of()).alias("size"),
                                _chance(F.col("doc_id"), seed).alias("u")), "sizes")
    goals = source_targets(sizes, weights, share, most) \
        .withColumn("rate", F.when(F.col("source_size") > 0,
                                   F.col("target") / F.col("source_size")).otherwise(0.0)) \
        .withColumn("whole", F.floor("rate")) \
        .withColumn("odds", F.col("rate") - F.col("whole")) \
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    goals = written(goals, "goals")
    goals = written(_per_source(goals.drop("odds"), inclusion_odds(sizes, goals), "left"), "odds")
    ranked = _ranked(sizes, goals)
    slices = ranked.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("slice"))
    edge = (_per_source(slices.withColumn("upto", upto), goals.select("source", "rest"))
            .withColumn("base", F.col("upto") - F.col("words"))
            .filter("base < rest AND rest <= upto")
            .select("source", F.col("slice").alias("edge"), "base", "rest"))
    # the rows of one slice per source, in rank order; rows that tie in all of it share one sum
    order = Window.partitionBy("source").orderBy("place")
    tied = F.sum("size").over(Window.partitionBy("source", "place"))
    near = (_per_source(ranked, edge).filter("slice = edge")
            .withColumn("upto", F.col("base") + F.sum("size").over(order))
            .withColumn("under", F.col("upto") - tied))
    crossing = (near.filter("under < rest AND rest <= upto")
                .groupBy("source").agg(F.first("place").alias("last"), F.first("under").alias("under"),
                                       F.first("upto").alias("upto"), F.first("rest").alias("rest")))
    short, over = F.col("rest") - F.col("under"), F.col("upto") - F.col("rest")
    # what still fits best into the gap before the crossing row
    later = (_per_source(ranked, crossing)
             .filter((F.col("place") > F.col("last")) & (F.col("size") > 0) & (F.col("size") <= short))
             .groupBy("source").agg(F.max(F.struct("size", "place")).alias("extra")))
    cuts = _per_source(crossing, later, "left") \
        .withColumn("with_last", over <= short - F.coalesce(F.col("extra.size"), F.lit(0))) \
        .select("source", "last", "with_last", F.when(~F.col("with_last"), F.col("extra.place")).alias("extra"))
    return sizes, written(_per_source(goals.drop("rest", "rate"), cuts, "left"), "plan")


def _per_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joins a table with one that has a row per source, null being a source."""
    of = right.withColumnRenamed("source", "of")
    return left.join(of, F.col("source").eqNullSafe(F.col("of")), how).drop("of")


def _place(u: Column, odds: Column, d: Column, size: Column) -> Column:
    """A document's place in the order: its random odds by its inclusion odds; certain ones first."""
    p = F.try_element_at(odds, size_bits(size))
    q = F.when(p >= 1, F.lit(0.0)).otherwise((u / (1 - u)) / (p / (1 - p)))
    return F.struct(q.alias("q"), d.alias("d"), size.alias("n"))


def _ranked(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """Documents of sources that have a rest, with their place and its slice."""
    q = F.col("place.q")
    return (_per_source(sizes, goals.filter("odds IS NOT NULL").select("source", "odds"))
            .select("source", "size",
                    _place(F.col("u"), F.col("odds"), id_of(), F.col("size")).alias("place"))
            .withColumn("slice", F.floor(q / (1 + q) * SLICES).cast("int")))


def _copies(u: Column, d: Column, size: Column) -> Column:
    """How often a document is taken, from its source's row of the plan."""
    place = _place(u, F.col("odds"), d, size)
    sampled = F.when(F.col("odds").isNull(), False).otherwise(
        (place < F.col("last")) | ((place == F.col("last")) & F.col("with_last"))
        | F.coalesce(place == F.col("extra"), F.lit(False)))
    return F.col("whole").cast("int") + F.coalesce(sampled, F.lit(False)).cast("int")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST,
        seed: int = 42) -> DataFrame:
    """(doc_id, size, source_size, target, copies): how often the mix takes each row, whole.

    A document's size is its words; null text has none.  Sources get the targets of
    `source_targets`.  The whole part of target / source_size are certain copies of all documents of a
    source; the rest is drawn by Pareto order sampling with unequal probabilities: that of a document grows
    with the digits of its size (`inclusion_odds`), so that the expected words are the rest.  Documents
    are ranked by random odds u/(1-u), u a hash of the doc_id, divided by their inclusion odds
    p/(1-p), those with p = 1 first, and taken from the lowest rank on.  The sample's fixed size is in
    words: the document that crosses the rest of the target is taken if that
    comes nearer than leaving it out and taking the largest later document that still fits.
    Documents are taken whole, `ceil(most)` times at most.  Rows that repeat a doc_id and size
    share their fate.  Null sources are a source; null doc_ids tie.  An empty table gives none.

    A source's ranks are never sorted in one task: sums over 4,096 slices of the rank scale
    find the slice that holds the cut, and only its rows are sorted.  The plan has a row per
    source.  Sizes are computed once, into a narrow table; texts aren't moved.
    """
    sizes, plan = mix_plan(docs, weights, share, most, seed)
    return _per_source(sizes, plan).select(
        "doc_id", "size", "source_size", "target",
        _copies(F.col("u"), id_of(), F.col("size")).alias("copies"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST,
                    seed: int = 42) -> DataFrame:
    """The documents, each as often as the mix takes it, with their columns."""
    _, plan = mix_plan(docs, weights, share, most, seed)
    rows = in_rows(docs, d=id_of(), source=F.col("source"), u=_chance(F.col("doc_id"), seed),
                   size=word_count(text_of()))
    copies = _copies(F.col("u"), F.col("d"), F.col("size"))
    taken = _per_source(rows, plan).select(
        "row", F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"))
    return out_rows(taken, docs.columns)
