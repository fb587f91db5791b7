"""Connected components of a link table, by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.plans.workspace import written


def _nearest(links: DataFrame) -> DataFrame:
    """Each node's smallest neighbour; combined before the shuffle."""
    return links.groupBy("a").agg(F.min("b").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are tied to the smallest of it and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = _nearest(both).select("a", F.least("a", "least").alias("least"))
    return (both.join(near, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are tied to the smallest of them.

    Links run from the larger to the smaller node.
    """
    near = _nearest(links)
    others = (links.join(near, "a").filter("b <> least")
              .select(F.col("b").alias("a"), F.col("least").alias("b")))
    return others.unionByName(near.select("a", F.col("least").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    links: two long columns a and b.  Rows with a null, loops and repeats don't matter; no
    links give no rows.  Every round halves the distance to the root at least, so rounds grow
    with the logarithm of the longest chain; each is written to the shared folder, which cuts
    lineage.  No node's neighbours are gathered in one value: stars are joins with the
    smallest neighbour, and large stars are split like any skewed join.
    """
    now = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter("a <> b").distinct(), "links")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if state == before:
            break
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
