"""Merkle manifest of a table: leaves by source, subroots by source, one root, and proofs.

Trees have a fanout of three.  Aligned runs of leaves are hashed up where they are; their
roots then meet by butterfly exchange: in each round, groups of three subtrees swap roots, and
every run hashes its own ancestor, so each has all upper siblings when the root is reached.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import id_of
from parley.llm.ranked import numbered
from parley.plans.workspace import written

FANOUT = 3
#: Levels of the tree within a run: a run has FANOUT ** LEVELS leaves, save the last of a source.
LEVELS = 7
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: How runs travel between tasks.
GROUP = ["known", "source"]


def _field(c: Column) -> Column:
    c = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def leaf_digest(**values: Column) -> Column:
    """The hash of a row: each field is its length in bytes, a colon and its value, or `-`."""
    return F.sha2(F.concat(*[_field(values.get(name, F.col(f"`{name}`"))) for name in FIELDS]), 256)


def hash_up(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def tree_levels(leaves: list[str], levels: int) -> list[list[str]]:
    """So many levels above the leaves, or as many as there are until one node remains."""
    rows = [leaves]
    while len(rows) <= levels:
        below = rows[-1]
        rows.append([hash_up(below[k:k + FANOUT]) for k in range(0, len(below), FANOUT)])
    return rows


def depth_of(n: int) -> int:
    """Levels above n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def run_roots(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(known, source, size, run, node): the root of each run of FANOUT ** levels leaves.

    leaves: known, source, size (leaves of the source), pos, leaf.  A source that is one run
    is hashed up to its only node; a lone leaf is that.  Runs are streamed.
    """
    span = FANOUT ** levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(key, held):
            up = levels if key[2] > span else depth_of(key[2])
            return (*key, tree_levels(held, up)[-1][0])
        key, held, out = None, [], []
        for b in batches:
            for *now, leaf in zip(*(c.to_pylist() for c in b.columns)):
                if now != key:
                    if held:
                        out.append(closed(key, held))
                    key, held = now, []
                held.append(leaf)
            yield _batch(out, RUN)
            out = []
        if held:
            yield _batch([closed(key, held)], RUN)

    runs = leaves.withColumn("run", F.floor(F.col("pos") / span)) \
        .repartition(*GROUP, "run").sortWithinPartitions(*GROUP, "run", "pos")
    return runs.select(*GROUP, "size", "run", "leaf").mapInArrow(run, _ddl(RUN))


RUN = [("known", pa.bool_()), ("source", pa.string()), ("size", pa.int64()), ("run", pa.int64()), ("node", pa.string())]


def _ddl(fields) -> str:
    names = {pa.bool_(): "boolean", pa.string(): "string", pa.int64(): "long", pa.list_(pa.string()): "array<string>"}
    return ", ".join(f"{name} {names[kind]}" for name, kind in fields)


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def butterfly(runs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The runs with `above`, their siblings level by level, and `node`, the root of their source.

    In a round, run r holds the root of its aligned subtree of FANOUT ** k runs.  It asks one
    run of each other subtree of its group for that subtree's root: the run with the same place
    in it, or, where the last subtree is not full, that place modulo its runs.  All asked
    roots, in order, are the siblings (none for an only child), and their hash with the own
    root is what the run holds next.  Rounds are the levels above the runs of the largest
    source; each is written.  Sources that have reached their root wait.
    """
    span = FANOUT ** levels
    state = written(runs.withColumn("runs", F.ceil(F.col("size") / span).cast("long"))
                    .withColumn("above", F.array().cast("array<string>")), "butterfly")
    most = state.agg(F.coalesce(F.max("runs"), F.lit(0))).first()[0]
    step = 1
    while step < most:
        mine = F.floor(F.col("run") / step)                       # the subtree, and the first of its group
        first = F.floor(mine / FANOUT) * FANOUT
        within = F.least(F.lit(step), F.col("runs") - F.col("tree") * step)
        open_ = state.filter(F.col("runs") > step)
        asked = open_.select(*GROUP, "run", "runs", F.explode(F.sequence(first, F.least(
            first + FANOUT - 1, F.ceil(F.col("runs") / step) - 1))).alias("tree"), mine.alias("mine"))
        asked = asked.withColumn("partner", F.col("tree") * step + F.pmod(F.pmod("run", F.lit(step)), within))
        sent = state.select(*GROUP, F.col("run").alias("partner"), "node")
        got = asked.join(sent, [*GROUP, "partner"]).groupBy(*GROUP, "run", "mine").agg(
            F.sort_array(F.collect_list(F.struct("tree", "node"))).alias("got"))
        others = F.transform(F.filter("got", lambda x: x["tree"] != F.col("mine")), lambda x: x["node"])
        got = got.select(*GROUP, "run", F.array_join(others, "").alias("siblings"),
                         F.sha2(F.array_join(F.col("got.node"), ""), 256).alias("up"))
        state = written(state.join(got, [*GROUP, "run"], "left").select(
            *GROUP, "size", "run", F.coalesce("up", "node").alias("node"), "runs",
            F.when(F.col("up").isNull(), F.col("above"))
            .otherwise(F.concat("above", F.array("siblings"))).alias("above")), "butterfly")
        step *= FANOUT
    return state.drop("runs")


def placed(leaves: DataFrame, order: list[str], label: str) -> DataFrame:
    """The leaves with `pos` within their source and its `size`."""
    laid = written(numbered(leaves, GROUP, order, label), label)
    return laid.join(laid.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("size")), GROUP)


def _fold(node: str, at: int, siblings: list[str]) -> str:
    """Hashes a node up: `siblings` are texts of whole digests, level by level, `at` the node's number."""
    for others in siblings:
        cut = 64 * (at % FANOUT)
        node, at = hash_up([others[:cut], node, others[cut:]]), at // FANOUT
    return node


def proofs(leaves: DataFrame, tops: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(id, leaf, subroot, root, siblings, folded) of each leaf.

    leaves: known, source, size, pos, id, leaf, seen.  tops has a row for each run: known,
    source, run, size, above, subroot, and what is above the subroot: `place` (its number
    there), `further` (its siblings, level by level) and `root`.  `siblings` holds a text for
    each level from the leaf to the root, left to right; `folded` is the root computed from
    `seen` and them.  A run is met by its row of `tops`, which comes first; its tree is hashed
    again rather than shipped.  Runs are streamed.
    """
    span = FANOUT ** levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed():
            size, number, above, subroot, place, further, root = top
            up = levels if size > span else depth_of(size)
            rows, out = tree_levels([leaf for _, leaf, _ in held], up), []
            for k, (id_, leaf, seen) in enumerate(held):
                starts = [k // FANOUT ** level // FANOUT * FANOUT for level in range(up)]
                own = ["".join(rows[v][s:k // FANOUT ** v] + rows[v][k // FANOUT ** v + 1:s + FANOUT])
                       for v, s in enumerate(starts)]
                folded = _fold(_fold(_fold(seen, k, own), number, above), place, further)
                out.append((id_, leaf, subroot, root, own + above + further, folded))
            return _batch(out, PROOF)
        top, held = None, []
        for b in batches:
            for pos, id_, leaf, seen, *first in zip(*(c.to_pylist() for c in b.columns)):
                if pos >= 0:
                    held.append((id_, leaf, seen))
                    continue
                if held:
                    yield closed()
                top, held = first, []
        if held:
            yield closed()

    heads = ["run", "above", "subroot", "place", "further", "root"]
    rows = leaves.select(*GROUP, "size", F.floor(F.col("pos") / span).alias("run"), "pos", "id", "leaf", "seen") \
        .unionByName(tops.select(*GROUP, "size", F.lit(-1).cast("long").alias("pos"), *heads), allowMissingColumns=True)
    return rows.repartition(*GROUP, "run").sortWithinPartitions(*GROUP, "run", "pos") \
        .select("pos", "id", "leaf", "seen", "size", *heads).mapInArrow(run, _ddl(PROOF))


PROOF = [("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
         ("siblings", pa.list_(pa.string())), ("folded", pa.string())]


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, siblings, folded) of every row of a documents table.

    rows: doc_id, source, lang, n_chars, text, and `seen`, the text as it is found when it is
    verified.  Leaves of a source go by doc_id (nulls last), rows that share it by their hash;
    equal rows are leaves each.  A null source is one of its own, before all others.  An empty
    table has no rows and no root.  Other columns are not part of the leaf.
    """
    n = F.col("source").isNotNull()
    leaves = written(rows.select(
        n.alias("known"), F.coalesce("source", F.lit("")).alias("source"), id_of().alias("id"),
        leaf_digest().alias("leaf"), leaf_digest(text=F.col("seen")).alias("seen")), "leaves")
    leaves = written(placed(leaves, ["id", "leaf", "seen"], "placed"), "placed")
    runs = written(butterfly(run_roots(leaves, levels), levels), "runs")
    # the tree over the sources: their subroots are the leaves of one group
    subroots = runs.filter("run = 0").select(
        F.lit(True).alias("known"), F.lit("").alias("source"), F.col("known").alias("known_"),
        F.col("source").alias("source_"), F.col("node").alias("leaf"))
    subroots = written(placed(subroots, ["known_", "source_"], "subroots"), "subroots")
    over = written(butterfly(run_roots(subroots, levels), levels), "over").withColumn("subroot", F.col("node")) \
        .withColumn("root", F.col("node")).withColumn("place", F.lit(0).cast("long")) \
        .withColumn("further", F.array().cast("array<string>"))
    upper = proofs(subroots.withColumn("id", F.col("pos")).withColumn("seen", F.col("leaf")), over, levels)
    upper = written(upper.select(F.col("id").alias("place"), "root", F.col("siblings").alias("further")), "upper")
    of_source = subroots.select(F.col("known_").alias("known"), F.col("source_").alias("source"),
                                F.col("pos").alias("place")).join(upper, "place")
    tops = runs.withColumnRenamed("node", "subroot").join(of_source, GROUP)
    return proofs(leaves, tops, levels).withColumnRenamed("id", "doc_id")
