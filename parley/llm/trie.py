"""Prefix trie of conversations, rolled up over subtrees by centroid decomposition."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm.common import NO_ID, WORD, id_of
from parley.llm.ranked import numbered
from parley.plans.workspace import written

#: Rebuilt conversations begin with 0 to HEADS - 1 turns of the conversation at the multiple of EVERY.
EVERY, HEADS = 20, 4
#: Turns whose running sums are taken in one window.
BLOCK = 4096
#: A prefix is known by so many sums of 31-bit hashes of its turns and their positions.
SUMS = 4
#: Components of at most so many nodes are finished in one task.
LIMIT = 1 << 15
#: Ids of a piece of the text that is hashed for a node's ends.
PIECE = 4096
COMP = ["top", "top_depth"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(c, p, h1, h2, words): the turns of each conversation, numbered from 0.

    Turns go by `turn` (null first), then role, then text; null role and text are empty.  Null
    conv_ids are one conversation.  h1 and h2 are hashes of role and text, words those of the text.
    """
    rows = conversations.select(
        id_of("conv_id").alias("c"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return numbered(rows, ["c"], ["turn", "role", "text"], "turns").select(
        "c", F.col("pos").alias("p"), F.xxhash64(F.lit(1), "role", "text").alias("h1"),
        F.xxhash64(F.lit(2), "role", "text").alias("h2"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns (c, p, h1, h2, words, len) and the conversations (c, len) with shared heads.

    Conversation c begins with the first h turns of conversation c - c % 20, if there is one, and goes on
    with its own turns after its first h, h being crc32 of its decimal id modulo 4.  The
    conversation without an id stays as it is.
    """
    own = turns.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    h = F.when(F.col("c") == NO_ID, F.lit(0)).otherwise(F.crc32(F.col("c").cast("string")) % HEADS).cast("long")
    wanted = own.select("c", "n", h.alias("h"), (F.col("c") - F.pmod("c", F.lit(EVERY))).alias("b"))
    base = own.select(F.col("c").alias("b"), F.col("n").alias("n_b"))
    convs = wanted.join(base, "b", "left").withColumn("got", F.least("h", F.coalesce("n_b", F.lit(0)))) \
        .withColumn("len", F.col("got") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = written(convs, "conversations")
    heads = convs.filter("got > 0").select("c", "b", "got", "len").join(
        turns.filter(F.col("p") < HEADS - 1).withColumnRenamed("c", "b"), "b").filter("p < got")
    rest = convs.filter("n > h").select("c", "h", "got", "len").join(turns, "c").filter("p >= h") \
        .withColumn("p", F.col("p") - F.col("h") + F.col("got"))
    columns = ["c", "p", "h1", "h2", "words", "len"]
    return heads.select(*columns).unionByName(rest.select(*columns)), convs.select("c", "len")


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rebuilt(written(ordered_turns(conversations), "ordered"))


def _key(sums: list[Column], depth: Column) -> list[Column]:
    return [F.xxhash64(F.lit(k), depth, *sums) for k in (11, 12)]


def prefixes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The turns with k1, k2, the key of the sequence that ends there, and up1, up2, that of its parent.

    Sums of hashes of (position, turn) are running sums, so long conversations are cut into
    blocks; whoever has the same turns at the same positions has the same sums.
    """
    parts = [F.xxhash64(F.lit(k), "p", "h1", "h2").bitwiseAND(F.lit((1 << 31) - 1)).alias(f"x{k}") for k in range(SUMS)]
    rows = written(turns.select("c", "p", "words", "len", F.floor(F.col("p") / block).alias("block"), *parts), "hashed")
    totals = rows.groupBy("c", "block").agg(*[F.sum(f"x{k}").alias(f"y{k}") for k in range(SUMS)])
    before = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("c", "block", *[F.coalesce(F.sum(f"y{k}").over(before), F.lit(0)).alias(f"y{k}")
                                         for k in range(SUMS)])
    inside = Window.partitionBy("c", "block").orderBy("p")
    sums = rows.withColumns({f"s{k}": F.sum(f"x{k}").over(inside) for k in range(SUMS)}).join(base, ["c", "block"])
    now = [F.col(f"y{k}") + F.col(f"s{k}") for k in range(SUMS)]
    up = [F.col(f"y{k}") + F.col(f"s{k}") - F.col(f"x{k}") for k in range(SUMS)]
    (k1, k2), (up1, up2) = _key(now, F.col("p") + 1), _key(up, F.col("p"))
    return sums.select("c", (F.col("p") + 1).alias("depth"), "words", "len", k1.alias("k1"), k2.alias("k2"),
                       up1.alias("up1"), up2.alias("up2"))


def trie_nodes(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """(k1, k2, m, depth, up, n_convs, words, weight): the distinct prefixes, and the root.

    m is the smallest conversation that begins with it, and with `depth` names the node; up is
    the parent's.  weight counts the turns, at it and below, of all these conversations.
    """
    root = [F.lit(0).cast("long")] * SUMS
    r1, r2 = _key(root, F.lit(0).cast("long"))
    nodes = steps.groupBy("k1", "k2").agg(
        F.min("c").alias("m"), F.min("depth").alias("depth"), F.min("up1").alias("up1"), F.min("up2").alias("up2"),
        F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight"))
    top = convs.agg(F.min("c").alias("m"), F.count(F.lit(1)).alias("n_convs"), (F.sum("len") + 1).alias("weight")) \
        .filter("m IS NOT NULL").select(
            r1.alias("k1"), r2.alias("k2"), "m", F.lit(0).cast("long").alias("depth"),
            F.lit(None).cast("long").alias("up1"), F.lit(None).cast("long").alias("up2"), "n_convs",
            F.lit(0).cast("long").alias("words"), "weight")
    nodes = written(nodes.unionByName(top), "nodes")
    parents = nodes.select(F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("m").alias("up"))
    return nodes.join(parents, ["up1", "up2"], "left").select(
        "k1", "k2", "m", "depth", "up", "n_convs", "words", "weight")


def subtree_sums(nodes: DataFrame, places: DataFrame, values: list[str], limit: int = LIMIT) -> DataFrame:
    """(m, depth, and the values summed over the subtree) of each node.

    nodes: m, depth, up, weight, values.  places: (c, depth, m, next): the node where
    conversation c is at a depth, and where it goes from there.

    Round by round every component of over `limit` nodes is split at its centroid, the deepest
    node whose subtree has over half the component's weight.  What is below it in the component
    is summed and added to the nodes on the path from it to the component's top: those of at most
    its depth with over half the weight.  The centroid is then done; its children's subtrees and
    the rest are components with half the weight at most, so the rounds are the logarithm of the
    number of turns, however deep or wide the tree is.  A node's subtree total is what it has
    gathered: each node below it is added once, when the two are parted.  Components within the limit
    are finished by the same method in one task each.

    Whether a node is below the centroid is asked once for each conversation that names nodes of
    the component: it is if that conversation is at the centroid at its depth.
    """
    sums = [f"sum_{v}" for v in values]
    root = nodes.filter("depth = 0").select(F.col("m").alias("top"), F.lit(0).cast("long").alias("top_depth"))
    one = Window.partitionBy()
    state = nodes.select("m", "depth", "up", "weight", *values, *[F.lit(0).cast("long").alias(s) for s in sums]) \
        .join(F.broadcast(root))                                        # one row
    ready, small = [], []
    while True:
        sized = state.groupBy(*COMP).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("whole"))
        met = written(state.join(sized, COMP), "components")
        small.append(met.filter(F.col("n") <= limit).drop("n", "whole"))
        large = met.filter(F.col("n") > limit).drop("n")
        if large.isEmpty():
            break
        centre = large.filter(2 * F.col("weight") > F.col("whole")).groupBy(*COMP).agg(
            F.max(F.struct("depth", "m", "weight")).alias("centre"))
        centre = written(centre.select(*COMP, F.col("centre.depth").alias("at"), F.col("centre.m").alias("at_m"),
                                       F.col("centre.weight").alias("cut")), "centroids")
        named = large.groupBy(*COMP, "m").agg(F.max("depth").alias("last")).join(centre, COMP).filter("last >= at")
        below = named.select(*COMP, F.col("m").alias("c"), F.col("at").alias("depth"), "at_m").join(
            places.withColumnRenamed("m", "there"), ["c", "depth"]).filter("there = at_m") \
            .select(*COMP, F.col("c").alias("m"), "next", F.lit(True).alias("below"))
        parted = large.join(centre, COMP).join(below, [*COMP, "m"], "left") \
            .withColumn("below", F.coalesce("below", F.lit(False)) & (F.col("depth") >= F.col("at")))
        parted = written(parted, "parted")
        total = parted.filter("below").groupBy(*COMP).agg(*[F.sum(v).alias(f"add_{v}") for v in values])
        path = (F.col("depth") <= F.col("at")) & (2 * F.col("weight") > F.col("whole"))
        centroid = F.col("below") & (F.col("depth") == F.col("at"))
        grown = parted.join(total, COMP).select(
            "m", "depth", "up", F.when(path, F.col("weight") - F.col("cut")).otherwise(F.col("weight")).alias("weight"),
            *values, *[(F.col(s) + F.when(path, F.col(f"add_{v}")).otherwise(0)).alias(s) for s, v in zip(sums, values)],
            F.when(F.col("below"), F.col("next")).otherwise(F.col("top")).alias("top"),
            F.when(F.col("below"), F.col("at") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            centroid.alias("done"))
        grown = written(grown, "grown")
        ready.append(grown.filter("done").select("m", "depth", *sums))
        state = grown.filter("NOT done").drop("done")
    rest = small[0]
    for more in small[1:]:
        rest = rest.unionByName(more)
    out = _finished(rest, values, sums)
    for some in ready:
        out = out.unionByName(some)
    return out.select("m", "depth", *[F.col(s).alias(v) for s, v in zip(sums, values)])


def centroid_sums(parent: list[int], weight: list[int], values: list[list[int]], sums: list[list[int]]) -> None:
    """Adds to `sums` the subtree totals of one component; nodes go by depth, the top first.

    weight: turns at a node and below it within the component; it is used up.
    """
    side, stack = [0] * len(parent), [list(range(len(parent)))]
    while stack:
        comp = stack.pop()
        top, whole = comp[0], weight[comp[0]]
        centre = next(u for u in reversed(comp) if 2 * weight[u] > whole)
        rest, parts = [], {}
        for u in comp:
            if u == centre:
                side[u] = u
                continue
            over = side[parent[u]] if u != top else -1
            side[u] = u if over == centre else over
            if side[u] < 0:
                rest.append(u)
            else:
                parts.setdefault(side[u], []).append(u)
        below = [centre, *(u for part in parts.values() for u in part)]
        adds, cut, u = [sum(v[x] for x in below) for v in values], weight[centre], centre
        while True:
            for s, add in zip(sums, adds):
                s[u] += add
            if u == top:
                break
            u = parent[u]
            weight[u] -= cut
        stack += [part for part in (rest, *parts.values()) if part]


def _finished(rows: DataFrame, values: list[str], sums: list[str]) -> DataFrame:
    """(m, depth, sums) of whole components, each in one task; a task holds one at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed():
            cols = [list(c) for c in zip(*held)]
            m, depth, up, weight = cols[:4]
            where = {x: k for k, x in enumerate(zip(m, depth))}
            parent = [where.get((u, d - 1), -1) for u, d in zip(up, depth)]
            got = cols[4 + len(values):]
            centroid_sums(parent, weight, cols[4:4 + len(values)], got)
            for k, c in enumerate((m, depth, *got)):
                out[k] += c
        key, held, out = None, [], [[] for _ in range(2 + len(sums))]
        for b in batches:
            for top, top_depth, *row in zip(*(c.to_pylist() for c in b.columns)):
                if (top, top_depth) != key:
                    if held:
                        closed()
                    key, held = (top, top_depth), []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["m", "depth", *sums])
            out = [[] for _ in out]
        if held:
            closed()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["m", "depth", *sums])
    return rows.repartition(*COMP).sortWithinPartitions(*COMP, "depth") \
        .select(*COMP, "m", "depth", "up", "weight", *values, *sums) \
        .mapInArrow(run, ", ".join(f"{c} long" for c in ["m", "depth", *sums]))


def id_digests(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """(m, depth, digest): SHA-256 of the decimal ids c of each node, ascending and comma-joined.

    Sorted ranges are first joined to pieces of many ids where they are, so one node's pieces,
    not its ids, meet in a task, which streams them.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for b in batches:
            out = []
            for m, depth, c in zip(*(x.to_pylist() for x in b.columns)):
                if (m, depth) != key or len(held) == piece:
                    if held:
                        out.append((*key, held[0], _ids(held)))
                    key, held = (m, depth), []
                held.append(c)
            yield _pieces(out)
        if held:
            yield _pieces([(*key, held[0], _ids(held))])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, None
        for b in batches:
            out = []
            for m, depth, text in zip(*(x.to_pylist() for x in b.columns)):
                if (m, depth) != key:
                    if key:
                        out.append((*key, now.hexdigest()))
                    key, now = (m, depth), sha256(text.encode())
                else:
                    now.update(b"," + text.encode())
            yield _digests(out)
        if key:
            yield _digests([(*key, now.hexdigest())])

    cut = rows.repartitionByRange("m", "depth", "c").sortWithinPartitions("m", "depth", "c") \
        .select("m", "depth", "c").mapInArrow(pieces, "m long, depth long, first long, ids string")
    return cut.repartition("m", "depth").sortWithinPartitions("m", "depth", "first") \
        .select("m", "depth", "ids").mapInArrow(digests, "m long, depth long, digest string")


def _ids(ids) -> str:
    return ",".join("null" if c == NO_ID else str(c) for c in ids)


def _pieces(rows) -> pa.RecordBatch:
    m, d, c, t = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(m, pa.int64()), pa.array(d, pa.int64()), pa.array(c, pa.int64()),
                                       pa.array(t, pa.string())], ["m", "depth", "first", "ids"])


def _digests(rows) -> pa.RecordBatch:
    m, d, t = list(zip(*rows)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(m, pa.int64()), pa.array(d, pa.int64()), pa.array(t, pa.string())],
                                      ["m", "depth", "digest"])


def prefix_trie(turns: DataFrame, convs: DataFrame, limit: int = LIMIT, block: int = BLOCK,
                piece: int = PIECE) -> DataFrame:
    """(m, depth, up, n_convs, n_children, n_leaves, saved_tokens, digest) of every node.

    turns: c, p (0, 1, ...), h1, h2 (hashes of the turn), words, len; convs: c, len of all
    conversations, turnless ones too.  n_children counts a node's children and n_leaves the
    childless nodes of its subtree; saved_tokens sums (n_convs - 1) * words over the subtree: what
    a model need not read again.  digest is that of the ids of the conversations that end there.
    No conversations give no rows, not even the root.
    """
    steps = written(prefixes(turns, block), "steps")
    nodes = written(trie_nodes(steps, convs), "trie")
    at = written(steps.join(nodes.select("k1", "k2", "m"), ["k1", "k2"]).select("c", "depth", "len", "m")
                 .unionByName(convs.select("c", F.lit(0).cast("long").alias("depth"), "len")
                              .join(F.broadcast(nodes.filter("depth = 0").select("m")))), "places")
    onward = at.select("c", (F.col("depth") - 1).alias("depth"), F.col("m").alias("next")).filter("depth >= 0")
    places = written(at.join(onward, ["c", "depth"], "left").select("c", "depth", "m", "next"), "onward")
    children = nodes.filter("up IS NOT NULL").groupBy(F.col("up").alias("m"), (F.col("depth") - 1).alias("depth")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    known = written(nodes.join(children, ["m", "depth"], "left").select(
        "m", "depth", "up", "n_convs", "weight", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
        .withColumn("n_leaves", (F.col("n_children") == 0).cast("long")), "known")
    summed = subtree_sums(known, places, ["n_leaves", "saved_tokens"], limit)
    ends = id_digests(at.filter("depth = len").select("m", "depth", "c"), piece)
    return known.drop("n_leaves", "saved_tokens", "weight").join(summed, ["m", "depth"]) \
        .join(ends, ["m", "depth"], "left").select(
            "m", "depth", "up", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("digest"))
