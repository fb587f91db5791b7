"""Reply trees: root-to-leaf paths by iterative self-joins, formatted as conversations."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm.common import id_of
from parley.plans.workspace import written

# The template's control strings.
PROMPT, REPLY = ("[INST]", "[/INST]"), ("<s>", "</s>")
CONTROL = r"\[/?INST\]|</?s>"
SPEAKS = "assistant"

_ANY, _ESCAPED = re.compile(rf"(\\*)({CONTROL})"), re.compile(rf"\\(\\*)({CONTROL})")
_MARK = re.compile(rf"(?<!\\)(?:{CONTROL})")
_PLAIN = re.compile(r"[A-Za-z_]+")


def escape(text: str) -> str:
    """Every control string gets a backslash before it and before those it already has."""
    return _ANY.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def formatted(turns) -> tuple[str, list[tuple[int, int]]]:
    """The conversation of (role, text) turns, and the code point spans under the loss mask.

    A turn is a mark, the role, a line end, the escaped text, a line end and the closing
    mark; a mark is never preceded by a backslash.  Roles that aren't letters are JSON texts.
    The mask covers the texts of the assistant.
    """
    parts, spans, at = [], [], 0
    for role, text in turns:
        begin, end = REPLY if role == SPEAKS else PROMPT
        head = f"{begin}{role if _PLAIN.fullmatch(role) else escape(json.dumps(role))}\n"
        body = escape(text)
        parts += head, body, f"\n{end}"
        if role == SPEAKS:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + 1 + len(end)
    return "".join(parts), spans


def read_back(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, begun = [], None
    for m in _MARK.finditer(text):
        if begun is None:
            begun = m.end()
        else:
            role, _, body = text[begun:m.start() - 1].partition("\n")
            turns.append((role if _PLAIN.fullmatch(role) else json.loads(unescape(role)), unescape(body)))
            begun = None
    return turns


def reply_chains(conversations: DataFrame) -> DataFrame:
    """(tree, id, parent, role, text, score): each row replies to the row before it.

    Rows of a conversation go by turn, then role, then text; null turns come first.  Null
    conversations are one conversation, null texts and roles are empty.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(
        id_of("conv_id").alias("tree"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("id", F.row_number().over(order).cast("long"))
    return rows.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"),
                       "role", "text", F.lit(0.0).alias("score"))


def branches(messages: DataFrame, keep: int = 1) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, leaf, depth, total) of each tree's best branches, and the tables of jumps.

    A branch is the path from a root to a message without replies; its score is the sum of
    its messages' scores.  The `keep` highest stay, ties going to the longer path, then the
    smaller leaf.  A message whose parent is missing is a root; messages that reply to each
    other in a circle have no root and belong to no path.

    Every self-join doubles how far each message looks up, so the rounds are the logarithm
    of the deepest path.  Table k of the jumps has the ancestors 2^k messages up.  Messages
    that have reached their root leave the joins.
    """
    ids = messages.select("tree", F.col("id").alias("known"))
    own = messages.select("tree", "id", "parent", F.coalesce("score", F.lit(0.0)).alias("total"))
    up = own.filter("parent IS NOT NULL").join(
        ids, (own.tree == ids.tree) & (F.col("parent") == F.col("known")), "left") \
        .select(own.tree, "id", F.col("known").alias("up"), "total") \
        .unionByName(own.filter("parent IS NULL").select("tree", "id", F.lit(None).cast("long").alias("up"), "total"))
    state = written(up.withColumn("depth", F.lit(1).cast("long")), "jumps")
    done, jumps, open_ = [], [], None
    while True:
        done.append(state.filter("up IS NULL").drop("up"))
        active = state.filter("up IS NOT NULL")
        left = active.count()
        if not left or left == open_:    # only circles remain
            break
        open_ = left
        jumps.append(active.select("tree", "id", "up"))
        further = state.select("tree", F.col("id").alias("at"), F.col("up").alias("next"),
                               F.col("total").alias("t"), F.col("depth").alias("n"))
        for known in done[:-1]:
            further = further.unionByName(known.select(
                "tree", F.col("id").alias("at"), F.lit(None).cast("long").alias("next"),
                F.col("total").alias("t"), F.col("depth").alias("n")))
        state = written(active.join(further, (active.tree == further.tree) & (F.col("up") == F.col("at")))
                        .select(active.tree, "id", F.col("next").alias("up"),
                                (F.col("total") + F.col("t")).alias("total"),
                                (F.col("depth") + F.col("n")).alias("depth")), "jumps")
    rooted = done[0]
    for more in done[1:]:
        rooted = rooted.unionByName(more)
    replied = messages.filter("parent IS NOT NULL").select("tree", F.col("parent").alias("id")).distinct()
    leaves = rooted.join(replied, ["tree", "id"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("depth"), "id")
    chosen = leaves.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= keep)
    return written(chosen.select("tree", F.col("id").alias("leaf"), "depth", "total"), "branches"), jumps


def paths(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(tree, leaf, id, pos) of every message on the chosen branches, roots at position 1.

    From the farthest jumps to the nearest, each join adds the ancestors so many messages up.
    """
    found = chosen.select("tree", "leaf", F.col("leaf").alias("id"), F.col("depth").alias("pos"))
    for k in reversed(range(len(jumps))):
        higher = found.join(jumps[k], ["tree", "id"]).select(
            "tree", "leaf", F.col("up").alias("id"), (F.col("pos") - 2 ** k).alias("pos"))
        found = written(found.unionByName(higher), "paths")
    return found


OUT = "tree long, leaf long, formatted string, loss array<struct<start:int,end:int>>"


def format_branches(messages: DataFrame, keep: int = 1) -> DataFrame:
    """(tree, leaf, formatted, loss): each chosen path as one conversation.

    messages: tree, id, parent (long), role, text, score.  Equal (tree, id) rows aren't
    expected; an empty table gives no rows.  Messages are sorted by path and position and
    streamed, so a task holds one conversation at a time.
    """
    chosen, jumps = branches(messages, keep)
    on_path = paths(chosen, jumps)
    turns = on_path.join(messages.select("tree", "id", "role", "text"), ["tree", "id"]) \
        .repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "pos") \
        .select("tree", "leaf", "role", "text")
    return turns.mapInArrow(_format, OUT)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, turns, out = None, [], []
    for b in batches:
        for tree, leaf, role, text in zip(*(c.to_pylist() for c in b.columns)):
            if (tree, leaf) != key:
                if turns:
                    out.append((*key, *formatted(turns)))
                key, turns = (tree, leaf), []
            turns.append((role, text))
        if out:
            yield _batch(out)
            out = []
    if turns:
        yield _batch([(*key, *formatted(turns))])


def _batch(out) -> pa.RecordBatch:
    trees, leaves, texts, spans = zip(*out)
    loss = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans],
                    pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
    return pa.RecordBatch.from_arrays(
        [pa.array(trees, pa.int64()), pa.array(leaves, pa.int64()), pa.array(texts, pa.string()), loss],
        ["tree", "leaf", "formatted", "loss"])


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


def digests(conversations: DataFrame) -> DataFrame:
    """What the formatted conversations say when they are read back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for tree, text, loss in zip(b.column(0).to_pylist(), b.column(2), b.column(3).to_pylist()):
                text = text.as_py()
                turns = read_back(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                masked = "".join(unescape(text[s["start"]:s["end"]]) for s in loss)
                out.append((tree, len(turns), sha256(said.encode()).hexdigest(), len(masked),
                            sha256(masked.encode()).hexdigest(), len(text)))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 [x.split()[0] for x in DIGEST.split(", ")])
    return conversations.mapInArrow(run, DIGEST)
