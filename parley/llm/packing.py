"""Packing of tokenized documents into sequences by minimum bin slack."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm.common import text_of
from parley.llm.tokens import encoder
from parley.plans.workspace import written

CAPACITY, END = 1024, 2
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, block int, no long"


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full ones but for the first."""
    at, size = 0, n % capacity or min(n, capacity)
    while at < n:
        yield at, size
        at, size = at + size, capacity


def pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, ranks: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """One row per piece of each document's ids: the ids of its whole text, then `end`.

    Only documents of over `capacity` ids are cut; their first piece may be shorter.  Null
    text is empty: its only id is `end`.  `block` is the task and `no` counts a block's
    pieces of one length from 0.  with_ids adds the ids as array<int>.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, last = encoder(ranks), end.to_bytes(4, "little")
        block, seen = TaskContext.get().partitionId(), Counter()
        for b in batches:
            out: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = enc.all_ids(text.as_py()) + last
                for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start:4 * (start + n)]
                    row = (doc, k, start, n, zlib.crc32(own), block, seen[n])
                    out.append((*row, np.frombuffer(own, "<u4").astype(np.int32)) if with_ids else row)
                    seen[n] += 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    names = [*(x.split()[0] for x in PIECE.split(", ")), *["ids"] * with_ids]
    i32, i64 = pa.int32(), pa.int64()
    types = [i64, i32, i64, i64, i64, i32, i64, pa.list_(i32)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")) \
        .mapInArrow(run, PIECE + ", ids array<int>" * with_ids)


def fullest(seed: int, left: dict[int, int], capacity: int) -> Counter:
    """The multiset of lengths, `seed` among them, that fills a bin best.

    Bit s of `reach` says that lengths taken so far can sum to s; each step offers some
    copies of one length, longest first, and remembers what was reachable before it.
    """
    room, reach, steps = capacity - seed, 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((x for x in left if x <= room), reverse=True):
        free, some = min(left[length] - (length == seed), room // length), 1
        while free > 0 and not reach >> room:
            take = min(some, free)
            now = (reach | reach << length * take) & mask
            if now != reach:
                steps.append((length, take, reach))
                reach = now
            free, some = free - take, some * 2
        if reach >> room:
            break
    used, total = Counter([seed]), reach.bit_length() - 1
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] += take
            total -= length * take
    return used


def slack_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, Counter]]:
    """(how many bins, the lengths in each) until all pieces are placed.

    Each bin starts with the longest piece left and gets the fullest feasible combination of
    the rest, which is then removed; while enough pieces are left the same combination is
    again the fullest, so it is removed as many times at once.  The work depends on the
    number of different lengths, `capacity` at most, not on the number of pieces.
    """
    left, plan = {k: n for k, n in counts.items() if n}, []
    while left:
        used = fullest(max(left), left, capacity)
        times = min(left[x] // m for x, m in used.items())
        plan.append((times, used))
        for x, m in used.items():
            left[x] -= times * m
            if not left[x]:
                del left[x]
    return plan


def _by_length(plan: list[tuple[int, Counter]]) -> dict[int, np.ndarray]:
    """For each length rows of (first rank, first bin, copies in a bin, offset), by rank."""
    rows, given, bins = defaultdict(list), Counter(), 0
    for times, used in plan:
        offset = 0
        for length in sorted(used, reverse=True):
            m = used[length]
            rows[length].append((given[length], bins, m, offset))
            given[length] += times * m
            offset += m * length
        bins += times
    return {length: np.array(r, np.int64).T for length, r in rows.items()}


def pack(docs: DataFrame, capacity: int = CAPACITY, end: int = END,
         ranks: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Sequences hold `capacity` ids at most, without gaps.  See `pieces` for how documents are
    cut and `slack_plan` for the method.  Repeated rows are packed each; a null doc_id stays
    null; an empty table gives no rows; other columns of docs are not read.

    The pieces are written, without their ids, to the shared folder.  Only the histogram of
    lengths, `capacity` rows at most, reaches the driver.  A piece's rank among those of its
    length is the number in earlier blocks plus that in its own, so no task numbers all
    pieces of a frequent length.
    """
    table = written(pieces(docs, capacity, end, ranks), "pieces")
    counts = written(table.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # one row per length, 1 to capacity
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _by_length(slack_plan(histogram, capacity))
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")
    ranked = table.join(counts.select("length", "block", earlier.alias("base")), ["length", "block"]) \
        .select("doc_id", "piece", "start", "length", "ids_crc32",
                (F.col("base") + F.col("no")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, ranks_ = b.column(3).to_numpy(), b.column(5).to_numpy()
            sequence, offset = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                first, bins, copies, begin = places[int(length)]
                k = np.searchsorted(first, ranks_[at], "right") - 1
                beyond = ranks_[at] - first[k]
                sequence[at] = bins[k] + beyond // copies[k]
                offset[at] = begin[k] + beyond % copies[k] * length
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)],
                                             [*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, "
                                  "ids_crc32 long, sequence_id long, offset long")


def sequences(docs: DataFrame, packed: DataFrame, capacity: int = CAPACITY, end: int = END,
              ranks: str | None = None) -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets): the packed sequences themselves.

    docs: the table that was packed, without repeated rows.
    """
    ids = pieces(docs, capacity, end, ranks, with_ids=True).select("doc_id", "piece", "ids")
    parts = packed.join(ids, packed.doc_id.eqNullSafe(ids.doc_id) & (packed.piece == ids.piece)) \
        .groupBy("sequence_id").agg(F.array_sort(F.collect_list(
            F.struct("offset", packed.doc_id, "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"),
                        F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"))
