"""Groups of similar documents by wide SimHash fingerprints, compared in blocks of like size.

The 64-bit fingerprints of `simhash` can't tell a similarity of 0.8 from chance: at the 12
differing bits it allows, one pair of unrelated texts in four million links.  Four words make
that less than one in 10^20, and keep copies with a fifth of their shingles changed.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import same_and_smallest

WORDS, SIMILARITY, SEED = 5, 0.8, 42
#: 64-bit words of a fingerprint.
PARTS = 4
#: Rows of a block, on average; two blocks are compared by one call.
BLOCK = 1 << 16
#: Rows compared at a time, so that a step fits the cache; links held before they are reduced.
ROWS, COLUMNS, HELD = 32, 4096, 1 << 14
#: Size classes to which a document within the similarity may differ.
STEPS = 4
CELL = ["a", "a_no", "b", "b_no"]
# The mixing constants of splitmix64.
GOLDEN, MIX_1, MIX_2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th hash made of a shingle's first: that itself, then splitmix64 of it."""
    if not k:
        return h
    with np.errstate(over="ignore"):
        z = h + GOLDEN * np.uint64(k)
        z = (z ^ (z >> np.uint64(30))) * MIX_1
        z = (z ^ (z >> np.uint64(27))) * MIX_2
    return z ^ (z >> np.uint64(31))


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """How many of the wide hashes made of these have each bit set."""
    total = np.zeros(64 * PARTS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        h = hashes[at:at + (1 << 14)].astype("<u8")
        wide = np.stack([_mixed(h, k) for k in range(PARTS)], axis=1)
        bits = np.unpackbits(wide.view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little")
        # sums of 255 rows fit a byte
        total += np.add.reduceat(bits, range(0, len(h), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return total


def _size_class(n: Column, similarity: float) -> Column:
    """Numbers of shingles on a logarithmic scale; similar documents differ by STEPS at most."""
    return F.floor(F.log(n) / (log(1 / similarity) / STEPS * (1 + 1e-9))).cast("int")


def _near(x: np.ndarray, y: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of two blocks that differ in `radius` bits or fewer; blocks are parts by rows.

    Both are in order of population count, which never differs by more than the bits do, so
    rows meet only the part of the other block within the radius.  A pair that differs too
    much in all words but the last is out; only the others see the last.
    """
    counts = [np.bitwise_count(v).sum(axis=0, dtype=np.int64) for v in (x, y)]
    ox, oy = (np.argsort(c, kind="stable") for c in counts)
    x, y, cx, cy = x[:, ox], y[:, oy], counts[0][ox], counts[1][oy]
    most = PARTS - 1
    room, few, more = np.empty(ROWS * COLUMNS, np.uint64), *np.empty((2, ROWS * COLUMNS), np.uint8)
    for at in range(0, x.shape[1], ROWS):
        some = x[:, at:at + ROWS]
        low, high = np.searchsorted(cy, [cx[at] - radius, cx[at:at + ROWS][-1] + radius + 1])
        for begin in range(low, high, COLUMNS):
            other = y[:, begin:min(begin + COLUMNS, high)]
            shape = some.shape[1], other.shape[1]
            z, d, e = (v[:shape[0] * shape[1]].reshape(shape) for v in (room, few, more))
            np.bitwise_count(np.bitwise_xor(some[0][:, None], other[0], out=z), out=d)
            for k in range(1, most):
                d += np.bitwise_count(np.bitwise_xor(some[k][:, None], other[k], out=z), out=e)
            near = d <= radius
            if near.any():
                i, j = np.nonzero(near)
                full = d[i, j].astype(np.int64)
                for k in range(most, PARTS):
                    full += np.bitwise_count(some[k][i] ^ other[k][j])
                ok = full <= radius
                yield ox[at + i[ok]], oy[begin + j[ok]]


def block_links(left: pa.Table, right: pa.Table, radius: int, similarity: float) -> pa.Table:
    """One link from each row of two blocks to the smallest of its group, if it has another."""
    ids = [t["id"].to_numpy() for t in (left, right)]
    n = [t["n"].to_numpy() for t in (left, right)]
    x, y = (np.array([t[f"w{k}"].to_numpy().view(np.uint64) for k in range(PARTS)]) for t in (left, right))
    nodes, place = np.unique(np.concatenate(ids), return_inverse=True)
    of_x, of_y = place[:len(ids[0])], place[len(ids[0]):]
    labels, held, count = np.arange(len(nodes)), [], 0
    if len(ids[0]) and len(ids[1]):
        for i, j in _near(x, y, radius):
            fewer, more = np.minimum(n[0][i], n[1][j]), np.maximum(n[0][i], n[1][j])
            like = (fewer >= similarity * more) & (of_x[i] != of_y[j])
            if like.any():
                held.append((of_x[i[like]], of_y[j[like]]))
                count += len(held[-1][0])
            if count > HELD:
                labels = same_and_smallest(*map(np.concatenate, zip(*held)), labels)
                held, count = [], 0
    if held:
        labels = same_and_smallest(*map(np.concatenate, zip(*held)), labels)
    own = np.flatnonzero(labels != np.arange(len(nodes)))
    return pa.table({"a": pa.array(nodes[own], pa.int64()), "b": pa.array(nodes[labels[own]], pa.int64())})


def similar_links(classes: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK,
                  radius: int | None = None) -> DataFrame:
    """(a, b): links that join all classes that are similar.

    classes: id, n, w0..w3, one row per fingerprint and size.  Two are similar if the share of
    equal bits and the ratio of their sizes are both `similarity` or more; `radius` sets
    another number of differing bits.  Rows are dealt into
    blocks of about `block` of one size class; blocks meet those of the size classes within
    the ratio, every pair of blocks as its own group, so a frequent size is many groups and
    no group grows with the table.  Within a group all pairs are compared; what leaves it is
    a forest, not the pairs: a group of k similar classes gives k - 1 links.
    """
    if radius is None:
        radius = int(64 * PARTS * (1 - similarity) + 1e-9)
    signed = classes.filter("n > 0").withColumn("a", _size_class(F.col("n"), similarity))
    # a row per size class: some 800 for texts of up to 2^63 shingles
    split = signed.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("of"))
    rows = signed.join(F.broadcast(split), "a") \
        .withColumn("a_no", F.pmod(F.xxhash64("id", F.lit("block")), F.col("of")).cast("int")).drop("of")
    others = split.select(F.col("a").alias("b"), "of")
    reach = F.explode(F.array(*map(F.lit, range(STEPS + 1)))).alias("step")
    columns = ["id", "n", *(f"w{k}" for k in range(PARTS))]

    def dealt(sign: int) -> DataFrame:
        """Each row once for every block that its own meets, above it or below."""
        met = rows.select("*", reach).withColumn("b", F.col("a") + sign * F.col("step")) \
            .join(F.broadcast(others), "b") \
            .withColumn("b_no", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
        met = met.filter(F.col("step").cast("boolean") | (sign * (F.col("b_no") - F.col("a_no")) >= 0))
        cell = CELL if sign > 0 else ["b", "b_no", "a", "a_no"]
        # new names for both sides, which come from one table
        return met.select(*[F.col(o).alias(c) for c, o in zip(CELL, cell)], *[F.col(c).alias(c) for c in columns])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        return block_links(left, right, radius, similarity)

    return dealt(1).groupBy(*CELL).cogroup(dealt(-1).groupBy(*CELL)).applyInArrow(compare, "a long, b long")
