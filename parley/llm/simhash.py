"""Near-duplicates by SimHash: tiled exact comparison of 64-bit fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import (NO_ID, id_of, in_rows, out_rows, same_and_smallest, text_of,
                               word_blocks)
from parley.llm.components import components
from parley.plans.workspace import written

WORDS, RADIUS, SEED = 3, 2, 42
#: Fingerprints of a tile, on average; a comparison of two tiles looks at 256 rows at a time.
TILE, ROWS = 2048, 256
#: Links that a task holds before it reduces them to one per fingerprint.
HELD = 1 << 20
#: A fingerprint is four parts of 16 bits; each has 0 to 16 bits set.
PARTS, LEVELS = 4, 17


def simhash(text: bytes, words: int = WORDS) -> int:
    """The majority bits of the XXH64 of all shingles, repeats included; 0 without words."""
    tail: list[bytes] = []
    total, n = np.zeros(64, np.int64), 0
    for block in word_blocks(text.lower()):
        tail += block
        hashes = [xxhash.xxh64_intdigest(b" ".join(s), SEED)
                  for s in zip(*(tail[k:] for k in range(words)))]
        for at in range(0, len(hashes), 1 << 16):
            part = np.array(hashes[at:at + (1 << 16)], "<u8")
            total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                                   bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
        tail = tail[max(0, len(tail) - words + 1):]
    if not n:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED) if tail else 0
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(d, t, fp): each row's doc_id, hash of its text and fingerprint of its whole text.

    A null doc_id is the largest number, null text is empty; fp is a signed long.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).cast(pa.binary())
            fps = np.fromiter((simhash(x.as_py(), words) for x in texts), np.uint64, len(b))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["d", "t", "fp"])
    return docs.select(id_of().alias("d"), F.xxhash64(text_of()).alias("t"),
                       text_of().alias("text")).mapInArrow(run, "d long, t long, fp long")


def _signature(fp):
    """How many bits each part has, as one number below 17^4 = 83,521."""
    parts = [F.bit_count(F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF)))
             for k in range(PARTS)]
    return sum((p * LEVELS ** k for k, p in enumerate(parts)), F.lit(0)).cast("int")


def _steps(radius: int) -> list[tuple[int, ...]]:
    """The differences of two signatures within the radius, one of each pair of opposites."""
    near = [d for d in product(range(-radius, radius + 1), repeat=PARTS)
            if sum(map(abs, d)) <= radius]
    return [d for d in near if d >= (0,) * PARTS]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One link from each fingerprint to the smallest of its group."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    labels = same_and_smallest(at[:len(a)], at[len(a):], np.arange(len(nodes)))
    own = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[own], nodes[labels[own]]


def _compare(x: np.ndarray, y: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles, reduced block by block."""
    links_a, links_b = [], []
    for at in range(0, len(x), ROWS):
        near = np.bitwise_count(x[at:at + ROWS, None] ^ y[None, :]) <= radius
        i, j = np.nonzero(near)
        if len(i):
            a, b = x[at + i], y[j]
            if differ := np.flatnonzero(a != b).size:
                a, b = _forest(a, b) if differ > ROWS else (a, b)
                links_a.append(a)
                links_b.append(b)
    if not links_a:
        return x[:0], x[:0]
    return _forest(np.concatenate(links_a), np.concatenate(links_b))


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links that join all fingerprints differing in `radius` bits or fewer.

    fps: distinct longs in a column fp.  Fingerprints with the same number of bits set in
    each of four parts share tiles of about `tile`; two numbers of set bits never differ by
    more than the bits do, part by part, so only tiles whose counts differ by `radius` in sum
    meet, and every pair within them is compared.  A task keeps the links as a forest: a
    group of k fingerprints leaves k - 1 of its links, not all pairs, and loses none of its
    connections.  Frequent signatures are many tiles, dealt out by a hash.
    """
    signed = fps.select("fp", _signature(F.col("fp")).alias("sig"))
    # at most 83,521 rows, whatever the input
    split = signed.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / tile).alias("n"))
    tiles = written(signed.join(F.broadcast(split), "sig")
                    .groupBy("sig", F.pmod(F.xxhash64("fp"), F.col("n")).alias("no"))
                    .agg(F.collect_list("fp").alias("fps")), "tiles")
    steps = F.explode(F.array(*[F.struct(*[F.lit(v).alias(f"d{k}") for k, v in enumerate(d)])
                                for d in _steps(radius)]))
    level = [F.pmod(F.floor(F.col("sig") / LEVELS ** k), F.lit(LEVELS)) + F.col(f"step.d{k}")
             for k in range(PARTS)]
    left = (tiles.select("sig", "no", "fps", steps.alias("step"))
            .select(F.col("sig").alias("own"), F.col("no").alias("own_no"), F.col("fps").alias("x"),
                    F.array(*level).alias("levels"))
            .filter(F.forall("levels", lambda v: v.between(0, LEVELS - 1)))
            .withColumn("sig", sum((F.col("levels")[k] * LEVELS ** k for k in range(PARTS)),
                                   F.lit(0)).cast("int")).drop("levels"))
    pairs = (left.join(tiles, "sig").filter("own <> sig OR own_no <= no")
             .select("x", F.col("fps").alias("y")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            xs, ys = b.column(0), b.column(1)
            for k in range(len(b)):
                x = xs[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                y = ys[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                found = _compare(x, y, radius)
                held.append(found)
                n += len(found[0])
            if n > HELD:
                held = [_forest(*(np.concatenate(s) for s in zip(*held)))]
                n = len(held[0][0])
                if n > HELD:
                    yield _links(held[0])
                    held, n = [], 0
        if n:
            yield _links(_forest(*(np.concatenate(s) for s in zip(*held))))

    return pairs.mapInArrow(run, "a long, b long")


def _links(found) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in found], ["a", "b"])


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id, first): the group of near-duplicates of each row.

    Null text is empty; rows without words have fingerprint 0 and link like any other.  A
    row's component is the smallest doc_id reached over links, null only if none there has
    one; `first` has the doc_id and the text's hash of the row that leads the group.
    Repeated rows come out as often as they come in.  Other columns of docs are not read.
    The table of fingerprints, tiles and links go to the shared folder; nothing that grows
    with the documents passes the driver.
    """
    marked = written(fingerprints(docs, words), "fingerprints")
    classes = marked.groupBy("fp").agg(F.min(F.struct("d", "t")).alias("first"))
    roots = components(fingerprint_links(classes.select("fp"), radius))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    led = rooted.groupBy("root").agg(F.min("first").alias("first"))
    of_fp = rooted.drop("first").join(led, "root").select("fp", "first")
    return marked.join(of_fp, "fp").select(
        F.nullif("d", F.lit(NO_ID)).alias("doc_id"), "fp",
        F.nullif(F.col("first.d"), F.lit(NO_ID)).alias("component_id"), "first")


def keep_one(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The documents, one of each group of near-duplicates: that with the smallest doc_id.

    Of rows that share it, that with the smallest hash of its text stays; of rows that are
    equal in both, one.  A null doc_id counts as the largest.
    """
    rows = in_rows(docs, d=id_of(), t=F.xxhash64(text_of()))
    led = near_duplicates(docs, words, radius).select("first.d", "first.t").distinct()
    return out_rows(rows.join(led, ["d", "t"]).dropDuplicates(["d", "t"]), docs.columns)
