"""Groups of documents whose sets of five-word shingles are alike, each link checked exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import id_of, in_rows, out_rows, same_and_smallest, text_of, word_blocks
from parley.llm.components import components
from parley.llm.similar import PARTS, SEED, SIMILARITY, WORDS, _near, bit_sums, similar_links
from parley.plans.workspace import written

#: Differing bits of 256 up to which two sets are compared.  Sets of a similarity of 0.8 differ in
#: about 39 +- 6, unrelated ones in 128 +- 8.
RADIUS = 72
#: Sets of a block, on average; two blocks of a group of candidates are compared by one call.
BLOCK = 1024
#: Shingles of a block, on average: 32 MB, so that long texts make more blocks of fewer sets.
ITEMS = 1 << 22
#: Pairs checked in the first round of a step, twice as many in each further one.
FIRST = 32
NAMES = [f"w{k}" for k in range(PARTS)]


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """The hashes of a whole text's distinct shingles, in order.

    A text of fewer words is one shingle; one without words has none.
    """
    tail: list[bytes] = []
    found = [np.empty(0, np.uint64)]
    for block in word_blocks(text.lower()):
        tail += block
        found.append(np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(s), SEED)
                                         for s in zip(*(tail[k:] for k in range(words)))], np.uint64)))
        tail = tail[max(0, len(tail) - words + 1):]
    own = np.unique(np.concatenate(found))
    if not len(own) and tail:
        own = np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], np.uint64)
    return own


def set_fingerprint(own: np.ndarray) -> np.ndarray:
    """The majority bits of distinct hashes: 256 bits in four words."""
    return np.packbits(2 * bit_sums(own) > len(own), bitorder="little").view("<u8")


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def set_fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(d, t, id, n, w0..w3): each row's doc_id, hash of its text and of its set, shingles, fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, n, bits = [], [], np.zeros((len(b), PARTS), np.uint64)
            for k, text in enumerate(b.column(2).cast(pa.binary())):
                own = shingle_set(text.as_py(), words)
                ids.append(_signed(xxhash.xxh64_intdigest(own.tobytes(), SEED)))
                n.append(len(own))
                bits[k] = set_fingerprint(own)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
                 *(pa.array(bits[:, k].copy().view(np.int64)) for k in range(PARTS))], ["d", "t", "id", "n", *NAMES])
    return docs.select(id_of().alias("d"), F.xxhash64(text_of()).alias("t"), text_of().alias("text")) \
        .mapInArrow(run, "d long, t long, id long, n long, " + ", ".join(f"{c} long" for c in NAMES))


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """The rows with the sets `s` of their texts instead of these."""
    kept = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(b.schema.get_field_index("text")).cast(pa.binary())
            for k, x in enumerate(text):
                own = shingle_set(x.as_py(), words).view(np.int64)
                ends = pa.array([0, len(own)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(b.schema.get_field_index(c)).slice(k, 1) for c in kept),
                     pa.ListArray.from_arrays(ends, pa.array(own))], [*kept, "s"])
    types = dict(texts.dtypes)
    return texts.mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in kept) + ", s array<bigint>")


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two ordered sets share so large a part of their union."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = int((b[at] == a).sum())
    return shared >= similarity * (len(a) + len(b) - shared) - 1e-9


def checked_links(rows: pa.Table, radius: int, similarity: float) -> pa.Table:
    """One link from each set of two blocks to the smallest of its group, if it has another.

    Every pair within the radius is compared exactly unless its sets are in one group already.
    """
    if not len(rows):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    ids, no = rows["id"].to_numpy(), rows["no"].to_numpy()
    low, high = rows["lo"][0].as_py(), rows["hi"][0].as_py()
    bits = np.array([rows[c].to_numpy().view(np.uint64) for c in NAMES])
    column = rows["s"].combine_chunks()
    flat, ends = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
    n = np.diff(ends)
    of_x, of_y = np.flatnonzero(no == low), np.flatnonzero(no == high)
    rank = np.argsort(np.argsort(ids))                      # labels are the ranks of ids
    labels = np.arange(len(ids))
    if len(of_x) and len(of_y):
        for i, j in _near(bits[:, of_x], bits[:, of_y], radius):
            i, j = of_x[i], of_y[j]
            like = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9
            like &= (i < j) if low == high else (i != j)
            i, j, some = i[like], j[like], FIRST
            while len(i):
                a, b = labels[rank[i]], labels[rank[j]]
                i, j, b = i[a != b], j[a != b], b[a != b]
                # one pair for each group of the right, and the first others
                pick = np.union1d(np.unique(b, return_index=True)[1], np.arange(min(some, len(i)))).astype(np.int64)
                ok = np.array([alike(flat[ends[p]:ends[p + 1]], flat[ends[q]:ends[q + 1]], similarity)
                               for p, q in zip(i[pick], j[pick])], bool)
                labels = same_and_smallest(rank[i[pick[ok]]], rank[j[pick[ok]]], labels)
                i, j, some = np.delete(i, pick), np.delete(j, pick), 2 * some
    nodes = np.sort(ids)
    own = np.flatnonzero(labels != np.arange(len(nodes)))
    return pa.table({"a": pa.array(nodes[own], pa.int64()), "b": pa.array(nodes[labels[own]], pa.int64())})


def shingle_links(docs: DataFrame, classes: DataFrame, words: int = WORDS, similarity: float = SIMILARITY,
                  radius: int = RADIUS, block: int = BLOCK, items: int = ITEMS) -> DataFrame:
    """(a, b): links that join all sets that share `similarity` of their union or more.

    classes: id, n, w0..w3 and `first`, the (d, t) of a row with that set.  Fingerprints within
    `radius` bits make groups of candidates.  The sets of these are made again from their texts
    and dealt into blocks of about `block` sets of a group, or fewer of about `items` shingles in
    all; each two blocks are one call, which compares every pair within the radius.  A row is
    copied once per block of its group.
    """
    near = components(similar_links(classes.drop("first"), similarity, radius=radius))
    members = written(classes.join(near.withColumnRenamed("node", "id"), "id"), "candidates")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / items))
    of = members.groupBy("root").agg(blocks.cast("int").alias("of"))
    placed = members.join(of, "root").select(
        F.col("first.d").alias("d"), F.col("first.t").alias("t"), "id", "root", "of",
        F.pmod(F.xxhash64("id", F.lit("block")), F.col("of")).cast("int").alias("no"), *NAMES)
    texts = docs.select(id_of().alias("d"), F.xxhash64(text_of()).alias("t"), text_of().alias("text")) \
        .join(placed, ["d", "t"]).drop("d", "t").dropDuplicates(["id"])
    dealt = written(_sets(texts, words), "sets") \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1))) \
        .select("root", F.least("no", "other").alias("lo"), F.greatest("no", "other").alias("hi"), "no", "id", *NAMES, "s")

    def compare(rows: pa.Table) -> pa.Table:
        return checked_links(rows, radius, similarity)

    return dealt.groupBy("root", "lo", "hi").applyInArrow(compare, "a long, b long")


def shingle_groups(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, **how: int) -> DataFrame:
    """(d, t, first): for each row the doc_id and text hash of the row that leads its group.

    That is the smallest doc_id, then the smallest hash, reached over links of sets that are
    alike.  Null text is empty; texts without words are one group.  A null doc_id is the
    largest number.  A set is known by a 64-bit hash of it.
    """
    marked = written(set_fingerprints(docs, words), "shingled")
    classes = written(marked.groupBy("id", "n", *NAMES).agg(F.min(F.struct("d", "t")).alias("first")), "classes")
    roots = components(shingle_links(docs, classes, words, similarity, **how))
    rooted = classes.select("id", "first").join(roots.withColumnRenamed("node", "id"), "id", "left") \
        .select("id", "first", F.coalesce("root", "id").alias("root"))
    led = rooted.groupBy("root").agg(F.min("first").alias("first"))
    of_set = written(rooted.drop("first").join(led, "root").select("id", "first"), "leaders")
    return marked.select("d", "t", "id").join(of_set, "id").select("d", "t", "first")


def keep_one(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, **how: int) -> DataFrame:
    """The documents, one of each group whose shingle sets are alike: that with the smallest doc_id.

    Of rows that share it, that with the smallest hash of its text stays; of rows that are
    equal in both, one.  A null doc_id counts as the largest.  An empty table gives no rows.
    """
    rows = in_rows(docs, d=id_of(), t=F.xxhash64(text_of()))
    led = shingle_groups(docs, words, similarity, **how).select("first.d", "first.t").distinct()
    return out_rows(rows.join(led, ["d", "t"]).dropDuplicates(["d", "t"]), docs.columns)
