"""Document fingerprints of Lempel-Ziv phrases, and their likeness."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import text_of

#: Slots of a signature; a slot holds 1 + the smallest hash modulo 255, or 0 if empty.
SLOTS = 128
NONE = np.uint64((1 << 64) - 1)


def _minima(phrases, slots: int = SLOTS) -> np.ndarray:
    """The smallest hash of each slot; one hash decides both slot and value."""
    least = np.full(slots, NONE)
    if phrases:
        h = np.fromiter((xxhash.xxh64_intdigest(p.encode(), 42) for p in phrases),
                        np.uint64, len(phrases))
        np.minimum.at(least, (h % np.uint64(slots)).astype(np.intp), h // np.uint64(slots))
    return least


def _parse(text: str, known: set[str], word: str) -> tuple[list[str], str]:
    """Cuts a text into phrases, each the longest known one and one character more.

    Returns the phrases added to `known`, which holds as many as the text needs, and the open phrase.
    """
    added: list[str] = []
    for char in text:
        longer = word + char
        if longer in known:
            word = longer
        else:
            known.add(longer)
            added.append(longer)
            word = ""
    return added, word


def signature(text: str) -> np.ndarray:
    """The minimum-hash signature of a text's phrase set, one byte per slot."""
    return _bytes(_minima(_parse(text, set(), "")[0]))


def signatures(text: str, keep: int, tail: str) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a text and of its first `keep` characters followed by `tail`.

    The common beginning is parsed once.
    """
    known: set[str] = set()
    begun, word = _parse(text[:keep], known, "")
    common, out = _minima(begun), []
    for rest in (text[keep:], tail):
        added, _ = _parse(rest, known, word)
        out.append(_bytes(np.minimum(common, _minima(added))))
        known.difference_update(added)
    return out[0], out[1]


def _bytes(least: np.ndarray) -> np.ndarray:
    return np.where(least == NONE, 0, least % np.uint64(255) + np.uint64(1)).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal slots among those that either fills; 1 if neither fills any."""
    filled = (a > 0) | (b > 0)
    return float(((a == b) & filled).sum() / filled.sum()) if filled.any() else 1.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every whole text, null being empty; a narrow pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = [signature(x.as_py()).tobytes().hex() for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(marks, pa.string())],
                                             ["doc_id", "fingerprint"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")) \
        .mapInArrow(run, "doc_id long, fingerprint string")


FIRST = -(1 << 63)                       # stands for a null doc_id: last in descending order
EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
DEALT = "range int, guest int, doc_id long, d long, t long, text string"


def compared_with_edit(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint next to that of its edited text and of the next document.

    The edited text has the last floor(n/2) code points replaced by the first as many of the
    next document in descending doc_id (all of it if it is shorter); after the last comes the
    first.  Null text is empty and like other empty texts; null doc_ids come last; rows that
    repeat a doc_id follow each other by a hash of the text.  An empty table gives no rows.

    Documents are dealt out in ranges of doc_id; the first of each range also goes, as a
    guest, to the range whose last document it follows.  So each text moves once, and a task
    holds three texts at a time.  The driver gets one number per range.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("d")
    tops = sorted(r.top for r in docs.select(d).repartitionByRange(4 * tasks, "d")
                  .groupBy(F.spark_partition_id()).agg(F.max("d").alias("top")).collect())
    bounds = np.array(tops, np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = b.column(1).to_numpy()
            own = np.searchsorted(bounds, d)
            heads = np.flatnonzero(bounds[own] == d)
            rows = pa.array(np.concatenate([np.arange(len(d)), heads]))
            ranges = np.concatenate([own, (own[heads] + 1) % len(bounds)]).astype(np.int32)
            guest = np.repeat(np.array([0, 1], np.int32), [len(d), len(heads)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges), pa.array(guest), *(c.take(rows) for c in b.columns)],
                ["range", "guest", "doc_id", "d", "t", "text"])

    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), d,
                        F.xxhash64(text_of()).alias("t"), text_of().alias("text")) \
        .mapInArrow(deal, DEALT)
    ordered = dealt.repartition(tasks, "range").sortWithinPartitions(
        "range", "guest", F.desc("d"), F.desc("t"))
    return ordered.mapInArrow(_compare, EDITED)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of range, guests last; a row's successor is the row after it."""
    out: list[tuple] = []
    waiting = held = None                # one row that lacks only its successor's signature

    def edited(row, following: str):
        doc, text = row
        half = len(text) // 2
        keep, tail = len(text) - half, following[:half]
        own, other = signatures(text, keep, tail)
        digest = sha256((text[:keep] + tail).encode()).hexdigest()
        return (doc, len(text), digest, own.tobytes().hex(), other.tobytes().hex(),
                likeness(own, other)), own

    at, guests = None, 0
    for b in batches:
        for where, guest, doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                           b.column(2).to_pylist(), b.column(5)):
            if where != at:
                at, guests, waiting, held = where, 0, None, None
            guests += guest
            if guests > 1:
                continue
            text = text.as_py()
            if held is not None:
                ready, own = edited(held, text)
                if waiting is not None:
                    out.append((*waiting[0], likeness(waiting[1], own)))
                waiting = ready, own
                if guest:
                    out.append((*ready, likeness(own, signature(text))))
            held = doc, text
            if len(out) >= 1000:
                yield _rows(out)
                out = []
    if out:
        yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
        [x.split()[0] for x in EDITED.split(", ")])
