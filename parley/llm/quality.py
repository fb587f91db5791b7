"""Quality rules: counts of each text, and the frequency of its lines across documents."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import id_of, in_rows, out_rows, text_of, word_blocks
from parley.llm.lines import joined_without
from parley.plans.workspace import written

SYMBOLS, BLANK_BYTES = b"#*$%&|<>", b" \t\n\x0b\f\r"
#: Base rules: fewest words, and percent of words in repeated 3-word windows.
MIN_WORDS, MAX_REPEATED = 50, 50
#: A line is boilerplate on a host beyond so many distinct documents, and such a share of the
#: host's; a document is depleted if less than so many percent of its words remain.
LINE_DOCS, LINE_SHARE, LEFT_PERCENT = 10, 0.001, 30

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = ("d long, t long, host string, " + ", ".join(f"{c} long" for c in STATS)
          + ", class long, lines array<struct<pos:int, h:long, n:int>>")


def repeated_words(data: bytes) -> tuple[int, int]:
    """(words, words in 3-word windows that occur twice or more, the first included)."""
    ids: dict[bytes, int] = {}
    seq = array("q")
    for block in word_blocks(data):
        seq.extend([ids.setdefault(w, len(ids)) for w in block])
    n, v = len(seq), len(ids)
    if n < 4:
        return n, 0
    s = np.frombuffer(seq, np.int64)
    pair = s[:-2] * v + s[1:-1]
    if v ** 3 >= 1 << 62:
        pair = np.unique(pair, return_inverse=True)[1]
    _, at, count = np.unique(pair * v + s[2:], return_inverse=True, return_counts=True)
    twice = count[at] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k:n - 2 + k] |= twice
    return n, int(inside.sum())


def describe(data: bytes, chars: int) -> tuple[list[int], int, list[tuple[int, int, int]]]:
    """The counts of a text, its class, and (position, hash, words) of its lines with a word.

    The class is the hash of all normalised lines in order, so a line counts once for all
    documents that are equal but for case and white space.
    """
    n, repeated = repeated_words(data)
    seen, dup, lines, whole = set(), 0, [], xxhash.xxh64(seed=42)
    for pos, line in enumerate(data.split(b"\n")):
        words = line.split()
        if words:
            dup += line in seen
            seen.add(line)
            plain = b" ".join(words).lower()
            whole.update(plain + b"\n")
            lines.append((pos, _hash(plain), len(words)))
    stats = [n, chars - (len(data) - len(data.translate(None, BLANK_BYTES))),
             len(data) - len(data.translate(None, SYMBOLS)), dup, repeated]
    return stats, _signed(whole.intdigest()), lines


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _hash(data: bytes) -> int:
    return _signed(xxhash.xxh64_intdigest(data, 42))


def described(docs: DataFrame, host: str = "source") -> DataFrame:
    """(d, t, host, counts, class, lines) of each row's whole text; one Python pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats: list[list[int]] = []
            classes, ends, flat = [], [0], ([], [], [])
            for text in b.column(3):
                text = text.as_py()
                counts, kind, lines = describe(text.encode(), len(text))
                stats.append(counts)
                classes.append(kind)
                for column, values in zip(flat, zip(*lines)):
                    column.extend(values)
                ends.append(len(flat[0]))
            parts = pa.StructArray.from_arrays(
                [pa.array(flat[0], pa.int32()), pa.array(flat[1], pa.int64()),
                 pa.array(flat[2], pa.int32())], ["pos", "h", "n"])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], *(pa.array([s[k] for s in stats], pa.int64()) for k in range(len(STATS))),
                 pa.array(classes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)],
                ["d", "t", "host", *STATS, "class", "lines"])
    return docs.select(id_of().alias("d"), F.xxhash64(text_of()).alias("t"),
                       F.col(host).cast("string").alias("host"), text_of().alias("text")) \
        .mapInArrow(run, SCHEMA)


def frequent_lines(rows: DataFrame, line_docs: int = LINE_DOCS,
                   line_share: float = LINE_SHARE) -> DataFrame:
    """(host, h): lines that more distinct documents of a host hold than the limit.

    The limit is the larger of `line_docs` and `line_share` of the host's documents.  Copies
    of a whole document have one class and count once.  Lines are made distinct per host and class
    before they are counted, and counts are summed per task before they meet; only lines
    beyond `line_docs` meet the number of the host's documents.
    """
    held = rows.select("host", "class", F.explode("lines.h").alias("h")).distinct()
    counts = held.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") > line_docs)
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("size"))
    return (counts.alias("c").join(hosts.alias("o"), F.col("c.host").eqNullSafe(F.col("o.host")))
            .filter(F.col("n") > F.col("size") * line_share).select("c.host", "h"))


def judged(docs: DataFrame, host: str = "source", line_docs: int = LINE_DOCS,
           line_share: float = LINE_SHARE, left_percent: int = LEFT_PERCENT) -> DataFrame:
    """(d, t, counts, n_removed, gone, base_failed, kept) for each row.

    Null text is empty, and a text without words fails the base rules.  `n_removed` counts
    the words in lines that are frequent on the row's host, `gone` has those lines'
    positions.  A document is depleted, and not kept, if fewer than `left_percent` percent of
    its words remain.  A null host is a host; rows that repeat a doc_id and a text are
    judged alike and come out as often as they come in; a null doc_id is NO_ID.
    """
    rows = written(described(docs, host), "described")
    frequent = frequent_lines(rows, line_docs, line_share)
    lines = rows.select("d", "t", "host", F.inline("lines")).distinct()
    removed = (lines.alias("l").join(frequent.alias("f"), F.col("l.host").eqNullSafe(F.col("f.host"))
                                     & (F.col("l.h") == F.col("f.h")))
               .groupBy("d", "t", "l.host").agg(F.sum("n").alias("n_removed"),
                                                F.collect_list("pos").alias("gone")))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"x.{c}")) for c in ("d", "t", "host")]
    met = rows.drop("class", "lines").alias("r").join(removed.alias("x"), same, "left")
    n_removed = F.coalesce("n_removed", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | \
        (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    depleted = 100 * (F.col("n_words") - n_removed) < left_percent * F.col("n_words")
    return met.select("r.d", "r.t", F.col("r.host").alias("host"), *STATS,
                      n_removed.alias("n_removed"), "gone",
                      failed.alias("base_failed"), (~failed & ~depleted).alias("kept"))


def good_documents(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents that the rules keep, unchanged and with all their columns."""
    rejected = judged(docs, host, **limits).filter("NOT kept").select("d", "t", "host").distinct()
    rows = in_rows(docs, d=id_of(), t=F.xxhash64(text_of()), host=F.col(host).cast("string"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"x.{c}")) for c in ("d", "t", "host")]
    return out_rows(rows.alias("r").join(rejected.alias("x"), same, "left_anti"), docs.columns)


def without_frequent_lines(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents that the rules keep, without the lines that are frequent on their host."""
    kept = judged(docs, host, **limits).filter("kept").select("d", "t", "host", "gone") \
        .dropDuplicates(["d", "t", "host"])
    rows = in_rows(docs, d=id_of(), t=F.xxhash64(text_of()), host=F.col(host).cast("string"),
                   lines=F.split(text_of(), "\n"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"x.{c}")) for c in ("d", "t", "host")]
    met = rows.alias("r").join(kept.alias("x"), same)
    return out_rows(met, docs.columns, text=joined_without("lines", "gone"))
