"""Line deduplication across documents, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import BLANKS, ascii_lower, id_of, in_rows, out_rows, text_of
from parley.plans.workspace import written

MIN_CHARS, MIN_DOCS = 10, 2


def line_key(line: Column) -> Column:
    """The normalised line: no white space at both ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(d, t, pos, k1, k2): each line whose key is long enough, by two 64-bit hashes of its key."""
    lines = docs.select(id_of().alias("d"), F.xxhash64(text_of()).alias("t"),
                        F.posexplode(F.split(text_of(), "\n")).alias("pos", "line"))
    keyed = lines.select("d", "t", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= min_chars).select(
        "d", "t", "pos", F.xxhash64("key").alias("k1"),
        F.xxhash64(F.lit("second"), F.col("key")).alias("k2"))


def repeated_lines(hashes: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(k1, k2, n_docs, first): hashes found in `min_docs` documents or more.

    Counted in two steps, so that the copies of a frequent line are first made distinct by
    document, over many tasks, and then summed per task before they meet.
    """
    once = hashes.select("k1", "k2", "d").distinct()
    return (once.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_docs"), F.min("d").alias("first"))
            .filter(F.col("n_docs") >= min_docs))


def joined_without(lines: str, gone: str) -> Column:
    """A text of the lines in one column without those whose positions the other lists.

    Positions are sets, so long texts take linear time.
    """
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    kept = F.transform(stay, lambda i: F.get(F.col(lines), i))
    return F.when(F.col(gone).isNull(), F.array_join(lines, "\n")).otherwise(F.array_join(kept, "\n"))


def dedupe_lines(docs: DataFrame, min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """(row, n_lines, n_dropped, text): the documents without lines that others have before them.

    Texts split at \\n; null or empty text is one empty line, whose key is too short to drop.
    A key of at least `min_chars` code points that `min_docs` documents or more hold loses
    all its lines but those in the smallest doc_id that holds it; within that document
    repeats stay.  Rows that share a doc_id are one document; a null doc_id is one document
    after all others.  A text may lose all lines and is then empty.  `row` has the other
    columns of the input.  Two independent 64-bit hashes stand for a key.

    Lines travel as hashes; the text moves once, to meet the list of its dropped positions.
    A line held by very many documents is a skewed join on its hash, which Spark splits.
    """
    hashes = written(line_hashes(docs, min_chars), "lines")
    # written, so that both sides of the join are dealt out plainly and large keys can be split
    repeated = written(repeated_lines(hashes, min_docs), "repeated")
    dropped = (hashes.join(repeated, ["k1", "k2"])
               .filter(F.col("d") != F.col("first"))
               .groupBy("d", "t").agg(F.collect_list("pos").alias("gone")))
    rows = in_rows(docs, d=id_of(), t=F.xxhash64(text_of()), lines=F.split(text_of(), "\n"))
    met = (rows.withColumn("row", F.col("row").dropFields("text"))
           .join(dropped.hint("shuffle_hash"), ["d", "t"], "left"))
    return met.select("row", F.size("lines").cast("long").alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                      joined_without("lines", "gone").alias("text"))


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS,
                           min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with their columns; null text becomes empty."""
    return out_rows(dedupe_lines(docs, min_chars, min_docs), docs.columns, text=F.col("text"))
