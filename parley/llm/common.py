"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that separates words, as characters and as a pattern's class.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for a null doc_id: one document, after all others.
NO_ID = (1 << 63) - 1
BLOCK_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def id_of(column: str = "doc_id") -> Column:
    """The document's number, with one number for all nulls."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only; `lower` itself where the text holds nothing else."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, LOWER))


def in_rows(docs: DataFrame, **derived: Column) -> DataFrame:
    """All columns as one struct `row`, so that no name clashes with the derived ones."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *[c.alias(name) for name, c in derived.items()])


def out_rows(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of `row` again, some of them replaced."""
    return df.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])


def word_blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in lists of about `size` bytes; no word is cut."""
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            m = _SPACE.search(data, end)
            end = m.start() if m else len(data)
        yield data[at:end].split()
        at = end


def same_and_smallest(i, j, labels):
    """Joins the groups of `labels` that the links i-j touch; labels point to the smallest member."""
    import numpy as np
    while len(i):
        a, b = labels[i], labels[j]
        differ = a != b
        i, j = i[differ], j[differ]
        low, high = np.minimum(a, b)[differ], np.maximum(a, b)[differ]
        np.minimum.at(labels, high, low)
        while (labels[labels] != labels).any():
            labels = labels[labels]
    return labels
