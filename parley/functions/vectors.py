"""Vector expressions and the built-in text embedding."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from parley import constants as K

TOKEN_RX = r"[\p{L}\p{N}_]+"
# Tokens whose slots a task counts at once.
COUNTED_SLOTS = 1 << 20


def once(value: Column, use) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column) -> Column:
    """Unit vector; the zero vector stays as it is."""
    length = norm(v)
    return F.when(length == 0, F.transform(v, lambda x: x.cast("double"))).otherwise(
        F.transform(v, lambda x: x.cast("double") / length))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def tokens(text: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(TOKEN_RX), F.lit(0)),
                    lambda w: F.length(w) >= 2)


def token_slots(text: Column, dim: int = K.EMBEDDING_DIM) -> Column:
    """One slot number per token, from the token's md5."""
    return F.transform(tokens(text), lambda w: F.pmod(
        F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint"), F.lit(dim)).cast("int"))


def hashed_embedding(text: Column, dim: int = K.EMBEDDING_DIM) -> Column:
    """Unit-length token-count vector over hashed slots."""
    @F.arrow_udf("array<double>")
    def count_slots(slots: pa.Array) -> pa.Array:
        return slot_lists(slots, dim)
    return count_slots(token_slots(text, dim))


def slot_lists(slots: pa.Array, dim: int) -> pa.Array:
    """The vector of each list of slots; neither lists nor vectors become Python objects."""
    import numpy as np
    sizes = slots.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype("int64")
    flat, ends = slots.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(sizes))
    v = _slot_matrix(sizes, lambda a, b: flat[ends[a]:ends[b]], dim)
    return pa.ListArray.from_arrays(np.arange(0, v.size + 1, dim, dtype="int32"), v.reshape(-1))


def slot_vectors(slots: pd.Series, dim: int) -> pd.Series:
    """`slot_lists` of a pandas series."""
    import numpy as np
    sizes = np.fromiter((0 if s is None else len(s) for s in slots), "int64", len(slots))
    some = lambda a, b: np.concatenate([s for s in slots.iloc[a:b] if s is not None])
    return pd.Series(list(_slot_matrix(sizes, some, dim)))


def _slot_matrix(sizes, some, dim: int):
    """Vectors by row; places are made for about COUNTED_SLOTS tokens, or one longer text, at a time.

    `some(a, b)` gives the slots of the rows from a to b.
    """
    import numpy as np
    edges = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // COUNTED_SLOTS)) + 1).tolist(), len(sizes)]
    v = np.empty((len(sizes), dim))
    for a, b in zip(edges, edges[1:]):
        cells = np.repeat(np.arange(b - a) * dim, sizes[a:b])
        if len(cells):
            cells += some(a, b)
        v[a:b] = np.bincount(cells, minlength=(b - a) * dim).reshape(-1, dim)
    size = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(size == 0, 1.0, size)
