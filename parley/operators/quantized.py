"""Approximate vector search over product-quantised codes, the best of them compared exactly.

Directions are cut into `PARTS` pieces; each piece is replaced by the number of its nearest centre of
that piece's codebook, a byte.  A search scans the codes of all vectors, a byte a piece instead of its
doubles, keeps the best `RERANK` per query and meets only those vectors in full.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import constants as K
from parley.functions import vectors as V
from parley.operators import search as S
from parley.plans.workspace import at_most, new_path, written

#: Pieces per vector, a byte each.
PARTS = 16
CENTRES = 256
#: Codebooks are fitted on about this many vectors, chosen by the hash of their ids; every vector is encoded.
TRAIN_ROWS = 50_000
ROUNDS = 12
#: Candidates per query that are compared exactly.
RERANK = 200
_CHUNK = 8192


def _nearest(rows, centres):
    """Number of the nearest centre of each row, in chunks of bounded memory."""
    import numpy as np
    half = (centres * centres).sum(axis=1) / 2
    return np.concatenate([np.argmin(half - rows[i:i + _CHUNK] @ centres.T, axis=1)
                           for i in range(0, len(rows), _CHUNK)] or [np.zeros(0, "int64")])


def _pieces(matrix, parts):
    """Unit vectors padded to a multiple of `parts`: (rows, parts, width)."""
    import numpy as np
    unit = S._unit(matrix)
    width = -(-unit.shape[1] // parts)
    return np.pad(unit, ((0, 0), (0, width * parts - unit.shape[1]))).reshape(len(unit), parts, width)


class QuantizedIndex:
    """Codes of vectors in the shared folder.  Vectors have one length; rows without a vector are left out."""

    def __init__(self, vectors: DataFrame, doc_id: str, doc_vec: str, parts: int = PARTS,
                 centres: int = CENTRES, train_rows: int = TRAIN_ROWS, rounds: int = ROUNDS) -> None:
        if not 1 <= centres <= 256:
            raise ValueError("a code is a byte: 1 to 256 centres")
        self.doc_id, self.parts = doc_id, parts
        self.full = vectors.select(F.col(doc_id).alias("did"), F.col(doc_vec).alias("dvec")).filter("dvec IS NOT NULL")
        self.books = self._fit(centres, train_rows, rounds)
        self.codes = self._encode()

    def _fit(self, centres, train_rows, rounds):
        """One codebook per piece, each fitted by a task of its own on the sample's pieces."""
        import numpy as np
        parts, n = self.parts, self.full.count()
        share = min(1.0, train_rows / max(n, 1))
        sample = self.full.filter(F.pmod(F.xxhash64("did"), F.lit(1 << 32)) < int(share * (1 << 32)))

        def cut(batches):
            for pdf in batches:
                if len(pdf):
                    cells = _pieces(S._matrix(pdf["dvec"]), parts)
                    for p in range(parts):
                        yield pd.DataFrame({"part": p, "key": pdf["key"].to_numpy(), "piece": list(cells[:, p])})

        def learn(pdf):
            rows = np.stack(pdf.sort_values("key", kind="stable")["piece"].to_numpy())
            distinct, first = np.unique(rows, axis=0, return_index=True)
            found = rows[np.sort(first)[:centres]]             # begins with the first distinct pieces
            for _ in range(rounds if len(distinct) > centres else 0):
                at = _nearest(rows, found)
                size = np.bincount(at, minlength=len(found))
                sums = np.stack([np.bincount(at, rows[:, j], len(found)) for j in range(rows.shape[1])], axis=1)
                found = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], found)
            return pd.DataFrame({"part": pdf["part"].iloc[0], "book": [found.ravel().tolist()], "width": rows.shape[1]})

        cells = sample.select(F.xxhash64("did").alias("key"), "dvec").mapInPandas(cut, "part int, key long, piece array<double>")
        books = written(cells.groupBy("part").applyInPandas(learn, "part int, book array<double>, width int"), "codebooks")
        return [np.array(r.book).reshape(-1, r.width) for r in books.orderBy("part").collect()]     # one row per piece

    def _encode(self):
        parts, books = self.parts, self.books

        def encode(batches):
            import numpy as np
            for pdf in batches:
                if len(pdf):
                    cells = _pieces(S._matrix(pdf["dvec"]), parts)
                    codes = np.stack([_nearest(cells[:, p], books[p]) for p in range(parts)], axis=1).astype("uint8")
                    yield pd.DataFrame({"did": pdf["did"], "dvec": [row.tobytes() for row in codes]})

        schema = T.StructType([self.full.schema["did"], T.StructField("dvec", T.BinaryType())])
        path = new_path(self.full.sparkSession, "codes")
        self.full.mapInPandas(encode, schema).write.parquet(path)
        return self.full.sparkSession.read.schema(schema).parquet(path)

    def _decoder(self, width):
        parts, books = self.parts, self.books

        def decode(codes):
            import numpy as np
            at = np.frombuffer(b"".join(codes), "uint8").reshape(-1, parts)
            return np.concatenate([books[p][at[:, p]] for p in range(parts)], axis=1)[:, :width]
        return decode

    def candidates(self, queries: DataFrame, query_id: str, query_vec: str, rerank: int = RERANK) -> DataFrame:
        """(query, document, score): the best `rerank` documents of each query by their codes."""
        q = queries.select(F.col(query_id).alias("qid"), F.col(query_vec).alias("qvec")).filter("qvec IS NOT NULL")
        schema = T.StructType([T.StructField(query_id, q.schema["qid"].dataType),
                               T.StructField(self.doc_id, self.full.schema["did"].dataType), T.StructField("score", T.DoubleType())])
        one = self.full.select(F.size("dvec").alias("n")).first()
        if one is None:
            return q.sparkSession.createDataFrame([], schema)
        decode = self._decoder(one.n)
        if at_most(q, S.MAX_BROADCAST_QUERIES):
            local = S._bounded_best(q, self.codes, schema, rerank, decode)
        else:
            one_list = lambda df: df.withColumn("list", F.lit(0))
            local = S._blocked_best(one_list(q), one_list(self.codes), schema, rerank, decode)
        return S.rank_results(local, [query_id], "score", self.doc_id, rerank)

    def search(self, queries: DataFrame, query_id: str, query_vec: str, k: int = K.TOP_K, rerank: int = RERANK) -> DataFrame:
        """Cosine top-k of every query, by exact scores of its candidates."""
        # an id that several rows hold meets each of them once
        near = self.candidates(queries, query_id, query_vec, max(rerank, k)).select(query_id, self.doc_id).distinct()
        asked = queries.select(query_id, F.col(query_vec).alias("__q"))
        pairs = near.join(self.full.withColumnRenamed("did", self.doc_id), self.doc_id).join(asked, query_id)
        cosine = F.coalesce(V.cosine(F.col("dvec"), F.col("__q")), F.lit(0.0))
        scored = pairs.select(query_id, self.doc_id, (F.floor(cosine * 10.0 ** S.DIGITS + 0.5) / 10.0 ** S.DIGITS).alias("score"))
        return S.rank_results(scored, [query_id], "score", self.doc_id, k)
