"""Stored tables whose parts are replaced as a whole, once per batch.

A write goes to a new folder; a commit, one small file written last, says for each part of the
table where its rows are now, and which batch brought them.  A job that dies before its commit
leaves the table as it was, a batch that is delivered again changes nothing, and readers see
the parts of one commit or the next, never half of each.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.sources.transcripts import latest_by_key

COMMIT = "version long, batch string, part string, path string"
#: Parts of a table that is dealt out by the hash of its keys; each should be written by a few tasks.
PARTS = 32
PART = "__part"


def hashed_part(*keys: str, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("string")


class StoredTable:
    """A table in one folder.  `schema` is that of its rows, a type or its text.

    Appended batches may be laid out by columns `partition_by`, so that readers of few of their values
    leave the other files alone.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str,
                 partition_by: tuple[str, ...] = ()) -> None:
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), partition_by
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def commits(self) -> DataFrame:
        """(version, batch, part, path), one row per part of each commit."""
        try:
            return self.spark.read.schema(COMMIT).option("recursiveFileLookup", True) \
                .parquet(f"{self.path}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMIT)

    def has(self, batch: str) -> bool:
        return not self.commits().filter(F.col("batch") == batch).isEmpty()

    def parts(self) -> dict[str, str]:
        """Where each part is; a part without rows has no path and is left out."""
        last = self.commits().groupBy("part").agg(F.max_by("path", "version").alias("path"))
        return {r.part: r.path for r in last.collect() if r.path}

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows, or those of some parts; other parts aren't listed or read."""
        paths, wanted = self.parts(), None if parts is None else set(parts)
        paths = sorted(p for k, p in paths.items() if wanted is None or k in wanted)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        read = self.spark.read.schema(self.schema)
        # folders with columns of their own are read one by one
        return reduce(DataFrame.unionByName, [read.parquet(p) for p in paths]) if self.partition_by else read.parquet(*paths)

    def replace(self, rows: DataFrame, part: Column, batch: str, touched: list[str]) -> None:
        """Puts these rows in the place of the parts `touched`; all of them must be in one of these."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        laid = rows.select(*self.schema.names, part.alias(PART)).hint("rebalance", F.col(PART))
        laid.write.partitionBy(PART).parquet(folder)
        kept = T.StructType([*self.schema.fields, T.StructField(PART, T.StringType())])
        found = {r[0] for r in self.spark.read.schema(kept).parquet(folder).select(PART).distinct().collect()}
        self._commit(batch, {k: f"{folder}/{PART}={k}" if k in found else None for k in touched})

    def append(self, rows: DataFrame, batch: str) -> None:
        """Adds rows as a part of their own; a batch that is there already is left out."""
        if not self.has(batch):
            self._commit(batch, {batch: self._laid(rows)})

    def compact(self, batch: str) -> None:
        """Puts the rows of all appended batches together in one part; they stay known as batches."""
        old = dict.fromkeys(self.parts())
        if len(old) > 1 and not self.has(batch):
            self._commit(batch, old | {batch: self._laid(self.read())})

    def _laid(self, rows: DataFrame) -> str:
        folder, rows = f"{self.path}/data/{uuid.uuid4().hex}", rows.select(*self.schema.names)
        if self.partition_by:
            rows = rows.hint("rebalance", *[F.col(c) for c in self.partition_by])
        rows.write.partitionBy(*self.partition_by).parquet(folder)
        return folder

    def upsert(self, rows: DataFrame, keys: list[str], newest_first: list, batch: str,
               parts: int = PARTS) -> None:
        """Inserts rows or replaces those with the same keys by whichever comes first in `newest_first`.

        Only the hash parts that hold a key of the batch are read and written.
        """
        if self.has(batch):
            return
        part = hashed_part(*keys, parts=parts)
        touched = [r[0] for r in rows.select(part).distinct().collect()]        # at most `parts`
        merged = latest_by_key(self.read(touched), rows.select(*self.schema.names), keys, newest_first)
        self.replace(merged, part, batch, touched)

    def _commit(self, batch: str, paths: dict[str, str | None]) -> None:
        """Commits one file, which appears as a whole when its job does."""
        version = self.commits().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0] + 1
        rows = [(version, batch, k, p) for k, p in paths.items()] or [(version, batch, "", None)]
        self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.parquet(
            f"{self.path}/commits/{version:010d}-{uuid.uuid4().hex}")
