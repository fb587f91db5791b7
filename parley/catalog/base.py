"""Registry of queries and the derived inputs they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.operators import calls as C
from parley.plans.workspace import written
from parley.sources.views import Tables


@dataclass(frozen=True)
class Entry:
    run: Callable
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register `fn(inputs) -> DataFrame` under its name, with its SQL text."""
    def add(fn):
        key = name or fn.__name__
        if key in REGISTRY:
            raise ValueError(f"duplicate query {key}")
        REGISTRY[key] = Entry(lambda spark, sf_dir: present(fn(Inputs(spark, sf_dir))), sql)
        return fn
    return add


def present(df: DataFrame) -> DataFrame:
    """Edge format of results: lists as JSON text, integers wide, doubles to six places."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


class Inputs(Tables):
    """Tables, views and the engine tables computed from them."""

    @cached_property
    def stored_turns(self) -> DataFrame:
        """The turns, numbered and written once, for queries that read them several times."""
        return written(self.turns, "turns")

    @cached_property
    def segments(self) -> DataFrame:
        return C.analyze_segments(self.turns)

    @cached_property
    def pc(self) -> DataFrame:
        return C.roll_up_calls(self.segments)

    @cached_property
    def enriched(self) -> DataFrame:
        """Calls enriched so far: the critical ones, which the queue serves first."""
        return self.pc.filter("overall_importance = 'critical'").select("call_id")

    @cached_property
    def flagged_calls(self) -> DataFrame:
        from parley.sources.transcripts import with_stage_flags
        return with_stage_flags(self.calls, self.pc, self.enriched)

    @cached_property
    def enrichments(self) -> DataFrame:
        """Results of the calls enriched so far."""
        from parley.operators import enrichment as N
        from parley.functions import triage
        plan = self.pc.filter("overall_importance = 'critical'").select(
            "call_id", triage.select_model(F.col("overall_importance")).alias("model"))
        return N.enrich(self.turns, plan)
