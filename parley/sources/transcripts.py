"""Transcript documents: scan, validate, flatten, nest, write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.functions.text import parse_time
from parley.plans.ordered import part_of
from parley.plans.workspace import spread

# The transcript document and its metadata.
METADATA = ("struct<call_id:string,client_id:string,client_segment:string,product:string,"
            "call_duration_seconds:double,call_timestamp:string,region:string,"
            "agent_id:string,call_outcome:string>")
TRANSCRIPT = ("array<struct<speaker:string,text:string,start_time:double,end_time:double,"
              "duration:double>>")
SCHEMA = (f"call_id string, first_turn int, transcript {TRANSCRIPT}, metadata {METADATA}, "
          "ingestion_timestamp string, ground_truth_importance string, "
          "_corrupt_record string")


def scan_transcripts(spark: SparkSession, path: str, one_per_file: bool = True,
                     limit: int | None = None, more: str = "") -> DataFrame:
    """Read a folder of documents; unreadable ones keep their text for the rejects.

    `more` are fields that these documents have beyond the format, such as "copies long".
    """
    reader = spark.read.schema(", ".join(filter(None, [more, SCHEMA]))).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    if one_per_file:
        reader = reader.option("multiLine", True).option("pathGlobFilter", "*.json")
    docs = reader.json(path)
    return docs.orderBy("call_id").limit(limit) if limit else docs


def _is_valid() -> Column:
    return F.coalesce(F.col("call_id").isNotNull() & F.col("metadata").isNotNull()
                      & (F.size("transcript") > 0), F.lit(False))


def split_valid(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) documents; bad documents never fail the job."""
    return raw.filter(_is_valid()), raw.filter(~_is_valid())


def reject_reason() -> Column:
    """Why a document isn't accepted."""
    return (F.when(F.col("_corrupt_record").isNotNull(), "unreadable").when(F.col("call_id").isNull(), "no call id")
            .when(F.col("metadata").isNull(), "no metadata").otherwise("no turns"))


def call_metadata(raw: DataFrame) -> DataFrame:
    """The `calls` row of each document; missing keys become NULL."""
    names = ("client_id", "client_segment", "product", "call_duration_seconds", "region",
             "agent_id", "call_outcome")
    return raw.select("call_id", *[F.col(f"metadata.{n}").alias(n) for n in names],
                      parse_time(F.col("metadata.call_timestamp")).alias("call_timestamp"),
                      parse_time(F.col("ingestion_timestamp")).alias("ingestion_timestamp"))


def explode_turns(raw: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    """One row per turn, numbered in document order from the document's first turn.

    `more` are columns of the document that its turns keep.
    """
    first = F.coalesce("first_turn", F.lit(0)) if "first_turn" in raw.columns else F.lit(0)
    rows = raw.select("call_id", first.alias("first"), *more, F.posexplode("transcript").alias("at", "turn"))
    kept = [c for c in rows.columns if c not in ("call_id", "first", "at", "turn")]
    return (rows.select("call_id", (F.col("first") + F.col("at")).cast("int").alias("turn_index"), "turn", *kept)
            .select("call_id", "turn_index", segment_id().alias("segment_id"), "turn.*", *kept))


def segment_id() -> Column:
    return F.format_string("%s_SEG_%03d", F.col("call_id"), F.col("turn_index"))


def latest_by_key(existing: DataFrame, incoming: DataFrame, keys, newest_first,
                  details: DataFrame | None = None) -> DataFrame:
    """Insert-or-replace: per key the row that comes first in `newest_first` order.

    The rank limit is applied before the shuffle, so a key that was delivered
    very often sends one row per task.  `details` has, by the keys, columns that the incoming
    rows lack: these meet them once the newest row of a key is known, those without any are left out.
    """
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    first = lambda rows: rows.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") == 1).drop("__rank")
    if details is not None:
        incoming = first(incoming).join(spread(details), [*keys])
    return first(existing.unionByName(incoming))


def limit_calls(calls: DataFrame, n: int) -> DataFrame:
    return calls.orderBy("call_id").limit(n)


def unprocessed(calls: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Calls that have no row in a stage table yet."""
    todo = calls.join(done.select("call_id"), "call_id", "left_anti")
    return limit_calls(todo, limit) if limit else todo


def with_stage_flags(calls: DataFrame, preprocessed: DataFrame,
                     enriched: DataFrame) -> DataFrame:
    """Stage flags derived from the stage tables (nothing to keep in step).

    A call is `processed` once a preprocessing result exists.
    """
    pre = preprocessed.select("call_id", F.lit(True).alias("__pre"))
    enr = enriched.select("call_id", F.lit(True).alias("__enr"))
    out = calls.join(pre, "call_id", "left").join(enr, "call_id", "left")
    pre_flag, enr_flag = F.col("__pre").isNotNull(), F.col("__enr").isNotNull()
    return (out.withColumn("processed", pre_flag).withColumn("preprocessed", pre_flag)
            .withColumn("enriched", enr_flag).drop("__pre", "__enr"))


def assemble_transcript(turns: DataFrame, part_turns: int | None = None) -> DataFrame:
    """`SPEAKER: text` lines in turn order, one row per call.

    With `part_turns` a call is cut into parts of so many turns, numbered from
    0; the parts joined by a line end are the whole.
    """
    line = F.concat(F.upper("speaker"), F.lit(": "), F.col("text"))
    packed = (turns.groupBy("call_id", part_of("turn_index", part_turns).alias("part"))
              .agg(F.collect_list(F.struct("turn_index", line.alias("line"))).alias("l")))
    return packed.select("call_id", "part", F.array_join(F.transform(
        F.sort_array("l"), lambda x: x["line"]), "\n").alias("transcript_text"))


def nest_turns(turns: DataFrame, part_turns: int | None = None, keys: Sequence[str] = ("call_id",)) -> DataFrame:
    """Turns back to nested documents, one per call.

    With `part_turns` a call becomes several documents; `first_turn` says where
    each begins, and `explode_turns` adds it back.  `keys` tell calls apart.
    """
    turn = (*[F.col(c) for c in ("speaker", "text", "start_time", "end_time")],
            (F.col("end_time") - F.col("start_time")).alias("duration"))
    packed = (turns.groupBy(*keys, part_of("turn_index", part_turns).alias("part"))
              # flat, as turns of one number are told apart by what follows it: Spark builds the
              # comparison of a nested struct anew for every pair that it compares
              .agg(F.min("turn_index").cast("int").alias("first_turn"),
                   F.collect_list(F.struct("turn_index", *turn)).alias("l")))
    names = ("speaker", "text", "start_time", "end_time", "duration")
    return packed.select(*keys, "part", "first_turn", F.transform(
        F.sort_array("l"), lambda x: F.struct(*[x[c].alias(c) for c in names])).alias("transcript"))


def as_documents(turns: DataFrame, calls: DataFrame, truth: DataFrame, keys: Sequence[str] = ("call_id",),
                 count_copies: bool = False) -> DataFrame:
    """Documents in the input format, with metadata and the ground-truth label.

    Turns, metadata and labels meet on `keys`.  An id that several calls share doesn't tell them apart: by it
    alone, each of its documents holds the turns of all, once per call and label.  With `count_copies` those
    that differ in nothing, as labels of an id are the same, are one document that says how many they are.
    """
    meta = calls.select(*keys, F.struct(
        "call_id", "client_id", "client_segment", "product", "call_duration_seconds",
        F.date_format("call_timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("call_timestamp"),
        "region", "agent_id", "call_outcome").alias("metadata"),
        F.date_format("call_timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("ingestion_timestamp"))
    label = truth.select(*keys, F.when(F.col("is_important"), "high").otherwise("low")
                         .alias("ground_truth_importance"))
    if count_copies:
        label = label.groupBy(*label.columns).agg(F.count(F.lit(1)).alias("copies"))
    return nest_turns(turns, keys=keys).join(meta, [*keys]).join(label, [*keys], "left")


def write_documents(docs: DataFrame, path: str) -> None:
    """Compressed, as documents repeat the names of their fields in every turn."""
    docs.write.option("compression", "gzip").json(path)


def save_table(df: DataFrame, path: str, partition_by=()) -> None:
    """Write one engine table, partitioned; big partitions are split, small ones merged."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
