"""Scans, validation, upsert, nesting and sinks."""

from pyspark.sql import functions as F

from parley.catalog.base import query
from parley.catalog.sql_views import sql
from parley.plans.workspace import new_path
from parley.sources import transcripts as S


def _documents(t):
    return S.as_documents(t.turns, t.calls, t.truth)


@query(sql("""SELECT call_id, product, is_important, count(*) AS n_turns,
 sum(length(text))::BIGINT AS n_chars, round(max(end_time), 6) AS last_second
FROM turns JOIN calls USING (call_id) JOIN truth USING (call_id) GROUP BY ALL""",
           "turns", "calls", "truth"))
def scan_transcripts(t):
    """Write the documents as JSON, scan them back, and count their turns."""
    path = new_path(t.spark, "documents")
    S.write_documents(S.as_documents(t.turns, t.calls, t.truth, count_copies=True).drop("part"), path)
    raw = S.scan_transcripts(t.spark, path, one_per_file=False, more="copies long")
    copies = F.coalesce("copies", F.lit(1))             # no label, one document
    docs = raw.select("call_id", F.col("metadata.product").alias("product"),
                      (F.col("ground_truth_importance") == "high").alias("is_important"),
                      copies.alias("copies"), F.explode("transcript").alias("turn"))
    return docs.groupBy("call_id", "product", "is_important").agg(
        F.sum("copies").alias("n_turns"), F.sum(F.length("turn.text") * F.col("copies")).alias("n_chars"),
        F.max("turn.end_time").alias("last_second"))


@query(sql("""SELECT CASE WHEN n IS NULL THEN 'rejected' ELSE 'accepted' END AS verdict,
 count(*) AS n_docs, coalesce(sum(n), 0)::BIGINT AS n_turns
FROM calls LEFT JOIN (SELECT call_id, count(*) AS n FROM turns GROUP BY 1) USING (call_id)
GROUP BY 1""", "turns", "calls"))
def validate_transcripts(t):
    """Calls without turns become documents with an empty list, which are rejected."""
    nested = S.nest_turns(t.turns)
    raw = t.calls.select("call_id", F.struct("call_id", "product").alias("metadata")).join(
        nested, "call_id", "left").withColumn("transcript", F.coalesce(
            "transcript", F.array().cast(nested.schema["transcript"].dataType)))
    ok, rejects = S.split_valid(raw)
    count = lambda df, verdict: df.groupBy(F.lit(verdict).alias("verdict")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.size("transcript")).alias("n_turns"))
    return count(ok, "accepted").unionByName(count(rejects, "rejected"))


@query(sql("""SELECT call_id, client_id, client_segment, product,
 round(call_duration_seconds, 6) AS call_duration_seconds, region, agent_id, call_outcome,
 call_timestamp, call_timestamp AS ingestion_timestamp
FROM calls WHERE call_id IN (SELECT call_id FROM turns)""", "turns", "calls"))
def extract_call_metadata(t):
    return S.call_metadata(_documents(t))


@query(sql("""SELECT call_id, product, call_outcome, call_timestamp FROM (
 SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY call_timestamp DESC, call_outcome) AS r
 FROM (SELECT call_id, product, call_outcome, call_timestamp FROM calls
  UNION ALL SELECT call_id, product, 'followed_up', l_shipdate FROM calls
   JOIN lineitem ON call_id = concat('CALL_', lpad(CAST(l_orderkey AS VARCHAR), 6, '0'))))
WHERE r = 1""", "calls"))
def upsert_calls(t):
    """Every shipped line re-delivers its call with a later or earlier timestamp."""
    cols = ["call_id", "product", "call_outcome", "call_timestamp"]
    again = t.table("lineitem").select(
        F.concat(F.lit("CALL_"), F.lpad(F.col("l_orderkey").cast("string"), 6, "0"))
        .alias("call_id"), F.col("l_shipdate").alias("call_timestamp"), F.lit("followed_up").alias("call_outcome"))
    return S.latest_by_key(t.calls.select(*cols), again, ["call_id"], [F.desc("call_timestamp"), "call_outcome"],
                           details=t.calls.select("call_id", "product"))


@query(sql("SELECT call_id, product FROM calls ORDER BY call_id LIMIT 100", "calls"))
def ingest_limit(t):
    return S.limit_calls(t.calls.select("call_id", "product"), 100)


@query(sql("""SELECT call_id, turn_index::BIGINT AS turn_index,
 printf('%s_SEG_%03d', call_id, turn_index) AS segment_id, speaker, text,
 round(start_time, 6) AS start_time, round(end_time, 6) AS end_time,
 round(end_time - start_time, 6) AS duration FROM turns""", "turns"))
def explode_turns(t):
    return S.explode_turns(S.nest_turns(t.turns))


@query(sql("""SELECT call_id, 0::BIGINT AS part,
 string_agg(concat(upper(speaker), ': ', text), chr(10) ORDER BY turn_index) AS transcript_text
FROM turns GROUP BY call_id""", "turns"))
def assemble_transcript(t):
    return S.assemble_transcript(t.turns)


@query(sql("""SELECT call_id, 0::BIGINT AS part, count(*) AS n_turns,
 to_json(list(text ORDER BY turn_index))::VARCHAR AS texts,
 to_json(list(speaker ORDER BY turn_index))::VARCHAR AS speakers FROM chat GROUP BY call_id""", "chat"))
def nest_turns(t):
    chat = t.chat_turns.withColumn("start_time", F.lit(0.0)).withColumn("end_time", F.lit(0.0))
    nested = S.nest_turns(chat)
    return nested.select("call_id", "part", F.size("transcript").alias("n_turns"),
                         F.transform("transcript", lambda x: x["text"]).alias("texts"),
                         F.transform("transcript", lambda x: x["speaker"]).alias("speakers"))


@query(sql("""SELECT call_id, printf('%s_SEG_%03d', call_id, turn_index) AS segment_id,
 turn_index::BIGINT AS turn_index, upper(speaker) AS speaker, length(text)::BIGINT AS n_chars
FROM chat""", "chat"))
def ordered_segments(t):
    return t.chat_turns.select("call_id", S.segment_id().alias("segment_id"), "turn_index",
                               F.upper("speaker").alias("speaker"),
                               F.length("text").alias("n_chars")).orderBy("segment_id")


@query(sql("""SELECT overall_importance, strftime(call_timestamp, '%Y-%m') AS call_month,
 count(*) AS n_calls FROM both_calls GROUP BY ALL""", "both_calls"))
def table_sinks(t):
    """Save the call results partitioned by month and count what was saved."""
    path = new_path(t.spark, "calls")
    rows = t.calls.join(t.pc, "call_id").withColumn(
        "call_month", F.date_format("call_timestamp", "yyyy-MM"))
    S.save_table(rows, path, ["call_month"])
    saved = t.spark.read.schema(rows.schema).parquet(path)
    return saved.groupBy("overall_importance", "call_month").agg(
        F.count(F.lit(1)).alias("n_calls"))


@query(sql("""SELECT call_id, client_id, call_timestamp FROM calls
WHERE call_id NOT IN (SELECT call_id FROM pc)""", "calls", "pc"))
def scan_unprocessed(t):
    return S.unprocessed(t.calls.select("call_id", "client_id", "call_timestamp"), t.pc)


_FLAGGED = """SELECT calls.*, call_id IN (SELECT call_id FROM pc) AS preprocessed,
 call_id IN (SELECT call_id FROM pc) AS processed,
 call_id IN (SELECT call_id FROM enriched) AS enriched FROM calls"""


@query(sql(f"""SELECT call_id, processed, preprocessed, enriched FROM ({_FLAGGED})""",
           "calls", "pc", "enriched"))
def mark_stage(t):
    return t.flagged_calls.select("call_id", "processed", "preprocessed", "enriched")
