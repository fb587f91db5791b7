"""Secret scans over a ledger of content-addressed blobs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.common import text_of
from parley.plans.workspace import written

# The patterns of the rules.
#: kind: (version, pattern, fewest characters of the match, or of its group `value`)
RULES = {
    "assign": (1, r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(?P<value>[A-Za-z0-9+/_.=-]+)""", 6),
    "access": (1, r"AKIA[A-Z0-9]+", 20),
    "hex": (1, r"[0-9a-f]+", 24),
    "pem": (1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 1),
    "github": (1, r"gh[pousr]_[A-Za-z0-9]+", 40),
}
#: One of these is in every text that the rule of that kind matches, whatever its case.
NEEDED = {"assign": ("passw", "secret", "token", "api"), "access": ("akia",),
          "pem": ("private key",), "github": ("gh",)}
KINDS = tuple(RULES)
SPANS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob string, rules array<string>, spans {SPANS}"


def rule_versions(rules: dict) -> list[str]:
    return [f"{kind}@{version}" for kind, (version, _, _) in rules.items()]


def find(text: str, rules: dict = RULES) -> list[dict]:
    """The spans of a whole text in code points, by kind: leftmost, not overlapping."""
    low, out = text.lower(), []
    for kind, (_, pattern, least) in rules.items():
        if kind in NEEDED and not any(x in low for x in NEEDED[kind]):
            continue
        # a maximal run that is too short is never part of a longer match
        pattern = re.compile(pattern.replace("[0-9a-f]+", "[0-9a-f]{24,}") if kind == "hex" else pattern)
        for m in pattern.finditer(text):
            own = m["value"] if "value" in pattern.groupindex else m[0]
            if len(own) >= least:
                out.append({"kind": kind, "start": m.start(), "end": m.end()})
    return out


def scan(versions: DataFrame, ledger: str, rules: dict = RULES) -> DataFrame:
    """Brings the ledger up to date with all texts; returns it.

    versions: a column text, one row per historical version of a path; null is empty.
    ledger: a folder all executors reach, Parquet of (blob, rules, spans); need not exist.
    A blob is the SHA-256 of a whole text.  Each blob that lacks some of the current rule
    versions in the ledger is scanned once, for those only, however many paths hold it, and
    gets a row even if nothing is found.  Copies meet after one of them is chosen per task,
    so a blob with very many copies isn't gathered anywhere.
    """
    spark = versions.sparkSession
    current = rule_versions(rules)
    texts = versions.select(text_of().alias("text"))
    blobs = texts.groupBy(F.sha2("text", 256).alias("blob")).agg(F.first("text").alias("text"))
    seen = (_rows(spark, ledger).groupBy("blob")
            .agg(F.flatten(F.collect_list("rules")).alias("seen")))
    missing = F.array_except(F.array(*map(F.lit, current)),
                             F.coalesce("seen", F.array().cast("array<string>")))
    todo = blobs.join(seen, "blob", "left").select("blob", "text", missing.alias("rules")) \
        .filter(F.size("rules") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_version = dict(zip(current, rules.items()))
        for b in batches:
            found = [find(x.as_py(), dict(by_version[v] for v in lacking.as_py()))
                     for x, lacking in zip(b.column(1), b.column(2))]
            spans = pa.array(found, pa.list_(pa.struct(
                [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), spans],
                                             ["blob", "rules", "spans"])

    added = todo.mapInArrow(run, LEDGER)
    added.write.mode("append").parquet(ledger)
    return _rows(spark, ledger)


def _rows(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger; no rows if the folder isn't there yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def findings(versions: DataFrame, ledger: str, rules: dict = RULES) -> DataFrame:
    """(row, blob, spans): the current rules' spans of each version, by start, then kind.

    Every path of a blob gets its spans; rows without any get an empty list.  A blob that two
    scans at once, or one repeated after its commit, put into the ledger twice counts once.  A
    blob with very many paths is a skewed join on its hash, which Spark splits.
    """
    spark = versions.sparkSession
    current, place = F.array(*map(F.lit, rule_versions(rules))), F.array(*map(F.lit, rules))
    # a row's spans of rules that have a newer version don't count
    valid = F.transform(F.array_intersect("rules", current), lambda v: F.split_part(v, F.lit("@"), F.lit(1)))
    known = (_rows(spark, ledger).filter(F.arrays_overlap("rules", current))
             .select("blob", valid.alias("valid"), "spans")
             .select("blob", F.filter("spans", lambda s: F.array_contains(F.col("valid"), s["kind"])).alias("spans"))
             .groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("all")))
    ordered = F.array_sort(F.transform("all", lambda s: F.struct(
        s["start"].alias("start"), F.array_position(place, s["kind"]).alias("place"),
        s["end"].alias("end"), s["kind"].alias("kind"))))
    # written, so that both sides of the join are dealt out plainly and large blobs can be split
    known = written(known.filter(F.size("all") > 0).select("blob", ordered.alias("spans")), "known")
    rows = versions.select(F.struct(*[F.col(f"`{c}`") for c in versions.columns if c != "text"])
                           .alias("row"), F.sha2(text_of(), 256).alias("blob"))
    empty = F.array().cast("array<struct<start:int,place:bigint,end:int,kind:string>>")
    return rows.join(known, "blob", "left").select("row", "blob", F.coalesce("spans", empty).alias("spans"))
