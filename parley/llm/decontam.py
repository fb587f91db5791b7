"""Benchmark decontamination: word windows of test items found in documents and removed.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import ascii_lower, id_of, in_rows, out_rows, text_of
from parley.plans.workspace import written

WINDOW = 10
#: Words of lower-cased texts, and the same words where A-Z are still there.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A broadcast set of windows has no more rows and bytes than this, on average; larger sets go block by block.
SET_ROWS, SET_BYTES = 1 << 19, 64 << 20
#: Documents with a larger share of their words hit are dropped by `decontaminated`.
MOST_HIT = 0.5


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _windows(rows: DataFrame) -> DataFrame:
    """The rows, which have `words`, `pos` and `n`, that have a whole window there, with its `hash`."""
    return rows.filter(F.col("pos") + F.col("n") <= F.size("words")) \
        .withColumn("hash", F.xxhash64(F.slice("words", F.col("pos") + 1, F.col("n"))))


def _window_text() -> Column:
    return F.array_join(F.slice("words", F.col("pos") + 1, F.col("n")), " ")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, n, hash, gram): the distinct windows of the items, of `window` words.

    An item of fewer words is one window of them all; one without words (or null) has none.
    Rows that share an item_id are one item; a null item_id is the item named by the empty text.
    """
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            words_of(text_of()).alias("words"))
    rows = rows.select("*", F.least(F.size("words"), F.lit(window)).alias("n"),
                       F.posexplode("words").alias("pos", "word"))
    return _windows(rows).select("item", "n", "hash", _window_text().alias("gram")).distinct()


def hits(docs: DataFrame, grams: DataFrame, rows: int = SET_ROWS, size: int = SET_BYTES) -> DataFrame:
    """(d, t, pos, n, g): where the windows `grams` (g, n, hash, gram) occur in whole texts.

    d and t are the doc_id and a hash of the text.  Windows of the documents are hashed where
    they are and looked up in a broadcast set; a window whose hash is known is compared by its
    words.  The set is counted first: one that is too large is split by hash into blocks, each
    broadcast alone and its hits written, so the texts are scanned once per block.
    """
    spark = docs.sparkSession
    n_rows, n_bytes = grams.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("gram") + 64), F.lit(0))).first()
    sizes = sorted(r.n for r in grams.select("n").distinct().collect())     # `window` values at most
    if not n_rows:
        return spark.createDataFrame([], "d long, t long, pos int, n int, g long")
    read = docs.select(id_of().alias("d"), F.xxhash64(text_of()).alias("t"), words_of(text_of()).alias("words"))
    at = read.select("*", F.posexplode("words").alias("pos", "word"))
    at = at.withColumn("n", F.lit(sizes[0]) if len(sizes) == 1 else F.explode(F.array(*map(F.lit, sizes))))
    scan, blocks, found = _windows(at), max(-(-n_rows // rows), -(-n_bytes // size)), None
    for k in range(blocks):
        known = grams.filter(F.pmod("hash", F.lit(blocks)) == k)
        # `between`, because an equality would become a join key and be computed for every window
        some = scan.join(F.broadcast(known), ["hash", "n"]).filter(_window_text().between(F.col("gram"), F.col("gram"))) \
            .select("d", "t", "pos", "n", "g")
        some = written(some, "hits") if blocks > 1 else some
        found = some if found is None else found.unionByName(some)
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **bounds: int) -> DataFrame:
    """(row, text, n_words, n_hit, items, gone) of every document.

    n_words counts its words, n_hit those inside any occurrence of a window of an item; `items`
    are the ids of items with such windows, sorted as strings, and `gone` the places of the hit
    words.  `row` has the input's columns but the text, which moves only if it is asked for.  Null or empty text has no words.  Rows that are equal
    in doc_id and text get equal results; null doc_ids are one number.  Empty tables are fine.
    Lists are as long as a text or the benchmark has words or items, whatever the corpus.
    """
    pairs = written(item_windows(benchmark, window), "windows")
    grams = written(pairs.select("n", "hash", "gram").distinct()
                    .withColumn("g", F.monotonically_increasing_id()), "grams")
    found = hits(docs, grams, **bounds).groupBy("d", "t").agg(
        F.collect_set(F.struct("pos", "n")).alias("spans"), F.collect_set("g").alias("gs"))
    found = written(found.select("d", "t", "gs", F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["pos"], s["pos"] + s["n"] - 1)))).alias("gone")), "found")
    items = found.select("d", "t", F.explode("gs").alias("g")) \
        .join(grams, "g").join(pairs, ["n", "hash", "gram"]) \
        .groupBy("d", "t").agg(F.sort_array(F.collect_set("item")).alias("items"))
    rows = in_rows(docs, d=id_of(), t=F.xxhash64(text_of()),
                   n_words=F.regexp_count(text_of(), F.lit(WORD_ANY_CASE)).cast("long"))
    rows = rows.withColumn("text", F.col("row.text")).withColumn("row", F.col("row").dropFields("text"))
    none = F.array().cast("array<int>")
    return rows.join(found.drop("gs").join(items, ["d", "t"]), ["d", "t"], "left").select(
        "row", "text", "n_words", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("gone", none).alias("gone"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: float = MOST_HIT,
                   **bounds: int) -> DataFrame:
    """The documents without what they share with the benchmark, with their columns.

    A document with more than `most` of its words hit goes; from others the hit words go, each
    with what stands between it and the next word.  Documents without a hit stay as they are,
    null texts too.
    """
    judged = contamination(docs, benchmark, window, **bounds).filter(
        F.col("n_hit") <= F.lit(most) * F.col("n_words"))
    text = F.col("text")
    parts = judged.withColumn("own", F.when(F.col("n_hit") > 0, F.regexp_extract_all(
        text, F.lit(WORD_ANY_CASE), F.lit(0)))).withColumn("gaps", F.when(
            F.col("n_hit") > 0, F.split(text, WORD_ANY_CASE, -1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("own") - 1), F.col("gone"))
    left = F.concat(F.get("gaps", F.lit(0)), F.array_join(F.transform(
        stay, lambda i: F.concat(F.get("own", i), F.get("gaps", i + 1))), ""))
    return out_rows(parts, docs.columns, text=F.when(F.col("n_hit") > 0, left).otherwise(text))
