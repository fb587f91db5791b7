"""Languages by character n-grams: a multinomial model fitted on a bounded sample of labelled texts.

The model is a small table (gram, log probabilities per language), whose size is bounded by its
parameters.  Texts are scored whole: their grams meet the model in a broadcast join and are added up
per text before the shuffle, so only a row of sums per text and task moves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.plans.workspace import written

#: Labelled texts per language that are read for the model: those whose md5(key) comes first.
TEXTS_PER_LANGUAGE = 400
#: Most frequent grams of each language that the model knows.
GRAMS_PER_LANGUAGE = 1500
#: A text is of an unknown language if the model knows less than this share of its grams,
MIN_KNOWN = 0.5
#: or if the best language's mean log probability per gram leads by less than this.
MIN_LEAD = 0.02
UNKNOWN = "unknown"


def grams(text: Column) -> Column:
    """Three-letter grams of lower-cased words, each word between spaces; NULL has none.

    Cut from three starting places, so that every gram is found in linear time.
    """
    letters = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))
    padded = F.when(letters == "", F.lit("")).otherwise(F.concat(F.lit(" "), letters, F.lit(" ")))
    at = [F.regexp_extract_all(padded if i == 1 else F.substring(padded, i, 2**31 - 1), F.lit("(...)"), F.lit(1))
          for i in (1, 2, 3)]
    return F.coalesce(F.concat(*at), F.array().cast("array<string>"))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: DataFrame            # (gram, p_0, p_1, ...), at most languages x GRAMS_PER_LANGUAGE rows


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang",
        texts: int = TEXTS_PER_LANGUAGE, vocabulary: int = GRAMS_PER_LANGUAGE) -> LanguageModel:
    """Fits the model; rows without a language or a text are left out."""
    order = Window.partitionBy("language").orderBy(F.md5(F.col("key").cast("string")), "key", F.xxhash64("text"))
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(language).alias("language")) \
        .filter("language IS NOT NULL AND text IS NOT NULL")
    sample = rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= texts)
    counts = written(sample.select("language", F.explode(grams(F.col("text"))).alias("gram"))
                     .groupBy("language", "gram").agg(F.count(F.lit(1)).alias("n")), "gram-counts")
    often = Window.partitionBy("language").orderBy(F.desc("n"), "gram")
    known = counts.withColumn("r", F.row_number().over(often)).filter(F.col("r") <= vocabulary).select("gram").distinct()
    counts = written(counts.join(F.broadcast(known), "gram", "left_semi"), "gram-model")
    # languages are an enumeration: one total each
    totals = {r.language: r.n for r in counts.groupBy("language").agg(F.sum("n").alias("n")).collect()}
    names, size = tuple(sorted(totals)), counts.select("gram").distinct().count()
    smoothed = [F.log((F.coalesce(F.sum(F.when(F.col("language") == x, F.col("n"))), F.lit(0)) + 1)
                      / F.lit(float(totals[x] + size))).alias(f"p_{i}") for i, x in enumerate(names)]
    return LanguageModel(names, written(counts.groupBy("gram").agg(F.lit(0).alias("known"), *smoothed).drop("known"), "languages"))


def score(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_grams, n_known, language) per key; copies of a key are one text.

    `language` is `UNKNOWN` for texts without known grams, with too few, or without a clear lead.
    """
    found = docs.select(F.col(key), F.explode_outer(grams(F.col(text))).alias("gram")) \
        .join(F.broadcast(model.table), "gram", "left")
    n = len(model.languages)
    sums = [F.sum(f"p_{i}").alias(f"s_{i}") for i in range(n)]
    hits = F.count("p_0") if n else F.lit(0).cast("bigint")
    out = found.groupBy(key).agg(F.count("gram").alias("n_grams"), hits.alias("n_known"), *sums)
    if not n:
        return out.withColumn("language", F.lit(UNKNOWN))
    scores = F.array(*[F.col(f"s_{i}") for i in range(n)])
    ranked = F.sort_array(scores, asc=False)
    lead = F.coalesce((ranked[0] - F.get(ranked, F.lit(1))) / F.col("n_known"), F.lit(float("inf")))
    clear = (F.col("n_known") > 0) & (F.col("n_known") >= F.lit(MIN_KNOWN) * F.col("n_grams")) & (lead >= F.lit(MIN_LEAD))
    best = F.element_at(F.array(*map(F.lit, model.languages)), F.array_position(scores, ranked[0]).cast("int"))
    return out.select(key, "n_grams", "n_known", F.when(clear, best).otherwise(UNKNOWN).alias("language"))


def accuracy(scored: DataFrame, truth: str = "lang") -> DataFrame:
    """Texts per true language, how many are right and how many unknown."""
    return scored.groupBy(truth).agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("language") == F.col(truth)).alias("n_right"),
        F.count_if(F.col("language") == UNKNOWN).alias("n_unknown"))
