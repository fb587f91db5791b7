"""A stored inverted index: postings in buckets of terms, idf and norms of a named vocabulary.

Texts are cut into terms once, when their batch is added.  Vocabularies, norms and scores come
from the narrow postings; a search reads the buckets of the asked terms only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley import constants as K
from parley.operators import search as S
from parley.operators.turns import rank_results
from parley.plans.workspace import at_most, written
from parley.sources.stored import StoredTable

BUCKETS = 32
#: Asked terms up to this many become a filter on the postings' buckets and terms.
MAX_ASKED = 4096


def bucket_of(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


class TextIndex:
    """The index in one folder; `key` is the type of the documents' ids.

    Vocabularies are named, so one index can serve several sizes or dates; after adding batches,
    name the vocabulary again to count them in.
    """

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark, self.path = spark, path
        self.postings = StoredTable(spark, f"{path}/postings", f"doc {key}, term string, tf long, bucket int", ("bucket",))
        self.documents = StoredTable(spark, f"{path}/documents", f"doc {key}")
        self.terms = StoredTable(spark, f"{path}/vocabularies", "name string, term string, idf double")
        self.norms = StoredTable(spark, f"{path}/norms", f"name string, doc {key}, length double")

    def add(self, docs: DataFrame, doc_id: str, text: str, batch: str, bigrams: bool = True) -> None:
        """Adds a batch of new documents; a batch that is delivered again changes nothing."""
        if not self.postings.has(batch):
            counts = S.term_counts(docs, doc_id, text, bigrams).withColumnRenamed(doc_id, "doc")
            self.postings.append(counts.withColumn("bucket", bucket_of(F.col("term"))), batch)
        self.documents.append(docs.select(F.col(doc_id).alias("doc")), batch)

    def compact(self, batch: str) -> None:
        """Lays the postings of all batches out together, once there are many."""
        self.postings.compact(batch)

    def name_vocabulary(self, name: str, max_features: int = K.MAX_FEATURES) -> None:
        """Counts the vocabulary over all batches, and the documents' lengths under it."""
        n_docs = self.documents.read().agg(F.count(F.lit(1))).scalar()
        vocab = S.vocabulary(self.postings.read(), n_docs, max_features)
        self.terms.replace(vocab.withColumn("name", F.lit(name)), F.col("name"), f"{name}-{self._version()}", [name])
        vocab = S.small(self.vocabulary(name), max_features)
        norms = S.norms(S.weighted(self.postings.read(), vocab), "doc")
        self.norms.replace(norms.withColumn("name", F.lit(name)), F.col("name"), f"{name}-{self._version()}", [name])

    def _version(self) -> int:
        return self.postings.commits().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def vocabulary(self, name: str) -> DataFrame:
        return self.terms.read([name]).select("term", "idf")

    def matching(self, terms: DataFrame) -> DataFrame:
        """The postings of these terms.  Few terms become filters that reach the files; many are joined."""
        if not at_most(terms, MAX_ASKED):
            return self.postings.read().join(terms, "term", "left_semi")
        asked = [(r.term, r.bucket) for r in terms.select("term", bucket_of(F.col("term")).alias("bucket")).collect()]
        return self.postings.read().filter(
            F.col("bucket").isin(sorted({b for _, b in asked})) & F.col("term").isin(sorted({t for t, _ in asked})))

    def scores(self, queries: DataFrame, query_id: str, query_text: str, name: str) -> DataFrame:
        """(doc, query, score) of all documents that share a term with a query, as `search.keyword_scores`."""
        asked = written(S.asked_weights(queries, query_id, query_text, self.vocabulary(name)), "asked")
        found = self.matching(asked.select("term").distinct())
        return S.cosines(found, asked, query_id, "doc", self.norms.read([name]).select("doc", "length"))

    def search(self, queries: DataFrame, query_id: str, query_text: str, name: str, k: int = K.TOP_K) -> DataFrame:
        """The k best documents of each query; equal to `search.keyword_search` over all documents added."""
        return rank_results(self.scores(queries, query_id, query_text, name), [query_id], "score", "doc", k)
