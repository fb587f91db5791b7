"""Search over documents, vectors and call segments."""

from pyspark.sql import functions as F

from parley import constants as K
from parley.catalog import sql_views as V
from parley.catalog import turns as TU
from parley.catalog.base import query
from parley.catalog.scalars import label_centroids
from parley.catalog.sql_views import r, sql, view
from parley.operators import quantized as Z
from parley.operators import search as S
from parley.operators.postings import TextIndex
from parley.plans.workspace import new_path

STOP = V.words(K.STOP_WORDS)


# --- SQL views --------------------------------------------------------------
def gram_views(prefix, source, key, text):
    """`<prefix>`: (k, term, tf) of unigrams and bigrams without stop words."""
    view(prefix, f"""SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(list_concat(w,
 [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS term FROM (SELECT {key} AS k,
 [x FOR x IN {TU.tokens_sql(text)} IF NOT list_contains({STOP}, x)] AS w FROM {source})) GROUP BY ALL""", source)


def index_views(prefix, source, key, text, features=K.MAX_FEATURES):
    """`<prefix>_idf` and `<prefix>_w`: vocabulary and unit document vectors."""
    gram_views(f"{prefix}_tf", source, key, text)
    view(f"{prefix}_idf", f"""SELECT term, ln(((SELECT count(*) FROM {source}) + 1) / (df + 1)::DOUBLE) + 1 AS idf
 FROM (SELECT term, sum(tf) AS total, count(*) AS df FROM {prefix}_tf GROUP BY 1) ORDER BY total DESC, term
 LIMIT {features}""", f"{prefix}_tf")
    weight_view(f"{prefix}_w", f"{prefix}_tf", f"{prefix}_idf")


def weight_view(name, tf, idf):
    view(name, f"""SELECT k, term, tf, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY k)) AS w
 FROM {tf} JOIN {idf} USING (term)""", tf, idf)


view("documents_v", "SELECT * FROM documents")
view("benchmark_v", "SELECT * FROM benchmark")
index_views("doc", "documents_v", "doc_id", "text")
gram_views("item_tf", "benchmark_v", "item_id", "text")
weight_view("item_w", "item_tf", "doc_idf")
view("kw_scores", """SELECT i.k AS item_id, d.k AS doc_id, round(sum(i.w * d.w), 9) AS score
 FROM item_w i JOIN doc_w d USING (term) GROUP BY ALL HAVING round(sum(i.w * d.w), 9) > 0""", "item_w", "doc_w")
TU.vector_views("doc_vec", "documents_v", "doc_id", "text")
TU.vector_views("item_vec", "benchmark_v", "item_id", "text")
view("vec_scores", """SELECT item_id, doc_id, coalesce(round(s, 9), 0::DOUBLE) AS score FROM (SELECT item_id FROM benchmark)
 CROSS JOIN (SELECT doc_id FROM documents) LEFT JOIN (SELECT i.k AS item_id, d.k AS doc_id, sum(i.x * d.x) AS s
  FROM item_vec i JOIN doc_vec d USING (slot) GROUP BY ALL) USING (item_id, doc_id)""", "item_vec", "doc_vec")


def top(source, k, q="item_id", d="doc_id"):
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {q} ORDER BY score DESC, {d}) AS rank "
            f"FROM {source}) WHERE rank <= {k}")


def _merged(kw, sem, q="item_id", d="doc_id"):
    return f"""SELECT {q}, {d}, coalesce(a.score, 0::DOUBLE) AS keyword_score, coalesce(b.score, 0::DOUBLE) AS semantic_score,
 round(coalesce(a.score, 0::DOUBLE) * 0.3::DOUBLE + coalesce(b.score, 0::DOUBLE) * 0.7::DOUBLE, 9) AS score
 FROM ({kw}) a FULL JOIN ({sem}) b USING ({q}, {d})"""


# --- queries ----------------------------------------------------------------
def _docs(t):
    return t.table("documents").select("doc_id", "text", "lang", "source")


def _items(t):
    return t.table("benchmark").select("item_id", F.col("text").alias("item_text"))


def _embedded(t):
    return S.embed_texts(_items(t), "item_text", "item_vec"), S.embed_texts(_docs(t), "text")


@query(sql(f"""SELECT k AS doc_id, term, tf, {r('w')} AS weight FROM doc_w""", "doc_w"))
def tfidf_index(t):
    return S.tfidf_index(_docs(t), "doc_id", "text")


@query(sql("SELECT item_id, doc_id, round(score, 6) AS score, rank FROM (" + top("kw_scores", 10) + ")", "kw_scores"))
def keyword_search(t):
    return S.keyword_search(_items(t), "item_id", "item_text", _docs(t), "doc_id", "text")


@query(sql("SELECT item_id, doc_id, round(score, 6) AS score, rank FROM (" + top("kw_scores", 10) + ")", "kw_scores"))
def stored_keyword_search(t):
    """The same answers from an index that stays: documents come in a batch per language."""
    index, docs = TextIndex(t.spark, new_path(t.spark, "text-index"), "bigint"), _docs(t)
    english = F.col("lang").eqNullSafe("en")
    index.add(docs.filter(english), "doc_id", "text", "english")
    index.add(docs.filter(~english), "doc_id", "text", "others")
    index.name_vocabulary("current")
    return index.search(_items(t), "item_id", "item_text", "current").withColumnRenamed("doc", "doc_id")


@query(sql("SELECT item_id, count(*) AS n_hits, round(max(score), 6) AS best FROM kw_scores GROUP BY 1", "kw_scores"))
def positive_score_filter(t):
    """All keyword hits (score above zero) of each query."""
    return S.keyword_scores(_items(t), "item_id", "item_text", _docs(t), "doc_id", "text").groupBy(
        "item_id").agg(F.count(F.lit(1)).alias("n_hits"), F.max("score").alias("best"))


@query(sql("""SELECT k AS item_id, term, count(*) AS n_docs FROM item_tf JOIN (SELECT term, k AS d FROM doc_w)
 USING (term) GROUP BY ALL""", "item_tf", "doc_w"))
def term_match_join(t):
    """Query terms matched with the documents that hold them."""
    index = S.tfidf_index(_docs(t), "doc_id", "text")
    df = index.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))
    asked = S.term_counts(_items(t), "item_id", "item_text").select("item_id", "term")
    return asked.join(df, "term").select("item_id", "term", "n_docs")


_DOT = ("list_sum([embedding[i]::DOUBLE * centroid[i] FOR i IN range(1, len(centroid) + 1)]) / "
        "(sqrt(list_sum([e::DOUBLE * e::DOUBLE FOR e IN embedding])) * sqrt(list_sum([c * c FOR c IN centroid])))")
view("centroids", """SELECT label AS qid, list(m ORDER BY i) AS centroid FROM (SELECT label, i,
 round(avg(embedding[i]::DOUBLE), 9) AS m FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i
 FROM embeddings) GROUP BY ALL) GROUP BY label""")
view("centroid_scores", f"SELECT qid::BIGINT AS qid, vec_id, round({_DOT}, 9) AS score FROM centroids CROSS JOIN embeddings",
     "centroids")


def _centroids(t):
    return label_centroids(t).withColumnRenamed("label", "qid")


@query(sql("SELECT qid, vec_id, round(score, 6) AS score, rank FROM (" + top("centroid_scores", 10, "qid", "vec_id") + ")",
           "centroid_scores"))
def vector_search(t):
    """The vectors closest to the centroid of each label."""
    return S.vector_search(_centroids(t), "qid", "centroid", t.table("embeddings"), "vec_id",
                           "embedding")


_SELF = ("SELECT a.vec_id AS qid, b.vec_id, round(list_sum([a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE "
         "FOR i IN range(1, len(a.embedding) + 1)]) / (a.n * b.n), 9) AS score FROM e a CROSS JOIN e b")


@query(sql("WITH e AS (SELECT vec_id, embedding, sqrt(list_sum([x::DOUBLE * x::DOUBLE FOR x IN embedding])) AS n "
           f"FROM embeddings) SELECT qid, vec_id, round(score, 6) AS score, rank FROM ({top('(' + _SELF + ')', 5, 'qid', 'vec_id')})"))
def vector_score_join(t):
    """Every vector as a query: the five nearest of each."""
    e = t.table("embeddings")
    return S.vector_search(e.select(F.col("vec_id").alias("qid"), "embedding"), "qid", "embedding",
                           e.select("vec_id", F.col("embedding").alias("v")), "vec_id", "v", 5)


@query(sql("SELECT item_id, doc_id, round(score, 6) AS score, rank FROM (" + top("vec_scores", 10) + ")", "vec_scores"))
def semantic_search(t):
    items, docs = _embedded(t)
    return S.vector_search(items, "item_id", "item_vec", docs, "doc_id", "embedding")


_SHOWN = ("item_id, doc_id, round(keyword_score, 6) AS keyword_score, "
          "round(semantic_score, 6) AS semantic_score, round(score, 6) AS score")


@query(sql(f"SELECT {_SHOWN} FROM ({_merged(top('kw_scores', 20), top('vec_scores', 20))})",
           "kw_scores", "vec_scores"))
def merge_rankings(t):
    items, docs = _embedded(t)
    kw = S.keyword_search(items, "item_id", "item_text", docs, "doc_id", "text", 20)
    sem = S.vector_search(items, "item_id", "item_vec", docs, "doc_id", "embedding", 20)
    return S.merge_rankings(kw, sem, "item_id", "doc_id")


@query(sql(f"SELECT {_SHOWN}, rank FROM (" + top(f"({_merged(top('kw_scores', 20), top('vec_scores', 20))})", 10) + ")",
           "kw_scores", "vec_scores"))
def hybrid_search(t):
    items, docs = _embedded(t)
    return S.hybrid_search(items, "item_id", "item_text", "item_vec", docs, "doc_id", "text",
                           "embedding")


view("rrf_scores", f"""SELECT item_id, doc_id, round(sum(s), 9) AS score FROM (
 SELECT item_id, doc_id, 1::DOUBLE / (60 + rank) AS s FROM ({top('kw_scores', 20)})
 UNION ALL SELECT item_id, doc_id, 1::DOUBLE / (60 + rank) FROM ({top('vec_scores', 20)})) GROUP BY ALL""",
     "kw_scores", "vec_scores")


@query(sql(f"SELECT item_id, doc_id, {r('score')} AS score, rank FROM ({top('rrf_scores', 10)})", "rrf_scores"))
def rrf_search(t):
    items, docs = _embedded(t)
    kw = S.keyword_search(items, "item_id", "item_text", docs, "doc_id", "text", 20)
    sem = S.vector_search(items, "item_id", "item_vec", docs, "doc_id", "embedding", 20)
    return S.rrf_merge(kw, sem, "item_id", "doc_id", k=10)


@query(sql("SELECT item_id, doc_id, round(score, 6) AS score, rank FROM (" + top(
    f"(SELECT x.item_id, x.doc_id, x.score FROM ({top('vec_scores', 20)}) x JOIN documents USING (doc_id) WHERE lang IN ('en', 'fr'))",
    10) + ")", "vec_scores"))
def over_fetch(t):
    """Fetch 20, keep the English and French ones, cut to ten."""
    items, docs = _embedded(t)
    ranked = S.vector_search(items, "item_id", "item_vec", docs, "doc_id", "embedding", 20)
    return S.over_fetch(ranked, _docs(t), "item_id", "doc_id", {"lang": ["en", "fr"]}, 10)


@query(sql(f"""SELECT k AS doc_id, slot, {r('x')} AS x FROM doc_vec""", "doc_vec"))
def embed_texts(t):
    rows = S.embed_texts(_docs(t), "text").select("doc_id", F.posexplode("embedding").alias("slot", "x"))
    return rows.filter(F.col("x") != 0).select("doc_id", F.col("slot").cast("bigint").alias("slot"), "x")


@query()
def ann_search(t):
    asked = t.table("embeddings").filter("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("asked"))
    return S.ann_search(asked, "qid", "asked", t.table("embeddings"), "vec_id",
                        "embedding")


def _quantized(t):
    """Every vector whose id is divisible by 50 asks all vectors."""
    vectors = t.table("embeddings")
    asked = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("asked"))
    return vectors, asked, Z.QuantizedIndex(vectors, "vec_id", "embedding").search(asked, "qid", "asked")


@query()
def ann_quantized(t):
    return _quantized(t)[2]


@query(sql("SELECT count(*) AS n_queries, TRUE AS recall_ok FROM embeddings WHERE vec_id % 50 = 0 AND embedding IS NOT NULL"))
def ann_quantized_recall(t):
    """Whether at least nine of ten exact neighbours are found through the codes."""
    vectors, asked, found = _quantized(t)
    exact = S.vector_search(asked, "qid", "asked", vectors, "vec_id", "embedding")
    both = exact.join(found.withColumn("hit", F.lit(1)).select("qid", "vec_id", "hit"), ["qid", "vec_id"], "left")
    return both.agg(F.countDistinct("qid").alias("n_queries"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recall_ok"))


@query(sql("""SELECT 'embedding_sentence-transformers' AS model, count(*) AS num_texts, count(*) * 100 AS total_tokens,
 round(count(*) * 100 / 1000.0::DOUBLE * 0.00002::DOUBLE, 6) AS cost_usd FROM seg""", "seg"))
def embedding_cost(t):
    return S.embedding_cost(t.segments)


@query(sql("""SELECT sum(n)::BIGINT AS n_texts, count(*) AS n_distinct, round(1 - count(*) / sum(n)::DOUBLE, 6) AS reuse_ratio
FROM (SELECT sha256(text), count(*) AS n FROM turns GROUP BY 1)""", "turns"))
def embedding_reuse(t):
    return S.embedding_reuse(t.turns, "text")


QUESTION = "Who reported fraud or an error on the credit card and wants a refund?"
view("turn_docs", "SELECT concat(call_id, '#', turn_index) AS turn_key, text FROM turns", "turns")
index_views("turn_doc", "turn_docs", "turn_key", "text")
view("question_v", f"SELECT 0 AS question_id, {V.lit(QUESTION)} AS text")
gram_views("question_tf", "question_v", "question_id", "text")
weight_view("question_w", "question_tf", "turn_doc_idf")


@query(sql(f"""SELECT call_id, turn_index, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY call_id
 ORDER BY score DESC, turn_index) AS rank FROM (SELECT split_part(d.k, '#', 1) AS call_id, split_part(d.k, '#', 2)::BIGINT AS turn_index,
  round(sum(q.w * d.w), 9) AS score FROM question_w q JOIN turn_doc_w d USING (term) GROUP BY d.k)) WHERE rank <= 3""",
           "question_w", "turn_doc_w"))
def query_focused_turns(t):
    """Per call, the three turns closest to one question."""
    from parley.operators.summaries import query_focused_turns as focus
    return focus(t.turns, QUESTION)
