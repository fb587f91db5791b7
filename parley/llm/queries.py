"""Registered queries of the operators, and their SQL texts where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from parley.llm import (chat, decontam, lengths, lines, manifest, mixing, packing, phrases, pii, quality,
                        secrets, simhash, trie)
from parley.llm.common import NO_ID
from parley.plans.workspace import new_path, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": corpus_pipeline.run}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers `fn(table reader)` under its name, with its SQL text."""
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


@query()
def op1_simhash(table):
    return simhash.near_duplicates(table("documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op2_token_counts(table):
    return lengths.limits(lengths.length_histogram(table("documents")))


# Each match stands between two private-use characters; the lengths of what is between them
# give the positions.
FIND_SQL = r"""SELECT doc_id, '{kind}' AS kind, {place} AS place, part AS found,
       (sum(len(part)) OVER (PARTITION BY doc_id ORDER BY i) - len(part))::BIGINT AS start, i
  FROM (SELECT doc_id, unnest(parts) AS part, unnest(range(len(parts))) AS i
        FROM (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '({pattern})',
              chr(57344) || '\1' || chr(57344), 'g'), chr(57344)) AS parts FROM documents)
        WHERE len(parts) > 1)"""
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+"""
VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?"""
SECRETS = (("assign", ASSIGN, f"len(regexp_replace(found, '{VALUE}', '')) >= 6"),
           ("access", "AKIA[A-Z0-9]+", "len(found) >= 20"), ("hex", "[0-9a-f]+", "len(found) >= 24"),
           ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "true"),
           ("github", "gh[pousr]_[A-Za-z0-9]+", "len(found) >= 40"))


@query("WITH spans AS (" + " UNION ALL ".join(
    f"SELECT doc_id, kind, place, start, start + len(found) AS ends FROM ({FIND_SQL.format(kind=kind, place=k, pattern=p)}) "
    f"WHERE i % 2 = 1 AND {ok}" for k, (kind, p, ok) in enumerate(SECRETS)) + """),
joined AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
   count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
   string_agg(concat(kind, ':', start, ':', ends), ',' ORDER BY start, place) FILTER (place < 3) AS base,
   string_agg(concat(kind, ':', start, ':', ends), ',' ORDER BY start, place) AS spans
 FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans FROM documents LEFT JOIN joined USING (doc_id)""")
def op3_secret_scans(table):
    docs = table("documents")
    ledger = new_path(docs.sparkSession, "ledger")
    secrets.scan(docs, ledger)
    found = secrets.findings(docs.select("doc_id", "text"), ledger)

    def text(kinds):
        own = F.filter("spans", lambda s: s["kind"].isin(*kinds))
        return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = secrets.KINDS[:3]

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("row.doc_id", *map(number, base), F.sha2(text(base), 256).alias("base_sha256"),
                        text(secrets.KINDS).alias("spans"))


WORDS_SQL = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text,
                     {WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) >= 3),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
            FROM starts JOIN docs USING (doc_id)),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
             FROM windows, range(3) r(k) WHERE n > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, source, pos, line, count(*) OVER (PARTITION BY doc_id, line) AS n_same,
                 array_to_string({WORDS_SQL.format("line")}, ' ') AS spaced,
                 len({WORDS_SQL.format("line")}) AS n
          FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                       unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs)),
plain AS (SELECT doc_id, source, pos, {LOWER_SQL.format("spaced")} AS h, n FROM lines WHERE n > 0),
dups AS (SELECT doc_id, sum(n - 1) AS n_dup_lines
         FROM (SELECT doc_id, line, count(*) AS n FROM lines WHERE n > 0 GROUP BY ALL) GROUP BY ALL),
classes AS (SELECT doc_id, string_agg(h, chr(10) ORDER BY pos) AS class FROM plain GROUP BY ALL),
hosts AS (SELECT source, count(*) AS size FROM docs GROUP BY ALL),
frequent AS (SELECT p.source, h, count(DISTINCT class) AS n
             FROM plain p JOIN classes USING (doc_id) GROUP BY ALL),
removed AS (SELECT p.doc_id, sum(p.n) AS n_removed FROM plain p
            JOIN frequent f ON p.source IS NOT DISTINCT FROM f.source AND p.h = f.h
            JOIN hosts o ON p.source IS NOT DISTINCT FROM o.source
            WHERE f.n > {quality.LINE_DOCS} AND f.n > o.size * {quality.LINE_SHARE}::DOUBLE GROUP BY ALL),
counted AS (SELECT doc_id, len(w)::BIGINT AS n_words,
       coalesce(len(array_to_string(w, '')), 0)::BIGINT AS word_chars,
       (len(text) - len(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
       coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
       coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
       coalesce(n_removed, 0)::BIGINT AS n_removed
  FROM docs LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id)
       LEFT JOIN removed USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND NOT 100 * (n_words - n_removed) < {quality.LEFT_PERCENT} * n_words AS kept
FROM counted""")
def op4_quality_rules(table):
    return quality.judged(table("documents")).select(
        F.nullif("d", F.lit(NO_ID)).alias("doc_id"), *quality.STATS, "n_removed",
        "base_failed", "kept")


@query(r"""
WITH sizes AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
   (('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, 'null'), ':42')), 1, 13))::BIGINT + 0.5::DOUBLE)
       / 4503599627370496::DOUBLE AS u FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY ALL),
capped AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
           2.0::DOUBLE * source_size AS cap FROM by_source),
levels AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM by_source)
     - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE))
     / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS need
   FROM capped),
goals AS (SELECT source, source_size, least(cap, (SELECT max(need) FROM levels WHERE need <= cap / weight) * weight) AS target FROM levels),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0::DOUBLE END AS rate FROM goals),
rests AS (SELECT source, source_size, target, floor(rate) AS whole, rate - floor(rate) AS odds,
          target - floor(rate) * source_size AS rest FROM rates),
classes AS (SELECT source, len(bin(size)) AS bits, sum(size)::BIGINT AS words FROM sizes GROUP BY ALL),
needs AS (SELECT c.source, bits, (rest - coalesce(sum(words) OVER (PARTITION BY c.source ORDER BY bits DESC
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE) / nullif((sum(bits * words) OVER (PARTITION BY c.source
      ORDER BY bits DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE, 0::DOUBLE) AS need
   FROM classes c JOIN rests r ON c.source IS NOT DISTINCT FROM r.source WHERE odds > 0 AND rest > 0),
chances AS (SELECT source, bits, least(1::DOUBLE, max(CASE WHEN need <= 1::DOUBLE / bits THEN need END) OVER (PARTITION BY source)
      * bits) AS p FROM needs),
ranked AS (SELECT s.*, r.* EXCLUDE (source), CASE WHEN p >= 1 THEN 0::DOUBLE ELSE (u / (1 - u)) / (p / (1 - p)) END AS q
           FROM sizes s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
           JOIN chances h ON s.source IS NOT DISTINCT FROM h.source AND bits = len(bin(size))),
summed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id, size) AS upto FROM ranked),
crossing AS (SELECT source, q AS cq, doc_id AS cd, rest - (upto - size) AS short, upto - rest AS over
             FROM summed WHERE upto - size < rest AND rest <= upto),
later AS (SELECT s.source, max((size, q, doc_id)) AS extra FROM summed s
          JOIN crossing c ON s.source IS NOT DISTINCT FROM c.source
          WHERE (q, doc_id) > (cq, cd) AND size > 0 AND size <= short GROUP BY ALL),
cuts AS (SELECT c.*, x.extra, over <= short - coalesce(x.extra[1], 0) AS with_last
         FROM crossing c LEFT JOIN later x ON c.source IS NOT DISTINCT FROM x.source),
sampled AS (SELECT s.doc_id, s.size, (q, s.doc_id) < (cq, cd) OR (s.doc_id = cd AND with_last)
              OR (NOT with_last AND coalesce(extra[3] = s.doc_id, false)) AS taken
            FROM summed s JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source)
SELECT s.doc_id, s.size, r.source_size, r.target,
       (s.size * (r.whole + coalesce(t.taken, false)::INT))::BIGINT AS taken
FROM sizes s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
LEFT JOIN sampled t ON s.doc_id = t.doc_id""")
def op5_mixing(table):
    return mixing.mix(table("documents")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"))


@query(f"""
WITH lines AS (SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line
               FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, {LOWER_SQL.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
          FROM lines),
held AS (SELECT key, min(doc_id) AS first, count(DISTINCT doc_id) AS n FROM keyed
         WHERE len(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT k.*, h.first IS NOT NULL AND h.first <> doc_id AS gone
           FROM keyed k LEFT JOIN held h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op6_line_dedup(table):
    return lines.dedupe_lines(table("documents")).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op7_pii(table):
    def text(of):
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["base"])
    return pii.detected(table("documents")).select(
        "doc_id", *map(number, pii.BASE), F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"))


@query()
def op8_best_fit_packing(table):
    return packing.pack(table("documents"))


@query()
def op9_phrase_fingerprints(table):
    return phrases.compared_with_edit(table("documents"))


@query()
def op10_reply_trees(table):
    talks = table("conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    extra = talks.sparkSession.createDataFrame(
        [(-1, 0, "user", marks), (-1, 1, "assistant", marks)], talks.schema)
    messages = written(chat.reply_chains(talks.unionByName(extra)), "messages")
    return chat.digests(chat.format_branches(messages)).withColumn(
        "conv_id", F.nullif("conv_id", F.lit(NO_ID)))


ITEM_WORDS_SQL = rf"regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '{decontam.WORD}')"


@query(f"""
WITH words AS (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word
               FROM (SELECT doc_id, {ITEM_WORDS_SQL} AS w FROM documents)),
items AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {ITEM_WORDS_SQL} AS w FROM benchmark)),
grams AS (SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS gram
          FROM (SELECT *, unnest(range(len(w) - n + 1)) AS i FROM items WHERE n > 0)),
runs AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l
         FROM words),
windows AS (SELECT doc_id, i, n, array_to_string(l[1:n], ' ') AS gram
            FROM runs, (SELECT DISTINCT n FROM grams) WHERE len(l) >= n),
hits AS (SELECT doc_id, i, n, item_id FROM windows JOIN grams USING (n, gram)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
         FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n_words FROM words GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents LEFT JOIN counted USING (doc_id) LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)""")
def op11_decontamination(table):
    return decontam.contamination(table("documents"), table("benchmark")).select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


CRC_SQL = """xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split({0}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda x, b: list_reduce(
    list_concat([xor(x, b)], range(8)), lambda a, i: xor(a >> 1, 3988292384::BIGINT * (a & 1)))))"""


@query(f"""
WITH RECURSIVE own AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS p FROM conversations),
convs AS (SELECT c, c - c % 20 AS b, {CRC_SQL.format("c")} % 4 AS h FROM own GROUP BY c),
mixed AS (SELECT convs.c, 0 AS part, p, role, text FROM convs JOIN own ON own.c = b AND p < h
          UNION ALL SELECT convs.c, 1, p, role, text FROM convs JOIN own ON own.c = convs.c AND p >= h),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS depth,
                 sha256(concat(length(role), ':', role, text)) AS h,
                 len({WORDS_SQL.format("text")}) AS words FROM mixed),
prefix AS (SELECT c, depth, words, string_agg(h, '') OVER (PARTITION BY c ORDER BY depth) AS path FROM turns
           UNION ALL SELECT c, 0, 0, '' FROM convs),
nodes AS (SELECT path, min(c) AS conv_id, min(depth)::BIGINT AS depth, count(*) AS n_convs, max(words) AS words
          FROM prefix GROUP BY path),
linked AS (SELECT n.*, u.conv_id AS parent FROM nodes n LEFT JOIN nodes u
           ON n.depth > 0 AND u.path = left(n.path, greatest(len(n.path) - 64, 0))),
fanned AS (SELECT u.path, count(n.path) AS n_children FROM nodes u LEFT JOIN nodes n
           ON n.depth > 0 AND u.path = left(n.path, greatest(len(n.path) - 64, 0)) GROUP BY u.path),
over AS (SELECT n.path AS node, n.path AS above FROM nodes n
         UNION ALL SELECT node, left(above, len(above) - 64) FROM over WHERE above <> ''),
summed AS (SELECT above AS path, count(*) FILTER (n_children = 0) AS n_leaves,
                  sum((n_convs - 1) * words)::BIGINT AS saved_tokens
           FROM over JOIN nodes ON nodes.path = over.node JOIN fanned ON fanned.path = over.node GROUP BY above),
ends AS (SELECT path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
         FROM (SELECT c, arg_max(path, depth) AS path FROM prefix GROUP BY c) GROUP BY path)
SELECT conv_id, depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM linked JOIN fanned USING (path) JOIN summed USING (path) LEFT JOIN ends USING (path)""")
def op12_prefix_trie(table):
    nodes = trie.prefix_trie(*trie.rebuilt_turns(table("conversations")))
    return nodes.select(F.nullif("m", F.lit(NO_ID)).alias("conv_id"), "depth",
                        F.nullif("up", F.lit(NO_ID)).alias("parent_conv_id"), "n_convs", "n_children",
                        "n_leaves", "saved_tokens", F.col("digest").alias("ends_sha256"))


LEAF_SQL = "sha256(concat(" + ", ".join(
    f"coalesce(concat(strlen({c}::VARCHAR), ':', {c}::VARCHAR), '-')" for c in manifest.FIELDS) + "))"


@query(f"""
WITH RECURSIVE leaves AS (SELECT doc_id, source, {LEAF_SQL} AS leaf FROM documents),
seen AS (SELECT doc_id, {LEAF_SQL} AS seen FROM (SELECT * REPLACE (CASE WHEN {CRC_SQL.format("doc_id")} % 2 = 0
         THEN replace(text, chr(10), '') ELSE text END AS text) FROM documents)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i,
                    count(*) OVER (PARTITION BY source) AS n FROM leaves),
low AS (SELECT source, 0 AS level, i, n, leaf AS h FROM numbered
        UNION ALL SELECT source, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
        FROM low WHERE n > 1 GROUP BY source, level, i // 3, n),
subroots AS (SELECT source, level AS top, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i,
                    count(*) OVER () AS n FROM low WHERE n = 1),
high AS (SELECT 0 AS level, i, n, subroot AS h FROM subroots
         UNION ALL SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
         FROM high WHERE n > 1 GROUP BY level, i // 3, n),
groups AS (SELECT source, level, i // 3 AS g, list(h ORDER BY i) AS hs FROM low WHERE n > 1 GROUP BY ALL
           UNION ALL SELECT s.source, s.top + level, high.i // 3, list(h ORDER BY high.i)
           FROM high, subroots s WHERE high.n > 1 GROUP BY ALL),
walk AS (SELECT doc_id, x.source, top, s.i AS place, 0 AS level, CASE WHEN top = 0 THEN s.i ELSE x.i END AS i,
                seen AS h, '' AS proof
         FROM numbered x JOIN seen USING (doc_id) JOIN subroots s ON x.source IS NOT DISTINCT FROM s.source
         UNION ALL SELECT doc_id, w.source, top, place, w.level + 1,
           CASE WHEN w.level + 1 = top THEN place ELSE i // 3 END,
           sha256(concat(array_to_string(hs[1:i % 3], ''), h, array_to_string(hs[i % 3 + 2:], ''))),
           concat(proof, array_to_string(hs[1:i % 3], ''), array_to_string(hs[i % 3 + 2:], ''))
         FROM walk w JOIN groups x ON x.source IS NOT DISTINCT FROM w.source AND x.level = w.level AND g = i // 3),
last AS (SELECT doc_id, arg_max(h, level) AS folded_root, arg_max(proof, level) AS proof FROM walk GROUP BY doc_id),
root AS (SELECT h AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN last USING (doc_id), subroots s, root WHERE s.source IS NOT DISTINCT FROM leaves.source""")
def op13_merkle_manifest(table):
    docs = table("documents").select(*manifest.FIELDS)
    cut = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    rows = docs.withColumn("seen", F.when(cut, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
    return manifest.manifest(rows).select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"))
