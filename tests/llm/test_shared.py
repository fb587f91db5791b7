"""Decontamination, the prefix trie and the Merkle manifest, against plain brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from parley.llm import decontam, manifest, trie
from parley.llm.common import NO_ID
from parley.llm.ranked import numbered

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TOKEN = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ANY_CASE = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = "Which of the four stones in the river, if any, is the heaviest of all?"


def tokens(text):
    return TOKEN.findall((text or "").translate(AZ))


def hit_words(text, items):
    """(the places of hit words, the ids of the items that hit)"""
    w, at, ids = tokens(text), set(), set()
    for i, t in items:
        own = tokens(t)
        n = min(10, len(own))
        grams = {tuple(own[k:k + n]) for k in range(len(own) - n + 1)} if n else set()
        for k in range(len(w) - n + 1 if n else 0):
            if tuple(w[k:k + n]) in grams:
                at |= set(range(k, k + n))
                ids.add("" if i is None else str(i))
    return at, ids


def test_numbered(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < .4 else str(rng.randrange(9)), rng.choice([None, 1, 2, rng.randrange(50)]))
            for _ in range(500)] + [("same", 7)] * 100
    df = spark.createDataFrame(rows, "g string, o int").repartition(7)
    got = defaultdict(list)
    for r in numbered(df, ["g"], ["o"], "numbered").collect():
        got[r.g].append((r.pos, r.o))
    for g, own in got.items():
        own.sort()
        assert [p for p, _ in own] == list(range(len(own)))
        assert [o for _, o in own] == sorted((o for h, o in rows if h == g), key=lambda o: (o is not None, o))
    assert numbered(df.limit(0), ["g"], ["o"], "numbered").count() == 0


ITEMS = [(1, ITEM), (2, "two WORDS"), (2, "Two Words!"), (30, "nine"), (None, ITEM + " And more of it"), (4, None),
         (5, " ?! "), (6, "Éa Ünd 北京"), (7, "x " * 40)]


@pytest.mark.parametrize("bounds", [{}, {"rows": 3}])
def test_contamination(spark, docs, odd, bounds):
    rows = odd + [(20, "Before it. " + ITEM.upper() + " After.", "a"), (21, ITEM[:40], "a"), (22, "x," * 60, "b"),
                  (23, "two\x00words and two words, éa Ünd-北京", "b"), (24, "nine", "b"), (25, ITEM + " " + ITEM, None),
                  (25, ITEM + " " + ITEM, None), (26, "seventy nine " * 30 + "nineteen", "b")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("g", F.lit(1))
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), frozenset(r.gone)) for r in decontam.contamination(
        docs(rows), items, **bounds).select("row.doc_id", "n_words", "n_hit", "items", "gone").collect())
    want = Counter()
    for i, t, _ in rows:
        at, ids = hit_words(t, ITEMS)
        want[i, len(tokens(t)), len(at), tuple(sorted(ids)), frozenset(at)] += 1
    assert got == want


def test_decontaminated(spark, docs, odd):
    rows = odd + [(20, "Before it? " + ITEM.upper() + " After.", "a"), (22, "x," * 60, "b"), (25, "Nine lives\nthe NINE", "b"),
                  (26, "(one) two-words, a nine: tail", "b")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontam.decontaminated(docs(rows), items)
    assert out.columns == docs(rows).columns
    want = Counter()
    for i, t, _ in rows:
        at, _ = hit_words(t, ITEMS)
        if 2 * len(at) > len(tokens(t)):
            continue
        if at:
            own, gaps = ANY_CASE.findall(t), ANY_CASE.split(t)
            t = gaps[0] + "".join(own[k] + gaps[k + 1] for k in range(len(own)) if k not in at)
        want[i, t] += 1
    assert Counter((r.doc_id, r.text) for r in out.collect()) == want
    for d, b in ((docs(rows).limit(0), items), (docs(rows), items.limit(0))):
        assert decontam.decontaminated(d, b).count() == d.count()


def brute_trie(rows):
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        talks[NO_ID if c is None else c].append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [(r, t) for _, _, r, t in sorted(own)] for c, own in talks.items()}
    built = {}
    for c, own in talks.items():
        h = 0 if c == NO_ID else zlib.crc32(str(c).encode()) % 4
        built[c] = talks.get(c - c % 20, [])[:h] + own[h:]
    members, words = defaultdict(set), {(): 0}
    for c, own in built.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].add(c)
    for p in members:
        words[p] = len(SPACED.findall(p[-1][1])) if p else 0
    children = Counter(p[:-1] for p in members if p)
    out = Counter()
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(own) - 1) * words[p]
    for p, own in members.items():
        ends = ",".join("null" if c == NO_ID else str(c) for c in sorted(own) if len(built[c]) == len(p))
        out[min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p],
            sha256(ends.encode()).hexdigest()] += 1
    return out


def talk_rows():
    rng = random.Random(3)
    rows = []
    for c in [*range(90), 400, 401, 405, None]:
        copied = c is not None and c % 3 == 0                       # a third of all are copies
        for turn in range(6 if copied else rng.randrange(0, 7)):
            text = f"turn {turn}" if copied else rng.choice(["", None, "a b", "c\td e", "é"])
            rows.append((c, turn if turn else None, rng.choice(["user", None]) if not copied else "user", text))
    rows += [(7, k, "user", "on and on") for k in range(10, 60)]      # a long path
    return rows + [(8, 3, "user", "same turn")] * 5 + [(8, 3, "assistant", "same turn")]


@pytest.mark.parametrize("how", [{}, {"limit": 4, "block": 3, "piece": 2}, {"limit": 1, "block": 1, "piece": 1}])
def test_prefix_trie(spark, how):
    rows = talk_rows()
    talks = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string") \
        .withColumn("c", F.lit(1)).withColumn("weight", F.lit("w"))
    got = trie.prefix_trie(*trie.rebuilt_turns(talks), **how).collect()
    assert Counter(map(tuple, got)) == brute_trie(rows)


def test_prefix_trie_of_few(spark):
    talks = spark.createDataFrame([(20, 0, "user", "b")], "conv_id long, turn long, role string, text string")
    assert Counter(map(tuple, trie.prefix_trie(*trie.rebuilt_turns(talks)).collect())) == brute_trie([(20, 0, "user", "b")])
    assert trie.prefix_trie(*trie.rebuilt_turns(talks.limit(0))).count() == 0


def test_centroids_halve_components():
    """Subtree totals of random trees, deep and wide, and the number of splits a node sees."""
    rng = random.Random(8)
    for shape in (lambda k: k - 1, lambda k: 0, lambda k: rng.randrange(k), lambda k: max(0, k - rng.randrange(1, 4))):
        depth, parent = [0], [-1]
        for k in range(1, 300):
            parent.append(shape(k))
            depth.append(depth[parent[-1]] + 1)
        order = sorted(range(300), key=depth.__getitem__)
        at = {u: k for k, u in enumerate(order)}
        up = [at.get(parent[u], -1) for u in order]
        own = [rng.randrange(9) for _ in order]
        weight, want = [1] * 300, list(own)
        for k in reversed(range(1, 300)):
            weight[up[k]] += weight[k]
            want[up[k]] += want[k]
        got = [0] * 300
        trie.centroid_sums(up, weight, [own], [got])
        assert got == want


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    def leaf(i, s, lang, n, t):
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, lang, n, t)])

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][k:k + 3]) for k in range(0, len(levels[-1]), 3)])
        return levels

    def walk(levels, k, seen):
        proof = ""
        for nodes in levels[:-1]:
            a = k // 3 * 3
            left, right = "".join(nodes[a:k]), "".join(nodes[k + 1:a + 3])
            proof, seen, k = proof + left + right, digest(left, seen, right), k // 3
        return proof, seen
    by = defaultdict(list)
    for i, s, lang, n, t in rows:
        seen = t if t is None or i is None or zlib.crc32(str(i).encode()) % 2 else t.replace("\n", "")
        by[s].append((NO_ID if i is None else i, leaf(i, s, lang, n, t), leaf(i, s, lang, n, seen)))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[1] for x in sorted(by[s])]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = Counter()
    for at, s in enumerate(sources):
        for k, (i, own, seen) in enumerate(sorted(by[s])):
            low, node = walk(trees[s], k, seen)
            high, node = walk(top, at, node)
            out[i, own, trees[s][-1][0], top[-1][0], digest(low + high), node] += 1
    return out


@pytest.mark.parametrize("levels, sizes", [(7, [40, 1, 3, 4]), (1, [40, 1, 3, 4, 9, 10, 27, 28, 2, 1, 1]), (2, [82])])
def test_manifest(spark, levels, sizes):
    rows = [(7 * k + n, f"ß{n}" if n else None, "en" if k % 3 else None, k, f"line {k}\nof {n}" if k % 5 else None)
            for n, size in enumerate(sizes) for k in range(size)]
    rows += [(None, None, None, None, "a\nb"), (3, "ß1", "de", None, ""), (3, "ß1", "de", None, "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    cut = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    df = df.withColumn("seen", F.when(cut, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
    got = manifest.manifest(df.withColumn("run", F.lit(1)).withColumn("leaf", F.lit("x")), levels).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, digest(*r.siblings), r.folded) for r in got) == brute_manifest(rows)


def test_manifest_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string, seen string")
    assert manifest.manifest(df).count() == 0
