"""Personal data by weak supervision, with DataFrame functions only."""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm.common import NO_ID, id_of, text_of
from parley.plans.workspace import written

# Patterns, gazetteers and cue words.
#: Base kinds: every match that passes its check is personal data.  Runs begin where no
#: earlier character could, or where the match before ended, and don't backtrack: the same
#: matches as without, in linear time.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Candidates: matches that may be personal data; the classifier decides.
CANDIDATES = {
    "hidden_email": r"(?i)[a-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]) ?[a-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[a-z0-9-]{1,63}){1,4}",
    "local_phone": r"(?<![0-9.+-])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
KINDS = (*BASE, *CANDIDATES)
DOMAINS = r"(?i)(?:\.|dot[)\]]) ?(?:com|net|org|edu|gov|info|io|de|fr|es|uk|eu)$"
ISSUERS = r"^(?:3[47]|4|5[1-5]|2[2-7]|6)"
LOCAL_NETS = r"^(?:0|10|127|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168|22[4-9]|2[3-5][0-9])\."
AREAS = r"^\(?(?:[2-9][0-9]{2})"
NUMBERS = r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"
CUES = {
    "email": r"(?i)(?:mail|contact|write to|address)[^\n]{0,20}$",
    "ip": r"(?i)(?:\bip\b|host|address|server|from)[^\n]{0,20}$",
    "card": r"(?i)(?:card|visa|credit|payment)[^\n]{0,20}$",
    "phone": r"(?i)(?:call|phone|tel|fax|mobile|contact)[^\n]{0,20}$",
    "ssn": r"(?i)(?:ssn|social security)[^\n]{0,20}$",
}
OTHER_NUMBERS = r"(?i)(?:version|isbn|order|invoice|page|chapter|section|part no)[^\n]{0,10}$"
ALIKE = {"hidden_email": "email", "local_phone": "phone"}

LABELERS = ("shape", "gazetteer", "context", "setting")
BEFORE, MARK, MARKED = 40, "\x01", "\x02"
ROUNDS, STEPS, RATE, ACCEPT = 30, 300, 0.5, 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a text of digits passes the check sum."""
    back = F.reverse(digits)
    values = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.struct(
        i.alias("i"), F.substr(back, i, F.lit(1)).cast("int").alias("v")))
    doubled = F.transform(values, lambda x: F.when(x["i"] % 2 == 1, x["v"])
                          .when(x["v"] > 4, 2 * x["v"] - 9).otherwise(2 * x["v"]))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: Column, match: Column) -> Column:
    """The check of a base match; candidates pass."""
    digits = _digits(match)
    # without leading zeros a part has three digits at most, then its value counts
    small = F.forall(F.split(match, r"\."), lambda x: F.coalesce(
        F.length(F.ltrim(x, F.lit("0"))) <= 3, F.lit(True)) & (F.right(x, F.lit(3)).cast("int") <= 255))
    return (F.when(kind == "ip", small)
            .when(kind == "card", F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", F.length(digits).between(9, 15)).otherwise(True))


def matches(docs: DataFrame) -> DataFrame:
    """(d, t, kind, rank, start, stop, found, before, after): every match in the whole texts.

    Each match is put between two marks and the text split at them; the lengths of the parts
    before a match, in code points, add up to its start.  A mark that a text itself holds is
    first replaced by another character that no pattern knows.  `before` and `after` are the
    characters around the match.  The parts of a text and kind are rows, so a text with very
    many matches takes linear time.  Rows that repeat a doc_id and a text give one set.
    """
    text = F.replace(text_of(), F.lit(MARK), F.lit(MARKED))
    parts = F.array(*[F.struct(F.lit(k).alias("rank"), F.lit(kind).alias("kind"), F.split(
        F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK).alias("parts"))
        for k, (kind, pattern) in enumerate({**BASE, **CANDIDATES}.items())])
    found = (docs.select(id_of().alias("d"), F.xxhash64(text_of()).alias("t"),
                         F.explode(F.filter(parts, lambda x: F.size(x["parts"]) > 1)).alias("x"))
             .select("d", "t", "x.rank", "x.kind", F.posexplode("x.parts").alias("i", "part")))
    # of a text between matches only its length and what stands next to them is kept
    odd = F.col("i") % 2 == 1
    slim = found.select(
        "d", "t", "rank", "kind", "i", F.length("part").alias("n"),
        F.when(odd, F.col("part")).alias("found"),
        F.when(~odd, F.right("part", F.lit(BEFORE))).alias("tail"),
        F.when(~odd, F.left("part", F.lit(1))).alias("head")).dropDuplicates(["d", "t", "rank", "i"])
    row = Window.partitionBy("d", "t", "rank").orderBy("i")
    return slim.select(
        "d", "t", "kind", "rank", (F.sum("n").over(row) - F.col("n")).alias("start"),
        F.sum("n").over(row).alias("stop"), "found", F.lag("tail").over(row).alias("before"),
        F.lead("head").over(row).alias("after")).filter("found IS NOT NULL")


def _votes(kind: Column, found: Column, before: Column, after: Column) -> list[Column]:
    """One vote per labeler: 1 personal, -1 not, 0 abstains."""
    like = F.coalesce(*[F.when(kind == a, F.lit(b)) for a, b in ALIKE.items()], kind)
    passes = _passes(kind, found)
    shape = F.when(kind.isin(*BASE), F.when(passes, 1).otherwise(-1)).otherwise(0)
    listed = (F.when(like == "email", found.rlike(DOMAINS)).when(kind == "ip", ~found.rlike(LOCAL_NETS))
              .when(kind == "card", _digits(found).rlike(ISSUERS)).when(kind == "local_phone", found.rlike(AREAS))
              .when(kind == "ssn", found.rlike(NUMBERS)))
    gazetteer = F.when(listed, 1).when(~listed, -1).otherwise(0)
    cue = F.lit(False)
    for k, pattern in CUES.items():
        cue = F.when(like == k, before.rlike(pattern)).otherwise(cue)
    context = F.when(cue, 1).when(before.rlike(OTHER_NUMBERS), -1).otherwise(0)
    joined = F.coalesce(before, F.lit("")).rlike(r"[\p{L}0-9_/.-]$") | F.coalesce(after, F.lit("")).rlike(r"^[\p{L}0-9_/-]")
    setting = F.when(joined, -1).otherwise(0)
    return [v.cast("int").alias(name) for name, v in zip(LABELERS, (shape, gazetteer, context, setting))]


def reliabilities(patterns: list[tuple]) -> tuple[dict, dict]:
    """Expectation-maximisation over the counts of (kind, votes): (posteriors, reliabilities).

    patterns: (kind, votes, count), at most kinds x 3^labelers of them.  A labeler's
    reliability is the chance of each of its votes given the truth; kinds have a prior each.
    """
    chance = {(k, y, v): p for k in range(len(LABELERS)) for y, v, p in
              ((1, 1, .6), (1, 0, .3), (1, -1, .1), (0, 1, .1), (0, 0, .3), (0, -1, .6))}
    prior, post = {kind: .5 for kind, _, _ in patterns}, {}
    for _ in range(ROUNDS):
        for kind, votes, _ in patterns:
            odds = [prior[kind] if y else 1 - prior[kind] for y in (0, 1)]
            for k, v in enumerate(votes):
                odds = [o * chance[k, y, v] for y, o in enumerate(odds)]
            post[kind, votes] = odds[1] / sum(odds)
        for kind in prior:
            n = sum(c for q, _, c in patterns if q == kind)
            prior[kind] = (1 + sum(c * post[q, w] for q, w, c in patterns if q == kind)) / (2 + n)
        for k in range(len(LABELERS)):
            for y in (0, 1):
                share = [(w[k], c * (post[q, w] if y else 1 - post[q, w])) for q, w, c in patterns]
                whole = sum(s for _, s in share)
                for v in (1, 0, -1):
                    chance[k, y, v] = (1 + sum(s for u, s in share if u == v)) / (3 + whole)
    return post, chance


def trained(patterns: list[tuple], post: dict) -> dict:
    """Weights of a logistic span classifier: a bias per kind, a weight per labeler's vote.

    Fitted to the posteriors by gradient steps over the counted patterns.
    """
    weights: dict = {}
    total = sum(log(1 + c) for _, _, c in patterns) or 1.0
    for _ in range(STEPS):
        slope: dict = {}
        for kind, votes, count in patterns:
            names = features(kind, votes)
            z = sum(weights.get(x, 0.0) for x in names)
            # counts are damped so that frequent patterns don't silence the others
            off = (post[kind, votes] - 1 / (1 + exp(-z))) * log(1 + count) / total
            for x in names:
                slope[x] = slope.get(x, 0.0) + off
        for x, s in slope.items():
            weights[x] = weights.get(x, 0.0) + RATE * len(KINDS) * s
    return weights


def features(kind: str, votes) -> list:
    return [kind, *((name, v) for name, v in zip(LABELERS, votes) if v)]


def spans(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(d, t, kind, rank, start, stop, base, chance): the spans found in each text.

    Base spans stay whatever the classifier says.  A candidate is added if it overlaps no
    base span and the classifier gives it more than `accept`.  Without any match there are
    no rows, and nothing is trained.  The driver gets the counts of vote patterns, at most
    7 kinds x 81, and trains on them.
    """
    found = written(matches(docs), "matches")
    kind, text = F.col("kind"), F.col("found")
    of_base = kind.isin(*BASE)
    voted = found.withColumn("base", of_base & _passes(kind, text)) \
        .select("*", *_votes(kind, text, F.coalesce("before", F.lit("")), F.coalesce("after", F.lit(""))))
    counted = voted.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = sorted((r.kind, tuple(r[x] for x in LABELERS), r.n) for r in counted)
    weights = trained(patterns, reliabilities(patterns)[0]) if patterns else {}
    score = F.lit(0.0)
    for k in KINDS:
        score = F.when(kind == k, F.lit(weights.get(k, 0.0))).otherwise(score)
    for name in LABELERS:
        score = score + F.when(F.col(name) == 1, F.lit(weights.get((name, 1), 0.0))) \
            .when(F.col(name) == -1, F.lit(weights.get((name, -1), 0.0))).otherwise(0.0)
    by_start = Window.partitionBy("d", "t").orderBy("start", "rank")
    ends = F.max(F.when(F.col("base"), F.col("stop"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    free = F.coalesce(ends <= F.col("start"), F.lit(True)) & F.coalesce(begins >= F.col("stop"), F.lit(True))
    return (voted.filter(F.col("base") | ~of_base)
            .select("d", "t", "kind", "rank", "start", "stop", "base", free.alias("free"),
                    (1 / (1 + F.exp(-score))).alias("chance"))
            .filter(F.col("base") | (F.col("free") & (F.col("chance") > accept))).drop("free"))


def detected(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, spans) for every row; spans by kind as listed, then start.

    Null text is empty and has none; a null doc_id stays null; repeated rows come out as
    often as they come in; other columns of docs are not read.
    """
    per_text = spans(docs, accept).groupBy("d", "t").agg(F.array_sort(F.collect_list(F.struct(
        "rank", "start", "stop", "kind", "base"))).alias("spans"))
    rows = docs.select(id_of().alias("d"), F.xxhash64(text_of()).alias("t"))
    none = F.array().cast("array<struct<rank:int,start:bigint,stop:bigint,kind:string,base:boolean>>")
    return rows.join(per_text, ["d", "t"], "left").select(
        F.nullif("d", F.lit(NO_ID)).alias("doc_id"), F.coalesce("spans", none).alias("spans"))
