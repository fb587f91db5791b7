"""Text expressions: counting, noise detection, similarity, list encoding, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley import constants as K
from parley.functions.triage import any_of, count_patterns, matches, number_found
from parley.functions.vectors import once

STRINGS = "array<string>"


def squeeze(text: Column) -> Column:
    """Runs of whitespace become one blank; outer blanks go."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def words(text: Column) -> Column:
    """Whitespace-separated words (empty array for blank text)."""
    clean = squeeze(text)
    return F.when(clean == "", F.array().cast(STRINGS)).otherwise(F.split(clean, " "))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def approx_tokens(text: Column) -> Column:
    return F.floor(F.length(text) / F.lit(4)).cast("bigint")


def encode_list(items: Column) -> Column:
    return F.to_json(items)


def decode_list(text: Column) -> Column:
    """JSON text to a list; text that is not a list becomes a one-element list."""
    parsed = F.from_json(F.when(F.trim(text).startswith("["), text), STRINGS)
    return F.when(text.isNotNull(), F.coalesce(parsed, F.array(text)))


# --- noise ------------------------------------------------------------------
def any_pattern(text: Column, patterns) -> Column:
    """True when one of the patterns occurs; a single pass over the text."""
    return matches(text, "(?:" + "|".join(patterns) + ")")


def is_greeting(text: Column) -> Column:
    return any_pattern(text, K.GREETING_RX)


def is_greeting_full(text: Column) -> Column:
    return any_pattern(text, K.GREETING_FULL_RX)


def is_closing(text: Column) -> Column:
    return any_pattern(text, K.CLOSING_RX)


def is_hold(text: Column) -> Column:
    return any_pattern(text, K.HOLD_RX)


def is_resolution(text: Column) -> Column:
    return any_pattern(text, K.RESOLUTION_RX)


def procedural_ratio(text: Column, patterns=K.PROCEDURAL_RX) -> Column:
    """Patterns present per five words."""
    return count_patterns(text, patterns) / F.greatest(word_count(text) / F.lit(5.0), F.lit(1.0))


def is_substantial(text: Column, aggressive: bool = False, patterns=K.PROCEDURAL_RX) -> Column:
    """Not mostly procedural, or long enough to matter anyway."""
    limit, long_enough = (0.3, 25) if aggressive else (0.5, 15)
    return (procedural_ratio(text, patterns) < F.lit(limit)) | (word_count(text) > long_enough)


def is_short_greeting(text: Column) -> Column:
    return any_pattern(text, K.GREETING_SIMPLE_RX) & (word_count(text) <= 10)


def is_not_procedural_simple(text: Column) -> Column:
    return (count_patterns(text, K.PROCEDURAL_SIMPLE_RX) <= 1) | (word_count(text) > 20)


def clean_fillers(text: Column) -> Column:
    return squeeze(F.regexp_replace(text, "(?i)" + K.FILLER_RX, ""))


def clean_fillers_full(text: Column) -> Column:
    for pattern in K.FILLER_FULL_RX:
        text = F.regexp_replace(text, "(?i)" + pattern, "")
    return F.regexp_replace(squeeze(text), r"\s+([,.])", "$1")


# --- scores -----------------------------------------------------------------
def has_negative_words(text: Column, vocabulary=K.NEGATIVE_WORDS) -> Column:
    return any_of(F.lower(text), vocabulary)


def keyword_importance(text: Column) -> Column:
    low = F.lower(text)
    return F.least(number_found(low, K.IMPORTANT_WORDS) * F.lit(0.3)
                   + number_found(low, K.USEFUL_WORDS) * F.lit(0.1), F.lit(1.0))


def position_score(index: Column, total: Column) -> Column:
    """1 in the middle of the call, falling to 0 at both ends."""
    return F.lit(1.0) - F.abs(F.lit(0.5) - index / total.cast("double")) * F.lit(2.0)


def summary_quality(summary: Column) -> Column:
    """0.5, +0.2 for 100-300 words, +0.1 for each of three kinds of content."""
    n = word_count(summary)
    score = F.lit(0.5) + F.when(n.between(100, 300), F.lit(0.2)).otherwise(F.lit(0.0))
    for pattern in (K.SUMMARY_ISSUE_RX, K.SUMMARY_RESOLUTION_RX, K.SUMMARY_PARTY_RX):
        score = score + F.when(matches(summary, pattern), F.lit(0.1)).otherwise(F.lit(0.0))
    return F.least(score, F.lit(1.0))


# --- similarity -------------------------------------------------------------
def _gram_set(text: Column, use, kind: str) -> Column:
    return F.when(F.length(text) >= 3, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - 2), lambda i: use(F.substring(text, i, F.lit(3))))
    )).otherwise(F.array().cast(kind))


def trigrams(text: Column) -> Column:
    """Set of character trigrams; empty below three characters."""
    return _gram_set(text, lambda gram: gram, STRINGS)


def trigram_codes(text: Column) -> Column:
    """The same set by 64-bit hashes, which are told apart and compared as numbers."""
    return _gram_set(text, F.xxhash64, "array<bigint>")


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two sets; 0 when either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(
        once(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n)))


def trigram_jaccard(a: Column, b: Column, cut: bool = False) -> Column:
    """Of two texts, or with `cut` of their `trigram_codes`: a text that meets several others is cut once."""
    if cut:
        return jaccard(a, b)
    return once(trigram_codes(a), lambda x: once(trigram_codes(b), lambda y: jaccard(x, y)))


# --- labels -----------------------------------------------------------------
def preview(text: Column, n: int) -> Column:
    return F.concat(F.substring(text, 1, n), F.lit("..."))


def two_decimals(x: Column) -> Column:
    """Rounded first, so that ties print the same everywhere."""
    return F.format_string("%.2f", F.round(x, 2))


def time_range_label(start: Column, end: Column) -> Column:
    return F.format_string("%.0fs - %.0fs", start, end)


def parse_time(text: Column) -> Column:
    """ISO text to a zone-less timestamp; NULL when absent or unreadable."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def period_trunc(ts: Column, period: str) -> Column:
    """Start of the hour/day/week/month; weeks start on Monday."""
    unit = {"hourly": "hour", "daily": "day", "weekly": "week", "monthly": "month"}[period]
    return F.date_trunc(unit, ts).cast("timestamp_ntz")
