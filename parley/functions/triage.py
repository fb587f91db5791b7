"""Rule expressions that score one turn.

All of them are built-in Spark expressions, so a scoring projection stays in
one narrow stage next to the scan.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley import constants as K


def any_of(text: Column, words) -> Column:
    """True when the text holds at least one of the words as a substring."""
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def any_case(pattern: str) -> str:
    """The pattern in either case; one of whole words asks first for one of their first letters, so that
    most places of a text are passed by without trying each word."""
    words = re.fullmatch(r"\\b\(([a-zA-Z |]+)\)\\b", pattern)
    if not words:
        return "(?i)" + pattern
    first = "".join(sorted({w[0] for w in words[1].split("|")}))
    return rf"(?i)(?=[{first}])\b(?:{words[1]})\b"


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(any_case(pattern))


def count_patterns(text: Column, patterns) -> Column:
    """How many of the patterns occur in the text (not how often)."""
    return reduce(lambda a, b: a + b, [matches(text, p).cast("int") for p in patterns])


def words_found(text: Column, words) -> Column:
    """The words that occur as substrings, in list order."""
    return F.array_compact(F.array(*[F.when(text.contains(w), F.lit(w)) for w in words]))


def number_found(text: Column, words) -> Column:
    return reduce(lambda a, b: a + b, [text.contains(w).cast("int") for w in words])


def lookup(key: Column, table: dict, default) -> Column:
    """A small constant table.

    One reference to the key: a filter on the result can then be pushed below
    the projection without repeating the key's expression per entry.
    """
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def classify_intent(text: Column) -> Column:
    low = F.lower(text)
    billing = any_of(low, K.BILLING_WORDS) & any_of(low, K.BILLING_FAULT_WORDS)
    return (F.when(matches(text, K.COMPLAINT_RX), "complaint")
            .when(matches(text, K.ISSUE_RX), "technical_issue")
            .when(billing, "billing_dispute")
            .when(matches(text, K.QUESTION_RX) | text.contains("?"), "inquiry")
            .when(any_of(low, K.ACCOUNT_WORDS), "account_management")
            .otherwise("general"))


def analyze_sentiment(text: Column) -> Column:
    """Two or more, one, or no negative words decide first, then positive ones.

    Each count is used once, as a coordinate of a constant 3 x 3 table.
    """
    count = lambda rx: F.least(F.regexp_count(text, F.lit(any_case(rx))), F.lit(2))
    table = (["neutral", "positive", "very_positive"] + ["negative"] * 3
             + ["very_negative"] * 3)
    place = count(K.NEGATIVE_RX) * 3 + count(K.POSITIVE_RX) + 1
    return F.element_at(F.array(*[F.lit(x) for x in table]), place)


def high_keywords(text: Column) -> Column:
    return words_found(F.lower(text), K.HIGH_KEYWORDS)


def medium_keywords(text: Column) -> Column:
    return words_found(F.lower(text), K.MEDIUM_KEYWORDS)


def extract_products(text: Column) -> Column:
    return products_in(F.lower(text))


def products_in(low: Column) -> Column:
    """The products of a text in lower case."""
    return F.array_compact(F.array(*[F.when(any_of(low, kws), F.lit(name))
                                     for name, kws in K.PRODUCT_MENTIONS.items()]))


def extract_issues(text: Column) -> Column:
    return issues_in(F.lower(text))


def issues_in(low: Column) -> Column:
    """The issues of a text in lower case."""
    return words_found(low, K.ISSUE_MENTIONS)


def is_customer(speaker: Column) -> Column:
    return F.lower(speaker) == "customer"


def importance_score(intent: Column, sentiment: Column, n_high: Column, n_medium: Column,
                     customer: Column) -> Column:
    """Turn score in [0, 1].

    The terms are added left to right in doubles: the thresholds are compared
    with the sum as it comes out of that order.
    """
    score = F.lit(K.BASE_SCORE) + lookup(intent, K.INTENT_WEIGHT, 0.0)
    score = score + lookup(sentiment, K.SENTIMENT_WEIGHT, 0.0)
    score = score + F.least(n_high * F.lit(K.HIGH_KEYWORD_BONUS), F.lit(K.HIGH_KEYWORD_CAP))
    score = score + F.least(n_medium * F.lit(K.MEDIUM_KEYWORD_BONUS),
                            F.lit(K.MEDIUM_KEYWORD_CAP))
    score = score + F.when(customer, F.lit(K.CUSTOMER_BONUS)).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def text_importance(text: Column, speaker: Column) -> Column:
    """Turn score straight from the text."""
    low = F.lower(text)
    return importance_score(classify_intent(text), analyze_sentiment(text),
                            number_found(low, K.HIGH_KEYWORDS),
                            number_found(low, K.MEDIUM_KEYWORDS), is_customer(speaker))


def weighted_importance(intent: Column, sentiment: Column, n_high: Column, n_medium: Column,
                        customer: Column) -> Column:
    """The documented alternative: a weighted sum of four features."""
    kw = (F.least(n_high * F.lit(K.ALT_HIGH), F.lit(K.ALT_HIGH_CAP))
          + F.least(n_medium * F.lit(K.ALT_MEDIUM), F.lit(K.ALT_MEDIUM_CAP)))
    total = (lookup(intent, K.ALT_INTENT, 0.0) * F.lit(K.ALT_WEIGHTS["intent"])
             + lookup(sentiment, K.ALT_SENTIMENT, 0.0) * F.lit(K.ALT_WEIGHTS["sentiment"])
             + kw * F.lit(K.ALT_WEIGHTS["keywords"])
             + F.when(customer, F.lit(1.0)).otherwise(F.lit(0.0))
             * F.lit(K.ALT_WEIGHTS["speaker"]))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))


def requires_model(score: Column) -> Column:
    return score >= F.lit(K.HIGH_AT)


def is_critical(score: Column) -> Column:
    return score >= F.lit(K.CRITICAL_AT)


def importance_level(score: Column) -> Column:
    return (F.when(score >= F.lit(K.CRITICAL_AT), "critical")
            .when(score >= F.lit(K.HIGH_AT), "high")
            .when(score >= F.lit(K.MEDIUM_AT), "medium")
            .otherwise("low"))


def intent_severity(intent: Column) -> Column:
    return lookup(intent, K.INTENT_SEVERITY, 0)


def sentiment_severity(sentiment: Column) -> Column:
    return lookup(sentiment, K.SENTIMENT_SEVERITY, 0)


def level_order(level: Column) -> Column:
    """1 for critical … 4 for low, for custom orderings."""
    return lookup(level, {name: i + 1 for i, name in enumerate(K.LEVELS)}, None)


def select_model(level: Column, force=False) -> Column:
    force = force if isinstance(force, Column) else F.lit(bool(force))
    return F.when(force | (level == "critical"), K.EXPENSIVE_MODEL).otherwise(K.CHEAP_MODEL)


def select_model_tiered(level: Column) -> Column:
    """Four tiers; low importance gets no model."""
    return lookup(level, K.TIERED_MODELS, None)


def model_cost(tokens_in: Column, tokens_out: Column, model: Column) -> Column:
    dear = model.contains(K.EXPENSIVE_MARK)
    price_in = F.when(dear, F.lit(K.EXPENSIVE_IN)).otherwise(F.lit(K.CHEAP_IN))
    price_out = F.when(dear, F.lit(K.EXPENSIVE_OUT)).otherwise(F.lit(K.CHEAP_OUT))
    return (tokens_in / F.lit(1000.0)) * price_in + (tokens_out / F.lit(1000.0)) * price_out
