"""Personal data: find and replace spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley import constants as K


def pii_types(text: Column) -> Column:
    """Which kinds of personal data occur, in pattern order."""
    return F.array_compact(F.array(*[F.when(text.rlike(rx), F.lit(kind))
                                     for kind, rx in K.PII_RX.items()]))


def pii_count(text: Column, kind: str) -> Column:
    return F.regexp_count(text, F.lit(K.PII_RX[kind]))


def redact(text: Column) -> Column:
    """Replace spans by type tokens, longer number formats before phones."""
    for kind in K.REDACTION_ORDER:
        text = F.regexp_replace(text, K.PII_RX[kind], K.PII_TOKENS[kind])
    return text
