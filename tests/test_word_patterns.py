"""Patterns of whole words that look at a first letter match what the plain ones do."""

from pyspark.sql import functions as F

from parley import constants as K
from parley.functions import triage as T


def test_first_letters_change_no_match(spark):
    texts = ["a COMPLAINT", "complaints", "uncancel cancel", "thanks, thank you", "Can You", "badly bad", "", "é error",
             "not  working not working", "bug-bug", "_hate hate_", "worst. Worst", "how", "show"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for rx in (K.COMPLAINT_RX, K.ISSUE_RX, K.QUESTION_RX, K.NEGATIVE_RX, K.POSITIVE_RX):
        assert "(?=[" in T.any_case(rx)
        count = lambda p: F.regexp_count("t", F.lit(p))
        assert df.filter(count(T.any_case(rx)) != count("(?i)" + rx)).isEmpty()
    assert T.any_case("how are you") == "(?i)how are you"
