import pytest

SCHEMA = "doc_id long, text string, source string, fp long, d long, row string, size string, rank int"
LONG = "word " * 3000 + "\n" + "x" * 5000


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text, source); further columns clash with the operators' own names."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, s, 7, 7, "r", "s", 1) for i, t, s in rows], SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and very long texts, ties, repeated rows."""
    body = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi " * 5
    return [(0, body, "a"), (1, body, "a"), (2, None, None), (3, "", "b"), (3, "", "b"), (4, LONG, "b"),
            (5, body.upper(), None), (None, body + "omega", "a"), (None, None, "a"), (6, " \t\n\x0b ", "c"),
            (7, "one two", "c"), (8, "One TWO", "c"), (9, "Éa Ünd\nA line that repeats\nA LINE that repeats ", "c"),
            (10, "  a line THAT repeats\t\nshort\nshort", "c"), (11, "a@b.co token = 'abcdef123'", "z")]
