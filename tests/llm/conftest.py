import pytest

#: Extra columns whose names clash with those that operators add.
EXTRA = "size long, shard int, slot long, doc struct<a:int>, score double, taken long, fp string, part int, words long, _k long"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA


@pytest.fixture
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    def make(rows=None):
        rows = ODD if rows is None else rows
        full = [(d, t, lang, s, n, 9, 9, 9, None, 0.5, 9, "x", 9, 9, 9) for d, t, lang, s, n in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


LONG = "the quick brown fox jumps over a lazy dog again. " * 20000
ODD = [
    (1, "alpha beta gamma", "en", "a", 16), (1, "alpha beta gamma", "en", "a", 16), (2, "alpha beta gamma", "en", "a", 16),
    (3, None, "en", "b", None), (4, "", None, "b", 0), (5, " \t\n", "en", None, 3), (None, "no id at all", "en", None, 12),
    (None, None, None, None, None), (6, LONG, "en", "c", len(LONG)), (7, "Straße é́ \U0001f600  x\x1fy", "de", "é", 9),
    (-8, "negative id\nsecond line", "en", "", 23), (2 ** 62, "x", "en", "z", 1),
]
