import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(frame):
    """Documents from (doc_id, text[, lang, source])."""

    def make(rows):
        full = [(*r, *("en", "s")[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        return frame(DOCS, [(*r, len(r[1]) if r[1] is not None else None) for r in full])

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    same = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    return [
        (1, same, "en", "a"), (1, same, "en", "a"), (2, same, "en", "b"), (3, same.upper() + " \n\n", None, "a"), (None, same, "en", None),
        (4, None, "en", "a"), (5, "", "en", None), (6, " \t\n ", None, None), (7, long, "fr", "b"), (8, long + " end", "fr", "b"),
        (9, "short", "en", "a"), (10, "### \\ </turn> <|endoftext|> 日本語 ñ\u00a0x", "es", "c"), (11, "1234 5678", "de", "c"),
        (None, None, None, None),
    ]


@pytest.fixture(scope="session")
def clash(spark):
    """A frame with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["id", "mark", "size", "u", "g", "r", "digest", "key", "kept", "i", "m", "s", "n", "k", "t", "at", "band", "site", "words", "passes", "lines", "component_id"]

    return lambda df: df.withColumns({n: F.lit("x") for n in names if n not in df.columns})
