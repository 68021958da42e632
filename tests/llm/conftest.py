import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """documents table from (doc_id, text[, lang]) tuples, with extra columns whose names the operators use inside."""

    def build(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, COLUMNS)
        if not extra:
            return df
        for name in ("id", "h", "fp", "rep", "key", "score", "kept", "ids", "runs", "root", "next", "n", "line", "component_id"):
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build


@pytest.fixture(scope="session")
def texts():
    """Awkward texts: nulls, empties, ties, repeated rows, long, non-ASCII."""
    long_ = " ".join(f"w{i % 97}x{i * i % 1009}" for i in range(6000))
    share = " ".join(f"shared{i}" for i in range(60))
    return [
        (1, None), (2, ""), (2, ""), (3, "a"), (4, "Ein Wörterbuch über Öl\nund Zucker"), (5, long_), (6, long_), (6, long_),
        (7, "start " + share + " end of seven"), (8, "another one " + share), (9, share), (None, share), (None, None),
        (10, "\n\n \t\n"), (11, "The The The The " * 90), (12, "日本語 🙂 " * 120), (13, "tail " + "🙂" * 300), (14, "🙂" * 300),
    ]
