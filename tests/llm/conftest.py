import pytest

#: Extra columns named like ones that operators use inside.
CLASH = "row string, size string, th string, bucket string, component string, places string, held string, part string, `key` string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) or (doc_id, text, source) rows, with clashing extra columns."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *["x"] * 9) for r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}").repartition(3)

    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    """Nulls in every column, empty and very long texts, ties, repeated rows, an id twice."""
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long), (6, long + " end"), (7, "a b c d e f g h"), (7, "a b c d e f g h"), (8, "A b C d e f g H"), (None, "a b c d e f g h"), (None, None), (9, "a b c d e f g h"), (9, "another text of id nine")]
    return docs_of([(i, t, None if k % 5 == 0 else "s1" if k % 2 else "s0") for k, (i, t) in enumerate(rows)])


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
