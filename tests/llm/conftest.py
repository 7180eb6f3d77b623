import pytest

#: Columns of ``documents`` and two whose names clash with the operators' helpers.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _verdict string, _part int"


@pytest.fixture(scope="session")
def make(spark):
    def build(rows):
        """(doc_id, text, source) rows with nulls in the other columns."""
        full = [(d, t, None, s, None, f"v{i % 2}", i) for i, (d, t, s) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA).repartition(3)
    return build


LONG = " ".join(f"word{i % 977} tail{i}" for i in range(20_000))
ODD_ROWS = [(None, None, None), (None, "null id", "a"), (1, "", "a"), (2, " \t\n", "b"), (3, "one", None),
            (4, "one", "a"), (4, "one", "a"), (5, LONG, "b"), (6, "Ünïcode wörds 日本語 🙂 á", "c"), (7, "x" * 5000, "c")]


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD_ROWS)


@pytest.fixture(scope="session")
def none(make, spark):
    return spark.createDataFrame([], SCHEMA)
