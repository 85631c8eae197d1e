import pytest

from arenalake.llm.store import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def session(spark):
    ship(spark)
    return spark


@pytest.fixture
def documents(session):
    """documents([text, ...]) or documents([(id, text), ...]) as a table with the columns of ``documents``."""

    def make(rows, partitions=3):
        pairs = [row if isinstance(row, tuple) else (k, row) for k, row in enumerate(rows)]
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        return session.createDataFrame(full, SCHEMA).repartition(partitions)

    return make


#: Names that operators use inside, and that a table may have for its own columns.
CLASHING = ["src", "key", "ids", "n", "part", "part_start", "kind", "row", "doc", "score", "spans", "token", "window",
            "tokens", "values", "words", "place", "held_out", "start", "least", "component_id", "found_id", "copy_id"]


@pytest.fixture
def with_clashing_columns():
    from pyspark.sql import functions as F

    return lambda rows: rows.select("*", *(F.lit("own").alias(x) for x in CLASHING))
