import pytest

from ordersmith.llm.common import ready


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with this package importable by its Python workers."""
    return ready(spark)


@pytest.fixture(scope="session")
def docs_of(llm):
    """Makes a documents table from ``(doc_id, text)`` rows."""
    def make(rows, extra=False):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        out = llm.createDataFrame([(i, t, "en" if i is None or i % 3 else None, f"src{(i or 0) % 7}" if i != 2 else None, None if t is None else len(t)) for i, t in rows], schema)
        # names that operators use inside
        return out.selectExpr("*", "1 AS label", "'x' AS score", "2 AS rep", "3 AS kept", "4 AS length", "5 AS `row`") if extra else out
    return make
