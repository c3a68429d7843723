import pytest


@pytest.fixture()
def docs(spark):
    """Builds a documents table from (doc_id, text, source) rows, with the columns of the real one."""
    def make(rows, extra=""):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint" + extra
        more = extra.count(",")
        return spark.createDataFrame([(i, t, None, s, None if t is None else len(t), *[7] * more) for i, t, s in rows], schema)
    return make
