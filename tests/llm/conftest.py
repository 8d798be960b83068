import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents of (doc_id, text[, lang, source]) tuples, with columns whose names operators use too."""

    def make(*rows, extra=False):
        full = [(*r, *("en", "s0")[len(r) - 2 :], None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if not extra:
            return df
        names = "key size kept row _row spans bits place root list doc target taken text_key entropy threshold uid"
        return df.selectExpr("*", *[f"'x' AS `{n}`" for n in names.split()])

    return make


def by_id(df, *columns, key="doc_id"):
    """{id: value or values} of a frame whose ids are unique."""
    rows = df.collect()
    assert len({r[key] for r in rows}) == len(rows)
    return {r[key]: r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns) for r in rows}
