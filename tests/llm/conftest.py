import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text, source) rows, with the other columns of the table."""

    def build(*rows):
        frame = spark.createDataFrame([tuple(r) for r in rows], "doc_id bigint, text string, source string")
        return frame.selectExpr("doc_id", "text", "'en' AS lang", "source", "CAST(length(text) AS BIGINT) AS n_chars")

    return build


#: Columns that a caller's table may have and that operators use inside.
CLASHING = {
    name: "'mine'"
    for name in ("doc", "size", "target", "copies", "score", "base", "linked", "fp", "value", "segment", "piece", "edits_", "x")
}


@pytest.fixture(scope="session")
def with_clashes():
    def add(frame):
        return frame.selectExpr("*", *[f"{sql} AS `{name}`" for name, sql in CLASHING.items()])

    return add
