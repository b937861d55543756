import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use themselves."""

    def make(*rows):
        frame = spark.createDataFrame(
            [(i, t, None if t is None else "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA
        )
        extra = ["score", "n_words", "rate", "component", "node", "tokens", "starts", "text_hash", "label", "element"]
        return frame.selectExpr("*", *[f"'x' as {name}" for name in extra])

    return make


@pytest.fixture
def by_id():
    def collect(frame):
        return {row["doc_id"]: row.asDict() for row in frame.collect()}

    return collect
