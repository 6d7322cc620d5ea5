import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def make(spark):
    """Rows as a DataFrame; documents also get clashing extra columns."""
    def build(rows, schema=DOCS, partitions=3):
        return spark.createDataFrame(rows, schema).repartition(partitions)
    return build


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text))
