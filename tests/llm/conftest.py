import pytest

PATTERN_FILE = "byte_bpe_50k.tiktoken"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) or (id, text, source) rows, with extra columns whose names the operators use themselves."""

    def make(rows, extra=True):
        rows = [(*r, "s")[:3] for r in rows]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
        if extra:
            df = df.selectExpr("*", "1 AS id", "'x' AS node", "2 AS n", "'d' AS digest", "3 AS keep_id", "4 AS rank", "5 AS token", "6 AS size")
        return df

    return make
