import pytest
from pyspark.sql import functions as F


@pytest.fixture
def docs(spark):
    """Documents with odd rows: null and empty texts, repeats, a clashing extra column."""

    def make(texts, **more):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        for name, value in more.items():
            df = df.withColumn(name, F.lit(value))
        return df

    return make
