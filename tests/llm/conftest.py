import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang[, source]]) tuples; extra columns have names that operators use, too."""
    from pyspark.sql import functions as F

    from starloom.llm.common import workers_import
    workers_import(spark)

    def make(rows, clash=False):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        if clash:
            df = df.withColumns({n: F.lit("x") for n in (
                "size", "score", "predicted", "n", "a", "bands", "key", "band", "component", "rep", "host", "mix_copy", "row", "bucket",
                "target", "kept", "cosine", "item_id", "kind", "words", "x0", "pool", "n_words", "c", "shuffled")})
        return df
    return make
