
import pytest


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHING = ("size", "key", "spans", "region", "group", "distance", "text_key", "part", "nth", "score")


@pytest.fixture(scope="session")
def docs(spark):
    """A frame of documents from (doc_id, text, lang, source) rows."""
    def build(rows, clash=False):
        frame = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
        if clash:
            from pyspark.sql import functions as F

            frame = frame.withColumns({c: F.lit("x") for c in CLASHING})
        return frame

    return build
