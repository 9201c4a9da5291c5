import sys
from pathlib import Path

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """A documents table of (doc_id, text) pairs, with the usual and some clashing extra columns."""
    names = ("lang", "source", "word", "fp", "key", "i", "block")
    schema = StructType(
        [StructField("doc_id", LongType()), StructField("text", StringType())]
        + [StructField(n, StringType()) for n in names]
        + [StructField("n_chars", LongType())]
    )

    def make(*pairs):
        rows = [(i, t, "en", "src", "x", "x", "x", "x", "x", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, schema)

    return make
