import json
import os
import sys

import pytest

from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture()
def frame(spark):
    """Rows to a DataFrame with the columns of documents (or any DDL)."""
    def make(rows, ddl="doc_id long, text string, lang string, source string, n_chars long"):
        schema = T._parse_datatype_string(ddl)
        width = len(schema)
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)
    return make


@pytest.fixture()
def same_rows():
    def check(a, b):
        key = lambda r: json.dumps(r, sort_keys=True, default=str)
        assert sorted(map(key, a)) == sorted(map(key, b))
    return check
