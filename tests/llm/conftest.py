from __future__ import annotations

import zlib

import pytest
from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text[, lang[, source]])."""
        full = []
        for r in rows:
            r = (*r, *(None,) * (4 - len(r)))
            full.append((*r, len(r[1]) if r[1] is not None else None))
        return spark.createDataFrame(full, DOC_SCHEMA)
    return make


def crc(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod
