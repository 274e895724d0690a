import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from samples import CLASHES, DOCS, ODD  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table of (id, text) or (id, text, lang, source) rows, with extra columns if asked for."""
    from chondria.llm.common import importable
    importable(spark)

    def make(rows, extra=False):
        from pyspark.sql import functions as F
        full = [(r[0], r[1], *(r[2:] or ("en", "a")), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.select("*", *[F.lit("x").alias(c) for c in CLASHES]) if extra else df
    return make


@pytest.fixture(scope="session")
def odd():
    return ODD
