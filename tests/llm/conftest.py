from __future__ import annotations

import pytest
from pyspark.sql import types as T


@pytest.fixture
def table(spark):
    """Rows as a DataFrame of a declared schema, over a few partitions."""

    def make(rows: list[tuple], schema: str):
        return spark.createDataFrame(rows, schema).repartition(3) if rows else spark.createDataFrame([], T._parse_datatype_string(schema))

    return make
