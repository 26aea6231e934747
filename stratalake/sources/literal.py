"""Small in-code dimensions."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

LITERAL_DIMENSION_LIMIT = 100_000


def literal_dim(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A dimension written in code.

    Going through Arrow gives Spark a local relation of known size, so the
    planner broadcasts it on its own size check. Longer lists belong in a table.
    """
    if len(rows) > LITERAL_DIMENSION_LIMIT:
        raise ValueError(f"{len(rows)} literal rows; store them as a table instead")
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    columns = list(zip(*rows, strict=True)) if rows else [() for _ in schema.fields]
    arrow_schema = to_arrow_schema(schema)
    arrays = [pa.array(list(values), type=field.type) for values, field in zip(columns, arrow_schema, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow_schema), schema=schema)
