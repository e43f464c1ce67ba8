"""Small frames from values of the driver."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType


def small_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """The rows as values in the plan itself, so that no task has to bring them."""
    fields = StructType.fromDDL(schema).fields
    # A timestamp without a zone is in the driver's.
    plain = [[v.astimezone() if isinstance(v, datetime) else v for v in row] for row in rows]
    arrays = [
        pa.array([row[i] for row in plain], to_arrow_type(f.dataType, timestamp_utc=True))
        for i, f in enumerate(fields)
    ]
    return spark.createDataFrame(pa.table(arrays, names=[f.name for f in fields]), schema)
