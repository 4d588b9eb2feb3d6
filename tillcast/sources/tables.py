"""Table scans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def date_slice(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows with start <= column < end. Bounds are cast to the column's own type, never the
    column to the bounds' type, so the predicate reaches the Parquet scan."""
    kind = df.schema[column].dataType
    low, high = (F.lit(b.isoformat() if isinstance(b, dt.date) else b).cast(kind) for b in (start, end))
    return df.where((F.col(column) >= low) & (F.col(column) < high))
