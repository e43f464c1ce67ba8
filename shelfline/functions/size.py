"""Measuring a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def csv_bytes(frame: DataFrame) -> int:
    """Size of the frame's rows as CSV text, summed over all tasks."""
    line = F.to_csv(F.struct(*[F.col(c) for c in frame.columns]))
    return frame.agg(F.sum(F.octet_length(line) + 1).alias("bytes")).first()["bytes"] or 0
