"""Where a job may put its own files."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def work_path(spark: SparkSession, label: str) -> str:
    """A new path for this run, in the shared folder the session names.

    The folder is ``spark.checkpoint.dir``, or the warehouse where that is unset:
    both are shared by all executors.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/shelfline-{uuid.uuid4().hex}/{label}"
