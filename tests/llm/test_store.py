"""Intermediate tables go with the driver that made them."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from shelfline.llm.store import stored

builder = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {folder!r})
spark = builder.config("spark.sql.warehouse.dir", {folder!r} + "/warehouse").getOrCreate()
first = stored(spark.range(5))
second = stored(first.selectExpr("id + 1 AS id"))
assert second.count() == 5
import pathlib
assert len(list(pathlib.Path({folder!r}).glob("llm-*/*"))) == 2
if {stop}:
    spark.stop()
"""


@pytest.mark.parametrize("stop", [True, False])
def test_nothing_is_left_when_the_driver_ends(tmp_path, stop):
    script = SCRIPT.format(root=str(ROOT), folder=str(tmp_path), stop=stop)
    subprocess.run([sys.executable, "-c", script], check=True, timeout=120, capture_output=True)
    assert not list(tmp_path.glob("llm-*"))
