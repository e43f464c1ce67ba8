"""The job argument: a JSON object from table name to path below the input root."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.schemas import FEEDS

# The published tables.
OUTPUT_TABLES = {
    "weekly": "weekly_agg_table",
    "calendar": "calendar_table",
    "store": "store_table",
    "product": "prod_table",
}


@dataclass(frozen=True)
class JobPaths:
    """Input path of every feed and output path of every table."""

    inputs: dict[str, str]
    weekly: str
    calendar: str
    store: str
    product: str

    @classmethod
    def from_json(cls, manifest: str, input_root: str, output_root: str) -> JobPaths:
        """Resolve a manifest; ``ValueError`` names the tables it lacks."""
        paths = json.loads(manifest)
        # The trigger sends the mapping inside a "conf" object.
        paths = paths.get("conf", paths)
        lacking = [t for t in FEEDS if t not in paths]
        if lacking:
            raise ValueError(f"manifest has no path for: {', '.join(lacking)}")
        outputs = {role: output_root + name for role, name in OUTPUT_TABLES.items()}
        return cls(inputs={t: input_root + paths[t] for t in FEEDS}, **outputs)


def manifest_paths(manifests: DataFrame, root: str) -> DataFrame:
    """Decode a frame of manifests into one row per run date and table."""
    entries = F.from_json("manifest", "map<string,string>")
    return manifests.select("run_date", F.explode(entries).alias("table_name", "entry")).select(
        "run_date", "table_name", F.concat(F.lit(root), "entry").alias("path")
    )


def output_paths(manifests: DataFrame, root: str) -> DataFrame:
    """One row per run date and published table, with the path below ``root``."""
    names = F.create_map(*[F.lit(x) for pair in OUTPUT_TABLES.items() for x in pair])
    return manifests.select("run_date", F.explode(names).alias("role", "table_name")).select(
        "run_date", "role", "table_name", F.concat(F.lit(root), "table_name").alias("path")
    )
