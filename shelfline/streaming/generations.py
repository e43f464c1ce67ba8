"""States of a store, published one after another.

Whatever a generation changes is written aside, under its own number; then one
small file with that number says which parts make up the state. Readers take the
highest such file, so they see a whole state, the old or the new one, and a
failure before that file leaves the old one. Parts that neither the newest nor
the state before it names are removed: a reader of the state before is not
disturbed. Two writers cannot publish the same number: the second fails.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

from shelfline.sources import files


@dataclass(frozen=True)
class State:
    """``weeks`` maps a week to the generation that built it.

    ``index`` and ``ledger`` name the generations that wrote them, ``entries`` is the
    number of index rows, and ``dropped`` whether rows of the state before no longer
    count. ``calendar`` is a digest of the calendar that the weeks were built with, and
    ``days`` has one of each week's days.
    """

    generation: int = -1
    weeks: dict[int, int] = field(default_factory=dict)
    index: int | None = None
    entries: int = 0
    dropped: bool = False
    ledger: int | None = None
    calendar: str | None = None
    days: dict[int, str] = field(default_factory=dict)

    def next(self, **changes) -> State:
        return replace(self, **{"generation": self.generation + 1, "dropped": False, **changes})


def _folder(root: str) -> str:
    return f"{root}/published"


def _read(spark: SparkSession, root: str, name: str) -> State:
    found = json.loads(files.read_text(spark, f"{_folder(root)}/{name}"))
    return State(**{**found, **{k: {int(w): v for w, v in found.get(k, {}).items()} for k in ("weeks", "days")}})


def published(spark: SparkSession, root: str) -> list[State]:
    """The states whose parts are kept: the newest one last; none before the first."""
    return [_read(spark, root, name) for name in files.children(spark, _folder(root))]


def newest(spark: SparkSession, root: str) -> State:
    names = files.children(spark, _folder(root))
    return _read(spark, root, names[-1]) if names else State()


def publish(spark: SparkSession, root: str, state: State) -> list[State]:
    """Make the state the newest; returns the older ones that are no longer kept."""
    path = f"{_folder(root)}/{state.generation:012d}.json"
    files.write_text(spark, path, json.dumps(asdict(state)))
    return published(spark, root)[:-2]


def forget(spark: SparkSession, root: str, state: State) -> None:
    files.remove(spark, f"{_folder(root)}/{state.generation:012d}.json")
