"""Running independent Spark actions side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

Result = TypeVar("Result")


def together(actions: Sequence[Callable[[], Result]]) -> list[Result]:
    """Submit every action from a thread of its own and return their results in order.

    Spark runs their tasks as executors come free, so small writes do not wait
    behind the last tasks of a large one.
    """
    with ThreadPoolExecutor(len(actions)) as pool:
        return [running.result() for running in [pool.submit(a) for a in actions]]
