"""Passes that measure themselves: when a job began and ended, and counters observed while its rows went by."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation

Result = TypeVar("Result")


def observed(rows: DataFrame, metrics: Mapping[str, Column], action: Callable[[DataFrame], Result]) -> tuple[Result, dict[str, object]]:
    """Runs ``action`` on ``rows`` and returns what it gave, with the metrics of the rows that passed.

    ``action`` has to run exactly one job over all rows, such as a write. The metrics are taken at the end of the plan, in
    the tasks that write: those are counted once each, also when executors are lost and tasks run again.
    """
    if not metrics:
        return action(rows), {}
    watch = Observation()
    done = action(rows.observe(watch, *[value.alias(name) for name, value in metrics.items()]))
    return done, dict(watch.get)


@dataclass(frozen=True)
class Pass:
    """A finished job: what it gave, how long it took and what it counted."""

    result: DataFrame
    elapsed_ms: int
    metrics: dict[str, object]


def timed(make: Callable[[], DataFrame], store: Callable[[DataFrame], DataFrame], metrics: Mapping[str, Column]) -> Pass:
    """Builds a result and stores it. The time covers both, as building may run jobs of its own."""
    begun = time.monotonic()
    stored, counted = observed(make(), metrics, store)
    return Pass(stored, max(1, round((time.monotonic() - begun) * 1000)), counted)
