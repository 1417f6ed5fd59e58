"""Counts of what the steps did, taken while their rows pass: no pass of its own, and nothing is printed row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation


class Metrics:
    """Named counts of one run. They are there once an action has run over the watched rows; the first one counts."""

    def __init__(self):
        self._watched: dict[str, Observation] = {}

    def watch(self, rows: DataFrame, step: str, **counts: Column) -> DataFrame:
        """``rows``, unchanged; ``counts`` are aggregates over them. A step is watched once."""
        if step in self._watched:
            raise ValueError(f"{step} is watched already")
        self._watched[step] = Observation()
        return rows.observe(self._watched[step], *(c.alias(name) for name, c in counts.items()))

    def values(self) -> dict[str, dict[str, int]]:
        """By step its counts. Waits for the action where none has run yet."""
        return {step: dict(seen.get) for step, seen in self._watched.items()}
