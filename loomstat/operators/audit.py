"""Counts that come out of the job that writes, by observed metrics, in place of jobs of their own."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation


class Audit:
    """Named counts of the rows that pass marked places of a plan. Ask for them when the plan has run."""

    def __init__(self) -> None:
        self._seen: list[tuple[list[str], Observation]] = []

    def on(self, rows: DataFrame, **counts: Column) -> DataFrame:
        """``rows``, counted when they pass here. A place that Spark runs twice is counted twice, so mark places that one path uses."""
        seen = Observation()
        self._seen.append((list(counts), seen))
        return rows.observe(seen, *[c.alias(name) for name, c in counts.items()])

    def counts(self) -> dict[str, int | None]:
        """All counts; waits for the job if it hasn't ended.

        None where Spark left a place out, as what it would be joined with has no rows; at the top
        of a plan that means that there are none.
        """
        made: dict[str, int | None] = {}
        for names, seen in self._seen:
            try:
                made |= {name: int(n or 0) for name, n in seen.get.items()}
            except Py4JJavaError as error:
                if "assertion failed" not in str(error.java_exception):  # Spark's answer for a place that didn't run
                    raise
                made |= dict.fromkeys(names)
        return made
