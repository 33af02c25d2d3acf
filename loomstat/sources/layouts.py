"""Tables whose columns change over time: layouts with a version, and upgrades that keep all rows.

A layout lies in a folder of its own. An upgrade reads the newest one, whatever columns its files
have, applies the steps it lacks one after the other, and writes the next folder whole; only then
the log of layouts names it. A step that fails, or that loses or makes rows, leaves the table at
the layout it had.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import Audit
from .store import LogStore

LAYOUTS = "name string, layout int, seq long"
Step = Callable[[DataFrame], DataFrame]


class LayoutError(RuntimeError):
    """An upgrade would have changed the number of rows."""


class VersionedTable:
    """One table under ``root``; ``steps[k]`` makes layout k + 2 of layout k + 1."""

    def __init__(self, spark: SparkSession, root: str, name: str, steps: Sequence[Step] = ()) -> None:
        self.store, self.name, self.steps = LogStore(spark, root), name, tuple(steps)

    def _log(self) -> str:
        return f"{self.name}_layouts"

    def path(self, layout: int) -> str:
        return self.store.path(f"{self.name}/layout-{layout}")

    def layout(self) -> int:
        """The layout that counts; 1 before any is named."""
        found = self.store.read(self._log(), LAYOUTS).filter(F.col("name") == self.name).agg(F.max("layout")).first()[0]
        return found or 1

    def append(self, rows: DataFrame) -> None:
        """Add rows as they come; columns that other files lack are fine."""
        rows.write.mode("append").parquet(self.path(self.layout()))

    def read(self) -> DataFrame:
        """All rows, with the columns of all files; null where a file lacks one."""
        return self.store.spark.read.option("mergeSchema", "true").parquet(self.path(self.layout()))

    def upgrade(self) -> dict[int, int]:
        """Bring the table to the newest layout; returns the rows of each step. Repeating it does nothing."""
        done = {}
        for layout in range(self.layout() + 1, len(self.steps) + 2):
            audit = Audit()
            rows = audit.on(self.read(), before=F.count("*"))
            made = audit.on(self.steps[layout - 2](rows), after=F.count("*"))
            made.write.mode("overwrite").parquet(self.path(layout))
            seen = {name: n or 0 for name, n in audit.counts().items()}
            if seen["before"] != seen["after"]:
                raise LayoutError(f"layout {layout} of {self.name} would have {seen['after']} rows, not {seen['before']}")
            self.store.append(self._log(), self.store.spark.createDataFrame([(self.name, layout, layout)], LAYOUTS))
            done[layout] = seen["after"]
        return done


def with_columns(**columns: object) -> Step:
    """A step that adds columns with a value for the rows that are there; a column that some files have keeps its values."""

    def step(rows: DataFrame) -> DataFrame:
        return rows.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in rows.columns else F.lit(v) for c, v in columns.items()})

    return step


def renamed(**names: str) -> Step:
    """A step that renames columns, old=new."""
    return lambda rows: rows.withColumnsRenamed(names)
