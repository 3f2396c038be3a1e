"""Counts taken while a job runs, and whether they add up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """df and an observation of it: the metrics (by default the number of rows) are known once an action has run, without a pass of their own."""
    watch = Observation(name)
    made = metrics or {"rows": F.count(F.lit(1))}
    return df.observe(watch, *(c.alias(n) for n, c in made.items())), watch


@dataclass(frozen=True)
class Stage:
    """What a stage read, gave on and left out."""

    name: str
    read: int
    emitted: int
    excluded: int = 0
    declared: int | None = None

    @property
    def ok(self) -> bool:
        return self.read == self.emitted + self.excluded and (self.declared is None or self.declared == self.read)


def reconcile_stages(stages: list[Stage]) -> list[str]:
    """What doesn't add up: within a stage, and from one to the next, which must read what the one before gave on."""
    out = [f"{s.name}: read {s.read}, gave on {s.emitted}, left out {s.excluded}, declared {s.declared}" for s in stages if not s.ok]
    return out + [f"{b.name} read {b.read} of {a.emitted} that {a.name} gave on" for a, b in zip(stages, stages[1:], strict=False) if a.emitted != b.read]
