"""A small runner for stages that depend on each other's datasets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from loomwork.core.artifacts import exists, publish


@dataclass
class Stage:
    name: str
    build: Callable[..., DataFrame]
    inputs: list[str] = field(default_factory=list)


@dataclass
class Runner:
    """Runs stages in dependency order; a dataset that is there is not built again.

    ``skip`` drops stages and, with them, every stage that needs one of them.
    """

    spark: SparkSession
    root: str
    stages: list[Stage]

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def order(self, skip: set[str] = frozenset()) -> list[Stage]:
        by_name, out, dropped = {s.name: s for s in self.stages}, [], set(skip)
        waiting = [s for s in self.stages if s.name not in dropped]
        while waiting:
            ready = [s for s in waiting if all(i not in by_name or any(o.name == i for o in out) for i in s.inputs)]
            lost = [s for s in waiting if any(i in dropped for i in s.inputs)]
            if lost:
                dropped |= {s.name for s in lost}
                waiting = [s for s in waiting if s not in lost]
                continue
            if not ready:
                raise ValueError("stages depend on each other in a circle: " + ", ".join(s.name for s in waiting))
            out.append(ready[0])
            waiting.remove(ready[0])
        return out

    def run(self, skip: set[str] = frozenset(), force: set[str] = frozenset()) -> list[str]:
        """Names of the stages that were built."""
        built: list[str] = []
        for stage in self.order(skip):
            target = self.path(stage.name)
            fresh = exists(self.spark, f"{target}/_SUCCESS") and stage.name not in force and not set(stage.inputs) & set(built)
            if not fresh:
                publish(stage.build(self.spark, *[self.spark.read.parquet(self.path(i)) for i in stage.inputs]), target)
                built.append(stage.name)
        return built
