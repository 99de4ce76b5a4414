"""Datasets, their layers and dependencies, and a runner."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..sources.snapshots import overwrite

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Dataset:
    """name, layer, key columns, partition columns, the datasets it is made of, and how: make(spark, inputs) -> DataFrame."""

    name: str
    layer: str
    keys: tuple[str, ...]
    make: Callable[[SparkSession, dict[str, DataFrame]], DataFrame]
    needs: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ()


@dataclass
class Registry:
    datasets: dict[str, Dataset] = field(default_factory=dict)

    def add(self, d: Dataset) -> None:
        if d.layer not in LAYERS:
            raise ValueError(f"{d.name}: no layer {d.layer}")
        if d.name in self.datasets:
            raise ValueError(f"{d.name} is there already")
        for n in d.needs:
            if n not in self.datasets:
                raise ValueError(f"{d.name} needs {n}, which is not there")
            if LAYERS.index(self.datasets[n].layer) > LAYERS.index(d.layer):
                raise ValueError(f"{d.name} ({d.layer}) needs {n} of a later layer")
        self.datasets[d.name] = d

    def order(self, wanted: list[str]) -> list[str]:
        """The wanted datasets and all they need, each after what it needs."""
        out: list[str] = []

        def visit(name: str) -> None:
            if name not in out:
                for n in self.datasets[name].needs:
                    visit(n)
                out.append(name)

        for name in wanted:
            visit(name)
        return out

    def run(self, spark: SparkSession, root: str, wanted: list[str]) -> dict[str, DataFrame]:
        """Make, write and read back each dataset in turn, so that every one starts from written rows."""
        made: dict[str, DataFrame] = {}
        for name in self.order(wanted):
            d = self.datasets[name]
            path = f"{root.rstrip('/')}/{d.layer}/{name}"
            overwrite(d.make(spark, {n: made[n] for n in d.needs}), path, d.partitions)
            made[name] = spark.read.parquet(path)
        return made
