"""Extension points as plain functions: datasets with their normalizers, and derived tables with their inputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..operators.master import discontinuities, instrument_master
from ..schemas import BARS
from ..sources.prices import normalize_indices, normalize_primary

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Dataset:
    """What is stored under a key, how raw rows become it, and how many rows a day may have."""

    key: str
    schema: T.StructType
    normalize: Transform
    rows_per_day: tuple[int, int]
    keys: tuple[str, ...] = ("date", "instrument_key")


@dataclass
class Registry:
    datasets: dict[str, Dataset] = field(default_factory=dict)
    derived: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = field(default_factory=dict)

    def dataset(self, d: Dataset) -> None:
        self.datasets[d.key] = d

    def derive(self, name: str, inputs: tuple[str, ...], build: Callable[..., DataFrame]) -> None:
        self.derived[name] = (inputs, build)

    def build(self, name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
        """A derived table; inputs that are derived themselves are built first."""
        inputs, build = self.derived[name]
        return build(*(tables[i] if i in tables else self.build(i, tables) for i in inputs))


def default_registry() -> Registry:
    r = Registry()
    r.dataset(Dataset("equity_bars", BARS, normalize_primary, (2000, 10000)))
    r.dataset(Dataset("index_bars", BARS, normalize_indices, (50, 500)))
    r.derive("instruments", ("equity_bars",), instrument_master)
    r.derive("ca_flags", ("equity_bars",), discontinuities)
    return r
