"""Helpers that several operators use: null-safe text, bounded batches, tables, names that cannot clash."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.filters import FILTER_WORDS, bit_table, thinned
from ..functions.workspace import dropped, fresh_path, shared_dir, ship, written

__all__ = ["FILTER_WORDS", "ascii_lower", "bit_table", "dropped", "free", "fresh_path", "hidden", "prepare", "shared_dir", "table", "thinned", "whole", "written"]

#: The only letters that lower-casing touches.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def free(name: str, taken: Iterable[str]) -> str:
    """The name, with as many underscores after it as it takes to differ from all others."""
    names = {c.lower() for c in taken}
    while name.lower() in names:
        name += "_"
    return name


def hidden(docs: DataFrame, *read: str) -> tuple[DataFrame, list[Column]]:
    """docs with all columns but the given ones under names that no operator uses, and the columns that bring back the table's own names
    and order."""
    quoted = lambda c: F.col(f"`{c.replace('`', '``')}`")
    inner = {c: c if c in read else f"extra column {k}" for k, c in enumerate(docs.columns)}
    return docs.select(*(quoted(c).alias(inner[c]) for c in docs.columns)), [quoted(inner[c]).alias(c) for c in docs.columns]


def prepare(spark: SparkSession) -> None:
    """For queries with Python in their tasks: gives the package to the executors, and bounds what a worker holds at once."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
