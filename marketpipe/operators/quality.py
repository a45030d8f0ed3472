"""Comparison of two versions of a table by their partition statistics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def no_shrink(live: DataFrame, new: DataFrame, owned: Iterable[str], allow_shrink: bool = False) -> DataFrame:
    """(dataset, year, verdict) for each partition of the live owned datasets: missing_dataset, missing_partition, fewer_rows,
    date_regression, ok. allow_shrink passes lower row counts only."""
    sets = new.select("dataset").distinct().withColumn("_there", F.lit(True))
    mine = live.filter(F.col("dataset").isin(list(owned)))
    both = mine.join(new.select("dataset", "year", F.col("n_rows").alias("new_rows"), F.col("max_date").alias("new_date")), ["dataset", "year"], "left").join(sets, "dataset", "left")
    verdict = (
        F.when(F.col("_there").isNull(), "missing_dataset").when(F.col("new_rows").isNull(), "missing_partition").when(F.lit(not allow_shrink) & (F.col("new_rows") < F.col("n_rows")), "fewer_rows")
        .when(F.col("new_date") < F.col("max_date"), "date_regression").otherwise("ok")
    )
    return both.select("dataset", "year", "n_rows", "new_rows", verdict.alias("verdict"))
