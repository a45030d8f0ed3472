"""Sector frames, index baskets and the gates that accept a new snapshot of them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import plain_label, text_or_empty, tier_or_null
from .master import carry_forward


def cyclical(sector: str, names: Iterable[str]) -> Column:
    """Exact match."""
    return F.coalesce(F.col(sector).isin(list(names)), F.lit(False))


def cyclical_plain(sector: str, names: Iterable[str]) -> Column:
    """Match that ignores case and punctuation; names in plain form (lower-case letters, digits, ampersands)."""
    return F.coalesce(plain_label(sector).isin(list(names)), F.lit(False))


def sector_frame(rows: DataFrame, names: Iterable[str], version: int, as_of: str) -> DataFrame:
    """Sorted sector rows: empty tiers null, cyclical flag, rule version, date."""
    tiers = ("macro_sector", "sector", "industry", "basic_industry")
    out = rows.select("instrument_key", text_or_empty("symbol").alias("symbol"), *(tier_or_null(t).alias(t) for t in tiers))
    return out.withColumns({"is_cyclical": cyclical_plain("sector", names), "cyclicality_rule_version": F.lit(version), "date": F.lit(as_of).cast("date")}).orderBy("instrument_key")


def sector_summary(rows: DataFrame, names: Iterable[str]) -> DataFrame:
    return rows.groupBy("sector").agg(F.count(F.lit(1)).alias("n")).withColumn("is_cyclical", cyclical_plain("sector", names))


def accept_snapshot(current: DataFrame, prior: DataFrame, floor: int, key: str) -> DataFrame:
    """(n, n_prior, n_keys, verdict): empty, duplicate_keys, below_floor, shrunk, accepted; all but the last keep the prior table."""
    a = current.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("n_keys"))
    b = prior.agg(F.count(F.lit(1)).alias("n_prior"))
    verdict = F.when(F.col("n") == 0, "empty").when(F.col("n_keys") < F.col("n"), "duplicate_keys").when(F.col("n") < floor, "below_floor").when(F.col("n") < F.col("n_prior"), "shrunk").otherwise("accepted")
    return a.crossJoin(b).withColumn("verdict", verdict)  # one row each


def baskets(members: DataFrame, file: str = "source_file", least: int = 5) -> DataFrame:
    """Members of the files that have enough of them: 12-letter ISIN, a symbol, each ISIN once per file; other files go whole."""
    good = members.filter((F.length(F.trim("isin")) == 12) & (F.trim("symbol") != "")).dropDuplicates([file, "isin"])
    enough = good.groupBy(file).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).drop("_n")
    return good.join(enough, file, "left_semi")


def basket_sizes(members: DataFrame, key: str = "index_key") -> DataFrame:
    return members.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def merge_baskets(current: DataFrame, prior: DataFrame, key: str = "index_key") -> DataFrame:
    """Current baskets, and prior ones whose index this run has none of."""
    return carry_forward(current, prior, [key])
