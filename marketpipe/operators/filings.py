"""Filing discovery: which documents to take, what is pending, what became of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import keep_first


def pick_documents(refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chosen, pending) of refs (filing_key, basis, locator, broadcast, seq): per filing the newest consolidated document with a
    locator, else the newest standalone one, else the first with any; filings without a locator are pending, by their first ref."""
    has = F.col("locator").isNotNull()
    rank = F.when(has & (F.col("basis") == "consolidated"), 0).when(has & (F.col("basis") == "standalone"), 1).when(has, 2).otherwise(3)
    newest = F.when(rank < 2, F.col("broadcast")).desc_nulls_last()
    w = Window.partitionBy("filing_key").orderBy(rank, newest, "seq")
    best = refs.withColumn("_rank", rank).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return best.filter("_rank < 3").drop("_rank"), best.filter("_rank = 3").drop("_rank")


def without_repeats(chosen: DataFrame) -> DataFrame:
    """The first filing, in order of its key, for each locator."""
    return keep_first(chosen, ["locator"], ["filing_key"])


def unprocessed(chosen: DataFrame, processed: DataFrame, key: str = "dedup_key") -> DataFrame:
    return chosen.join(processed.select(key).distinct(), key, "left_anti")


def covered_only(refs: DataFrame, covered: DataFrame, key: str = "instrument_key") -> DataFrame:
    return refs.join(covered.select(key).distinct(), key, "left_semi")


def resolve_codes(refs: DataFrame, listing: DataFrame, code: str = "scrip_code") -> DataFrame:
    """refs with instrument_key by native code; null on a miss."""
    names = keep_first(listing.filter(F.col(code).isNotNull()), [code], ["instrument_key"]).select(code, "instrument_key")
    return refs.join(names, code, "left")


def in_era(refs: DataFrame, floor: str, day: str = "broadcast") -> DataFrame:
    """Refs from the floor on; a blank date counts as in the era."""
    return refs.filter(F.col(day).isNull() | (F.col(day) >= F.lit(floor).cast("date")))


def sector_of_file(name: str = "locator") -> Column:
    """Sector by the prefix after INTEGRATED_FILING_; other prefixes (governance among them) give null."""
    rest = F.regexp_extract(name, r"INTEGRATED_FILING_(.*)$", 1)
    return F.when(rest.startswith("NBFC_INDAS"), "nbfc").when(rest.startswith("BANKING"), "bank").when(rest.startswith("LI_") | rest.startswith("GI_"), "insurance").when(rest.startswith("INDAS"), "general")


def latest_revisions(refs: DataFrame, keys: tuple[str, ...] = ("issuer", "period_end", "basis")) -> DataFrame:
    """The highest sequence of each (period, basis)."""
    return refs.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("seq").desc()))).filter("_n = 1").drop("_n")


def consolidated_first(refs: DataFrame) -> DataFrame:
    """One ref per period: the consolidated one where there is one."""
    w = Window.partitionBy("issuer", "period_end").orderBy(F.when(F.col("basis") == "consolidated", 0).otherwise(1), F.col("seq").desc())
    return refs.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def newest_periods(refs: DataFrame, n: int, march_only: bool = False) -> DataFrame:
    """The n newest periods of each issuer, or its n newest March ones."""
    rows = refs.filter(F.month("period_end") == 3) if march_only else refs
    return rows.withColumn("_n", F.dense_rank().over(Window.partitionBy("issuer").orderBy(F.col("period_end").desc()))).filter(F.col("_n") <= n).drop("_n")


def outcome() -> Column:
    """What became of a filing with columns locator, parse_error, identity, sector_kind, blocks."""
    return (
        F.when(F.col("locator").isNull(), "unavailable").when(F.col("parse_error"), "parse_error").when(F.col("identity") == "rejected", "identity_mismatch")
        .when(F.col("sector_kind").isNull(), "unclassified").when(F.col("blocks") != "", "gate_blocked").otherwise("published")
    )


def last_published(rows: DataFrame) -> DataFrame:
    """(issuer, last_period_end, last_basis, n_published): the newest period of each issuer's published filings, with the first basis
    in order of the sequence among those of that period."""
    newest = F.max_by("basis", F.struct("period_end", -F.col("seq")))
    return rows.filter("outcome = 'published'").groupBy("issuer").agg(F.max("period_end").alias("last_period_end"), newest.alias("last_basis"), F.count(F.lit(1)).alias("n_published"))


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Filings by outcome and sector, with the flagged among them."""
    return outcomes.groupBy("outcome", F.coalesce("sector_kind", F.lit("none")).alias("sector")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("flags") != "").alias("flagged"))


def migrated_state(processed: DataFrame, published: DataFrame, drop_outcome: str | None = None) -> DataFrame:
    """Processed marks of instruments that have published rows, without those of one outcome class."""
    kept = processed.join(published.select("instrument_key").distinct(), "instrument_key", "left_semi")
    return kept if drop_outcome is None else kept.filter(~F.col("outcome").eqNullSafe(F.lit(drop_outcome)))
