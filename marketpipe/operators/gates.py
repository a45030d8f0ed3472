"""Gates that a batch passes before it is stored. Each gives a table of verdicts; callers decide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import holds
from ..schemas import BARS

PRICES = ("open", "high", "low", "close", "prevclose")


def known(c: str) -> F.Column:
    """A double that is neither null nor NaN."""
    return F.col(c).isNotNull() & ~F.isnan(c)


def sound() -> F.Column:
    """Whether a bar's prices, volume and key make sense; null and NaN do not."""
    prices = F.lit(True)
    for c in PRICES:
        prices = prices & known(c) & (F.col(c) > 0)
    return holds(prices & (F.col("volume") >= 0) & (F.col("high") >= F.col("low")) & (F.col("low") <= F.col("close")) & (F.col("close") <= F.col("high")) & (F.col("instrument_key") != ""))


def tagged(bars: DataFrame, name: str = "ok") -> DataFrame:
    """bars with a column that says whether each is sound."""
    return bars.withColumn(name, sound())


def quarantine(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, bad): exact complements. Each reads bars anew; where both are needed, persist tagged() and filter it."""
    marked = tagged(bars, "_ok")
    return marked.filter("_ok").drop("_ok"), marked.filter("not _ok").drop("_ok")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Sorted names of absent columns; callers fail on any."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    if missing := missing_columns(df, required):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def contract(df: DataFrame, schema: T.StructType = BARS) -> DataFrame:
    """(rule, violations): extra and absent columns, types, nulls where none may be, negative numbers."""
    have = {f.name: f.dataType for f in df.schema}
    fixed = [(f"extra:{c}", 1) for c in sorted(set(have) - set(schema.names))] + [(f"absent:{c}", 1) for c in sorted(set(schema.names) - set(have))]
    fixed += [(f"type:{f.name}", 1) for f in schema if f.name in have and have[f.name] != f.dataType]
    rules = {f"null:{f.name}": F.col(f.name).isNull() for f in schema if f.name in have and not f.nullable}
    numbers = (T.DoubleType, T.LongType, T.IntegerType)
    rules |= {f"negative:{f.name}": F.col(f.name) < 0 for f in schema if f.name in have and isinstance(f.dataType, numbers)}
    counted = df.agg(*(F.count_if(holds(rule)).alias(name) for name, rule in rules.items()))
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules), *(F.struct(F.lit(n).alias("rule"), F.lit(v).cast("bigint").alias("violations")) for n, v in fixed)))
    return counted.select(pairs.alias("p")).select("p.*")


def breaks_contract(schema: T.StructType = BARS) -> F.Column:
    """Whether a row of the schema's columns has a null where none may be, or a negative number."""
    bad = F.lit(False)
    for f in schema:
        if not f.nullable:
            bad = bad | F.col(f.name).isNull()
        if isinstance(f.dataType, (T.DoubleType, T.LongType, T.IntegerType)):
            bad = bad | holds(F.col(f.name) < 0)
    return bad


def wrong_dates(df: DataFrame, target: str, show: int = 3, day: str = "date") -> DataFrame:
    """(wrong_rows, sample, rejected): any row of another day rejects the whole batch; an empty batch passes."""
    odd = ~F.col(day).eqNullSafe(F.lit(target).cast("date"))
    days = F.slice(F.array_sort(F.collect_set(F.when(odd, F.coalesce(F.col(day).cast("string"), F.lit("none"))))), 1, show)
    return df.agg(F.count_if(odd).alias("wrong_rows"), F.concat_ws(";", days).alias("sample")).withColumn("rejected", F.col("wrong_rows") > 0)


def all_bad(bars: DataFrame) -> DataFrame:
    """(n_rows, n_clean, failed): rows came, none is sound."""
    return bars.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(sound()).alias("n_clean")).withColumn("failed", (F.col("n_rows") > 0) & (F.col("n_clean") == 0))


def row_count_gate(df: DataFrame, lo: int, hi: int, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("passed", F.col("n_rows").between(lo, hi))


def series_counts(df: DataFrame) -> DataFrame:
    return df.filter(F.col("series").isNotNull()).groupBy("date", "series").agg(F.count(F.lit(1)).alias("n"))


def trailing_means(counts: DataFrame, calendar: DataFrame, days: int = 10) -> DataFrame:
    """(date, series, mean): for each calendar trading day, each series' mean count over the days trading days before it.

    Days without the series do not count. As equi joins: every counted day is dealt to the days that look back on it.
    """
    trading = calendar.filter("is_trading").select("date", "ordinal")
    seen = counts.join(trading, "date").select("series", "n", F.explode(F.sequence(F.col("ordinal") + 1, F.col("ordinal") + days)).alias("ordinal"))
    return seen.groupBy("ordinal", "series").agg(F.avg("n").alias("mean")).join(trading, "ordinal").select("date", "series", "mean")


def series_deviation_gate(counts: DataFrame, means: DataFrame, floor: float = 50, large: float = 1000, band: float = 0.50, tight: float = 0.15) -> DataFrame:
    """(date, series, n, mean, verdict) of every day that has counts: exempt below the floor, absent, deviates, no_history, ok."""
    days = counts.select("date").distinct()
    both = counts.join(means.join(days, "date", "left_semi"), ["date", "series"], "full_outer")
    n, mean = F.coalesce("n", F.lit(0)), F.col("mean")
    off = F.abs(n - mean) / mean
    verdict = F.when(mean.isNull(), "no_history").when(mean < floor, "exempt").when(n == 0, "absent").when(off > F.when(mean >= large, tight).otherwise(band), "deviates").otherwise("ok")
    return both.select("date", "series", n.cast("bigint").alias("n"), mean, verdict.alias("verdict"))


def completeness(counts: DataFrame, means: DataFrame, share: float = 0.85) -> DataFrame:
    """(date, stored, expected, complete): over the series present on both sides only; no shared history is complete."""
    shared = counts.join(means, ["date", "series"]).groupBy("date").agg(F.sum("n").alias("stored"), F.sum("mean").alias("expected"))
    out = counts.select("date").distinct().join(shared, "date", "left")
    return out.select("date", F.coalesce("stored", F.lit(0)).alias("stored"), F.coalesce("expected", F.lit(0.0)).alias("expected"), F.coalesce(F.col("stored") >= share * F.col("expected"), F.lit(True)).alias("complete"))


def day_status(days: DataFrame, target: str | None = None) -> DataFrame:
    """Status of each day of (date, is_trading, present, complete, rows, failed_gate): what a daily run ends with. Without rows a day
    is not yet there; with a target day given, only that one is, and all others have failed."""
    late = F.lit(True) if target is None else F.col("date") == F.lit(target).cast("date")
    status = (
        F.when(~F.col("is_trading"), "holiday").when(F.col("present") & F.col("complete"), "idempotent").when(F.col("rows") == 0, F.when(late, "not_yet").otherwise("failed"))
        .when(F.col("failed_gate"), "failed").when(F.col("present"), "success_topped_up").otherwise("success")
    )
    return days.withColumn("status", status)


def source_canaries(sizes: DataFrame, least: dict[str, int]) -> DataFrame:
    """(source, n, ok): whether each source delivered at least its least number of rows."""
    need = F.create_map(*(F.lit(x) for pair in least.items() for x in pair))
    return sizes.withColumn("ok", F.col("n") >= F.coalesce(need[F.col("source")], F.lit(0)))


def systemic_failure(selected: str = "selected", failures: str = "failures") -> F.Column:
    return (F.col(selected) > 0) & (F.col(failures) >= F.col(selected))


def absence_intervals(presence: DataFrame, snapshots: DataFrame, key: str) -> DataFrame:
    """(key, place, until): from each presence of a key to its next one or to the end of the history, by the places of the valid snapshots
    in their order. At place p of an interval the key has been absent p - place times. Only presences are sorted and compared."""
    # a row per valid snapshot
    order = snapshots.select("snapshot").distinct().withColumn("place", F.row_number().over(Window.orderBy("snapshot")))
    end = order.agg((F.coalesce(F.max("place"), F.lit(0)) + 1).alias("_end"))
    seen = presence.select(key, "snapshot").distinct().join(F.broadcast(order), "snapshot").crossJoin(F.broadcast(end))  # one row
    until = F.coalesce(F.lead("place").over(Window.partitionBy(key).orderBy("place")), F.col("_end"))
    return seen.select(key, "place", until.alias("until"))


def absences(presence: DataFrame, snapshots: DataFrame, key: str, inactive_at: int = 2) -> DataFrame:
    """(key, snapshot, absences, inactive) over a history of valid snapshots (snapshot is its ordinal): absences in a row since the
    key was last present; before its first presence a key has none. The intervals, spread over their snapshots."""
    order = snapshots.select("snapshot").distinct().withColumn("p", F.row_number().over(Window.orderBy("snapshot")))
    spread = absence_intervals(presence, snapshots, key).select(key, "place", F.explode(F.sequence("place", F.col("until") - 1)).alias("p"))
    n = (F.col("p") - F.col("place")).cast("bigint")
    return spread.join(F.broadcast(order), "p").select(key, "snapshot", n.alias("absences"), (n >= inactive_at).alias("inactive"))


def absent_now(presence: DataFrame, snapshots: DataFrame, key: str, inactive_at: int = 2) -> DataFrame:
    """(key, absences, inactive) after the last valid snapshot: one row per key, nothing spread."""
    last = absence_intervals(presence, snapshots, key).groupBy(key).agg(F.max("place").alias("place"), F.max("until").alias("until"))
    n = (F.col("until") - 1 - F.col("place")).cast("bigint")
    return last.select(key, n.alias("absences"), (n >= inactive_at).alias("inactive"))
