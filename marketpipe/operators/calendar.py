"""Trading days: the calendar table, ordinals, holes, freshness."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import is_weekday


def trading_calendar(spark: SparkSession, first: date | str, last: date | str, holidays: DataFrame, sessions: DataFrame) -> DataFrame:
    """(date, is_trading, ordinal, previous): every day from first to last. Weekdays trade unless they are holidays; special
    sessions trade on any day. ordinal counts trading days; previous is the trading day before. One row a day: small by its nature."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))).alias("date"))
    off, on = holidays.select("date").distinct().withColumn("off", F.lit(True)), sessions.select("date").distinct().withColumn("on", F.lit(True))
    marked = days.join(off, "date", "left").join(on, "date", "left")
    trading = F.coalesce("on", F.lit(False)) | (is_weekday("date") & ~F.coalesce("off", F.lit(False)))
    w = Window.orderBy("date")
    marked = marked.select("date", trading.alias("is_trading"))
    return marked.select(
        "date", "is_trading",
        F.when(F.col("is_trading"), F.count_if("is_trading").over(w)).alias("ordinal"),
        F.last(F.when(F.col("is_trading"), F.col("date")), True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("previous"),
    )


def nth_back(calendar: DataFrame, n: int) -> DataFrame:
    """(date, back): the trading day n trading days before each trading day."""
    days = calendar.filter("is_trading").select("date", "ordinal")
    return days.join(days.select((F.col("ordinal") + n).alias("ordinal"), F.col("date").alias("back")), "ordinal", "left").select("date", "back")


def session_ordinals(df: DataFrame, day: str = "date") -> DataFrame:
    """(date, session): the distinct stored dates, numbered. The numbering sees dates only."""
    return df.select(day).distinct().withColumn("session", F.dense_rank().over(Window.orderBy(day)).cast("bigint"))


#: Days in one word of a bit mask.
WORD = 60


def holes(present: DataFrame, expected_days: DataFrame, key: str, window: int | None = None, day: str = "date") -> DataFrame:
    """(key, date): expected days without a row of the key, never before the key's own first day; of the last so many days only.

    A key's days are bit masks over the expected ones, one or-ed word per WORD days, combined within tasks: one shuffle, of a row per key
    and task. The holes are read off the complement. Expected days are calendar days: few enough for the plan."""
    days = sorted((r[0] for r in expected_days.select(day).distinct().collect()), reverse=True)[:window][::-1]
    if not days:
        return present.select(key, day).limit(0)
    places = present.sparkSession.createDataFrame([(d, k) for k, d in enumerate(days)], T.StructType([T.StructField(day, expected_days.schema[day].dataType), T.StructField("_place", T.IntegerType())]))
    words = range(-(-len(days) // WORD))
    bit = lambda w: F.when(F.floor(F.col("_place") / WORD) == w, F.expr(f"shiftleft(1L, _place - {w * WORD})"))
    masks = present.select(key, day).join(F.broadcast(places), day, "left").groupBy(key).agg(F.min(day).alias("_first"), *(F.coalesce(F.bit_or(bit(w)), F.lit(0).cast("bigint")).alias(f"_w{w}") for w in words))
    open_days = [F.expr(f"CASE WHEN (_w{k // WORD} & shiftleft(1L, {k % WORD})) = 0 THEN {k} END") for k in range(len(days))]
    listed = F.array(*(F.lit(d) for d in days))
    left = masks.select(key, "_first", F.explode(F.array_compact(F.array(*open_days))).alias("_place"))
    return left.select(key, "_first", F.element_at(listed, F.col("_place") + 1).alias(day)).filter(F.col(day) >= F.col("_first")).drop("_first")


def freshness(latest: DataFrame, previous_day: str, key: str = "dataset", day: str = "max_date") -> DataFrame:
    """latest with stale: whether its newest day lies before the previous trading day; without any day it is stale."""
    return latest.withColumn("stale", F.coalesce(F.col(day) < F.lit(previous_day).cast("date"), F.lit(True)))


def day_states(present: DataFrame, expected_days: DataFrame, target: str, day: str = "date") -> DataFrame:
    """(date, state): ok where stored; not_yet for a missing target day, failed for a missing past day."""
    have = present.select(day).distinct().withColumn("_have", F.lit(True))
    state = F.when(F.col("_have"), "ok").when(F.col(day) >= F.lit(target).cast("date"), "not_yet").otherwise("failed")
    return expected_days.join(have, day, "left").select(day, state.alias("state"))
