"""Which days enter a store: the gates of a daily run, day after day, over counts.

Whether a day is admitted depends on the days admitted before it, since their counts are the means that it is held against. So the days
of a dataset are folded in order. The fold sees a table of counts (a row per day, series and kind of count), never bars: some dozens of
rows a day, whatever the number of bars, and one group per dataset.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: dataset, day and its ordinal, series (null for counts of whole days), what is counted, how many. Kinds: stored (rows that the store has),
#: raw (rows that came), merged (rows that the store would have with the sound ones); of whole days rows, bad, wrong_date, broken.
TALLIES = "dataset string, date date, ordinal bigint, series string, kind string, n bigint"
ADMITTED = "dataset string, date date, status string, reason string, n_rows bigint, n_quarantined bigint, evidence boolean"


@dataclass(frozen=True)
class Limits:
    """Bounds of the gates: rows of a day, share of the expected rows that makes a stored day complete, days that the means look back on;
    series with a mean below floor are exempt, those of large ones or more may deviate by tight, others by band."""

    least: int = 2000
    most: int = 10000
    share: float = 0.85
    history: int = 10
    floor: float = 50
    large: float = 1000
    band: float = 0.50
    tight: float = 0.15


def means_before(held: dict[int, dict[str, int]], ordinal: int, history: int) -> dict[str, float]:
    """Each series' mean count over the days before that hold it."""
    seen: dict[str, list[int]] = {}
    for k in range(ordinal - history, ordinal):
        for series, n in held.get(k, {}).items():
            seen.setdefault(series, []).append(n)
    return {series: sum(ns) / len(ns) for series, ns in seen.items()}


def deviation(raw: dict[str, int], means: dict[str, float], limits: Limits) -> str | None:
    """The first series, in order, that is absent or off its mean by more than it may."""
    for series, mean in sorted(means.items()):
        if mean < limits.floor:
            continue
        if series not in raw:
            return f"series {series} absent"
        if abs(raw[series] - mean) / mean > (limits.tight if mean >= limits.large else limits.band):
            return f"series {series} deviates"
    return None


def judged(day: dict[str, int], raw: dict[str, int], stored: dict[str, int] | None, means: dict[str, float], limits: Limits, is_target: bool) -> tuple[str, str | None, bool]:
    """(status, reason, whether bad rows are kept as evidence) of one day, by the gates in their order. stored is None for a day that the
    store does not have."""
    if stored is not None:
        shared = [s for s in stored if s in means]
        expected = sum(means[s] for s in shared)
        if not expected or sum(stored[s] for s in shared) >= limits.share * expected:
            return "idempotent", None, False
    rows = day.get("rows", 0)
    if not rows:
        return ("not_yet", None, False) if is_target else ("failed", "no rows of a past day", False)
    if day.get("wrong_date"):
        return "failed", "rows of another date", False
    if not limits.least <= rows <= limits.most:
        return "failed", "row count out of bounds", False
    if off := deviation(raw, means, limits):
        return "failed", off, False
    if day.get("bad", 0) == rows:
        return "failed", "all rows are bad", True
    if day.get("broken"):
        return "failed", "contract broken", True
    return ("success" if stored is None else "success_topped_up"), None, True


def may_enter(limits: Limits) -> Column:
    """Whether a day's own counts (rows, bad, wrong_date, broken) let it in, whatever came before it: the gates of judged without the means."""
    return (F.col("wrong_date") == 0) & F.col("rows").between(limits.least, limits.most) & (F.col("bad") < F.col("rows")) & (F.col("broken") == 0)


def admissions(tallies: DataFrame, days: DataFrame, target: str, limits: Limits = Limits()) -> DataFrame:
    """ADMITTED for each day of days (date, ordinal), in each dataset that has tallies or, without any, in none.

    tallies: TALLIES of these days and of the limits.history trading days before them. Only the target day may be late. A refused day
    leaves the store's counts as they are; an admitted one has its merged counts from then on."""

    def fold(key: tuple[str], pdf: pd.DataFrame) -> pd.DataFrame:
        known: dict[tuple[int, str], dict] = {}
        for row in pdf.itertuples():
            known.setdefault((row.ordinal, row.kind), {})[row.series] = int(row.n)
        # series that are null are no series to the gates; a stored day is one with any row
        named = lambda o, kind: {s: n for s, n in known.get((o, kind), {}).items() if isinstance(s, str)}
        held = {o: named(o, "stored") for o, kind in known if kind == "stored"}
        out = []
        for o, date in sorted((int(o), d) for o, d in pdf.loc[pdf["kind"] == "day", ["ordinal", "date"]].itertuples(index=False)):
            day = {kind: sum(known.get((o, kind), {}).values()) for kind in ("rows", "bad", "wrong_date", "broken")}
            status, reason, evidence = judged(day, named(o, "raw"), held.get(o), means_before(held, o, limits.history), limits, str(date)[:10] == target)
            if status.startswith("success"):
                held[o] = named(o, "merged")
            out.append((key[0], date, status, reason, day["rows"], day["bad"], evidence))
        return pd.DataFrame(out, columns=["dataset", "date", "status", "reason", "n_rows", "n_quarantined", "evidence"])

    asked = tallies.select("dataset").distinct().crossJoin(F.broadcast(days.select("date", "ordinal")))  # a row per dataset and day
    asked = asked.select("dataset", "date", "ordinal", F.lit(None).cast("string").alias("series"), F.lit("day").alias("kind"), F.lit(0).cast("bigint").alias("n"))
    return tallies.unionByName(asked).groupBy("dataset").applyInPandas(fold, ADMITTED)
