from datetime import date, timedelta

from pyspark.sql import functions as F

from marketpipe.operators import calendar as cal
from marketpipe.operators import gates
from marketpipe.schemas import BARS

D = date(2026, 7, 3)


def bar(key="K", day=D, **over):
    row = dict(date=day, instrument_key=key, isin="I", symbol="S", series="EQ", open=10.0, high=12.0, low=9.0, close=11.0, prevclose=10.0, volume=5, value=50.0, trades=2, source="x") | over
    return tuple(row[n] for n in BARS.names)


def bars(spark, *rows):
    loose = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BARS)
    return spark.createDataFrame(list(rows), loose)


def test_quarantine_splits_exactly(spark):
    df = bars(spark, bar("GOOD"), bar("NEGVOL", volume=-1), bar("HILO", high=10.0, low=20.0), bar("OUT", close=9999.0), bar(None), bar(""), bar("NAN", open=float("nan")), bar("NULL", prevclose=None))
    clean, bad = gates.quarantine(df)
    assert [r["instrument_key"] for r in clean.collect()] == ["GOOD"] and bad.count() == 7


def counts(spark, today, trailing):
    c = spark.createDataFrame([(D, s, n) for s, n in today.items()], "date date, series string, n bigint")
    m = spark.createDataFrame([(D, s, float(sum(v)) / len(v)) for s, v in trailing.items()], "date date, series string, mean double")
    return {r["series"]: r["verdict"] for r in gates.series_deviation_gate(c, m).collect()}


def test_deviation_gate(spark):
    history = {"EQ": [2100, 2090, 2110], "BE": [300] * 3, "GS": [60] * 3, "ST": [150] * 3, "GB": [60] * 3}
    assert set(counts(spark, {"EQ": 2100, "BE": 180, "GS": 40, "ST": 120, "GB": 45}, history).values()) == {"ok"}
    assert counts(spark, {"EQ": 1000}, {"EQ": [2100, 2090, 2110]}) == {"EQ": "deviates"}
    assert counts(spark, {"EQ": 1700}, {"EQ": [2100, 2090, 2110]}) == {"EQ": "deviates"}
    assert counts(spark, {"BE": 120}, {"BE": [300] * 3}) == {"BE": "deviates"}


def test_deviation_gate_boundaries(spark):
    assert counts(spark, {"A": 1}, {"B": [50], "C": [49.9], "A": [1000]}) == {"B": "absent", "C": "exempt", "A": "deviates"}
    assert counts(spark, {"A": 850, "B": 849, "C": 500, "N": 3}, {"A": [1000], "B": [1000], "C": [999.0]}) == {"A": "ok", "B": "deviates", "C": "ok", "N": "no_history"}


def test_completeness_compares_shared_series_only(spark):
    c = spark.createDataFrame([(D, "EQ", 90), (date(2026, 7, 6), "EQ", 84), (date(2026, 7, 7), "ZZ", 1)], "date date, series string, n bigint")
    m = spark.createDataFrame([(d, s, n) for d in (D, date(2026, 7, 6), date(2026, 7, 7)) for s, n in (("EQ", 100.0), ("BE", 500.0))], "date date, series string, mean double")
    assert {r["date"].day: r["complete"] for r in gates.completeness(c, m).collect()} == {3: True, 6: False, 7: True}


def test_wrong_dates(spark):
    ok, bad = bars(spark, bar()), bars(spark, bar(), bar(day=date(2026, 7, 6)), bar(day=date(2026, 7, 1)), bar(day=date(2026, 7, 7)), bar(day=date(2026, 7, 8)))
    assert not gates.wrong_dates(ok, "2026-07-03").first()["rejected"] and not gates.wrong_dates(ok.limit(0), "2026-07-03").first()["rejected"]
    r = gates.wrong_dates(bad, "2026-07-03").first()
    assert (r["wrong_rows"], r["sample"], r["rejected"]) == (4, "2026-07-01;2026-07-06;2026-07-07", True)


def test_contract_and_columns(spark):
    got = {r["rule"]: r["violations"] for r in gates.contract(bars(spark, bar(close=-1.0), bar(symbol=None)).withColumn("more", F.lit(1)).drop("isin")).collect()}
    assert (got["negative:close"], got["null:symbol"], got["extra:more"], got["absent:isin"]) == (1, 1, 1, 1) and sum(got.values()) == 4
    assert gates.missing_columns(bars(spark, bar()), ["z", "date", "a"]) == ["a", "z"]


def test_all_bad_and_range(spark):
    assert gates.all_bad(bars(spark, bar(volume=-1))).first()["failed"] and not gates.all_bad(bars(spark, bar(), bar(volume=-1))).first()["failed"] and not gates.all_bad(bars(spark, bar()).limit(0)).first()["failed"]
    assert gates.row_count_gate(bars(spark, bar(), bar()), 2, 2).first()["passed"]


def test_calendar_and_holes(spark):
    days = lambda *x: spark.createDataFrame([(date.fromisoformat(v),) for v in x], "date date")
    c = cal.trading_calendar(spark, "2024-01-18", "2024-01-27", days("2024-01-26"), days("2024-01-20"))
    got = {r["date"].day: (r["is_trading"], r["previous"] and r["previous"].day) for r in c.collect()}
    assert got[20] == (True, 19) and got[21] == (False, 20) and got[26] == (False, 25) and got[18] == (True, None)
    back = {r["date"].day: r["back"] and r["back"].day for r in cal.nth_back(c, 2).collect()}
    assert back[22] == 19 and back[18] is None
    present = spark.createDataFrame([("A", date(2024, 1, 18)), ("A", date(2024, 1, 22)), ("B", date(2024, 1, 24))], "k string, date date")
    found = {(r["k"], r["date"].day) for r in cal.holes(present, c.filter("is_trading").select("date"), "k", 5).collect()}
    assert found == {("A", 20), ("A", 23), ("A", 24), ("A", 25), ("B", 25)}


def test_absences(spark):
    p = spark.createDataFrame([("a", 1), ("a", 4), ("b", 2)], "k string, snapshot int")
    s = spark.createDataFrame([(i,) for i in range(1, 6)], "snapshot int")
    got = {(r["k"], r["snapshot"]): (r["absences"], r["inactive"]) for r in gates.absences(p, s, "k").collect()}
    assert [got["a", i] for i in range(1, 6)] == [(0, False), (1, False), (2, True), (0, False), (1, False)]
    assert ("b", 1) not in got and got["b", 5] == (3, True)


def test_absences_come_from_presences_alone(spark):
    p = spark.createDataFrame([("a", 1), ("a", 1), ("a", 4), ("b", 9), ("c", 99), ("d", 4), ("d", 9), ("e", 7)], "k string, snapshot int")
    s = spark.createDataFrame([(n,) for n in (1, 4, 7, 9, 12)], "snapshot int")  # 99 was no valid snapshot
    got = {(r["k"], r["snapshot"]): r["absences"] for r in gates.absences(p, s, "k").collect()}
    want = {("a", 1): 0, ("a", 4): 0, ("a", 7): 1, ("a", 9): 2, ("a", 12): 3, ("b", 9): 0, ("b", 12): 1, ("d", 4): 0, ("d", 7): 1, ("d", 9): 0, ("d", 12): 1, ("e", 7): 0, ("e", 9): 1, ("e", 12): 2}
    assert got == want
    assert {r["k"]: (r["absences"], r["inactive"]) for r in gates.absent_now(p, s, "k").collect()} == {"a": (3, True), "b": (1, False), "d": (1, False), "e": (2, True)}
    assert "NestedLoop" not in gates.absences(p, s, "k")._jdf.queryExecution().toString().replace("BroadcastNestedLoopJoin BuildRight, Cross", "")
    assert gates.absences(p.limit(0), s, "k").count() == gates.absences(p, s.limit(0), "k").count() == 0


def test_holes_over_many_words(spark):
    days = [date(2026, 1, 1) + timedelta(days=n) for n in range(200)]
    rows = [(k, d) for k, step in (("a", 2), ("b", 3), ("c", 1)) for n, d in enumerate(days) if n % step == 0 and n >= 10] + [("a", days[12]), ("z", date(2020, 1, 1)), ("late", date(2027, 1, 1))]
    present, expected = spark.createDataFrame(rows, "k string, date date"), spark.createDataFrame([(d,) for d in days], "date date")
    have = set(rows)
    for window in (None, 61, 5):
        want = sorted((k, d) for k in ("a", "b", "c", "z") for d in days[-(window or 200) :] if d >= min(x for j, x in rows if j == k) and (k, d) not in have)
        found = cal.holes(present, expected, "k", window)
        assert sorted(map(tuple, found.collect())) == want
    assert cal.holes(present, expected, "k", 70)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert cal.holes(present, expected.limit(0), "k").count() == cal.holes(present.limit(0), expected, "k").count() == 0
