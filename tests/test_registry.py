from datetime import date

import pytest
from pyspark.sql import functions as F

from marketpipe.operators import quality, registry, sectors

STATE = "isin string, symbol string, status string, macro_sector string, sector string, industry string, basic_industry string, attempts int, retry_on date, deferred boolean, backlog boolean, audit_attempt_on date, absences int"
TODAY = "2026-05-15"


def entry(isin, status="classified", symbol=None, sector="S", attempts=0, retry_on=None, deferred=False, backlog=False, audit=None, absences=0):
    tiers = ("M", sector, "I", "B") if sector else (None,) * 4
    return (isin, symbol or isin.lower(), status, *tiers, attempts, retry_on, deferred, backlog, audit, absences)


def state(spark, *rows):
    return spark.createDataFrame(list(rows), STATE)


def snap(spark, *keys):
    return spark.createDataFrame([k if isinstance(k, tuple) else (k, k.lower()) for k in keys], "isin string, symbol string")


def reasons(df):
    return {r["isin"]: r["reasons"] for r in df.collect() if r["reasons"]}


def test_only_new_listings_are_collected(spark):
    out = registry.reconcile(state(spark, entry("A"), entry("B")), snap(spark, "A", "NEW"), TODAY)
    assert reasons(out) == {"NEW": "new"} and {r["isin"]: r["absences"] for r in out.collect()} == {"A": 0, "B": 1, "NEW": 0}


def test_two_absences_then_back(spark):
    one = registry.reconcile(state(spark, entry("A"), entry("B")), snap(spark, "A"), TODAY).drop("reasons")
    two = registry.reconcile(one, snap(spark, "A"), TODAY).drop("reasons")
    assert {r["isin"]: r["status"] for r in two.collect()} == {"A": "classified", "B": "inactive"}
    back = registry.reconcile(two, snap(spark, "A", "B"), TODAY)
    assert reasons(back) == {"B": "reactivated"} and {r["isin"]: (r["status"], r["absences"]) for r in back.collect()}["B"] == ("classified", 0)


def test_candidates(spark):
    d = date(2026, 5, 15)
    rows = [entry("DUE", "pending", sector=None, attempts=1, retry_on=d), entry("LATER", "pending", sector=None, retry_on=date(2026, 5, 16)), entry("DEF", "pending", sector=None, deferred=True), entry("LOG", "pending", sector=None, backlog=True), entry("REN", symbol="old"), entry("AUD", audit=date(2026, 3, 31)), entry("OK", audit=date(2026, 4, 1))]
    keys = [r[0] for r in rows]
    assert reasons(registry.reconcile(state(spark, *rows), snap(spark, *keys), TODAY)) == {"DUE": "retry_due", "REN": "renamed"}
    assert set(reasons(registry.reconcile(state(spark, *rows), snap(spark, *keys), TODAY, force_pending=True))) == {"DUE", "LATER", "DEF", "LOG", "REN"}
    audit = reasons(registry.reconcile(state(spark, *rows), snap(spark, *keys), TODAY, audit=True))
    assert "audit_due" in audit["AUD"] and "OK" not in audit
    manual = registry.reconcile(state(spark, entry("RAW", "pending", sector=None)), snap(spark, "RAW"), TODAY, manual=True)
    assert manual.first()["backlog"] and [r["isin"] for r in registry.candidates(registry.reconcile(state(spark), snap(spark, "Z", "Y", "X"), TODAY), 2).collect()] == ["X", "Y"]


def test_retry_budget(spark):
    now, days = state(spark, entry("A", "pending", sector=None)).withColumn("reasons", F.lit("new")), []
    fail = spark.createDataFrame([("A", 1, "failed", None, None, None, None)], "isin string, ordinal int, outcome string, macro_sector string, sector string, industry string, basic_industry string")
    for _ in range(4):
        now = registry.fold(now, fail, TODAY)
        row = now.first()
        days.append((row["retry_on"] and (row["retry_on"] - date(2026, 5, 15)).days, row["deferred"]))
    assert days == [(1, False), (3, False), (7, False), (None, True)]


def test_fold_stops_at_deferral(spark):
    s = state(spark, *(entry(k, "pending", sector=None, attempts=2) for k in "ABC"))
    att = spark.createDataFrame([("A", 1, "observed", "m", "s", "i", "b"), ("B", 2, "deferred", None, None, None, None), ("C", 3, "observed", "m", "s", "i", "b")], "isin string, ordinal int, outcome string, macro_sector string, sector string, industry string, basic_industry string")
    assert {r["isin"]: (r["status"], r["sector"], r["attempts"]) for r in registry.fold(s, att, TODAY).collect()} == {"A": ("classified", "s", 0), "B": ("pending", None, 2), "C": ("pending", None, 2)}


def view(spark, n=10, change=None, rename=(), drop=0, sectors_=3):
    rows = [(f"K{i}", f"s{i}{'x' if i in rename else ''}", "M", (change or {}).get(i, f"S{i % sectors_}"), "I", "B") for i in range(drop, n)]
    return spark.createDataFrame(rows, "isin string, symbol string, macro_sector string, sector string, industry string, basic_industry string")


@pytest.mark.parametrize("current, want, kw", [
    ({}, "unchanged", {}), ({"n": 0}, "empty", {}), ({"drop": 1}, "coverage", {}), ({"rename": (1, 2, 3, 4)}, "publish", {}), ({"change": {1: "S0"}}, "publish", {}), ({"change": {1: "S0", 2: "S0"}}, "taxonomy_change", {}),
    ({"sectors_": 1}, "diversity", {}), ({"rename": (1,)}, "missing_provenance", {"known": []}), ({"rename": (1,)}, "coverage", {"observed": 98, "expected": 100}),
])
def test_publication(spark, current, want, kw):
    known = spark.createDataFrame([(k,) for k in kw.pop("known", [f"K{i}" for i in range(10)])], "isin string")
    assert registry.decide_publication(view(spark, **current), view(spark), known, **kw).first()["decision"] == want


def test_snapshot_validity(spark):
    many = state(spark, *(entry(f"K{i}") for i in range(40)))
    valid = lambda st, *keys: registry.snapshot_validity(snap(spark, *keys), st).first()["valid"]
    assert valid(many, *(f"K{i}" for i in range(38))) and not valid(many, *(f"K{i}" for i in range(37))) and not valid(many, *(f"K{i}" for i in range(37)), "X")
    assert not valid(many) and not valid(many, *(f"K{i}" for i in range(40)), "K1") and not valid(many, *(f"K{i}" for i in range(40)), ("", "s"))
    few = state(spark, entry("A"), entry("B"))
    assert valid(few, "A") and not valid(few, "Z") and valid(state(spark), "Z")


def test_sectors(spark):
    df = spark.createDataFrame([("Oil, Gas & Consumable Fuels",), ("Metals",), (None,)], "sector string")
    assert [r[0] for r in df.select(sectors.cyclical_plain("sector", ["oil gas & consumable fuels"])).collect()] == [True, False, False]
    assert [r[0] for r in df.select(sectors.cyclical("sector", ["Metals"])).collect()] == [False, True, False]
    ids = spark.createDataFrame([(i,) for i in range(5)], "k int")
    verdict = lambda cur, floor: sectors.accept_snapshot(cur, ids, floor, "k").first()["verdict"]
    assert [verdict(ids.limit(0), 1), verdict(ids.unionAll(ids), 1), verdict(ids, 6), verdict(ids.limit(4), 1), verdict(ids, 5)] == ["empty", "duplicate_keys", "below_floor", "shrunk", "accepted"]


def test_no_shrink(spark):
    s = "dataset string, year int, n_rows bigint, max_date date"
    live = spark.createDataFrame([("a", 2024, 5, date(2024, 5, 1)), ("a", 2025, 5, date(2025, 5, 1)), ("a", 2026, 5, date(2026, 5, 1)), ("b", 2026, 1, date(2026, 1, 1)), ("c", 2026, 1, date(2026, 1, 1))], s)
    new = spark.createDataFrame([("a", 2024, 4, date(2024, 5, 1)), ("a", 2026, 9, date(2026, 4, 1))], s)
    got = {(r["dataset"], r["year"]): r["verdict"] for r in quality.no_shrink(live, new, ["a", "b"]).collect()}
    assert got == {("a", 2024): "fewer_rows", ("a", 2025): "missing_partition", ("a", 2026): "date_regression", ("b", 2026): "missing_dataset"}
    assert {r["verdict"] for r in quality.no_shrink(live, new, ["a"], True).filter("year = 2024").collect()} == {"ok"}


def test_candidates_follow_the_order_of_the_snapshot(spark):
    ordered = snap(spark, "C", "A", "B").withColumn("ordinal", F.expr("case isin when 'C' then 1 when 'A' then 2 else 3 end"))
    out = registry.reconcile(state(spark), ordered, TODAY)
    assert [r["isin"] for r in registry.candidates(out, 2).collect()] == ["C", "A"]
    plain = registry.reconcile(state(spark), snap(spark, "C", "A", "B"), TODAY)
    assert [r["isin"] for r in registry.candidates(plain, 2).collect()] == ["A", "B"]


def test_observations_find_their_key_by_symbol(spark):
    seen = spark.createDataFrame([("a", "x"), ("zz", "y")], "symbol string, label string")
    got = registry.observed_keys(seen, state(spark, entry("A1", symbol="a"), entry("A2", symbol="a"), entry("B"))).collect()
    assert [(r["isin"], r["label"]) for r in got] == [("A2", "x")]


def test_flat_state_has_one_row_per_key_and_no_labels_where_unknown(spark):
    origin = spark.createDataFrame([("A", "2026-01-01", "u", "v1", "h"), ("A", "2026-02-01", "u", "v2", "h2")], "isin string, observed_at string, source_url string, extractor_version string, fragment_hash string")
    got = {r["isin"]: r for r in registry.flat_state(state(spark, entry("A", audit=date(2026, 3, 1)), entry("B", "pending", sector=None)), origin, TODAY).collect()}
    assert (got["A"]["extractor_version"], got["A"]["audit_attempt_on"], got["A"]["sector"]) == ("v2", "2026-03-01", "S")
    assert got["B"]["sector"] is None and got["B"]["source_url"] is None and str(got["B"]["date"]) == TODAY


def test_a_wider_artifact_keeps_its_keys(spark):
    got = registry.widened(snap(spark, "A", "B"), snap(spark, ("B", "old"), "C"))
    assert sorted(map(tuple, got.collect())) == [("A", "a", False), ("B", "b", False), ("C", "c", True)]
    assert registry.widened_verdict(snap(spark, "A"), snap(spark, "A", "B")).first()["accepted"]
