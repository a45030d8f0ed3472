from datetime import date

import pytest
from pyspark.sql import functions as F

from marketpipe.operators import filings
from marketpipe.operators import fundamentals as fun

E = lambda y, m: {3: date(y, 3, 31), 6: date(y, 6, 30), 9: date(y, 9, 30), 12: date(y, 12, 31)}[m]
S = "instrument_key string, basis string, fiscal_quarter string, period_end date, revenue double, net_profit double, eps double"


def rows(spark, *xs):
    return spark.createDataFrame([("K", "consolidated", *x) for x in xs], S)


def by(df, *cols):
    return {(r["fiscal_quarter"], str(r["period_end"])): tuple(r[c] for c in cols) for r in df.collect()}


def test_trailing_eps(spark):
    q = [("Q1", E(2025, 6), 0.0, 0.0, 1.0), ("Q2", E(2025, 9), 0.0, 0.0, 2.0), ("Q3", E(2025, 12), 0.0, 0.0, 3.0), ("Q4", E(2026, 3), 0.0, 0.0, 4.0), ("FY", E(2026, 3), 0.0, 0.0, 13.54)]
    got = by(fun.ttm_eps(rows(spark, *q)), "ttm_eps", "ttm_eps_method")
    assert got["Q4", "2026-03-31"] == (10.0, "sum4q") and got["FY", "2026-03-31"] == (13.54, "fy_eps") and got["Q3", "2025-12-31"] == (None, "")
    gapped = by(fun.ttm_eps(rows(spark, *(("Q", d, 0.0, 0.0, 1.0) for d in (E(2025, 6), E(2025, 9), E(2026, 3), E(2026, 6))))), "ttm_eps", "ttm_eps_method")
    assert set(gapped.values()) == {(None, "")}
    missing = by(fun.ttm_eps(rows(spark, *[(a, b, c, d, None if a == "Q2" else e) for a, b, c, d, e in q])), "ttm_eps", "ttm_eps_method")
    assert missing["Q4", "2026-03-31"] == (13.54, "fy_eps")


def test_of_quarters_with_one_period_end_the_first_counts(spark):
    q = [("Q1", E(2025, 6), 0.0, 0.0, 1.0), ("Q2", E(2025, 9), 0.0, 0.0, 2.0), ("Q3", E(2025, 12), 0.0, 0.0, 3.0), ("Q4", E(2026, 3), 0.0, 0.0, None), ("Q5", E(2026, 3), 0.0, 0.0, 4.0)]
    for order in (q, q[::-1]):
        assert by(fun.ttm_eps(rows(spark, *order)), "ttm_eps")["Q5", "2026-03-31"] == (None,)


def test_filings_without_usable_facts(spark):
    facts = [("good", "RevenueFromOperations", "OneD", "5"), ("bad", "RevenueFromOperations", "OneD", "n/a"), ("odd", "OtherIncome", "OneD", "5"), ("half", "InterestEarned", "FourD", "5"), ("half", "InterestExpended", "OneD", "5")]
    df = spark.createDataFrame([(*f, i) for i, f in enumerate(facts)], "filing string, element string, context string, value string, ordinal bigint")
    assert [(r["filing"], r["sector_kind"]) for r in fun.without_usable_facts(df).collect()] == [("bad", "general")]
    kinds = {r["filing"]: r["sector_kind"] for r in fun.sector_kind(df).collect()}
    assert {r["filing"]: r["sector_kind"] for r in fun.periods_with_kind(df).collect()} == kinds
    # an insurer's life branch and a general insurer's combined ratio, and a bank's bad loans
    more = [("life", "NetPremiumIncome", "1e7"), ("life", "ProfitLossBeforeTax", "2e7"), ("life", "BenefitsPaidNet", "3e7"), ("gen", "NetPremiumWritten", "1e9"), ("gen", "IncurredClaims", "6e8"), ("gen", "OperatingExpenses", "3e8"), ("gen", "ProvisionForTax", "1e7")]
    more += [("bank", "InterestEarned", "9e7"), ("bank", "InterestExpended", "4e7"), ("bank", "PercentageOfGrossNpa", "0.025"), ("bank", "PercentageOfNpa", "0.77"), ("bank", "ProvisionsOtherThanTaxAndContingencies", "1e7")]
    df = spark.createDataFrame([(f, e, "OneD", v, i) for i, (f, e, v) in enumerate(more)], df.schema)
    got = {r["filing"]: r for r in fun.sector_lines(fun.periods_with_kind(df)).collect()}
    assert (got["life"]["revenue"], got["life"]["pbt"], got["life"]["benefits_paid"], got["life"]["combined_ratio_pct"], got["life"]["tax"]) == (1.0, 2.0, 3.0, None, None)
    assert (got["gen"]["combined_ratio_pct"], got["gen"]["benefits_paid"], got["gen"]["tax"]) == (pytest.approx(90.0), 60.0, 1.0)
    assert (got["bank"]["gross_npa_pct"], got["bank"]["net_npa_pct"], got["bank"]["provisions_and_contingencies"], got["bank"]["net_interest_income"]) == (2.5, None, 1.0, 5.0)


def test_last_published_period(spark):
    f = [("I", E(2026, 3), "standalone", 4, "published"), ("I", E(2026, 3), "consolidated", 3, "published"), ("I", E(2026, 6), "standalone", 9, "gate_blocked"), ("J", E(2026, 3), "standalone", 1, "parse_error")]
    got = filings.last_published(spark.createDataFrame(f, "issuer string, period_end date, basis string, seq bigint, outcome string")).collect()
    assert [tuple(r) for r in got] == [("I", E(2026, 3), "consolidated", 2)]


def test_growth(spark):
    q = [("Q", d, r, p, None) for d, r, p in ((E(2025, 6), 100.0, -5.0), (E(2025, 9), 110.0, 10.0), (E(2025, 12), 120.0, -2.0), (E(2026, 3), 130.0, 1.0), (E(2026, 6), 125.0, 1.0))]
    got = by(fun.growth(rows(spark, *q)), "revenue_growth_yoy_pct", "revenue_growth_qoq_pct", "net_profit_growth_qoq_pct")
    last = got["Q", "2026-06-30"]
    assert last[0] == 25.0 and last[1] == pytest.approx(-3.846, abs=1e-3)
    assert got["Q", "2025-09-30"][2] is None and got["Q", "2025-12-31"][2] == -120.0
    fy = by(fun.growth(rows(spark, ("FY", E(2025, 3), 1000.0, 1.0, 1.0), ("FY", E(2026, 3), 1200.0, 1.0, 1.0), ("Q4", E(2025, 3), 260.0, 1.0, 1.0), ("Q4", E(2026, 3), 300.0, 1.0, 1.0))), "revenue_growth_yoy_pct", "revenue_growth_qoq_pct")
    assert fy["FY", "2026-03-31"] == (20.0, None) and fy["Q4", "2026-03-31"][0] == pytest.approx(15.3846, abs=1e-3)


GATE = "revenue double, tax double, pbt double, net_profit double, eps double, shares_outstanding double, mktcap_cr double, days int, fiscal_quarter string, fields_resolved_pct double, interest_earned double, interest_expended double, net_interest_income double"
CLEAN = dict(revenue=1000.0, tax=35.0, pbt=140.0, net_profit=105.0, eps=10.5, shares_outstanding=1e8, mktcap_cr=40000.0, days=90, fiscal_quarter="Q1", fields_resolved_pct=1.0, interest_earned=None, interest_expended=None, net_interest_income=None)


@pytest.mark.parametrize("change, blocks, flags", [
    ({}, "", ""), ({"fields_resolved_pct": 0.39}, "low_fields_resolved", ""), ({"revenue": -1.0}, "negative_revenue", ""), ({"mktcap_cr": 399.0}, "scale_revenue_vs_mcap_too_large", ""), ({"mktcap_cr": 4.1e6}, "scale_revenue_vs_mcap_too_small", ""),
    ({"days": 96}, "quarter_duration", ""), ({"days": 85}, "", ""), ({"fiscal_quarter": "FY", "days": 380}, "", ""), ({"fiscal_quarter": "FY", "days": 275}, "annual_duration", ""), ({"tax": -5.0, "net_profit": 145.0, "eps": 14.5}, "", "negative_tax"),
    ({"eps": 20.0}, "", "eps_vs_net_profit_mismatch"), ({"tax": 150.0, "net_profit": -10.0, "eps": -1.0}, "", "tax_exceeds_pbt"), ({"net_profit": 90.0, "eps": 9.0}, "", "pbt_tax_np_identity"), ({"interest_earned": 100.0, "interest_expended": 40.0, "net_interest_income": 70.0}, "", "nii_identity"),
])
def test_gate(spark, change, blocks, flags):
    row = CLEAN | change
    got = spark.createDataFrame([tuple(row.values())], GATE).select(fun.gate_blocks().alias("b"), fun.gate_flags().alias("f")).first()
    assert (got["b"], got["f"]) == (blocks, flags)


def test_facts_take_the_first_even_if_it_does_not_parse(spark):
    f = spark.createDataFrame([("1", "A", "OneD", "x", 1), ("1", "A", "OneD", "5", 2), ("1", "B", "OneD", " 7 ", 3), ("1", "B", "FourD", "8", 1)], "filing string, element string, context string, value string, ordinal int")
    assert tuple(fun.pivot_facts(f, ["A", "B"], ["OneD", "FourD"]).first()) == ("1", None, None, 7.0, 8.0)


def test_document_values(spark):
    """A general filing: revenue, profit and shares, zero debt as null."""
    data = {("RevenueFromOperations", "OneD"): "6795700000", ("ProfitLossForPeriod", "OneD"): "507900000", ("BasicEarningsLossPerShareFromContinuingOperations", "OneD"): "3.71", ("EquityShareCapital", "OneI"): "137000000", ("FaceValueOfEquityShareCapital", "OneD"): "1", ("BorrowingsCurrent", "OneI"): "0"}
    f = spark.createDataFrame([("1", e, c, v, i) for i, ((e, c), v) in enumerate(data.items())], "filing string, element string, context string, value string, ordinal int")
    kinds = fun.sector_kind(f)
    line = fun.sector_lines(fun.periods(f).join(kinds, "filing"))
    row = fun.fundamentals_rows(line, fun.valuation(f, kinds)).first()
    assert (row["sector_kind"], row["revenue"], row["net_profit"], row["eps"], row["shares_outstanding"], row["total_debt"]) == ("general", 679.57, 50.79, 3.71, 137_000_000.0, None)
    assert row["fields_resolved_pct"] == pytest.approx(0.3)


def test_sectors_by_facts(spark):
    cases = {"insurance": ["NetPremiumIncome", "RevenueFromOperations"], "bank": ["InterestEarned", "InterestExpended"], "nbfc": ["RevenueFromOperations", "ImpairmentOnFinancialInstruments"], "general": ["RevenueFromOperations"], None: ["Other"]}
    f = spark.createDataFrame([(str(k), e, "OneD", "1", 1) for k, es in cases.items() for e in es], "filing string, element string, context string, value string, ordinal int")
    assert {r["filing"]: r["sector_kind"] for r in fun.sector_kind(f).collect()} == {str(k): k for k in cases}


def test_merge_keeps_as_of_of_equal_data(spark):
    s = "instrument_key string, period_end date, fiscal_quarter string, basis string, revenue double, as_of string"
    old = spark.createDataFrame([("A", E(2026, 3), "Q4", "c", 1.0, "old"), ("B", E(2026, 3), "Q4", "c", 1.0, "old"), ("D", E(2026, 3), "Q4", "c", None, "old")], s)
    new = spark.createDataFrame([("A", E(2026, 3), "Q4", "c", 1.0, "new"), ("B", E(2026, 3), "Q4", "c", 2.0, "new"), ("C", E(2026, 3), "Q4", "c", 3.0, "new"), ("D", E(2026, 3), "Q4", "c", None, "new")], s)
    assert {r["instrument_key"]: (r["revenue"], r["as_of"], r["change"]) for r in fun.merge_rows(old, new).collect()} == {"A": (1.0, "old", "unchanged"), "B": (2.0, "new", "replaced"), "C": (3.0, "new", "appended"), "D": (None, "old", "unchanged")}


@pytest.mark.parametrize("declared, scrip, want", [("INEOO1A01011", "9", "clean"), (None, "9", "clean"), (" ine001a01O11", "x", "clean"), ("INE001A01099", "1", "flagged"), ("INE001A01099", None, "rejected"), ("INE999A01011", "1", "rejected")])
def test_identity(spark, declared, scrip, want):
    df = spark.createDataFrame([(declared, "INE001A01011", scrip, "1")], "d string, e string, s string, x string")
    assert df.select(fun.identity("d", "e", "s", "x")).first()[0] == want


def test_document_pick(spark):
    s = "filing_key string, basis string, locator string, broadcast date, seq int"
    refs = spark.createDataFrame([("f1", "standalone", "a", E(2026, 6), 1), ("f1", "consolidated", "b", E(2026, 3), 2), ("f1", "consolidated", "c", E(2026, 6), 3), ("f2", "standalone", None, E(2026, 6), 4), ("f3", None, "d", E(2026, 3), 5), ("f3", "consolidated", None, E(2026, 6), 6), ("f4", None, "d", E(2026, 3), 7)], s)
    chosen, pending = filings.pick_documents(refs)
    assert {r["filing_key"]: r["locator"] for r in chosen.collect()} == {"f1": "c", "f3": "d", "f4": "d"} and [r["filing_key"] for r in pending.collect()] == ["f2"]
    once = filings.without_repeats(chosen)
    assert sorted(r["filing_key"] for r in once.collect()) == ["f1", "f3"]
    done = once.filter("filing_key = 'f1'").select(F.col("locator").alias("dedup_key"))
    assert [r["filing_key"] for r in filings.unprocessed(once.withColumn("dedup_key", F.col("locator")), done).collect()] == ["f3"]


def test_file_prefixes(spark):
    names = {"NBFC_INDAS_1": "nbfc", "INDAS_1": "general", "BANKING_1": "bank", "LI_1": "insurance", "GI_1": "insurance", "GOVERNANCE_1": None}
    df = spark.createDataFrame([(f"x/INTEGRATED_FILING_{n}.xml",) for n in names], "locator string")
    assert {r["locator"][20:-4]: r["k"] for r in df.select("locator", filings.sector_of_file().alias("k")).collect()} == names


def test_full_years(spark):
    df = spark.createDataFrame([("FY", date(2024, 4, 1), date(2024, 12, 31)), ("FY", date(2024, 4, 1), date(2025, 3, 31)), ("Q4", date(2025, 1, 1), date(2025, 3, 31))], "fiscal_quarter string, start date, end date")
    assert [r["end"].year for r in fun.full_years_only(df).collect()] == [2025, 2025]


def test_facts_travel_as_narrow_rows(spark):
    facts = spark.createDataFrame([("f", "RevenueFromOperations", "OneD", " 5 ", 2), ("f", "RevenueFromOperations", "OneD", "n/a", 3), ("f", "InterestEarned", "FourD", "1", 1), ("f", "Other", "OneD", "7", 0), ("g", None, "FourD", "2", 0)], "filing string, element string, context string, value string, ordinal bigint")
    rows = fun.periods_with_kind(facts)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("partial_min_by") < plan.index("Exchange")
    got = {(r["filing"], r["context"]): (r["RevenueFromOperations"], r["InterestEarned"], r["sector_kind"]) for r in rows.collect()}
    assert got == {("f", "OneD"): (5e-7, None, "nbfc"), ("f", "FourD"): (None, 1e-7, "nbfc"), ("g", "FourD"): (None, None, None)}
