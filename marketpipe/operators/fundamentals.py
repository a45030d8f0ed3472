"""Fundamentals: facts to wide periods, sector lines, rows, gates, merge, trailing EPS and growth."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import flags, growth_pct, holds, inclusive_days, plausible_pct, positive, sum_known
from ..schemas import FUND_KEY

#: The facts that the derivations read, by element name.
RUPEE_FACTS = (
    "RevenueFromOperations OtherIncome FinanceCosts DepreciationDepletionAndAmortisationExpense ProfitBeforeTax TaxExpense CurrentTax DeferredTax ProfitLossForPeriod InterestEarned InterestExpended "
    "ProfitLossFromOrdinaryActivitiesBeforeTax ProfitLossForThePeriod ProfitLossFromOrdinaryActivitiesAfterTax Income OperatingExpenses OperatingProfitBeforeProvisionAndContingencies "
    "ProvisionsOtherThanTaxAndContingencies ImpairmentOnFinancialInstruments NetPremiumIncome NetPremiumWritten GrossPremiumIncome GrossPremiumsWritten IncomeFromInvestmentsNet NetCommission "
    "BenefitsPaidNet IncurredClaims TransferredToShareholdersAccount OperatingProfitOrLoss ProfitLossBeforeTax ProfitOrLossBeforeTax ProvisionForTax ProfitLossAfterTaxAndExtraordinaryItems "
    "ProfitLossAfterTaxBeforeExtraordinaryItems ProfitLossAfterTax"
).split()
PLAIN_FACTS = (
    "BasicEarningsLossPerShareFromContinuingAndDiscontinuedOperations BasicEarningsLossPerShareFromContinuingOperations BasicEarningsPerShareAfterExtraordinaryItems "
    "BasicAndDilutedEPSAfterExtraordinaryItemsNetOfTaxExpenseForThePeriodNotToBeAnnualized PercentageOfGrossNpa PercentageOfNpa"
).split()
INSTANT_FACTS = "EquityShareCapital PaidUpEquityShareCapital PaidUpEquityCapital ShareCapital EquityAttributableToOwnersOfParent Equity BorrowingsCurrent BorrowingsNoncurrent Borrowings CashAndCashEquivalents".split()
#: Fields whose presence is counted for each sector.
RESOLVED = {
    "general": ("revenue", "operating_profit", "opm_pct", "other_income", "interest", "depreciation", "pbt", "tax", "net_profit", "eps"),
    "bank": ("revenue", "other_income", "pbt", "tax", "net_profit", "eps"),
    "nbfc": ("revenue", "other_income", "interest", "pbt", "tax", "net_profit", "eps"),
    "insurance": ("revenue", "other_income", "net_profit", "eps"),
}
DERIVED = ("ttm_eps", "ttm_eps_method", "revenue_growth_yoy_pct", "revenue_growth_qoq_pct", "net_profit_growth_yoy_pct", "net_profit_growth_qoq_pct", "eps_growth_yoy_pct")


def first_fact(value: Column, when: Column) -> Column:
    """The value of the first fact (by ordinal) that the condition holds for, parsed as a number; an unparsable first one is null."""
    return F.min_by(value, F.when(when, F.col("ordinal"))).try_cast("double")


def pivot_facts(facts: DataFrame, elements: Sequence[str], contexts: Sequence[str], by: Sequence[str] = ("filing",)) -> DataFrame:
    """One row per filing, a column {element}_{context} for each pair: the first fact's number. One shuffle, partial aggregates."""
    wanted = facts.filter(F.col("element").isin(list(elements)) & F.col("context").isin(list(contexts)))
    value = F.trim("value")
    return wanted.groupBy(*by).agg(*(first_fact(value, (F.col("element") == e) & (F.col("context") == c)).alias(f"{e}_{c}") for e in elements for c in contexts))


def sector_kind(facts: DataFrame) -> DataFrame:
    """(filing, sector_kind) by the presence of facts in duration contexts: insurance, bank, nbfc, general, else null."""
    there = facts.filter(F.col("context").isin("OneD", "FourD") & (F.trim("value") != ""))
    return there.groupBy("filing").agg(kind_of(lambda e: F.max(F.col("element") == e)).alias("sector_kind"))


#: Elements by whose presence a filing's sector is known.
SHOWN = ("NetPremiumIncome", "NetPremiumWritten", "InterestEarned", "InterestExpended", "RevenueFromOperations", "ImpairmentOnFinancialInstruments")


def kind_of(has: Callable[[str], Column]) -> Column:
    """The sector of a filing, from a condition for the presence of each of SHOWN."""
    rev, earned, spent = has("RevenueFromOperations"), has("InterestEarned"), has("InterestExpended")
    return (
        F.when(has("NetPremiumIncome") | has("NetPremiumWritten"), "insurance").when(earned & spent & ~rev, "bank")
        .when(rev & (has("ImpairmentOnFinancialInstruments") | earned), "nbfc").when(rev, "general")
    )


def periods_with_kind(facts: DataFrame, contexts: Sequence[str] = ("OneD", "FourD")) -> DataFrame:
    """periods() with the sector_kind of their filing, from one pass over the facts: presence is noted per context, then folded by filing.

    Facts are dealt by filing as narrow rows, elements as numbers: what a task sorts are these, and a wide row is made of a filing's context
    at a time. Dealt after a partial aggregation, nearly every fact would travel and be sorted as a row of all columns."""
    names = (*RUPEE_FACTS, *PLAIN_FACTS, *(e for e in SHOWN if e not in RUPEE_FACTS))
    is_ = {e: F.col("_e") == n for n, e in enumerate(names, 1)}
    narrow = facts.filter(F.col("context").isin(list(contexts))).select("filing", "context", F.array_position(F.array(*map(F.lit, names)), F.col("element")).cast("int").alias("_e"), F.trim("value").alias("value"), "ordinal")
    wide = narrow.repartition("filing").groupBy("filing", "context").agg(
        *(first_fact(F.col("value"), is_[e]).alias(e) for e in (*RUPEE_FACTS, *PLAIN_FACTS)),
        *(F.max(is_[e] & (F.col("value") != "")).alias(f"_has_{e}") for e in SHOWN),
    )
    kind = kind_of(lambda e: F.max(f"_has_{e}").over(Window.partitionBy("filing")))
    return wide.select("filing", "context", *((F.col(e) / 1e7).alias(e) for e in RUPEE_FACTS), *PLAIN_FACTS, kind.alias("sector_kind"))


def without_usable_facts(facts: DataFrame) -> DataFrame:
    """(filing, sector_kind, error): filings of a known sector that have its revenue in neither duration context."""
    rows = periods_with_kind(facts)
    lines = sector_lines(rows).select("filing").distinct()
    missing = rows.filter("sector_kind is not null").select("filing", "sector_kind").distinct().join(lines, "filing", "left_anti")
    return missing.withColumn("error", F.lit("no usable facts in either duration context"))


def periods(facts: DataFrame, contexts: Sequence[str] = ("OneD", "FourD")) -> DataFrame:
    """Long periods (filing, context, one column per element, rupees in crore): contexts stay rows, so both share one plan."""
    wide = pivot_by_context(facts.filter(F.col("context").isin(list(contexts))), [*RUPEE_FACTS, *PLAIN_FACTS])
    return wide.select("filing", "context", *((F.col(e) / 1e7).alias(e) for e in RUPEE_FACTS), *PLAIN_FACTS)


def pivot_by_context(facts: DataFrame, elements: Sequence[str]) -> DataFrame:
    wanted = facts.filter(F.col("element").isin(list(elements)))
    return wanted.groupBy("filing", "context").agg(*(first_fact(F.trim("value"), F.col("element") == e).alias(e) for e in elements))


def _eps() -> Column:
    return F.coalesce("BasicEarningsLossPerShareFromContinuingAndDiscontinuedOperations", "BasicEarningsLossPerShareFromContinuingOperations")


def sector_lines(periods: DataFrame) -> DataFrame:
    """periods (with sector_kind) -> the common columns and the sector's own ones. Periods without the sector's revenue go."""
    c = F.col
    life = c("NetPremiumIncome").isNotNull()
    kind = c("sector_kind")
    pick = lambda general, bank, nbfc, insurance: F.when(kind == "bank", bank).when(kind == "nbfc", nbfc).when(kind == "insurance", insurance).otherwise(general)
    none = F.lit(None).cast("double")
    by_life = lambda a, b: F.when(life, c(a)).otherwise(c(b))
    operating = c("ProfitBeforeTax") + c("FinanceCosts") + c("DepreciationDepletionAndAmortisationExpense") - c("OtherIncome")
    premium = by_life("NetPremiumIncome", "NetPremiumWritten")
    general_tax = F.coalesce("TaxExpense", sum_known("CurrentTax", "DeferredTax"))
    insurer_profit = F.when(life, F.coalesce("ProfitLossAfterTaxAndExtraordinaryItems", "ProfitLossAfterTaxBeforeExtraordinaryItems", "TransferredToShareholdersAccount")).otherwise(F.coalesce("ProfitLossAfterTax", "OperatingProfitOrLoss"))
    only = lambda k, x: F.when(kind == k, x)
    out = periods.select(
        "filing", "context", "sector_kind",
        pick(c("RevenueFromOperations"), c("InterestEarned"), c("RevenueFromOperations"), premium).alias("revenue"),
        pick(operating, none, none, none).alias("operating_profit"),
        pick(F.when(c("RevenueFromOperations") != 0, operating / c("RevenueFromOperations") * 100), none, none, none).alias("opm_pct"),
        pick(F.lit("opm"), F.lit("nim"), F.lit("spread"), F.lit("uw_margin")).alias("margin_kind"),
        pick(c("OtherIncome"), c("OtherIncome"), c("OtherIncome"), c("IncomeFromInvestmentsNet")).alias("other_income"),
        pick(c("FinanceCosts"), none, c("FinanceCosts"), none).alias("interest"),
        pick(c("DepreciationDepletionAndAmortisationExpense"), none, none, none).alias("depreciation"),
        pick(c("ProfitBeforeTax"), c("ProfitLossFromOrdinaryActivitiesBeforeTax"), c("ProfitBeforeTax"), by_life("ProfitLossBeforeTax", "ProfitOrLossBeforeTax")).alias("pbt"),
        pick(general_tax, c("TaxExpense"), c("TaxExpense"), F.when(~life, c("ProvisionForTax"))).alias("tax"),
        pick(c("ProfitLossForPeriod"), F.coalesce("ProfitLossForThePeriod", "ProfitLossFromOrdinaryActivitiesAfterTax"), c("ProfitLossForPeriod"), insurer_profit).alias("net_profit"),
        pick(_eps(), c("BasicEarningsPerShareAfterExtraordinaryItems"), _eps(), c("BasicAndDilutedEPSAfterExtraordinaryItemsNetOfTaxExpenseForThePeriodNotToBeAnnualized")).alias("eps"),
        F.when(kind.isin("bank", "nbfc"), c("Income")).alias("total_income"),
        only("bank", c("InterestEarned")).alias("interest_earned"), only("bank", c("InterestExpended")).alias("interest_expended"),
        F.when(kind == "bank", c("InterestEarned") - c("InterestExpended")).when(kind == "nbfc", c("InterestEarned") - c("FinanceCosts")).alias("net_interest_income"),
        only("bank", c("OperatingExpenses")).alias("operating_expenses"), only("bank", c("OperatingProfitBeforeProvisionAndContingencies")).alias("pre_provision_operating_profit"),
        only("bank", c("ProvisionsOtherThanTaxAndContingencies")).alias("provisions_and_contingencies"),
        only("bank", plausible_pct("PercentageOfGrossNpa")).alias("gross_npa_pct"), only("bank", plausible_pct("PercentageOfNpa")).alias("net_npa_pct"),
        only("nbfc", c("ImpairmentOnFinancialInstruments")).alias("impairment_on_financial_instruments"),
        only("insurance", by_life("GrossPremiumIncome", "GrossPremiumsWritten")).alias("gross_premium_income"), only("insurance", premium).alias("net_premium_income"),
        only("insurance", c("IncomeFromInvestmentsNet")).alias("investment_income"), only("insurance", c("NetCommission")).alias("net_commission"),
        only("insurance", by_life("BenefitsPaidNet", "IncurredClaims")).alias("benefits_paid"),
        only("insurance", F.when(~life & (c("NetPremiumWritten") != 0), (c("IncurredClaims") + c("OperatingExpenses")) / c("NetPremiumWritten") * 100)).alias("combined_ratio_pct"),
    )
    return out.filter(kind.isNotNull() & c("revenue").isNotNull())


def valuation(facts: DataFrame, kinds: DataFrame, master: DataFrame | None = None) -> DataFrame:
    """(filing, face_value, shares_outstanding, equity, total_debt, cash, ebitda): money in crore, shares as a count.

    kinds: (filing, sector_kind). master: (filing, exchange_face_value), where the filing itself is silent.
    """
    duration = ["FaceValueOfEquityShareCapital", "PaidUpValueOfEquityShareCapital", "ProfitBeforeTax", "FinanceCosts", "DepreciationDepletionAndAmortisationExpense"]
    wide = pivot_facts(facts, [*INSTANT_FACTS, *duration], ["OneI", "OneD", "FourD"]).join(kinds, "filing", "left")
    wide = wide.join(master, "filing", "left") if master is not None else wide.withColumn("exchange_face_value", F.lit(None).cast("double"))
    c, general = F.col, F.coalesce(F.col("sector_kind") == "general", F.lit(False))
    face = F.coalesce(positive(F.coalesce("FaceValueOfEquityShareCapital_OneD", "FaceValueOfEquityShareCapital_FourD")), positive("exchange_face_value"))
    capital = positive(F.coalesce("EquityShareCapital_OneI", "PaidUpValueOfEquityShareCapital_OneD", "PaidUpValueOfEquityShareCapital_FourD", "PaidUpEquityShareCapital_OneI", "PaidUpEquityCapital_OneI", "ShareCapital_OneI"))
    not_zero = lambda x: F.when(x != 0, x)
    debt = F.when(general, sum_known("BorrowingsCurrent_OneI", "BorrowingsNoncurrent_OneI")).otherwise(c("Borrowings_OneI"))
    ebitda = F.when(general, c("ProfitBeforeTax_FourD") + c("FinanceCosts_FourD") + c("DepreciationDepletionAndAmortisationExpense_FourD"))
    return wide.select(
        "filing", face.alias("face_value"), (capital / face).alias("shares_outstanding"),
        (F.coalesce(not_zero(c("EquityAttributableToOwnersOfParent_OneI")), not_zero(c("Equity_OneI"))) / 1e7).alias("equity"),
        (not_zero(debt) / 1e7).alias("total_debt"), (not_zero(c("CashAndCashEquivalents_OneI")) / 1e7).alias("cash"), (ebitda / 1e7).alias("ebitda"),
    )


def resolved_share(rows: DataFrame) -> DataFrame:
    """rows with fields_resolved_pct: the share of its sector's fields that are there."""
    share = F.lit(None).cast("double")
    for kind, fields in RESOLVED.items():
        n = sum((F.when(F.col(f).isNotNull(), 1).otherwise(0) for f in fields[1:]), F.when(F.col(fields[0]).isNotNull(), 1).otherwise(0))
        share = F.when(F.col("sector_kind") == kind, n / len(fields)).otherwise(share)
    return rows.withColumn("fields_resolved_pct", share)


def fundamentals_rows(lines: DataFrame, values: DataFrame) -> DataFrame:
    """Lines joined with the balance sheet: capital employed, book value per share, EBITDA on full-year rows only."""
    rows = lines.join(values, "filing", "left")
    employed = F.when(F.col("equity").isNotNull(), F.col("equity") + F.coalesce("total_debt", F.lit(0.0)))
    book = F.when(F.col("shares_outstanding") > 0, F.col("equity") * 1e7 / F.col("shares_outstanding"))
    annual = F.when(F.col("context") == "FourD", F.col("ebitda"))
    return resolved_share(rows.withColumns({"capital_employed": employed, "book_value_per_share": book, "ebitda_annual": annual}).drop("ebitda"))


def full_years_only(rows: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Without full-year rows whose context does not span 350 to 380 days."""
    return rows.filter(F.coalesce((F.col("fiscal_quarter") != "FY") | inclusive_days(start, end).between(350, 380), F.lit(False)))


def gate_blocks() -> Column:
    """Fixed values, as published with each row: the names of the reasons. Reasons that block a row (columns as in rows, days of its context, mktcap_cr), joined by ';'."""
    c = F.col
    yearly = F.when(c("fiscal_quarter") == "FY", c("revenue")).otherwise(c("revenue") * 4)
    sized = (c("revenue") > 0) & (c("mktcap_cr") > 0)
    fy = c("fiscal_quarter") == "FY"
    return flags({
        "low_fields_resolved": c("fields_resolved_pct") < 0.40, "negative_revenue": c("revenue") < 0,
        "scale_revenue_vs_mcap_too_large": sized & (yearly > c("mktcap_cr") * 10), "scale_revenue_vs_mcap_too_small": sized & (yearly < c("mktcap_cr") / 1000),
        "annual_duration": fy & ~c("days").between(350, 380), "quarter_duration": ~fy & ~c("days").between(85, 95),
    })


def gate_flags() -> Column:
    """Fixed values, as published with each row: the names of the doubts. Doubts that do not block a row, sorted, joined by ';'."""
    c = F.col
    implied = c("net_profit") * 1e7 / F.when(c("shares_outstanding") > 0, c("shares_outstanding"))
    apart = lambda a, b, share, least: (F.greatest(F.abs(a), F.abs(b)) > least) & (F.abs(a - b) > share * F.greatest(F.abs(a), F.abs(b)))
    return flags({
        "negative_tax": c("tax") < 0, "tax_exceeds_pbt": (c("pbt") > 0) & (c("tax") > c("pbt")),
        "eps_vs_net_profit_mismatch": (F.abs(c("eps")) > 0.01) & apart(implied, c("eps"), 0.25, 0.0),
        "pbt_tax_np_identity": apart(c("pbt") - c("tax"), c("net_profit"), 0.05, 1e-9),
        "nii_identity": apart(c("interest_earned") - c("interest_expended"), c("net_interest_income"), 0.01, 1e-9),
    })


def ttm_eps(rows: DataFrame) -> DataFrame:
    """rows with ttm_eps and ttm_eps_method. Quarters: the sum of four known quarters that span 260 to 300 days (sum4q), else the
    full year's EPS of the same period end (fy_eps); full years: their own. Quarters of one period end count once, by the first in order, known or not."""
    key = ("instrument_key", "basis")
    quarters = rows.filter("fiscal_quarter <> 'FY'").groupBy(*key, "period_end").agg(F.min_by("eps", "fiscal_quarter").alias("q_eps"))
    w = Window.partitionBy(*key).orderBy("period_end")
    last4 = w.rowsBetween(-3, 0)
    span = inclusive_days(F.lag("period_end", 3).over(w), F.col("period_end"))
    whole_year = (F.count("q_eps").over(last4) == 4) & span.between(260, 300)
    quarters = quarters.select(*key, "period_end", F.when(whole_year, F.sum("q_eps").over(last4)).alias("sum4"))
    annual = rows.filter("fiscal_quarter = 'FY'").groupBy(*key, "period_end").agg(F.min_by("eps", "fiscal_quarter").alias("fy_eps"))
    both = rows.join(quarters, [*key, "period_end"], "left").join(annual, [*key, "period_end"], "left")
    fy = F.col("fiscal_quarter") == "FY"
    value = F.when(fy, F.col("eps")).otherwise(F.coalesce("sum4", "fy_eps"))
    method = F.when(fy & F.col("eps").isNotNull(), "fy_eps").when(~fy & F.col("sum4").isNotNull(), "sum4q").when(~fy & F.col("fy_eps").isNotNull(), "fy_eps").otherwise("")
    return both.withColumns({"ttm_eps": value, "ttm_eps_method": method}).drop("sum4", "fy_eps")


def growth(rows: DataFrame) -> DataFrame:
    """rows with year-on-year growth (latest period 360 to 372 inclusive days before) and quarter-on-quarter (85 to 98), percent,
    null over a base that is missing or not positive. Full years compare with full years and have no quarter-on-quarter."""
    fy = F.col("fiscal_quarter") == "FY"
    w = Window.partitionBy("instrument_key", "basis", fy).orderBy(F.datediff("period_end", F.lit("1970-01-01")))
    point = F.struct("revenue", "net_profit", "eps")
    out = rows.withColumns({"_y": F.last(point).over(w.rangeBetween(-371, -359)), "_q": F.last(point).over(w.rangeBetween(-97, -84))})
    return out.withColumns({
        "revenue_growth_yoy_pct": growth_pct("revenue", "_y.revenue"), "net_profit_growth_yoy_pct": growth_pct("net_profit", "_y.net_profit"), "eps_growth_yoy_pct": growth_pct("eps", "_y.eps"),
        "revenue_growth_qoq_pct": F.when(~fy, growth_pct("revenue", "_q.revenue")), "net_profit_growth_qoq_pct": F.when(~fy, growth_pct("net_profit", "_q.net_profit")),
    }).drop("_y", "_q")


def merge_rows(existing: DataFrame, new: DataFrame, ignore: Sequence[str] = ("as_of", "mktcap_cr", *DERIVED), key: Sequence[str] = FUND_KEY) -> DataFrame:
    """Existing and new rows by key: equal data keeps the existing row with its as_of, other data is replaced, nothing is dropped."""
    cols = [c for c in existing.columns if c not in key]
    data = [c for c in cols if c not in ignore]
    a, b = existing.select(*key, F.struct(*cols).alias("_old")), new.select(*key, F.struct(*cols).alias("_new"))
    both = a.join(b, list(key), "full_outer")
    same = F.lit(True)
    for c in data:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    change = F.when(F.col("_new").isNull(), "kept").when(F.col("_old").isNull(), "appended").when(same, "unchanged").otherwise("replaced")
    both = both.withColumn("change", change).withColumn("_row", F.when(F.col("change").isin("kept", "unchanged"), F.col("_old")).otherwise(F.col("_new")))
    return both.select(*key, *(F.col(f"_row.{c}").alias(c) for c in cols), "change")


def sorted_rows(rows: DataFrame) -> DataFrame:
    return rows.orderBy("instrument_key", F.col("period_end").desc(), "fiscal_quarter", "basis")


def history_depth(rows: DataFrame, top: int = 20) -> DataFrame:
    """(symbol, quarters, oldest, newest, with_growth) of the symbols with most quarters."""
    out = rows.groupBy("symbol").agg(F.count_if(F.col("fiscal_quarter") != "FY").alias("quarters"), F.min("period_end").alias("oldest"), F.max("period_end").alias("newest"), F.count("revenue_growth_yoy_pct").alias("with_growth"))
    return out.orderBy(F.col("quarters").desc(), "symbol").limit(top)


def identity(declared: str, expected: str, scrip: str, expected_scrip: str) -> Column:
    """clean, flagged or rejected: how a filing's ISIN agrees with the expected one."""
    norm = lambda c: F.translate(F.upper(F.trim(F.col(c))), "O", "0")
    same_issuer = (F.substring(norm(declared), 1, 9) == F.substring(norm(expected), 1, 9)) & (F.col(scrip) == F.col(expected_scrip))
    return F.when(F.col(declared).isNull() | (norm(declared) == norm(expected)), "clean").when(holds(same_issuer), "flagged").otherwise("rejected")


def enriched(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """rows with market cap, face value and a symbol: the row's, the listing's, else the instrument key."""
    extra = listing.select("instrument_key", F.col("mktcap").alias("mktcap_cr"), F.col("face_value").alias("exchange_face_value"), F.col("symbol").alias("_symbol"))
    return rows.join(extra, "instrument_key", "left").withColumn("symbol", F.coalesce(F.nullif("symbol", F.lit("")), F.nullif("_symbol", F.lit("")), "instrument_key")).drop("_symbol")
