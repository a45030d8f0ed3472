"""Column functions: text keys, dates, numbers, flags."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Col = Column | str


def col(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- text


def index_key(name: Col) -> Column:
    """Trimmed, upper-case, without blanks; punctuation stays."""
    return F.regexp_replace(F.upper(F.trim(col(name))), " ", "")


def plain_label(name: Col) -> Column:
    """Lower-case letters, digits and ampersands with single blanks between: for matches that ignore case and punctuation."""
    return F.trim(F.regexp_replace(F.lower(col(name)), "[^a-z0-9&]+", " "))


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else " ".join(unicodedata.normalize("NFKC", v).split()))


def canonical_label(name: Col) -> Column:
    """Compatibility-composed Unicode, white space collapsed, trimmed. Spark has no built-in for the first."""
    return _nfkc(col(name))


def instrument_key(isin: Col, symbol: Col, prefix: str = "NSE:") -> Column:
    """The ISIN; else prefix and symbol; else empty."""
    isin, symbol = F.coalesce(col(isin), F.lit("")), F.coalesce(col(symbol), F.lit(""))
    return F.when(isin != "", isin).when(symbol != "", F.concat(F.lit(prefix), symbol)).otherwise("")


def normal_isin(isin: Col) -> Column:
    """Trimmed, upper-case, letter O read as zero."""
    return F.translate(F.upper(F.trim(col(isin))), "O", "0")


def issuer(isin: Col) -> Column:
    return F.substring(col(isin), 1, 9)


def joined_key(*parts: Col, missing: str = "-") -> Column:
    """Parts joined by '|', missing ones as a placeholder."""
    return F.concat_ws("|", *(F.coalesce(col(p).cast("string"), F.lit(missing)) for p in parts))


def machine_locator(path: Col) -> Column:
    """The .xml twin of an .html locator."""
    return F.regexp_replace(col(path), r"\.html$", ".xml")


def last_segment(path: Col) -> Column:
    return F.substring_index(col(path), "/", -1)


def or_default(label: Col, default: Col) -> Column:
    """The label, or the default where it is null or blank."""
    return F.coalesce(F.nullif(F.trim(col(label)), F.lit("")), col(default))


def text_or_empty(c: Col) -> Column:
    return F.coalesce(col(c), F.lit(""))


def tier_or_null(c: Col) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def scrip_code(c: Col) -> Column:
    """A code given as a JSON number or string, as text."""
    return F.regexp_replace(F.trim(col(c).cast("string")), r"\.0+$", "")


def fingerprint_text(text: Col) -> Column:
    return F.sha2(col(text), 256)


# ---- dates


def strict_date(text: Col, pattern: str) -> Column:
    """Parses and fails on anything else (ANSI mode)."""
    return F.to_date(col(text), pattern)


def month_name_date(text: Col) -> Column:
    """31-MAR-2026 in any letter case; null where it does not parse."""
    return F.to_date(F.try_to_timestamp(F.initcap(F.lower(F.trim(col(text)))), F.lit("dd-MMM-yyyy")))


def is_weekday(d: Col) -> Column:
    return F.weekday(col(d)) < 5


def quarter_start(d: Col) -> Column:
    return F.trunc(col(d), "quarter")


def fiscal_year(d: Col) -> Column:
    """The year in which the April-March year ends."""
    return F.year(col(d)) + F.when(F.month(col(d)) >= 4, 1).otherwise(0)


def fiscal_quarter(d: Col) -> Column:
    """Q1..Q4 for quarter ends June, September, December, March; other months Q?."""
    m = F.month(col(d))
    return F.when(m == 6, "Q1").when(m == 9, "Q2").when(m == 12, "Q3").when(m == 3, "Q4").otherwise("Q?")


def retry_delay(attempts: Col, delays: Iterable[int] = (1, 3, 7)) -> Column:
    """Days until the next try after so many failures; null after the last."""
    delays = list(delays)
    n = col(attempts)
    return F.when((n >= 1) & (n <= len(delays)), F.element_at(F.array(*map(F.lit, delays)), F.greatest(n, F.lit(1)).cast("int")))


def filing_season(d: Col) -> Column:
    """January, April, July, October from the 5th on."""
    return F.month(col(d)).isin(1, 4, 7, 10) & (F.dayofmonth(col(d)) >= 5)


def inclusive_days(start: Col, end: Col) -> Column:
    return F.datediff(col(end), col(start)) + 1


def calendar_due(today: Col, last_year_known: Col) -> Column:
    """From December on the next year's holidays must be known."""
    return (F.month(col(today)) == 12) & (col(last_year_known) <= F.year(col(today)))


# ---- numbers


def deviation(a: Col, b: Col) -> Column:
    """|a / b - 1|; null for b = 0."""
    return F.abs(F.try_divide(col(a), col(b)) - 1)


def growth_pct(now: Col, before: Col) -> Column:
    """Percent growth over a positive base; null otherwise."""
    return F.when(col(before) > 0, (col(now) - col(before)) / col(before) * 100)


def crore(rupees: Col) -> Column:
    return col(rupees) / 1e7


def safe_number(text: Col, default: Col | float | None = None) -> Column:
    """A number in text; the default for '-', blanks and anything else."""
    value = F.expr(f"try_cast(trim({text}) as double)") if isinstance(text, str) else F.try_to_number(text, F.lit("999999999999.999999")).cast("double")
    value = F.when(~F.isnan(value), value)
    return value if default is None else F.coalesce(value, default if isinstance(default, Column) else F.col(default) if isinstance(default, str) else F.lit(default))


def positive(c: Col) -> Column:
    return F.when(col(c) > 0, col(c))


def plausible_pct(share: Col, most: float = 50.0) -> Column:
    """A positive share as percent, null above the plausible."""
    pct = col(share) * 100
    return F.when((col(share) > 0) & (pct <= most), pct)


def sum_known(a: Col, b: Col) -> Column:
    """a + b, where one of them may be missing."""
    return F.when(col(a).isNotNull() | col(b).isNotNull(), F.coalesce(col(a), F.lit(0.0)) + F.coalesce(col(b), F.lit(0.0)))


# ---- flags


def flags(rules: dict[str, Column]) -> Column:
    """Names of the rules that hold (null counts as not), sorted, joined by ';'."""
    return F.concat_ws(";", F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items()))))))


def holds(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))
