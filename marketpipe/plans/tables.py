"""The given star tables seen as market data: adapters, each with its SQL twin as a chain of common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import fiscal_quarter
from ..sources.prices import normalize_primary


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_primary(spark: SparkSession, d: str) -> DataFrame:
    """Events by user and day as the primary daily file: a final session, and an intermediate one of every fifth user."""
    e = load(spark, d, "events").withColumn("date", F.col("ts").cast("date"))
    day = e.groupBy("user_id", "date").agg(
        F.min_by("value", "event_id").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "event_id").alias("close"),
        F.count(F.lit(1)).alias("volume"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"), F.max_by("event_type", "event_id").alias("series"),
    )
    k = (F.col("user_id") + F.dayofmonth("date")) % 11
    factor = F.when(k == 0, 0.5).when(k == 1, 1.003).otherwise(1.0)
    before = F.lag("close").over(Window.partitionBy("user_id").orderBy("date"))
    symbol = F.concat(F.lit("U"), F.col("user_id"))
    rows = day.select(
        F.col("date").alias("TradDt"), F.lit("STK").alias("FinInstrmTp"), F.when(F.col("user_id") % 7 != 0, F.concat(F.lit("INE"), F.lpad(F.col("user_id").cast("string"), 6, "0"), F.lit("010"))).alias("ISIN"), symbol.alias("TckrSymb"),
        F.col("series").alias("SctySrs"), F.lit("F1").alias("SsnId"), F.col("open").alias("OpnPric"), F.col("high").alias("HghPric"), F.col("low").alias("LwPric"), F.col("close").alias("ClsPric"),
        F.coalesce(before * factor, "open").alias("PrvsClsgPric"), F.col("volume").alias("TtlTradgVol"), F.col("value").alias("TtlTrfVal"), F.col("volume").alias("TtlNbOfTxsExctd"),
    )
    return rows.unionByName(rows.filter(F.substring("TckrSymb", -1, 1).isin("0", "5")).withColumn("SsnId", F.lit("I1")))


def bars(spark: SparkSession, d: str) -> DataFrame:
    return normalize_primary(raw_primary(spark, d))


BARS = """
day AS (SELECT user_id, CAST(ts AS DATE) AS date, arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close, count(*) AS volume,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value, arg_max(event_type, event_id) AS series FROM events GROUP BY user_id, CAST(ts AS DATE)),
bars AS (SELECT date, CASE WHEN user_id % 7 <> 0 THEN 'INE' || lpad(CAST(user_id AS VARCHAR), 6, '0') || '010' ELSE 'NSE:U' || user_id END AS instrument_key,
  CASE WHEN user_id % 7 <> 0 THEN 'INE' || lpad(CAST(user_id AS VARCHAR), 6, '0') || '010' ELSE '' END AS isin, 'U' || user_id AS symbol, series, open, high, low, close,
  coalesce(lag(close) OVER (PARTITION BY user_id ORDER BY date) * CASE (user_id + day(date)) % 11 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.003::DOUBLE ELSE 1.0::DOUBLE END, open) AS prevclose,
  volume, value, volume AS trades, 'primary' AS source, user_id FROM day)"""


def user(symbol: str = "symbol") -> F.Column:
    return F.substring(symbol, 2, 20).cast("bigint")


def dirty_bars(spark: SparkSession, d: str) -> DataFrame:
    """Bars some of which have a negative close, a NaN open or an empty key."""
    k = (user() * 31 + F.dayofmonth("date")) % 97
    return bars(spark, d).withColumns({"close": F.when(k == 0, -F.col("close")).otherwise(F.col("close")), "open": F.when(k == 1, float("nan")).otherwise(F.col("open")), "instrument_key": F.when(k == 2, "").otherwise(F.col("instrument_key"))})


DIRTY = BARS + """,
dirty AS (SELECT date, CASE WHEN k = 2 THEN '' ELSE instrument_key END AS instrument_key, isin, symbol, series, CASE WHEN k = 1 THEN 'NaN'::DOUBLE ELSE open END AS open, high, low,
  CASE WHEN k = 0 THEN -close ELSE close END AS close, prevclose, volume, value, trades, source, user_id FROM (SELECT *, (user_id * 31 + day(date)) % 97 AS k FROM bars)),
sound AS (SELECT *, coalesce(NOT isnan(open) AND open > 0 AND NOT isnan(high) AND high > 0 AND NOT isnan(low) AND low > 0 AND NOT isnan(close) AND close > 0 AND NOT isnan(prevclose) AND prevclose > 0
  AND volume >= 0 AND high >= low AND low <= close AND close <= high AND instrument_key <> '', FALSE) AS ok FROM dirty)"""


def second_source(spark: SparkSession, d: str) -> DataFrame:
    """The same closes a little off, every tenth user further, every thirteenth absent."""
    u = user()
    return bars(spark, d).filter(u % 13 != 0).withColumns({"close": F.col("close") * F.when(u % 10 == 0, 1.01).otherwise(1.0005), "source": F.lit("second")})


SECOND = BARS + """,
second AS (SELECT date, instrument_key, series, close * CASE WHEN user_id % 10 = 0 THEN 1.01::DOUBLE ELSE 1.0005::DOUBLE END AS close, user_id FROM bars WHERE user_id % 13 <> 0)"""


def quarters(spark: SparkSession, d: str) -> DataFrame:
    """Orders by nation, segment and basis as quarterly and full-year rows."""
    o = load(spark, d, "orders").join(load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"), "o_custkey")
    day, price = F.col("o_orderdate").cast("date"), F.col("o_totalprice").cast("decimal(18,2)")
    key = F.concat_ws("-", "c_nationkey", "c_mktsegment")
    rows = o.select(key.alias("instrument_key"), F.when(F.col("o_orderpriority") < "3", "consolidated").otherwise("standalone").alias("basis"), day.alias("day"), price.alias("price"), "o_orderstatus")
    q_end = F.last_day(F.add_months(F.trunc("day", "quarter"), 2))
    y_end = F.make_date(F.year("day") + F.when(F.month("day") >= 4, 1).otherwise(0), F.lit(3), F.lit(31))
    money = lambda s: F.sum(F.when(F.col("o_orderstatus") == s, F.col("price")).otherwise(0))
    sums = lambda df: df.agg(F.sum("price").cast("double").alias("revenue"), (money("F") - money("P")).cast("double").alias("net_profit"))
    q = sums(rows.groupBy("instrument_key", "basis", q_end.alias("period_end"))).withColumn("fiscal_quarter", fiscal_quarter("period_end"))
    y = sums(rows.groupBy("instrument_key", "basis", y_end.alias("period_end"))).withColumn("fiscal_quarter", F.lit("FY"))
    return q.unionByName(y).withColumn("eps", F.col("net_profit") / 1000)


QUARTERS = """
q0 AS (SELECT c_nationkey || '-' || c_mktsegment AS instrument_key, CASE WHEN o_orderpriority < '3' THEN 'consolidated' ELSE 'standalone' END AS basis, CAST(o_orderdate AS DATE) AS day,
  CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey),
q1 AS (SELECT instrument_key, basis, CAST(last_day(date_trunc('quarter', day) + INTERVAL 2 MONTH) AS DATE) AS period_end, 'Q' AS kind, price, o_orderstatus FROM q0
  UNION ALL SELECT instrument_key, basis, make_date(CAST(year(day) + CASE WHEN month(day) >= 4 THEN 1 ELSE 0 END AS INTEGER), 3, 31), 'FY', price, o_orderstatus FROM q0),
quarters AS (SELECT *, net_profit / 1000 AS eps FROM (SELECT instrument_key, basis, period_end, CASE WHEN kind = 'FY' THEN 'FY' ELSE CASE month(period_end) WHEN 6 THEN 'Q1' WHEN 9 THEN 'Q2' WHEN 12 THEN 'Q3' ELSE 'Q4' END END AS fiscal_quarter,
  CAST(sum(price) AS DOUBLE) AS revenue, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN price ELSE 0 END) - sum(CASE WHEN o_orderstatus = 'P' THEN price ELSE 0 END) AS DOUBLE) AS net_profit
  FROM q1 GROUP BY instrument_key, basis, period_end, kind))"""


def filings(spark: SparkSession, d: str) -> DataFrame:
    """Orders as filed documents: one filing per customer and quarter, a locator unless the status is P."""
    o = load(spark, d, "orders")
    end = F.last_day(F.add_months(F.trunc(F.col("o_orderdate").cast("date"), "quarter"), 2))
    prefix = F.element_at(F.array(*map(F.lit, ("INDAS", "BANKING", "NBFC_INDAS", "LI", "GI", "GOVERNANCE"))), (F.col("o_orderkey") % 6 + 1).cast("int"))
    name = F.concat(F.lit("doc/INTEGRATED_FILING_"), prefix, F.lit("_"), F.col("o_orderkey") % 4000, F.lit(".html"))
    basis = F.when(F.col("o_orderpriority") < "3", "consolidated").when(F.col("o_orderpriority") < "5", "standalone")
    return o.select(F.col("o_custkey").alias("issuer"), end.alias("period_end"), F.concat_ws("|", "o_custkey", end).alias("filing_key"), basis.alias("basis"), F.when(F.col("o_orderstatus") != "P", name).alias("locator"), F.col("o_orderdate").cast("date").alias("broadcast"), F.col("o_orderkey").alias("seq"))


FILINGS = """
filings AS (SELECT o_custkey AS issuer, CAST(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS DATE) AS period_end,
  o_custkey || '|' || CAST(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS DATE) AS filing_key,
  CASE WHEN o_orderpriority < '3' THEN 'consolidated' WHEN o_orderpriority < '5' THEN 'standalone' END AS basis,
  CASE WHEN o_orderstatus <> 'P' THEN 'doc/INTEGRATED_FILING_' || ['INDAS', 'BANKING', 'NBFC_INDAS', 'LI', 'GI', 'GOVERNANCE'][CAST(o_orderkey % 6 + 1 AS INTEGER)] || '_' || (o_orderkey % 4000) || '.html' END AS locator,
  CAST(o_orderdate AS DATE) AS broadcast, o_orderkey AS seq FROM orders)"""

#: Elements that line items stand for, by l_partkey mod their number.
ELEMENTS = ("RevenueFromOperations", "OtherIncome", "FinanceCosts", "DepreciationDepletionAndAmortisationExpense", "ProfitBeforeTax", "CurrentTax", "DeferredTax", "ProfitLossForPeriod", "BasicEarningsLossPerShareFromContinuingOperations", "InterestEarned", "InterestExpended", "NetPremiumWritten")


def facts(spark: SparkSession, d: str) -> DataFrame:
    """Line items as facts of their order; every quantity of 7 is text that does not parse."""
    li = load(spark, d, "lineitem")
    element = F.element_at(F.array(*map(F.lit, ELEMENTS)), (F.col("l_partkey") % len(ELEMENTS) + 1).cast("int"))
    value = F.when(F.col("l_quantity") == 7, "n/a").otherwise(F.concat(F.lit(" "), F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit(" ")))
    return li.select(F.col("l_orderkey").cast("string").alias("filing"), element.alias("element"), F.when(F.col("l_linestatus") == "F", "FourD").otherwise("OneD").alias("context"), value.alias("value"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("ordinal"))


FACTS = f"""
facts AS (SELECT CAST(l_orderkey AS VARCHAR) AS filing, {list(ELEMENTS)}[CAST(l_partkey % {len(ELEMENTS)} + 1 AS INTEGER)] AS element, CASE WHEN l_linestatus = 'F' THEN 'FourD' ELSE 'OneD' END AS context,
  CASE WHEN l_quantity = 7 THEN 'n/a' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS value, CAST(round(l_extendedprice * 100) AS BIGINT) AS ordinal FROM lineitem)"""


def listings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Customers as two overlapping listings."""
    c = load(spark, d, "customer")
    isin = F.concat(F.lit("INE"), F.lpad(F.col("c_custkey").cast("string"), 6, "0"), F.lit("010"))
    face = F.when(F.col("c_custkey") % 4 != 0, (F.col("c_nationkey") + 1).cast("double"))
    a = c.filter("c_custkey % 3 <> 0").select(isin.alias("isin"), F.concat(F.lit("A"), F.col("c_custkey")).alias("symbol"), F.col("c_name").alias("name"), face.alias("face_value"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("mktcap"))
    b = c.filter("c_custkey % 4 <> 1").select(isin.alias("isin"), F.concat(F.lit("B"), F.col("c_custkey")).alias("symbol"), F.upper("c_name").alias("name"), F.lit(10.0).alias("face_value"), F.lit(None).cast("double").alias("mktcap"))
    return a, b


LISTINGS = """
la AS (SELECT 'INE' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '010' AS isin, 'A' || c_custkey AS symbol, c_name AS name, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey + 1 AS DOUBLE) END AS face_value,
  CASE WHEN c_acctbal > 0 THEN c_acctbal END AS mktcap FROM customer WHERE c_custkey % 3 <> 0),
lb AS (SELECT 'INE' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '010' AS isin, 'B' || c_custkey AS symbol, upper(c_name) AS name, CAST(10 AS DOUBLE) AS face_value, CAST(NULL AS DOUBLE) AS mktcap FROM customer WHERE c_custkey % 4 <> 1),
uni AS (SELECT coalesce(la.isin, lb.isin) AS isin, la.symbol AS symbol_a, lb.symbol AS symbol_b, coalesce(la.name, lb.name) AS name, coalesce(la.face_value, lb.face_value) AS face_value, coalesce(la.mktcap, lb.mktcap) AS mktcap,
  la.isin IS NOT NULL AS on_a, lb.isin IS NOT NULL AS on_b FROM la FULL OUTER JOIN lb ON la.isin = lb.isin)"""

TODAY = "2026-05-15"


def registry_state(spark: SparkSession, d: str) -> DataFrame:
    """Customers as registry keys in every state."""
    c = load(spark, d, "customer").filter("c_custkey % 10 <> 9")
    k, known = F.col("c_custkey"), F.col("c_custkey") % 4 != 0
    status = F.when(k % 11 == 0, "inactive").when(known, "classified").otherwise("pending")
    tier = lambda x: F.when(known, x)
    return c.select(
        F.concat(F.lit("K"), k).alias("isin"), F.concat(F.lit("S"), k).alias("symbol"), status.alias("status"), tier(F.concat(F.lit("M"), F.col("c_nationkey") % 5)).alias("macro_sector"), tier(F.col("c_mktsegment")).alias("sector"),
        tier(F.concat(F.lit("I"), F.col("c_nationkey"))).alias("industry"), tier(F.lit("B")).alias("basic_industry"), F.when(known, 0).otherwise((k % 5).cast("int")).alias("attempts"),
        F.when(~known & (k % 5 > 0), F.date_add(F.lit("2026-05-10").cast("date"), (k % 12).cast("int"))).alias("retry_on"), (~known & (k % 5 == 4)).alias("deferred"), (~known & (k % 8 == 0)).alias("backlog"),
        F.when(k % 3 == 0, F.lit("2026-01-20").cast("date")).when(k % 3 == 1, F.lit("2026-04-02").cast("date")).alias("audit_attempt_on"), F.when(k % 11 == 0, 2).when(k % 7 == 0, 1).otherwise(0).alias("absences"),
    )


def registry_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Most customers, some renamed, some new."""
    c, k = load(spark, d, "customer").filter("c_custkey % 50 <> 7"), F.col("c_custkey")
    return c.select(F.concat(F.lit("K"), k).alias("isin"), F.when(k % 37 == 0, F.concat(F.lit("R"), k)).otherwise(F.concat(F.lit("S"), k)).alias("symbol"))


REGISTRY = """
state AS (SELECT 'K' || k AS isin, 'S' || k AS symbol, CASE WHEN k % 11 = 0 THEN 'inactive' WHEN k % 4 <> 0 THEN 'classified' ELSE 'pending' END AS status,
  CASE WHEN k % 4 <> 0 THEN 'M' || (c_nationkey % 5) END AS macro_sector, CASE WHEN k % 4 <> 0 THEN c_mktsegment END AS sector, CASE WHEN k % 4 <> 0 THEN 'I' || c_nationkey END AS industry, CASE WHEN k % 4 <> 0 THEN 'B' END AS basic_industry,
  CAST(CASE WHEN k % 4 <> 0 THEN 0 ELSE k % 5 END AS INTEGER) AS attempts, CASE WHEN k % 4 = 0 AND k % 5 > 0 THEN DATE '2026-05-10' + CAST(k % 12 AS INTEGER) END AS retry_on, k % 4 = 0 AND k % 5 = 4 AS deferred, k % 4 = 0 AND k % 8 = 0 AS backlog,
  CASE WHEN k % 3 = 0 THEN DATE '2026-01-20' WHEN k % 3 = 1 THEN DATE '2026-04-02' END AS audit_attempt_on, CASE WHEN k % 11 = 0 THEN 2 WHEN k % 7 = 0 THEN 1 ELSE 0 END AS absences
  FROM (SELECT *, c_custkey AS k FROM customer) WHERE k % 10 <> 9),
snap AS (SELECT 'K' || c_custkey AS isin, CASE WHEN c_custkey % 37 = 0 THEN 'R' || c_custkey ELSE 'S' || c_custkey END AS symbol FROM customer WHERE c_custkey % 50 <> 7),
rec AS (SELECT coalesce(n.isin, s.isin) AS isin, coalesce(n.symbol, s.symbol) AS symbol,
  CASE WHEN s.isin IS NULL THEN 'pending' WHEN n.isin IS NOT NULL THEN CASE WHEN s.sector IS NOT NULL THEN 'classified' ELSE 'pending' END WHEN s.absences + 1 >= 2 THEN 'inactive' ELSE s.status END AS status,
  s.macro_sector, s.sector, s.industry, s.basic_industry, coalesce(s.attempts, 0) AS attempts, s.retry_on, coalesce(s.deferred, FALSE) AS deferred, coalesce(s.backlog, FALSE) AS backlog, s.audit_attempt_on,
  CASE WHEN s.isin IS NOT NULL AND n.isin IS NULL THEN s.absences + 1 ELSE 0 END AS absences,
  concat_ws(';', CASE WHEN s.isin IS NOT NULL AND n.isin IS NOT NULL AND (s.audit_attempt_on IS NULL OR s.audit_attempt_on < DATE '2026-04-01') THEN 'audit_due' END, CASE WHEN s.isin IS NULL THEN 'new' END,
    CASE WHEN n.isin IS NOT NULL AND s.status = 'inactive' THEN 'reactivated' END, CASE WHEN s.symbol <> n.symbol THEN 'renamed' END,
    CASE WHEN n.isin IS NOT NULL AND s.status = 'pending' AND NOT s.backlog AND NOT s.deferred AND (s.retry_on IS NULL OR s.retry_on <= DATE '2026-05-15') THEN 'retry_due' END) AS reasons
  FROM state s FULL OUTER JOIN snap n ON s.isin = n.isin)"""
