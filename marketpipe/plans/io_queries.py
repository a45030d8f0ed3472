"""Queries through files and streams that Spark derives from the given tables: readers, extraction, sinks, replay."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as S
from ..functions.workspace import fresh_path, ship, written
from ..operators import fundamentals as fun
from ..operators import gates, registry, sectors, store
from ..operators.admission import Limits
from ..operators.master import instrument_master
from ..schemas import BARS
from ..sources import filings as src
from ..sources import prices, reference
from ..streaming import ingest
from . import tables as t
from .queries import BAR_COLUMNS, CALENDAR, KIND, _calendar, query

# ---- readers


@query(f"WITH {t.BARS} SELECT {BAR_COLUMNS} FROM bars")
def primary_csv(spark, d):
    """The primary file written as CSV, read back by its declared columns and normalised."""
    path = fresh_path(spark, "primary-csv")
    t.raw_primary(spark, d).withColumn("Extra", F.lit("x")).write.csv(path, header=True)
    return prices.normalize_primary(prices.read_primary(spark, path))


INDEX_SQL = """SELECT date, 'IDX:' || symbol AS instrument_key, symbol, close, CASE WHEN volume % 2 = 0 THEN open ELSE close END AS open, round(close - CASE WHEN volume % 3 = 0 THEN 0 ELSE round(close - open, 2) END, 4) AS prevclose, CASE WHEN volume % 5 = 0 THEN 0 ELSE volume END AS volume FROM bars"""


@query(f"WITH {t.BARS} {INDEX_SQL}")
def index_csv(spark, d):
    """Index closes with '-' placeholders and padded values."""
    b, dash, v = t.bars(spark, d), F.lit(" - "), F.col("volume")
    text = lambda c: F.format_string(" %.2f ", c)
    raw = b.select(
        F.concat(F.lit(" "), F.lower("symbol"), F.lit(" ")).alias("Index Name"), F.date_format("date", "dd-MM-yyyy").alias("Index Date"), F.when(v % 2 == 0, text(F.col("open"))).otherwise(dash).alias("Open Index Value"), text(F.col("high")).alias("High Index Value"), text(F.col("low")).alias("Low Index Value"),
        text(F.col("close")).alias("Closing Index Value"), F.when(v % 3 == 0, dash).otherwise(text(F.round(F.col("close") - F.col("open"), 2))).alias("Points Change"), F.when(v % 5 == 0, dash).otherwise(v.cast("string")).alias("Volume"), dash.alias("Turnover (Rs. Cr.)"),
    )
    path = fresh_path(spark, "index-csv")
    raw.write.csv(path, header=True)
    out = prices.normalize_indices(prices.read_text_csv(spark, path))
    return out.select("date", "instrument_key", F.upper("symbol").alias("symbol"), "close", "open", F.round("prevclose", 4).alias("prevclose"), "volume")


@query(f"WITH {t.BARS} SELECT date, coalesce(nullif(isin, ''), 'NSE:' || symbol) AS instrument_key, close, CASE WHEN volume % 4 = 0 THEN close ELSE open END AS open, round(value * 100000, 2) AS value, trades FROM bars")
def full_csv(spark, d):
    """The alternate file with padded headers; ISIN by (symbol, series) from the instrument master."""
    b, v = t.bars(spark, d), F.col("volume")
    names = dict(zip(prices.FULL_COLUMNS, ("symbol", "series", "date", "prevclose", "open", "high", "low", "close", "volume", "value", "trades")))
    raw = b.select(*(F.concat(F.lit(" "), F.date_format(c, "dd-MMM-yyyy") if c == "date" else F.when(v % 4 == 0, "-").otherwise(F.format_string("%.2f", c)) if c == "open" else F.format_string("%.4f", c) if c in ("prevclose", "high", "low", "close", "value") else F.col(c).cast("string"), F.lit(" ")).alias(f" {n} ") for n, c in names.items()))
    path = fresh_path(spark, "full-csv")
    raw.write.csv(path, header=True)
    out = prices.normalize_primary(prices.adapt_full(prices.read_text_csv(spark, path), instrument_master(b)))
    return out.select("date", "instrument_key", "close", "open", F.round("value", 2).alias("value"), "trades")


@query(f"WITH {t.BARS} SELECT date, instrument_key, close, open, round(value, 2) AS value FROM bars")
def legacy_csv(spark, d):
    """The legacy file: upper-case month names and its own ISIN."""
    b = t.bars(spark, d)
    cols = dict(zip(prices.LEGACY_COLUMNS, ("symbol", "series", "open", "high", "low", "close", "prevclose", "volume", "value", "date", "trades", "isin")))
    raw = b.select(*((F.upper(F.date_format(c, "dd-MMM-yyyy")) if c == "date" else F.format_string("%.4f", c) if c in ("open", "high", "low", "close", "prevclose", "value") else F.col(c).cast("string")).alias(n) for n, c in cols.items()))
    path = fresh_path(spark, "legacy-csv")
    raw.write.csv(path, header=True)
    return prices.normalize_primary(prices.adapt_legacy(prices.read_text_csv(spark, path))).select("date", "instrument_key", "close", "open", F.round("value", 2).alias("value"))


@query("""SELECT 'INE' || c_custkey AS isin, 'S' || c_custkey AS symbol FROM customer WHERE c_custkey % 3 IN (0, 1)""")
def listed_equities(spark, d):
    c = t.load(spark, d, "customer")
    raw = c.select(F.concat(F.lit(" s"), "c_custkey").alias(" symbol "), F.element_at(F.array(F.lit("EQ"), F.lit("be "), F.lit("N1")), (F.col("c_custkey") % 3 + 1).cast("int")).alias(" Series"), F.concat(F.lit("ine"), "c_custkey").alias("ISIN Number "))
    return reference.listed_equities(raw)


@query("""SELECT 'INE' || c_custkey AS isin, CAST(c_custkey AS VARCHAR) AS scrip_code, 'S' || c_custkey AS symbol, c_name AS name, CASE WHEN c_nationkey > 0 THEN CAST(c_nationkey AS DOUBLE) END AS face_value, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS mktcap FROM customer WHERE c_custkey % 4 <> 0""")
def scrip_master_json(spark, d):
    """The scrip master as JSON lines with text values."""
    c = t.load(spark, d, "customer")
    raw = c.select(F.concat(F.lit("INE"), "c_custkey").alias("ISIN_NUMBER"), F.col("c_custkey").alias("SCRIP_CD"), F.concat(F.lit("S"), "c_custkey").alias("scrip_id"), F.lit(" ").alias("Issuer_Name"), F.col("c_name").alias("Scrip_Name"), F.when(F.col("c_custkey") % 4 == 0, "Suspended").otherwise("Active").alias("Status"), F.lit("Equity").alias("Segment"), F.col("c_nationkey").cast("string").alias("FACE_VALUE"), F.format_string("%.2f", "c_acctbal").alias("Mktcap"))
    path = fresh_path(spark, "scrips-json")
    raw.write.json(path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("ISIN_NUMBER", "SCRIP_CD", "scrip_id", "Issuer_Name", "Scrip_Name", "Status", "Segment", "FACE_VALUE", "Mktcap")])
    return reference.scrip_master(spark.read.schema(schema).json(path))


@query("""WITH o AS (SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS scrip_code, CASE WHEN o_orderstatus <> 'P' THEN 'a' || o_orderkey || '.xml' END AS own, CASE WHEN o_orderkey % 3 = 0 THEN 'a' || o_orderkey || '.xml' WHEN o_orderkey % 3 = 1 THEN 'c' || o_orderkey || '.xml' END AS twin FROM orders)
SELECT scrip_code, own AS locator, CASE WHEN k % 2 = 0 THEN 'standalone' END AS basis FROM o WHERE own IS NOT NULL UNION ALL SELECT scrip_code, twin, 'consolidated' FROM o WHERE twin IS NOT NULL AND twin IS DISTINCT FROM own UNION ALL SELECT scrip_code, NULL, CASE WHEN k % 2 = 0 THEN 'standalone' END FROM o WHERE own IS NULL AND twin IS NULL""")
def filing_discovery(spark, d):
    """One discovery response per customer, parsed into own documents, consolidated twins and pending refs."""
    o, k = t.load(spark, d, "orders"), F.col("o_orderkey")
    own = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("a"), k, F.lit(".html"))).otherwise("")
    twin = F.when(k % 3 == 0, F.concat(F.lit("a"), k, F.lit(".html"))).when(k % 3 == 1, F.concat(F.lit("c"), k, F.lit(".html")))
    row = F.struct(F.col("o_custkey").alias("Scrip_cd"), F.lit("MQ").alias("quarter_code"), F.lit("Audited").alias("audited"), F.col("o_orderdate").cast("string").alias("Fld_CreateDate"), F.when(k % 2 == 0, "Standalone").otherwise("Other").alias("Fld_NatureOfReport"), own.alias("XMLName"), twin.alias("Consol_XMLName"))
    bodies = o.groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_list(row).alias("Table"))).alias("body"))
    return src.discovered(bodies).select("scrip_code", "locator", "basis")


@query(f"""WITH {t.FILINGS}, k AS (SELECT *, CASE WHEN contains(locator, 'FILING_NBFC_INDAS') THEN 'nbfc' WHEN contains(locator, 'FILING_BANKING') THEN 'bank' WHEN contains(locator, 'FILING_LI_') OR contains(locator, 'FILING_GI_') THEN 'insurance' WHEN contains(locator, 'FILING_INDAS') THEN 'general' END AS sector_kind FROM filings)
SELECT CAST(issuer AS VARCHAR) AS issuer, period_end, CASE WHEN basis = 'consolidated' THEN 'consolidated' ELSE 'standalone' END AS basis, seq, sector_kind FROM k WHERE sector_kind IS NOT NULL""")
def integrated_filing_list(spark, d):
    f = t.filings(spark, d)
    row = F.struct(F.col("issuer").cast("string").alias("symbol"), F.upper(F.date_format("period_end", "dd-MMM-yyyy")).alias("qe_Date"), F.when(F.col("basis") == "consolidated", "Consolidated").otherwise("Standalone").alias("consolidated"), F.col("seq").cast("string").alias("seq_Id"), F.lit("Audited").alias("audited"), F.col("locator").alias("xbrl"))
    bodies = f.groupBy("issuer").agg(F.to_json(F.struct(F.collect_list(row).alias("data"))).alias("body"))
    return src.filing_list(bodies).select("issuer", "period_end", "basis", "seq", "sector_kind")


def _documents(spark, d):
    """Each order as an instance document; every 97th is broken off."""
    f = t.facts(spark, d)
    node = F.concat(F.lit("<x:"), "element", F.lit(' contextRef="'), "context", F.lit('">'), "value", F.lit("</x:"), "element", F.lit(">"))
    facts = f.groupBy("filing").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", node.alias("n")))), lambda x: x["n"]), "").alias("nodes"))
    head = F.lit('<xbrl xmlns:x="urn:x"><context id="OneD"><period><startDate>2026-01-01</startDate><endDate>2026-03-31</endDate></period></context>')
    ids = F.concat(F.lit('<x:ISIN contextRef="FourD">INE'), "filing", F.lit('</x:ISIN><x:Symbol contextRef="OneD"> S'), "filing", F.lit(" </x:Symbol>"))
    end = F.when(F.col("filing").cast("bigint") % 97 == 0, "<").otherwise("</xbrl>")
    return facts.select("filing", F.concat(head, ids, "nodes", end).alias("body"))


_FACT = lambda e, c: f"try_cast(arg_min(value, ordinal) FILTER (WHERE element = '{e}' AND context = '{c}') AS DOUBLE)"


@query(f"""WITH {t.FACTS}, {KIND} SELECT f.filing, CASE WHEN k.bad THEN NULL ELSE 'INE' || f.filing END AS isin, CASE WHEN NOT k.bad THEN 90 END AS quarter_days, CASE WHEN NOT k.bad THEN v END AS revenue, k.bad AS parse_error
FROM (SELECT filing, {_FACT('RevenueFromOperations', 'OneD')} AS v FROM facts GROUP BY filing) f JOIN (SELECT filing, CAST(filing AS BIGINT) % 97 = 0 AS bad FROM kinds) k ON k.filing = f.filing""")
def document_facts(spark, d):
    """Documents to facts in one pass, facts to identity, context dates and a number of each filing in one aggregation; a broken document is one error
    row."""
    ship(spark)
    x = src.extract(_documents(spark, d))
    kind, element = F.col("kind"), F.col("element")
    mine = x.filter((kind != "fact") | element.isin("RevenueFromOperations", *src.IDENTITY))
    revenue = fun.first_fact(F.trim("value"), (element == "RevenueFromOperations") & (F.col("context") == "OneD")).alias("revenue")
    out = mine.groupBy("filing").agg(*src.identity_texts(), *src.context_dates(), revenue, F.max(kind == "error").alias("parse_error"), F.max(F.coalesce(element.isin(list(src.IDENTITY)), F.lit(False))).alias("_named"))
    return out.filter("parse_error or _named").select("filing", "isin", S.inclusive_days("quarter_start", "quarter_end").alias("quarter_days"), "revenue", "parse_error")


# ---- balance sheet

_BAL = ("FaceValueOfEquityShareCapital", "PaidUpValueOfEquityShareCapital", "EquityShareCapital", "ShareCapital", "EquityAttributableToOwnersOfParent", "Equity", "BorrowingsCurrent", "BorrowingsNoncurrent", "Borrowings", "CashAndCashEquivalents", "ProfitBeforeTax", "FinanceCosts", "DepreciationDepletionAndAmortisationExpense")
_BALANCE = f"""b0 AS (SELECT CAST(l_orderkey AS VARCHAR) AS filing, {list(_BAL)}[CAST(l_partkey % 13 + 1 AS INTEGER)] AS element, ['OneI', 'OneD', 'FourD'][CAST(l_suppkey % 3 + 1 AS INTEGER)] AS context, CASE WHEN l_quantity = 3 THEN 0 ELSE l_extendedprice END AS v, CAST(round(l_extendedprice * 100) AS BIGINT) AS ordinal FROM lineitem),
b1 AS (SELECT filing, {', '.join(f"arg_min(v, ordinal) FILTER (WHERE element = '{e}' AND context = '{c}') AS {e}_{c}" for e in _BAL for c in ('OneI', 'OneD', 'FourD'))} FROM b0 GROUP BY filing),
b2 AS (SELECT *, CAST(filing AS BIGINT) % 2 = 0 AS general, coalesce(CASE WHEN coalesce(FaceValueOfEquityShareCapital_OneD, FaceValueOfEquityShareCapital_FourD) > 0 THEN coalesce(FaceValueOfEquityShareCapital_OneD, FaceValueOfEquityShareCapital_FourD) END, 10) AS face,
coalesce(EquityShareCapital_OneI, PaidUpValueOfEquityShareCapital_OneD, PaidUpValueOfEquityShareCapital_FourD, ShareCapital_OneI) AS cap FROM b1),
b3 AS (SELECT *, CASE WHEN general THEN CASE WHEN BorrowingsCurrent_OneI IS NOT NULL OR BorrowingsNoncurrent_OneI IS NOT NULL THEN coalesce(BorrowingsCurrent_OneI, 0) + coalesce(BorrowingsNoncurrent_OneI, 0) END ELSE Borrowings_OneI END AS debt FROM b2)"""


@query(f"""WITH {_BALANCE} SELECT filing, face AS face_value, round(CASE WHEN cap > 0 THEN cap END / face, 6) AS shares_outstanding, round(coalesce(nullif(EquityAttributableToOwnersOfParent_OneI, 0), nullif(Equity_OneI, 0)) / 1e7, 9) AS equity, round(nullif(debt, 0) / 1e7, 9) AS total_debt,
round(nullif(CashAndCashEquivalents_OneI, 0) / 1e7, 9) AS cash, round(CASE WHEN general THEN ProfitBeforeTax_FourD + FinanceCosts_FourD + DepreciationDepletionAndAmortisationExpense_FourD END / 1e7, 9) AS ebitda FROM b3""")
def balance_sheet(spark, d):
    li = t.load(spark, d, "lineitem")
    pick = lambda xs, c: F.element_at(F.array(*map(F.lit, xs)), (F.col(c) % len(xs) + 1).cast("int"))
    value = F.when(F.col("l_quantity") == 3, 0.0).otherwise(F.col("l_extendedprice")).cast("string")
    facts = li.select(F.col("l_orderkey").cast("string").alias("filing"), pick(_BAL, "l_partkey").alias("element"), pick(("OneI", "OneD", "FourD"), "l_suppkey").alias("context"), value.alias("value"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("ordinal"))
    ids = facts.select("filing").distinct()
    kinds = ids.withColumn("sector_kind", F.when(F.col("filing").cast("bigint") % 2 == 0, "general").otherwise("bank"))
    out = fun.valuation(facts, kinds, ids.withColumn("exchange_face_value", F.lit(10.0)))
    return out.select("filing", "face_value", F.round("shares_outstanding", 6).alias("shares_outstanding"), *(F.round(c, 9).alias(c) for c in ("equity", "total_debt", "cash", "ebitda")))


# ---- functions


@query("""SELECT o_orderkey, CAST(year(d) + CASE WHEN month(d) >= 4 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year, CASE month(d) WHEN 6 THEN 'Q1' WHEN 9 THEN 'Q2' WHEN 12 THEN 'Q3' WHEN 3 THEN 'Q4' ELSE 'Q?' END AS fiscal_quarter, isodow(d) < 6 AS is_weekday, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start,
month(d) IN (1, 4, 7, 10) AND day(d) >= 5 AS in_season, CASE CAST(o_orderkey % 5 AS INTEGER) WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 7 END AS retry_days, month(d) = 12 AND 1997 <= year(d) AS calendar_due, CAST(date_diff('day', DATE '1995-01-01', d) + 1 AS INTEGER) AS days FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_functions(spark, d):
    o = t.load(spark, d, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    return o.select(
        "o_orderkey", S.fiscal_year("d").alias("fiscal_year"), S.fiscal_quarter("d").alias("fiscal_quarter"), S.is_weekday("d").alias("is_weekday"), S.quarter_start("d").alias("quarter_start"), S.filing_season("d").alias("in_season"),
        S.retry_delay((F.col("o_orderkey") % 5).cast("int")).alias("retry_days"), S.calendar_due("d", F.lit(1997)).alias("calendar_due"), S.inclusive_days(F.lit("1995-01-01").cast("date"), "d").alias("days"),
    )


@query(r"""SELECT p_partkey, replace(upper(trim(p_brand || ' ' || p_type)), ' ', '') AS index_key, trim(regexp_replace(lower(p_name || ' & (' || p_type || ')'), '[^a-z0-9&]+', ' ', 'g')) AS plain, replace(upper(trim(' ino' || p_partkey || 'o ')), 'O', '0') AS isin, substr('INE' || lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 1, 9) AS issuer,
CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '-' END || '|' || p_partkey AS filing_key, p_name || '.xml' AS locator, CAST(p_partkey AS VARCHAR) || '.csv' AS file, CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_type END AS label, CASE WHEN p_size % 4 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS number, sha256(p_name) AS digest FROM part""")
def text_functions(spark, d):
    p, size = t.load(spark, d, "part"), F.col("p_size")
    p = p.withColumn("n", F.when(size % 4 == 0, " - ").otherwise(F.concat(F.lit(" "), size, F.lit(" "))))
    return p.select(
        "p_partkey", S.index_key(F.concat(F.lit(" "), "p_brand", F.lit(" "), "p_type")).alias("index_key"), S.plain_label(F.concat("p_name", F.lit(" & ("), "p_type", F.lit(")"))).alias("plain"), S.normal_isin(F.concat(F.lit(" ino"), "p_partkey", F.lit("o "))).alias("isin"),
        S.issuer(F.concat(F.lit("INE"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))).alias("issuer"), S.joined_key(F.when(size % 2 == 0, F.col("p_brand")), "p_partkey").alias("filing_key"), S.machine_locator(F.concat("p_name", F.lit(".html"))).alias("locator"),
        S.last_segment(F.concat(F.lit("a/b/"), "p_partkey", F.lit(".csv"))).alias("file"), S.or_default(F.when(size % 3 == 0, F.col("p_name")).otherwise(" "), "p_type").alias("label"), S.safe_number("n").alias("number"), S.fingerprint_text("p_name").alias("digest"),
    )


@query("""SELECT c_custkey, round(CASE WHEN c_nationkey <> 0 THEN abs(c_acctbal / c_nationkey - 1) END, 9) AS deviation, round(CASE WHEN c_nationkey > 0 THEN (c_acctbal - c_nationkey) / c_nationkey * 100 END, 6) AS growth, round(c_acctbal / 1e7, 12) AS crore, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS positive,
round(CASE WHEN c_nationkey > 0 AND c_nationkey / 40.0::DOUBLE * 100 <= 50 THEN c_nationkey / 40.0::DOUBLE * 100 END, 9) AS npa_pct, CASE WHEN c_custkey % 2 = 0 OR c_custkey % 3 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 1.5::DOUBLE ELSE 0 END + CASE WHEN c_custkey % 3 = 0 THEN 2.5::DOUBLE ELSE 0 END END AS known_sum,
concat_ws(';', CASE WHEN c_acctbal < 0 THEN 'negative' END, CASE WHEN c_nationkey > 12 THEN 'north' END) AS flags FROM customer""")
def number_functions(spark, d):
    c, k = t.load(spark, d, "customer"), F.col("c_custkey")
    nation = F.col("c_nationkey").cast("double")
    return c.select(
        "c_custkey", F.round(S.deviation("c_acctbal", nation), 9).alias("deviation"), F.round(S.growth_pct("c_acctbal", nation), 6).alias("growth"), F.round(S.crore("c_acctbal"), 12).alias("crore"), S.positive("c_acctbal").alias("positive"),
        F.round(S.plausible_pct(nation / 40.0), 9).alias("npa_pct"), S.sum_known(F.when(k % 2 == 0, 1.5), F.when(k % 3 == 0, 2.5)).alias("known_sum"), S.flags({"north": F.col("c_nationkey") > 12, "negative": F.col("c_acctbal") < 0}).alias("flags"),
    )


@query("""SELECT c_mktsegment AS source, count(*) AS n, count(*) >= CASE WHEN c_mktsegment = 'BUILDING' THEN 1000000 ELSE 10 END AS ok, count(*) FILTER (WHERE c_acctbal < 0) AS failures, count(*) > 0 AND count(*) FILTER (WHERE c_acctbal < 0) >= count(*) AS systemic FROM customer GROUP BY 1""")
def source_canaries(spark, d):
    sizes = t.load(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("source")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("failures"))
    least = {s: 10 for s in ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY")} | {"BUILDING": 1000000}
    return gates.source_canaries(sizes, least).withColumn("systemic", gates.systemic_failure("n", "failures")).select("source", "n", "ok", "failures", "systemic")


@query("""SELECT 'K' || c_custkey AS isin, CASE WHEN c_custkey % 2 = 0 THEN 'classified' ELSE 'pending' END AS status, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS sector, CASE WHEN c_custkey % 2 = 0 THEN 'seed' END AS source, c_mktsegment IN ('FURNITURE') AS cyclical FROM customer""")
def registry_from_seed(spark, d):
    c = t.load(spark, d, "customer")
    seed = c.select(F.concat(F.lit("K"), "c_custkey").alias("isin"), F.lit("S").alias("symbol"), F.lit("M").alias("macro_sector"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("sector"), F.lit("I").alias("industry"), F.lit("B").alias("basic_industry"), "c_mktsegment")
    return registry.from_seed(seed, t.TODAY).select("isin", "status", "sector", "source").join(seed.select("isin", sectors.cyclical("c_mktsegment", ["FURNITURE"]).alias("cyclical")), "isin")


@query(f"""WITH {t.QUARTERS}, l AS (SELECT c_nationkey || '-' || c_mktsegment AS instrument_key, max(c_acctbal) AS mktcap_cr FROM customer WHERE c_nationkey % 2 = 0 GROUP BY 1) SELECT q.instrument_key, q.period_end, q.fiscal_quarter, q.basis, l.mktcap_cr, CASE WHEN l.instrument_key IS NOT NULL THEN 'Y' || q.instrument_key ELSE q.instrument_key END AS symbol
FROM quarters q LEFT JOIN l ON l.instrument_key = q.instrument_key""")
def filing_enrichment(spark, d):
    c = t.load(spark, d, "customer").filter("c_nationkey % 2 = 0")
    listing = c.groupBy(F.concat_ws("-", "c_nationkey", "c_mktsegment").alias("instrument_key")).agg(F.max("c_acctbal").alias("mktcap")).withColumns({"face_value": F.lit(10.0), "symbol": F.concat(F.lit("Y"), "instrument_key")})
    return fun.enriched(t.quarters(spark, d).withColumn("symbol", F.lit("")), listing).select("instrument_key", "period_end", "fiscal_quarter", "basis", "mktcap_cr", "symbol")


# ---- sinks and streams


@query(f"""WITH {t.DIRTY}, m AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN close + 1 ELSE close END AS c2 FROM sound WHERE ok) SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS n, CAST(sum(CAST(c2 AS DECIMAL(18,2))) AS DOUBLE) AS sum_close FROM m GROUP BY 1""")
def store_upsert(spark, d):
    """Day batches upserted into year partitions, a correction twice: running it again changes nothing."""
    clean, _ = gates.quarantine(t.dirty_bars(spark, d))
    path = fresh_path(spark, "store")
    store.upsert(spark, clean, path)
    fix = clean.filter(t.user() % 3 == 0).withColumn("close", F.col("close") + 1)
    for _ in range(2):
        store.upsert(spark, fix, path)
    return store.read_years(spark, path, BARS).groupBy(F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("close").cast("decimal(18,2)")).cast("double").alias("sum_close"))


@query("SELECT 'v2' AS version, TRUE AS first_write, FALSE AS second_write, count(*) AS n FROM customer")
def snapshot_write(spark, d):
    """A snapshot under a version folder, a second write of equal content is left out."""
    path, c = fresh_path(spark, "snapshot"), t.load(spark, d, "customer")
    store.write_snapshot(c.filter("c_custkey % 2 = 0"), path, "v1")
    first = store.write_if_changed(c, path, "v2", ["c_custkey"])
    second = store.write_if_changed(c.repartition(5), path, "v3", ["c_custkey"])
    version = store.current_version(spark, path)
    return store.read_snapshot(spark, path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(version).alias("version"), F.lit(first).alias("first_write"), F.lit(second).alias("second_write"), "n")


@query(f"WITH {t.BARS} SELECT date, count(*) AS n FROM bars WHERE date IN (SELECT DISTINCT date FROM bars ORDER BY date DESC LIMIT 12) GROUP BY date")
def day_deltas(spark, d):
    path = fresh_path(spark, "deltas")
    store.write_day_delta(t.bars(spark, d), path, keep=12)
    return spark.read.parquet(path).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {t.DIRTY}, newest AS (SELECT DISTINCT date FROM sound WHERE ok ORDER BY date DESC LIMIT 9) SELECT date, count(*) FILTER (WHERE ok) AS stored, count(*) FILTER (WHERE NOT ok) AS quarantined, count(*) FILTER (WHERE ok AND date IN (FROM newest)) AS delta FROM sound GROUP BY date")
def stream_replay(spark, d):
    """Day files as a stream into the keyed store and its deltas, then the same files as a second stream: both stay as they were."""
    files, path, side = fresh_path(spark, "day-files"), fresh_path(spark, "stream-store"), fresh_path(spark, "side")
    t.dirty_bars(spark, d).repartition(4, "date").write.parquet(files)
    for k in range(2):
        ingest.run_to_end(ingest.ingest(ingest.day_files(spark, files), path, fresh_path(spark, "cp"), f"{side}-{k}", deltas=f"{side}-deltas", keep=9))
    out = store.read_years(spark, path, BARS).groupBy("date").agg(F.count(F.lit(1)).alias("stored"))
    for name, rows in (("quarantined", spark.read.schema(BARS).parquet(f"{side}-1")), ("delta", ingest.read_deltas(spark, f"{side}-deltas"))):
        out = out.join(rows.groupBy("date").agg(F.count(F.lit(1)).alias(name)), "date", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


@query(f"WITH {t.FILINGS} SELECT filing_key, min(broadcast) AS seen FROM filings GROUP BY 1 HAVING count(locator) = 0")
def pending_filings(spark, d):
    """Filings that wait for a document, tracked over the batches of a stream."""
    files, changes = fresh_path(spark, "refs"), fresh_path(spark, "pending")
    refs = t.filings(spark, d).select("filing_key", "locator", F.col("broadcast").alias("seen"))
    refs.repartition(6).write.parquet(files)
    ingest.run_to_end(ingest.track_pending(spark.readStream.schema(refs.schema).option("maxFilesPerTrigger", 2).parquet(files), changes, fresh_path(spark, "cp")))
    return ingest.pending(spark, changes)


@query(f"WITH {t.FILINGS} SELECT issuer || '|' || locator AS dedup_key, min(CAST(broadcast AS TIMESTAMP)) AS seen FROM filings WHERE locator IS NOT NULL GROUP BY 1")
def documents_once(spark, d):
    """Each (issuer, document) once over a stream that brings all of them again, years later."""
    files, out, ledger = fresh_path(spark, "docs"), fresh_path(spark, "once"), fresh_path(spark, "ledger")
    f = t.filings(spark, d).filter("locator is not null").groupBy(S.joined_key("issuer", "locator").alias("dedup_key")).agg(F.min("broadcast").cast("timestamp").alias("seen"))
    again = f.withColumn("seen", F.col("seen") + F.expr("interval 4000 days"))
    for rows in (f, again):  # a stream takes older files first
        rows.repartition(3).write.mode("append").parquet(files)
    s = spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 2).parquet(files)
    ingest.run_to_end(ingest.once_per_document(s, "seen", out, ledger, fresh_path(spark, "cp")))
    return spark.read.schema(f.schema).parquet(out).select("dedup_key", "seen")


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) - 1 FROM events) GROUP BY 1, 2")
def event_windows(spark, d):
    """Tumbling one-day windows over the events as a stream; windows that the watermark has passed are final."""
    files, out = fresh_path(spark, "events"), fresh_path(spark, "windows")
    e = t.load(spark, d, "events").select("ts", "event_type")
    e.repartitionByRange(4, "ts").write.parquet(files)
    s = ingest.windowed_counts(spark.readStream.schema(e.schema).parquet(files), "ts", by=["event_type"])
    ingest.run_to_end(s.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", fresh_path(spark, "cp")).trigger(availableNow=True).start())
    end = e.agg((F.max("ts").cast("date") - F.expr("interval 1 day")).cast("date").alias("_end"))
    return spark.read.parquet(out).crossJoin(F.broadcast(end)).filter("day < _end").drop("_end")  # one row


_SHORT = """have AS (SELECT date, series, count(*) AS n FROM bars WHERE day(date) % 7 <> 0 AND (day(date) % 5 <> 0 OR user_id % 2 = 0) GROUP BY 1, 2)"""
_MEANS = """tr AS (SELECT * FROM cal WHERE is_trading), seen AS (SELECT c.series, c.n, t.ordinal FROM {0} c JOIN tr t ON c.date = t.date), means AS (SELECT t.date, s.series, avg(s.n) AS mean FROM seen s JOIN tr t ON s.ordinal BETWEEN t.ordinal - 10 AND t.ordinal - 1 GROUP BY 1, 2)"""


@query(f"""WITH {t.BARS}, {CALENDAR}, {_SHORT}, {_MEANS.format('have')}, s AS (SELECT h.date, sum(h.n) >= 0.85 * sum(m.mean) AS complete FROM have h JOIN means m ON m.date = h.date AND m.series = h.series GROUP BY 1)
SELECT d.date, CASE WHEN d.date NOT IN (SELECT date FROM have) THEN 'fill' WHEN NOT coalesce(s.complete, TRUE) THEN 'top_up' ELSE 'skip' END AS action FROM (SELECT DISTINCT date FROM bars) d LEFT JOIN s ON s.date = d.date""")
def catch_up(spark, d):
    """Days to replay: missing ones are filled, those short of their trailing means topped up."""
    b, day = t.bars(spark, d), F.dayofmonth("date")
    have = gates.series_counts(b.filter((day % 7 != 0) & ((day % 5 != 0) | (t.user() % 2 == 0))))
    return ingest.catch_up(spark, b.select("date").distinct(), have, gates.trailing_means(have, _calendar(spark)))


#: Thresholds scaled to the small tables; the defaults are those for a full exchange.
LIMITS = Limits(least=1, most=5000, floor=2, band=0.6)


def _backfill_sql(n, target):
    """The days one after the other, in a chain of tables: h holds the counts of the store after each day, so that a refused day is not in
    the means (m) of later ones."""
    steps = f"""WITH {t.DIRTY}, {CALENDAR}, days AS (SELECT date, ordinal FROM cal WHERE is_trading AND date <= DATE '{target}' ORDER BY date DESC LIMIT {n}), old AS (SELECT date, series, instrument_key FROM sound WHERE ok AND (day(date) % 4 = 1 OR day(date) % 4 = 2 AND user_id % 2 = 0)),
raw AS (SELECT r.* FROM (SELECT *, CASE WHEN day(date) = 22 AND user_id % 50 = 7 THEN CAST(date + 1 AS DATE) ELSE date END AS asked, day(date) = 25 AND user_id % 10 = 3 AS broken FROM sound WHERE day(date) % 6 <> 0 AND NOT (day(date) = 17 AND series = 'view')) r JOIN days d ON d.date = r.asked),
whole AS (SELECT asked AS date, count(*) AS n_rows, count(*) FILTER (WHERE NOT ok) AS bad, count(*) FILTER (WHERE asked <> date) AS wrong, count(*) FILTER (WHERE ok AND broken) AS broken FROM raw GROUP BY 1),
rawc AS (SELECT asked AS date, series, count(*) AS n FROM raw GROUP BY 1, 2), clean AS (SELECT date, instrument_key, series FROM raw WHERE ok AND asked = date),
after AS (SELECT c.ordinal, x.series, count(*) AS n FROM (SELECT date, instrument_key, series FROM clean UNION SELECT date, instrument_key, series FROM old WHERE date IN (SELECT date FROM clean)) x JOIN cal c ON c.date = x.date GROUP BY 1, 2),
h0 AS (SELECT c.ordinal, o.series, count(*) AS n FROM old o JOIN cal c ON c.date = o.date WHERE c.is_trading GROUP BY 1, 2)"""
    for k in range(1, n + 1):
        h, m = f"h{k - 1}", f"m{k}"
        steps += f""",
d{k} AS (SELECT date, ordinal FROM days WHERE ordinal = (SELECT max(ordinal) FROM days) - {n - k}), m{k} AS (SELECT h.series, avg(h.n) AS mean FROM {h} h, d{k} d WHERE h.ordinal BETWEEN d.ordinal - 10 AND d.ordinal - 1 GROUP BY 1),
q{k} AS (SELECT d.date, d.ordinal, w.*EXCLUDE (date), EXISTS (FROM {h} WHERE ordinal = d.ordinal) AS present, (SELECT coalesce(sum(h.n) >= 0.85 * sum(m.mean), TRUE) FROM {h} h JOIN {m} m ON m.series = h.series, d{k} x WHERE h.ordinal = x.ordinal) AS complete,
  (SELECT count(*) FROM {m} m LEFT JOIN (SELECT r.* FROM rawc r JOIN d{k} x ON x.date = r.date) r ON r.series = m.series WHERE m.mean >= {LIMITS.floor} AND (r.n IS NULL OR abs(r.n - m.mean) / m.mean > CASE WHEN m.mean >= {LIMITS.large} THEN {LIMITS.tight} ELSE {LIMITS.band} END)) AS off FROM d{k} d LEFT JOIN whole w ON w.date = d.date),
v{k} AS MATERIALIZED (SELECT *, CASE WHEN present AND complete THEN 'idempotent' WHEN n_rows IS NULL THEN CASE WHEN date = DATE '{target}' THEN 'not_yet' ELSE 'failed' END WHEN wrong > 0 OR n_rows NOT BETWEEN 1 AND 5000 OR off > 0 OR bad = n_rows OR broken > 0 THEN 'failed' WHEN present THEN 'success_topped_up' ELSE 'success' END AS status,
  n_rows IS NOT NULL AND NOT (present AND complete) AND wrong = 0 AND off = 0 AS evidence FROM q{k}),
h{k} AS MATERIALIZED (SELECT h.* FROM {h} h, v{k} v WHERE NOT (h.ordinal = v.ordinal AND v.status LIKE 'success%') UNION ALL SELECT a.* FROM after a JOIN v{k} v ON a.ordinal = v.ordinal AND v.status LIKE 'success%')"""
    every = " UNION ALL ".join(f"SELECT date, status, coalesce(n_rows, 0) AS n_rows, coalesce(bad, 0) AS n_quarantined, evidence FROM v{k}" for k in range(1, n + 1))
    return f"""{steps}, st AS ({every}),
kept AS (SELECT date, instrument_key FROM old UNION SELECT clean.date, clean.instrument_key FROM clean JOIN st ON st.date = clean.date WHERE st.status LIKE 'success%')"""


def _prepared(spark, d, n, target, side=None):
    """A store with some full days and some short ones, then the backfill of the last n trading days from a source with holes: a day that
    lacks a series, a day with rows of another date, a day with a broken contract."""
    ship(spark)
    path, day, u = fresh_path(spark, "backfill-store"), F.dayofmonth("date"), t.user()
    raw = written(t.dirty_bars(spark, d), "backfill-raw")  # what came, for the store and for each run
    clean, _ = gates.quarantine(raw)
    store.upsert(spark, clean.filter((day % 4 == 1) | ((day % 4 == 2) & (u % 2 == 0))), path)
    raw = raw.filter((day % 6 != 0) & ~((day == 17) & (F.col("series") == "view")))
    raw = raw.withColumns({"asked": F.when((day == 22) & (u % 50 == 7), F.date_add("date", 1)).otherwise(F.col("date")), "trades": F.when((day == 25) & (u % 10 == 3), -1).otherwise(F.col("trades"))})
    run = lambda: ingest.backfill(raw, path, _calendar(spark), target, n, LIMITS, "asked", evidence=side and f"{side}-evidence", deltas=side and f"{side}-deltas")
    return path, run


@query(_backfill_sql(20, "2024-01-30") + """, bad AS (SELECT raw.asked AS date, count(*) AS n FROM raw JOIN st ON st.date = raw.asked WHERE NOT raw.ok AND st.evidence GROUP BY 1), good AS (SELECT clean.date, count(*) AS n FROM clean JOIN st ON st.date = clean.date WHERE st.status LIKE 'success%' GROUP BY 1)
SELECT st.date, st.status, st.n_rows, st.n_quarantined, count(kept.date) AS stored, coalesce(any_value(bad.n), 0) AS evidence, coalesce(any_value(good.n), 0) AS delta FROM st LEFT JOIN kept ON kept.date = st.date LEFT JOIN bad ON bad.date = st.date LEFT JOIN good ON good.date = st.date GROUP BY 1, 2, 3, 4""")
def backfill(spark, d):
    """Twenty trading days in one job, each held against the days admitted before it; what the store, the evidence and the deltas hold."""
    side = fresh_path(spark, "backfill")
    path, run = _prepared(spark, d, 20, "2024-01-30", side)
    out = run().drop("dataset", "reason")
    for name, day, held in (("stored", "date", store.read_years(spark, path, BARS)), ("evidence", "day", ingest.read_evidence(spark, f"{side}-evidence")), ("delta", "date", spark.read.schema(BARS).parquet(f"{side}-deltas"))):
        out = out.join(held.groupBy(F.col(day).alias("date")).agg(F.count(F.lit(1)).alias(name)), "date", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


@query(_backfill_sql(20, "2024-01-30") + " SELECT st.date, count(kept.date) AS stored FROM st LEFT JOIN kept ON kept.date = st.date GROUP BY st.date")
def backfill_resumed(spark, d):
    """A second run over the same days leaves the store as the first one did."""
    path, run = _prepared(spark, d, 20, "2024-01-30")
    run()
    statuses = run()
    held = store.read_years(spark, path, BARS).groupBy("date").agg(F.count(F.lit(1)).alias("stored"))
    return statuses.join(held, "date", "left").select("date", F.coalesce("stored", F.lit(0)).alias("stored"))


@query(_backfill_sql(7, "2024-01-31") + " SELECT date, status FROM st")
def catch_up_replay(spark, d):
    """The catch-up window of seven trading days, replayed: past days are strict, the target day may be late."""
    _, run = _prepared(spark, d, 7, "2024-01-31")
    return run().select("date", "status")


@query(_backfill_sql(7, "2024-01-31") + " SELECT date, n_rows FROM st WHERE status = 'failed' AND date <> DATE '2024-01-31'")
def window_failures(spark, d):
    """The side table of failed past days; a later run replaces it."""
    side = fresh_path(spark, "window-failures")
    for target in ("2024-01-30", "2024-01-31"):
        _, run = _prepared(spark, d, 7, target)
        failures = store.write_failures(run(), target, side)
    return failures.select("date", "n_rows")


@query(f"WITH {t.DIRTY} SELECT 'bars' AS dataset, CAST(year(date) AS INTEGER) AS year, count(*) AS n_rows, max(date) AS max_date FROM sound WHERE ok GROUP BY 2")
def stored_statistics(spark, d):
    """Rows and newest day of each year, from the counts that each upsert commits with its rows."""
    clean, _ = gates.quarantine(t.dirty_bars(spark, d))
    path, day = fresh_path(spark, "counted-store"), F.dayofmonth("date")
    for part in (clean.filter(day % 3 < 2), clean.filter(day % 3 > 0)):
        store.upsert(spark, part, path)
    return store.stored_statistics(spark, path, "bars")


@query(f"""WITH {t.BARS}, x AS (SELECT unnest(['first', 'second']) AS run) SELECT run, 'success' AS status, count(*) AS symbol_count, count(*) FILTER (WHERE close < 20) AS quarantined_count FROM bars, x GROUP BY run""")
def status_log(spark, d):
    """One status row for each run, appended as JSON and read back."""
    path, b = fresh_path(spark, "status"), t.bars(spark, d)
    for run in ("first", "second"):
        store.append_status(b.agg(F.lit(run).alias("run"), F.lit("success").alias("status"), F.count(F.lit(1)).alias("symbol_count"), F.count_if(F.col("close") < 20).alias("quarantined_count")), path)
    return spark.read.schema("run string, status string, symbol_count bigint, quarantined_count bigint").json(path)


@query(f"WITH {t.QUARTERS} SELECT instrument_key, period_end, fiscal_quarter, basis FROM quarters")
def fundamentals_order(spark, d):
    return fun.sorted_rows(t.quarters(spark, d)).select("instrument_key", "period_end", "fiscal_quarter", "basis")


@query(f"WITH {t.FILINGS} SELECT count(DISTINCT filing_key) AS filings, count(*) FILTER (WHERE date_diff('day', DATE '1995-01-01', broadcast) % 7 = 6) AS saturdays FROM filings")
def filing_calendar(spark, d):
    f = t.filings(spark, d)
    return f.agg(F.count_distinct("filing_key").alias("filings"), F.count_if(F.weekday("broadcast") == 5).alias("saturdays"))
