"""One query per operator over the given tables, each with the same query in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.workspace import fresh_path, written
from ..operators import calendar as cal
from ..operators import filings as fil
from ..operators import fundamentals as fun
from ..operators import gates, master, quality, registry, sectors, store
from ..sources import reference
from . import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- store

BAR_COLUMNS = "date, instrument_key, isin, symbol, series, open, high, low, close, prevclose, volume, value, trades, source"


@query(f"WITH {t.BARS} SELECT {BAR_COLUMNS} FROM bars")
def normalize_primary(spark, d):
    return t.bars(spark, d)


@query(f"""WITH {t.DIRTY}, m AS (SELECT date, instrument_key, series, CASE WHEN user_id % 3 = 0 THEN close + 1 ELSE close END AS close FROM sound WHERE ok),
w AS (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY date DESC) AS n FROM m)
SELECT series, count(*) AS n_rows, count(DISTINCT instrument_key) AS n_keys, CAST(sum(CAST(close AS DECIMAL(18,2))) AS DOUBLE) AS sum_close FROM w WHERE n <= 5 GROUP BY series""")
def trailing_window(spark, d):
    """Quarantine, upsert of a correction batch, last five rows per key, by series."""
    clean, _ = gates.quarantine(t.dirty_bars(spark, d))
    fixed = clean.filter(t.user() % 3 == 0).withColumn("close", F.col("close") + 1)
    rows = store.trailing_rows(store.merged(clean, fixed, ("date", "instrument_key")), "instrument_key", 5)
    return rows.groupBy("series").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("instrument_key").alias("n_keys"), F.sum(F.col("close").cast("decimal(18,2)")).cast("double").alias("sum_close"))


@query(f"WITH {t.DIRTY} SELECT series, ok, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM sound GROUP BY series, ok")
def quarantine_split(spark, d):
    return gates.tagged(t.dirty_bars(spark, d)).groupBy("series", "ok").agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"))


_REQUIRED = "date instrument_key symbol series open high low close prevclose volume value trades source".split()
_CONTRACT = [f"SELECT 'null:{c}' AS rule, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM broken" for c in _REQUIRED]
_CONTRACT += [f"SELECT 'negative:{c}', count(*) FILTER (WHERE {c} < 0 AND NOT isnan(CAST({c} AS DOUBLE))) FROM broken" for c in "open high low close prevclose volume value trades".split()]


@query(f"WITH {t.DIRTY}, broken AS (SELECT * REPLACE (CASE WHEN user_id % 8 = 0 THEN NULL ELSE series END AS series, CASE WHEN day(date) % 9 = 0 THEN -volume ELSE volume END AS volume) FROM dirty) SELECT 'extra:extra' AS rule, 1 AS violations UNION ALL " + " UNION ALL ".join(_CONTRACT))
def contract_check(spark, d):
    broken = t.dirty_bars(spark, d).withColumns({"series": F.when(t.user() % 8 != 0, F.col("series")), "volume": F.when(F.dayofmonth("date") % 9 == 0, -F.col("volume")).otherwise(F.col("volume"))})
    return gates.contract(broken.withColumn("extra", F.lit(1)))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS n FROM lineitem) WHERE n = 1""")
def keep_last_per_key(spark, d):
    rows = store.keep_last(t.load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
ORDER BY l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem) WHERE n = 1""")
def keep_first_per_key(spark, d):
    rows = store.keep_first(t.load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return store.duplicate_keys(t.load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""WITH e AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_suppkey, 0 AS b FROM lineitem WHERE l_suppkey % 3 <> 1), i AS (SELECT l_orderkey, l_linenumber, l_quantity + 100, l_extendedprice, l_suppkey, 1 FROM lineitem WHERE l_suppkey % 3 <> 0),
u AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY b DESC, l_extendedprice DESC, l_suppkey DESC, l_quantity DESC) AS n FROM (SELECT * FROM e UNION ALL SELECT * FROM i))
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_suppkey FROM u WHERE n = 1""")
def upsert_by_key(spark, d):
    li = t.load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_suppkey")
    new = li.filter("l_suppkey % 3 <> 0").withColumn("l_quantity", F.col("l_quantity") + 100)
    return store.merged(li.filter("l_suppkey % 3 <> 1"), new, ["l_orderkey", "l_linenumber"], ["l_extendedprice", "l_suppkey", "l_quantity"])


@query("""WITH l AS (SELECT o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderkey, 0 AS b FROM orders WHERE o_orderkey % 3 <> 1 UNION ALL SELECT o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderkey, 1 FROM orders WHERE o_orderkey % 3 <> 0)
SELECT o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY b, o_totalprice, o_orderkey) AS n FROM l) WHERE n = 1""")
def append_ledger(spark, d):
    o = t.load(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderkey")
    return store.append_ledger(o.filter("o_orderkey % 3 <> 1"), o.filter("o_orderkey % 3 <> 0"), ["o_custkey", "o_orderstatus", "o_orderpriority"])


@query("WITH o AS (SELECT *, CAST(o_orderdate AS DATE) AS date FROM orders), k AS (SELECT DISTINCT date FROM o ORDER BY date DESC LIMIT 35) SELECT date, count(*) AS n, max(o_orderkey) AS last_key FROM o WHERE date IN (SELECT date FROM k) GROUP BY date")
def newest_day_partitions(spark, d):
    o = t.load(spark, d, "orders").withColumn("date", F.col("o_orderdate").cast("date"))
    return store.newest_partitions(o, 35).groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last_key"))


@query("SELECT 'orders' AS dataset, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows, CAST(max(o_orderdate) AS DATE) AS max_date FROM orders GROUP BY 1, 2")
def partition_statistics(spark, d):
    return store.partition_statistics(t.load(spark, d, "orders").withColumn("date", F.col("o_orderdate").cast("date")), "orders")


@query("""WITH s AS (SELECT count(*) AS n_rows, sum(('0x' || substr(h, 1, 12))::BIGINT) AS s0, sum(('0x' || substr(h, 13, 12))::BIGINT) AS s1, sum(('0x' || substr(h, 25, 12))::BIGINT) AS s2, sum(('0x' || substr(h, 37, 12))::BIGINT) AS s3, sum(('0x' || substr(h, 49, 12))::BIGINT) AS s4
FROM (SELECT sha256(concat_ws('|', CAST(c_custkey AS VARCHAR), c_mktsegment, c_name, CAST(c_nationkey AS VARCHAR))) AS h FROM customer))
SELECT n_rows, sha256(concat_ws('|', CAST(n_rows AS VARCHAR), CAST(s0 AS VARCHAR), CAST(s1 AS VARCHAR), CAST(s2 AS VARCHAR), CAST(s3 AS VARCHAR), CAST(s4 AS VARCHAR))) AS fingerprint FROM s""")
def table_fingerprint(spark, d):
    return store.fingerprint(t.load(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))


@query("""WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders), b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 = 3 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 500 <> 7)
SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_a, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_b, FALSE AS unchanged""")
def content_unchanged(spark, d):
    o = t.load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    b = o.filter("o_orderkey % 500 <> 7").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 1000 == 3, "X").otherwise(F.col("o_orderstatus")))
    return store.unchanged(o, b)


@query("""WITH s AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'small' ELSE 'large' END AS dataset, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_orderdate AS DATE) AS date, o_orderkey FROM orders),
live AS (SELECT dataset, year, count(*) AS n_rows, max(date) AS max_date FROM s GROUP BY ALL), new AS (SELECT dataset, year, count(*) AS n_rows, max(date) AS max_date FROM s WHERE NOT (dataset = 'small' AND year = 1997) AND NOT (dataset = 'large' AND year = 1998 AND o_orderkey % 7 = 0) GROUP BY ALL)
SELECT l.dataset, l.year, l.n_rows, n.n_rows AS new_rows, CASE WHEN n.n_rows IS NULL THEN 'missing_partition' WHEN n.n_rows < l.n_rows THEN 'fewer_rows' WHEN n.max_date < l.max_date THEN 'date_regression' ELSE 'ok' END AS verdict
FROM live l LEFT JOIN new n ON l.dataset = n.dataset AND l.year = n.year""")
def no_shrink_compare(spark, d):
    s = t.load(spark, d, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, "small").otherwise("large").alias("dataset"), F.col("o_orderdate").cast("date").alias("date"), "o_orderkey")
    stats = lambda df: df.groupBy("dataset", F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("n_rows"), F.max("date").alias("max_date"))
    y = F.year("date")
    new = s.filter(~((F.col("dataset") == "small") & (y == 1997)) & ~((F.col("dataset") == "large") & (y == 1998) & (F.col("o_orderkey") % 7 == 0)))
    return quality.no_shrink(stats(s), stats(new), ["small", "large"])


# ---- calendar

CALENDAR = """
cal0 AS (SELECT CAST(x AS DATE) AS date FROM range(DATE '2023-12-25', DATE '2024-02-06', INTERVAL 1 DAY) r(x)),
cal1 AS (SELECT date, date = DATE '2024-01-20' OR (isodow(date) < 6 AND date NOT IN (DATE '2024-01-01', DATE '2024-01-26')) AS is_trading FROM cal0),
cal AS (SELECT date, is_trading, CASE WHEN is_trading THEN count(*) FILTER (WHERE is_trading) OVER (ORDER BY date) END AS ordinal, max(CASE WHEN is_trading THEN date END) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM cal1)"""


def _calendar(spark):
    days = lambda *x: spark.createDataFrame([(v,) for v in x], "d string").select(F.col("d").cast("date").alias("date"))
    return cal.trading_calendar(spark, "2023-12-25", "2024-02-05", days("2024-01-01", "2024-01-26"), days("2024-01-20"))


@query(f"WITH {t.BARS}, {CALENDAR} SELECT c.*, CAST(count(b.date) AS BIGINT) AS n_bars FROM cal c LEFT JOIN bars b ON b.date = c.date GROUP BY ALL")
def trading_calendar(spark, d):
    """The calendar with the number of stored bars of each day."""
    stored = t.bars(spark, d).groupBy("date").agg(F.count(F.lit(1)).alias("n_bars"))
    return _calendar(spark).join(stored, "date", "left").withColumn("n_bars", F.coalesce("n_bars", F.lit(0)))


@query(f"WITH {t.BARS}, {CALENDAR}, tr AS (SELECT * FROM cal WHERE is_trading) SELECT b.instrument_key, b.date, p.date AS back FROM bars b JOIN tr c ON b.date = c.date LEFT JOIN tr p ON p.ordinal = c.ordinal - 3")
def three_days_back(spark, d):
    return t.bars(spark, d).join(cal.nth_back(_calendar(spark), 3), "date").select("instrument_key", "date", "back")


@query(f"""WITH {t.BARS}, e AS (SELECT DISTINCT date FROM bars ORDER BY date DESC LIMIT 20), f AS (SELECT instrument_key, min(date) AS first FROM bars GROUP BY 1)
SELECT f.instrument_key, e.date FROM f JOIN e ON e.date >= f.first LEFT JOIN bars b ON b.instrument_key = f.instrument_key AND b.date = e.date WHERE b.date IS NULL""")
def trading_day_holes(spark, d):
    b = t.bars(spark, d)
    return cal.holes(b, b.select("date").distinct(), "instrument_key", 20)


@query(f"WITH {t.BARS}, l AS (SELECT series AS dataset, max(date) AS max_date FROM bars WHERE date < DATE '2024-01-20' OR series <> 'error' GROUP BY 1) SELECT *, max_date < DATE '2024-01-30' AS stale FROM l")
def freshness_status(spark, d):
    rows = t.bars(spark, d).filter("date < date'2024-01-20' or series <> 'error'")
    return cal.freshness(rows.groupBy(F.col("series").alias("dataset")).agg(F.max("date").alias("max_date")), "2024-01-30")


@query(f"WITH {t.BARS}, {CALENDAR}, h AS (SELECT DISTINCT date FROM bars WHERE day(date) % 6 <> 0) SELECT c.date, CASE WHEN h.date IS NOT NULL THEN 'ok' WHEN c.date >= DATE '2024-02-02' THEN 'not_yet' ELSE 'failed' END AS state FROM cal c LEFT JOIN h ON h.date = c.date WHERE c.is_trading")
def day_states(spark, d):
    stored = t.bars(spark, d).filter(F.dayofmonth("date") % 6 != 0)
    return cal.day_states(stored, _calendar(spark).filter("is_trading").select("date"), "2024-02-02")


# ---- gates

COUNTS = "cnt AS (SELECT date, series, count(*) AS n FROM bars WHERE NOT (series = 'error' AND day(date) % 9 = 0) GROUP BY 1, 2)"
MEANS = """tr AS (SELECT * FROM cal WHERE is_trading), seen AS (SELECT c.series, c.n, t.ordinal FROM cnt c JOIN tr t ON c.date = t.date),
means AS (SELECT t.date, s.series, avg(s.n) AS mean FROM seen s JOIN tr t ON s.ordinal BETWEEN t.ordinal - 10 AND t.ordinal - 1 GROUP BY 1, 2)"""


def _counts(spark, d):
    return gates.series_counts(t.bars(spark, d).filter(~((F.col("series") == "error") & (F.dayofmonth("date") % 9 == 0))))


@query(f"WITH {t.BARS}, {CALENDAR}, {COUNTS}, {MEANS} SELECT date, series, round(mean, 6) AS mean FROM means")
def trailing_series_means(spark, d):
    return gates.trailing_means(_counts(spark, d), _calendar(spark)).withColumn("mean", F.round("mean", 6))


@query(f"""WITH {t.BARS}, {CALENDAR}, {COUNTS}, {MEANS}, j AS (SELECT coalesce(c.date, m.date) AS date, coalesce(c.series, m.series) AS series, coalesce(c.n, 0) AS n, m.mean
FROM cnt c FULL OUTER JOIN (SELECT * FROM means WHERE date IN (SELECT date FROM cnt)) m ON c.date = m.date AND c.series = m.series)
SELECT date, series, n, round(mean, 6) AS mean, CASE WHEN mean IS NULL THEN 'no_history' WHEN mean < 20 THEN 'exempt' WHEN n = 0 THEN 'absent' WHEN abs(n - mean) / mean > CASE WHEN mean >= 27 THEN 0.15 ELSE 0.5 END THEN 'deviates' ELSE 'ok' END AS verdict FROM j""")
def series_deviation_gate(spark, d):
    """Thresholds scaled to the small tables; the defaults are those for a full exchange."""
    counts = _counts(spark, d)
    return gates.series_deviation_gate(counts, gates.trailing_means(counts, _calendar(spark)), floor=20, large=27).withColumn("mean", F.round("mean", 6))


@query(f"""WITH {t.BARS}, {CALENDAR}, {COUNTS}, {MEANS}, s AS (SELECT c.date, CAST(sum(c.n) AS BIGINT) AS stored, sum(m.mean) AS expected FROM cnt c JOIN means m ON c.date = m.date AND c.series = m.series GROUP BY 1)
SELECT d.date, coalesce(stored, 0) AS stored, round(coalesce(expected, 0), 6) AS expected, coalesce(stored >= 0.85 * expected, TRUE) AS complete FROM (SELECT DISTINCT date FROM cnt) d LEFT JOIN s ON s.date = d.date""")
def completeness_topup(spark, d):
    counts = _counts(spark, d)
    return gates.completeness(counts, gates.trailing_means(counts, _calendar(spark))).withColumn("expected", F.round("expected", 6))


@query(f"WITH {t.BARS} SELECT date, count(*) AS n_rows, count(*) BETWEEN 120 AND 140 AS passed FROM bars GROUP BY date")
def row_count_gate(spark, d):
    return gates.row_count_gate(t.bars(spark, d), 120, 140, ["date"])


@query(f"""WITH {t.BARS}, x AS (SELECT * FROM bars WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-11'), w AS (SELECT DISTINCT date FROM x WHERE date <> DATE '2024-01-08')
SELECT count(*) FILTER (WHERE date <> DATE '2024-01-08') AS wrong_rows, (SELECT string_agg(CAST(date AS VARCHAR), ';' ORDER BY date) FROM (SELECT date FROM w ORDER BY date LIMIT 3)) AS sample, count(*) FILTER (WHERE date <> DATE '2024-01-08') > 0 AS rejected FROM x""")
def wrong_date_guard(spark, d):
    return gates.wrong_dates(t.bars(spark, d).filter("date between '2024-01-08' and '2024-01-11'"), "2024-01-08")


@query(f"WITH {t.DIRTY} SELECT count(*) AS n_rows, count(*) FILTER (WHERE ok) AS n_clean, count(*) > 0 AND count(*) FILTER (WHERE ok) = 0 AS failed FROM sound")
def all_bad_day(spark, d):
    return gates.all_bad(t.dirty_bars(spark, d))


@query(f"""WITH {t.BARS}, {CALENDAR}, {COUNTS}, {MEANS}, s AS (SELECT c.date, sum(c.n) >= 0.85 * sum(m.mean) AS complete FROM cnt c JOIN means m ON c.date = m.date AND c.series = m.series GROUP BY 1), r AS (SELECT date, count(*) AS n FROM bars GROUP BY 1)
SELECT k.date, CASE WHEN NOT k.is_trading THEN 'holiday' WHEN r.n IS NOT NULL AND coalesce(s.complete, TRUE) THEN 'idempotent' WHEN coalesce(r.n, 0) = 0 THEN 'not_yet' WHEN r.n > 142 THEN 'failed' WHEN r.n IS NOT NULL THEN 'success_topped_up' ELSE 'success' END AS status
FROM cal k LEFT JOIN r ON r.date = k.date LEFT JOIN s ON s.date = k.date""")
def day_status(spark, d):
    counts = _counts(spark, d)
    done = gates.completeness(counts, gates.trailing_means(counts, _calendar(spark))).select("date", "complete")
    n = t.bars(spark, d).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
    days = _calendar(spark).join(n, "date", "left").join(done, "date", "left")
    days = days.select("date", "is_trading", F.col("rows").isNotNull().alias("present"), F.coalesce("complete", F.lit(True)).alias("complete"), F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce(F.col("rows") > 142, F.lit(False)).alias("failed_gate"))
    return gates.day_status(days).select("date", "status")


@query("""WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS snapshot FROM orders), p AS (SELECT DISTINCT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS snapshot FROM orders), f AS (SELECT k, min(snapshot) AS first FROM p GROUP BY 1),
g AS (SELECT f.k, y.snapshot, p.k IS NOT NULL AS here FROM f JOIN y ON y.snapshot >= f.first LEFT JOIN p ON p.k = f.k AND p.snapshot = y.snapshot), i AS (SELECT *, count(*) FILTER (WHERE here) OVER (PARTITION BY k ORDER BY snapshot) AS island FROM g),
a AS (SELECT *, count(*) FILTER (WHERE NOT here) OVER (PARTITION BY k, island ORDER BY snapshot) AS absences FROM i)
SELECT k AS o_custkey, snapshot, absences, absences >= 2 AS inactive FROM a""")
def absence_counter(spark, d):
    """Customers without an order in a year, counted from year to year."""
    p = t.load(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("snapshot")).distinct()
    return gates.absences(p, p.select("snapshot").distinct(), "o_custkey")


# ---- master and comparison

MASTER = """sess AS (SELECT DISTINCT date FROM bars ORDER BY date DESC LIMIT 10),
master AS (SELECT instrument_key, arg_max(isin, date) AS isin, symbol, symbol AS name, series, min(date) AS first_seen, max(date) AS last_seen, CASE WHEN max(date) IN (SELECT date FROM sess) THEN 'active' ELSE 'inactive' END AS status,
min(date) AS valid_from, max(date) AS valid_to, (SELECT max(date) FROM bars) AS date FROM bars GROUP BY instrument_key, symbol, series)"""


@query(f"WITH {t.BARS}, {MASTER} SELECT * FROM master")
def scd2_master(spark, d):
    return master.instrument_master(t.bars(spark, d))


@query(f"WITH {t.BARS}, {MASTER} SELECT symbol, instrument_key, series, last_seen FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY last_seen DESC, instrument_key DESC, series DESC) AS n FROM master WHERE status = 'active' AND series <> 'INDEX') WHERE n = 1")
def rebuild_universe(spark, d):
    return master.rebuild_universe(master.instrument_master(t.bars(spark, d))).select("symbol", "instrument_key", "series", "last_seen")


DISC = """n AS (SELECT date, dense_rank() OVER (ORDER BY date) AS s FROM (SELECT DISTINCT date FROM bars)), o AS (SELECT b.*, n.s FROM bars b JOIN n ON n.date = b.date),
flag AS (SELECT t.date, t.instrument_key, p.close AS close_prev, t.prevclose AS prevclose_today, p.close / t.prevclose AS implied_ratio, abs(t.prevclose / p.close - 1) AS dev FROM o t JOIN o p ON p.instrument_key = t.instrument_key AND p.s = t.s - 1 WHERE p.close > 0 AND t.prevclose > 0)"""


@query(f"WITH {t.BARS}, {DISC} SELECT date, instrument_key, close_prev, prevclose_today, round(implied_ratio, 9) AS implied_ratio FROM flag WHERE dev > 0.005")
def discontinuity_flags(spark, d):
    return master.discontinuities(t.bars(spark, d)).withColumn("implied_ratio", F.round("implied_ratio", 9))


COMPARED = "cmp AS (SELECT b.date, b.instrument_key, b.close AS close_a, s.close AS close_b, abs(s.close / nullif(b.close, 0) - 1) AS deviation FROM bars b JOIN second s ON s.date = b.date AND s.instrument_key = b.instrument_key)"


@query(f"WITH {t.SECOND}, {COMPARED} SELECT date, instrument_key, close_a, round(close_b, 9) AS close_b, round(deviation, 9) AS deviation, coalesce(deviation > 0.001, FALSE) AS mismatch FROM cmp")
def cross_source_compare(spark, d):
    out = master.compare_sources(t.bars(spark, d), t.second_source(spark, d))
    return out.withColumns({"close_b": F.round("close_b", 9), "deviation": F.round("deviation", 9)})


@query(f"WITH {t.SECOND}, {COMPARED} SELECT count(*) AS compared, count(*) FILTER (WHERE deviation > 0.001) AS mismatched FROM cmp")
def divergence_summary(spark, d):
    return master.divergence_summary(master.compare_sources(t.bars(spark, d), t.second_source(spark, d)))


@query(f"WITH {t.SECOND}, {COMPARED}, r AS (SELECT date, instrument_key, round(deviation, 6) AS deviation FROM cmp WHERE deviation > 0.001) SELECT * FROM r ORDER BY deviation DESC, date, instrument_key LIMIT 5")
def worst_divergences(spark, d):
    """A top-5 report; deviations are rounded first so that ties are ties in either engine."""
    out = master.compare_sources(t.bars(spark, d), t.second_source(spark, d)).withColumn("deviation", F.round("deviation", 6))
    return master.worst(out).select("date", "instrument_key", "deviation")


@query(f"""WITH {t.BARS}, k AS (SELECT instrument_key, row_number() OVER (ORDER BY instrument_key) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT instrument_key FROM bars))
SELECT instrument_key FROM k WHERE i % greatest(1, n // 40) = 0 UNION SELECT * FROM (VALUES ('INE000001010'), ('INE000002010'))""")
def stride_sample(spark, d):
    """A sampling operator: every k-th key and two seeds."""
    return master.stride_sample(t.bars(spark, d), "instrument_key", 40, ["INE000001010", "INE000002010"])


@query(f"""WITH {t.BARS}, {MASTER}, l AS (SELECT symbol, series, isin FROM (SELECT *, row_number() OVER (PARTITION BY symbol, series ORDER BY last_seen DESC, isin DESC) AS n FROM master) WHERE n = 1)
SELECT x.date, x.symbol, x.series, coalesce(l.isin, '') AS isin FROM (SELECT date, symbol, CASE WHEN user_id % 9 = 0 THEN 'ZZ' ELSE series END AS series FROM bars) x LEFT JOIN l ON l.symbol = x.symbol AND l.series = x.series""")
def symbol_isin_lookup(spark, d):
    b = t.bars(spark, d)
    rows = b.select("date", "symbol", F.when(t.user() % 9 == 0, "ZZ").otherwise(F.col("series")).alias("series"))
    return master.lookup_isin(rows, master.instrument_master(b)).select("date", "symbol", "series", "isin")


@query(f"WITH {t.LISTINGS} SELECT * FROM uni")
def universe_full_outer(spark, d):
    return master.universe(*t.listings(spark, d))


@query(f"""WITH {t.LISTINGS}, seen AS (SELECT DISTINCT isin FROM uni WHERE CAST(substr(isin, 4, 6) AS INTEGER) % 2 = 0)
SELECT u.isin, u.mktcap, CASE WHEN mktcap IS NULL THEN 'unrankable' WHEN mktcap >= 5000 THEN 'covered' WHEN mktcap >= 4500 AND s.isin IS NOT NULL THEN 'retained' ELSE 'below_floor' END AS bucket FROM uni u LEFT JOIN seen s ON s.isin = u.isin""")
def universe_floor(spark, d):
    u = master.universe(*t.listings(spark, d))
    seen = u.filter(F.substring("isin", 4, 6).cast("int") % 2 == 0).select("isin")
    return master.floor_partition(u, seen, 5000, 4500).select("isin", "mktcap", "bucket")


@query(f"WITH {t.LISTINGS}, c AS (SELECT isin, mktcap FROM uni WHERE mktcap >= 5000) SELECT isin, mktcap FROM c ORDER BY mktcap DESC, isin LIMIT 100")
def covered_order(spark, d):
    """A top-100 report by cap."""
    u = master.universe(*t.listings(spark, d))
    return master.covered_order(master.floor_partition(u, u.select("isin").limit(0), 5000, 4500), 100).select("isin", "mktcap")


@query(f"WITH {t.LISTINGS} SELECT on_a, count(*) AS n, count(lb.isin) AS covered, count(*) - count(lb.isin) AS missing, round(count(lb.isin) * 100.0 / count(*), 4)::DOUBLE AS pct FROM uni LEFT JOIN lb ON lb.isin = uni.isin GROUP BY on_a")
def coverage_report(spark, d):
    a, b = t.listings(spark, d)
    return master.coverage(master.universe(a, b), b, "isin", "on_a")


@query("""WITH u AS (SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN '' ELSE 'T' || c_custkey END AS symbol FROM customer), k AS (SELECT 'T' || s_suppkey AS tradingsymbol, s_suppkey + 5000 AS instrument_token FROM supplier)
SELECT u.c_custkey, u.symbol, k.instrument_token, CASE WHEN u.symbol = '' THEN 'no_symbol' WHEN k.instrument_token IS NULL THEN 'no_token' END AS reason FROM u LEFT JOIN k ON k.tradingsymbol = u.symbol""")
def token_lookup(spark, d):
    u = t.load(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 17 == 0, "").otherwise(F.concat(F.lit("T"), "c_custkey")).alias("symbol"))
    k = t.load(spark, d, "supplier").select(F.concat(F.lit("T"), "s_suppkey").alias("tradingsymbol"), (F.col("s_suppkey") + 5000).alias("instrument_token"))
    return master.with_token(u, k).select("c_custkey", "symbol", "instrument_token", "reason")


@query(f"""WITH {t.SECOND}, x AS (SELECT date, instrument_key, close, CASE WHEN day(date) % 3 = 0 THEN 'b' ELSE 'a' END AS source FROM bars WHERE day(date) % 4 <> 0 UNION ALL SELECT date, instrument_key, close, 'c' FROM second),
b AS (SELECT date, min(source) AS source FROM x WHERE source <> 'a' OR date >= DATE '2024-01-10' GROUP BY date) SELECT x.date, x.source, count(*) AS n, CAST(sum(CAST(round(x.close, 6) AS DECIMAL(18,6))) AS DOUBLE) AS sum_close FROM x JOIN b ON b.date = x.date AND b.source = x.source GROUP BY 1, 2""")
def source_fallback(spark, d):
    b, cols = t.bars(spark, d), ["date", "instrument_key", "close", "source"]
    first = b.filter(F.dayofmonth("date") % 4 != 0).withColumn("source", F.when(F.dayofmonth("date") % 3 == 0, "b").otherwise("a"))
    rows = master.fallback_sources(first.select(cols).unionByName(t.second_source(spark, d).withColumn("source", F.lit("c")).select(cols)), ["a", "b", "c"], primary_from="2024-01-10")
    return rows.groupBy("date", "source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round("close", 6).cast("decimal(18,6)")).cast("double").alias("sum_close"))


@query(f"""WITH {t.BARS}, {MASTER}, u AS (SELECT symbol, instrument_key FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY last_seen DESC, instrument_key DESC, series DESC) AS n FROM master WHERE status = 'active') WHERE n = 1),
x AS (SELECT u.symbol, b.open, b.close, CASE WHEN CAST(substr(u.symbol, 2) AS BIGINT) % 6 = 0 THEN 'no_token' WHEN b.close IS NULL THEN 'no_candle' END AS reason FROM u LEFT JOIN bars b ON b.symbol = u.symbol AND b.date = DATE '2024-01-15')
SELECT coalesce(reason, 'built') AS reason, count(*) AS n, CAST(sum(CASE WHEN reason IS NULL THEN CAST(open AS DECIMAL(18,2)) END) AS DOUBLE) AS sum_prevclose FROM x GROUP BY 1""")
def candle_rebuild(spark, d):
    b = t.bars(spark, d)
    tokens = b.select(F.col("symbol").alias("tradingsymbol"), t.user().alias("instrument_token")).distinct().filter("instrument_token % 6 <> 0")
    candles = b.filter("date = '2024-01-15'").select(t.user().alias("instrument_token"), "open", "high", "low", "close", "volume")
    rows, failures = master.candle_rebuild(master.rebuild_universe(master.instrument_master(b)).select("symbol", "instrument_key"), tokens, candles)
    built = rows.groupBy(F.lit("built").alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("prevclose").cast("decimal(18,2)")).cast("double").alias("sum_prevclose"))
    return built.unionByName(failures.withColumn("sum_prevclose", F.lit(None).cast("double")))


@query(f"WITH {t.BARS}, {MASTER} SELECT instrument_key, symbol, series, first_seen, row_number() OVER (ORDER BY instrument_key, first_seen, symbol, series) AS ordinal FROM master")
def master_order(spark, d):
    return master.master_order(master.instrument_master(t.bars(spark, d))).select("instrument_key", "symbol", "series", "first_seen", "ordinal")


# ---- filings


@query(f"""WITH {t.FILINGS}, r AS (SELECT *, CASE WHEN locator IS NOT NULL THEN CASE basis WHEN 'consolidated' THEN 0 WHEN 'standalone' THEN 1 ELSE 2 END ELSE 3 END AS rk FROM filings),
p AS (SELECT *, row_number() OVER (PARTITION BY filing_key ORDER BY rk, CASE WHEN rk < 2 THEN broadcast END DESC NULLS LAST, seq) AS n FROM r) SELECT filing_key, seq, basis, locator, rk = 3 AS pending FROM p WHERE n = 1""")
def document_pick(spark, d):
    chosen, pending = fil.pick_documents(t.filings(spark, d))
    cols = ["filing_key", "seq", "basis", "locator"]
    return chosen.select(*cols, F.lit(False).alias("pending")).unionByName(pending.select(*cols, F.lit(True).alias("pending")))


@query(f"""WITH {t.FILINGS}, r AS (SELECT *, CASE WHEN locator IS NOT NULL THEN CASE basis WHEN 'consolidated' THEN 0 WHEN 'standalone' THEN 1 ELSE 2 END ELSE 3 END AS rk FROM filings),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY filing_key ORDER BY rk, CASE WHEN rk < 2 THEN broadcast END DESC NULLS LAST, seq) AS n FROM r) WHERE n = 1 AND rk < 3), o AS (SELECT * EXCLUDE (n, rk) FROM (SELECT * EXCLUDE (n), row_number() OVER (PARTITION BY locator ORDER BY filing_key) AS n FROM p) WHERE n = 1)
SELECT filing_key, locator FROM o WHERE issuer IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND (issuer || '|' || locator) NOT IN (SELECT issuer || '|' || locator FROM filings WHERE locator IS NOT NULL AND broadcast < DATE '1996-01-01')""")
def documents_to_fetch(spark, d):
    """Picked documents, each once, of covered issuers, without those processed before."""
    f = t.filings(spark, d).withColumn("dedup_key", F.when(F.col("locator").isNotNull(), S.joined_key("issuer", "locator")))
    covered = t.load(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("issuer"))
    done = f.filter("broadcast < '1996-01-01' and locator is not null").select("dedup_key")
    return fil.unprocessed(fil.covered_only(fil.without_repeats(fil.pick_documents(f)[0]), covered, "issuer"), done).select("filing_key", "locator")


@query(f"""WITH {t.FILINGS}, s AS (SELECT *, substr(locator, 24 + 1) AS rest FROM filings WHERE broadcast >= DATE '1996-04-01'), k AS (SELECT *, CASE WHEN contains(locator, 'FILING_NBFC_INDAS') THEN 'nbfc' WHEN contains(locator, 'FILING_BANKING') THEN 'bank'
WHEN contains(locator, 'FILING_LI_') OR contains(locator, 'FILING_GI_') THEN 'insurance' WHEN contains(locator, 'FILING_INDAS') THEN 'general' END AS kind FROM s WHERE locator IS NOT NULL),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY issuer, period_end, basis ORDER BY seq DESC) AS n FROM k WHERE kind IS NOT NULL AND basis IS NOT NULL) WHERE n = 1), c AS (SELECT * EXCLUDE (n) FROM (SELECT * EXCLUDE (n), row_number() OVER (PARTITION BY issuer, period_end ORDER BY CASE WHEN basis = 'consolidated' THEN 0 ELSE 1 END, seq DESC) AS n FROM l) WHERE n = 1)
SELECT issuer, period_end, basis, seq, kind FROM (SELECT *, dense_rank() OVER (PARTITION BY issuer ORDER BY period_end DESC) AS n FROM c) WHERE n <= 4""")
def newest_filings(spark, d):
    """In era, financial sectors only, latest revision, consolidated first, four newest periods."""
    f = fil.in_era(t.filings(spark, d), "1996-04-01").withColumn("kind", fil.sector_of_file()).filter("kind is not null and basis is not null")
    return fil.newest_periods(fil.consolidated_first(fil.latest_revisions(f)), 4).select("issuer", "period_end", "basis", "seq", "kind")


@query(f"""WITH {t.FILINGS}, x AS (SELECT *, CASE WHEN contains(locator, 'FILING_NBFC_INDAS') THEN 'nbfc' WHEN contains(locator, 'FILING_BANKING') THEN 'bank' WHEN contains(locator, 'FILING_LI_') OR contains(locator, 'FILING_GI_') THEN 'insurance' WHEN contains(locator, 'FILING_INDAS') THEN 'general' END AS kind,
seq % 23 = 0 AS bad, CASE WHEN seq % 19 = 0 THEN 'rejected' ELSE 'clean' END AS ident, CASE WHEN seq % 13 = 0 THEN 'negative_revenue' ELSE '' END AS blocks, CASE WHEN seq % 5 = 0 THEN 'negative_tax' ELSE '' END AS flags FROM filings)
SELECT CASE WHEN locator IS NULL THEN 'unavailable' WHEN bad THEN 'parse_error' WHEN ident = 'rejected' THEN 'identity_mismatch' WHEN kind IS NULL THEN 'unclassified' WHEN blocks <> '' THEN 'gate_blocked' ELSE 'published' END AS outcome, coalesce(kind, 'none') AS sector, count(*) AS n, count(*) FILTER (WHERE flags <> '') AS flagged FROM x GROUP BY 1, 2""")
def filing_outcomes(spark, d):
    s = F.col("seq")
    x = t.filings(spark, d).withColumns({"sector_kind": fil.sector_of_file(), "parse_error": s % 23 == 0, "identity": F.when(s % 19 == 0, "rejected").otherwise("clean"), "blocks": F.when(s % 13 == 0, "negative_revenue").otherwise(""), "flags": F.when(s % 5 == 0, "negative_tax").otherwise("")})
    return fil.run_summary(x.withColumn("outcome", fil.outcome()))


@query(f"""WITH {t.FILINGS}, x AS (SELECT *, CASE WHEN locator IS NULL THEN 'unavailable' WHEN seq % 23 = 0 THEN 'parse_error' WHEN contains(locator, 'GOVERNANCE') THEN 'unclassified' WHEN seq % 13 = 0 THEN 'gate_blocked' ELSE 'published' END AS outcome FROM filings), p AS (SELECT * FROM x WHERE outcome = 'published')
SELECT issuer, period_end AS last_period_end, basis AS last_basis, n_published FROM (SELECT *, row_number() OVER (PARTITION BY issuer ORDER BY period_end DESC, seq) AS n, count(*) OVER (PARTITION BY issuer) AS n_published FROM p) WHERE n = 1""")
def last_published(spark, d):
    """The newest published period of each issuer."""
    s = F.col("seq")
    x = t.filings(spark, d).withColumns({"sector_kind": fil.sector_of_file(), "parse_error": s % 23 == 0, "identity": F.lit("clean"), "blocks": F.when(s % 13 == 0, "negative_revenue").otherwise("")})
    return fil.last_published(x.withColumn("outcome", fil.outcome()))


@query("""WITH f AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS scrip_code FROM orders), l AS (SELECT CAST(s_suppkey AS VARCHAR) AS scrip_code, 'INE' || s_suppkey AS instrument_key FROM supplier) SELECT f.o_orderkey, l.instrument_key FROM f LEFT JOIN l ON l.scrip_code = f.scrip_code""")
def resolve_codes(spark, d):
    refs = t.load(spark, d, "orders").select("o_orderkey", S.scrip_code("o_custkey").alias("scrip_code"))
    listing = t.load(spark, d, "supplier").select(S.scrip_code("s_suppkey").alias("scrip_code"), F.concat(F.lit("INE"), "s_suppkey").alias("instrument_key"))
    return fil.resolve_codes(refs, listing).select("o_orderkey", "instrument_key")


@query("""WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'ine00' || lpad(CAST(o_custkey AS VARCHAR), 5, 'O') || '99' ELSE ' INE00' || lpad(CAST(o_custkey AS VARCHAR), 5, '0') || '10' END AS a, 'INEOO' || lpad(CAST(o_custkey AS VARCHAR), 5, '0') || '1O' AS b,
CAST(o_custkey AS VARCHAR) AS s, CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS es FROM orders), n AS (SELECT *, replace(upper(trim(a)), 'O', '0') AS na, replace(upper(trim(b)), 'O', '0') AS nb FROM x)
SELECT o_orderkey, CASE WHEN a IS NULL OR na = nb THEN 'clean' WHEN substr(na, 1, 9) = substr(nb, 1, 9) AND s = es THEN 'flagged' ELSE 'rejected' END AS identity FROM n""")
def identity_resolution(spark, d):
    o = t.load(spark, d, "orders")
    pad = lambda c: F.lpad(F.col("o_custkey").cast("string"), 5, c)
    k = F.col("o_orderkey")
    x = o.select(
        "o_orderkey", F.when(k % 9 == 0, None).when(k % 5 == 0, F.concat(F.lit("ine00"), pad("O"), F.lit("99"))).otherwise(F.concat(F.lit(" INE00"), pad("0"), F.lit("10"))).alias("a"), F.concat(F.lit("INEOO"), pad("0"), F.lit("1O")).alias("b"),
        F.col("o_custkey").cast("string").alias("s"), F.when(k % 10 == 0, "x").otherwise(F.col("o_custkey").cast("string")).alias("es"),
    )
    return x.select("o_orderkey", fun.identity("a", "b", "s", "es").alias("identity"))


@query("""WITH p AS (SELECT o_orderkey, 'K' || o_custkey AS instrument_key, CASE WHEN o_orderstatus = 'P' THEN 'parse_error' ELSE 'published' END AS outcome FROM orders), pub AS (SELECT DISTINCT 'K' || c_custkey AS instrument_key FROM customer WHERE c_acctbal > 3000)
SELECT o_orderkey, outcome FROM p WHERE instrument_key IN (SELECT instrument_key FROM pub) AND outcome <> 'parse_error'""")
def migrated_state(spark, d):
    p = t.load(spark, d, "orders").select("o_orderkey", F.concat(F.lit("K"), "o_custkey").alias("instrument_key"), F.when(F.col("o_orderstatus") == "P", "parse_error").otherwise("published").alias("outcome"))
    pub = t.load(spark, d, "customer").filter("c_acctbal > 3000").select(F.concat(F.lit("K"), "c_custkey").alias("instrument_key"))
    return fil.migrated_state(p, pub, "parse_error").select("o_orderkey", "outcome")


# ---- facts and fundamentals

_FACT = lambda e, c=None: f"try_cast(arg_min(value, ordinal) FILTER (WHERE element = '{e}'{f' AND context = {c!r}' if c else ''}) AS DOUBLE)"


@query(f"WITH {t.FACTS} SELECT filing, " + ", ".join(f"{_FACT(e, c)} AS {e}_{c}" for e in ("RevenueFromOperations", "ProfitBeforeTax") for c in ("OneD", "FourD")) + " FROM facts WHERE element IN ('RevenueFromOperations', 'ProfitBeforeTax') GROUP BY filing")
def fact_pivot(spark, d):
    return fun.pivot_facts(t.facts(spark, d), ["RevenueFromOperations", "ProfitBeforeTax"], ["OneD", "FourD"])


_HAS = lambda e: f"bool_or(element = '{e}')"
KIND = f"""kinds AS (SELECT filing, CASE WHEN {_HAS('NetPremiumIncome')} OR {_HAS('NetPremiumWritten')} THEN 'insurance' WHEN {_HAS('InterestEarned')} AND {_HAS('InterestExpended')} AND NOT {_HAS('RevenueFromOperations')} THEN 'bank'
WHEN {_HAS('RevenueFromOperations')} AND {_HAS('InterestEarned')} THEN 'nbfc' WHEN {_HAS('RevenueFromOperations')} THEN 'general' END AS sector_kind FROM facts GROUP BY filing)"""


@query(f"WITH {t.FACTS}, {KIND} SELECT * FROM kinds")
def sector_fingerprint(spark, d):
    return fun.sector_kind(t.facts(spark, d))


WIDE = "wide AS (SELECT filing, context, " + ", ".join(f"{_FACT(e)}{' / 1e7' if 'PerShare' not in e else ''} AS {e}" for e in t.ELEMENTS) + " FROM facts GROUP BY filing, context)"
_OP = "ProfitBeforeTax + FinanceCosts + DepreciationDepletionAndAmortisationExpense - OtherIncome"
LINES = f"""lines AS (SELECT w.filing, w.context, k.sector_kind, CASE sector_kind WHEN 'bank' THEN InterestEarned WHEN 'insurance' THEN NetPremiumWritten ELSE RevenueFromOperations END AS revenue,
CASE WHEN sector_kind = 'general' THEN {_OP} END AS operating_profit, CASE WHEN sector_kind = 'general' AND RevenueFromOperations <> 0 THEN ({_OP}) / RevenueFromOperations * 100 END AS opm_pct,
CASE sector_kind WHEN 'bank' THEN 'nim' WHEN 'nbfc' THEN 'spread' WHEN 'insurance' THEN 'uw_margin' ELSE 'opm' END AS margin_kind, CASE WHEN sector_kind <> 'insurance' THEN OtherIncome END AS other_income,
CASE WHEN sector_kind IN ('general', 'nbfc') THEN FinanceCosts END AS interest, CASE WHEN sector_kind = 'general' THEN DepreciationDepletionAndAmortisationExpense END AS depreciation, CASE WHEN sector_kind IN ('general', 'nbfc') THEN ProfitBeforeTax END AS pbt,
CASE WHEN sector_kind = 'general' AND (CurrentTax IS NOT NULL OR DeferredTax IS NOT NULL) THEN coalesce(CurrentTax, 0) + coalesce(DeferredTax, 0) END AS tax, CASE WHEN sector_kind IN ('general', 'nbfc') THEN ProfitLossForPeriod END AS net_profit,
CASE WHEN sector_kind IN ('general', 'nbfc') THEN BasicEarningsLossPerShareFromContinuingOperations END AS eps, CASE sector_kind WHEN 'bank' THEN InterestEarned - InterestExpended WHEN 'nbfc' THEN InterestEarned - FinanceCosts END AS net_interest_income
FROM wide w JOIN kinds k ON k.filing = w.filing), rows AS (SELECT * FROM lines WHERE sector_kind IS NOT NULL AND revenue IS NOT NULL)"""
_LINE_NUMBERS = ("revenue", "operating_profit", "opm_pct", "other_income", "interest", "depreciation", "pbt", "tax", "net_profit", "eps", "net_interest_income")


def _lines(spark, d):
    return fun.sector_lines(fun.periods_with_kind(t.facts(spark, d)))


@query(f"WITH {t.FACTS}, {KIND}, {WIDE}, {LINES} SELECT filing, context, sector_kind, margin_kind, " + ", ".join(f"round({c}, 9) AS {c}" for c in _LINE_NUMBERS) + " FROM rows")
def sector_lines(spark, d):
    return _lines(spark, d).select("filing", "context", "sector_kind", "margin_kind", *(F.round(c, 9).alias(c) for c in _LINE_NUMBERS))


_N = lambda fields: " + ".join(f"CAST({f} IS NOT NULL AS INTEGER)" for f in fields)
RESOLVED = "CASE sector_kind " + " ".join(f"WHEN '{k}' THEN ({_N(fs)}) / {len(fs)}.0::DOUBLE" for k, fs in fun.RESOLVED.items()) + " END"


@query(f"WITH {t.FACTS}, {KIND}, {WIDE}, {LINES} SELECT filing, context, sector_kind, round({RESOLVED}, 6) AS fields_resolved_pct FROM rows")
def resolved_fields(spark, d):
    return fun.resolved_share(_lines(spark, d)).select("filing", "context", "sector_kind", F.round("fields_resolved_pct", 6).alias("fields_resolved_pct"))


@query(f"WITH {t.FACTS}, {KIND}, {WIDE}, {LINES} SELECT filing, sector_kind, 'no usable facts in either duration context' AS error FROM kinds WHERE sector_kind IS NOT NULL AND filing NOT IN (SELECT filing FROM rows)")
def period_presence(spark, d):
    """Filings of a known sector whose revenue cannot be read in either context."""
    return fun.without_usable_facts(t.facts(spark, d))


_VALUES = "vals AS (SELECT CAST(o_orderkey AS VARCHAR) AS filing, o_totalprice / 1e3 AS equity, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS total_debt, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey * 1000 + 7 AS DOUBLE) END AS shares_outstanding, CAST(o_custkey AS DOUBLE) AS ebitda FROM orders WHERE o_orderkey % 4 <> 0)"


@query(f"""WITH {t.FACTS}, {KIND}, {WIDE}, {LINES}, {_VALUES} SELECT r.filing, r.context, round(v.equity + coalesce(v.total_debt, 0), 6) AS capital_employed, round(v.equity * 1e7 / v.shares_outstanding, 6) AS book_value_per_share, CASE WHEN r.context = 'FourD' THEN v.ebitda END AS ebitda_annual, round({RESOLVED}, 6) AS fields_resolved_pct
FROM rows r LEFT JOIN vals v ON v.filing = r.filing""")
def fundamentals_rows(spark, d):
    """Lines with the balance sheet of their filing."""
    k = F.col("o_orderkey")
    values = t.load(spark, d, "orders").filter(k % 4 != 0).select(k.cast("string").alias("filing"), (F.col("o_totalprice") / 1e3).alias("equity"), F.when(k % 3 != 0, F.col("o_custkey").cast("double")).alias("total_debt"), F.when(k % 5 != 0, (F.col("o_custkey") * 1000 + 7).cast("double")).alias("shares_outstanding"), F.col("o_custkey").cast("double").alias("ebitda"))
    out = fun.fundamentals_rows(_lines(spark, d), values)
    return out.select("filing", "context", *(F.round(c, 6).alias(c) for c in ("capital_employed", "book_value_per_share")), "ebitda_annual", F.round("fields_resolved_pct", 6).alias("fields_resolved_pct"))


GATE = f"""g AS (SELECT *, {RESOLVED} AS share, CASE WHEN context = 'FourD' THEN 'FY' ELSE 'Q1' END AS fiscal_quarter, CAST(filing AS BIGINT) AS k FROM rows), x AS (SELECT *, 80 + k % 20 + CASE WHEN fiscal_quarter = 'FY' THEN 270 ELSE 0 END AS days,
CASE WHEN k % 4 = 0 THEN 0.0001::DOUBLE WHEN k % 4 = 1 THEN 10.0::DOUBLE END AS mktcap_cr, 1000000.0::DOUBLE AS shares FROM g), y AS (SELECT *, CASE WHEN fiscal_quarter = 'FY' THEN revenue ELSE revenue * 4 END AS yearly, revenue > 0 AND mktcap_cr > 0 AS sized, net_profit * 1e7 / shares AS implied FROM x)"""


def _gate_rows(spark, d):
    k, fy = F.col("filing").cast("bigint"), F.col("context") == "FourD"
    rows = fun.resolved_share(_lines(spark, d)).withColumn("fiscal_quarter", F.when(fy, "FY").otherwise("Q1"))
    return rows.withColumns({"days": 80 + k % 20 + F.when(fy, 270).otherwise(0), "mktcap_cr": F.when(k % 4 == 0, 0.0001).when(k % 4 == 1, 10.0), "shares_outstanding": F.lit(1000000.0)})


@query(f"""WITH {t.FACTS}, {KIND}, {WIDE}, {LINES}, {GATE} SELECT filing, context, concat_ws(';', CASE WHEN fiscal_quarter = 'FY' AND days NOT BETWEEN 350 AND 380 THEN 'annual_duration' END, CASE WHEN share < 0.4 THEN 'low_fields_resolved' END, CASE WHEN revenue < 0 THEN 'negative_revenue' END,
CASE WHEN fiscal_quarter <> 'FY' AND days NOT BETWEEN 85 AND 95 THEN 'quarter_duration' END, CASE WHEN sized AND yearly > mktcap_cr * 10 THEN 'scale_revenue_vs_mcap_too_large' END, CASE WHEN sized AND yearly < mktcap_cr / 1000 THEN 'scale_revenue_vs_mcap_too_small' END) AS blocks FROM y""")
def gate_blocks(spark, d):
    return _gate_rows(spark, d).select("filing", "context", fun.gate_blocks().alias("blocks"))


_APART = lambda a, b, s, e: f"greatest(abs({a}), abs({b})) > {e} AND abs({a} - ({b})) > {s} * greatest(abs({a}), abs({b}))"


@query(f"""WITH {t.FACTS}, {KIND}, {WIDE}, {LINES}, {GATE}, z AS (SELECT *, pbt - tax AS want FROM y) SELECT filing, context, concat_ws(';', CASE WHEN implied IS NOT NULL AND abs(eps) > 0.01 AND {_APART('implied', 'eps', 0.25, 0)} THEN 'eps_vs_net_profit_mismatch' END, CASE WHEN tax < 0 THEN 'negative_tax' END,
CASE WHEN want IS NOT NULL AND net_profit IS NOT NULL AND {_APART('want', 'net_profit', 0.05, 1e-9)} THEN 'pbt_tax_np_identity' END, CASE WHEN pbt > 0 AND tax > pbt THEN 'tax_exceeds_pbt' END) AS flags FROM z""")
def gate_flags(spark, d):
    return _gate_rows(spark, d).select("filing", "context", fun.gate_flags().alias("flags"))


@query(f"""WITH {t.QUARTERS}, w AS (SELECT *, count(eps) OVER w4 AS n, sum(eps) OVER w4 AS s, period_end - lag(period_end, 3) OVER (PARTITION BY instrument_key, basis ORDER BY period_end) + 1 AS span FROM quarters WHERE fiscal_quarter <> 'FY' WINDOW w4 AS (PARTITION BY instrument_key, basis ORDER BY period_end ROWS 3 PRECEDING)),
v AS (SELECT w.*, CASE WHEN n = 4 AND span BETWEEN 260 AND 300 THEN s END AS sum4, f.eps AS fy FROM w LEFT JOIN (SELECT * FROM quarters WHERE fiscal_quarter = 'FY') f ON f.instrument_key = w.instrument_key AND f.basis = w.basis AND f.period_end = w.period_end)
SELECT instrument_key, basis, period_end, fiscal_quarter, round(coalesce(sum4, fy), 6) AS ttm_eps, CASE WHEN sum4 IS NOT NULL THEN 'sum4q' WHEN fy IS NOT NULL THEN 'fy_eps' ELSE '' END AS ttm_eps_method FROM v UNION ALL
SELECT instrument_key, basis, period_end, fiscal_quarter, round(eps, 6), 'fy_eps' FROM quarters WHERE fiscal_quarter = 'FY'""")
def ttm_sum4q(spark, d):
    return fun.ttm_eps(t.quarters(spark, d)).select("instrument_key", "basis", "period_end", "fiscal_quarter", F.round("ttm_eps", 6).alias("ttm_eps"), "ttm_eps_method")


_LAST = lambda c, lo, hi: f"last({c}) OVER (PARTITION BY instrument_key, basis, fiscal_quarter = 'FY' ORDER BY dn RANGE BETWEEN {lo} PRECEDING AND {hi} PRECEDING)"
GROWTH = f"""gr AS (SELECT *, {_LAST('revenue', 371, 359)} AS ry, {_LAST('net_profit', 371, 359)} AS py, {_LAST('eps', 371, 359)} AS ey, {_LAST('revenue', 97, 84)} AS rq, {_LAST('net_profit', 97, 84)} AS pq FROM (SELECT *, period_end - DATE '1970-01-01' AS dn FROM quarters)),
growth AS (SELECT *, CASE WHEN ry > 0 THEN (revenue - ry) / ry * 100 END AS revenue_growth_yoy_pct, CASE WHEN py > 0 THEN (net_profit - py) / py * 100 END AS net_profit_growth_yoy_pct, CASE WHEN ey > 0 THEN (eps - ey) / ey * 100 END AS eps_growth_yoy_pct,
CASE WHEN fiscal_quarter <> 'FY' AND rq > 0 THEN (revenue - rq) / rq * 100 END AS revenue_growth_qoq_pct, CASE WHEN fiscal_quarter <> 'FY' AND pq > 0 THEN (net_profit - pq) / pq * 100 END AS net_profit_growth_qoq_pct FROM gr)"""
_GROWTH = ("revenue_growth_yoy_pct", "net_profit_growth_yoy_pct", "eps_growth_yoy_pct", "revenue_growth_qoq_pct", "net_profit_growth_qoq_pct")


@query(f"WITH {t.QUARTERS}, {GROWTH} SELECT instrument_key, basis, period_end, fiscal_quarter, " + ", ".join(f"round({c}, 4) AS {c}" for c in _GROWTH) + " FROM growth")
def growth_yoy_range_frame(spark, d):
    return fun.growth(t.quarters(spark, d)).select("instrument_key", "basis", "period_end", "fiscal_quarter", *(F.round(c, 4).alias(c) for c in _GROWTH))


@query(f"""WITH {t.QUARTERS}, {GROWTH}, h AS (SELECT instrument_key AS symbol, count(*) FILTER (WHERE fiscal_quarter <> 'FY') AS quarters, min(period_end) AS oldest, max(period_end) AS newest, count(revenue_growth_yoy_pct) AS with_growth FROM growth GROUP BY 1) SELECT * FROM h ORDER BY quarters DESC, symbol LIMIT 20""")
def history_depth(spark, d):
    """A top-20 report."""
    return fun.history_depth(fun.growth(t.quarters(spark, d)).withColumn("symbol", F.col("instrument_key")))


@query(f"""WITH {t.QUARTERS}, e AS (SELECT instrument_key, period_end, fiscal_quarter, basis, revenue, net_profit, DATE '2026-01-01' AS as_of FROM quarters WHERE year(period_end) < 2000), n AS (SELECT instrument_key, period_end, fiscal_quarter, basis, CASE WHEN month(period_end) = 6 THEN revenue + 1 ELSE revenue END AS revenue, net_profit, DATE '2026-02-01' AS as_of FROM quarters WHERE year(period_end) > 1997)
SELECT coalesce(e.instrument_key, n.instrument_key) AS instrument_key, coalesce(e.period_end, n.period_end) AS period_end, coalesce(e.fiscal_quarter, n.fiscal_quarter) AS fiscal_quarter, coalesce(e.basis, n.basis) AS basis,
CASE WHEN n.basis IS NULL THEN 'kept' WHEN e.basis IS NULL THEN 'appended' WHEN e.revenue = n.revenue AND e.net_profit = n.net_profit THEN 'unchanged' ELSE 'replaced' END AS change, CASE WHEN n.basis IS NULL OR (e.revenue = n.revenue AND e.net_profit = n.net_profit) THEN e.revenue ELSE n.revenue END AS revenue,
CASE WHEN n.basis IS NULL OR (e.revenue = n.revenue AND e.net_profit = n.net_profit) THEN e.as_of ELSE n.as_of END AS as_of FROM e FULL OUTER JOIN n ON e.instrument_key = n.instrument_key AND e.period_end = n.period_end AND e.fiscal_quarter = n.fiscal_quarter AND e.basis = n.basis""")
def merge_rows(spark, d):
    q = t.quarters(spark, d).select("instrument_key", "period_end", "fiscal_quarter", "basis", "revenue", "net_profit")
    old = q.filter("year(period_end) < 2000").withColumn("as_of", F.lit("2026-01-01").cast("date"))
    new = q.filter("year(period_end) > 1997").withColumns({"revenue": F.when(F.month("period_end") == 6, F.col("revenue") + 1).otherwise(F.col("revenue")), "as_of": F.lit("2026-02-01").cast("date")})
    return fun.merge_rows(old, new).select("instrument_key", "period_end", "fiscal_quarter", "basis", "change", "revenue", "as_of")


@query(f"WITH {t.QUARTERS} SELECT instrument_key, period_end, fiscal_quarter, basis, (CASE WHEN fiscal_quarter = 'FY' THEN 340 + CAST(revenue AS BIGINT) % 50 ELSE 90 END) AS days FROM quarters WHERE fiscal_quarter <> 'FY' OR 340 + CAST(floor(revenue) AS BIGINT) % 50 BETWEEN 350 AND 380".replace("340 + CAST(revenue AS BIGINT)", "340 + CAST(floor(revenue) AS BIGINT)"))
def full_years_only(spark, d):
    fy = F.col("fiscal_quarter") == "FY"
    q = t.quarters(spark, d).withColumn("days", F.when(fy, 340 + F.floor("revenue") % 50).otherwise(90))
    q = q.withColumns({"end": F.col("period_end"), "start": F.date_sub("period_end", (F.col("days") - 1).cast("int"))})
    return fun.full_years_only(q).select("instrument_key", "period_end", "fiscal_quarter", "basis", "days")


# ---- sectors and baskets

CYCLICAL = ("furniture", "machinery")


@query("""SELECT c_mktsegment AS sector, count(*) AS n, lower(c_mktsegment) IN ('furniture', 'machinery') AS is_cyclical FROM customer GROUP BY 1""")
def sector_summary(spark, d):
    return sectors.sector_summary(t.load(spark, d, "customer").select(F.col("c_mktsegment").alias("sector")), CYCLICAL)


@query("""SELECT 'K' || c_custkey AS instrument_key, c_name AS symbol, CAST(NULL AS VARCHAR) AS macro_sector, c_mktsegment AS sector, 'I' || c_nationkey AS industry, CASE WHEN c_custkey % 3 <> 0 THEN 'B' || (c_custkey % 7) END AS basic_industry, lower(c_mktsegment) IN ('furniture', 'machinery') AS is_cyclical, 3 AS cyclicality_rule_version, DATE '2026-05-15' AS date FROM customer""")
def sector_frame(spark, d):
    c = t.load(spark, d, "customer")
    rows = c.select(F.concat(F.lit("K"), "c_custkey").alias("instrument_key"), F.col("c_name").alias("symbol"), F.lit(" ").alias("macro_sector"), F.col("c_mktsegment").alias("sector"), F.concat(F.lit("I"), "c_nationkey").alias("industry"), F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("B"), F.col("c_custkey") % 7)).otherwise("").alias("basic_industry"))
    return sectors.sector_frame(rows, CYCLICAL, 3, t.TODAY)


def _members(spark, d):
    li = t.load(spark, d, "lineitem")
    return li.select(F.concat(F.lit("f"), F.col("l_suppkey")).alias("source_file"), F.concat(F.lit("INE"), F.lpad(F.col("l_partkey").cast("string"), 9, "0")).alias("isin"), F.when(F.col("l_partkey") % 10 == 0, "").otherwise(F.concat(F.lit("P"), "l_partkey")).alias("symbol"))


@query("""WITH m AS (SELECT DISTINCT 'f' || l_suppkey AS source_file, 'INE' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS isin, 'P' || l_partkey AS symbol FROM lineitem WHERE l_partkey % 10 <> 0), c AS (SELECT source_file FROM m GROUP BY 1 HAVING count(*) >= 400) SELECT * FROM m WHERE source_file IN (SELECT source_file FROM c)""")
def basket_floor(spark, d):
    return sectors.baskets(_members(spark, d), least=400)


@query("""WITH m AS (SELECT DISTINCT 'f' || l_suppkey AS index_key, 'P' || l_partkey AS symbol FROM lineitem WHERE l_partkey % 10 <> 0), cur AS (SELECT * FROM m WHERE CAST(substr(index_key, 2) AS BIGINT) % 3 <> 0), pri AS (SELECT * FROM m WHERE CAST(substr(index_key, 2) AS BIGINT) % 2 = 0)
SELECT index_key, symbol, FALSE AS carried FROM cur UNION ALL SELECT index_key, symbol, TRUE FROM pri WHERE index_key NOT IN (SELECT index_key FROM cur)""")
def basket_carry_forward(spark, d):
    m = _members(spark, d).filter("symbol <> ''").select(F.col("source_file").alias("index_key"), "symbol").distinct()
    k = F.substring("index_key", 2, 20).cast("bigint")
    return sectors.merge_baskets(m.filter(k % 3 != 0), m.filter(k % 2 == 0))


@query("""WITH m AS (SELECT c_custkey, c_mktsegment FROM customer), cur AS (SELECT * FROM m WHERE c_custkey % 20 <> 0) SELECT (SELECT count(*) FROM cur) AS n, (SELECT count(DISTINCT c_custkey) FROM cur) AS n_keys, (SELECT count(*) FROM m) AS n_prior, CASE WHEN (SELECT count(*) FROM cur) < 100 THEN 'below_floor' WHEN (SELECT count(*) FROM cur) < (SELECT count(*) FROM m) THEN 'shrunk' ELSE 'accepted' END AS verdict""")
def snapshot_acceptance(spark, d):
    c = t.load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return sectors.accept_snapshot(c.filter("c_custkey % 20 <> 0"), c, 100, "c_custkey")


@query(f"""WITH {t.BARS}, i AS (SELECT date, 'IDX:' || replace(upper(trim(symbol)), ' ', '') AS instrument_key, ' ' || lower(symbol) || ' ' AS symbol FROM bars), k AS (SELECT DISTINCT replace(upper(trim(symbol)), ' ', '') AS k, instrument_key FROM i WHERE date = (SELECT max(date) FROM i)),
n AS (SELECT 'u ' || c_custkey AS index_name FROM customer) SELECT n.index_name, k.instrument_key FROM n JOIN k ON k.k = replace(upper(trim(n.index_name)), ' ', '')""")
def index_key_resolution(spark, d):
    b = t.bars(spark, d).select("date", F.concat(F.lit("IDX:"), S.index_key("symbol")).alias("instrument_key"), F.concat(F.lit(" "), F.lower("symbol"), F.lit(" ")).alias("symbol"))
    return master.current_index_keys(t.load(spark, d, "customer").select(F.concat(F.lit("u "), "c_custkey").alias("index_name")), b)


@query(r"""WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\b[^>]*\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a>', 1) AS h, regexp_extract_all(html, '(?is)<a\b[^>]*\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a>', 2) AS l FROM pages),
x AS (SELECT page_id, unnest(h) AS href, trim(regexp_replace(unnest(l), '\s+', ' ', 'g')) AS label FROM a) SELECT page_id, href, count(DISTINCT label) AS n_texts, CASE WHEN min(label) = max(label) THEN min(label) END AS label FROM x GROUP BY 1, 2""")
def page_anchor_labels(spark, d):
    return reference.anchor_labels(t.load(spark, d, "pages"))


@query(r"""SELECT page_id, nfc_normalize(trim(regexp_replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '\s+', ' ', 'g'))) AS title FROM pages""")
def canonical_labels(spark, d):
    """The given titles have no characters with a compatibility form, so canonical composition is their twin; tests hold the rest against
    the standard library."""
    return t.load(spark, d, "pages").select("page_id", S.canonical_label(F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1)).alias("title"))


# ---- registry


@query(f"WITH {t.REGISTRY} SELECT isin, symbol, status, sector, attempts, retry_on, deferred, backlog, absences, reasons FROM rec")
def registry_reconcile(spark, d):
    out = registry.reconcile(t.registry_state(spark, d), t.registry_snapshot(spark, d), t.TODAY, audit=True)
    return out.select("isin", "symbol", "status", "sector", "attempts", "retry_on", "deferred", "backlog", "absences", "reasons")


@query(f"""WITH {t.REGISTRY}, a AS (SELECT count(*) FILTER (WHERE status <> 'inactive') AS n_prior FROM state), o AS (SELECT count(*) AS overlap FROM state WHERE status <> 'inactive' AND isin IN (SELECT isin FROM snap)), n AS (SELECT count(*) AS n, count(DISTINCT isin) AS n_keys FROM snap)
SELECT n, n_keys, 0::BIGINT AS n_blank, n_prior, overlap, n >= 0.95 * n_prior AND overlap >= 0.95 * n_prior AS valid FROM n, a, o""")
def snapshot_validity(spark, d):
    return registry.snapshot_validity(t.registry_snapshot(spark, d), t.registry_state(spark, d))


FOLD = """cand AS (SELECT *, row_number() OVER (ORDER BY isin) AS ordinal FROM rec WHERE reasons <> ''), att AS (SELECT isin, ordinal, CASE WHEN ordinal % 400 = 399 THEN 'deferred' WHEN ordinal % 3 = 0 THEN 'failed' ELSE 'observed' END AS outcome, 'MM' AS m, 'SS' || (ordinal % 6) AS s FROM cand),
done AS (SELECT * FROM att WHERE ordinal < coalesce((SELECT min(ordinal) FROM att WHERE outcome = 'deferred'), 1000000000)),
folded AS (SELECT r.isin, r.symbol, CASE d.outcome WHEN 'observed' THEN 'classified' WHEN 'failed' THEN 'pending' ELSE r.status END AS status, CASE WHEN d.outcome = 'observed' THEN d.m ELSE r.macro_sector END AS macro_sector, CASE WHEN d.outcome = 'observed' THEN d.s ELSE r.sector END AS sector,
CASE d.outcome WHEN 'observed' THEN 0 WHEN 'failed' THEN r.attempts + 1 ELSE r.attempts END AS attempts, CASE WHEN d.outcome = 'observed' THEN NULL WHEN d.outcome = 'failed' THEN CASE WHEN r.attempts + 1 <= 3 THEN DATE '2026-05-15' + CAST([1, 3, 7][CAST(r.attempts + 1 AS INTEGER)] AS INTEGER) END ELSE r.retry_on END AS retry_on,
CASE WHEN d.outcome = 'failed' THEN r.attempts + 1 > 3 ELSE r.deferred END AS deferred, CASE WHEN d.outcome IS NOT NULL THEN FALSE ELSE r.backlog END AS backlog, CASE WHEN d.outcome IS NOT NULL THEN DATE '2026-05-15' ELSE r.audit_attempt_on END AS audit_attempt_on, r.absences FROM rec r LEFT JOIN done d ON d.isin = r.isin)"""


def _folded(spark, d):
    """The fold and its attempts. State and fold are written once, as several branches read them."""
    state = written(registry.reconcile(t.registry_state(spark, d), t.registry_snapshot(spark, d), t.TODAY, audit=True), "reconciled")
    picked = store.numbered(registry.candidates(state), "isin")
    o = F.col("ordinal")
    attempts = picked.select("isin", "ordinal", F.when(o % 400 == 399, "deferred").when(o % 3 == 0, "failed").otherwise("observed").alias("outcome"), F.lit("MM").alias("macro_sector"), F.concat(F.lit("SS"), o % 6).alias("sector"), F.lit("II").alias("industry"), F.lit("BB").alias("basic_industry"))
    return written(registry.fold(state, attempts, t.TODAY, audit=True), "folded"), attempts


@query(f"WITH {t.REGISTRY}, {FOLD} SELECT * FROM folded")
def observation_fold(spark, d):
    return _folded(spark, d)[0].drop("industry", "basic_industry")


@query(f"""WITH {t.REGISTRY}, {FOLD}, v AS (SELECT f.*, a.isin AS tried FROM folded f LEFT JOIN att a ON a.isin = f.isin WHERE status <> 'inactive') SELECT count(*) AS active, count(tried) AS attempted, count(*) FILTER (WHERE status = 'classified') AS classified, count(*) FILTER (WHERE status = 'pending') AS pending,
count(*) FILTER (WHERE status = 'pending' AND backlog) AS baseline_pending, count(*) FILTER (WHERE status = 'pending' AND retry_on > DATE '2026-05-15') AS retry_pending, count(*) FILTER (WHERE deferred) AS audit_pending, round(count(*) FILTER (WHERE status = 'classified') * 100.0::DOUBLE / count(*), 4) AS coverage_pct FROM v""")
def collection_report(spark, d):
    folded, attempts = _folded(spark, d)
    return registry.collection_report(folded, attempts, t.TODAY)


PUB = """prev AS (SELECT isin, symbol, macro_sector, sector FROM state WHERE status <> 'inactive' AND sector IS NOT NULL), cur AS (SELECT isin, symbol, macro_sector, sector FROM folded WHERE status <> 'inactive' AND sector IS NOT NULL),
diff AS (SELECT coalesce(c.isin, p.isin) AS isin, CASE WHEN p.isin IS NULL THEN 'added' WHEN c.isin IS NULL THEN 'removed' WHEN c.sector <> p.sector OR c.macro_sector <> p.macro_sector THEN 'taxonomy' WHEN c.symbol <> p.symbol THEN 'renamed' END AS change FROM cur c FULL OUTER JOIN prev p ON p.isin = c.isin)"""


@query(f"WITH {t.REGISTRY}, {FOLD}, {PUB} SELECT * FROM diff WHERE change IS NOT NULL")
def registry_changes(spark, d):
    return registry.changes(registry.active_view(_folded(spark, d)[0]), registry.active_view(t.registry_state(spark, d)))


@query(f"""WITH {t.REGISTRY}, {FOLD}, {PUB}, x AS (SELECT (SELECT count(*) FROM cur) AS n, (SELECT count(DISTINCT sector) FROM cur) AS n_sectors, (SELECT count(*) FROM prev) AS n_prior, (SELECT count(DISTINCT sector) FROM prev) AS n_prior_sectors, (SELECT count(*) FROM diff WHERE change IS NOT NULL) AS n_changed,
(SELECT count(*) FROM diff WHERE change = 'taxonomy') AS n_taxonomy, (SELECT count(*) FROM diff WHERE change IS NOT NULL AND change <> 'removed' AND isin NOT IN (SELECT isin FROM att)) AS n_missing)
SELECT *, CASE WHEN n_changed = 0 THEN 'unchanged' WHEN n = 0 THEN 'empty' WHEN n < 0.99 * n_prior THEN 'coverage' WHEN n_sectors < 0.5 * n_prior_sectors THEN 'diversity' WHEN n_prior > 0 AND n_taxonomy > 0.1 * n_prior THEN 'taxonomy_change' WHEN n_missing > 0 THEN 'missing_provenance' ELSE 'publish' END AS decision FROM x""")
def publication_decision(spark, d):
    folded, attempts = _folded(spark, d)
    return registry.decide_publication(registry.active_view(folded), registry.active_view(t.registry_state(spark, d)), attempts)


@query(f"""WITH {t.REGISTRY}, o AS (SELECT isin, CAST(substr(isin, 2) AS BIGINT) * 7919 % 100003 AS ordinal FROM snap) SELECT r.isin, o.ordinal, r.reasons FROM rec r JOIN o ON o.isin = r.isin WHERE reasons <> '' ORDER BY ordinal, r.isin LIMIT 50""")
def candidate_batch(spark, d):
    """A batch limit: the first 50 candidates in the order of the snapshot's file."""
    place = (F.substring("isin", 2, 20).cast("bigint") * 7919 % 100003).alias("ordinal")
    snapshot = t.registry_snapshot(spark, d).select("*", place)
    return registry.candidates(registry.reconcile(t.registry_state(spark, d), snapshot, t.TODAY, audit=True), 50).select("isin", "ordinal", "reasons")


@query(f"""WITH {t.REGISTRY}, s AS (SELECT symbol, max(isin) AS isin FROM (SELECT CASE WHEN CAST(substr(isin, 2) AS BIGINT) % 50 = 1 THEN 'S1' ELSE symbol END AS symbol, isin FROM state) GROUP BY 1) SELECT n.symbol, n.isin AS observed_as, s.isin FROM snap n JOIN s ON s.symbol = n.symbol""")
def observed_keys(spark, d):
    """Observations by symbol, joined to the keys of the registry."""
    state = t.registry_state(spark, d).select("isin", F.when(F.substring("isin", 2, 20).cast("bigint") % 50 == 1, "S1").otherwise(F.col("symbol")).alias("symbol"))
    return registry.observed_keys(t.registry_snapshot(spark, d).withColumnRenamed("isin", "observed_as"), state)


_PROVENANCE = "prov AS (SELECT 'K' || c_custkey AS isin, '2026-05-0' || (c_custkey % 9 + 1) AS observed_at, 'u' || c_custkey AS source_url, 'v' || (c_custkey % 3) AS extractor_version, sha256(c_name) AS fragment_hash FROM customer WHERE c_custkey % 6 <> 0)"


@query(f"""WITH {t.REGISTRY}, {_PROVENANCE} SELECT s.isin, symbol, status, macro_sector, sector, observed_at, source_url, extractor_version, fragment_hash, backlog, CAST(audit_attempt_on AS VARCHAR) AS audit_attempt_on, absences, CAST(retry_on AS VARCHAR) AS retry_on, attempts, deferred, DATE '2026-05-15' AS date FROM state s LEFT JOIN prov p ON p.isin = s.isin""")
def registry_state_write(spark, d):
    """The registry's state with flat provenance, written as a snapshot and read back."""
    c, path = t.load(spark, d, "customer").filter("c_custkey % 6 <> 0"), fresh_path(spark, "registry-state")
    k = F.col("c_custkey")
    provenance = c.select(F.concat(F.lit("K"), k).alias("isin"), F.concat(F.lit("2026-05-0"), k % 9 + 1).alias("observed_at"), F.concat(F.lit("u"), k).alias("source_url"), F.concat(F.lit("v"), k % 3).alias("extractor_version"), F.sha2("c_name", 256).alias("fragment_hash"))
    registry.write_state(t.registry_state(spark, d), provenance.unionByName(provenance.withColumn("observed_at", F.lit("2026-05-00"))), path, "v1", t.TODAY)
    return store.read_snapshot(spark, path).drop("industry", "basic_industry")


@query(f"""WITH {t.REGISTRY}, p AS (SELECT isin, symbol, FALSE AS carried FROM snap), x AS (SELECT * FROM p UNION ALL SELECT isin, symbol, TRUE FROM state WHERE isin NOT IN (SELECT isin FROM snap)) SELECT *, (SELECT count(*) FROM x) >= (SELECT count(*) FROM state) AS accepted FROM x""")
def widened_registry(spark, d):
    """Keys of a wider artifact before stay beside the current ones, if the whole does not shrink."""
    current, previous = t.registry_snapshot(spark, d).select("isin", "symbol"), t.registry_state(spark, d).select("isin", "symbol")
    return registry.widened(current, previous).crossJoin(registry.widened_verdict(current, previous).select("accepted"))  # one row
