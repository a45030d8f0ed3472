"""Queries for the sources, gates and extension points that read files which Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.workspace import fresh_path, ship
from ..operators import gates, master, store
from ..sources import prices, reference
from . import tables as t
from .queries import DISC, query
from .registry import default_registry

# ---- sector lists, seeds, baskets, listings


@query("""WITH x AS (SELECT c_custkey AS k, 'INE' || (c_custkey // 2) AS instrument_key, 'S' || c_custkey AS symbol, c_mktsegment AS sector, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name || ', Ltd' END AS company, c_mktsegment IN ('BUILDING', 'MACHINERY') AS is_cyclical FROM customer WHERE c_custkey % 9 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 17 <> 0)
SELECT instrument_key, symbol, sector, company, is_cyclical FROM (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY k) AS n FROM x) WHERE n = 1""")
def sector_csv(spark, d):
    """A sector list with quoted commas and line breaks, two rows for each ISIN, short rows, and blanks in every column."""
    ship(spark)
    k = F.col("c_custkey")
    isin = F.concat(F.lit(" ine"), F.floor(k / 2))
    quoted = F.concat(F.lit('"'), "c_name", F.lit(', Ltd"'))
    blank = lambda n, c: F.when(k % n == 0, " ").otherwise(c)
    fields = [blank(5, quoted), blank(11, F.col("c_mktsegment")), blank(13, F.concat(F.lit("s"), k)), F.when(k % 3 == 0, "").when(k % 3 == 1, '"E\nQ"').otherwise("EQ"), blank(17, isin)]
    line = F.when(k % 9 == 0, "short,row").otherwise(F.concat_ws(",", *fields))
    rows = t.load(spark, d, "customer").select(F.floor(k / 2).alias("pair"), F.struct(k.alias("k"), line.alias("line")).alias("x")).groupBy((F.col("pair") % 4).alias("file")).agg(F.array_sort(F.collect_list("x")).alias("x"))
    path = fresh_path(spark, "sector-csv")
    text = F.concat(F.lit("\ufeffCompany Name,Industry,Symbol,Series,ISIN Code\n"), F.array_join("x.line", "\n"))
    rows.select(text.alias("value"), "file").repartition(4, "file").write.partitionBy("file").text(path)
    return reference.sector_list(reference.numbered_fields(spark, path), ["BUILDING", "MACHINERY"]).select("instrument_key", "symbol", "sector", "company", "is_cyclical")


@query("""SELECT 'K' || c_custkey AS instrument_key, 'S' || c_custkey AS symbol, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 5 <> 0 THEN 'M' || (c_nationkey % 3) END AS macro_sector, c_mktsegment AS sector, CASE WHEN c_custkey % 7 <> 0 THEN 'I, ' || c_nationkey END AS industry, CASE WHEN c_custkey % 3 <> 0 THEN 'Basic x' END AS basic_industry, c_mktsegment = 'BUILDING' AS is_cyclical FROM customer WHERE c_custkey % 11 <> 0""")
def seed_csv(spark, d):
    """Seeds of six fields, and of the older five without the macro tier, with blanks in every tier; lines dealt over tasks."""
    ship(spark)
    c, k = t.load(spark, d, "customer"), F.col("c_custkey")
    blank = lambda n, x: F.when(k % n == 0, "").otherwise(x)
    cols = {"instrument_key": F.concat(F.lit("k"), k), "symbol": F.concat(F.lit(" s"), k), "macro_sector": blank(5, F.concat(F.lit("M"), F.col("c_nationkey") % 3)), "sector": blank(11, F.concat(F.lit("  "), "c_mktsegment")), "industry": blank(7, F.concat(F.lit('"I,  '), "c_nationkey", F.lit('"'))), "basic_industry": blank(3, F.lit("\uff22asic  x"))}
    paths = []
    for odd, names in ((0, list(cols)), (1, [n for n in cols if n != "macro_sector"])):
        paths.append(fresh_path(spark, "seed-csv"))
        head = spark.createDataFrame([(",".join(names),)], "value string")
        lines = c.filter(k % 2 == odd).select(F.concat_ws(",", *(cols[n] for n in names)).alias("value"))
        head.union(lines).coalesce(1).write.text(paths[-1])
    one, two = (reference.seed_list(reference.numbered_fields(spark, p, whole=False), ["building"]) for p in paths)
    return one.unionByName(two)


def _catalog(spark, d):
    """The catalog of baskets as a CSV, one for each supplier, some without a file."""
    s, k = t.load(spark, d, "supplier"), F.col("s_suppkey")
    path = fresh_path(spark, "catalog-csv")
    s.select(F.when(k % 10 != 0, F.concat(F.lit("lists/f"), k, F.lit(".csv"))).otherwise(" ").alias("csv_path"), F.concat(F.lit("IDX:"), k).alias("index_key"), F.col("s_name").alias("index_name"), F.concat(F.lit("nation "), "s_nationkey").alias("family"), (k % 2 == 0).cast("string").alias("rotation"), F.when(k % 3 == 0, F.concat(F.lit("Basket "), k)).alias("display_label")).write.csv(path, header=True)
    return reference.catalog(spark, path)


@query("""SELECT 'lists/f' || s_suppkey || '.csv' AS csv_path, 'IDX:' || s_suppkey AS index_key, s_name AS index_name, 'nation ' || s_nationkey AS family, CASE WHEN s_suppkey % 2 = 0 THEN 'true' ELSE 'false' END AS rotation, CASE WHEN s_suppkey % 3 = 0 THEN 'Basket ' || s_suppkey END AS display_label FROM supplier WHERE s_suppkey % 10 <> 0""")
def catalog_csv(spark, d):
    return _catalog(spark, d)


_FILES = """members AS (SELECT DISTINCT l_suppkey AS f, l_partkey AS p FROM lineitem), ok AS (SELECT f FROM members WHERE f % 7 <> 0 AND f % 10 <> 0 GROUP BY f HAVING count(*) FILTER (WHERE p % 11 <> 0) >= 20),
kept AS (SELECT m.f, m.p FROM members m JOIN ok ON ok.f = m.f WHERE m.p % 11 <> 0)"""


def _baskets(spark, d):
    """Whole basket files of the parts that each supplier has sold; every seventh is a page, every eleventh part has no symbol."""
    p = F.col("l_partkey")
    line = F.concat(F.lit('"Part, '), p, F.lit('",Parts,'), F.when(p % 11 == 0, "").otherwise(F.concat(F.lit("P"), p)), F.lit(",EQ,"), F.lit("INE"), F.lpad(p.cast("string"), 9, "0"))
    files = t.load(spark, d, "lineitem").select("l_suppkey", line.alias("line")).distinct().groupBy("l_suppkey").agg(F.array_join(F.collect_list("line"), "\r\n").alias("body"))
    head = F.when(F.col("l_suppkey") % 7 == 0, "<html><body>").otherwise(F.element_at(F.array(*map(F.lit, reference.BASKET_HEADERS)), (F.col("l_suppkey") % 2 + 1).cast("int")))
    texts = files.select(F.concat(F.lit("s3/f"), "l_suppkey", F.lit(".csv")).alias("source_file"), F.concat(F.lit("﻿"), head, F.lit("\r\n"), "body", F.lit("\r\n")).alias("text"))
    return reference.basket_members(texts, _catalog(spark, d), least=20)


@query(f"""WITH {_FILES} SELECT 's3/f' || f || '.csv' AS source_file, 'INE' || lpad(CAST(p AS VARCHAR), 9, '0') AS isin, 'P' || p AS symbol, 'Part, ' || p AS company, 'IDX:' || f AS index_key, CASE WHEN f % 3 = 0 THEN 'Basket ' || f ELSE s_name END AS display_label FROM kept JOIN supplier ON s_suppkey = f""")
def basket_files(spark, d):
    """Basket files with a known header and enough members, under the names of the catalog."""
    return _baskets(spark, d).select("source_file", "isin", "symbol", "company", "index_key", "display_label")


@query(f"WITH {_FILES} SELECT count(*) AS n_rows, count(DISTINCT f) AS n_indices, count(DISTINCT f) || ' indices' AS message FROM kept")
def index_count(spark, d):
    return master.index_count(_baskets(spark, d))


@query("""SELECT CASE WHEN c_custkey % 5 = 0 THEN 'INE' ELSE 'INE0' END || c_custkey AS isin, 'S' || c_custkey AS symbol, c_name AS name, CASE WHEN c_nationkey > 0 THEN CAST(c_nationkey AS DOUBLE) END AS face_value, CAST(NULL AS DOUBLE) AS mktcap FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 4 <> 0""")
def listed_universe(spark, d):
    """The listing as a CSV: EQ rows with an INE prefix, face values that are not positive left out."""
    c, k = t.load(spark, d, "customer"), F.col("c_custkey")
    prefix = F.when(k % 4 == 0, "INF").when(k % 5 == 0, "INE").otherwise("INE0")
    path = fresh_path(spark, "listed-csv")
    c.select(F.concat(F.lit("S"), k).alias("SYMBOL"), F.col("c_name").alias("NAME OF COMPANY"), F.when(k % 3 == 0, "EQ").otherwise("BE").alias(" SERIES"), F.concat(prefix, k).alias(" ISIN NUMBER"), F.concat(F.lit(" "), "c_nationkey").alias(" FACE VALUE")).write.csv(path, header=True)
    return reference.listed_universe(prices.read_text_csv(spark, path))


_TIERS = ("/the", "/and", "/en")


@query(r"""WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\b[^>]*\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a>', 1) AS h, regexp_extract_all(html, '(?is)<a\b[^>]*\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a>', 2) AS l FROM pages),
x AS (SELECT page_id, lower(unnest(h)) AS name, trim(regexp_replace(unnest(l), '\s+', ' ', 'g')) AS label FROM a), o AS (SELECT page_id, name, CASE WHEN min(label) = max(label) THEN min(label) END AS label FROM x WHERE label <> '' AND name IN ('/the', '/and', '/en') GROUP BY 1, 2),
w AS (SELECT page_id, max(label) FILTER (WHERE name = '/the') AS a, max(label) FILTER (WHERE name = '/and') AS b FROM o GROUP BY 1 HAVING bool_or(name <> '/en'))
SELECT page_id, CASE WHEN b IS NOT NULL THEN a END AS "/the", CASE WHEN a IS NOT NULL THEN b END AS "/and" FROM w""")
def page_tiers(spark, d):
    """Anchors named by an attribute as label columns: conflicting texts are null, and all are null where one is missing."""
    ship(spark)
    pages = t.load(spark, d, "pages").select("page_id", F.regexp_replace(F.regexp_replace("html", '(?i)href="/the"', 'href="/the"'), '(?i)href="/and"', 'href="/and"').alias("html"))
    return reference.page_labels(pages, _TIERS[:2], "href")


@query("""SELECT c_custkey AS page_id, CASE WHEN ok THEN 'Goods & ' || c_nationkey END AS "Sector", CASE WHEN ok THEN c_name || ' <x>' END AS "Industry" FROM (SELECT *, c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AS ok FROM customer) WHERE c_custkey % 11 <> 0""")
def label_pages(spark, d):
    """Pages with labels in either quote or none, in nested tags, with character references, among comments and scripts; some lack a label,
    some have two texts for one, some have none."""
    ship(spark)
    k = F.col("c_custkey")
    html = F.concat(
        F.lit("<html><!-- <a title='Sector'>No</a> --><script>'<a title=\"Industry\">No</a>'</script>"),
        F.when(k % 11 == 0, "<p>none").otherwise(F.concat(F.element_at(F.array(F.lit("<A href=x\n TITLE='Sector'>"), F.lit("<a title=Sector >"), F.lit('<a data-x=">" title = "Sector">')), (k % 3 + 1).cast("int")), F.lit(" <b>Goods</b>\n&amp; "), "c_nationkey", F.lit("</a>"))),
        F.when((k % 5 == 0) | (k % 11 == 0), "").otherwise(F.concat(F.lit("<a title='Industry'>"), "c_name", F.lit(" &lt;x&#62;</A>"))),
        F.when((k % 7 == 0) & (k % 11 != 0), "<a title='Sector'>Other</a>").otherwise("<a title='Sectors'>Other</a><a>x</a>"),
    )
    return reference.page_labels(t.load(spark, d, "customer").select(k.alias("page_id"), html.alias("html")), ["Sector", "Industry"])


# ---- tables


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1")
def pruned_years(spark, d):
    """Two columns of all year partitions of a stored table."""
    path = fresh_path(spark, "years")
    o = t.load(spark, d, "orders")
    o.withColumn("year", F.year("o_orderdate")).write.partitionBy("year").parquet(path)
    schema = T.StructType([*o.schema.fields, T.StructField("year", T.IntegerType())])
    rows = store.read_years(spark, path, schema, columns=["year", "o_totalprice"])
    return rows.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query("SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS sector, '' AS note, FALSE AS audited, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def absent_columns(spark, d):
    """A stored table read in a newer layout: absent columns get their default or null, extra ones are left out."""
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("sector", T.StringType()), T.StructField("note", T.StringType()), T.StructField("audited", T.BooleanType()), T.StructField("c_nationkey", T.LongType())])
    return store.with_absent(t.load(spark, d, "customer"), schema, {"note": "", "audited": False})


@query("""WITH c AS (SELECT count(*) AS n FROM customer) SELECT * FROM (SELECT 'first' AS artifact, 1 AS version, CAST(NULL AS VARCHAR) AS error, n FROM c UNION ALL SELECT 'second', 2, NULL, n FROM c UNION ALL SELECT 'repeated', 2, 'duplicate keys', NULL FROM c UNION ALL SELECT 'other', NULL, 'unknown columns', NULL FROM c)""")
def versioned_read(spark, d):
    """Artifacts in either of two layouts are read, others and those with repeated keys are refused."""
    c = t.load(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    layouts = {1: {"c_custkey", "c_name"}, 2: {"c_custkey", "c_name", "c_mktsegment"}}
    tried = {"first": c.drop("c_mktsegment"), "second": c, "repeated": c.unionByName(c.limit(1)), "other": c.withColumnRenamed("c_name", "label")}
    out = None
    for name, table in tried.items():
        path = fresh_path(spark, "artifact")
        table.write.parquet(path)
        rows, version, error = reference.versioned(spark.read.parquet(path), layouts, "c_custkey")
        n = F.lit(None).cast("bigint") if rows is None else F.lit(rows.count())
        row = spark.range(1).select(F.lit(name).alias("artifact"), F.lit(version).cast("int").alias("version"), F.lit(error).cast("string").alias("error"), n.alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


@query("""WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders) SELECT date, 'off' AS kind, NULL AS label FROM o WHERE day(date) % 5 = 0 UNION ALL SELECT date, 'on', 'day ' || day(date) FROM o WHERE day(date) % 6 = 1""")
def calendar_files(spark, d):
    """Holidays as a JSON map of years, sessions as a JSON list, both written from the days of orders and read back."""
    days = t.load(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    off, on = fresh_path(spark, "holidays"), fresh_path(spark, "sessions")
    day = F.dayofmonth("date")
    years = days.filter(day % 5 == 0).groupBy(F.year("date").cast("string").alias("y")).agg(F.collect_list(F.col("date").cast("string")).alias("d"))
    years.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("y", "d")))).alias("value")).write.text(off)
    sessions = days.filter(day % 6 == 1).agg(F.collect_list(F.struct(F.col("date").cast("string").alias("date"), F.concat(F.lit("day "), day).alias("label"))).alias("sessions"))
    sessions.select(F.to_json(F.struct("sessions")).alias("value")).write.text(on)
    holidays, special = reference.calendar_sources(spark, off, on)
    return holidays.select("date", F.lit("off").alias("kind"), F.lit(None).cast("string").alias("label")).unionByName(special.select("date", F.lit("on").alias("kind"), "label"))


# ---- gates and extension points

_NEEDED = {"orders": ("o_orderkey", "o_custkey", "o_shippriority", "o_clerk"), "lineitem": ("l_orderkey", "l_comment"), "customer": ("c_custkey", "c_name")}


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS dataset, coalesce((SELECT string_agg(c, ';' ORDER BY c) FROM (SELECT unnest({list(cols)}) AS c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE {n}))), '') AS missing, (SELECT count(*) FROM {n}) AS n_rows" for n, cols in _NEEDED.items()) + ")")
def required_columns(spark, d):
    """The sorted names of required columns that a table lacks, with its rows."""
    out = None
    for name, cols in _NEEDED.items():
        df = t.load(spark, d, name)
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), F.lit(";".join(gates.missing_columns(df, cols))).alias("missing"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


@query(f"WITH {t.BARS}, x AS (SELECT CASE WHEN day(date) % 2 = 0 THEN 'mirror' ELSE source END AS source FROM bars) SELECT source, count(*) AS n FROM x GROUP BY 1")
def provenance_stamp(spark, d):
    """Days that a mirror served carry its name, the others the default."""
    b, even = t.bars(spark, d), F.dayofmonth("date") % 2 == 0
    rows = prices.stamped(b.filter(even), "mirror").unionByName(prices.stamped(b.filter(~even), None))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {t.BARS}, q AS (SELECT unnest([DATE '2024-01-15', DATE '1999-01-01']) AS day) SELECT day, EXISTS (SELECT 1 FROM bars WHERE bars.date = q.day) AS present FROM q")
def day_present(spark, d):
    b, out = t.bars(spark, d), None
    for day in ("2024-01-15", "1999-01-01"):
        literal = F.lit(day).cast("date")
        row = store.day_present(b, literal).select(literal.alias("day"), "present")
        out = row if out is None else out.unionByName(row)
    return out


@query(f"WITH {t.BARS} SELECT date, count(*) AS n_rows, count(*) BETWEEN 2000 AND 10000 AS passed FROM bars GROUP BY date")
def dataset_normalizer(spark, d):
    """A dataset of the registry: its normalizer on raw rows, its bounds on the rows of a day."""
    dataset = default_registry().datasets["equity_bars"]
    return gates.row_count_gate(dataset.normalize(t.raw_primary(spark, d)), *dataset.rows_per_day, ["date"])


@query(f"WITH {t.BARS}, {DISC} SELECT date, count(*) AS n FROM flag WHERE dev > 0.005 GROUP BY date")
def derived_table(spark, d):
    """A derived table of the registry, built from its declared input."""
    return default_registry().build("ca_flags", {"equity_bars": t.bars(spark, d)}).groupBy("date").agg(F.count(F.lit(1)).alias("n"))
