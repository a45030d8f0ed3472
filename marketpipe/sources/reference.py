"""Listings, sector seeds, index baskets, calendars, catalogs and labelled pages."""

from __future__ import annotations

import csv
import io
import unicodedata
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import canonical_label, last_segment, or_default, positive, scrip_code
from ..operators.sectors import cyclical, cyclical_plain
from ..operators.store import duplicate_keys, keep_first
from .prices import read_text_csv

#: Accepted headers of a basket file.
BASKET_HEADERS = ("Company Name,Industry,Symbol,Series,ISIN Code", "Company Name,Industry,Symbol,Series,ISIN")


#: Rows of a CSV file handed on at once.
CHUNK = 10_000
FIELDS = "file string, row struct<part: bigint, nth: bigint>, f array<string>"


def numbered_fields(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """FIELDS: the data rows of CSV files as arrays of trimmed fields, the header left out; row gives their order.

    Every field keeps its place: a blank one is an empty text, and a row has as many fields as its line. whole reads each file in one
    piece, so that quoted fields may hold line breaks; without it lines are dealt over tasks, for files that are too large for one."""

    def records(text: str) -> Iterator[list[str]]:
        return ([x.strip() for x in r] for r in csv.reader(io.StringIO(text, newline="")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.struct([("part", pa.int64()), ("nth", pa.int64())]), pa.list_(pa.string()))
        for batch in batches:
            out: list[tuple] = []
            for file, part, text in zip(*(c.to_pylist() for c in batch.columns)):
                for nth, f in enumerate(records((text or "").removeprefix("\ufeff"))):
                    out.append((file, {"part": part, "nth": nth}, f))
                    if len(out) == CHUNK:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["file", "row", "f"])
                        out = []
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 3, kinds)], names=["file", "row", "f"])

    texts = spark.read.text(path, wholetext=whole).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("part"), "value")
    if whole:
        return texts.mapInArrow(work, FIELDS).filter("row.nth > 0")
    # a line is one record, unless nothing is in it; the header is known without reading fields, so Python sees each line once
    header = texts.filter(~F.col("value").isin("", "\ufeff")).groupBy("file").agg(F.min("part").alias("_first"))
    return texts.join(F.broadcast(header), "file").filter("part > _first").select(*texts.columns).mapInArrow(work, FIELDS)  # one row per file


def _upper(i: int) -> Column:
    return F.upper(F.get("f", F.lit(i)))


def sector_list(fields: DataFrame, cyclical_names: Iterable[str] = ()) -> DataFrame:
    """Five fields by position (company, industry, symbol, series, ISIN). Short rows go, and rows without an ISIN, symbol or industry; a
    blank company or series is no reason. Keys and symbols are upper-case; the first row of an ISIN wins."""
    rows = fields.filter(F.size("f") >= 5).select("row", _upper(4).alias("instrument_key"), _upper(2).alias("symbol"), F.col("f")[1].alias("sector"), F.col("f")[0].alias("company"))
    rows = rows.filter("instrument_key <> '' and symbol <> '' and sector <> ''").withColumn("is_cyclical", cyclical("sector", cyclical_names))
    return keep_first(rows, ["instrument_key"], ["row"]).drop("row")


def seed_list(fields: DataFrame, cyclical_names: Iterable[str] = ()) -> DataFrame:
    """Seed rows of four tiers; rows of five fields are of the older layout without the macro tier. Labels are canonical, keys and symbols
    upper-case. Rows without key, symbol or sector go, other blank tiers are null; the first row of a key wins. cyclical_names: plain."""
    wide = F.size("f") >= 6
    at = lambda i: F.nullif(canonical_label(F.when(wide, F.get("f", F.lit(i))).otherwise(F.get("f", F.lit(i - 1)))), F.lit(""))
    macro = F.nullif(canonical_label(F.when(wide, F.get("f", F.lit(2)))), F.lit(""))
    rows = fields.filter(F.size("f") >= 5).select("row", _upper(0).alias("instrument_key"), _upper(1).alias("symbol"), macro.alias("macro_sector"), at(3).alias("sector"), at(4).alias("industry"), at(5).alias("basic_industry"))
    rows = rows.filter("instrument_key <> '' and symbol <> '' and sector is not null").withColumn("is_cyclical", cyclical_plain("sector", cyclical_names))
    return keep_first(rows, ["instrument_key"], ["row"]).drop("row")


def basket_members(texts: DataFrame, catalog: DataFrame, least: int = 5) -> DataFrame:
    """texts (source_file, text) with whole basket files -> members of the files whose header is known and that have enough rows.

    catalog: csv_path, index_key, index_name, family, rotation, display_label. Pages that are no basket are rejected, not read as empty.
    """
    lines = F.split(F.regexp_replace(F.regexp_replace("text", "﻿", ""), "\r", ""), "\n")
    known = F.regexp_replace(F.trim(lines[0]), '"', "").isin(*BASKET_HEADERS)
    fields = lambda line: F.when(line.contains('"'), F.split(line, ",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)")).otherwise(F.split(line, ","))
    body = F.filter(F.slice(lines, 2, 1_000_000_000), lambda x: F.trim(x) != "")
    rows = texts.filter(known).select("source_file", F.explode(F.transform(body, fields)).alias("f"))  # each line is split once
    bare = lambda x: F.when(x.contains('"'), F.regexp_replace(x, '^"|"$', "")).otherwise(x)
    part = lambda i: bare(F.trim(F.get("f", F.lit(i))))
    rows = rows.select("source_file", part(0).alias("company"), part(1).alias("industry"), part(2).alias("symbol"), part(3).alias("series"), part(4).alias("isin"))
    # a file's rows stay together for both: they were one text before
    rows = rows.filter((F.length("isin") == 12) & (F.col("symbol") != "")).repartition("source_file").dropDuplicates(["source_file", "isin"])
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("source_file"))).filter(F.col("_n") >= least).drop("_n")
    names = catalog.select(last_segment("csv_path").alias("_file"), "index_key", "index_name", "family", "rotation", or_default("display_label", "index_name").alias("display_label"))
    return rows.join(names, last_segment("source_file") == F.col("_file")).drop("_file")


def listed_equities(raw: DataFrame, series: Iterable[str] = ("EQ", "BE")) -> DataFrame:
    """(isin, symbol) of the listing's equity rows; headers are taken trimmed and upper-case."""
    up = raw.toDF(*(c.strip().upper() for c in raw.columns))
    rows = up.filter(F.upper(F.trim("SERIES")).isin(list(series))).select(F.upper(F.trim("ISIN NUMBER")).alias("isin"), F.upper(F.trim("SYMBOL")).alias("symbol"))
    return rows.filter("isin <> '' and symbol <> ''")


def listed_universe(raw: DataFrame) -> DataFrame:
    """EQ rows with an INE prefix: isin, symbol, name, optional positive face value."""
    up = raw.toDF(*(c.strip().upper() for c in raw.columns))
    face = positive(F.expr("try_cast(trim(`FACE VALUE`) as double)")) if "FACE VALUE" in up.columns else F.lit(None).cast("double")
    rows = up.filter((F.trim("SERIES") == "EQ") & F.trim("ISIN NUMBER").startswith("INE"))
    return rows.select(F.trim("ISIN NUMBER").alias("isin"), F.trim("SYMBOL").alias("symbol"), F.trim("NAME OF COMPANY").alias("name"), face.alias("face_value"), F.lit(None).cast("double").alias("mktcap"))


def scrip_master(json_rows: DataFrame) -> DataFrame:
    """Active equity rows with an INE prefix of a JSON array read with text columns; values that are not positive become null."""
    number = lambda c: positive(F.expr(f"try_cast(replace(trim({c}), ',', '') as double)"))
    rows = json_rows.filter(F.trim("ISIN_NUMBER").startswith("INE") & (F.col("Status") == "Active") & (F.col("Segment") == "Equity"))
    return rows.select(F.trim("ISIN_NUMBER").alias("isin"), scrip_code("SCRIP_CD").alias("scrip_code"), F.trim("scrip_id").alias("symbol"), F.coalesce(F.nullif(F.trim("Issuer_Name"), F.lit("")), F.trim("Scrip_Name")).alias("name"), number("FACE_VALUE").alias("face_value"), number("Mktcap").alias("mktcap"))


def calendar_sources(spark: SparkSession, holidays: str, sessions: str) -> tuple[DataFrame, DataFrame]:
    """Holidays from a JSON map year -> dates, special sessions from {"sessions": [{"date", "label"}]}."""
    off = spark.read.text(holidays, wholetext=True).select(F.explode(F.flatten(F.map_values(F.from_json("value", "map<string, array<string>>")))).alias("d")).select(F.col("d").cast("date").alias("date"))
    on = spark.read.text(sessions, wholetext=True).select(F.explode(F.from_json("value", "struct<sessions: array<struct<date: string, label: string>>>")["sessions"]).alias("s"))
    return off, on.select(F.col("s.date").cast("date").alias("date"), F.col("s.label").alias("label"))


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalog rows that name a file."""
    return read_text_csv(spark, path).filter(F.coalesce(F.trim("csv_path"), F.lit("")) != "")


class Anchors(HTMLParser):
    """The texts of a page's anchors whose attribute has one of some names. Comments, scripts and styles hold none; an anchor within an
    open one belongs to its text; one that never closes has none."""

    def __init__(self, names: frozenset[str], attribute: str):
        super().__init__(convert_charrefs=True)
        self.names, self.attribute = names, attribute
        self.found: list[tuple[str, str]] = []
        self.name: str | None = None
        self.text: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        name = dict(attrs).get(self.attribute) if tag == "a" and self.name is None else None
        if name in self.names:
            self.name, self.text = name, []

    def handle_data(self, data: str) -> None:
        if self.name is not None:
            self.text.append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self.name is not None:
            self.found.append((self.name, " ".join(unicodedata.normalize("NFKC", "".join(self.text)).split())))
            self.name = None


def named_anchors(pages: DataFrame, names: Iterable[str], attribute: str = "title") -> DataFrame:
    """(page_id, name, label) of each anchor with one of the names and a text, by an event parser in one Arrow pass."""
    wanted = frozenset(names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, html in zip(batch.column(0), batch.column(1).to_pylist()):
                parser = Anchors(wanted, attribute)
                parser.feed(html or "")
                parser.close()
                out += [(page, name, label) for name, label in parser.found if label]
            cols = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array([p.as_py() for p in cols[0]], batch.schema.field(0).type), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], names=["page_id", "name", "label"])

    return pages.select("page_id", "html").mapInArrow(work, f"page_id {pages.schema['page_id'].dataType.simpleString()}, name string, label string")


def page_labels(pages: DataFrame, names: Iterable[str], attribute: str = "title") -> DataFrame:
    """(page_id, one column per label name) of the pages with any of them: the text of the anchors whose attribute has that name. If the
    texts of a name conflict or any name is missing all are null."""
    names = list(names)
    one = named_anchors(pages, names, attribute).groupBy("page_id", "name").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    one = one.select("page_id", "name", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("label"))
    wide = one.groupBy("page_id").agg(*(F.max(F.when(F.col("name") == n, F.col("label"))).alias(n) for n in names))
    whole = F.lit(True)
    for n in names:
        whole = whole & F.col(n).isNotNull()
    return wide.select("page_id", *(F.when(whole, F.col(n)).alias(n) for n in names))


def anchor_labels(pages: DataFrame) -> DataFrame:
    """(page_id, href, n_texts, label): each distinct target of a page; label is null where its anchors' texts conflict."""
    pattern = F.lit(r'(?is)<a\b[^>]*\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a>')
    zipped = F.arrays_zip(F.regexp_extract_all("html", pattern, F.lit(1)).alias("href"), F.regexp_extract_all("html", pattern, F.lit(2)).alias("label"))
    rows = pages.select("page_id", F.explode(zipped).alias("x")).select("page_id", "x.href", F.trim(F.regexp_replace("x.label", r"\s+", " ")).alias("label"))
    return rows.groupBy("page_id", "href").agg(F.count_distinct("label").alias("n_texts"), F.when(F.min("label") == F.max("label"), F.min("label")).alias("label"))


def versioned(df: DataFrame, layouts: dict[int, set[str]], key: str) -> tuple[DataFrame | None, int | None, str | None]:
    """(records, version, error): a table with exactly the columns of one of the layouts and without repeated keys."""
    version = next((v for v, cols in layouts.items() if set(df.columns) == cols), None)
    if version is None:
        return None, None, "unknown columns"
    if not duplicate_keys(df, [key]).isEmpty():
        return None, version, "duplicate keys"
    return df, version, None
