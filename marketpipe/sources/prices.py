"""Daily price files in four shapes, read and brought to the canonical bar."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import index_key, instrument_key, strict_date
from ..operators.gates import require_columns
from ..operators.master import lookup_isin
from ..schemas import BARS, PRIMARY

#: Column names of the files.
INDEX_COLUMNS = ("Index Name", "Index Date", "Open Index Value", "High Index Value", "Low Index Value", "Closing Index Value", "Points Change", "Volume", "Turnover (Rs. Cr.)")
FULL_COLUMNS = ("SYMBOL", "SERIES", "DATE1", "PREV_CLOSE", "OPEN_PRICE", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE", "TTL_TRD_QNTY", "TURNOVER_LACS", "NO_OF_TRADES")
LEGACY_COLUMNS = ("SYMBOL", "SERIES", "OPEN", "HIGH", "LOW", "CLOSE", "PREVCLOSE", "TOTTRDQTY", "TOTTRDVAL", "TIMESTAMP", "TOTALTRADES", "ISIN")


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all columns as text, names and values trimmed."""
    df = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, encoding="UTF-8")
    return df.toDF(*(c.replace("﻿", "").strip() for c in df.columns))


def read_primary(spark: SparkSession, path: str) -> DataFrame:
    """The primary daily file: typed columns by name; extra columns are left out."""
    raw = require_columns(read_text_csv(spark, path), PRIMARY.names)
    return raw.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if not isinstance(f.dataType, T.LongType) else F.col(f.name).cast("double").cast("bigint").alias(f.name) for f in PRIMARY))


def read_zipped(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """The first member of each archive, a CSV with a header, as text columns. Archives are a day's file each."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    got = pd.read_csv(z.open(z.namelist()[0]), dtype=str, skipinitialspace=True)
                got.columns = [c.strip() for c in got.columns]
                yield got.reindex(columns=columns).apply(lambda s: s.str.strip())

    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(work, schema)


def normalize_primary(raw: DataFrame, source: str = "primary") -> DataFrame:
    """Stock rows of the final sessions as canonical bars; null isin, symbol and series become empty."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = require_columns(raw, PRIMARY.names).filter((F.col("FinInstrmTp") == "STK") & F.col("SsnId").isin("F1", "F2"))
    return rows.select(
        F.col("TradDt").cast("date").alias("date"), instrument_key("ISIN", "TckrSymb").alias("instrument_key"), text("ISIN").alias("isin"), text("TckrSymb").alias("symbol"), text("SctySrs").alias("series"),
        F.col("OpnPric").alias("open"), F.col("HghPric").alias("high"), F.col("LwPric").alias("low"), F.col("ClsPric").alias("close"), F.col("PrvsClsgPric").alias("prevclose"),
        F.col("TtlTradgVol").cast("bigint").alias("volume"), F.col("TtlTrfVal").alias("value"), F.col("TtlNbOfTxsExctd").cast("bigint").alias("trades"), F.lit(source).alias("source"),
    )


def stamped(bars: DataFrame, served_by: str | None) -> DataFrame:
    """The source that actually served the bars."""
    return bars if served_by is None else bars.withColumn("source", F.lit(served_by))


def _number(name: str) -> Column:
    return F.expr(f"try_cast(replace(trim(`{name}`), ',', '') as double)")


def normalize_indices(raw: DataFrame, source: str = "indices") -> DataFrame:
    """Index closes as bars: date and close must parse; open, high, low fall back to close, volume and value to 0."""
    require_columns(raw, INDEX_COLUMNS)
    close = F.col("Closing Index Value").cast("double")
    or_close = lambda c: F.coalesce(_number(c), close)
    return raw.select(
        strict_date("Index Date", "dd-MM-yyyy").alias("date"), F.concat(F.lit("IDX:"), index_key("Index Name")).alias("instrument_key"), F.lit("").alias("isin"), F.trim("Index Name").alias("symbol"), F.lit("INDEX").alias("series"),
        or_close("Open Index Value").alias("open"), or_close("High Index Value").alias("high"), or_close("Low Index Value").alias("low"), close.alias("close"),
        (close - F.coalesce(_number("Points Change"), F.lit(0.0))).alias("prevclose"), F.coalesce(_number("Volume"), F.lit(0.0)).cast("bigint").alias("volume"), F.coalesce(_number("Turnover (Rs. Cr.)"), F.lit(0.0)).alias("value"),
        F.lit(0).cast("bigint").alias("trades"), F.lit(source).alias("source"),
    )


def _adapted(raw: DataFrame, day: str, names: dict[str, str], scale: float) -> DataFrame:
    """Alternate shapes in the primary's columns: strict date and close, flat bars where prices are missing, value scaled."""
    close = F.trim(names["close"]).cast("double")
    or_close = lambda k: F.coalesce(_number(names[k]), close)
    isin = F.trim("ISIN") if "ISIN" in raw.columns else F.col("isin")
    return raw.select(
        strict_date(F.initcap(F.lower(F.trim(day))), "dd-MMM-yyyy").alias("TradDt"), F.lit("STK").alias("FinInstrmTp"), isin.alias("ISIN"), F.trim("SYMBOL").alias("TckrSymb"), F.trim("SERIES").alias("SctySrs"), F.lit("F1").alias("SsnId"),
        or_close("open").alias("OpnPric"), or_close("high").alias("HghPric"), or_close("low").alias("LwPric"), close.alias("ClsPric"), or_close("prev").alias("PrvsClsgPric"),
        F.coalesce(_number(names["volume"]), F.lit(0.0)).cast("bigint").alias("TtlTradgVol"), (F.coalesce(_number(names["value"]), F.lit(0.0)) * scale).alias("TtlTrfVal"), F.coalesce(_number(names["trades"]), F.lit(0.0)).cast("bigint").alias("TtlNbOfTxsExctd"),
    )


def adapt_full(raw: DataFrame, master: DataFrame) -> DataFrame:
    """The full file: turnover in lakhs, ISIN by (symbol, series) from the master."""
    named = lookup_isin(require_columns(raw, FULL_COLUMNS).withColumns({"symbol": F.trim("SYMBOL"), "series": F.trim("SERIES")}), master)
    return _adapted(named, "DATE1", {"close": "CLOSE_PRICE", "open": "OPEN_PRICE", "high": "HIGH_PRICE", "low": "LOW_PRICE", "prev": "PREV_CLOSE", "volume": "TTL_TRD_QNTY", "value": "TURNOVER_LACS", "trades": "NO_OF_TRADES"}, 100_000)


def adapt_legacy(raw: DataFrame) -> DataFrame:
    """The legacy file: its own ISIN, value as it is."""
    require_columns(raw, LEGACY_COLUMNS)
    return _adapted(raw, "TIMESTAMP", {"close": "CLOSE", "open": "OPEN", "high": "HIGH", "low": "LOW", "prev": "PREVCLOSE", "volume": "TOTTRDQTY", "value": "TOTTRDVAL", "trades": "TOTALTRADES"}, 1)


def conform(bars: DataFrame) -> DataFrame:
    """Columns in the declared order and types."""
    return bars.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in BARS))
