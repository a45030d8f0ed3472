"""Declared schemas and their contracts."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(spec: str) -> T.StructType:
    """'name type' pairs, separated by commas; a trailing '!' marks a column that must not be null."""
    kinds = {"string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType(), "date": T.DateType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, kinds[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


PRIMARY = struct("TradDt date, FinInstrmTp string, ISIN string, TckrSymb string, SctySrs string, SsnId string, OpnPric double, HghPric double, LwPric double, ClsPric double, PrvsClsgPric double, TtlTradgVol long, TtlTrfVal double, TtlNbOfTxsExctd long")
BARS = struct("date date!, instrument_key string!, isin string, symbol string!, series string!, open double!, high double!, low double!, close double!, prevclose double!, volume long!, value double!, trades long!, source string!")
BAR_KEY = ("date", "instrument_key")
INSTRUMENTS = struct("instrument_key string, isin string, symbol string, name string, series string, first_seen date, last_seen date, status string, valid_from date, valid_to date, date date")
CA_FLAGS = struct("date date, instrument_key string, close_prev double, prevclose_today double, implied_ratio double")
SECTORS = struct("instrument_key string, symbol string, macro_sector string, sector string, industry string, basic_industry string, is_cyclical boolean, cyclicality_rule_version int, date date")
REGISTRY = struct("isin string, symbol string, status string, macro_sector string, sector string, industry string, basic_industry string, classification_status string, attempts int, retry_on date, last_audit_on date, absences int")
OBSERVATIONS = struct("isin string, symbol string, outcome string, macro_sector string, sector string, industry string, basic_industry string, observed_on date, source string")
FACTS = struct("filing string, element string, context string, value string, ordinal int")
FUND_KEY = ("instrument_key", "period_end", "fiscal_quarter", "basis")
