"""Filing lists in JSON, and documents as fact tables."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import inclusive_days, machine_locator, month_name_date, scrip_code
from ..operators.filings import sector_of_file

DISCOVERY = "struct<Table: array<struct<Scrip_cd: string, quarter_code: string, audited: string, Fld_CreateDate: string, Fld_NatureOfReport: string, XMLName: string, Consol_XMLName: string>>>"
FILING_LIST = "struct<data: array<struct<symbol: string, qe_Date: string, consolidated: string, seq_Id: string, audited: string, xbrl: string>>>"
EXTRACTED = "filing string, kind string, element string, context string, value string, ordinal int"


def discovered(bodies: DataFrame) -> DataFrame:
    """bodies (body) of {"Table": [...]} -> refs: each row's own document, its consolidated twin where that differs, or one pending
    ref without a locator where there is neither."""
    rows = bodies.select(F.explode(F.from_json("body", DISCOVERY)["Table"]).alias("r")).select("r.*")
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    own, twin = blank("XMLName"), blank("Consol_XMLName")
    nature = F.lower(F.trim("Fld_NatureOfReport"))
    hint = F.when(nature.startswith("consol"), "consolidated").when(nature.startswith("stand"), "standalone")
    ref = lambda when, locator, basis: F.when(when, F.struct(locator.alias("locator"), basis.alias("basis")))
    none = F.lit(None).cast("string")
    refs = F.array_compact(F.array(ref(own.isNotNull(), own, hint), ref(twin.isNotNull() & ~twin.eqNullSafe(own), twin, F.lit("consolidated")), ref(own.isNull() & twin.isNull(), none, hint)))
    out = rows.select(scrip_code("Scrip_cd").alias("scrip_code"), F.col("quarter_code").alias("period"), (F.lower("audited") == "audited").alias("is_audited"), F.try_to_timestamp("Fld_CreateDate").alias("broadcast"), F.explode(refs).alias("x"))
    return out.select("scrip_code", "period", "is_audited", "broadcast", machine_locator("x.locator").alias("locator"), "x.basis")


def filing_list(bodies: DataFrame) -> DataFrame:
    """bodies (body) of {"data": [...]} -> refs of financial filings; rows without a document or with another prefix go."""
    rows = bodies.select(F.explode(F.from_json("body", FILING_LIST)["data"]).alias("r")).select("r.*")
    refs = rows.select(F.col("symbol").alias("issuer"), month_name_date("qe_Date").alias("period_end"), F.when(F.lower("consolidated") == "consolidated", "consolidated").otherwise("standalone").alias("basis"), F.expr("try_cast(seq_Id as bigint)").alias("seq"), F.col("xbrl").alias("locator"))
    return refs.withColumn("sector_kind", sector_of_file()).filter("sector_kind is not null and period_end is not null")


def extract(documents: DataFrame) -> DataFrame:
    """documents (filing, body) -> EXTRACTED rows in one Arrow pass per document: facts with a context, the contexts' dates (kind
    'start', 'end', 'instant'), or one 'error' row for a body that does not parse. Values are trimmed text."""

    def rows_of(filing: str, body: str | None) -> list[tuple]:
        local = lambda t: t.rpartition("}")[2]
        try:
            root = ET.fromstring((body or "").encode())
        except ET.ParseError as e:
            return [(filing, "error", None, None, str(e), 0)]
        out = []
        for i, node in enumerate(root.iter()):
            if not isinstance(node.tag, str):
                continue
            name = local(node.tag)
            if name == "context":
                for leaf in node.iter():
                    kind = {"startDate": "start", "endDate": "end", "instant": "instant"}.get(local(leaf.tag) if isinstance(leaf.tag, str) else "")
                    if kind:
                        out.append((filing, kind, None, node.get("id"), (leaf.text or "").strip(), i))
            elif node.get("contextRef") is not None:
                out.append((filing, "fact", name, node.get("contextRef"), (node.text or "").strip(), i))
        return out

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [r for filing, body in zip(frame["filing"], frame["body"]) for r in rows_of(filing, body)]
            yield pd.DataFrame(got, columns=["filing", "kind", "element", "context", "value", "ordinal"])

    return documents.select("filing", "body").mapInPandas(work, EXTRACTED)


def context_dates() -> list[Column]:
    """Aggregates of a filing's EXTRACTED rows: quarter_start, quarter_end, fy_start, fy_end, instant."""
    pick = lambda context, kind: F.min_by("value", F.when((F.col("context") == context) & (F.col("kind") == kind), F.col("ordinal"))).try_cast("date")
    return [pick("OneD", "start").alias("quarter_start"), pick("OneD", "end").alias("quarter_end"), pick("FourD", "start").alias("fy_start"), pick("FourD", "end").alias("fy_end"), pick("OneI", "instant").alias("instant")]


def contexts(extracted: DataFrame) -> DataFrame:
    """(filing, quarter_start, quarter_end, fy_start, fy_end, instant, quarter_days, fy_days); days are inclusive."""
    out = extracted.filter(F.col("kind").isin("start", "end", "instant")).groupBy("filing").agg(*context_dates())
    return out.withColumns({"quarter_days": inclusive_days("quarter_start", "quarter_end"), "fy_days": inclusive_days("fy_start", "fy_end")})


IDENTITY = {"ISIN": "isin", "Symbol": "symbol", "ScripCode": "scrip_code", "NameOfTheCompany": "company_name", "NatureOfReportStandaloneConsolidated": "nature", "WhetherResultsAreAuditedOrUnaudited": "audited"}


def identity_texts() -> list[Column]:
    """Aggregates of a filing's facts: of each element of IDENTITY the first non-blank fact in OneD, else in FourD."""
    pick = lambda e, c: F.min_by(F.nullif(F.trim("value"), F.lit("")), F.when((F.col("element") == e) & (F.col("context") == c), F.col("ordinal")))
    return [F.coalesce(pick(e, "OneD"), pick(e, "FourD")).alias(n) for e, n in IDENTITY.items()]


def identity_facts(facts: DataFrame) -> DataFrame:
    """(filing, isin, symbol, scrip_code, company_name, basis, is_audited): first non-blank fact in OneD, else in FourD."""
    wide = facts.filter(F.col("element").isin(list(IDENTITY))).groupBy("filing").agg(*identity_texts())
    basis = F.when(F.col("nature").isin("Consolidated", "Standalone"), F.lower("nature"))
    return wide.withColumns({"basis": basis, "is_audited": F.coalesce(F.col("audited") == "Audited", F.lit(False))}).drop("nature", "audited")
