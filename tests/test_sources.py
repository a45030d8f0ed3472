import io
import json
import random
import unicodedata
import zipfile
from datetime import date
from html.parser import HTMLParser
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketpipe.functions import scalar as S
from marketpipe.functions.workspace import ship
from marketpipe.plans import io_queries
from marketpipe.sources import filings, prices, reference

#: The column names of the files in this module. The rows are invented.
PRIMARY = """TradDt,FinInstrmTp,ISIN,TckrSymb,SctySrs,SsnId,OpnPric,HghPric,LwPric,ClsPric,PrvsClsgPric,TtlTradgVol,TtlTrfVal,TtlNbOfTxsExctd,Rsvd
2026-07-03,STK,INE00ALPHA01,ALPHA,EQ,F1,190,210,185,200,180,1000,30000,50,
2026-07-03,STK,INE00ALPHA01,ALPHA,EQ,I1,190,210,185,199,180,10,300,5,
2026-07-03,STK,,NOISIN,BE,F2,1,1,1,1,1,1,1,1,
2026-07-03,FUT,INE1,X,EQ,F1,1,1,1,1,1,1,1,1,
"""


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return f"file://{tmp_path}/{name}"


def test_primary(spark, tmp_path):
    got = {r["instrument_key"]: r for r in prices.normalize_primary(prices.read_primary(spark, put(tmp_path, "p.csv", PRIMARY))).collect()}
    assert set(got) == {"INE00ALPHA01", "NSE:NOISIN"} and got["INE00ALPHA01"]["close"] == 200.0 and got["NSE:NOISIN"]["isin"] == ""
    with pytest.raises(ValueError, match="missing columns: ISIN, SsnId"):
        prices.normalize_primary(spark.createDataFrame([(1,)], "TradDt int").select(*(F.lit(None).alias(c) for c in PRIMARY.split("\n")[0].split(",") if c not in ("ISIN", "SsnId"))))


def test_zip_members(spark, tmp_path):
    ship(spark)
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("a.csv", PRIMARY)
        z.writestr("b.csv", "other\n1\n")
    (tmp_path / "d.zip").write_bytes(held.getvalue())
    assert prices.read_zipped(spark, f"file://{tmp_path}/d.zip", ("ISIN", "TckrSymb")).count() == 4


def test_full_and_legacy(spark, tmp_path):
    full = prices.read_text_csv(spark, put(tmp_path, "f.csv", " SYMBOL , SERIES, DATE1, PREV_CLOSE, OPEN_PRICE, HIGH_PRICE, LOW_PRICE, CLOSE_PRICE, TTL_TRD_QNTY, TURNOVER_LACS, NO_OF_TRADES\n ALPHA , EQ , 03-Jul-2026 , 180, 190, 210, 185, 200, 1000000, 30000, 50000\nX,EQ,03-Jul-2026,-,-,-,-,5,1,-,-\n"))
    master = spark.createDataFrame([("X", "EQ", "INEX", date(2026, 1, 1))], "symbol string, series string, isin string, last_seen date")
    got = {r["symbol"]: r for r in prices.normalize_primary(prices.adapt_full(full, master)).collect()}
    assert got["ALPHA"]["value"] == 3e9 and got["ALPHA"]["instrument_key"] == "NSE:ALPHA"
    x = got["X"]
    assert x["instrument_key"] == "INEX" and (x["open"], x["high"], x["low"], x["prevclose"], x["value"], x["trades"]) == (5.0, 5.0, 5.0, 5.0, 0.0, 0)
    old = prices.read_text_csv(spark, put(tmp_path, "l.csv", "SYMBOL,SERIES,OPEN,HIGH,LOW,CLOSE,PREVCLOSE,TOTTRDQTY,TOTTRDVAL,TIMESTAMP,TOTALTRADES,ISIN\nA,EQ,1,2,1,2,1,5,10,05-JUL-2022,3,INEA\n"))
    row = prices.normalize_primary(prices.adapt_legacy(old)).first()
    assert (row["date"], row["instrument_key"], row["value"]) == (date(2022, 7, 5), "INEA", 10.0)


def test_indices(spark, tmp_path):
    rows = "Index Name,Index Date,Open Index Value,High Index Value,Low Index Value,Closing Index Value,Points Change,Volume,Turnover (Rs. Cr.)\n\"Nifty 50 \",03-07-2026,100,110,90,105,5,7,1.5\nNifty X,03-07-2026,-,-,-,50,-,-,-\n"
    got = {r["instrument_key"]: r for r in prices.normalize_indices(prices.read_text_csv(spark, put(tmp_path, "i.csv", rows))).collect()}
    assert got["IDX:NIFTY50"]["prevclose"] == 100.0
    x = got["IDX:NIFTYX"]
    assert (x["open"], x["high"], x["low"], x["prevclose"], x["volume"], x["value"]) == (50.0, 50.0, 50.0, 50.0, 0, 0.0)
    bad = rows.replace("105", "n/a")
    with pytest.raises(Exception):
        prices.normalize_indices(prices.read_text_csv(spark, put(tmp_path, "j.csv", bad))).collect()


def test_blank_fields_keep_their_places(spark, tmp_path):
    ship(spark)
    seed = "instrument_key,symbol,macro_sector,sector,industry,basic_industry\nine1,aa,Mac,Sec,Ind,\nINE2,BB,, Sec  two ,,Bas\nINE3,,M,S,I,B\nINE4,DD,M,,I,B\nINE1,ZZ,M,S,I,B\n\nINE5,EE,M,S\nINE6,FF,S,,\n"
    for whole in (True, False):
        got = {r["instrument_key"]: tuple(r)[1:] for r in reference.seed_list(reference.numbered_fields(spark, put(tmp_path, "seed.csv", seed), whole), ["sec two"]).collect()}
        assert got == {"INE1": ("AA", "Mac", "Sec", "Ind", None, False), "INE2": ("BB", None, "Sec two", None, "Bas", True), "INE6": ("FF", None, "S", None, None, False)}
    rows = 'Company Name,Industry,Symbol,Series,ISIN Code\nA,Oil,a,,ine1\n,Steel,b,EQ,INE2\nC,,c,EQ,INE3\nD,Oil,,EQ,INE4\n"E\nF, G",Oil,e,EQ,INE5\nH,Oil,h,EQ\nI,Oil,i,EQ,INE6,more\nJ,Oil,j,EQ,INE1\n'
    got = {r["instrument_key"]: (r["symbol"], r["company"], r["is_cyclical"]) for r in reference.sector_list(reference.numbered_fields(spark, put(tmp_path, "list.csv", rows)), ["Steel"]).collect()}
    assert got == {"INE1": ("A", "A", False), "INE2": ("B", "", True), "INE5": ("E", "E\nF, G", False), "INE6": ("I", "I", False)}
    assert reference.numbered_fields(spark, put(tmp_path, "empty.csv", "")).count() == 0


class Plain(HTMLParser):
    """All anchors by the standard parser's own events, written down and read again."""

    def __init__(self):
        super().__init__()
        self.events = []

    def handle_starttag(self, tag, attrs):
        self.events.append(("open", tag, dict(attrs).get("title")))

    def handle_endtag(self, tag):
        self.events.append(("close", tag, None))

    def handle_data(self, data):
        self.events.append(("text", data, None))


def test_anchors_of_any_legal_markup(spark):
    ship(spark)
    rng = random.Random(3)
    bits = ["<a title='Sector'>", '<A\nTITLE="Sector" x>', "<a title=Sector>", "<a title=Other>", "<a>", "</a>", "</A >", "Steel", "  Pipes &amp; &#84;ubes\n", "<b>", "</b>", "<!-- <a title=Sector>no</a> -->", "<script>'<a title=Sector>no</a>'</script>", "<br/>", "<a title='Sector'/>", "</p>", "&nbsp;", "<a title='Sec", "'>"]
    pages = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(400)]

    def want(html):
        parser, out, text = Plain(), [], None
        parser.feed(html)
        parser.close()
        for kind, what, title in parser.events:
            if kind == "open" and what == "a" and text is None and title == "Sector":
                text = ""
            elif kind == "text" and text is not None:
                text += what
            elif kind == "close" and what == "a" and text is not None:
                out += [" ".join(unicodedata.normalize("NFKC", text).split())]
                text = None
        return sorted(x for x in out if x)

    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)] + [(1000, None), (1001, "")], "page_id bigint, html string")
    got = {}
    for r in reference.named_anchors(df, ["Sector"]).collect():
        got.setdefault(r["page_id"], []).append(r["label"])
    assert {i: sorted(v) for i, v in got.items()} == {i: w for i, h in enumerate(pages) if (w := want(h))}


def test_sector_and_seed_lists(spark, tmp_path):
    ship(spark)
    rows = reference.sector_list(reference.numbered_fields(spark, put(tmp_path, "s.csv", '﻿Company Name,Industry,Symbol,Series,ISIN Code\n"Rel, Ltd",Oil,ALPHA,EQ,INE1\nshort,row\nOther,Steel,DUP,EQ,INE1\n'))).collect()
    assert [(r["instrument_key"], r["symbol"], r["sector"], r["company"]) for r in rows] == [("INE1", "ALPHA", "Oil", "Rel, Ltd")]
    six = reference.seed_list(reference.numbered_fields(spark, put(tmp_path, "6.csv", 'instrument_key,symbol,macro_sector,sector,industry,basic_industry\nK,S,M,"Oil, Gas",I,B\n'))).first()
    five = reference.seed_list(reference.numbered_fields(spark, put(tmp_path, "5.csv", "instrument_key,symbol,sector,industry,basic_industry\nK,S,X,I,B\n"))).first()
    assert (six["macro_sector"], six["sector"], six["basic_industry"]) == ("M", "Oil, Gas", "B") and (five["macro_sector"], five["sector"], five["basic_industry"]) == (None, "X", "B")


def test_baskets(spark):
    head = "Company Name,Industry,Symbol,Series,ISIN Code\n"
    rows = lambda n: "".join(f'"C, {i}",Ind,SYM{i},EQ,INE{i:04d}01011\n' for i in range(n))
    texts = spark.createDataFrame([("d/ok.csv", "﻿" + head + rows(6)), ("d/few.csv", head + rows(4)), ("d/page.csv", "<html></html>"), ("d/other.csv", "A,B\n" + rows(9))], "source_file string, text string")
    cat = spark.createDataFrame([(f"x/{n}.csv", n, n.upper(), "f", "r", "" if n == "ok" else None) for n in ("ok", "few", "page", "other")], "csv_path string, index_key string, index_name string, family string, rotation string, display_label string")
    got = reference.basket_members(texts, cat).collect()
    assert len(got) == 6 and {(r["index_key"], r["display_label"]) for r in got} == {("ok", "OK")} and got[0]["company"].startswith("C, ")


def test_listings_and_calendars(spark, tmp_path):
    raw = prices.read_text_csv(spark, put(tmp_path, "e.csv", "SYMBOL, SERIES, ISIN NUMBER, NAME OF COMPANY, FACE VALUE\nrel,EQ,ine002,Rel,10\nbond,N1,INE003,Bond,1\nREL2,EQ,INE004,Rel 2,0\n"))
    assert [(r["isin"], r["symbol"]) for r in reference.listed_equities(raw).collect()] == [("INE002", "REL"), ("INE004", "REL2")]
    assert [(r["isin"], r["face_value"]) for r in reference.listed_universe(raw).collect()] == [("INE004", None)]
    off, on = reference.calendar_sources(spark, put(tmp_path, "h.json", json.dumps({"2021": ["2021-01-26"], "2022": ["2022-01-26", "2022-03-01"]})), put(tmp_path, "s.json", json.dumps({"sessions": [{"date": "2024-01-20", "label": "x"}]})))
    assert off.count() == 3 and on.first()["date"] == date(2024, 1, 20)


@pytest.mark.parametrize("html, want", [
    ("".join(f'<a href=x title="{n}"> {n[0]}  1 </a>' for n in ("Broad Sector", "Sector", "Broad Industry", "Industry")), ("B 1", "S 1", "B 1", "I 1")),
    ("".join(f"<a title='{n}'>{n[0]} <b>|</b> &amp;</a>" for n in ("Broad Sector", "Sector", "Broad Industry", "Industry")), ("B | &", "S | &", "B | &", "I | &")),
    ("".join(f"<a title={n.replace(' ', '&#32;')}>{n[0]}</a><!--<a title='{n}'>x</a>-->" for n in ("Broad Sector", "Sector", "Broad Industry", "Industry")), ("B", "S", "B", "I")),
    ("".join(f'<a title="{n}">{n[0]}</a>' for n in ("Broad Sector", "Sector", "Industry")), (None,) * 4),
    ("".join(f'<a title="{n}">{n[0]}</a>' for n in ("Broad Sector", "Sector", "Broad Industry", "Industry")) + '<a title="Sector">other</a>', (None,) * 4),
    ("".join(f'<a title="{n}">{n[0]}</a>' for n in ("Broad Sector", "Sector", "Broad Industry", "Industry")) + '<a title="Sector">S</a>', ("B", "S", "B", "I")),
])
def test_label_pages(spark, html, want):
    ship(spark)
    pages = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    assert tuple(reference.page_labels(pages, ["Broad Sector", "Sector", "Broad Industry", "Industry"]).first())[1:] == want


def test_discovery(spark):
    table = [{"Scrip_cd": 500, "quarter_code": "MQ", "audited": "Audited", "Fld_CreateDate": "2026-05-01T10:00:00", "Fld_NatureOfReport": "Standalone", "XMLName": "a.html", "Consol_XMLName": "b.html"}, {"Scrip_cd": "501", "quarter_code": "MQ", "audited": "Unaudited", "Fld_CreateDate": None, "Fld_NatureOfReport": "", "XMLName": "", "Consol_XMLName": None}]
    got = sorted((r["scrip_code"], r["locator"] or "", r["basis"]) for r in filings.discovered(spark.createDataFrame([(json.dumps({"Table": table}),)], "body string")).collect())
    assert got == [("500", "a.xml", "standalone"), ("500", "b.xml", "consolidated"), ("501", "", None)]


def test_extraction_goes_on_after_a_broken_document(spark):
    ship(spark)
    good = '<x xmlns:i="u"><i:context id="OneD"><period><startDate>2026-01-01</startDate><endDate>2026-03-31</endDate></period></i:context><i:ISIN contextRef="OneD"> </i:ISIN><i:ISIN contextRef="FourD">INE1</i:ISIN><i:Rev contextRef="OneD"> 5 </i:Rev></x>'
    x = filings.extract(spark.createDataFrame([("g", good), ("b", "<x>"), ("n", None)], "filing string, body string"))
    assert {r["filing"] for r in x.filter("kind = 'error'").collect()} == {"b", "n"}
    assert filings.identity_facts(x.filter("kind = 'fact'")).first()["isin"] == "INE1" and filings.contexts(x).first()["quarter_days"] == 90


def test_versions(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert reference.versioned(df, {1: {"k"}, 2: {"k", "v"}}, "k")[1:] == (2, None)
    assert reference.versioned(df, {1: {"k"}}, "k")[2] == "unknown columns" and reference.versioned(df.unionAll(df), {2: {"k", "v"}}, "k")[2] == "duplicate keys"


def test_scalars(spark):
    ship(spark)
    one = spark.createDataFrame([("ﬁne　 Ａ\n b", date(2026, 3, 31), "31-MAR-2026", "31-XXX-2026")], "t string, d date, m string, bad string")
    row = one.select(S.canonical_label("t").alias("c"), S.fiscal_year("d").alias("y"), S.fiscal_quarter("d").alias("q"), S.month_name_date("m").alias("m"), S.month_name_date("bad").alias("b"), S.retry_delay(F.lit(4)).alias("r"), S.growth_pct(F.lit(1.0), F.lit(-5.0)).alias("g")).first()
    assert tuple(row) == ("fine A b", 2026, "Q4", date(2026, 3, 31), None, None, None)


def test_basket_lines_are_read_once(spark):
    head = reference.BASKET_HEADERS[0]
    lines = ['"A, ""x""",I,SA,EQ,INE000000001', "B,I,SB,EQ,INE000000002", '"B",I,SB,EQ,INE000000002', "", " ", '"C",I,"",EQ,INE000000003', 'D,"I, J","SD",EQ,"INE000000004"']
    texts = spark.createDataFrame([("s/a.csv", "\r\n".join([head, *lines])), ("s/b.csv", "\n".join([head, *lines[:2]])), ("s/c.csv", "<html>")], "source_file string, text string")
    names = spark.createDataFrame([(f"l/{x}.csv", f"K{x}", x, "f", "true", None) for x in "abc"], "csv_path string, index_key string, index_name string, family string, rotation string, display_label string")
    got = reference.basket_members(texts, names, least=3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1
    assert sorted((r["index_key"], r["isin"][-1], r["symbol"]) for r in got.collect()) == [("Ka", "1", "SA"), ("Ka", "2", "SB"), ("Ka", "4", "SD")]
    assert {(r["isin"][-1], r["industry"]) for r in got.collect()} == {("1", "I"), ("2", "I"), ("4", "I, J")}


def test_dealt_lines_go_through_python_once(spark, tmp_path):
    folder = tmp_path / "seeds"
    folder.mkdir()
    for k, text in enumerate(("\ufeff\n\nh,i\n a , b\n\n\"x, y\",z\n", "h\n", "h,i\nc,d\n")):
        put(folder, f"{k}.csv", text)
    got = reference.numbered_fields(spark, f"file://{folder}", whole=False)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(r["f"] for r in got.collect()) == [["a", "b"], ["c", "d"], ["x, y", "z"]]


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="the given tables are not here")
def test_extracted_facts_are_aggregated_once(spark):
    out = io_queries.document_facts(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "Join" not in plan
    rows = {int(r["filing"]): r for r in out.collect()}
    assert len(rows) == out.count() and all((i % 97 == 0) == r["parse_error"] == (r["isin"] is None) == (r["quarter_days"] is None) for i, r in rows.items())
