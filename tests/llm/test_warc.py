import hashlib

import pytest

from marketpipe.llm import warc
from marketpipe.llm.queries import ORACLE
from marketpipe.llm.shared import fresh_path, prepare


def rows(spark, data):
    return spark.createDataFrame(data, "page_id bigint, url string, html string, extra string")


def test_round_trip_with_revisits_nulls_and_repeated_rows(spark):
    prepare(spark)
    long, other = "é" * 600, "x" * 1000
    data = [(1, "http://a/ü b\r\nX: y", long, "e"), (7, "http://b", long, "e"), (9, None, long, None), (2, "u", "short", ""), (3, "u", "short", ""), (4, "u", None, ""), (None, "n", other, ""), (5, "u", other, ""), (9, None, long, None)]
    got = {}
    for r in warc.archive(rows(spark, data)).collect():
        got.setdefault(r["page_id"], []).append(r)
    for page, _, html, _ in data:
        payload = (html or "").encode()
        assert all(r["payload_bytes"] == len(payload) and r["payload_digest"] == hashlib.sha1(payload).hexdigest() for r in got[page])
    assert [r["record_type"] for r in got[9]] == ["response"] * 2
    assert [(got[i][0]["record_type"], got[i][0]["refers_to"]) for i in (1, 7, 2, 3, 4, 5)] == [("revisit", 9)] * 2 + [("response", None)] * 4
    assert got[1][0]["url"] == "http://a/%C3%BC%20b%0D%0AX:%20y"


def test_files_do_not_depend_on_partitions_and_roll(spark):
    prepare(spark)
    data = [(i, f"u{i}", chr(97 + i % 26) * 50 + hashlib.sha256(b"%d" % i).hexdigest() * 40, "") for i in range(1200)]
    one = warc.write(rows(spark, data).coalesce(1), fresh_path(spark, "w"), roll_bytes=20_000).collect()
    two = warc.write(rows(spark, data[::-1]).repartition(7), fresh_path(spark, "w"), roll_bytes=20_000).collect()
    key = lambda m: sorted(tuple(r) for r in m)
    assert key(one) == key(two) and len(one) > 3
    assert sum(r["n_records"] for r in one) == 1200


def test_very_long_payloads_and_many_pages_without_id(spark):
    prepare(spark)
    long = "".join(hashlib.sha256(b"%d" % i).hexdigest() for i in range(80_000))
    data = [(1, "u", long, ""), (2, "u", long, ""), (3, "u", "z" * 30_000_000, "")] + [(None, f"n{i}", f"text {i % 20}", "") for i in range(200)]
    got = warc.archive(rows(spark, data)).collect()
    assert len(got) == len(data)
    by = {r["page_id"]: r for r in got if r["page_id"]}
    assert (by[1]["refers_to"], by[2]["record_type"], by[3]["payload_bytes"]) == (2, "response", 30_000_000)
    assert all(by[i]["payload_digest"] == hashlib.sha1(data[i - 1][2].encode()).hexdigest() for i in (1, 2, 3))
    assert sorted(r["payload_digest"] for r in got if r["page_id"] is None) == sorted(hashlib.sha1(f"text {i % 20}".encode()).hexdigest() for i in range(200))


def test_pages_without_an_id_revisit_too(spark):
    prepare(spark)
    one, two, short = "x" * 1000, "y" * 2000, "z" * 999
    data = [(5, "u", one, ""), (3, "v", one, ""), (5, "w", short, "")] + [(None, f"n{i}", one, "") for i in range(150)] + [(None, f"m{i}", two, "") for i in range(3)] + [(None, "s", short, ""), (None, None, None, None)]
    got = [(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive(rows(spark, data)).collect()]
    want = [(5, 1000, "response", None), (3, 1000, "revisit", 5), (5, 999, "response", None)] + [(None, 1000, "revisit", 5)] * 150 + [(None, 2000, "response", None)] * 3 + [(None, 999, "response", None), (None, 0, "response", None)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR, extra VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?, ?)", data)
    assert sorted(((r[0], r[1], r[3], r[4]) for r in con.execute(ORACLE["op5_warc"]).fetchall()), key=repr) == sorted(want, key=repr)


def test_empty(spark):
    prepare(spark)
    assert warc.archive(rows(spark, [])).count() == 0
