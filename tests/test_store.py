from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketpipe.operators import gates, store
from marketpipe.operators.admission import Limits
from marketpipe.plans import io_queries
from marketpipe.plans.registry import default_registry
from marketpipe.schemas import BARS
from marketpipe.streaming import ingest

from .test_gates import bar, bars


def content(spark, path):
    return sorted((str(r["date"]), r["instrument_key"], r["close"]) for r in store.read_years(spark, path, BARS).collect())


def test_upsert_is_idempotent_and_crosses_years(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    assert store.read_years(spark, path, BARS).count() == 0
    first = bars(spark, bar("A", date(2025, 12, 31)), bar("A", date(2026, 1, 1)), bar("B", date(2026, 1, 1)))
    fix = bars(spark, bar("A", date(2026, 1, 1), close=11.5), bar("C", date(2026, 1, 1)))
    store.upsert(spark, first, path)
    store.upsert(spark, fix, path)
    once = content(spark, path)
    store.upsert(spark, fix, path)
    assert content(spark, path) == once == [("2025-12-31", "A", 11.0), ("2026-01-01", "A", 11.5), ("2026-01-01", "B", 11.0), ("2026-01-01", "C", 11.0)]
    assert store.read_years(spark, path, BARS, [2025], ["close"]).count() == 1


def test_windows_and_duplicates(spark):
    df = bars(spark, *(bar("A", date(2026, 1, d)) for d in range(1, 8)), bar("B", date(2024, 1, 1)))
    got = store.trailing_rows(df, "instrument_key", 3)
    assert sorted(r["date"].day for r in got.filter("instrument_key = 'A'").collect()) == [5, 6, 7] and got.count() == 4
    assert store.duplicate_keys(df.unionAll(df.limit(1)), ["date", "instrument_key"]).count() == 1


def test_fingerprint_ignores_partitioning_only(spark):
    df = bars(spark, *(bar(f"K{i}") for i in range(20)))
    a = store.fingerprint(df).first()
    assert a == store.fingerprint(df.repartition(7)).first() != store.fingerprint(df.limit(19)).first()
    assert store.fingerprint(df.limit(0)).first()["n_rows"] == 0
    assert store.fingerprint(bars(spark, bar("K", isin=None))).first() != store.fingerprint(bars(spark, bar("K", isin=""))).first()


def test_snapshots_and_ledger(spark, tmp_path):
    path, df = f"file://{tmp_path}/snap", bars(spark, bar("A"), bar("B"))
    assert store.write_if_changed(df, path, "v1", ["instrument_key"]) and not store.write_if_changed(df, path, "v2", ["instrument_key"])
    assert store.write_if_changed(df.limit(1), path, "v3", ["instrument_key"]) and store.read_snapshot(spark, path).count() == 1
    led = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    assert sorted(map(tuple, store.append_ledger(led, spark.createDataFrame([("a", 2), ("c", 3)], "k string, v int"), ["k"]).collect())) == [("a", 1), ("b", 1), ("c", 3)]


def test_the_pointer_of_a_snapshot_moves_in_one_step(spark, tmp_path):
    path, df = f"file://{tmp_path}/snap", bars(spark, bar("A"), bar("B"))
    assert store.current_version(spark, path) is None
    for k in range(12):
        store.write_snapshot(df.limit(1 + k % 2), path, f"v.{k}")
    assert store.current_version(spark, path) == "v.11" and store.read_snapshot(spark, path).count() == 2
    df.write.parquet(f"{path}/version=torn")  # a writer that stopped before its pointer
    assert store.current_version(spark, path) == "v.11"


def test_rows_are_numbered_in_order_over_range_partitions(spark):
    df = spark.range(1000).repartition(7).selectExpr("(id * 37) % 1000 as k", "id % 3 as g")
    got = store.numbered(df, "g", "k").collect()
    want = sorted(((r["g"], r["k"]) for r in got))
    assert [(r["g"], r["k"]) for r in sorted(got, key=lambda r: r["ordinal"])] == want and {r["ordinal"] for r in got} == set(range(1, 1001))
    assert store.numbered(df.limit(0), "k").count() == 0


def test_upsert_deals_a_year_over_ranges_of_its_keys(spark, tmp_path):
    rows = spark.range(4000).selectExpr("date'2026-01-05' as date", "concat('K', id) as instrument_key", "cast(id as double) as close")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows are few
    store.upsert(spark, rows.repartition(4), path := f"file://{tmp_path}/s")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()
    assert len(files) > 1 and sum(r["count"] for r in files) == 4000


def test_failures_of_a_run_replace_those_before(spark, tmp_path):
    path = f"file://{tmp_path}/f"
    make = lambda *rows: spark.createDataFrame([(date(2026, 1, d), s) for d, s in rows], "date date, status string")
    first = store.write_failures(make((1, "failed"), (2, "failed"), (3, "success")), "2026-01-02", path)
    assert [r["date"].day for r in first.collect()] == [1]
    assert store.write_failures(make((1, "success"), (2, "failed")), "2026-01-02", path).count() == 0
    for k in range(2):
        store.append_status(spark.createDataFrame([("success", k)], "status string, n int"), f"{path}-log")
    assert spark.read.json(f"{path}-log").count() == 2


DAYS = [date(2026, 1, d) for d in (5, 6, 7, 8, 9)]
KEYS = [f"K{i}" for i in range(10)]
SMALL = Limits(least=1, most=100, floor=5, band=0.5)


def trading(spark):
    return spark.createDataFrame([(d, True, k + 1) for k, d in enumerate(DAYS)] + [(date(2026, 1, 10), False, None)], "date date, is_trading boolean, ordinal bigint")


def full(day, keys=KEYS, **over):
    return [bar(k, day, **over) for k in keys]


def filled(spark, source, path, target, limits=SMALL, **more):
    rows = ingest.backfill(source, path, trading(spark), target, 5, limits, **more).collect()
    return {r["date"].day: (r["status"], r["n_rows"], r["n_quarantined"]) for r in rows}, {r["date"].day: r["reason"] for r in rows}


def test_backfill(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    store.upsert(spark, bars(spark, *full(DAYS[0]), *full(DAYS[1], KEYS[:3])), path)
    source = bars(spark, *full(DAYS[1]), *full(DAYS[2], volume=-1), *full(DAYS[0], close=11.5))
    run = lambda target: filled(spark, source, path, target)[0]
    assert run("2026-01-09") == {5: ("idempotent", 10, 0), 6: ("success_topped_up", 10, 0), 7: ("failed", 10, 10), 8: ("failed", 0, 0), 9: ("not_yet", 0, 0)}
    held = content(spark, path)
    assert len(held) == 20 and {c for _, _, c in held} == {11.0}
    assert run("2026-01-09")[6][0] == "idempotent" and content(spark, path) == held
    assert run("2026-01-08")[8][0] == "not_yet"


def test_a_refused_day_never_enters_a_later_mean(spark, tmp_path):
    # 10, then 4 (refused: off by more than half), then 6: within half of 10, not of the mean of 10 and 4 had that been let in at 15 %
    source = bars(spark, *full(DAYS[0]), *full(DAYS[1], KEYS[:4]), *full(DAYS[2], KEYS[:6]), *full(DAYS[3], KEYS[:3]), *full(DAYS[4], [f"J{i}" for i in range(15)]))
    got, reasons = filled(spark, source, path := f"file://{tmp_path}/s", "2026-01-09")
    # means before: -, 10, 10, 8, 8
    assert {d: s for d, (s, _, _) in got.items()} == {5: "success", 6: "failed", 7: "success", 8: "failed", 9: "failed"}
    assert reasons[6] == reasons[8] == reasons[9] == "series EQ deviates"
    assert sorted((r["date"].day, r["n"]) for r in store.read_counts(spark, path).collect()) == [(5, 10), (7, 6)]


def test_gates_in_their_order(spark, tmp_path):
    rows = full(DAYS[0]) + full(DAYS[1], series="BE") + full(DAYS[2]) + full(DAYS[3], trades=-1) + full(DAYS[4], KEYS[:9]) + [bar("", DAYS[4])]
    asked = F.when((F.col("date") == F.lit(DAYS[1])) & (F.col("instrument_key") == "K1"), F.lit(DAYS[2])).otherwise(F.col("date"))
    side = f"file://{tmp_path}/side"
    got, reasons = filled(spark, bars(spark, *rows).withColumn("asked", asked), path := f"file://{tmp_path}/s", "2026-01-09", asked="asked", evidence=f"{side}-e", deltas=f"{side}-d")
    assert reasons == {5: None, 6: "series EQ absent", 7: "rows of another date", 8: "contract broken", 9: None}
    assert got[9] == ("success", 10, 1) and got[7] == ("failed", 11, 0)
    assert spark.read.parquet(f"{side}-e").count() == 1
    assert sorted((r["date"].day, r["count"]) for r in spark.read.parquet(f"{side}-d").groupBy("date").count().collect()) == [(5, 10), (9, 9)]
    assert len(content(spark, path)) == 19


def test_a_backfill_reads_no_stored_bars_for_its_means(spark, tmp_path):
    store.upsert(spark, bars(spark, *full(DAYS[0]), *full(DAYS[1])), path := f"file://{tmp_path}/s")
    marked = gates.tagged(bars(spark, *full(DAYS[2])), "_ok").withColumns({"_wrong": F.lit(False), "_broken": F.lit(False)})
    files = ingest.tallies(marked, marked.drop("_ok", "_wrong", "_broken"), path, trading(spark), 3, 5, 10, "bars").inputFiles()
    assert files and all("/_counts/batch=" in f for f in files)


def test_days_that_their_own_counts_keep_out_go_no_further(spark, tmp_path, monkeypatch):
    seen, plain = [], ingest.keep_last

    def watched(rows, *how):
        seen.append({r["date"].day for r in rows.select("date").distinct().collect()})
        return plain(rows, *how)

    monkeypatch.setattr(ingest, "keep_last", watched)
    source = bars(spark, *full(DAYS[0]), *full(DAYS[1], [f"M{i}" for i in range(101)]), *full(DAYS[2], volume=-1), *full(DAYS[3], trades=-1), *full(DAYS[4], KEYS[:9]))
    got, _ = filled(spark, source, f"file://{tmp_path}/s", "2026-01-09")
    assert {d: s for d, (s, _, _) in got.items()} == {5: "success", 6: "failed", 7: "failed", 8: "failed", 9: "success"} and got[6][1] == 101
    assert seen == [{5, 9}]


def test_a_backfill_of_nothing(spark, tmp_path):
    got, _ = filled(spark, bars(spark), f"file://{tmp_path}/s", "2026-01-09")
    assert got == {5: ("failed", 0, 0), 6: ("failed", 0, 0), 7: ("failed", 0, 0), 8: ("failed", 0, 0), 9: ("not_yet", 0, 0)}
    assert store.read_years(spark, f"file://{tmp_path}/s", BARS).count() == 0


def test_a_backfill_without_evidence_or_deltas(spark, tmp_path):
    side = f"file://{tmp_path}/side"
    got, _ = filled(spark, bars(spark, *full(DAYS[0]), bar("", DAYS[0])), f"file://{tmp_path}/s", "2026-01-09", Limits(least=1, most=5), evidence=f"{side}-e", deltas=f"{side}-d")
    assert got[5] == ("failed", 11, 1)
    assert ingest.read_evidence(spark, f"{side}-e").groupBy("day").count().collect() == []
    assert spark.read.schema(BARS).parquet(f"{side}-d").groupBy("date").count().collect() == []


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="the given tables are not here")
def test_the_backfill_query_where_every_day_is_refused(spark, monkeypatch):
    monkeypatch.setattr(io_queries, "LIMITS", Limits(least=1, most=1, floor=2, band=0.6))
    rows = io_queries.backfill(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 20 and all(r["evidence"] == 0 and r["delta"] == 0 for r in rows) and not any(r["status"].startswith("success") for r in rows)


def test_a_writer_that_stops_leaves_the_table_whole(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/s"
    store.upsert(spark, bars(spark, bar("A", date(2025, 1, 1)), bar("A", date(2026, 1, 1))), path)
    before = content(spark, path)

    def stop(*_):
        raise KeyboardInterrupt

    fix = bars(spark, bar("A", date(2025, 1, 1), close=11.5), bar("A", date(2026, 1, 1), close=11.5))
    with monkeypatch.context() as m:
        m.setattr(store, "commit", stop)
        with pytest.raises(KeyboardInterrupt):
            store.upsert(spark, fix, path)
    assert content(spark, path) == before and len(list(tmp_path.glob("s/batch=*"))) == 2
    store.upsert(spark, fix, path)
    assert {c for _, _, c in content(spark, path)} == {11.5}


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    path, real, done = f"file://{tmp_path}/s", store.commit, []

    def slow(*args):
        if not done:
            done.append(1)
            store.upsert(spark, bars(spark, bar("B", date(2026, 1, 1)), bar("A", date(2026, 1, 1), close=12.0)), path)  # another writer is faster
        return real(*args)

    monkeypatch.setattr(store, "commit", slow)
    store.upsert(spark, bars(spark, bar("A", date(2026, 1, 1)), bar("C", date(2025, 1, 1))), path)
    assert content(spark, path) == [("2025-01-01", "C", 11.0), ("2026-01-01", "A", 11.0), ("2026-01-01", "B", 11.0)]
    assert not real(spark, path, 2, {}) and len(store.commits(spark, path)) == 2


def test_old_commits_go_and_plain_tables_are_taken_over(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    rows = bars(spark, bar("A", date(2024, 1, 1)), bar("A", date(2025, 1, 1)))
    rows.withColumn("year", F.year("date")).write.partitionBy("year").parquet(path)
    for k in range(8):
        store.upsert(spark, bars(spark, bar("B", date(2025, 1, 1), trades=k)), path)
    assert content(spark, path) == [("2024-01-01", "A", 11.0), ("2025-01-01", "A", 11.0), ("2025-01-01", "B", 11.0)]
    assert len(store.commits(spark, path)) == store.KEPT_COMMITS == len(list(tmp_path.glob("s/batch=*")))
    assert sorted((r["date"].year, r["n"]) for r in store.read_counts(spark, path).collect()) == [(2024, 1), (2025, 2)]
    assert sorted(map(tuple, store.stored_statistics(spark, path, "b").select("year", "n_rows").collect())) == [(2024, 1), (2025, 2)]


def test_pending_filings_write_their_changes_only(spark, tmp_path):
    schema = "filing_key string, locator string, seen date"
    batches = [[("a", None, 3), ("b", None, 2), ("c", "x", 1), (None, None, 1)], [("a", None, 2), ("d", None, None)], [("b", "y", 9), ("c", None, 1)], [("b", None, 1), ("a", None, 5)]]
    for k, rows in enumerate(batches):
        rows = [(f, u, s and date(2026, 1, s)) for f, u, s in rows]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{tmp_path}/in/{k}")
        stream = spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in/*")
        ingest.run_to_end(ingest.track_pending(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/cp"))
    changes = spark.read.parquet(f"file://{tmp_path}/out").groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in changes} == {0: 2, 1: 2, 2: 1}
    assert sorted(map(tuple, ingest.pending(spark, f"file://{tmp_path}/out").collect())) == [("a", date(2026, 1, 2)), ("d", None)]


def test_documents_come_once_however_late(spark, tmp_path):
    schema, paths = "dedup_key string, seen timestamp, extra int", [f"file://{tmp_path}/{x}" for x in ("out", "ledger", "cp")]
    day = lambda n: datetime(2026, 1, 1) + timedelta(days=n)
    for k, rows in enumerate([[("a", 0), ("a", 1), (None, 0)], [("b", 100)], [("c", 300), ("a", 290)], [("a", 400), ("b", 101), ("d", 400), ("e", 5)]]):
        spark.createDataFrame([(key, day(n), n) for key, n in rows], schema).coalesce(1).write.parquet(f"file://{tmp_path}/in/{k}")
        for _ in range(2):  # the second run finds nothing new
            ingest.run_to_end(ingest.once_per_document(spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in/*"), "seen", *paths))
    assert sorted(r["dedup_key"] for r in spark.read.parquet(paths[0]).collect()) == ["a", "b", "c", "d", "e"]


def test_deltas_keep_the_newest_days(spark, tmp_path):
    path = f"file://{tmp_path}/d"
    store.write_day_delta(bars(spark, *(bar("A", date(2026, 1, d)) for d in range(1, 6))), path, keep=3)
    store.write_day_delta(bars(spark, bar("A", date(2026, 1, 6))), path, keep=3)
    assert sorted(r["date"].day for r in spark.read.parquet(path).collect()) == [4, 5, 6]


def test_absent_columns(spark):
    got = store.with_absent(spark.createDataFrame([(1, "x")], "volume int, other string"), BARS, {"isin": ""}).first()
    assert got["volume"] == 1 and got["isin"] == "" and got["close"] is None and "other" not in got


def test_stream_replay_changes_nothing(spark, tmp_path):
    files, out, deltas = (f"file://{tmp_path}/{x}" for x in ("in", "out", "deltas"))
    bars(spark, bar("A", date(2026, 1, 1)), bar("A", date(2026, 1, 2)), bar("", date(2026, 1, 2))).write.parquet(files)
    for i in range(2):
        ingest.run_to_end(ingest.ingest(ingest.day_files(spark, files), out, f"file://{tmp_path}/cp{i}", f"file://{tmp_path}/side", deltas=deltas, keep=1))
    assert len(content(spark, out)) == 2 and spark.read.parquet(f"file://{tmp_path}/side").count() == 1
    assert [(str(r["date"]), r["instrument_key"]) for r in ingest.read_deltas(spark, deltas).collect()] == [("2026-01-02", "A")]


def test_registry_builds_derived_tables(spark):
    r = default_registry()
    rows = bars(spark, bar("A", date(2026, 1, 1), close=10.0), bar("A", date(2026, 1, 2), prevclose=5.0, close=5.0, low=4.0))
    assert r.build("ca_flags", {"equity_bars": rows}).first()["implied_ratio"] == 2.0
    assert r.build("instruments", {"equity_bars": rows}).count() == 1 and r.datasets["equity_bars"].rows_per_day == (2000, 10000)


def test_pending_filings_are_folded_without_state_and_replayed_batches_replace_their_own(spark, tmp_path):
    schema, out = "filing_key string, locator string, seen date", f"file://{tmp_path}/out"
    changes = lambda: sorted((r["batch"], r["filing_key"], r["seen"].day, r["waiting"]) for r in spark.read.parquet(out).collect())
    for k, rows in enumerate([[("a", None, 5), ("a", None, 4), ("b", "x", 3), ("b", None, 2), ("c", None, 1)], [("a", "y", 2), ("b", None, 1), ("c", None, 3), ("d", "z", 1)]]):
        spark.createDataFrame([(f, u, date(2026, 1, s)) for f, u, s in rows], schema).write.parquet(f"file://{tmp_path}/in/{k}")
        for _ in range(2):  # the second time as after a stop between the batch's files and its commit
            query = ingest.track_pending(spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in/*"), out, f"file://{tmp_path}/cp")
            ingest.run_to_end(query)
            assert query.lastProgress["stateOperators"] == []
            for name in (f"{k}", f".{k}.crc"):
                (tmp_path / "cp" / "commits" / name).unlink()
        ingest.run_to_end(ingest.track_pending(spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in/*"), out, f"file://{tmp_path}/cp"))
        assert changes() == [(0, "a", 4, True), (0, "c", 1, True), (1, "a", 2, False)][: 2 + k]
    assert sorted(map(tuple, ingest.pending(spark, out).collect())) == [("c", date(2026, 1, 1))]
