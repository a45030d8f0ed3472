import hashlib

import pyarrow as pa
import pytest

from marketpipe.llm import exact_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("keep", ["max", "min"])
def test_groups_ties_nulls_and_repeated_rows(docs, keep):
    rows = [(1, "Ab"), (5, "aB"), (3, "ab "), (2, None), (9, ""), (4, "É"), (6, "é"), (7, "x" * 10000), (8, "X" * 10000), (8, "X" * 10000)]
    norm = [(d, (t or "").translate(LOWER)) for d, t in rows]
    pick = max if keep == "max" else min
    got = exact_dedup.exact_groups(docs(rows), keep).collect()
    assert len(got) == len(rows)
    for r in got:
        text = dict(norm)[r["doc_id"]]
        same = [d for d, t in norm if t == text]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (pick(same), len(same), r["doc_id"] == pick(same), hashlib.sha256(text.encode()).hexdigest())


def test_empty_table(docs):
    assert exact_dedup.exact_groups(docs([])).count() == 0


def test_colliding_digests_are_told_apart_by_their_bytes(docs, monkeypatch):
    """With a digest of three bits nearly all texts collide; the answers stay the same."""
    from pyspark.sql import functions as F

    rows = [(i, f"text {i % 40}") for i in range(200)]
    sha2 = F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.lpad(F.conv(F.substring(sha2(c, n), 1, 1), 16, 8), 2, "0"))
    got = exact_dedup.exact_groups(docs(rows)).collect()
    assert all(r["group_size"] == 5 and r["keep_id"] == 160 + r["doc_id"] % 40 for r in got) and len(got) == 200


def test_long_and_repeated_texts(docs):
    rows = [(i, "Many words " * 20_000) for i in range(60)] + [(100, "many words " * 20_000 + "x"), (101, None)] + [(7, "many WORDS " * 20_000)] * 3
    got = {(r["doc_id"], r["keep_id"], r["group_size"]) for r in exact_dedup.exact_groups(docs(rows)).collect()}
    assert got == {(i, 59, 63) for i in range(60)} | {(100, 100, 1), (101, 101, 1)}


def entries(index):
    return sorted((bytes(r["digest"]), r["min_id"], r["max_id"], r["n"]) for runs in index.levels for run in runs for r in run.entries.collect())


def test_levels_merge_and_lookups_skip_runs(spark, monkeypatch):
    keys = lambda ids: spark.createDataFrame([(f"{i % 70:032d}".encode(), i) for i in ids], "digest binary, doc_id bigint")
    index = exact_dedup.DigestIndex(spark)
    for k in range(5):
        index.flush(keys(range(20 * k, 20 * k + 20)))
    assert [len(runs) for runs in index.levels] == [1, 1]
    assert len(entries(index)) == 70 + 20
    read = []
    for runs in index.levels:
        for run in runs:
            spy = run.entries
            monkeypatch.setattr(spy, "join", lambda *a, _join=spy.join, _run=run, **k: read.append(_run) or _join(*a, **k))
    got = {bytes(r["digest"]): (r["min_id"], r["max_id"], r["n"]) for r in index.lookup(keys([1, 15, 500])).collect()}
    want = {f"{d % 70:032d}".encode(): [i for i in range(100) if i % 70 == d % 70] for d in (1, 15, 500)}
    assert got == {k: (min(v), max(v), len(v)) for k, v in want.items() if v}
    read.clear()
    assert index.lookup(spark.createDataFrame([(b"not there",)], "digest binary")).count() == 0 and not read
    index.lookup(keys([40]))
    assert read == index.levels[1]
    index.merge(0)
    assert [len(runs) for runs in index.levels] == [0, 1] and entries(index) == sorted((f"{d:032d}".encode(), d, *((d + 70, 2) if d < 30 else (d, 1))) for d in range(70))


def test_fold_keeps_one_entry_for_each_digest_across_batches():
    batch = lambda rows: pa.RecordBatch.from_pylist([dict(zip(("digest", "min_id", "max_id", "n"), r)) for r in rows])
    out = exact_dedup.fold(iter([batch([(b"a", 5, 6, 2), (b"b", 1, 1, 1)]), batch([(b"b", 0, 3, 4)]), batch([(b"b", 2, 9, 1), (b"c", 7, 7, 1)])]))
    assert [tuple(r.values()) for b in out for r in b.to_pylist()] == [(b"a", 5, 6, 2), (b"b", 0, 9, 6), (b"c", 7, 7, 1)]


def test_texts_are_not_shuffled_by_digest_alone(docs, monkeypatch):
    plans = []
    keep = exact_dedup.written
    monkeypatch.setattr(exact_dedup, "written", lambda df, name, **o: plans.append((name, df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString())) or keep(df, name, **o))
    exact_dedup.exact_groups(docs([(i, f"t{i % 7}") for i in range(50)])).collect()
    plan = next(p for name, _, p in plans if name == "collisions")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(digest" in line]
    assert len(exchanges) == 2 and "salt" in exchanges[1] and "salt" not in exchanges[0]


def test_memtables_flush_sorted_runs(monkeypatch):
    monkeypatch.setattr(exact_dedup, "MEMTABLE_ROWS", 4)
    batches = [pa.RecordBatch.from_arrays([pa.array([b"b", b"a", b"b"]), pa.array([3, 1, 2])], names=["digest", "doc_id"])] * 3
    runs = list(exact_dedup.flush(iter(batches)))
    assert [r.column("digest").to_pylist() for r in runs] == [[b"a", b"b"]] * 2
    assert [r.column("n").to_pylist() for r in runs] == [[2, 4], [1, 2]]
    assert runs[0].column("min_id").to_pylist() == [1, 2] and runs[0].column("max_id").to_pylist() == [1, 3]


def test_the_index_has_levels_and_skips_runs(docs, monkeypatch):
    """Rows come in several flushes; what is looked up goes to the runs whose filters let it in."""
    seen = []
    lookup = exact_dedup.DigestIndex.lookup
    monkeypatch.setattr(exact_dedup.DigestIndex, "lookup", lambda self, digests: seen.append(([len(level) for level in self.levels], digests.count())) or lookup(self, digests))
    rows = [(i, f"text {i if i < 180 else i - 150}") for i in range(200)]
    table = docs(rows).repartition(12)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_groups(table).collect()}
    assert got == {i: (i + 150, 2) if 30 <= i < 50 else (i, 2 if i >= 180 else 1) for i in range(200)}
    assert seen[0][0] == [2, 1] and 20 <= seen[0][1] < 40  # four runs were merged, two are at level 0; few digests are looked up


def test_rows_without_an_id(docs):
    rows = [(None, "a"), (None, "A"), (3, "a"), (None, "b"), (None, "b"), (7, "c")]
    got = sorted((r["doc_id"] is None, r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(docs(rows)).filter("keep_id is not null").collect())
    assert got == [(False, 3, 3, True), (False, 7, 1, True), (True, 3, 3, False), (True, 3, 3, False)]
    rest = exact_dedup.exact_groups(docs(rows)).filter("keep_id is null").collect()
    assert [(r["doc_id"], r["group_size"], r["kept"]) for r in rest] == [(None, 2, True)] * 2
