from marketpipe.llm import line_dedup


def brute(rows, least):
    lines = {}
    for doc, text, _, source in rows:
        for line in (text or "").split("\n"):
            bare = line.strip(" \t\r\f\v")
            if bare and source is not None:
                lines.setdefault(bare, []).append((source, doc))
    wide = {b: min(d for _, d in v) for b, v in lines.items() if len({s for s, _ in v}) >= least}
    out = {}
    for doc, text, _, _ in rows:
        parts = (text or "").split("\n")
        kept = [x for x in parts if wide.get(x.strip(" \t\r\f\v"), doc) == doc]
        out[doc] = ("\n".join(kept), 0 if not text else len(parts), len(parts) - len(kept))
    return out


def check(docs, rows, least):
    got = line_dedup.apply(docs(rows), least).collect()
    want = brute(rows, least)
    assert len(got) == len(rows)
    for r in got:
        assert (r["text"], r["n_lines"], r["n_removed"]) == want[r["doc_id"]]


def test_spread_around_the_threshold(docs):
    rows = [(i, f"common\nown {i}\n  common \n\nat {i % 2}", "en", f"s{i % 4}") for i in range(12)]
    rows += [(20 + i, f"nine\nother {i}", "en", f"t{i}") for i in range(9)] + [(40 + i, "ten ", "en", f"u{i}") for i in range(10)] + [(60 + i, "many", "en", "one") for i in range(30)]
    check(docs, rows, 10)
    check(docs, rows, 4)
    check(docs, rows, 2)


def test_nulls_empty_repeated_and_long(docs):
    rows = [(1, None, "en", "a"), (2, "", "en", "b"), (3, "\n\n", "en", "c"), (4, "x", "en", None), (5, "x", "en", None), (6, "y" * 100_000, "en", "a"), (7, "y" * 100_000, "en", "b"), (8, "x", "en", "a"), (9, "x", "en", "b")]
    check(docs, rows, 2)
    got = line_dedup.apply(docs([(1, "x\ny", "en", "a"), (1, "x\ny", "en", "a"), (2, "x", "en", "b")]), 2).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, "x\ny"), (1, "x\ny"), (2, "")]
    assert line_dedup.apply(docs([]), 2).count() == 0


def test_lines_of_very_many_documents_are_salted(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_DOCS", 20)
    monkeypatch.setattr(line_dedup, "SALTS", 4)
    rows = [(i, f"hot\nwarm {i % 9}\nown {i}\nhot", "en", f"s{i % 12}") for i in range(150)]
    check(docs, rows, 5)


def test_documents_that_lose_very_many_lines(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "MANY", 5)
    shared = [f"shared {i}" for i in range(40)]
    rows = [(i, "\n".join([*shared[: i % 40], f"own {i}", "", *shared[: i % 7], shared[0]]), "en", f"s{i % 6}") for i in range(60)] + [(90 + i, "\n".join(shared), "en", f"s{i}") for i in range(6)]
    check(docs, rows, 4)
    odd = line_dedup.apply(docs([*rows, (7, None, "en", "s1"), (7, "", "en", "s1")]), 2).filter("doc_id = 7").collect()
    assert sorted((r["n_lines"], r["n_removed"]) for r in odd)[:2] == [(0, 0)] * 2 and len(odd) == 3
    check(docs, [(300, None, "en", "a"), *rows, (200, "\n".join(shared) + "\n", "en", "s1")], 2)


def test_extra_columns_pass(docs):
    row = line_dedup.apply(docs([(1, "a", "en", "s")])).first()
    assert (row["id"], row["n"], row["c"], row["label"]) == ("x", "y", "z", "w")


def test_near_threshold_sketches_are_counted_exactly(docs):
    """A sketch of few buckets is off by many; the exact count decides near the threshold."""
    rows = [(i, "edge" if i < 300 else "below", "en", f"s{i if i < 300 else i % 299}") for i in range(900)]
    got = line_dedup.apply(docs(rows), 300, 8).filter("n_removed > 0").count()
    assert got == 299


def test_columns_with_inner_names_pass(docs):
    rows = [(i, f"common\nown {i}", "en", f"s{i}") for i in range(4)]
    names = ["_id", "_drop", "_kept", "_lines", "_row", "_word", "n_lines", "N_REMOVED", "a`b", "word", "site"]
    table = docs(rows)
    for k, name in enumerate(names):
        table = table.withColumn(name, line_dedup.F.lit(k))
    got = line_dedup.apply(table, 2)
    assert got.columns == [*table.columns, "n_lines_", "n_removed_"]
    for r in got.collect():
        assert [r[n] for n in names] == list(range(len(names))) and r["n_lines_"] == 2 and r["n_removed_"] == (r["doc_id"] > 0)
