import zlib
from pathlib import Path

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from marketpipe.llm import langid, line_dedup, minhash, quality
from marketpipe.llm.shared import prepare, written

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the given tables are not here")


def test_each_stage_on_what_the_one_before_kept(spark):
    """Every stage against its operator's rows on the same input, and the last against the library's token counts."""
    tokenizers = pytest.importorskip("tokenizers")
    from marketpipe.llm.queries import tokenizer

    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF), name)
        assert out.columns == columns
        before, after = ({r["doc_id"]: r for r in x.collect()} for x in (docs, out))
        if name == "language":
            want = {r["doc_id"] for r in langid.predict(docs, langid.fit(docs)).filter("accepted").collect()}
        elif name == "quality":
            want = {r["doc_id"] for r in quality.predict(docs, quality.fit(docs, labels)).filter("predicted = 1").collect()}
        elif name == "lines":
            want = set(before)
            clean = {r["doc_id"]: r["text"] for r in line_dedup.apply(docs).collect()}
            assert all(after[i]["text"] == clean[i] and after[i]["n_chars"] == (len(clean[i]) if clean[i] != before[i]["text"] else before[i]["n_chars"]) for i in after)
        else:
            want = {r["doc_id"] for r in minhash.near_groups(docs, corpus_pipeline.NEAR_PERCENT).filter("kept").collect()}
        assert set(after) == want
        if name != "lines":
            assert all(after[i] == before[i] for i in after)
        docs = out
        seen.append(len(after))
    assert seen == sorted(seen, reverse=True) and seen[-1] > seen[0] / 2
    lib = tokenizers.Tokenizer.from_file(tokenizer())
    want = {r["doc_id"]: len(lib.encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs.collect()}
    got = {}
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_odd_documents_and_an_empty_table(spark, docs):
    from marketpipe.llm.queries import QUERIES

    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    base = [(i, f"some plain words number {i} stand here. They go on.", "en", f"s{i % 3}") for i in range(30)]
    rows = base + [(100, None, "en", "s"), (101, "", None, None), (102, "1 2 3", "en", "s"), (103, base[0][1], "en", "s"), (103, base[0][1], "en", "s")]
    table = docs(rows)
    out = corpus_pipeline.language(spark, table, SF)
    assert {r["doc_id"] for r in out.collect()} == {r[0] for r in base} | {103} and out.count() == 32
    kept = corpus_pipeline.near(spark, corpus_pipeline.lines(spark, written(out, "l"), SF), SF)
    assert kept.columns == table.columns and 0 in {r["doc_id"] for r in kept.collect()} and 103 not in {r["doc_id"] for r in kept.collect()}
    empty = docs([])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SF)
        assert out.count() == 0


def test_near_stage_links_from_four_fifths_on(spark, docs):
    """Pairs around 0.80 and 0.85 against brute force over all pairs; op1's threshold stays at 0.85."""
    rows, n = [], 0
    for base in range(6):
        words = [f"b{base}w{i}" for i in range(204)]  # 200 shingles, five of them lost with each word changed
        for edits in range(8):
            copy = [f"x{n}y{i}" if i % 25 == 12 and i // 25 < edits else w for i, w in enumerate(words)]
            rows.append((n, " ".join(copy)))
            n += 1
    sets = {i: set(zip(*(t.split()[k:] for k in range(5)))) for i, t in rows}
    share = {(a, b): 100 * len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    assert sum(80 <= v < 85 for v in share.values()) >= 6
    # of each group its first document and one in the band between the thresholds, or one below both
    for a, b in [(0, 4), (0, 5)]:
        pairs = [(8 * g + a, 8 * g + b) for g in range(6)]
        table = docs([rows[i] for pair in pairs for i in pair])
        for percent, kept in ((corpus_pipeline.NEAR_PERCENT, corpus_pipeline.near(spark, table, SF)), (85, minhash.near_groups(table).filter("kept"))):
            assert {r["doc_id"] for r in kept.collect()} == {x for pair in pairs for x in pair} - {y for x, y in pairs if share[x, y] >= percent}
    assert corpus_pipeline.NEAR_PERCENT == 80 <= share[0, 4] < 85 and share[0, 5] < 80


def test_near_stage_keeps_one_of_repeated_rows(spark, docs):
    """Also of the row that holds its group's smallest doc_id; a row that repeats only the doc_id stays."""
    rows = [(1, "one two three four five six", "en", "a"), (1, "one two three four five six", "en", "a"), (1, "one two three four five six", "en", "b")]
    rows += [(2, "ONE two three four five six", "en", "a")] * 2 + [(3, "seven eight nine ten eleven", "en", None)] * 3 + [(4, None, "en", "a")] * 2
    rows += [(5, "red green blue grey black", "en", "a"), (5, "north south east west up", "en", "a"), (6, "all alone here now then", "en", "a")]
    got = sorted((r["doc_id"], r["text"] or "", r["source"]) for r in corpus_pipeline.near(spark, docs(rows), SF).collect())
    want = [rows[0], rows[5], rows[8], rows[10], rows[11], rows[12]]
    assert got == sorted((i, t or "", s) for i, t, _, s in want)


def test_held_out_rows_are_never_learned_from(docs):
    """Changing the labels of held-out documents changes no answer."""
    rows = [(i, f"{'alpha beta gamma' if i % 2 else 'uno dos tres'} {i}", "aa" if i % 2 else "bb", "s") for i in range(120)]
    other = [(i, t, "bb" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, s) for i, t, lang, s in rows]
    one, two = (sorted(map(tuple, langid.predict(docs(rows), langid.fit(docs(x))).collect())) for x in (rows, other))
    assert one == two


def test_stages_with_clashing_columns(spark, docs):
    """Names that the operators use inside, a map column, and rows without an id."""
    rows = [(i, f"common line\none two three four five six seven {i // 2}", "en", f"s{i}") for i in range(24)] + [(None, "a row without an id", "en", "a"), (2, "common line\none two three four five six seven 1", "en", "s2")]
    table = docs(rows)
    names = ["_id", "_kept", "_nth", "_drop", "n_lines", "n_removed", "kept", "n", "label"]
    for k, name in enumerate(names):
        table = table.withColumn(name, F.lit(k))
    table = table.withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    out = corpus_pipeline.lines(spark, table, SF)
    assert out.columns == table.columns and all([r[n] for n in names] == list(range(len(names))) for r in out.collect())
    assert {r["doc_id"] for r in out.filter("text like 'common%'").collect()} == {0, None} - {None} and out.filter("doc_id is null").count() == 1
    kept = corpus_pipeline.near(spark, table, SF)
    assert kept.columns == table.columns and sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect()) == [-1, *range(0, 24, 2)]
