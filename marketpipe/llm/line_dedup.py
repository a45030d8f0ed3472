"""Removal of lines that stand on many distinct sites (boilerplate), in DataFrame functions only.

A line is what stands between line feeds, compared after trimming white space. Per line hash, HyperLogLog sketches of the sites
merge by aggregation (map side first). Lines whose estimate lies near the threshold get an exact distinct count. A line on at
least min_sites sites goes from every document but the one with the smallest doc_id that has it, so no content leaves the corpus.

Bit tables of bounded size keep lines that stay, and documents that lose none, out of the shuffles. Lines of HOT_DOCS documents or
more are dealt over SALTS tasks each.

Null text: no lines, empty result text. Blank lines are neither counted nor removed. A null source is no site. Repeated rows
count as the same site. An empty table gives an empty result. Extra columns pass through apply() untouched, whatever their names; where the
table has a column n_lines or n_removed, the operator's own get underscores after their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bit_table, dropped, free, hidden, thinned, whole, written

MIN_SITES = 10
#: log2 of a sketch's buckets: a relative standard error of about 1.04 / 2^(LG_K / 2), 1.6 % at 12.
LG_K = 12
#: Estimates within this share of the threshold (more than five standard errors) are counted exactly.
NEAR = 0.1
#: Documents from which a line's rows are dealt over tasks, and over how many.
HOT_DOCS, SALTS = 1000, 256
#: Lost lines from which a document's lines meet them in a join instead of one by one in a list.
MANY = 256


def bare(line: Column) -> Column:
    return F.regexp_replace(line, r"^[ \t\r\f\x0B]+|[ \t\r\f\x0B]+$", "")


def line_key(line: Column) -> Column:
    """128 bits of a trimmed line, as two independently seeded hashes; null for a blank line."""
    return F.when(line != "", F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b")))


def split(docs: DataFrame) -> DataFrame:
    """docs with _lines: the lines of each text. Lists of lines are never shuffled or written, they are made from the text."""
    return docs.withColumn("_lines", F.split(whole("text"), "\n", -1))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, site, a, b): each distinct line of each document once."""
    keys = F.array_distinct(F.array_compact(F.transform("_lines", lambda x: line_key(bare(x)))))
    rows = docs.select("doc_id", F.col("source").alias("site"), F.explode(keys).alias("k"))
    return rows.select("doc_id", "site", "k.a", "k.b")


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, near: float = NEAR) -> DataFrame:
    """(a, b, first_id, n): the lines on at least min_sites distinct sites, the smallest document that has each, and how many have it."""
    most = F.col("n") >= min_sites  # fewer documents than that cannot be on that many sites
    counted = lines.filter(F.col("site").isNotNull()).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"), F.hll_sketch_agg("site", lg_k).alias("sketch"))
    counted = written(counted.filter(most).select("a", "b", "first_id", "n", F.hll_sketch_estimate("sketch").alias("estimate")), "line-spread")
    sure = counted.filter(F.col("estimate") > min_sites * (1 + near) + 1)
    unsure = counted.filter((F.col("estimate") >= min_sites * (1 - near) - 1) & (F.col("estimate") <= min_sites * (1 + near) + 1))
    # a line's sites are made distinct before the join, however many documents have it
    exact = thinned(lines.filter(F.col("site").isNotNull()), bit_table(unsure, "a"), "a").groupBy("a", "b", "site").agg(F.lit(1).alias("one"))
    exact = exact.groupBy("a", "b").agg(F.count(F.lit(1)).alias("sites")).filter(F.col("sites") >= min_sites)
    return sure.unionByName(unsure.join(exact, ["a", "b"], "left_semi")).select("a", "b", "first_id", "n")


def lost_lines(lines: DataFrame, spread: DataFrame) -> DataFrame:
    """(doc_id, a, b): the lines that each document loses. Rows of lines that many documents have meet a copy of the line per salt."""
    lines = thinned(lines.select("doc_id", "a", "b"), bit_table(spread, "a"), "a")
    hot = bit_table(spread.filter(F.col("n") >= HOT_DOCS), "a")
    salted = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    many = thinned(lines, hot, "a").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    many = many.join(thinned(spread, hot, "a").select("a", "b", "first_id", salted), ["a", "b", "salt"]).drop("salt")
    few = thinned(lines, hot, "a", there=False).join(thinned(spread, hot, "a", there=False).drop("n"), ["a", "b"])
    return many.unionByName(few).filter(F.col("doc_id") != F.col("first_id")).select("doc_id", "a", "b")


def by_list(docs: DataFrame) -> DataFrame:
    """docs (text, _drop) with _lines and _kept: the lines whose keys are not in _drop, in order."""
    kept = F.filter("_lines", lambda x: ~F.coalesce(F.array_contains("_drop", line_key(bare(x))), F.lit(False)))
    return split(docs).withColumn("_kept", kept)


def by_join(docs: DataFrame) -> DataFrame:
    """The same for documents that lose very many lines: their lines meet _drop in a join."""
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "long-documents")
    lines = split(rows).select("_row", F.posexplode("_lines").alias("_at", "_line")).withColumn("_key", line_key(bare(F.col("_line"))))
    stay = lines.join(rows.select("_row", F.explode("_drop").alias("_key")), ["_row", "_key"], "left_anti")
    stay = stay.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_at", "_line")))["_line"].alias("_kept"))
    return split(rows.join(stay, "_row", "left")).withColumn("_kept", F.coalesce("_kept", F.array().cast("array<string>"))).drop("_row")


def apply(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """docs with its text cleaned, plus n_lines (lines before) and n_removed, in this order. Rows of a null doc_id stay as they are."""
    outs = [free(c, docs.columns) for c in ("n_lines", "n_removed")]
    docs, own = hidden(docs, "doc_id", "text", "source")
    lines = written(lines_of(split(docs)), "lines")
    spread = written(spread_lines(lines, min_sites, lg_k), "spread-lines")
    drop = lost_lines(lines, spread).groupBy("doc_id").agg(F.collect_set(F.struct("a", "b")).alias("_drop"))
    drop = written(drop.withColumnRenamed("doc_id", "_id"), "lost-lines")
    dropped(lines)
    losing, long = bit_table(drop, "_id"), bit_table(drop.filter(F.size("_drop") > MANY), "_id")
    none = {"_id": F.lit(None).cast(drop.schema["_id"].dataType), "_drop": F.lit(None).cast(drop.schema["_drop"].dataType), "_kept": F.lit(None).cast("array<string>")}
    rest, same = thinned(docs, losing, "doc_id"), F.col("doc_id") == F.col("_id")
    # merged at every size: lists of lines are far larger in memory than in the file that an automatic broadcast goes by
    few = by_list(thinned(rest, long, "doc_id", there=False).join(drop.hint("merge"), same, "left"))
    many = by_join(thinned(rest, long, "doc_id").join(drop.hint("merge"), same, "left"))
    joined = few.unionByName(many).unionByName(split(thinned(docs, losing, "doc_id", there=False)).withColumns(none))
    n_lines = F.when(whole("text") == "", 0).otherwise(F.size("_lines"))
    whole_text = F.col("_drop").isNull() | (whole("text") == "")
    clean = F.when(whole_text, whole("text")).otherwise(F.array_join("_kept", "\n"))
    n_removed = F.when(whole_text, 0).otherwise(n_lines - F.size("_kept"))
    counted = joined.withColumns({"_n_lines": n_lines.cast("bigint"), "_n_removed": n_removed.cast("bigint"), "text": clean})
    return counted.select(*own, F.col("_n_lines").alias(outs[0]), F.col("_n_removed").alias(outs[1]))
