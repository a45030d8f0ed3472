"""Exact dedup by a log-structured merge index of text digests.

Memtables (one bounded batch of rows inside a task) are reduced to one entry per digest and flushed as sorted runs, each with a filter:
a bit table of bounded size. The rows come in FLUSHES parts, a run each. When a level holds FANOUT runs they are merged, with the run of
the level below, into one: sorted by range and folded as a stream, keeping the smallest and the largest identifier of each digest. What
may be a hit, a digest that a run has twice or that passes another run's filter, is looked up in all runs that its filters let it into.
Hits, digests that more than one row has, are verified on the bytes.

Null text counts as empty; texts are equal when they agree after lower-casing A-Z. Repeated rows are copies of each other. Rows without an
id are copies like others; keep_id is the largest (smallest) id of the copies that have one, so such a row is kept only where no copy has.
An empty table gives an empty result. Only doc_id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ascii_lower, bit_table, dropped, fresh_path, thinned, whole, written

#: Rows in one memtable; a full one is flushed.
MEMTABLE_ROWS = 200_000
#: Runs of a level that are merged into the next, and the parts in which the rows of a table are flushed.
FANOUT, FLUSHES = 4, 6
#: Pieces into which the copies of one text are dealt while their bytes are compared.
SALTS = 32
RUN = "digest binary, min_id bigint, max_id bigint, n bigint"


def reduced(entries: pa.Table) -> pa.Table:
    """One sorted entry for each digest of a table of RUN."""
    one = entries.group_by("digest").aggregate([("min_id", "min"), ("max_id", "max"), ("n", "sum")])
    one = one.select(["digest", "min_id_min", "max_id_max", "n_sum"]).rename_columns(["digest", "min_id", "max_id", "n"])
    return one.take(pc.sort_indices(one, [("digest", "ascending")])).combine_chunks()


def flush(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Memtables of (digest, doc_id) rows -> sorted entries, one per digest and memtable."""

    def run(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        t = pa.table([t["digest"], t["doc_id"], t["doc_id"], pa.repeat(pa.scalar(1, pa.int64()), len(t))], names=["digest", "min_id", "max_id", "n"])
        yield from reduced(t).to_batches(max_chunksize=20_000)

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= MEMTABLE_ROWS:
            yield from run(held)
            held, rows = [], 0
    if rows:
        yield from run(held)


def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted entries of many runs -> one entry per digest; the last digest of a batch waits for the next batch."""
    held = None
    for batch in batches:
        if batch.num_rows:
            t = pa.Table.from_batches([batch])
            t = reduced(t if held is None else pa.concat_tables([held, t]))
            yield from t.slice(0, len(t) - 1).to_batches()
            held = t.slice(len(t) - 1)
    if held is not None:
        yield from held.to_batches()


@dataclass
class Run:
    entries: DataFrame
    filter: DataFrame
    merged: bool  # one entry per digest; a flushed run has one per digest and memtable


class DigestIndex:
    """Levels of runs of RUN entries, in the shared folder."""

    def __init__(self, spark: SparkSession):
        self.spark, self.levels = spark, [[]]

    def run(self, entries: DataFrame, merged: bool = True) -> Run:
        entries = written(entries, "digest-run", **{"parquet.enable.dictionary": "false"})
        return Run(entries, written(bit_table(entries, "digest"), "digest-filter"), merged)

    def flush(self, keys: DataFrame) -> None:
        """Adds a run for the rows (digest, doc_id); merges levels that are full."""
        self.levels[0].append(self.run(keys.select("digest", F.col("doc_id").cast("bigint").alias("doc_id")).mapInArrow(flush, RUN), merged=False))
        level = 0
        while len(self.levels[level]) >= FANOUT:
            self.merge(level)
            level += 1

    def merge(self, level: int) -> Run:
        """Merges the runs of a level and of the next into one run of the next level."""
        if level + 1 == len(self.levels):
            self.levels.append([])
        old = self.levels[level] + self.levels[level + 1]
        entries = old[0].entries
        for run in old[1:]:
            entries = entries.unionByName(run.entries)
        new = self.run(entries.repartitionByRange("digest").sortWithinPartitions("digest").mapInArrow(fold, RUN))
        self.levels[level], self.levels[level + 1] = [], [new]
        for run in old:
            dropped(run.entries), dropped(run.filter)
        return new

    def candidates(self) -> DataFrame:
        """(digest) of all that more than one row may have: those that a run has twice, and those that pass another run's filter. Only the
        entries of all runs but the largest are held against filters: of two runs that share a digest one is not the largest."""
        runs = [r for level in self.levels for r in level]
        found = self.spark.createDataFrame([], "digest binary")
        for k, run in enumerate(runs):
            once = run.entries if run.merged else run.entries.groupBy("digest").agg(F.sum("n").alias("n"))
            found = found.unionByName(once.filter("n > 1").select("digest"))
            if k + 1 < len(runs):  # the last one is of the deepest level
                for other in runs[:k] + runs[k + 1 :]:
                    found = found.unionByName(thinned(run.entries.select("digest"), other.filter, "digest"))
        return found.distinct()

    def drop(self) -> None:
        """Deletes the runs and their filters."""
        for run in (r for level in self.levels for r in level):
            dropped(run.entries), dropped(run.filter)
        self.levels = [[]]

    def lookup(self, digests: DataFrame) -> DataFrame:
        """RUN of those of the rows (digest) that are in the index. Runs whose filter lets none of them through are not read."""
        found = self.spark.createDataFrame([], RUN)
        for run in (r for runs in self.levels for r in runs):
            maybe = thinned(digests.select("digest"), run.filter, "digest")
            if not maybe.isEmpty():
                found = found.unionByName(run.entries.join(maybe, "digest", "left_semi"))
        return found.groupBy("digest").agg(F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"), F.sum("n").alias("n"))


def exact_groups(docs: DataFrame, keep: str = "max") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. keep: which identifier of equal texts stays ("max" or "min").

    The filter of the hits tells most rows without a copy apart, so neither their keys nor their texts are shuffled. The bytes of all other
    rows are compared as the smallest and largest text of their digest, reduced first within each task, then within salted pieces: a
    text with very many copies meets in no single task. Texts that share a digest but differ are grouped by their bytes instead.
    """
    if keep not in ("max", "min"):
        raise ValueError("keep is 'max' or 'min'")
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), ascii_lower(whole("text")).alias("norm"))
    base = base.withColumn("digest", F.unhex(F.sha2("norm", 256)))
    part = F.pmod(F.spark_partition_id(), F.lit(FLUSHES)).alias("part")
    keys = written(base.select("doc_id", "digest", part), "digests", by=["part"], **{"parquet.enable.dictionary": "false"})
    index = DigestIndex(docs.sparkSession)
    for k in range(FLUSHES):
        index.flush(keys.filter(F.col("part") == k))
    keys = keys.drop("part")
    hits = index.run(index.lookup(written(index.candidates(), "candidates")).filter("n > 1"))
    index.drop()

    ends = thinned(base, hits.filter, "digest").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for by in (["digest", "salt"], ["digest"]):
        lo, hi = ("norm", "norm") if "salt" in by else ("lo", "hi")
        ends = ends.groupBy(*by).agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"))
    odd = written(ends.filter("lo <> hi").select("digest"), "collisions")

    single = F.lit(1).cast("bigint")
    found = hits.entries.select("digest", F.col(f"{keep}_id").alias("keep_id"), "n")
    rows = thinned(keys, hits.filter, "digest").join(found, "digest", "left")
    if not odd.isEmpty():
        best = (F.max if keep == "max" else F.min)("doc_id").alias("keep_id")
        split = base.join(odd, "digest", "left_semi")
        groups = split.groupBy("digest", "norm").agg(best, F.count(F.lit(1)).alias("n"))
        rows = rows.join(odd, "digest", "left_anti").select("digest", "doc_id", "keep_id", "n").unionByName(split.join(groups, ["digest", "norm"]).select("digest", "doc_id", "keep_id", "n"))
    alone = thinned(keys, hits.filter, "digest", there=False).select("digest", "doc_id", F.lit(None).cast("bigint").alias("keep_id"), single.alias("n"))
    rows = rows.unionByName(alone)
    keep_id = F.coalesce("keep_id", "doc_id")
    return rows.select("doc_id", keep_id.alias("keep_id"), F.coalesce("n", single).alias("group_size"), keep_id.eqNullSafe(F.col("doc_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
