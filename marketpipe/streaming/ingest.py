"""Day files as a stream: idempotent replay into the keyed store, exactly-once documents, pending filings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.admission import Limits, admissions, may_enter
from ..operators.gates import breaks_contract, completeness, tagged
from ..operators.store import day_counts, keep_first, keep_last, merged, read_counts, read_years, upsert, write_day_delta
from ..functions.filters import bit_table, thinned
from ..functions.workspace import written
from ..schemas import BAR_KEY, BARS


def day_files(spark: SparkSession, path: str, schema: T.StructType = BARS, per_batch: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def ingest(stream: DataFrame, store: str, checkpoint: str, quarantine_path: str | None = None, keys: Sequence[str] = BAR_KEY, deltas: str | None = None, keep: int = 35) -> StreamingQuery:
    """Upserts every batch's sound rows into the store; they go to deltas, a partition per day and batch, and bad rows to the side table
    under their batch. A replayed batch replaces its own partitions and repeats its upsert, so it changes nothing; the store moves last. Of
    the deltas the newest keep days stay. Runs over what is there, then stops."""

    def batch(df: DataFrame, epoch: int) -> None:
        marked = tagged(df, "_ok").persist()
        good = marked.filter("_ok").drop("_ok")
        if quarantine_path:
            marked.filter("not _ok").drop("_ok").write.mode("overwrite").parquet(f"{quarantine_path}/batch={epoch}")
        if deltas:
            write_day_delta(good.withColumn("batch", F.lit(epoch)), deltas, keep, by=["batch"])
        upsert(df.sparkSession, good, store, keys)
        marked.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_deltas(spark: SparkSession, path: str, keys: Sequence[str] = BAR_KEY) -> DataFrame:
    """The rows of a stream's deltas: of each key that of its last batch."""
    return keep_last(spark.read.schema(T.StructType([*BARS.fields, T.StructField("batch", T.LongType())])).parquet(path), keys, ["batch"]).drop("batch")


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    """The bad rows that a backfill has kept, with the day that was asked for; none where no day has any, and so no partition."""
    return spark.read.schema(T.StructType([*BARS.fields, T.StructField("day", T.DateType())])).parquet(path)


def once_within(stream: DataFrame, time: str, key: str = "dedup_key", late: str = "30 days") -> DataFrame:
    """Each document once, of those whose event times lie within the allowed lateness of each other; older state and late rows are
    dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def once_per_document(stream: DataFrame, time: str, out: str, ledger: str, checkpoint: str, key: str = "dedup_key") -> StreamingQuery:
    """Writes each document of a stream once to out, however late it comes or comes again: of a batch its first row by time.

    The ledger of processed keys decides: a batch leaves out what an earlier batch has in it. The ledger is thinned by a filter of the
    batch's keys before the join, so what is shuffled follows the batch and not the ledger; the stream holds no state. Rows and keys are
    written under the batch's number, and only earlier numbers are looked up, so a replayed batch replaces its own. Rows without a key are
    not documents."""
    names = stream.columns

    def batch(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        rows = df.filter(F.col(key).isNotNull()).persist()
        fresh = keep_first(rows, [key], [time, *(c for c in names if c not in (key, time))])
        if _exists(spark, ledger):
            done = spark.read.schema(T.StructType([rows.schema[key], T.StructField("batch", T.LongType())])).parquet(ledger).filter(F.col("batch") < epoch)
            fresh = fresh.join(thinned(done.select(key), bit_table(rows, key), key), key, "left_anti").select(*names)
        fresh = fresh.persist()
        fresh.write.mode("overwrite").parquet(f"{out}/batch={epoch}")
        fresh.select(key).write.mode("overwrite").parquet(f"{ledger}/batch={epoch}")
        fresh.unpersist()
        rows.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


#: A change of a filing that waits: since when, and whether it still does.
PENDING_CHANGE = "filing_key string, seen date, waiting boolean"


def track_pending(stream: DataFrame, changes: str, checkpoint: str) -> StreamingQuery:
    """Follows filings (filing_key, locator, seen) that wait for a locator, over a stream.

    A batch writes only what changes, under its number: filings that begin to wait, that are seen to have begun earlier, or that stop
    waiting. Keys that had a locator from the first go beside the changes, as they never wait. A batch, folded to one row a filing, is held
    against what earlier batches wrote of its filings, thinned by a filter of its keys before the join; a replayed batch replaces its own.
    pending() reads the present state."""

    def batch(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        has = F.col("locator").isNotNull()
        now = df.filter(F.col("filing_key").isNotNull()).groupBy("filing_key").agg(F.min("seen").alias("seen"), F.max(has).alias("done")).persist()
        folded = now
        if _exists(spark, changes):
            keys = bit_table(now, "filing_key")
            known = _changes(spark, changes).unionByName(_changes(spark, f"{changes}/_never"))
            last = thinned(known.filter(F.col("batch") < epoch), keys, "filing_key").groupBy("filing_key").agg(F.max_by(F.struct("seen", "waiting"), "batch").alias("_last"))
            now = now.join(last, "filing_key", "left").persist()
        else:
            now = now.withColumn("_last", F.lit(None).cast("struct<seen: date, waiting: boolean>"))
        new, first = F.col("_last").isNull(), F.least("_last.seen", "seen")
        news = (new & ~F.col("done")) | (F.col("_last.waiting") & (F.col("done") | ~first.eqNullSafe(F.col("_last.seen"))))
        never = now.filter(new & F.col("done")).select("filing_key", "seen", F.lit(False).alias("waiting"))
        never.write.mode("overwrite").parquet(f"{changes}/_never/batch={epoch}")
        now.filter(news).select("filing_key", first.alias("seen"), (~F.col("done")).alias("waiting")).write.mode("overwrite").parquet(f"{changes}/batch={epoch}")
        now.unpersist()
        folded.unpersist()

    rows = stream.select("filing_key", "locator", "seen")
    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _changes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PENDING_CHANGE + ", batch bigint").parquet(path)


def pending(spark: SparkSession, changes: str) -> DataFrame:
    """(filing_key, seen) of the filings that wait: the last change of each."""
    return keep_last(_changes(spark, changes), ["filing_key"], ["batch"]).filter("waiting").select("filing_key", "seen")


def windowed_counts(stream: DataFrame, time: str, width: str = "1 day", late: str = "1 day", by: Sequence[str] = ()) -> DataFrame:
    """Event counts per tumbling window, final once the watermark has passed it. The time column may be without a zone."""
    t = F.col(time).cast("timestamp")
    return stream.withColumn("_t", t).withWatermark("_t", late).groupBy(F.window("_t", width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").cast("date").alias("day"), *by, "n")


def catch_up(spark: SparkSession, days: DataFrame, counts: DataFrame, means: DataFrame, share: float = 0.85) -> DataFrame:
    """(date, action): replay days that are missing or short of their trailing means; the rest need nothing."""
    done = completeness(counts, means, share)
    out = days.join(done, "date", "left")
    return out.select("date", F.when(F.col("complete").isNull(), "fill").when(~F.col("complete"), "top_up").otherwise("skip").alias("action"))


def day_totals(marked: DataFrame, asked: str = "date") -> DataFrame:
    """(date, rows, bad, wrong_date, broken) of each day that was asked for."""
    return marked.groupBy(F.col(asked).alias("date")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("_ok")).alias("bad"), F.count_if("_wrong").alias("wrong_date"), F.count_if("_broken").alias("broken"))


def tallies(marked: DataFrame, clean: DataFrame, store: str, calendar: DataFrame, first: int, last: int, history: int, dataset: str, asked: str = "date") -> DataFrame:
    """TALLIES of the days whose ordinals lie from first to last, and of the history before them.

    Counts of stored days come from the store's own counts. Stored keys are read only of days that are both there and in what came, for
    what the store would have of them."""
    spark, trading = marked.sparkSession, F.broadcast(calendar.filter("is_trading").select("date", "ordinal"))  # a row a day
    years = [r[0] for r in calendar.filter(F.col("ordinal").between(first - history, last)).select(F.year("date")).distinct().collect()]
    stored = read_counts(spark, store, years).join(trading, "date").filter(F.col("ordinal").between(first - history, last))
    there = [r[0] for r in stored.filter(F.col("ordinal") >= first).select("date").distinct().collect()]  # days of the window
    held = read_years(spark, store, BARS, years, [*BAR_KEY, "series"]).filter(F.col("date").isin(there)) if there else None
    rows = clean.select(*BAR_KEY, "series")
    after = day_counts(merged(held.join(rows.select("date").distinct(), "date", "left_semi"), rows, BAR_KEY) if held else rows)
    come = marked.withColumn("date", F.col(asked))
    whole = day_totals(marked, asked)
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in ("rows", "bad", "wrong_date", "broken"))))
    whole = whole.select("date", F.lit(None).cast("string").alias("series"), kinds.alias("x")).select("date", "series", "x.kind", "x.n")
    parts = whole
    for kind, counts in (("stored", stored), ("raw", day_counts(come)), ("merged", after)):
        parts = parts.unionByName(counts.select("date", "series", F.lit(kind).alias("kind"), "n"))
    return parts.join(trading, "date").select(F.lit(dataset).alias("dataset"), "date", "ordinal", "series", "kind", "n")


def backfill(raw: DataFrame, store: str, calendar: DataFrame, end: str, n: int, limits: Limits = Limits(), asked: str = "date", evidence: str | None = None, deltas: str | None = None, keep: int = 35, dataset: str = "bars") -> DataFrame:
    """ADMITTED without evidence: each of the last n trading days up to end, after bringing them into the store in one job.

    raw: bars of any days; asked names its column with the day that was asked for, where that may differ from the bars' own. A day that
    the store has in full is left as it is, so a second run does nothing; a short day is topped up. Without rows end is not there yet, any
    other day has failed. A day must pass, in this order: all rows of its date, the bounds on rows, the gate on each series, one sound row
    at least, the contract. A refused day changes nothing: days after it are held against what the store has without it. Bad rows of days
    that came as far as the sound ones go to evidence, a partition a day; admitted days go to deltas, of which the newest keep days stay.
    The store moves last, in one step. Days that their own counts keep out are counted and go no further, so that what is held against the
    store is n days of limits.most rows, however many came.
    """
    trading = calendar.filter(F.col("is_trading") & (F.col("date") <= F.lit(end).cast("date"))).select("date", "ordinal")
    last = trading.agg(F.max("ordinal")).first()[0] or 0
    days = trading.filter(F.col("ordinal") > last - n)
    mine = raw.join(F.broadcast(days.select(F.col("date").alias("_asked"))), F.col(asked) == F.col("_asked"))
    marked = tagged(mine, "_ok").withColumns({"_wrong": ~F.col("date").eqNullSafe(F.col("_asked")), "_broken": F.col("_ok") & breaks_contract()}).persist()
    some = [r["date"] for r in day_totals(marked, "_asked").filter(may_enter(limits)).collect()]  # at most n days
    clean = keep_last(marked.filter("_ok and not _wrong").filter(F.col("_asked").isin(some)).select(*BARS.names), BAR_KEY, [c for c in BARS.names if c not in BAR_KEY]).persist()
    counted = tallies(marked, clean, store, calendar, last - n + 1, last, limits.history, dataset, "_asked")
    # as the store was before; a dataset without any count has days all the same
    none = days.limit(1).select(F.lit(dataset).alias("dataset"), "date", "ordinal", F.lit(None).cast("string").alias("series"), F.lit("none").alias("kind"), F.lit(0).cast("bigint").alias("n"))
    judgement = written(admissions(counted.unionByName(none), days, end, limits), "admissions")
    if evidence:
        shown = F.broadcast(judgement.filter("evidence").select(F.col("date").alias("_asked")))  # at most n days
        bad = marked.filter("not _ok").join(shown, "_asked", "left_semi").withColumn("day", F.col("_asked"))
        bad.select(*BARS.names, "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(evidence)
    good = clean.join(F.broadcast(judgement.filter(F.col("status").isin("success", "success_topped_up")).select("date")), "date", "left_semi")
    if deltas:
        write_day_delta(good, deltas, keep)
    upsert(raw.sparkSession, good, store)
    clean.unpersist()
    marked.unpersist()
    return judgement.drop("evidence")


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
