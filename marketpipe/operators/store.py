"""The keyed table store: upserts into year partitions, newest and first versions, windows of rows, retention, snapshots."""

from __future__ import annotations

import json
from collections.abc import Sequence
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.workspace import written
from ..schemas import BAR_KEY, BARS


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes last in the given order (arrival first, then all that breaks ties)."""
    return df.withColumn("_n", _ranked(df, keys, [F.col(c).desc_nulls_last() for c in order])).filter("_n = 1").drop("_n")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return df.withColumn("_n", _ranked(df, keys, [F.col(c).asc_nulls_last() for c in order])).filter("_n = 1").drop("_n")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def merged(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """Existing rows overridden by incoming rows of the same key; within a batch the last by ties stays."""
    both = existing.withColumn("_batch", F.lit(0)).unionByName(incoming.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
    return keep_last(both, keys, ["_batch", *ties]).drop("_batch")


def numbered(df: DataFrame, *order: str, name: str = "ordinal") -> DataFrame:
    """df with its rows numbered from 1 in the given order. Numbers come from range partitions and their sizes; rows never meet in one task."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    parts = written(parts.withColumn("_i", F.monotonically_increasing_id()), "ranges")  # within a partition in row order, from its least
    sizes = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"), F.min("_i").alias("_least"))
    # one row for each range partition
    sizes = sizes.select("_p", "_least", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_before"))
    return parts.join(F.broadcast(sizes), "_p").withColumn(name, F.col("_i") - F.col("_least") + F.col("_before") + 1).drop("_p", "_i", "_least", "_before")


#: Commits whose files stay readable after newer ones, and how often a writer starts again when another one was faster.
KEPT_COMMITS, ATTEMPTS = 5, 5


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def commits(spark: SparkSession, path: str) -> list[str]:
    """Names of a table's manifests, oldest first."""
    fs, folder = _hadoop(spark, f"{path}/_commits")
    return sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().endswith(".json")) if fs.exists(folder) else []


def manifest(spark: SparkSession, path: str, name: str | None = None) -> tuple[int, dict[int, str]]:
    """(number, year -> batch folder) of a commit, by default of the newest. Without any commit the number is 0, and the years are those
    of a plain year-partitioned table ('' for the table's own folder)."""
    names = commits(spark, path)
    if not names:
        fs, folder = _hadoop(spark, path)
        found = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return 0, {int(n[5:]): "" for n in found if n.startswith("year=")}
    fs, file = _hadoop(spark, f"{path}/_commits/{name or names[-1]}")
    stream = fs.open(file)
    try:
        years = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return int((name or names[-1])[:8]), {int(y): batch for y, batch in years.items()}


def commit(spark: SparkSession, path: str, number: int, years: dict[int, str]) -> bool:
    """Makes a manifest the newest in one step, a rename that never replaces; False where another writer has taken the number."""
    fs, draft = _hadoop(spark, f"{path}/_commits/.{uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(json.dumps({str(y): b for y, b in sorted(years.items())}).encode())
    stream.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_commits/{number:08d}.json")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, target, options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        fs.delete(draft, False)
        return False
    return True


def expire(spark: SparkSession, path: str, keep: int = KEPT_COMMITS) -> None:
    """Deletes manifests older than the newest keep ones, and the batch folders that only they name."""
    names = commits(spark, path)
    old, new = ([set(manifest(spark, path, n)[1].values()) for n in part] for part in (names[:-keep], names[-keep:]))
    for batch in set().union(*old) - set().union(*new) - {""}:
        for folder in (f"{path}/batch={batch}", f"{path}/_counts/batch={batch}"):
            fs, p = _hadoop(spark, folder)
            fs.delete(p, True)
    for name in names[:-keep]:
        fs, p = _hadoop(spark, f"{path}/_commits/{name}")
        fs.delete(p, False)


def day_counts(df: DataFrame, date: str = "date") -> DataFrame:
    """(date, series, n) of all rows; series is null where it is null or absent."""
    series = F.col("series") if "series" in df.columns else F.lit(None).cast("string")
    return df.groupBy(F.col(date).alias("date"), series.alias("series")).agg(F.count(F.lit(1)).alias("n"))


def upsert(spark: SparkSession, incoming: DataFrame, path: str, keys: Sequence[str] = BAR_KEY, ties: Sequence[str] | None = None, date: str = "date") -> None:
    """Brings rows into a year-partitioned table; running it twice equals running it once.

    Only the years that incoming touches are written, in ranges of the key, to a new batch folder, with their counts per day and series.
    A manifest that names the batch of every year then becomes current in one step: a reader sees the table before or after, never
    a part, and what a stopped writer leaves is not read. A writer whose number another one has taken starts again from that one's table.
    Rows of a batch that share a key: the last by ties (by default all other columns) stays.
    """
    ties = [c for c in incoming.columns if c not in keys] if ties is None else ties
    incoming = incoming.withColumn("year", F.year(date)).persist()
    try:
        years = [r["year"] for r in incoming.select("year").distinct().collect()]  # a handful at most
        for _ in range(ATTEMPTS if years else 0):
            number, base = manifest(spark, path)
            existing = _of_years(spark, path, incoming.schema, {y: base[y] for y in years if y in base})
            out = merged(existing, incoming, keys, ties).repartitionByRange("year", *keys).sortWithinPartitions("year", *keys)
            batch = uuid4().hex
            out.write.option("compression", "zstd").partitionBy("year").parquet(f"{path}/batch={batch}")
            now = spark.read.schema(incoming.schema).parquet(f"{path}/batch={batch}")
            day_counts(now, date).withColumn("year", F.year("date")).coalesce(1).write.partitionBy("year").parquet(f"{path}/_counts/batch={batch}")  # a row a day and series
            if commit(spark, path, number + 1, base | dict.fromkeys(years, batch)):
                return expire(spark, path)
        if years:
            raise RuntimeError(f"{ATTEMPTS} other writers were faster at {path}")
    finally:
        incoming.unpersist()


def _of_years(spark: SparkSession, path: str, schema: T.StructType, batches: dict[int, str], root: str = "") -> DataFrame:
    """The files of the given years, of the batch of each."""
    if not batches:
        return spark.createDataFrame([], schema if "year" in schema.names else T.StructType([*schema.fields, T.StructField("year", T.IntegerType())]))
    paths = [f"{path}{root}/batch={b}/year={y}" if b else f"{path}/year={y}" for y, b in sorted(batches.items())]
    old, new = [p for p in paths if "/batch=" not in p], [p for p in paths if "/batch=" in p]
    frames = [spark.read.schema(schema).option("basePath", f"{path}{root}" if some is new else path).parquet(*some).drop("batch") for some in (old, new) if some]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def read_years(spark: SparkSession, path: str, schema: T.StructType, years: Sequence[int] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """The year partitions of a table's newest commit, pruned; empty where the table is absent."""
    batches = manifest(spark, path)[1]
    out = _of_years(spark, path, schema, {y: b for y, b in batches.items() if years is None or y in {int(x) for x in years}})
    return out.select(*columns) if columns else out


COUNTS = "date date, series string, n bigint"


def read_counts(spark: SparkSession, path: str, years: Sequence[int] | None = None) -> DataFrame:
    """COUNTS of the newest commit, as written with it: no stored row is read. Years that were never upserted are counted."""
    batches = {y: b for y, b in manifest(spark, path)[1].items() if years is None or y in {int(x) for x in years}}
    kept = _of_years(spark, path, T.StructType.fromDDL(COUNTS), {y: b for y, b in batches.items() if b}, "/_counts").drop("year")
    plain = {y: b for y, b in batches.items() if not b}
    return kept.unionByName(day_counts(_of_years(spark, path, BARS, plain))) if plain else kept


def stored_statistics(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """(dataset, year, n_rows, max_date) of each year of a table, from its counts."""
    return read_counts(spark, path).groupBy(F.lit(dataset).alias("dataset"), F.year("date").alias("year")).agg(F.sum("n").alias("n_rows"), F.max("date").alias("max_date"))


def with_absent(df: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """df in the schema's columns: absent ones filled with their default or null, extra ones left out."""
    have, defaults = set(df.columns), defaults or {}
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name) for f in schema))


def trailing_rows(df: DataFrame, key: str, n: int, end: Column | None = None, date: str = "date", ties: Sequence[str] = ()) -> DataFrame:
    """The last n rows of each key up to end; reads end's year and the year before it."""
    if end is not None:
        df = df.filter((F.col(date) <= end) & (F.year(date) >= F.year(end) - 1))
    order = [F.col(date).desc(), *(F.col(t).desc() for t in ties)]
    return df.withColumn("_n", _ranked(df, [key], order)).filter(F.col("_n") <= n).drop("_n")


def newest_partitions(df: DataFrame, keep: int, date: str = "date") -> DataFrame:
    """Rows of the newest keep day partitions. The dates are ranked alone, then joined back: rows never meet in one task."""
    days = df.select(date).distinct()
    ranked = days.withColumn("_n", F.dense_rank().over(Window.orderBy(F.col(date).desc()))).filter(F.col("_n") <= keep).drop("_n")
    return df.join(ranked, date, "left_semi")


def write_day_delta(df: DataFrame, path: str, keep: int = 35, date: str = "date", by: Sequence[str] = ()) -> None:
    """One partition per day, or per day and the columns in by, such as the batch of a stream; only the newest keep days stay. A partition
    that is written again replaces itself."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date, *by).parquet(path)
    fs, folder = _hadoop(spark, path)
    days = sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().startswith(f"{date}=")) if fs.exists(folder) else []
    for day in days[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, day), True)


def _pointers(spark: SparkSession, path: str):
    """The file system, the folder of a snapshot's pointers, and their names in order."""
    fs, folder = _hadoop(spark, f"{path}/_current")
    return fs, folder, sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version that the newest pointer names; None without any."""
    names = _pointers(spark, path)[2]
    return names[-1].partition(".")[2] if names else None


def write_snapshot(df: DataFrame, path: str, version: str) -> str:
    """A full table under a new version folder. Its pointer, an empty file that is made in one step, comes last: until then the version
    before is current."""
    spark, target = df.sparkSession, f"{path}/version={version}"
    df.write.mode("overwrite").parquet(target)
    fs, folder, names = _pointers(spark, path)
    if not fs.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{len(names):08d}.{version}")):
        raise RuntimeError(f"another snapshot of {path} was written meanwhile")
    return target


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/version={current_version(spark, path)}")


def unchanged(a: DataFrame, b: DataFrame, ignore: Sequence[str] = ("date",)) -> DataFrame:
    """One row: rows only in a, only in b, and whether the contents are equal, repeated rows counted, ignored columns left out."""
    cols = [c for c in a.columns if c not in ignore]
    one, two = a.select(cols), b.select(cols)
    only_a, only_b = one.exceptAll(two).agg(F.count(F.lit(1)).alias("only_a")), two.exceptAll(one).agg(F.count(F.lit(1)).alias("only_b"))
    return only_a.crossJoin(only_b).withColumn("unchanged", (F.col("only_a") == 0) & (F.col("only_b") == 0))  # one row each


def write_if_changed(df: DataFrame, path: str, version: str, sort: Sequence[Column]) -> bool:
    """A sorted snapshot, written only where its content differs from the current one."""
    spark = df.sparkSession
    if current_version(spark, path) is not None and unchanged(df, read_snapshot(spark, path), ()).first()["unchanged"]:
        return False
    write_snapshot(df.orderBy(*sort), path, version)
    return True


def append_ledger(ledger: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An append-only ledger: of equal keys the earlier row stays."""
    both = ledger.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    return keep_first(both, keys, ["_batch", *[c for c in ledger.columns if c not in keys]]).drop("_batch")


def append_status(status: DataFrame, path: str) -> None:
    """Appends the rows of a run's status or report, as JSON."""
    status.write.mode("append").json(path)


def write_failures(statuses: DataFrame, target: str, path: str) -> DataFrame:
    """The side table of a run's failed days other than the target day; it replaces that of the run before, also with no rows."""
    failures = statuses.filter((F.col("status") == "failed") & (F.col("date") != F.lit(target).cast("date")))
    failures.write.mode("overwrite").parquet(path)
    return failures.sparkSession.read.schema(failures.schema).parquet(path)


def day_present(df: DataFrame, day: Column, date: str = "date") -> DataFrame:
    return df.filter(F.col(date) == day).limit(1).agg((F.count(F.lit(1)) > 0).alias("present"))


def partition_statistics(df: DataFrame, dataset: str, date: str = "date") -> DataFrame:
    """(dataset, year, n_rows, max_date) of each year partition."""
    return df.groupBy(F.lit(dataset).alias("dataset"), F.year(date).alias("year")).agg(F.count(F.lit(1)).alias("n_rows"), F.max(date).alias("max_date"))


def fingerprint(df: DataFrame) -> DataFrame:
    """(n_rows, fingerprint) of a table, whatever its partitioning: sums over the parts of each row's sha256, hashed once more.

    Sums merge map side, so no task holds more than its own rows. Columns count in name order, null differs from empty.
    """
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(df.columns)))
    parts = [F.conv(F.substring("_h", 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)") for i in range(5)]
    sums = df.select(F.sha2(text, 256).alias("_h")).agg(F.count(F.lit(1)).alias("n_rows"), *(F.sum(p).alias(f"s{i}") for i, p in enumerate(parts)))
    return sums.select("n_rows", F.sha2(F.concat_ws("|", "n_rows", *(F.coalesce(F.col(f"s{i}"), F.lit(0)).cast("string") for i in range(5))), 256).alias("fingerprint"))
