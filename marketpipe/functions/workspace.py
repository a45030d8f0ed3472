"""Where intermediate tables go, and how the package reaches the executors."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, as spark.checkpoint.dir names it; a local session may do without."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to storage that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, by: Sequence[str] = (), **options: str) -> DataFrame:
    """df written as Parquet to the shared folder, in partitions of the columns in by, and read back: lineage ends there, and lost executors
    lose nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**options).partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def dropped(df: DataFrame) -> None:
    """Deletes a table that written() returned, once nothing that is still to run reads it."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Gives the package to the executors, once per application."""
    sc, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(sc, "_marketpipe_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="spark-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._marketpipe_shipped = True
