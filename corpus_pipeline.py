"""From documents to packed training sequences: language, quality, boilerplate lines, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the columns of
documents. Null texts and texts without a letter end in the first stage; an empty table passes through all stages empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketpipe.llm import langid, line_dedup, minhash, packing, quality
from marketpipe.llm.queries import tokenizer
from marketpipe.llm.shared import hidden, prepare, table, written


#: Similarity in percent from which two documents are near duplicates; op1's contract of 85 binds its query only.
NEAR_PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text fits one of the languages that the labelled documents show."""
    prepare(spark)
    return langid.accepted(docs, langid.fit(docs))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    prepare(spark)
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on many sites; a document that loses lines keeps its row and gets a new n_chars."""
    out = line_dedup.apply(docs)
    removed = out.columns[-1]  # the operator's count, whatever the table's columns are called
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(removed) > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.drop(*out.columns[-2:])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id. Of rows that repeat its doc_id and text one stays,
    the first by the other columns, as text; rows of one doc_id with different texts are different documents. Rows without an id
    stay: links go by ids."""
    prepare(spark)
    groups = minhash.near_groups(docs, NEAR_PERCENT).groupBy(F.col("doc_id").alias("_kept"))
    kept = written(groups.agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).filter("kept").select("_kept", "n"), "near-kept")
    rows, own = hidden(docs, "doc_id", "text")
    same = F.col("doc_id").cast("bigint") == F.col("_kept")
    once, more = (rows.join(kept.filter(x), same, "left_semi") for x in ("n = 1", "n > 1"))
    extra = F.to_json(F.struct(F.lit(0).alias("none"), *(c for c in rows.columns if c not in ("doc_id", "text"))))  # any type, maps too
    nth = F.row_number().over(Window.partitionBy("doc_id", "text").orderBy(extra))
    return once.unionByName(more.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")).unionByName(rows.filter("doc_id is null")).select(own)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the packed sequences."""
    prepare(spark)
    return packing.pack(docs, tokenizer())


STAGES = [("language", language), ("quality", good), ("lines", lines), ("near", near), ("pack", pack)]

#: Language models, boosted trees, signatures and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
