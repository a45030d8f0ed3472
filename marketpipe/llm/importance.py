"""Importance resampling towards a target distribution of hashed word features.

Words are runs of letters, digits and characters beyond ASCII, after lower-casing A-Z; features are all runs of 1 to 2 words, hashed
into BUCKETS buckets. A bucket's gain says how much likelier it is in the target than in the corpus; a document's weight is the floored
mean gain of its features, looked up in one array. Weight plus Gumbel noise, drawn from the document's id, is its score; the
highest scores are a sample without replacement in which a document's chance goes with the exponential of its weight.

The bucket counts of corpus and target cover all their texts. Scores are written once. The cutoff between drawn and undrawn documents
comes from exact counts over them: each job counts the rows above SPLITS thresholds at once, which leaves one of SPLITS + 1 parts of the
range, until one score is left, and then one doc_id among those that tie on it. Only the drawn rows are sorted, by range partitions.

Null texts are empty: no features, weight 0, never drawn unless fewer than 1 word is asked for. A document without an id has no noise:
its score and rank are null, and it is not among the documents from which is drawn. Repeated rows count each; of rows that are equal
in id and score those with fewer features are drawn first. Without rows there is no result; an empty target has the same gain for all
unseen features. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.store import numbered
from .shared import written

BUCKETS, SCALE = 10_000, 1000
#: Words that a document must have to be drawn, the percentage that is drawn, and the seed of the noise.
LEAST_WORDS, PERCENT, SEED = 20, 25, "7"
#: Thresholds that one job counts.
SPLITS = 31
#: Bytes of a text that are cut into words at once.
STRETCH = 1 << 20

#: Bytes of words as they are, A-Z in lower case, all else as a space; bytes beyond ASCII belong to words.
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def features(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """Words, and the buckets of the features that end in them, of one stretch of a text after the other."""
    data, lo, before = text.encode().translate(WORD_BYTES), 0, []
    while lo < len(data):
        hi = data.find(b" ", lo + STRETCH)
        hi = len(data) if hi < 0 else hi
        words = data[lo:hi].split()
        # the checksum of "a b" goes on from that of "a"
        ones = list(map(crc32, words))
        twos = map(crc32, map(b" ".__add__, words if before else words[1:]), before + ones)
        yield len(words), np.array([*ones, *twos], np.uint32) % BUCKETS
        lo, before = hi, ones[-1:] or before


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task adds up its own; BUCKETS rows reach the driver, whatever the input."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, at in features(text):
                    total += np.bincount(at, minlength=BUCKETS)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], names=["bucket", "n"])

    parts = docs.filter("text is not null").select("text").mapInArrow(work, "bucket int, n bigint")
    out = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """SCALE times the log ratio of the smoothed shares in target and corpus, floored, per bucket."""
    s, t = corpus.astype(float), target.astype(float)
    return np.floor(SCALE * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise from the first 32 bits of a digest of seed and id, times SCALE and floored."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / float(1 << 32))))


def scored(docs: DataFrame, gain: np.ndarray, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                parts = [(n, len(at), int(shared.value[at].sum())) for n, at in features(text or "")]
                words, many, total = map(sum, zip(*parts, (0, 0, 0)))
                rows.append((words, many, total // max(many, 1)))
            columns = np.array(rows, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    return rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def cutoff(rows: DataFrame, column: str, want: int) -> tuple[int, int]:
    """The largest number c for which at least want >= 1 rows have column >= c, and how many rows have more than c. rows: want or more,
    none null in the column."""
    low, high = (int(x) for x in rows.agg(F.min(column), F.max(column)).first())
    above = 0  # the rows beyond high; those from low on are enough
    while low < high:
        at = sorted({low + (high - low) * k // (SPLITS + 1) + 1 for k in range(SPLITS + 1)})
        counts = rows.agg(*(F.count(F.when(F.col(column) >= F.lit(t), 1)) for t in at)).first()
        enough = [low, *(t for t, n in zip(at, counts) if n >= want)][-1]
        beyond = next(((t, n) for t, n in zip(at, counts) if n < want), (high + 1, above))
        low, high, above = enough, beyond[0] - 1, beyond[1]
    return low, above


def draw(docs: DataFrame, target: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each document; rank counts from 1 over the drawn ones and is null for the others.

    Drawn are floor(percent * N / 100) of the N documents with an id and at least least_words words."""
    rows = written(scored(docs, gains(bucket_counts(docs), bucket_counts(target)), seed), "importance-scores")
    fit = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    want = rows.filter(fit).count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not want:
        return rows.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    score, above = cutoff(rows.filter(fit), "score", want)
    tied = rows.filter(fit & (F.col("score") == score)).select(F.bitwise_not("doc_id").alias("turned"))  # the other way round, without overflow
    last = ~cutoff(tied, "turned", want - above)[0]
    drawn = F.coalesce(fit & ((F.col("score") > score) | ((F.col("score") == score) & (F.col("doc_id") <= last))), F.lit(False))
    key = rows.filter(drawn).withColumn("falling", -F.col("score"))
    ranked = numbered(key, "falling", "doc_id", "n_features", name="rank").withColumn("rank", F.when(F.col("rank") <= want, F.col("rank")))  # rows that repeat the last one
    return rows.filter(~drawn).select(*columns, F.lit(None).cast("bigint").alias("rank")).unionByName(ranked.select(*columns, "rank"))
