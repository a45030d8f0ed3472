"""Quality scores by histogram gradient-boosted trees over document statistics.

The trees are fitted on a sample of at most SAMPLE_DOCS labelled documents (the smallest hashes of their ids; of several texts of one
id the smallest counts). Each is a full
binary tree in flat arrays of features, bin limits and leaf values, walked for a whole batch at once in numpy.

Null text counts as empty and gets the score of its (all zero) statistics. Only the text is an input of a score. Labels that are
null or name no document are not used; of repeated labels the lowest counts. Without both labels every score is the labels' mean,
or 1 without any label. Repeated rows get equal scores; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .langid import held_out

SAMPLE_DOCS = 12_000
TREES, DEPTH, BINS, RATE, LEAST = 80, 5, 64, 0.15, 20.0
#: A document is kept from this score on.
THRESHOLD = 0.3
#: Byte classes that are counted: fixed groups of ASCII characters; all other bytes are letters beyond ASCII.
CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".", ",;:", "!?", "|", "#$%&*@^~", "<>{}[]()=_/\\", "\"'`-+"]
FEATURES = 13 + 12


def class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES) + 1, np.uint8)
    table[:128] = len(CLASSES)
    for k, group in enumerate(CLASSES):
        table[list(group.encode())] = k
    return table


def statistics(texts: list[str], table: np.ndarray) -> np.ndarray:
    """(texts, FEATURES) document statistics of whole texts."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for row, text in zip(out, texts):
        if not text:
            continue
        share = np.bincount(table[np.frombuffer(text.encode(), np.uint8)], minlength=len(CLASSES) + 2)
        n, words, lines = share.sum(), text.split(), text.split("\n")
        row[:13] = share[:13] / n
        if not words:
            continue
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        full = [x for x in lines if x]
        row[13:] = (
            np.log1p(n), np.log1p(len(words)), sizes.mean(), sizes.std(), np.log1p(sizes.max()), len(set(words)) / len(words), len(set(full)) / max(len(full), 1),
            len(words) / (1 + share[5]), np.log1p(len(full)), (sizes <= 3).mean(), share[1] / (1 + share[0] + share[1]), sum(x[-1] in ".!?" for x in full) / max(len(full), 1),
        )
    return out


@dataclass
class Trees:
    base: float
    limits: np.ndarray  # (features, BINS - 1) upper limits of the bins
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # (trees, inner nodes): bins up to it go left
    leaf: np.ndarray  # (trees, leaves)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(lim, col, "left") for lim, col in zip(self.limits, x.T)], 1).astype(np.int16)

    def score(self, x: np.ndarray) -> np.ndarray:
        binned, rows = self.bins(x), np.arange(len(x))
        total = np.full(len(x), self.base)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    mean = float(np.clip(y.mean() if len(y) else 1, 1e-6, 1 - 1e-6))
    limits = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.astype(np.float32) if len(y) else np.zeros((FEATURES, BINS - 1), np.float32)
    trees = Trees(float(np.log(mean / (1 - mean))), limits, np.zeros((0, 2**DEPTH - 1), np.int64), np.zeros((0, 2**DEPTH - 1), np.int64), np.zeros((0, 2**DEPTH)))
    if len(np.unique(y)) < 2:
        return trees
    binned = trees.bins(x)
    n, width = len(y), x.shape[1]
    flat = binned.astype(np.int64) + np.arange(width) * BINS
    margin, feature, cut, leaf = np.full(n, trees.base), [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node, fs, cs = np.zeros(n, np.int64), np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, BINS)
        for depth in range(DEPTH):
            first, many = 2**depth - 1, 2**depth
            at = ((node - first)[:, None] * (width * BINS) + flat).ravel()
            hist = [np.bincount(at, weights=np.repeat(v, width), minlength=many * width * BINS).reshape(many, width, BINS).cumsum(2) for v in (g, h)]
            (gl, hl), (gt, ht) = hist, [v[:, :, -1:] for v in hist]
            gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
            gain[(hl < LEAST / 10) | (ht - hl < LEAST / 10)] = 0
            best = gain.reshape(many, -1).argmax(1)
            top = gain.reshape(many, -1)[np.arange(many), best]
            fs[first : first + many] = np.where(top > 1e-6, best // BINS, 0)
            cs[first : first + many] = np.where(top > 1e-6, best % BINS, BINS)
            node = 2 * node + 1 + (binned[np.arange(n), fs[node]] > cs[node])
        node -= 2**DEPTH - 1
        value = RATE * np.bincount(node, weights=g, minlength=2**DEPTH) / (np.bincount(node, weights=h, minlength=2**DEPTH) + 1)
        margin += value[node]
        feature.append(fs), cut.append(cs), leaf.append(value)
    return Trees(trees.base, limits, np.stack(feature), np.stack(cut), np.stack(leaf))


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> Trees:
    """Trees from labelled documents whose crc32(doc_id as text) mod 5 is not 0."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("_y"))
    few = known.orderBy(F.xxhash64("doc_id", F.lit(6)), "doc_id").limit(most).withColumnRenamed("doc_id", "_id")
    # at most SAMPLE_DOCS ids: small by its definition
    rows = docs.select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("_id"))
    rows = rows.groupBy("doc_id", "_y").agg(F.min("text").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        for batch in batches:
            x = statistics([t or "" for t in batch.column(1).to_pylist()], table)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float32()))], names=["doc_id", "y", "x"])

    got = rows.select(F.col("doc_id").cast("bigint"), "text", "_y").mapInArrow(work, "doc_id bigint, y int, x array<float>").collect()
    got.sort(key=lambda r: (r["doc_id"], r["x"]))
    return fit_trees(np.array([r["x"] for r in got], np.float32).reshape(-1, FEATURES), np.array([r["y"] for r in got], float))


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, score, predicted) of each document of a table with doc_id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        for batch in batches:
            score = shared.value.score(statistics([t or "" for t in batch.column(1).to_pylist()], table))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, "doc_id bigint, score double, predicted int")


def accepted(docs: DataFrame, trees: Trees) -> DataFrame:
    """The documents whose score reaches the threshold, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        for batch in batches:
            yield batch.filter(pa.array(shared.value.score(statistics([t or "" for t in batch.column("text").to_pylist()], table)) >= THRESHOLD))

    return docs.mapInArrow(work, docs.schema)
