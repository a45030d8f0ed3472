"""Language identification by character language models with interpolated Kneser-Ney smoothing.

Symbols are lower-case code points: letters and marks stand for themselves, every run of other characters is one boundary. Per
language a model of four symbols is counted on a sample of labelled documents, whole texts, and built from the counts on the executors;
only finished models reach the driver. Each order of a model is a sorted array of sequence keys (exact up to three symbols, hashed at four) with
log probabilities, and one of contexts with back-off weights; below the single symbols lies an even distribution over all code
points.

All models together take at most MODEL_BYTES, however many languages there are: each has an equal share, and one with more distinct
sequences of four than fit it keeps those seen most often (ties by the symbols), before anything else is derived from them.

The language with the lowest cross-entropy per symbol wins. A text is rejected when that lies above what a fifth of the sample, kept
out of the counts, shows for the language, plus a margin that is wider for short texts.

The sample of a language are its documents with the smallest hashes of their ids, at most SAMPLE_DOCS rows, up to the one that
completes SAMPLE_CHARS characters; it is chosen by lengths and hashes, before any text is fetched. Null texts and texts without a letter are `und` with score 0, and rejected. Ties go to the first
language in order. Repeated rows get equal answers; an empty table gives none. Without any labelled document every text is `und`.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from unicodedata import category

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: Labelled rows per language that are learned from, and their characters.
SAMPLE_DOCS, SAMPLE_CHARS = 500, 4_000_000
ORDER = 4
#: Bytes of all models, and what a distinct sequence of four takes at most: 12 bytes in each of four orders of sequences and contexts.
MODEL_BYTES, GRAM_BYTES = 128 << 20, 96
#: Bits of a code point, and how many there are for the even distribution.
BITS, POINTS = np.uint64(21), 0x110000
#: Nats per symbol above the highest cross-entropy seen in the kept-out part; texts of n symbols get SLACK / sqrt(n) on top, as a few
#: odd letters weigh much in a short text.
MARGIN, SLACK = 1.0, 6.0
#: Weight of the evidence in the score: neighbouring symbols say much the same, so it grows with the root of their number.
WEIGHT = 6.0
#: Symbols counted or scored together: bounds what a worker holds besides its batch, a dozen arrays of 8 bytes for each of them.
BLOCK = 1 << 18
U = np.uint64
ONE, TWO, THREE = BITS, U(2) * BITS, U(3) * BITS
LOW, LOW2 = (U(1) << ONE) - U(1), (U(1) << TWO) - U(1)


def held_out() -> F.Column:
    """Whether a row is kept from all learning, by its doc_id; null for a null doc_id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def four(first: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """64-bit hashes of four symbols: the first, and the exact key of the other three."""
    x = rest * U(0x9E3779B97F4A7C15) + first * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xA0761D6478BD642F)
    return x ^ (x >> U(29))


@lru_cache
def letters() -> np.ndarray:
    """Per code point, whether it is a letter or a mark."""
    return np.fromiter((category(chr(c))[0] in "LM" for c in range(POINTS)), bool, POINTS)


def symbols(text: str) -> np.ndarray:
    """Lower-case letters and marks as code points, 0 for each run of anything else."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    s = np.where(letters()[points], points, 0)
    return s[np.append(True, (s[1:] != 0) | (s[:-1] != 0))] if len(s) else s


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each symbol the third one before it and the key of the other three, within its text; and the symbols of each text."""
    return keyed([symbols(t) for t in texts])


def keyed(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """windows() of texts that are symbols already."""
    sizes = np.array([len(p) for p in parts], np.int64)
    s = np.concatenate(parts).astype(U) if parts else np.zeros(0, U)
    nth = np.arange(len(s)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    back = []
    for k in (1, 2, 3):
        before = np.zeros(len(s), U)
        before[k:] = np.where(nth[k:] >= k, s[:-k], 0)
        back.append(before)
    return back[2], s | back[0] << ONE | back[1] << TWO, sizes


def blocks(texts: list[str], most: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What windows() gives for each symbol, and the number of its text, in order and at most so many symbols at a time. A longer text
    comes in parts, each with the three symbols before it."""
    lo = 0
    while lo < len(texts):
        hi, held = lo, 0
        while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= most):
            held += len(texts[hi])
            hi += 1
        parts = [symbols(t) for t in texts[lo:hi]]
        if hi > lo + 1:
            first, rest, n = keyed(parts)
            if len(rest):
                yield first, rest, np.repeat(np.arange(lo, hi), n)
        else:
            for a in range(0, len(parts[0]), most):
                back = min(a, 3)
                first, rest, _ = keyed([parts[0][a - back : a + most]])
                yield first[back:], rest[back:], np.full(len(rest) - back, lo)
        lo = hi


def found(keys: np.ndarray, values: np.ndarray, want: np.ndarray, other: np.ndarray | float) -> np.ndarray:
    """The values of the wanted keys in a sorted array, other where they are not there."""
    at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
    return np.where(keys[at] == want, values[at], other)


@dataclass
class Language:
    """Log probabilities by order of sequence, and log back-off weights by length of context, each with its sorted keys."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    backs: list[tuple[np.ndarray, np.ndarray]]
    unseen: float

    def log_p(self, first: np.ndarray, rest: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Log probability of the last symbol after the others; key is four(first, rest)."""
        before = rest >> ONE
        p = found(*self.grams[0], rest & LOW, self.unseen)
        p = found(*self.grams[1], rest & LOW2, found(*self.backs[0], before & LOW, 0) + p)
        p = found(*self.grams[2], rest, found(*self.backs[1], before, 0) + p)
        return found(*self.grams[3], key, found(*self.backs[2], before | first << TWO, 0) + p)


def language(first: np.ndarray, rest: np.ndarray, n: np.ndarray) -> Language:
    """The model of the distinct sequences of four symbols that were seen n times each."""

    def discount(counts: np.ndarray) -> float:
        one, two = int((counts == 1).sum()), int((counts == 2).sum())
        return one / (one + 2 * two) if one and two else 0.5

    # a lower order counts in how many distinct sequences of the order above a sequence stands
    three, c3 = np.unique(rest, return_counts=True)
    two, c2 = np.unique(three & LOW2, return_counts=True)
    one, c1 = np.unique(two & LOW, return_counts=True)
    d1, total = discount(c1), c1.sum()
    spare = d1 * len(c1) / total / POINTS
    p = (c1 - d1) / total + spare
    keys, grams, backs = one, [(one, np.log(p))], []
    for seen, counts, context, lower in ((two, c2, two >> ONE, two & LOW), (three, c3, three >> ONE, three & LOW2), (None, n, rest >> ONE | first << TWO, rest)):
        d = discount(counts)
        contexts, at, kinds = np.unique(context, return_inverse=True, return_counts=True)
        total = np.bincount(at, weights=counts)
        back = d * kinds / total
        p = (counts - d) / total[at] + back[at] * p[np.searchsorted(keys, lower)]
        keys = four(first, rest) if seen is None else seen
        by = np.argsort(keys)
        grams.append((keys[by], np.log(p[by])))
        backs.append((contexts, np.log(back)))
    small = lambda tables: [(k, v.astype(np.float32)) for k, v in tables]
    return Language(small(grams), small(backs), float(np.log(spare)))


@dataclass
class Model:
    names: list[str]
    languages: list[Language]
    limits: np.ndarray  # highest accepted cross-entropy per language

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per symbol (texts, languages), and symbols per text."""
        out, sizes = np.zeros((len(texts), len(self.names))), np.zeros(len(texts), np.int64)
        for first, rest, owner in blocks(texts):
            key, once, which = np.unique(four(first, rest), return_index=True, return_inverse=True)
            at = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            for k, each in enumerate(self.languages):
                got = each.log_p(first[once], rest[once], key)
                out[owner[at], k] -= np.add.reduceat(got[which], at, dtype=np.float64)
            sizes[owner[at]] += np.diff(np.append(at, len(owner)))
        return out / np.maximum(sizes, 1)[:, None], sizes


def sample(docs: DataFrame, most: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(text, lang, nth, many) of the labelled rows that are learned from: their number within the language, and how many it has."""
    key = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 30))
    ids = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "lang", key.alias("h"))
    # one row for each language, as in the model; a few times as many ids as are wanted go on to be ranked
    sizes = F.broadcast(ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    thin = ids.join(sizes, "lang").filter(F.col("h") <= F.lit(4.0 * most * (1 << 30)) / F.col("n"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    few = thin.withColumn("nth", first).filter(F.col("nth") <= most).select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct()
    # at most SAMPLE_DOCS ids for each language: small by its definition
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", text.alias("text"), F.xxhash64(text).alias("t")).join(F.broadcast(few), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))
    sizes = rows.groupBy("doc_id", "lang", "t").agg(F.max(F.char_length("text")).alias("size"), F.min(key).alias("h"), F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("n", F.lit(most)))))  # repeated rows count
    each = Window.partitionBy("lang").orderBy("h", "doc_id", "t", "copy")
    sizes = sizes.withColumns({"nth": F.row_number().over(each), "chars": F.sum("size").over(each.rowsBetween(Window.unboundedPreceding, -1))})
    sizes = sizes.filter((F.col("nth") <= most) & (F.coalesce("chars", F.lit(0)) < chars))
    chosen = sizes.select("doc_id", "lang", "t", "nth", F.count(F.lit(1)).over(Window.partitionBy("lang")).alias("many"))
    texts = rows.select("doc_id", "lang", "t", "text").join(F.broadcast(chosen.select("doc_id", "lang", "t").distinct()), ["doc_id", "lang", "t"], "left_semi")
    texts = texts.groupBy("doc_id", "lang", "t").agg(F.min("text").alias("text"))
    return texts.join(F.broadcast(chosen), ["doc_id", "lang", "t"]).select("text", "lang", "nth", "many")


GRAMS = "lang string, first bigint, rest bigint, n bigint"


def grams(rows: DataFrame) -> DataFrame:
    """GRAMS: how often each sequence of four symbols stands in the texts of each language."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                for first, rest, _ in blocks([t for t, x in zip(texts, langs) if x == lang]):
                    _, once, n = np.unique(four(first, rest), return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(once), pa.string()), pa.array(first[once].astype(np.int64)), pa.array(rest[once].astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "first", "rest", "n"])

    return rows.select("text", "lang").mapInArrow(work, GRAMS).groupBy("lang", "first", "rest").agg(F.sum("n").alias("n"))


def largest(counts: DataFrame, model_bytes: int = MODEL_BYTES) -> DataFrame:
    """GRAMS of the sequences that each language keeps: the most frequent ones that fit its share of model_bytes, one at least."""
    languages = F.broadcast(counts.agg(F.count_distinct("lang").alias("langs")))  # one row
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "first", "rest"))
    ranked = counts.withColumn("nth", nth).crossJoin(languages)
    return ranked.filter(F.col("nth") <= F.greatest(F.lit(1), F.floor(F.lit(model_bytes / GRAM_BYTES) / F.col("langs")))).drop("nth", "langs")


def build(counts: DataFrame) -> dict[str, Language]:
    """Each language's model, made from its counts (GRAMS) in a task of its own: at most SAMPLE_CHARS of them, and as many as fit the model."""

    def work(key: tuple[str], g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["first", "rest"])
        made = language(g["first"].to_numpy().astype(U), g["rest"].to_numpy().astype(U), g["n"].to_numpy())
        return pd.DataFrame({"lang": [key[0]], "model": [pickle.dumps(made)]})

    # MODEL_BYTES at most
    return {r["lang"]: pickle.loads(r["model"]) for r in counts.groupBy("lang").applyInPandas(work, "lang string, model binary").toLocalIterator()}


def fit(docs: DataFrame, most: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS, model_bytes: int = MODEL_BYTES) -> Model | None:
    """The models, from documents whose crc32(doc_id as text) mod 5 is not 0; None where none of their samples has a character."""
    rows = written(sample(docs, most, chars), "language-sample")
    by = build(written(largest(grams(rows.filter("nth % 5 <> 0 or many < 5")), model_bytes), "language-counts"))
    names = sorted(by)
    if not names:
        return None
    models = [by[name] for name in names]
    model = Model(names, models, np.full(len(names), np.inf))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {name: k for k, name in enumerate(shared.value.names)}
        for batch in batches:
            h, _ = shared.value.entropies(batch.column(0).to_pylist())
            own = [float(x[at[lang]]) if lang in at else 0.0 for x, lang in zip(h, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(own, pa.float64())], names=["lang", "h"])

    kept = rows.filter("nth % 5 = 0 or many < 5").select("text", "lang").mapInArrow(work, "lang string, h double")
    highest = dict(kept.groupBy("lang").agg(F.max("h")).collect())
    return Model(names, models, np.array([highest.get(name, np.inf) for name in names]) + MARGIN)


def judge(texts: list[str], m: Model | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, cross-entropy and acceptance of each text."""
    known = np.array([m is not None and any(map(str.isalpha, t)) for t in texts], bool)
    lang, score, entropy, accepted = np.full(len(texts), "und", object), np.zeros(len(texts)), np.full(len(texts), np.nan), np.zeros(len(texts), bool)
    if known.any():
        h, n = m.entropies([t for t, k in zip(texts, known) if k])
        best = h.argmin(1)
        low, root = h[np.arange(len(h)), best], np.sqrt(np.maximum(n, 1))
        lang[known] = np.array(m.names, object)[best]
        score[known] = 1 / np.exp((low[:, None] - h) * WEIGHT * root[:, None]).sum(1)
        entropy[known], accepted[known] = low, low <= m.limits[best] + SLACK / root
    return lang, score, entropy, accepted


PREDICTED = "doc_id bigint, lang_pred string, score double, entropy double, accepted boolean"


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """PREDICTED for each document of a table with doc_id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, entropy, accepted = judge([t or "" for t in batch.column(1).to_pylist()], shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(entropy, from_pandas=True), pa.array(accepted)], names=["doc_id", "lang_pred", "score", "entropy", "accepted"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, PREDICTED)


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents that are not rejected, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(judge([t or "" for t in batch.column("text").to_pylist()], shared.value)[3]))

    return docs.mapInArrow(work, docs.schema)
