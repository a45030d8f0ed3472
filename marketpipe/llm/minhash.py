"""MinHash near-dedup: many universal hash minima, banding, signature verification, full-set confirmation, connected components.

One pass gives each document its number of shingles, a digest of its shingle set and HASHES minima. Documents with equal sets are
one node. Nodes that agree in all minima of a band meet in a bucket, where each is compared with the bucket's smallest node:
first by size and signature, then on the full sets. Verified links grow into components by alternating large-star and small-star.
Buckets whose members are not all in one component by then are finished exactly: blocks of members are compared with each other on
all shingles that any two components share, and each block gives just the links that join its components. No bucket is capped or sampled.

The texts of the nodes that share a bucket are fetched once; a broadcast bit table of bounded size keeps most other texts out of that
shuffle. A star with many members is dealt out in blocks of BLOCK members, each with its own copy of the centre, so neither a large
group of near copies nor its centre meets in one task.

Linked are sets with 100 * intersection >= percent * union. The bands follow from percent, so that a pair at the threshold is
missed with a chance below 1e-6 (24 bands of 5 minima at 85, 30 of 4 at 80); the signature test lets a pair at the threshold pass
unless it is five standard deviations off.

Words are [^ \\t-\\r]+ after lower-casing A-Z; a shingle is five words, or all words of a shorter text. Null, empty and blank texts
have no shingles and link with nothing. Repeated rows are equal sets; a doc_id with several texts is one document that has the links
of each. Links go by ids: a document without one is a row with its shingles, in the component of the documents with an equal set, if any
has an id, else in none; it is not kept. An empty table gives none. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shared import bit_table, dropped, thinned, written

SHINGLE = 5
HASHES = 120
#: The threshold where none is given.
PERCENT = 85
#: Chance with which no band shows a pair at the threshold, at most.
MISS = 1e-6
#: Members of one block of a star that is confirmed.
BLOCK = 64
#: Members of one block of a mixed bucket that is finished, and their shingles, about.
MIXED, MIXED_SHINGLES = 512, 1 << 20
#: How often nodes that cannot have a link across components are left out; any number gives the same links.
ROUNDS = 3
#: Bytes of text that are hashed together. A word of PIECE - 1 bytes or more has a digest of its own as its hash, wherever it stands.
PIECE = 1 << 20


def rows_of(percent: int) -> int:
    """Minima of one band: the most that divide HASHES and miss a pair at the threshold with a chance below MISS."""
    fits = [r for r in range(1, HASHES + 1) if HASHES % r == 0 and (1 - (percent / 100) ** r) ** (HASHES // r) < MISS]
    if not 0 < percent <= 100 or not fits:
        raise ValueError(f"{HASHES} minima cannot find pairs at {percent} percent")
    return max(fits)


def agree_of(percent: int) -> int:
    """Equal minima that a candidate has at least: the expected ones at the threshold less five standard deviations."""
    share = percent / 100
    return max(0, math.floor(HASHES * share - 5 * math.sqrt(HASHES * share * (1 - share))))


U = np.uint64
BASE, WORD_END, STEP = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """An invertible mixing of 64 bits (xor-shifts and odd multipliers)."""
    x = (x ^ (x >> U(32))) * WORD_END
    x = (x ^ (x >> U(29))) * BASE
    return x ^ (x >> U(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n."""
    back = U(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n, BASE, U), np.full(n, back, U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


UP, DOWN = powers(PIECE)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of data, and where each begins. Long data is taken in pieces that end at white space."""
    raw = np.frombuffer(data, np.uint8)
    hashes, begins, lo = [], [], 0
    while lo < len(raw):
        hi = min(lo + PIECE - 1, len(raw))
        if hi - lo == PIECE - 1:
            cut = np.flatnonzero(SPACE[raw[lo:hi]])
            if not len(cut):
                more = np.flatnonzero(SPACE[raw[hi:]])
                end = hi + int(more[0]) if len(more) else len(raw)
                hashes.append(np.array([int.from_bytes(hashlib.blake2b(LOWER[raw[lo:end]].tobytes(), digest_size=8).digest(), "little")], U))
                begins.append(np.array([lo]))
                lo = end
                continue
            if hi < len(raw):
                hi = lo + int(cut[-1]) + 1
        part = LOWER[raw[lo:hi]]
        space = SPACE[part]
        edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.concatenate(([U(0)], np.cumsum((part.astype(U) + U(1)) * UP[: len(part)])))
        h = (sums[end] - sums[start]) * DOWN[start]
        hashes.append(mix(h + (end - start).astype(U) * STEP))
        begins.append(start + lo)
        lo = hi
    if not hashes:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(begins)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = [(t or "").encode() for t in texts]
    out: list[np.ndarray] = []
    lo = 0
    while lo < len(data):
        hi, held = lo, 0
        while hi < len(data) and (hi == lo or held + len(data[hi]) < PIECE - 1):
            held += len(data[hi]) + 1
            hi += 1
        sizes = np.array([len(d) + 1 for d in data[lo:hi]])
        words, begins = word_hashes(b"\n".join(data[lo:hi]))
        ends = np.searchsorted(begins, np.cumsum(sizes))
        runs = words.copy()
        for k in range(1, SHINGLE):
            runs = runs[:-1] * STEP + words[k:] if len(runs) else runs
        runs = mix(runs)
        first = 0
        for end in ends.tolist():
            n = end - first
            if n >= SHINGLE:
                out.append(np.unique(runs[first : end - SHINGLE + 1]))
            elif n:
                h = np.array([n], U)
                for w in range(first, end):
                    h = h * STEP + words[w : w + 1]
                out.append(mix(h ^ BASE))
            else:
                out.append(np.zeros(0, U))
            first = end
        lo = hi
    return out


def family() -> tuple[np.ndarray, np.ndarray]:
    """HASHES multiply-add functions of the universal family (a * x + b mod 2^64) >> 32 on 32-bit x."""
    rng = np.random.default_rng(20240501)
    return rng.integers(0, 1 << 64, HASHES, U) | U(1), rng.integers(0, 1 << 64, HASHES, U)


A, B = family()


def minima(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> U(32))[None, :]
    low = np.full(HASHES, ~U(0))
    for at in range(0, x.shape[1], 1024):
        v = A[:, None] * x[:, at : at + 1024]
        v += B[:, None]
        np.minimum(low, v.min(1), out=low)
    return (low >> U(32)).astype(np.uint32)


def bands(signature: str, width: int) -> F.Column:
    """An array of one hash for each band of width minima; the bands differ in their seeds."""
    return F.array(*(F.xxhash64(F.lit(k), F.slice(signature, 1 + k * width, width)) for k in range(HASHES // width)))


SKETCH = "doc_id bigint, n_shingles bigint, digest binary, signature array<int>"


def sketch(docs: DataFrame) -> DataFrame:
    """SKETCH of each document; digest and signature are null for sets without a shingle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist())
            full = np.array([len(s) > 0 for s in sets], bool)
            low = np.stack([minima(s) for s in sets if len(s)]) if full.any() else np.zeros((0, HASHES), np.uint32)
            offsets = np.append(0, np.cumsum(np.where(full, HASHES, 0))).astype(np.int32)
            signature = pa.ListArray.from_arrays(pa.array(offsets), pa.array(low.view(np.int32).ravel()), mask=pa.array(~full))
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), signature], names=["doc_id", "n_shingles", "digest", "signature"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, SKETCH)


def similar(left: str, right: str, percent: int) -> F.Column:
    """Whether the full shingle sets of two texts are linked."""

    @F.pandas_udf(T.BooleanType())
    def check(left: pd.Series, right: pd.Series) -> pd.Series:
        names = list(dict.fromkeys([*left, *right]))
        sets = dict(zip(names, shingle_sets(names)))

        def linked(a: np.ndarray, b: np.ndarray) -> bool:
            both = len(np.intersect1d(a, b, assume_unique=True))
            return 100 * both >= percent * (len(a) + len(b) - both)

        return pd.Series([linked(sets[a], sets[b]) for a, b in zip(left, right)], dtype=bool)

    return check(left, right)


def near_sizes(a: str, b: str, percent: int) -> F.Column:
    """Whether two set sizes allow a link at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def in_blocks(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) with i: a star of more than BLOCK members b is dealt out in blocks of about BLOCK."""
    stars = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).filter("blocks > 1")
    # written, so that the join has plain shuffles on both sides and a large star's rows are split over tasks
    dealt = pairs.join(written(stars, "stars"), "a", "left")
    return dealt.select("a", "b", F.coalesce(F.pmod(F.xxhash64("b"), "blocks"), F.lit(0)).alias("i"))


def by_block(dealt: DataFrame, values: DataFrame, *names: str) -> DataFrame:
    """(a, b, i) with the named values (id, ...) of both ends, as name_a and name_b. A centre's values are sent once to each block."""
    left = dealt.select("a", "i").distinct().join(values.select(F.col("id").alias("a"), *(F.col(n).alias(f"{n}_a") for n in names)), "a")
    right = dealt.join(values.select(F.col("id").alias("b"), *(F.col(n).alias(f"{n}_b") for n in names)), "b")
    return right.join(left, ["a", "i"])


def alike(dealt: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, i) whose sizes and signatures allow a link."""
    agree = F.aggregate(F.zip_with("signature_a", "signature_b", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    rows = by_block(dealt, nodes, "n", "signature")
    return rows.filter(near_sizes("n_a", "n_b", percent)).filter(agree >= agree_of(percent)).select("a", "b", "i").distinct()


def confirmed(dealt: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of (a, b, i) whose full sets are linked; texts: (id, text)."""
    rows = by_block(dealt, texts, "text")
    return written(rows.filter(similar("text_a", "text_b", percent)).select("a", "b").distinct(), "links")


def shared_buckets(nodes: DataFrame, percent: int) -> DataFrame:
    """(band, h, id, a): the nodes of each bucket with more than one, and the smallest of them."""
    each = nodes.select("id", F.posexplode(bands("signature", rows_of(percent))).alias("band", "h"))
    lows = each.groupBy("band", "h").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a < z").drop("z")
    lows = written(lows, "bucket-centres")
    buckets = written(each.join(lows, ["band", "h"]), "buckets")
    dropped(lows)
    return buckets


def shingle_rows(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, c, n, t, s): the distinct shingles of each text of the given nodes (id, c), their number and a hash of them all."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(2).to_pylist())
            offsets = np.append(0, np.cumsum([len(x) for x in sets])).astype(np.int32)
            values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            sizes = pa.array([len(x) for x in sets], pa.int64())
            own = pa.array([int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, own, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["id", "c", "n", "t", "s"])

    rows = texts.join(ids, "id").select("id", "c", "text")
    return rows.mapInArrow(work, "id bigint, c bigint, n bigint, t bigint, s array<bigint>").select("id", "c", "n", "t", F.explode("s").alias("s"))


def joining(ok: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Of the linked (row, column) pairs of ok those that join components not yet joined; left, right: component of each row and column."""
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while (up := root.get(c, c)) != c:
            root[c] = c = root.get(up, up)
        return c

    out = []
    for i, j in zip(*np.nonzero(ok)):
        one, two = find(int(left[i])), find(int(right[j]))
        if one != two:
            root[max(one, two)] = min(one, two)
            out.append((i, j))
    return out


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 16384) -> np.ndarray:
    """(left, right) sizes of the intersections of sets of numbers; width columns of the sets' matrices at a time."""
    flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right)]
    both = np.intersect1d(flat[0], flat[1])
    cells = []
    for x, values in zip((left, right), flat):
        row = np.repeat(np.arange(len(x)), [len(v) for v in x])
        at = np.minimum(np.searchsorted(both, values), max(len(both) - 1, 0))
        there = both[at] == values if len(both) else np.zeros(len(values), bool)
        by = np.argsort(at[there], kind="stable")
        cells.append((at[there][by], row[there][by]))
    out = np.zeros((len(left), len(right)), np.int64)
    for lo in range(0, len(both), width):
        parts = []
        for x, (at, row) in zip((left, right), cells):
            a, b = np.searchsorted(at, (lo, lo + width))
            m = np.zeros((len(x), width), np.float32)
            m[row[a:b], at[a:b] - lo] = 1
            parts.append(m)
        out += (parts[0] @ parts[1].T).astype(np.int64)  # sums of at most width ones are exact
    return out


def mixed_links(buckets: DataFrame, nodes: DataFrame, labels: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between members of a bucket that lie in different components, enough to join these; pairs with the bucket's
    smallest node are done already.

    A link across components can only rest on shingles that more than one component has; their number bounds a node's
    intersections, which leaves out nodes that differ from all others by shingles of their own, however many share a bucket.
    Blocks of the remaining members outside the smallest node's component then meet all blocks, with those shingles of theirs: they
    and the sizes of the full sets give each pair's exact similarity.
    """
    named = written(buckets.join(labels, "id", "left").withColumn("c", F.coalesce("label", "id")).drop("label"), "named-buckets")
    low_c = F.max(F.when(F.col("id") == F.col("a"), F.col("c"))).alias("low_c")
    stats = named.groupBy("band", "h").agg(low_c, F.min("c").alias("c1"), F.max("c").alias("c2")).filter("c1 <> c2").drop("c1", "c2")
    stats = written(stats, "mixed-centres")
    members = named.join(stats, ["band", "h"]).filter("id <> a").withColumn("out", F.col("c") != F.col("low_c"))
    members = written(members.drop("low_c", "a"), "mixed-buckets")
    dropped(named), dropped(stats)
    sizes = nodes.groupBy("id").agg(F.min("n").alias("least"))  # of an id with several texts the smallest, as a bound
    shingles = written(shingle_rows(members.select("id", "c").distinct(), texts), "mixed-shingles")
    for _ in range(ROUNDS):
        # written, so that the join has plain shuffles on both sides and a shingle that very many members have is split over tasks
        shared = written(shingles.groupBy("s").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).filter("c1 <> c2").select("s"), "shared-shingles")
        kept = shingles.join(shared, "s", "left_semi")
        able = kept.groupBy("id").agg(F.count(F.lit(1)).alias("x")).join(sizes, "id").filter(F.col("x") * 100 >= F.col("least") * percent)
        fewer = written(kept.join(able.select("id"), "id", "left_semi"), "mixed-shingles")
        dropped(shingles), dropped(shared)
        shingles = fewer
    sets = shingles.groupBy("id", "n", "t").agg(F.collect_list("s").alias("s"))
    members = written(members.drop("c").join(sets, "id").join(shingles.select("id", "c").distinct(), "id"), "mixed-members", **{"parquet.enable.dictionary": "false"})
    dropped(shingles)
    blocks_of = lambda rows: F.ceil(F.greatest(F.count(F.when(rows, 1)) / MIXED, F.coalesce(F.sum(F.when(rows, F.size("s"))), F.lit(0)) / MIXED_SHINGLES)).cast("int")
    counts = members.groupBy("band", "h").agg(blocks_of(F.col("out")).alias("outs"), blocks_of(F.lit(True)).alias("alls"))
    sized = members.join(written(counts.filter("outs > 0"), "mixed-counts"), ["band", "h"])
    spread, fields = F.xxhash64("id", "band"), ("out", "id", "c", "n", "s")
    left = sized.filter("out").select("band", "h", F.pmod(spread, "outs").alias("i"), F.explode(F.expr("sequence(0L, alls - 1L)")).alias("j"), F.lit(True).alias("left"), *fields)
    right = sized.select("band", "h", F.explode(F.expr("sequence(0L, outs - 1L)")).alias("i"), F.pmod(spread, "alls").alias("j"), F.lit(False).alias("left"), *fields)
    # dealt anew by block: the join's partitioning by bucket would leave all blocks of a hot bucket in one task
    blocks = left.unionByName(right).repartition("band", "h", "i", "j").groupBy("band", "h", "i", "j").agg(F.collect_list(F.struct("left", *fields)).alias("rows"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            flat = column.flatten()
            bounds = np.asarray(column.offsets) - column.offsets[0].as_py()
            is_left, out, ids, c, n = (np.asarray(flat.field(k).to_numpy(zero_copy_only=False)) for k in range(5))
            held = flat.field(5)
            values = held.flatten().to_numpy(zero_copy_only=False)
            ends = np.asarray(held.offsets) - held.offsets[0].as_py()
            found = []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                p, q = lo + np.flatnonzero(is_left[lo:hi]), lo + np.flatnonzero(~is_left[lo:hi])
                # both outside: once, from the larger id
                ok = (c[p][:, None] != c[q]) & (~out[q] | (ids[p][:, None] > ids[q]))
                ok &= 100 * np.minimum(n[p][:, None], n[q]) >= percent * np.maximum(n[p][:, None], n[q])
                if not ok.any():
                    continue
                p, q, ok = p[ok.any(1)], q[ok.any(0)], ok[ok.any(1)][:, ok.any(0)]
                both = shared_counts([values[ends[k] : ends[k + 1]] for k in p], [values[ends[k] : ends[k + 1]] for k in q])
                ok &= 100 * both >= percent * (n[p][:, None] + n[q] - both)
                found += [(min(ids[p[i]], ids[q[j]]), max(ids[p[i]], ids[q[j]])) for i, j in joining(ok, c[p], c[q])]
            pairs = np.array(sorted(set(found)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return blocks.select("rows").mapInArrow(work, "a bigint, b bigint").distinct()


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: every document's component by its smallest doc_id, linked at percent or more."""
    plain = {"parquet.enable.dictionary": "false"}
    sketches = written(sketch(docs), "sketches", **plain)
    keys = written(sketches.select("doc_id", "n_shingles", "digest"), "keys")
    ids = written(keys.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("id")), "nodes")
    nodes = sketches.withColumnRenamed("doc_id", "id").join(ids, ["id", "digest"], "left_semi").dropDuplicates(["id", "digest"])
    nodes = written(nodes.select("id", F.col("n_shingles").alias("n"), "signature"), "node-signatures", **plain)
    dropped(sketches)

    buckets = shared_buckets(nodes, percent)
    needed = buckets.select("id").distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = written(thinned(texts, bit_table(needed, "id"), "id").join(needed, "id").dropDuplicates(["id", "text"]), "bucket-texts")

    pairs = in_blocks(buckets.filter("id <> a").select("a", F.col("id").alias("b")).distinct())
    links = confirmed(written(alike(pairs, nodes, percent), "centre-pairs"), texts, percent)
    labels = components(links)
    more = written(mixed_links(buckets, nodes, labels, texts, percent), "mixed-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    for table in (nodes, buckets, texts):
        dropped(table)
    named = ids.join(labels, "id", "left").select("digest", F.coalesce("label", "id").alias("label"))
    component = F.coalesce("label", "doc_id")
    rows = keys.join(named, "digest", "left")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
