"""Clustering of vectors around centroids, in integers, with an n-simplex projection as filter.

Components become floor(SCALE * x). A vector's distances to several pivots (the first centroids, and those after each of the first
REFRESH rounds) are taken once and turned into apex coordinates: those of the point that has these distances to the pivots' simplex,
the last one its altitude above it. Both are kept in a written table. A round projects its centroids likewise. The Euclidean distance
of two apexes bounds the distance of their vectors from below; with one altitude mirrored it bounds it from above. Centroids whose lower
bound exceeds another one's upper bound are out; the rest are compared by exact squared distances in 64-bit integers, ties to the
smaller number. A round's sums are added up within tasks, so that only centroids times components numbers reach the driver, whatever
the input, and the centroids' state lives there: a lost executor costs its tasks only.

Kept are vectors with exactly `components` components, none null or non-finite, and none of 131072 or more in size, beyond which squared
distances leave 64 bits. Fewer vectors than centroids make fewer centroids; none make no rows. Repeated rows count each. Vectors
without an id are clustered, and come last in the choice of the first centroids; of equal ids the smaller vector comes first. Sums that
leave 64 bits (inertia) are null. Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dropped, written

SCALE, COMPONENTS, CLUSTERS, ROUNDS, SEED = 1024, 64, 8, 10, "3"
#: Integer components stay below this in size.
LARGEST = 1 << 27
#: The first centroids are the first pivots; after each of the first REFRESH rounds its centroids join them, as later ones lie close by.
REFRESH = 2
#: The least altitude of a pivot over the simplex of those before it, as a share of its distance.
FLAT = 1e-2
#: Relative room for rounding in the bounds.
ROOM = 1e-5


def quantised(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, v) of the kept vectors, v array<bigint>."""
    x = F.col("embedding").cast("array<double>")
    sound = (F.size("embedding") == components) & F.forall(x, lambda e: F.coalesce((e > -LARGEST / SCALE) & (e < LARGEST / SCALE), F.lit(False)))
    return embeddings.filter(sound).select("vec_id", F.transform(x, lambda e: F.floor(e * SCALE)).alias("v"))


def first_vectors(rows: DataFrame, n: int, seed: str = SEED) -> np.ndarray:
    """The n vectors with the smallest digests of seed and id; n is the number of centroids."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    got = rows.select("v", h.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(n).collect()
    return np.array([r["v"] for r in got], np.int64)


class Simplex:
    """The pivots' simplex, and apex coordinates from distances to the pivots. A pivot that lies nearly within the flat of those before it
    is left out, so the coordinates are well conditioned."""

    def __init__(self, candidates: np.ndarray, before: Simplex | None = None):
        """The pivots of the simplex before, and those of the candidates that add to it."""
        self.known = before.pivots if before else candidates[:1]
        chosen, base = list(self.known), before.base if before else np.zeros((0, candidates.shape[1]))
        for c in candidates:
            arm = (c - chosen[0]).astype(float)
            rest = arm - base.T @ (base @ arm)
            if np.linalg.norm(rest) > FLAT * max(np.linalg.norm(arm), 1):
                base = np.vstack([base, rest / np.linalg.norm(rest)])
                chosen.append(c)
        self.base, self.pivots = base, np.array(chosen, np.int64)
        self.corners = (self.pivots[1:] - self.pivots[0]) @ base.T  # lower triangular
        self.sides = np.square(self.corners).sum(1)

    def apexes(self, vectors: np.ndarray, cached: np.ndarray | None = None) -> np.ndarray:
        """(vectors, pivots) coordinates, the altitude last. cached: those for the pivots of the simplex before; only the distances to the
        pivots that came since are taken then."""
        old = len(self.known) - 1 if cached is not None else 0
        first = np.square(cached).sum(1) if cached is not None else np.square(vectors - self.pivots[0]).sum(1).astype(float)
        flat = cached[:, :old] if cached is not None else np.zeros((len(vectors), 0))
        if len(self.sides) > old:
            d = np.stack([np.square(vectors - p).sum(1) for p in self.pivots[old + 1 :]], 1).astype(float)
            right = (first[:, None] + self.sides[old:] - d) / 2 - flat @ self.corners[old:, :old].T
            flat = np.column_stack([flat, np.linalg.solve(self.corners[old:, old:], right.T).T])
        return np.column_stack([flat, np.sqrt(np.maximum(first - np.square(flat).sum(1), 0))])


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The number of each vector's nearest centroid, its squared distance, and how many exact distances were taken."""
    below = np.square(apexes).sum(1)[:, None] + np.square(tops).sum(1) - 2 * apexes @ tops.T
    above = below + 4 * apexes[:, -1:] * tops[:, -1]
    room = ROOM * (1 + np.square(apexes).sum(1)[:, None] + np.square(tops).sum(1))
    open_ = below - room <= (above + room).min(1)[:, None]
    d = np.full(open_.shape, np.iinfo(np.int64).max)
    for k, c in enumerate(centroids):
        at = np.flatnonzero(open_[:, k])
        d[at, k] = np.square(vectors[at] - c).sum(1)
    best = d.argmin(1)
    return best, d[np.arange(len(d)), best], int(open_.sum())


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def projected(rows: DataFrame, simplex: Simplex) -> DataFrame:
    """(vec_id, v, apex) of rows that have no apex yet, or one for the simplex before; written."""
    shared = rows.sparkSession.sparkContext.broadcast(simplex)  # (1 + REFRESH) pivots for each centroid at most

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cached = _matrix(batch.column(2), float) if batch.num_columns == 3 else None
                apexes = shared.value.apexes(_matrix(batch.column(1), np.int64), cached)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(list(apexes), pa.list_(pa.float64()))], names=["vec_id", "v", "apex"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return written(rows.mapInArrow(work, f"vec_id {kind}, v array<bigint>, apex array<double>"), "apexes")


def totals(table: DataFrame, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many vectors each centroid is nearest to, and their sums per component (Python integers). Tasks add up their own."""
    shared = table.sparkSession.sparkContext.broadcast((centroids, tops))  # a vector for each centroid
    many, wide = centroids.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((many, wide + 1), object)
        for batch in batches:
            if len(batch):
                v = _matrix(batch.column(0), np.int64)
                best, _, _ = nearest(v, _matrix(batch.column(1), float), *shared.value)
                for k in np.unique(best):
                    sums[k] += [*map(int, v[best == k].sum(0)), int((best == k).sum())]
        at = [(k, j, str(x)) for k, row in enumerate(sums) for j, x in enumerate(row) if x]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*at)) or [[]] * 3, (pa.int32(), pa.int32(), pa.string()))], names=["k", "j", "part"])

    parts = table.select("v", "apex").mapInArrow(work, "k int, j int, part string")
    out = np.zeros((many, wide + 1), object)
    for row in parts.groupBy("k", "j").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():
        out[row["k"], row["j"]] = int(row["total"])
    return out[:, -1], out[:, :-1]


ASSIGNED = "cluster int, distance bigint, compared int"


def assigned(table: DataFrame, centroids: np.ndarray, tops: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, compared) of each vector; compared: exact distances per vector of its batch, rounded up."""
    shared = table.sparkSession.sparkContext.broadcast((centroids, tops))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                best, d, n = nearest(_matrix(batch.column(1), np.int64), _matrix(batch.column(2), float), *shared.value)
                mean = np.full(len(batch), -(-n // len(batch)), np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32)), pa.array(d), pa.array(mean)], names=["vec_id", "cluster", "distance", "compared"])

    return table.select("vec_id", "v", "apex").mapInArrow(work, f"vec_id {table.schema['vec_id'].dataType.simpleString()}, {ASSIGNED}")


def cluster(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS, seed: str = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, compared) of each kept vector."""
    spark, rows = embeddings.sparkSession, quantised(embeddings, components)
    centroids = first_vectors(rows, clusters, seed)
    if not len(centroids):
        return rows.selectExpr("vec_id", "0 as cluster", "0L as distance", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256", "0 as compared").limit(0)
    simplex = Simplex(centroids)
    table = projected(rows, simplex)
    for k in range(rounds):
        n, sums = totals(table, centroids, simplex.apexes(centroids))
        centroids = np.array([[x // many for x in row] if many else old for many, row, old in zip(n, sums, centroids.tolist())], np.int64)
        if k < REFRESH:
            simplex, older = Simplex(centroids, simplex), table
            table = projected(older, simplex)
            dropped(older)
    out = written(assigned(table, centroids, simplex.apexes(centroids)), "clusters")
    # one row for each centroid
    parts = {r["cluster"]: int(r["total"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digests = [(k, str(parts[k]), str(sum(parts.values())), sha256(",".join(map(str, centroids[k].tolist())).encode()).hexdigest()) for k in sorted(parts)]
    known = spark.createDataFrame(digests, "cluster int, own string, whole string, centroid_sha256 string")
    known = known.selectExpr("cluster", "try_cast(own as bigint) as cluster_inertia", "try_cast(whole as bigint) as inertia", "centroid_sha256")
    return out.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared")
