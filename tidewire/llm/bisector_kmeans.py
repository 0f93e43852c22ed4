"""Centroid clustering by a tournament of bisectors.

Vectors become integers, so every step is exact.  For each pair of centroids ``i < j``
the plane half-way between them has the integer normal ``2 (c_j - c_i)`` and the
threshold ``|c_j|^2 - |c_i|^2``; which of the two is nearer to ``x`` is the sign of
``normal . x - threshold``.  With ``k`` centroids ``k - 1`` such tests leave one winner: the
centroid in the lead meets the next number, a positive sign hands the lead over, zero
leaves it with the smaller number.  Only the winner's squared distance is computed.

The vectors are written once as packed 32-bit integers; a round is one pass over them,
in which each task adds up its vectors per cluster.  The partial sums, one row per task and
cluster, meet in one aggregation; ``k`` sums reach the driver, which divides them
exactly.  Normals take ``k^2 / 2`` vectors of memory in a task, so ``k`` is meant to be
small (some hundreds).

Defined cases: a null vector, one with another number of components, or with a null, NaN
or infinite one, is left out.  A null ``vec_id`` stays and is drawn like the empty text.  Repeated rows
are vectors of their own; rows that tie in the draw of the first centroids are ordered by
their packed bytes.  Vectors at equal distance go to the smaller number.  With fewer
vectors than ``k`` there are as many centroids as vectors, so several may be equal (the smaller
number then gets all); an empty table gives an empty result.  Components beyond 2^27 in size
after scaling would overflow a 64-bit distance: they fail the job with a clear
message.  Columns besides the id and the vector are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.core import written

K, ROUNDS, DIMS, SCALE, DRAW = 8, 10, 64, 1024, "3:"
#: Largest size of a scaled component: 64 squared differences of twice that fit 63 bits.
LIMIT = 1 << 27


def integer_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE,
                    vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, draw, packed)`` of the vectors that count: the key by which first centroids
    are drawn, and ``dims`` little-endian 32-bit integers."""
    kept = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(
        (F.size("v") == dims) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))

    def run(batches):
        for b in batches:
            v = b.column(1)
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), dims)
            if len(x) and (np.abs(x) > LIMIT / scale).any():
                raise ValueError(f"a vector has a component beyond {LIMIT / scale:g}, too large for exact distances")
            rows = np.floor(x * scale).astype("<i4")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in rows], pa.binary())],
                                             names=["vec_id", "packed"])
    out = kept.mapInArrow(run, T.StructType([T.StructField("vec_id", kept.schema["vec_id"].dataType),
                                             T.StructField("packed", T.BinaryType())]))
    return out.withColumn("draw", F.sha2(F.concat(F.lit(DRAW), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256))


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals and thresholds of all pairs; entry ``[i, j]`` counts for ``i < j``."""
    norm = (centroids * centroids).sum(axis=1)
    return 2 * (centroids[None, :, :] - centroids[:, None, :]), norm[None, :] - norm[:, None]


def tournament(x: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row of ``x`` by ``k - 1`` sign tests."""
    lead = np.zeros(len(x), np.int64)
    for j in range(1, len(normals)):
        side = np.einsum("nd,nd->n", x, normals[lead, j]) - thresholds[lead, j]
        lead[side > 0] = j
    return lead


def _unpacked(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), dims).astype(np.int64)


def cluster_sums(packed: DataFrame, centroids: np.ndarray, dims: int = DIMS) -> dict[int, tuple[int, list[int]]]:
    """Number and componentwise sum of the vectors nearest to each centroid."""
    def run(batches):
        k = len(centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        planes = bisectors(centroids)
        for b in batches:
            x = _unpacked(b.column(0), dims)
            near = tournament(x, *planes)
            count += np.bincount(near, minlength=k)
            for c in range(k):
                total[c] += x[near == c].sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(count[used]),
             pa.array(total[used].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    parts = packed.select("packed").mapInArrow(run, "cluster int, n long, total array<long>")
    each = parts.select("cluster", "n", F.posexplode("total").alias("d", "s"))
    # 38 digits: sums of any number of vectors stay exact
    sums = each.groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = {}
    for r in sums.collect():  # k * dims rows
        out.setdefault(r["cluster"], (r["n"], [0] * dims))[1][r["d"]] = int(r["s"])
    return out


def nearest(packed: DataFrame, centroids: np.ndarray, dims: int = DIMS) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every vector."""
    def run(batches):
        planes = bisectors(centroids)
        for b in batches:
            x = _unpacked(b.column(1), dims)
            near = tournament(x, *planes)
            gap = x - centroids[near]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(near.astype(np.int32)), pa.array((gap * gap).sum(axis=1))],
                names=["vec_id", "cluster", "distance"])
    kind = packed.schema["vec_id"].dataType
    return packed.select("vec_id", "packed").mapInArrow(run, T.StructType([
        T.StructField("vec_id", kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]))


def _by_cluster(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values])[F.col("cluster")].cast(kind)


def centroid_clusters(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE,
                      vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of
    every vector that counts, after ``rounds`` rounds and a last assignment."""
    packed = written(integer_vectors(vectors, dims, scale, vec_id, vector), "integer-vectors")
    first = packed.orderBy("draw", "packed").limit(k).select("packed").collect()  # k rows
    centroids = np.array([np.frombuffer(r["packed"], "<i4") for r in first], dtype=np.int64).reshape(len(first), dims)
    for _ in range(rounds if len(first) else 0):
        for c, (n, total) in cluster_sums(packed, centroids, dims).items():
            centroids[c] = [s // n for s in total]
    out = written(nearest(packed, centroids, dims), "assigned")
    sums = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    inertia = [0] * max(1, len(centroids))
    for r in sums.collect():  # k rows
        inertia[r["cluster"]] = int(r["s"])
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()] or [""]
    return out.withColumns({"cluster_inertia": _by_cluster(inertia, "long"), "inertia": F.lit(sum(inertia)).cast("long"),
                            "centroid_sha256": _by_cluster(digest, "string")})
