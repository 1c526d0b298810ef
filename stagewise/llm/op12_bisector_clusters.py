"""Centroid clustering by a tournament of bisectors.

Between two centroids a < b lies the hyperplane of points equally far from both: with
the integer normal 2(b - a) and threshold |b|^2 - |a|^2, a vector v is nearer to b exactly
if normal . v > threshold. The centroids of a round are played off against each other:
the winner so far meets the next number, k - 1 sign tests in all, and a zero favours the
smaller number. Only the distance to the winner is computed at the end. All of it is
integer arithmetic, so results do not depend on how the table is dealt.

A round is one pass that sends k * (dims + 1) sums from each task. The driver holds the
centroids, k * dims integers, and nothing else.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.base import saved, small_batches
from stagewise.llm.integers import SUMS, as_array, digit_rows, finite_rows, long_or_null, matched, scaled, total_sums

#: Centroids, rounds, components of a vector, integer steps of one, text before an id that is hashed.
CLUSTERS, ROUNDS, DIMS, SCALE, SALT = 40, 5, 64, 256, "2"


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals and thresholds of all centroid pairs."""
    squares = (centroids * centroids).sum(1)
    return 2 * (centroids[None] - centroids[:, None]), squares[None] - squares[:, None]


def tournament(vectors: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """The nearest centroid of each vector, the smallest number among equally near ones."""
    winner = np.zeros(len(vectors), np.int64)
    for number in range(1, len(normals)):
        normal = normals[winner, number]
        side = (vectors * normal).sum(1) if vectors.dtype == object else np.einsum("ij,ij->i", vectors, normal)
        winner[np.asarray(side > thresholds[winner, number], bool)] = number
    return winner


def _usable(batch: pa.RecordBatch, dims: int) -> pa.RecordBatch:
    lengths = pc.fill_null(pc.list_value_length(batch.column("v")), -1).to_numpy(zero_copy_only=False)
    batch = batch.filter(pa.array(lengths == dims))
    return batch.filter(pa.array(finite_rows(batch.column("v"))))


def _first_centroids(rows: DataFrame, k: int, dims: int, scale: int, salt: str) -> list[list[int]]:
    def least(batches):
        for batch in batches:
            batch = _usable(batch, dims)
            # No hexadecimal digest is greater than "g".
            hashes = ["g" if i is None else hashlib.sha256(f"{salt}:{i}".encode()).hexdigest() for i in batch.column("id").to_pylist()]
            batch = pa.RecordBatch.from_arrays([pa.array(hashes, pa.string()), batch.column("v")], names=["hash", "v"])
            # Ties at the cut stay: Spark orders them by their vectors.
            last = sorted(hashes)[min(k, len(hashes)) - 1] if hashes else ""
            yield batch.filter(pa.array([h <= last for h in hashes], pa.bool_()))
    found = rows.mapInArrow(least, "hash string, v array<double>").orderBy("hash", "v").limit(k).toArrow()
    column = found.column("v").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return [[int(x) for x in row] for row in scaled(column, dims, scale)] if len(column) else []


def _assigned(rows: DataFrame, centroids: list[list[int]], dims: int, scale: int, out, schema: str) -> DataFrame:
    """``out(ids, vectors, winners, centroids)`` gives the record batches of each batch; called
    without arguments it gives those after the last."""
    def run(batches):
        points = as_array(centroids, dims)
        normals, thresholds = bisectors(points)
        give = out()
        for batch in batches:
            batch = _usable(batch, dims)
            if batch.num_rows:
                vectors, planes, cuts, at = matched(scaled(batch.column("v"), dims, scale), normals, thresholds, points)
                yield from give(batch.column("id"), vectors, tournament(vectors, planes, cuts), at)
        yield from give()
    return rows.mapInArrow(run, schema)


def _moved(rows: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> list[list[int]]:
    """The centroids after one round."""
    k = len(centroids)

    def start():
        sums = np.zeros((k, dims + 1), object)

        def give(ids=None, vectors=None, winners=None, points=None):
            if ids is None:
                return digit_rows({i: int(x) for i, x in enumerate(sums.ravel()) if x})
            for c in np.unique(winners).tolist():
                own = vectors[winners == c]
                sums[c, :dims] += own.sum(0)
                sums[c, dims] += len(own)
            return ()
        return give
    total = total_sums(_assigned(rows, centroids, dims, scale, start, SUMS))
    out = []
    for c, old in enumerate(centroids):
        n = total.get(c * (dims + 1) + dims, 0)
        out.append([total.get(c * (dims + 1) + i, 0) // n for i in range(dims)] if n else old)
    return out


def bisector_clusters(vectors: DataFrame, vector: str = "embedding", number: str = "vec_id", k: int = CLUSTERS, rounds: int = ROUNDS,
                      dims: int = DIMS, scale: int = SCALE, salt: str = SALT) -> DataFrame:
    """Integer k-means: the id column, cluster, distance, cluster_inertia, inertia and centroid_sha256.

    Vectors of ``dims`` finite components take part, as ``floor(scale * x)``; null vectors,
    others, and those with null or non-finite components have no row. The first centroids are
    the k vectors whose ``sha256(salt:id)`` is least; equal ids are ordered by their vectors,
    null ids come last. With fewer than k vectors there are fewer centroids. Means are rounded
    down, centroids without vectors stay. Repeated and null ids are kept. Sums beyond a long
    are null. Other columns are ignored. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col(number).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    centroids = _first_centroids(rows, k, dims, scale, salt)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(rows, centroids, dims, scale)

    def start():
        def give(ids=None, found=None, winners=None, points=None):
            if ids is None:
                return ()
            apart = found - points[winners]
            return [pa.RecordBatch.from_arrays([ids, pa.array(winners.astype(np.int32)), long_or_null((apart * apart).sum(1))], names=["id", "cluster", "distance"])]
        return give
    id_type = dict(rows.dtypes)["id"]
    schema = f"id {id_type}, cluster int, distance long"
    if not centroids:
        return spark.createDataFrame([], schema + ", cluster_inertia long, inertia long, centroid_sha256 string").withColumnRenamed("id", number)
    done = saved(_assigned(rows, centroids, dims, scale, start, schema), "clusters")
    # A row for each centroid.
    sums = done.groupBy("cluster").agg(F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("s")).collect()
    of = {row.cluster: row.s for row in sums}
    fits = lambda x: None if x is None or x >= 2**63 else int(x)
    whole = None if None in of.values() else fits(sum(of.values()))
    about = [(c, fits(of[c]), whole, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c in sorted(of)]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(about), "cluster").select(F.col("id").alias(number), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_bisector_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return bisector_clusters(spark.read.parquet(f"{folder}/embeddings.parquet"))


def _sql() -> str:
    """Lloyd's rounds with all distances, one pair of steps a round."""
    text = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, e) - 1 AS c, e FROM (SELECT sha256('{SALT}:' || vec_id) AS h, e FROM v ORDER BY h, e LIMIT {CLUSTERS})),"""
    for i in range(ROUNDS + 1):
        text += f"""
a{i} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT r, c,
  list_sum(list_transform(list_zip(v.e, c{i}.e), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d FROM v, c{i}) GROUP BY r),"""
        if i < ROUNDS:
            text += f"""
c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m.e, c{i}.e) AS e FROM c{i} LEFT JOIN (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS e
  FROM (SELECT c, i, sum(v.e[i]) AS s, count(*) AS n FROM v JOIN a{i} USING (r), (SELECT unnest(range(1, {DIMS + 1})) AS i) GROUP BY c, i) GROUP BY c) m USING (c)),"""
    return text.rstrip(",") + f"""
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(k.e, ',')) AS centroid_sha256 FROM v JOIN a{ROUNDS} a USING (r) JOIN c{ROUNDS} k ON k.c = a.c"""


SQL = _sql()
