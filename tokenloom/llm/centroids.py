"""Centroid clustering with bounds that moved centroids loosen by planar geometry.

Lloyd's rounds over integer vectors. Each vector keeps its cluster and a lower bound on
its distance to every other centroid. When centroids have moved, the vectors of one
cluster lie within a sphere around their old centroid. Another centroid that moves by D
from p to q can come nearer to a vector x by no more than D times the cosine of the
angle, seen from the middle m of its way, between its direction and x:

    |x-p| - |x-q| = 2 D <x-m, u> / (|x-p| + |x-q|)  <=  D <x-m, u> / |x-m|

In the plane of the way and the sphere's centre, the largest such cosine belongs to the
tangent from m to the sphere, or is 1 if the way's direction points into it. So a bound
is loosened by less than the full drift, and not at all where the centroid moves away.
A vector whose exact distance to its moved centroid is below its loosened bound keeps its
cluster; any other is ambiguous and is compared with every centroid exactly. Distances
are exact integers, so results equal plain Lloyd's rounds; bounds are floating and are
trusted only with a margin.

Each round reads the table of vectors once, writes it with its new clusters, and sums
it up by cluster (combined in each task first). The driver holds the centroids, sums
and radii: a fixed number for each cluster.

Nulls and odd input: vectors that are null, of another length, or hold a null, NaN or
infinity are dropped. A null id is kept but starts no cluster before others do; repeated
rows are vectors of their own, and may start several clusters. Ties go to the smaller
cluster number. Fewer vectors than clusters make fewer clusters; an empty table gives
an empty one. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from tokenloom.llm.vectors import COMPONENTS, floored_means, integer_vectors, joined_numbers, matrix, squared_distances
from tokenloom.plans.workspace import written

CLUSTERS = 16
ROUNDS = 3
SCALE = 64
SALT = 1
# What a bound and a distance must differ by, as a share, to be told apart.
MARGIN = 1e-9


def first_centroids(vectors: DataFrame, clusters: int, salt: int, components: int) -> np.ndarray:
    """The vectors with the smallest hashes of ``salt:id``, at most ``clusters`` rows."""
    name = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(name.alias("name"), "v").orderBy(F.col("name").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), components)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the nearest centre (the smaller of several), its squared distance, and the distance of the next one."""
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    found = squared_distances(points, centres)
    index = np.arange(len(points))
    own = found.argmin(1)
    distance = found[index, own]
    if found.shape[1] == 1:
        return own, distance, np.full(len(points), np.inf)
    found[index, own] = np.iinfo(np.int64).max
    return own, distance, np.sqrt(found.min(1).astype(float))


def loosening(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each centroid, how much nearer it may have come to any vector of a sphere."""
    way = (new - old).astype(float)
    drift = np.sqrt((way * way).sum(1))
    to = centre - (old + new) / 2
    far = np.sqrt((to * to).sum(1))
    outside = far > radius
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.arccos(np.clip((to * way).sum(1) / (far * drift), -1, 1))
        tangent = np.arcsin(np.clip(radius / far, 0, 1))
    cosine = np.where(outside, np.cos(np.maximum(between - tangent, 0)), 1.0)
    return np.where(drift > 0, drift * np.clip(cosine, 0, 1) * (1 + MARGIN) + MARGIN, 0.0)


def loosened_by(old: np.ndarray, new: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """For each cluster, the most that any other centroid may have come nearer to its vectors."""
    out = np.zeros(len(old))
    for a in range(len(old)):
        others = np.arange(len(old)) != a
        if others.any():
            out[a] = loosening(old[a], radii[a], old[others], new[others]).max()
    return out


STATE = [StructField("cluster", IntegerType()), StructField("distance", LongType()), StructField("bound", DoubleType())]

Assign = Callable[[np.ndarray, "pa.RecordBatch"], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _with_state(table: DataFrame, components: int, assign: Assign) -> DataFrame:
    schema = StructType([table.schema["vec_id"], table.schema["v"], *STATE])

    def run(batches):
        for batch in batches:
            own, distance, bound = assign(matrix(batch.column("v"), components), batch)
            arrays = [batch.column("vec_id"), batch.column("v"), pa.array(own.astype(np.int32)), pa.array(distance), pa.array(bound)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return table.mapInArrow(run, schema)


def first_assignment(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    return _with_state(vectors, centres.shape[1], lambda points, _: nearest(points, centres))


def next_assignment(state: DataFrame, old: np.ndarray, new: np.ndarray, radii: np.ndarray) -> DataFrame:
    """``state`` after the centroids moved; only vectors whose bound does not decide are compared with all of them."""
    less = loosened_by(old, new, radii)

    def assign(points, batch):
        own = batch.column("cluster").to_numpy().astype(np.int64)
        bound = batch.column("bound").to_numpy() - less[own]
        distance = ((points - new[own]) ** 2).sum(1)
        unclear = ~(np.sqrt(distance.astype(float)) * (1 + MARGIN) + MARGIN < bound * (1 - MARGIN))
        own[unclear], distance[unclear], bound[unclear] = nearest(points[unclear], new)
        return own, distance, bound

    return _with_state(state, new.shape[1], assign)


def summed(state: DataFrame, clusters: int, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sums, counts, radii and summed distances of the clusters."""
    sums = [F.sum(F.get("v", F.lit(k)).cast("long")).alias(f"s{k}") for k in range(components)]
    # The exact sum may be larger than a long on its way; as a result it must be one.
    inertia = F.sum(F.col("distance").cast("decimal(20,0)")).cast("long").alias("inertia")
    rows = state.groupBy("cluster").agg(F.count("*").alias("n"), F.max("distance").alias("most"), inertia, *sums).collect()
    total, counts = np.zeros((clusters, components), np.int64), np.zeros(clusters, np.int64)
    radii, inertias = np.zeros(clusters), np.zeros(clusters, np.int64)
    for r in rows:
        at = r["cluster"]
        total[at] = [r[f"s{k}"] for k in range(components)]
        counts[at], inertias[at] = r["n"], r["inertia"]
        radii[at] = np.sqrt(float(r["most"])) * (1 + MARGIN)
    return total, counts, radii, inertias


def clustered(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    salt: int = SALT,
    components: int = COMPONENTS,
) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The stored assignment (vec_id, v, cluster, distance, bound), the centroids, and each cluster's summed distance."""
    vectors = integer_vectors(table, scale, key, vector, components)
    centres = first_centroids(vectors, clusters, salt, components)
    state = written(first_assignment(vectors, centres), "assigned")
    for _ in range(rounds):
        sums, counts, radii, _ = summed(state, len(centres), components)
        moved = floored_means(sums, counts, centres)
        state = written(next_assignment(state, centres, moved, radii), "assigned")
        centres = moved
    return state, centres, summed(state, len(centres), components)[3]


def clustered_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The query: cluster and distance of every vector, with digests of the centroids."""
    state, centres, inertias = clustered(spark.read.parquet(f"{folder}/embeddings.parquet"))
    digests = [hashlib.sha256(joined_numbers(c).encode()).hexdigest() for c in centres]
    total = sum(map(int, inertias))
    rows = [(k, int(i), total, d) for k, (i, d) in enumerate(zip(inertias, digests, strict=True))]
    # One row for each cluster.
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _sql() -> str:
    """Plain Lloyd's rounds: every vector against every centroid."""
    steps = []
    for n in range(ROUNDS + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT row, vec_id, v, k, d FROM (
    SELECT x.row, x.vec_id, x.v, c.k,
           CAST(list_sum(list_transform(range(1, {COMPONENTS + 1}), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i]))) AS BIGINT) AS d
    FROM kept x CROSS JOIN c{n} c)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, k) = 1)""")
        if n < ROUNDS:
            steps.append(f"""
s{n} AS (
  SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS m
  FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n}) GROUP BY k, i),
m{n} AS (
  SELECT k, list((s - ((s % m) + m) % m) // m ORDER BY i) AS v FROM s{n} GROUP BY k),
c{n + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (k))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v
  FROM (SELECT sha256('{SALT}:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT {CLUSTERS})),{",".join(steps)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (k)
"""


SQL = _sql()
