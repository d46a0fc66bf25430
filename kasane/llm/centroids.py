"""Exact k-means over integer vectors: float32 matrix products with rigorous error bounds screen the centroids, integers decide.

A batch of vectors is multiplied with all centroids in float32. The rounding error of each product is bounded, so every
squared distance is known to lie in an interval; a centroid stays on the short list of a vector if its interval begins
no later than the first one ends. A short list of one is the answer. The distances of longer ones are computed anew
in exact integers, and the smallest number wins a tie. Screening thus never changes a result, only its cost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kasane.llm.textbytes import give_back
from kasane.plans.staging import stage

PARTS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64

#: Largest size of a component up to which squared distances of ``PARTS`` components fit in 64 bits; larger ones are Python integers.
NARROW = 1 << 27
#: Bits of a limb: sums of components are added up limb by limb, so that they are exact whatever their size.
LIMB_BITS = 30
#: Vectors that one numpy step works on.
STEP_ROWS = 4096

_LONG = 1 << 63
_PARTIAL = "cluster int, limb int, n long, sums array<long>"


def _whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as int64 where all fit ``NARROW``, else as Python integers."""
    scaled = np.floor(values * SCALE)
    if not len(scaled) or np.abs(scaled).max() <= NARROW:
        return scaled.astype(np.int64)
    exact = np.vectorize(lambda x: floor(int(x) * SCALE if abs(x) >= 1 << 53 else x * SCALE), otypes=[object])
    return exact(values)


def kept_rows(batch: pa.RecordBatch, parts: int = PARTS) -> tuple[pa.Array, np.ndarray]:
    """Ids and components (float64) of the vectors that count: ``parts`` components, none null or not finite."""
    column = batch.column("vector")
    flat = column.flatten().cast(pa.float64(), safe=False)
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy().astype(np.int64))
    sizes[column.is_null().to_numpy(zero_copy_only=False)] = 0
    long_enough = sizes == parts
    matrix = values[np.repeat(long_enough, sizes)].reshape(-1, parts)
    fine = np.isfinite(matrix).all(axis=1)
    return batch.column("vec_id").filter(pa.array(long_enough)).filter(pa.array(fine)), matrix[fine]


def _squares(rows: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(axis=1)


def _floats(values: np.ndarray) -> np.ndarray:
    """As float64; a Python integer that is too large for one is infinite."""
    if values.dtype == object:
        values = np.array([float(x) if abs(x) < 1 << 1000 else np.inf for x in values.flat]).reshape(values.shape)
    return values.astype(np.float64)


def short_list(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids can be the nearest of each row (rows x centroids), by float32 products and bounds of their rounding errors.

    With u = 2^-24, converting both sides to float32 and adding up d products in any order is off by at most
    g * |x| * |c|, where g = (d + 2) u / (1 - (d + 2) u). All else is done in float64, whose errors the last term covers.
    What overflows float32 has no bound and stays on the list.
    """
    u = 2.0**-24
    g = (rows.shape[1] + 2) * u / (1 - (rows.shape[1] + 2) * u)
    with np.errstate(all="ignore"):
        product = (_floats(rows).astype(np.float32) @ _floats(centroids).astype(np.float32).T).astype(np.float64)
        x, c = np.sqrt(_floats(_squares(rows))), _floats(_squares(centroids))
        both = x[:, None] * np.sqrt(c)[None, :]
        score = c[None, :] - 2 * product  # the squared distance less |x|^2, which is the same for all centroids
        error = 2 * g * both * (1 + 2.0**-40) + (c[None, :] + 2 * both) * 2.0**-49
        low, high = score - error, score + error
        bound = ~(np.isfinite(low) & np.isfinite(high))
        first = np.where(bound, np.inf, high).min(axis=1)
        return bound | (low <= first[:, None])


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, ties to the smaller number, and the exact squared distance."""
    listed = short_list(rows, centroids)
    at, number = np.nonzero(listed)
    exact = object if object in (rows.dtype, centroids.dtype) else np.int64
    many = listed.sum(axis=1)[at] > 1
    best = np.zeros(len(rows), np.int64)
    best[at[~many]] = number[~many]
    at, number = at[many], number[many]
    if len(at):
        distance = _squares(rows[at].astype(exact) - centroids[number].astype(exact))
        order = np.lexsort((number, distance, at)) if exact is np.int64 else np.array(sorted(range(len(at)), key=lambda i: (at[i], distance[i], number[i])))
        rows_first = np.flatnonzero(np.diff(at[order], prepend=-1))
        best[at[order][rows_first]] = number[order][rows_first]
    return best, _squares(rows.astype(exact) - centroids[best].astype(exact))


def _steps(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer components of the vectors that count, some at a time; large components in steps of their own."""
    for batch in batches:
        for lo in range(0, batch.num_rows, STEP_ROWS):
            ids, values = kept_rows(batch.slice(lo, STEP_ROWS), parts)
            large = (np.abs(values) * SCALE > NARROW).any(axis=1)
            for which in (~large, large):
                if which.any():
                    yield ids.filter(pa.array(which)), _whole(values[which])
    give_back()


def _limbs(rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The components as limbs of ``LIMB_BITS`` bits, the last one with the sign; components that fit 64 bits are one limb."""
    at = 0
    while rows.dtype == object and any(abs(x) > NARROW for x in rows.flat):
        yield at, np.array([x & ((1 << LIMB_BITS) - 1) for x in rows.flat], np.int64).reshape(rows.shape)
        rows = np.array([x >> LIMB_BITS for x in rows.flat], object).reshape(rows.shape)
        at += 1
    yield at, rows.astype(np.int64)


def _partial_sums(centroids: Callable[[], np.ndarray], parts: int):
    """Per task one row for each cluster and limb: how many vectors and the sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sums = centroids(), {}
        for _, rows in _steps(batches, parts):
            cluster, _ = nearest(rows, found)
            for limb, values in _limbs(rows):
                for k in np.unique(cluster):
                    mine = cluster == k
                    n, total = sums.get((k, limb), (0, 0))
                    sums[k, limb] = n + (int(mine.sum()) if limb == 0 else 0), total + values[mine].sum(axis=0)
        out = [{"cluster": int(k), "limb": limb, "n": n, "sums": total.tolist()} for (k, limb), (n, total) in sums.items()]
        schema = pa.schema([("cluster", pa.int32()), ("limb", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _assigned(centroids: Callable[[], np.ndarray], parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = centroids()
        for ids, rows in _steps(batches, parts):
            cluster, distance = nearest(rows, found)
            fits = [int(d) if d < _LONG else None for d in distance] if distance.dtype == object else distance
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(fits, pa.int64())], ["vec_id", "cluster", "distance"])

    return run


def _first(vectors: DataFrame, clusters: int, parts: int) -> np.ndarray:
    """The vectors of smallest hash: of ``clusters`` rows only, which come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = kept_rows(batch, parts)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, parts, dtype=np.int32)), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([ids, lists], ["vec_id", "vector"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    name = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    kept = vectors.mapInArrow(run, f"vec_id {kind}, vector array<double>")
    rows = kept.orderBy(name.asc_nulls_last(), "vector").limit(clusters).collect()
    return _whole(np.array([r["vector"] for r in rows], np.float64).reshape(-1, parts))


def _moved(vectors: DataFrame, centroids: np.ndarray, parts: int) -> np.ndarray:
    """Centroids as the exact floored means of their vectors; only clusters x parts sums come to the driver."""
    sent = vectors.sparkSession.sparkContext.broadcast(centroids)
    partial = vectors.mapInArrow(_partial_sums(lambda: sent.value, parts), _PARTIAL)
    sums = partial.select("cluster", "limb", "n", F.posexplode("sums").alias("part", "value"))
    rows = sums.groupBy("cluster", "limb", "part").agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(20,0)")).alias("value")).collect()
    sent.destroy()
    count, total = {}, {}
    for r in rows:
        at = r["cluster"], r["part"]
        count[at] = count.get(at, 0) + r["n"]
        total[at] = total.get(at, 0) + (int(r["value"]) << (LIMB_BITS * r["limb"]))
    moved = [[total[k, i] // count[k, i] if (k, i) in count else int(row[i]) for i in range(parts)] for k, row in enumerate(centroids)]
    large = any(abs(x) > NARROW for row in moved for x in row)
    return np.array(moved, object if large else np.int64).reshape(-1, parts)


def kmeans(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, parts: int = PARTS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256): one row for each vector that counts.

    A vector counts if it has ``parts`` components, none null, infinite or not a number; others, null vectors too, have no row.
    Component x becomes floor(64 * x). The first centroids are the vectors of smallest SHA-256 of "1:<id>" (of one id the smallest
    vector first, null ids last; fewer if there are fewer vectors); each round assigns all vectors (ties to the smaller number) and moves every centroid
    that has some to their floored mean. Repeated rows count as often as given; a null id is kept; an empty table gives an empty result.
    Distances beyond 64 bits, which need components over 2^21, are null, as are sums that hold one; clusters stay exact. Other columns are ignored.

    Every round reads the vectors once more and shuffles clusters x parts sums a task; the centroids, on the driver and in every
    task, are clusters x parts numbers.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    centroids = _first(given, clusters, parts)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(given, centroids, parts)
    kind = given.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    sent = spark.sparkContext.broadcast(centroids)
    found = stage(given.mapInArrow(_assigned(lambda: sent.value, parts), f"vec_id {kind}, cluster int, distance long"), "clusters")
    return found.join(F.broadcast(_summary(spark, found, centroids)), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _summary(spark: SparkSession, found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, cluster_inertia, inertia, centroid_sha256): one row a cluster that has vectors."""
    whole = F.sum(F.col("distance").cast("decimal(20,0)"))
    sums = found.groupBy("cluster").agg(whole.alias("total"), F.count_if(F.col("distance").isNull()).alias("unknown")).collect()
    fits = lambda total, unknown: int(total) if not unknown and total < _LONG else None
    inertia = fits(sum(r["total"] or 0 for r in sums), sum(r["unknown"] for r in sums))
    names = [hashlib.sha256(",".join(str(int(x)) for x in row).encode()).hexdigest() for row in centroids]
    rows = [(r["cluster"], fits(r["total"], r["unknown"]), inertia, names[r["cluster"]]) for r in sums]
    return spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
