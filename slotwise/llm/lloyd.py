"""Centroid clustering by weighted deduplication: Lloyd's rounds over distinct quantised vectors.

Vectors become integers, floor(scale * x), and identical ones are grouped with their multiplicity (combined before the
shuffle, so a vector that a third of all rows hold is a row for each task). The distinct vectors are a table in the
shared folder; each round reads it, assigns every vector to the nearest centroid in exact integer arithmetic and sums
weight times vector within each task, so that a round shuffles clusters x components numbers for each task and nothing
else; the driver sees clusters x components numbers. At last the assignments are joined back to the rows; vectors that
more rows hold than a partition's share, fewer than there are partitions, are looked up by broadcast instead.

Defined results: rows whose vector is null, has another number of components, a null or non-finite component or one so
large (above 2^19 for 64 components) that a long may not hold a squared distance take no part and are not returned. Rows
with null vec_id take part and are returned, but are no initial centroids. Repeated rows each count and are each
returned; of rows with one vec_id and other vectors the lesser vector is taken first. Fewer rows than clusters: as many
clusters as rows. No rows: no rows. Other columns are ignored. The sum of all distances must fit a long.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import common as C

#: Vectors that are compared with all centroids at once.
ROWS = 16_384


def quantised(rows: DataFrame, dim: int, scale: int, column: str = "embedding") -> DataFrame:
    """vec_id, q: the components floor(scale * x) as little-endian 32-bit integers, of the rows that take part."""

    most = math.isqrt(2**63 // (4 * dim))  # differences are twice as large, and dim of their squares add up

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            fit = pa.compute.fill_null(pa.compute.equal(pa.compute.list_value_length(vectors), dim), False)
            batch = batch.filter(fit)
            if not batch.num_rows:
                continue
            x = pa.compute.list_flatten(batch.column(1)).cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)  # nulls become NaN
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(x * scale)
                fit = (np.abs(x) < most).all(1)
            own = np.ascontiguousarray(x[fit].astype("<i4"))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fit)), pa.array([r.tobytes() for r in own], pa.binary())], ["vec_id", "q"])

    return rows.select(F.col("vec_id").cast("long"), column).mapInArrow(run, "vec_id long, q binary")


def matrix(values: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<i4").reshape(-1, dim)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, the smaller number of equals, and its squared distance, exactly."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * x.shape[1] * largest**2 < 1 << 53:  # all steps are whole numbers that a double holds
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        d = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
        d = d.astype(np.int64)
    else:
        d = np.stack([np.square(x.astype(np.int64) - c).sum(1) for c in centroids.astype(np.int64)], 1)
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at]


def initial(kept: DataFrame, k: int, seed: int, dim: int) -> np.ndarray:
    """The k vectors with the least sha256 of `seed:vec_id`, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.where("vec_id is not null").select(name.alias("h"), "q").orderBy("h", F.expr("hex(q)")).limit(k).collect()
    return matrix([bytes(r["q"]) for r in first], dim).astype(np.int64)


def assigned(distinct: DataFrame, centroids: np.ndarray, dim: int) -> DataFrame:
    """q, n, cluster, distance of every distinct vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                part = batch.slice(s, ROWS)
                at, d = nearest(matrix(part.column(0).to_pylist(), dim), centroids)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(at.astype(np.int32)), pa.array(d)], ["q", "n", "cluster", "distance"])

    return distinct.select("q", "n").mapInArrow(run, "q binary, n long, cluster int, distance long")


def moved(distinct: DataFrame, centroids: np.ndarray, dim: int) -> np.ndarray:
    """The centroids after a round: floor(sum / count) of each component over a cluster's rows; empty ones stay."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[int]] = {}
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                part = batch.slice(s, ROWS)
                x, n = matrix(part.column(0).to_pylist(), dim), part.column(1).to_numpy()
                at, _ = nearest(x, centroids)
                # sums of a block stay below 2^63 while its rows stand for fewer than 2^36
                kind = np.int64 if int(n.sum()) < 1 << 36 else object
                weighted = np.concatenate([x.astype(kind) * n.astype(kind)[:, None], n.astype(kind)[:, None]], 1)
                for c, own in C.split_by(at.astype(np.int32)):
                    sums = weighted[own].sum(0).tolist()
                    total[c] = [a + b for a, b in zip(total[c], sums, strict=True)] if c in total else sums
        for c, sums in total.items():
            yield pa.RecordBatch.from_pydict({"cluster": pa.array([c] * (dim + 1), pa.int32()), "i": pa.array(range(dim + 1), pa.int32()), "s": pa.array(list(map(str, sums)), pa.string())})

    parts = distinct.select("q", "n").mapInArrow(run, "cluster int, i int, s string")
    sums = parts.groupBy("cluster", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # k * (dim + 1) rows at most
    out, table = centroids.copy(), [[0] * (dim + 1) for _ in range(k)]
    for r in sums:
        table[r["cluster"]][r["i"]] = int(r["s"])
    for c, row in enumerate(table):
        if row[dim]:
            out[c] = [x // row[dim] for x in row[:dim]]
    return out


def clusters(rows: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2, column: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every row that takes part.

    Lloyd's algorithm on floor(scale * x), begun at the k vectors with the least sha256 of `seed:vec_id`: `rounds` times
    all vectors go to the nearest centroid and centroids to the floor of their vectors' mean; then vectors are assigned
    once more. centroid_sha256 is of the final centroid's components, joined by commas.
    """
    spark = rows.sparkSession
    kept = C.written(quantised(rows, dim, scale, column), "quantised")
    distinct = C.written(kept.groupBy("q").agg(F.count("*").alias("n")), "distinct")
    centroids = initial(kept, k, seed, dim)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(distinct, centroids, dim)
    final = C.written(assigned(distinct, centroids, dim), "assigned")
    each = {r["cluster"]: (int(r["s"]), r["n"]) for r in final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)") * F.col("n")).alias("s"), F.sum("n").alias("n")).collect()}
    inertia, total = sum(s for s, _ in each.values()), sum(n for _, n in each.values())
    told = [(c, s, inertia, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, (s, _) in each.items()]
    about = F.broadcast(spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))
    hot = F.broadcast(final.where(F.col("n") * C.n_shards(spark) > total).select("q", F.col("cluster").alias("_c"), F.col("distance").alias("_d")))
    all_rows = kept.join(hot, "q", "left")
    cold = all_rows.where("_c is null").select("vec_id", "q").join(final, "q").select("vec_id", "cluster", "distance")
    both = cold.union(all_rows.where("_c is not null").select("vec_id", "_c", "_d"))
    return both.join(about, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
