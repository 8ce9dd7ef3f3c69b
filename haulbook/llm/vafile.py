"""Exact integer k-means over a VA-file: few-bit cells per dimension, full vectors only where distance intervals overlap.

Every component becomes the integer floor(scale * x). Each dimension is cut into 2 ** ``bits`` cells; a row of the VA-file is a
vector's cells, a small part of its size. For a set of centroids, two lookup tables give the least and
greatest squared distance along each dimension from any point of each cell, so that sums of lookups are an interval that holds the
vector's distance to each centroid. A centroid whose interval begins above the end of another's cannot be the nearest.

A round's assignment is a function of its centroids alone, so no assignment is stored. Sums of clusters are carried
on: after the first round, a vector matters only if the centroids before and after assign it differently. Where the
intervals leave one centroid, the same before and after, it is settled from its cells; the others are fetched: joined
with the table of full vectors, which is bucketed by row, so that only the row numbers are shuffled. Their exact
distances decide and what moved changes the sums. The driver holds the centroids, their sums and the edges of cells, whatever the number of
vectors. The last assignment returns distances, so it reads every full vector.

Vectors with another number of components, or with a null or non-finite one, take no part; nor do those with a component
outside +-2**27 after scaling, whose squared distances do not fit a long. Ties go to the smaller centroid. Rows that repeat an id,
also a null one, are vectors like others; initial centroids take the smallest hash, null ids last, equal ids by value.
Fewer vectors than centroids give fewer centroids; an empty table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulbook.llm.common import new_folder, written

CENTROIDS = 8
ROUNDS = 10
DIMENSIONS = 64
SCALE = 1024
SEED = 3
BITS = 4
SAMPLE = 4096  # vectors from which the edges of cells are chosen; any edges give right results
BUCKET_ROWS = 4096
MOST_BUCKETS = 50_000  # Spark has a limit; beyond, buckets grow
LARGEST = 1 << 27
RESULT = "vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def usable(df: DataFrame, id_column: str, vector: str, dimensions: int, scale: int) -> DataFrame:
    """(vec_id, v): integer vectors that take part."""
    rows = df.select(F.col(id_column).alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    fits = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * float(scale)) <= F.lit(float(LARGEST))))
    rows = rows.filter(F.coalesce((F.size("x") == dimensions) & fits, F.lit(False)))
    return rows.select("vec_id", F.transform("x", lambda x: F.floor(x * float(scale)).cast("int")).alias("v"))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, one column for each centroid."""
    return np.stack([((vectors - c) ** 2).sum(1) for c in centroids], 1)


class Cells:
    """The cells of all dimensions: ``inner`` edges between them, and the least and greatest component of any vector."""

    def __init__(self, inner: np.ndarray, least: np.ndarray, greatest: np.ndarray, bits: int):
        self.inner, self.bits = inner, bits
        self.low = np.concatenate([least[:, None], np.maximum(inner, least[:, None])], 1)
        self.high = np.concatenate([np.minimum(inner - 1, greatest[:, None]), greatest[:, None]], 1)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The number of each component's cell."""
        found = [np.searchsorted(edges, x, "right") for edges, x in zip(self.inner, vectors.T, strict=True)]
        return np.stack(found, 1).astype(np.uint8)

    def pack(self, cells: np.ndarray) -> list[bytes]:
        bits = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - self.bits :]
        return [x.tobytes() for x in np.packbits(bits.reshape(len(cells), -1), axis=1)]

    def unpack(self, packed: np.ndarray, dimensions: int) -> np.ndarray:
        bits = np.unpackbits(packed, axis=1)[:, : dimensions * self.bits].reshape(len(packed), dimensions, self.bits)
        return np.packbits(bits, axis=2)[:, :, 0] >> (8 - self.bits)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each dimension, cell and centroid the least and the greatest squared distance."""
        low, high = self.low[:, :, None], self.high[:, :, None]
        c = centroids.T[:, None, :]
        inside = np.maximum(0, np.maximum(low - c, c - high))
        return inside**2, np.maximum((c - low) ** 2, (c - high) ** 2)

    def open(self, cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Whether each centroid may be the nearest: its interval begins where all others' have not ended."""
        least = np.zeros((len(cells), tables[0].shape[2]), np.int64)
        most = np.zeros_like(least)
        for d in range(cells.shape[1]):
            least += tables[0][d][cells[:, d]]
            most += tables[1][d][cells[:, d]]
        return least <= most.min(1, keepdims=True)


def _flags(open_: np.ndarray) -> np.ndarray:
    return (open_.astype(np.int64) << np.arange(open_.shape[1])).sum(1)


def _bits(flags: np.ndarray, k: int) -> np.ndarray:
    return (flags[:, None] >> np.arange(k)) & 1 == 1


def _sums(cluster: np.ndarray, sign: np.ndarray, vectors: np.ndarray, total: dict) -> None:
    """Add vectors, with their signs, to the running sums; place 0 counts them."""
    for c in np.unique(cluster).tolist():
        at = cluster == c
        s = sign[at]
        total[c] = total.get(c, 0) + np.concatenate([[s.sum()], (vectors[at] * s[:, None]).sum(0)])


def _summed(parts: DataFrame, k: int, dimensions: int) -> np.ndarray:
    """Sums over all tasks, as Python integers: one row per centroid, its count first."""
    rows = parts.groupBy("cluster", "place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    out = np.zeros((k, dimensions + 1), object)
    for r in rows:
        out[r["cluster"], r["place"]] = int(r["n"])
    return out


def _partial(total: dict) -> pa.RecordBatch:
    places = [(c, p, int(x)) for c, sums in total.items() for p, x in enumerate(sums)]
    arrays = [pa.array([x[i] for x in places], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64()))]
    return pa.RecordBatch.from_arrays(arrays, names=["cluster", "place", "n"])


def bucketed(rows: DataFrame, count: int, name: str) -> DataFrame:
    """The rows as a catalog table bucketed by ``row``, whose files are in the shared folder."""
    spark = rows.sparkSession
    buckets = min(MOST_BUCKETS, -(-count // BUCKET_ROWS))
    writer = rows.repartition(buckets, "row").write.bucketBy(buckets, "row").sortBy("row")
    writer.option("path", new_folder(spark, "vectors")).saveAsTable(name, format="parquet")
    return spark.table(name)


def clusters(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
    bits: int = BITS,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part.

    ``k`` is at most 62 and ``bits`` at most 8. The clustering runs when this is called; the result is a written table.
    """
    if not (0 < k <= 62 and 0 < bits <= 8):
        raise ValueError("k must be 1 to 62, bits 1 to 8")
    spark = df.sparkSession
    rows = written(usable(df, id_column, vector, dimensions, scale).withColumn("row", F.monotonically_increasing_id()), "integers")
    kind = rows.schema["vec_id"].dataType.simpleString()
    count = rows.count()
    if not count:
        return spark.createDataFrame([], RESULT.format(kind=kind))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(name.asc_nulls_last(), "v", "row").limit(k).select("v").collect()
    centroids = np.array([r["v"] for r in first], np.int64)
    k = len(centroids)

    sample = rows.orderBy(F.xxhash64("row", "v"), "row").limit(SAMPLE).select("v").collect()
    inner = np.quantile(np.array([r["v"] for r in sample], np.int64), np.arange(1, 1 << bits) / (1 << bits), axis=0, method="nearest")
    ends = rows.agg(*[f(F.col("v")[i]) for f in (F.min, F.max) for i in range(dimensions)]).first()
    cells = Cells(inner.T.astype(np.int64), np.array(ends[:dimensions], np.int64), np.array(ends[dimensions:], np.int64), bits)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = cells.pack(cells.of(_matrix(batch.column(1), dimensions)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["row", "cells"])

    table = f"haulbook_vectors_{uuid.uuid4().hex}"
    vectors = bucketed(rows.select("row", "v"), count, table)
    approximations = written(rows.select("row", "v").mapInArrow(approximate, "row long, cells binary"), "cells")

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            x = _matrix(batch.column(0), dimensions)
            _sums(distances(x, centroids).argmin(1), np.ones(len(x), np.int64), x, total)
        yield _partial(total)

    shape = "cluster int, place int, n long"
    sums = _summed(rows.select("v").mapInArrow(begin, shape), k, dimensions)
    for turn in range(rounds):
        if turn:
            sums = sums + _summed(_moves(vectors, approximations, cells, before, centroids, dimensions, shape), k, dimensions)
        before = centroids
        means = [[x // s[0] for x in s[1:]] if s[0] else c for s, c in zip(sums, before.tolist(), strict=True)]
        centroids = np.array(means, np.int64)
        if (centroids == before).all():
            break
    spark.sql(f"DROP TABLE {table}")  # the name only; files in the shared folder are the cluster's to clear

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = distances(_matrix(batch.column(1), dimensions), centroids)
            nearest = far.argmin(1)
            arrays = [batch.column(0), pa.array(nearest.astype(np.int32)), pa.array(far[np.arange(len(far)), nearest])]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cluster", "distance"])

    assigned = written(rows.select("vec_id", "v").mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "assigned")
    inertia = dict(assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    names = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = lambda values: F.array(*[F.lit(v) for v in values])[F.col("cluster")]
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        of([int(inertia.get(c, 0)) for c in range(k)]).cast("long").alias("cluster_inertia"),
        F.lit(int(sum(inertia.values()))).cast("long").alias("inertia"),
        of(names).alias("centroid_sha256"),
    )


def _moves(
    vectors: DataFrame, approximations: DataFrame, cells: Cells, before: np.ndarray, after: np.ndarray, dimensions: int, shape: str
) -> DataFrame:
    """What the sums of clusters gain and lose as ``after`` takes the place of ``before``: partial sums of each task."""
    tables, k = [cells.tables(c) for c in (before, after)], len(after)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows that their cells do not settle, with the centroids that may be nearest before and after."""
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = np.stack([np.frombuffer(x, np.uint8) for x in batch.column(1).to_pylist()])
            found = cells.unpack(packed, dimensions)
            old, new = (_flags(cells.open(found, t)) for t in tables)
            keep = np.flatnonzero((old != new) | (old & (old - 1) != 0))
            arrays = [batch.column(0).take(pa.array(keep)), pa.array(old[keep]), pa.array(new[keep])]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "old", "new"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Exact distances to those centroids only."""
        total: dict = {}
        for batch in batches:
            x = _matrix(batch.column(0), dimensions)
            old, new = (
                np.where(_bits(batch.column(i).to_numpy(), k), distances(x, c), np.iinfo(np.int64).max).argmin(1)
                for i, c in ((1, before), (2, after))
            )
            at = old != new
            ones = np.ones(int(at.sum()), np.int64)
            _sums(old[at], -ones, x[at], total)
            _sums(new[at], ones, x[at], total)
        yield _partial(total)

    unsettled = approximations.mapInArrow(bound, "row long, old long, new long")
    fetched = vectors.select("row", "v").join(unsettled, "row").select("v", "old", "new")
    return fetched.mapInArrow(decide, shape)
