"""k-means over integer vectors that are kept as codes of distinct subvectors.

The vectors are cut into chunks, and a chunk keeps, for each block of neighbouring dimensions, the distinct
subvectors that occur in it and for each vector its code, the place in that list; nothing is lost. In a round
the squared distances of the distinct subvectors to the centroids are computed once, and a vector's distances
are the sums of these by its codes. All sums are of integers and exact, so the order of rows has no influence.
Only centroids and sums (`k` rows) pass through the driver.

Vectors that are null, of another length, or with a null or non-finite component are left out. A null id counts
as an empty one in the choice of the first centroids, rows that share an id are vectors of their own (chosen by
their components where the hash ties), equal distances go to the smaller number. With fewer vectors than `k`
every vector starts a centroid. An empty table gives an empty result. Other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from veilcorpus.session import materialize

SCALE = 256.0
CHUNK_ROWS = 32_768  # the distances of a chunk to 40 centroids are 10 MB
WIDTHS = (1, 2, 4, 8)  # dimensions of a block; a chunk takes the width that costs it least
LARGEST = 1 << 27  # of a component; squares of 64 differences then stay below 2 ** 63
CHUNK_SCHEMA = "ids array<bigint>, width int, sizes array<int>, dictionary binary, codes binary"


def whole_vectors(table: DataFrame, vec_id: str, vector: str, dims: int, scale: float = SCALE) -> DataFrame:
    """`id, v`: vectors with exactly `dims` finite components, each floor(scale * x) with x as double."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    def scaled(x: Column) -> Column:
        wide = F.floor(x * scale)
        return F.when(F.abs(x * scale) <= LARGEST, wide).otherwise(F.raise_error(F.lit("a vector component is too large")).cast("bigint"))

    held = table.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("x"))
    held = held.filter((F.size("x") == dims) & F.forall("x", finite))
    return held.select("id", F.transform("x", scaled).alias("v"))


def _encode(v: np.ndarray, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct subvectors of each block of `width` dimensions, and every vector's codes."""
    lists, codes = [], np.empty((v.shape[1] // width, len(v)), dtype=np.int32)
    for b in range(len(codes)):
        part = np.ascontiguousarray(v[:, b * width : (b + 1) * width])
        keys = part[:, 0] if width == 1 else part.view([("", np.int64)] * width)[:, 0]
        _, first, codes[b] = np.unique(keys, return_index=True, return_inverse=True)
        lists.append(part[first])
    return lists, codes


def encode_chunks(vectors: DataFrame, dims: int, k: int, widths: tuple[int, ...] = WIDTHS, rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows of at most `rows` vectors, as dictionaries and codes."""
    allowed = [w for w in widths if dims % w == 0]

    def chunk(ids: list, v: np.ndarray) -> dict:
        def cost(made: tuple[list[np.ndarray], np.ndarray]) -> int:
            return k * (sum(x.size for x in made[0]) + made[1].size)

        lists, codes = min((_encode(v, w) for w in allowed), key=cost)
        return {
            "ids": ids, "width": lists[0].shape[1], "sizes": [len(x) for x in lists],
            "dictionary": b"".join(x.tobytes() for x in lists), "codes": codes.tobytes(),
        }

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("ids", pa.list_(pa.int64())), ("width", pa.int32()), ("sizes", pa.list_(pa.int32())),
            ("dictionary", pa.binary()), ("codes", pa.binary()),
        ])

        def flush(held: list) -> pa.RecordBatch:
            ids = [i for batch in held for i in batch.column("id").to_pylist()]
            v = np.concatenate([batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) for batch in held])
            return pa.RecordBatch.from_pylist([chunk(ids, v)], schema=schema)

        held, n = [], 0
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                if n + batch.num_rows > rows and held:
                    yield flush(held)
                    held, n = [], 0
                held.append(batch)
                n += batch.num_rows
        if n:
            yield flush(held)

    return vectors.mapInArrow(encode, CHUNK_SCHEMA)


def _nearest(chunk, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Cluster and squared distance of a chunk's vectors, with the chunk's dictionaries and codes."""
    dictionary = np.frombuffer(chunk.dictionary, dtype=np.int64)
    codes = np.frombuffer(chunk.codes, dtype=np.int32).reshape(len(chunk.sizes), -1)
    total = np.zeros((codes.shape[1], len(centroids)), dtype=np.int64)
    lists, at = [], 0
    for b, size in enumerate(chunk.sizes):
        words = dictionary[at : at + size * chunk.width].reshape(size, chunk.width)
        at += words.size
        lists.append(words)
        partial = np.zeros((size, len(centroids)), dtype=np.int64)
        for d in range(chunk.width):
            partial += (words[:, d, None] - centroids[None, :, b * chunk.width + d]) ** 2
        total += partial[codes[b]]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(total)), best], lists, codes


def _sums(chunks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Members and componentwise sums of the clusters that have any."""
    k, dims = centroids.shape

    def partial(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for chunk in frame.itertuples():
                best, _, lists, codes = _nearest(chunk, centroids)
                sums = np.empty((k, dims), dtype=np.int64)
                for b, words in enumerate(lists):
                    # How often each distinct subvector is in each cluster; then sums by code again.
                    seen = np.bincount(best * len(words) + codes[b], minlength=k * len(words)).reshape(k, -1)
                    sums[:, b * chunk.width : (b + 1) * chunk.width] = seen @ words
                n = np.bincount(best, minlength=k)
                rows += [(c, int(n[c]), sums[c].tolist()) for c in range(k) if n[c]]
            yield pd.DataFrame(rows, columns=["cluster", "n", "sums"])

    parts = chunks.mapInPandas(partial, "cluster int, n bigint, sums array<bigint>")
    added = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dims)]).alias("sums"))
    return {r["cluster"]: (r["n"], r["sums"]) for r in added.collect()}  # k rows


def subvector_clusters(
    table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 40, rounds: int = 5,
    widths: tuple[int, ...] = WIDTHS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """`vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256` of each whole vector after `rounds` rounds."""
    spark = table.sparkSession
    vectors = whole_vectors(table, vec_id, vector, dims)
    order = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = vectors.select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()  # k rows
    id_type = table.schema[vec_id].dataType
    if not first:
        empty = spark.createDataFrame([], StructType([StructField("vec_id", id_type)]))
        return empty.selectExpr("vec_id", "0 cluster", "0L distance", "0L cluster_inertia", "0L inertia", "'' centroid_sha256")
    centroids = np.array([r["v"] for r in first], dtype=np.int64)
    chunks = materialize(encode_chunks(vectors.withColumn("id", F.col("id").cast("bigint")), dims, k, widths, chunk_rows))
    for _ in range(rounds):
        centroids = centroids.copy()  # the last round's tasks hold their own
        for c, (n, sums) in _sums(chunks, centroids.copy()).items():
            centroids[c] = [s // n for s in sums]

    final = centroids.copy()

    def assign(frames):
        import pandas as pd

        for frame in frames:
            for chunk in frame.itertuples():
                best, distance, _, _ = _nearest(chunk, final)
                ids = pd.Series(list(chunk.ids), dtype="Int64")
                yield pd.DataFrame({"vec_id": ids, "cluster": best.astype(np.int32), "distance": distance})

    found = materialize(chunks.mapInPandas(assign, "vec_id bigint, cluster int, distance bigint"))
    digests = spark.createDataFrame(
        [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())],
        "cluster int, centroid_sha256 string",
    )
    spread = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = found.agg(F.coalesce(F.sum("distance"), F.lit(0)).alias("inertia")).first()[0]  # one number
    of_cluster = spread.join(digests, "cluster").withColumn("inertia", F.lit(whole).cast("bigint"))  # k rows
    out = found.join(F.broadcast(of_cluster), "cluster")
    return out.select(F.col("vec_id").cast(id_type).alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

