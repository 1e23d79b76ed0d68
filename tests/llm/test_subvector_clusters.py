import hashlib
import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from veilcorpus.llm.subvector_clusters import encode_chunks, subvector_clusters, whole_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, dims, k, rounds):
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x):
            kept.append((vec_id, [math.floor(256 * v) for v in x]))
    if not kept:
        return []
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        of = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (cluster, _) in zip(kept, of, strict=True) if cluster == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    of = assign()
    inertia = [sum(d for c, d in of if c == i) for i in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        [(vec_id, c, d, inertia[c], sum(inertia), sha[c]) for (vec_id, _), (c, d) in zip(kept, of, strict=True)], key=str
    )


def found(df):
    cols = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted([tuple(r[c] for c in cols) for r in df.select(cols).collect()], key=str)


def odd_vectors(dims):
    rng = random.Random(5)
    rows = [(i, [rng.randint(-64, 64) / 128 for _ in range(dims)]) for i in range(120)]
    rows += [(1000 + i, [0.25] * dims) for i in range(70)]  # a third of all vectors are one
    rows += [(3, [0.5] * dims), (3, [0.5] * dims), (3, [-0.5] * dims), (None, [0.125] * dims), (None, [-2.0] * dims)]
    rows += [(9000, None), (9001, []), (9002, [0.0] * (dims - 1)), (9003, [None] + [0.0] * (dims - 1))]
    rows += [(9004, [float("nan")] + [0.0] * (dims - 1)), (9005, [float("-inf")] + [0.0] * (dims - 1))]
    return rows


@pytest.mark.parametrize(("widths", "chunk_rows"), [((1, 2, 4, 8), 10_000), ((4,), 7), ((1,), 1)])
def test_equals_brute_force(spark, widths, chunk_rows):
    rows = odd_vectors(8)
    table = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA).repartition(3)
    for name in ("id", "v", "x", "cluster", "ids", "inertia"):
        table = table.withColumn(name, F.lit("user"))
    got = found(subvector_clusters(table, dims=8, k=6, rounds=3, widths=widths, chunk_rows=chunk_rows))
    assert got == brute(rows, 8, 6, 3)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.0] * 4), (2, [0.0] * 4), (3, [1.0] * 4)]
    table = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA)
    assert found(subvector_clusters(table, dims=4, k=40)) == brute(rows, 4, 40, 5)
    none = subvector_clusters(table.limit(0), dims=4)
    assert none.collect() == [] and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(PySparkException, match="too large"):
        subvector_clusters(spark.createDataFrame([(1, [1e30] * 4, 0)], SCHEMA), dims=4).collect()


def test_codes_give_the_vectors_back_and_take_the_cheaper_width(spark):
    import numpy as np

    rng = random.Random(1)
    words = [[rng.randint(-9, 9) / 256 for _ in range(4)] for _ in range(3)]
    rows = [(i, rng.choice(words) + rng.choice(words)) for i in range(500)]
    vectors = whole_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "vec_id", "embedding", 8)
    chunks = encode_chunks(vectors.coalesce(1), 8, 40).collect()
    back = {}
    for c in chunks:
        codes = np.frombuffer(c["codes"], dtype=np.int32).reshape(len(c["sizes"]), -1)
        flat, at, blocks = np.frombuffer(c["dictionary"], dtype=np.int64), 0, []
        for b, size in enumerate(c["sizes"]):
            blocks.append(flat[at : at + size * c["width"]].reshape(size, -1)[codes[b]])
            at += size * c["width"]
        back |= dict(zip(c["ids"], np.hstack(blocks).tolist(), strict=True))
    assert back == {i: [math.floor(256 * v) for v in x] for i, x in rows}
    assert {c["width"] for c in chunks} == {8}  # nine distinct vectors
