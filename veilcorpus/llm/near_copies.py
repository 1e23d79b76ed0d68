"""Near-duplicate classes: DartMinHash bands give candidates, exact weighted Jaccard decides.

A node is one distinct text. Nodes that share a band hash meet in a bucket, and no bucket
emits all its pairs. First each is compared with one pivot of its bucket, and the links
found are joined into classes. Then every bucket that still holds two classes compares the
nodes outside its largest class with all others; pairs of one class are passed over, and
so are pairs whose weights or parity maps prove that they can't be alike. So a large group
of copies costs one comparison a node, and no link between two classes is lost: a pair in a
bucket is compared, or already in one class, or ruled out by an exact bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from veilcorpus.functions.frames import free_name
from veilcorpus.llm.batches import small_batches
from veilcorpus.llm.dart_minhash import DartSketch, band_hashes, parity_maps, weighted_jaccard, weighted_sets
from veilcorpus.llm.shingles import Shingler
from veilcorpus.session import materialize

BANDS, ROWS = 30, 5  # a pair of similarity 0.8 shares no band with a chance of (1 - 0.8^5)^30 = 7e-6
GROUP = 64
MAP_WORDS = 16
MAPS = [f"m{i}" for i in range(MAP_WORDS)]
PACK = 256


def _signer(size: int, bands: int, rows: int):
    @F.pandas_udf("weight bigint, bands array<bigint>, map array<bigint>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingler, sketch = Shingler(size), DartSketch(bands * rows)
        for batch in batches:
            texts = list(batch)
            out: list[tuple] = []
            for i in range(0, len(texts), GROUP):
                sets = weighted_sets(shingler, texts[i : i + GROUP])
                full = [s for s in sets if len(s[0])]
                found = iter(band_hashes(sketch.sketch(full), bands) if full else ())
                maps = parity_maps(sets, MAP_WORDS)
                out += [(int(s[1].sum()), next(found) if len(s[0]) else [], m) for s, m in zip(sets, maps)]
            yield pd.DataFrame(out, columns=["weight", "bands", "map"])

    return sign


def _comparer(size: int):
    @F.pandas_udf("double")
    def compare(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        shingler = Shingler(size)
        for left, right in batches:
            last, own = None, None
            out = []
            for a, b in zip(left, right):
                if a != last:
                    (own,), last = weighted_sets(shingler, [a]), a
                (other,) = weighted_sets(shingler, [b])
                out.append(weighted_jaccard(own, other))
            yield pd.Series(out, dtype=float)

    return compare


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """`node, comp` for the nodes on edges `(a, b)`; `comp` is one node of each component.

    Each step points every node at its smallest neighbour, follows the pointers to their
    ends, and contracts the edges; a chain of any length halves at least.
    """
    labels = nodes.select("node", F.col("node").alias("comp"))
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("up")).withColumnRenamed("a", "v"))
        while True:
            above = up.select(F.col("v").alias("up"), F.col("up").alias("top"))
            jumped = materialize(up.join(above, "up").select("v", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")))
            up = jumped.select("v", "up")
            if jumped.filter("moved").isEmpty():
                break
        ends = up.withColumnRenamed("v", "comp")
        labels = materialize(labels.join(ends, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")))
        a, b = up.toDF("a", "ua"), up.toDF("b", "ub")
        edges = materialize(
            edges.join(a, "a").join(b, "b").filter("ua <> ub").select(F.col("ua").alias("a"), F.col("ub").alias("b")).distinct()
        )
        if edges.isEmpty():
            return labels


def _may_be_alike(a: Callable[[str], Column], b: Callable[[str], Column], least: float) -> Column:
    """False only if two nodes can't reach the similarity `least`: by the difference of weights, or of maps."""
    both = a("weight") + b("weight")
    differs = F.bit_count(a("m0").bitwiseXOR(b("m0")))
    for m in MAPS[1:]:
        differs = differs + F.bit_count(a(m).bitwiseXOR(b(m)))
    room = F.lit(1 - least) * both + F.lit(1e-6)
    return (F.lit(1 + least) * F.abs(a("weight") - b("weight")) <= room) & (F.lit(1 + least) * differs <= room)


def _ordered(a: Column, b: Column) -> tuple[Column, Column]:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _pivot_pairs(members: DataFrame, maps: DataFrame, least: float) -> DataFrame:
    """Each member of a bucket with the bucket's pivot.

    That is the member of smallest hash of (node, bucket), so each bucket of a group of copies
    has another, and a node meets many of its group.
    """
    pivots = members.groupBy("bucket").agg(F.min_by("node", F.xxhash64("node", "bucket")).alias("pivot"))
    met = members.join(pivots, "bucket").filter("node <> pivot").select(*_ordered(F.col("node"), F.col("pivot"))).distinct()
    left = maps.select(F.col("node").alias("a"), *[F.col(c).alias(f"a_{c}") for c in ("weight", *MAPS)])
    right = maps.select(F.col("node").alias("b"), *[F.col(c).alias(f"b_{c}") for c in ("weight", *MAPS)])
    alike = _may_be_alike(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}"), least)
    return met.join(left, "a").join(right, "b").filter(alike).select("a", "b")


def _rest_pairs(members: DataFrame, maps: DataFrame, least: float) -> DataFrame:
    """Pairs of different classes within a bucket that may be alike; `members` has `comp`.

    The nodes outside a bucket's largest class are packed into rows of at most about PACK,
    and each member goes through the rows of its bucket. The largest class is only told apart
    to save work, so any one of equals will do.
    """
    sizes = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count(F.lit(1)).alias("classes"))
    open_ = members.join(largest.filter("classes > 1").select("bucket", "main"), "bucket")
    mixed = materialize(open_.join(maps, "node"))
    outside = mixed.filter("comp <> main")
    # Packs are dealt by hash, and their number follows from the bucket's number of outsiders.
    packs = outside.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / PACK).alias("packs"))
    dealt = outside.join(packs, "bucket").withColumn("pack", F.pmod(F.xxhash64("node"), F.col("packs")))
    packed = dealt.groupBy("bucket", "pack").agg(F.collect_list(F.struct("node", "comp", "weight", *MAPS)).alias("others"))
    met = mixed.join(packed.drop("pack"), "bucket")
    # Two outsiders meet twice; the pair is kept where the other is the smaller node.
    wanted = F.filter(
        "others",
        lambda o: (o["comp"] != F.col("comp"))
        & ((F.col("comp") == F.col("main")) | (o["node"] < F.col("node")))
        & _may_be_alike(F.col, lambda c: o[c], least),
    )
    found = met.select("node", F.explode(F.transform(wanted, lambda o: o["node"])).alias("other"))
    return found.select(*_ordered(F.col("node"), F.col("other"))).distinct()


def near_copy_classes(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    least: float = 0.8,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row a document: `doc_id, digest, class_id, class_docs, first`.

    Texts are alike when the weighted Jaccard similarity of their `size`-word shingles
    (weight: how often a shingle occurs) is at least `least`; a class is a connected set.
    `class_id` is the smallest id in the class, `class_docs` its number of rows, and `first`
    marks the row that has this id; if several texts do, the one of smallest digest. Equal texts are always one class, and so are texts
    without any word if they are equal. A null text is a class of its own, with digest null
    and its own id. Rows with equal id and text stay separate rows, each marked first if one
    is. Extra columns are not read.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    present = source.filter(F.col("text").isNotNull()).withColumn("digest", F.md5("text"))
    signed = materialize(
        present.withColumn("s", _signer(size, bands, rows)("text")).select("doc_id", "digest", "s.weight", "s.bands", "s.map")
    )
    # Written, so that the numbers stay as they are.
    nodes = materialize(
        signed.groupBy("digest")
        .agg(F.first("weight").alias("weight"), F.first("bands").alias("bands"), F.first("map").alias("map"), F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    maps = nodes.select("node", "weight", *[F.col("map")[i].alias(m) for i, m in enumerate(MAPS)])
    members = materialize(entries.join(shared, "bucket"))

    wanted = members.select("node").distinct().join(nodes.select("node", "digest", "low"), "node")
    texts = materialize(
        present.withColumn("low", F.coalesce("doc_id", F.lit(-1)))
        .join(wanted.withColumn("low", F.coalesce("low", F.lit(-1))), ["digest", "low"])
        .groupBy("digest", "low")
        .agg(F.first("node").alias("node"), F.first("text").alias("text"))
        .select("node", "text")
    )
    compare = _comparer(size)

    def linked(pairs: DataFrame) -> DataFrame:
        met = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
        return materialize(met.withColumn("similarity", compare("text_a", "text_b")).filter(F.col("similarity") >= least).select("a", "b"))

    tried = materialize(_pivot_pairs(members, maps, least))
    links = linked(tried)
    labels = components(nodes, links)
    rest = materialize(_rest_pairs(members.join(labels, "node"), maps, least).join(tried, ["a", "b"], "left_anti"))
    more = linked(rest)
    if not more.isEmpty():
        labels = components(nodes, links.unionByName(more))

    classes = nodes.select("node", "digest", "low", "n").join(labels, "node")
    # The node with the smallest id stands for its class; null ids come last, and equal ids go by the text's digest.
    stands = F.min(F.struct(F.col("low").isNull(), "low", "digest")).alias("stands")
    totals = classes.groupBy("comp").agg(stands, F.sum("n").alias("class_docs"))
    named = classes.join(totals, "comp").select(
        "digest", F.col("stands.low").alias("class_id"), "class_docs", (F.col("digest") == F.col("stands.digest")).alias("holds")
    )
    known = signed.select("doc_id", "digest").join(named, "digest")
    known = known.select(
        "doc_id", "digest", "class_id", "class_docs", (F.col("holds") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("first")
    )
    alone = source.filter(F.col("text").isNull()).select(
        "doc_id", F.lit(None).cast("string").alias("digest"), F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_docs"), F.lit(True).alias("first")
    )
    return known.unionByName(alone)


def one_of_each_class(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` that stand for their class (see `near_copy_classes`), with all their columns.

    Of rows with equal id and text one stays. Null texts stay. Columns of any names are kept.
    """
    classes = near_copy_classes(docs, doc_id=doc_id, text=text, **options)
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    both = [free_name("_near_digest", docs), free_name("_near_key", docs)]
    nth = free_name("_near_nth", docs)
    stay = classes.filter("first AND digest IS NOT NULL").select(F.col("digest").alias(both[0]), key("doc_id").alias(both[1]))
    present = docs.filter(F.col(text).isNotNull()).withColumns({both[0]: F.md5(text), both[1]: key(doc_id)})
    kept = present.join(stay.distinct(), both, "left_semi")
    # The same keys again, so the join's partitioning serves; of equal rows each task sends on one.
    first = kept.withColumn(nth, F.row_number().over(Window.partitionBy(*both).orderBy(*both))).filter(F.col(nth) == 1)
    return first.drop(*both, nth).unionByName(docs.filter(F.col(text).isNull()))
