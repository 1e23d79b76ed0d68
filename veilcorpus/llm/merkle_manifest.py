"""A Merkle tree over the rows of a table, with a proof for each row, as SQL over fixed-width hex strings.

Leaves of a group are numbered in parallel and cut into aligned blocks of arity ** HEIGHT. A block holds each
of its levels as one string of 64-character digests: a parent is the hash of one fixed-width substring, and the
siblings of a node are the substrings to its left and right within its run. Block roots are the leaves of the
next round until a group has one node, its subroot; subroots, in the order of their groups, form the last tree.

Nulls: a null field is hashed as `-`; null groups form a group of their own, which comes first, and null order
keys come first within a group. Repeated rows are leaves of their own, in any order among themselves. A group of
one leaf has that leaf as its subroot and no siblings. An empty table gives an empty result. Other columns of
the table, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from veilcorpus.session import materialize

ARITY = 2
HEIGHT = 10  # levels of a block; a block of 1,024 leaves is some 300 kB
DIGEST = 64
ROWS_A_TASK = 100_000
PATH = "array<struct<left:binary,right:binary>>"


def field_text(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value; integers are decimal."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """Lowercase hex sha256 of the fields of a row."""
    return F.sha2(F.concat(*map(field_text, values)), 256)


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its siblings, from the lowest level up, give."""
    return F.aggregate(
        path, leaf, lambda node, at: F.sha2(F.concat(at.getField("left"), node.cast("binary"), at.getField("right")), 256)
    )


def proof_digest(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    pieces = F.transform(path, lambda at: F.concat(at.getField("left"), at.getField("right")).cast("string"))
    return F.sha2(F.array_join(pieces, ""), 256)


def _numbered(nodes: DataFrame) -> DataFrame:
    """`nodes` (group, key, digest, item) with `pos`, the 0-based place in the group, and `n`, the group's size.

    A range shuffle sorts everything by group, key and digest; a row number that is written beforehand
    parts equal rows, so that no value is too frequent to be split. Places follow from the written
    partitions' counts.
    """
    held = materialize(nodes.withColumn("row", F.monotonically_increasing_id()))
    tasks = max(1, held.count() // ROWS_A_TASK + 1)
    order = [F.asc_nulls_first("group"), F.asc_nulls_first("key"), "digest", "row"]
    ranged = held.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    ranged = materialize(ranged.withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    counts = ranged.groupBy("group", part.alias("part")).agg(F.count(F.lit(1)).alias("here"), F.min("place").alias("first"))
    # At most one row a group and partition.
    group = Window.partitionBy("group")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("group").alias("g"), F.col("part").alias("p"), "first",
        F.coalesce(F.sum("here").over(before), F.lit(0)).alias("offset"), F.sum("here").over(group).alias("n"),
    )
    met = ranged.join(offsets, part.eqNullSafe(F.col("p")) & F.col("group").eqNullSafe(F.col("g")))
    return met.select("group", "digest", "item", (F.col("offset") + F.col("place") - F.col("first")).alias("pos"), "n")


def _parents(level: Column, run: int) -> Column:
    """The level above: the hash of every `run` characters, the last run may be shorter."""
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / run).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(level.substr(i * run + 1, F.lit(run)), 256)), "").cast("binary")


def _blocks(nodes: DataFrame, arity: int, height: int) -> DataFrame:
    """One row a block: `group, block, n, members, l0..l<height>, digest`; a level is null above a group's only node."""
    width = arity**height
    held = nodes.groupBy("group", F.expr(f"pos div {width}").alias("block")).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "digest", "item"))).alias("members")
    )
    digests = F.transform("members", lambda m: m.getField("digest"))
    held = held.withColumn("l0", F.array_join(digests, "").cast("binary"))
    for j in range(height):
        several = (F.octet_length(f"l{j}") > DIGEST) | (F.col("n") > width)
        held = held.withColumn(f"l{j + 1}", F.when(several, _parents(F.col(f"l{j}"), DIGEST * arity)))
    top = F.coalesce(*[F.col(f"l{j}") for j in reversed(range(height + 1))])
    return held.withColumn("digest", top.cast("string"))


def _siblings(pos: Column, arity: int, height: int) -> Column:
    """The runs' others of a member, one struct a level of its block."""
    inside = F.pmod(pos, F.lit(arity**height)).cast("int")
    levels = []
    for j in range(height):
        at = F.floor(inside / F.lit(arity**j)).cast("int")
        rank = at % arity
        level = F.col(f"l{j}")
        levels.append(
            F.when(
                F.col(f"l{j + 1}").isNotNull(),
                F.struct(
                    level.substr((at - rank) * DIGEST + 1, rank * DIGEST).alias("left"),
                    level.substr((at + 1) * DIGEST + 1, (F.lit(arity - 1) - rank) * DIGEST).alias("right"),
                ),
            )
        )
    return F.filter(F.array(*levels), lambda at: at.isNotNull())


def _climb(nodes: DataFrame, most: int, arity: int, height: int) -> tuple[DataFrame, DataFrame]:
    """`group, item, path, top` of each node: its siblings up to its group's only remaining node, `top`; and `group, top`."""
    blocks = materialize(_blocks(nodes, arity, height))
    width = arity**height
    if most > width:
        above = blocks.select(
            "group", "digest", F.col("block").alias("pos"), F.col("block").alias("item"), F.expr(f"(n - 1) div {width} + 1").alias("n")
        )
        upper = _climb(above, -(-most // width), arity, height)[0].select(
            F.col("group").alias("g"), F.col("item").alias("b"), F.col("path").alias("above"), "top"
        )
        blocks = blocks.join(upper, blocks["group"].eqNullSafe(F.col("g")) & (blocks["block"] == F.col("b"))).drop("g", "b")
    else:
        blocks = blocks.withColumn("above", F.expr(f"CAST(array() AS {PATH})")).withColumn("top", F.col("digest"))
    members = F.transform(
        "members",
        lambda m: F.struct(
            m.getField("item").alias("item"),
            F.concat(_siblings(m.getField("pos"), arity, height).cast(PATH), F.col("above")).alias("path"),
        ),
    )
    rows = blocks.select("group", "top", F.inline(members)).select("group", "item", "path", "top")
    return rows, blocks.filter("block = 0").select("group", "top")


def _tree(nodes: DataFrame, arity: int, height: int) -> tuple[DataFrame, DataFrame]:
    """`_climb` over unnumbered nodes (group, key, digest, item)."""
    numbered = _numbered(nodes)
    most = numbered.agg(F.max("n")).first()[0] or 0  # one number
    return _climb(numbered, most, arity, height)


def merkle_proofs(
    leaves: DataFrame, leaf: str, group: str, order: str, carry: Sequence[str] = (), arity: int = ARITY, height: int = HEIGHT
) -> DataFrame:
    """`carry` columns, `leaf, subroot, root, path` of each row.

    `leaf` names the column of digests, `group` a text column whose values have trees of their own, `order`
    the key by which leaves ascend. `path` has the siblings of each level, `left` and `right` of the node, up to
    the root of all groups; `fold` and `proof_digest` work on it.
    """
    if arity < 2 or height < 1:
        raise ValueError("arity must be at least 2 and height at least 1")
    item = F.struct(F.col(leaf).alias("leaf"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    nodes = leaves.select(F.col(group).alias("group"), F.col(order).alias("key"), F.col(leaf).alias("digest"), item.alias("item"))
    below, subroots = _tree(nodes, arity, height)
    name = F.col("group").alias("name")
    groups = subroots.select(F.lit(0).alias("group"), F.col("group").alias("key"), F.col("top").alias("digest"), F.struct(name).alias("item"))
    tops = _tree(groups, arity, height)[0].select(F.col("item.name").alias("name"), F.col("path").alias("above"), F.col("top").alias("root"))
    # One row a group.
    out = below.join(materialize(tops), F.col("group").eqNullSafe(F.col("name")))
    return out.select(
        *[F.col(f"item.c{i}").alias(c) for i, c in enumerate(carry)],
        F.col("item.leaf").alias(leaf), F.col("top").alias("subroot"), "root", F.concat("path", "above").alias("path"),
    )


def document_manifest(docs: DataFrame) -> DataFrame:
    """Root, subroot and proof of each document; every row whose id's crc32 is a multiple of 7 is checked tampered.

    Tampering adds 1 to a non-null `n_chars`; the altered leaf is folded with the original siblings. A null id
    is never tampered with.
    """

    def digest(n_chars: Column) -> Column:
        return leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    picked = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    leaves = docs.select(
        "doc_id", "lang", digest(F.col("n_chars")).alias("leaf"),
        F.when(picked, digest(F.col("n_chars").cast("decimal(20,0)") + 1)).alias("altered"),
    )
    proofs = merkle_proofs(leaves, "leaf", "lang", "doc_id", carry=["doc_id", "altered"])
    out = proofs.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.col("path"), F.coalesce("altered", "leaf")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
