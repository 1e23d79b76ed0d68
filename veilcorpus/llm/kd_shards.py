"""Sharding by a k-d tree over metadata: leaves of near equal bytes, alike in their metadata.

A row has a place, a whole number, in each dimension. An integer column is its own place; any other column is
placed by weight: a value's place is the bytes of all rows with smaller values, so whole values count, however
long their common beginning is. A node that stands for k shards is split along the dimension in which its rows
spread over the largest part of the whole range, at the place that leaves the lower half of the shards their share
of the bytes. The splits of one level are found together, by histograms that narrow in on each: Spark adds up the
cells, finds the one in which the share is reached by a running sum, and one row a node reaches the driver. The
tree itself is a CASE over literals, so rows are never joined or moved between levels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from veilcorpus.session import discard, materialize

CELLS = 4096  # of a node's histogram
TIES = 1 << 32
TOLERANCE = 1e-4  # of a shard's share: a split this near is taken
SLOT_ROWS = 50_000
ROWS_A_TASK = 100_000
INTEGERS = ("tinyint", "smallint", "int", "bigint")
LEAST = -(1 << 63)


@dataclass
class Node:
    first: int  # its first shard
    shards: int
    weight: int = 0
    dim: int | None = None
    span: tuple[int, int] | None = None  # least and greatest place along `dim`
    split: tuple[int, int] | None = None  # a row goes to the lower half if its (place, tie) is at most this
    halves: tuple[Node, Node] | None = None

    @property
    def lower(self) -> int:
        return self.shards // 2

    def of_rows(self) -> Column:
        """The first shard of the node that a row has reached."""
        if self.halves is None:
            return F.lit(self.first)
        place, (at, tie) = F.col(f"p{self.dim}"), self.split
        return F.when((place < at) | ((place == at) & (F.col("tie") <= tie)), self.halves[0].of_rows()).otherwise(self.halves[1].of_rows())


def _places_by_weight(slim: DataFrame, name: str) -> DataFrame:
    """`value, place`: the bytes of all rows with smaller values (null is the smallest); one row a value."""
    values = materialize(slim.groupBy(F.col(name).alias("value")).agg(F.sum("size").alias("w")))
    tasks = values.count() // ROWS_A_TASK + 1
    order = F.asc_nulls_first("value")
    ranged = values.repartitionByRange(tasks, order).sortWithinPartitions(order)
    ranged = materialize(ranged.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a task.
    bases = ranged.groupBy(part.alias("part")).agg(F.sum("w").alias("w")).select("part", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("part", part).withColumn("inside", F.coalesce(F.sum("w").over(inside), F.lit(0)))
    return placed.join(bases, "part").select("value", (F.col("base") + F.col("inside")).alias("place"))


def _measure(rows: DataFrame, root: Node, level: list[Node], ranges: list[float]) -> list[Node]:
    """Weight and widest dimension of each node; those that hold rows."""
    spread = [f(f"p{d}").alias(f"{n}{d}") for d in range(len(ranges)) for n, f in (("lo", F.min), ("hi", F.max))]
    found = {r["node"]: r for r in rows.groupBy(root.of_rows().alias("node")).agg(F.sum("size").alias("w"), *spread).collect()}  # a row a node
    held = [n for n in level if n.first in found]
    for n in held:
        r = found[n.first]
        n.weight = r["w"]
        wide = [(r[f"hi{d}"] - r[f"lo{d}"]) / ranges[d] if ranges[d] else 0.0 for d in range(len(ranges))]
        n.dim = max(range(len(ranges)), key=lambda d: (wide[d], -d))
        n.span = (r[f"lo{n.dim}"], r[f"hi{n.dim}"])
    return held


def _find_splits(rows: DataFrame, root: Node, nodes: list[Node]) -> None:
    """Set `split` of each node: at or below it lies the weight nearest to the lower half's share.

    Each pass cuts every open span of places into cells and goes on within the cell in which the share is
    reached, between the least and the greatest place that occur in it. Once that is a single place, its rows
    are told apart by their ties in the same way.
    """
    open_ = {n.first: {"node": n, "span": n.span, "place": None, "below": 0} for n in nodes}
    while open_:
        key, low, width, wanted, inside, target = (_case(open_, f) for f in (_key, _low, _width, _wanted, _inside, _target))
        cell = F.floor((key - low).cast("double") / width).cast("bigint")
        kept = rows.withColumn("node", root.of_rows()).filter(inside)
        cells = kept.groupBy("node", cell.alias("cell")).agg(
            F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"), F.min(key).alias("least"), F.max(key).alias("most")
        )
        upto = Window.partitionBy("node").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = cells.withColumn("upto", F.sum("w").over(upto)).filter(F.col("upto") >= target - wanted)
        first = run.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("cell"))).filter("r = 1")
        for r in first.collect():  # a row a node
            at = open_[r["node"]]
            n, before = at["node"], at["below"] + r["upto"] - r["w"]
            share = n.weight * n.lower / n.shards
            small = r["n"] == 1 or r["w"] <= TOLERANCE * n.weight / n.shards
            include = before + r["w"] - share <= share - before
            if at["place"] is None and (small or r["least"] < r["most"]):
                if small:
                    n.split = (r["most"], TIES) if include else (r["least"], -1)
                else:
                    at["span"], at["below"] = (r["least"], r["most"]), before
            elif at["place"] is None:
                at["place"], at["span"], at["below"] = r["least"], (0, TIES - 1), before
            elif small or r["least"] == r["most"]:
                n.split = (at["place"], r["most"] if include else r["least"] - 1)
            else:
                at["span"], at["below"] = (r["least"], r["most"]), before
        open_ = {k: at for k, at in open_.items() if at["node"].split is None}


def _case(open_: dict[int, dict], value) -> Column:
    """`value` of the open node that a row is in; null for other rows."""
    out = None
    for first, at in open_.items():
        met = F.col("node") == first
        out = F.when(met, value(at)) if out is None else out.when(met, value(at))
    return out


def _key(at: dict) -> Column:
    return F.col(f"p{at['node'].dim}") if at["place"] is None else F.col("tie")


def _low(at: dict) -> Column:
    return F.lit(at["span"][0]).cast("decimal(20,0)")


def _width(at: dict) -> Column:
    lo, hi = at["span"]
    return F.lit(max(1.0, (hi - lo + 1) / CELLS))


def _inside(at: dict) -> Column:
    here = _key(at).between(*at["span"])
    return here if at["place"] is None else here & (F.col(f"p{at['node'].dim}") == at["place"])


def _wanted(at: dict) -> Column:
    return F.lit(at["below"]).cast("bigint")


def _target(at: dict) -> Column:
    n = at["node"]
    return F.lit(n.weight * n.lower / n.shards)


def _grow(rows: DataFrame, shards: int, ranges: list[float]) -> Node:
    root = Node(0, shards)
    level = [root]
    while level := [n for n in level if n.shards > 1]:
        level = _measure(rows, root, level, ranges)
        _find_splits(rows, root, level)
        for n in level:
            n.halves = (Node(n.first, n.lower), Node(n.first + n.lower, n.shards - n.lower))
        level = [half for n in level for half in n.halves]
    return root


def kd_tree_shards(
    docs: DataFrame,
    *,
    dims: list[str],
    shards: int | None = None,
    target_bytes: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row `doc_id, size, text_crc32, shard, slot`; shards are near equal in bytes.

    Give the number of `shards`, or `target_bytes` that a leaf should have. `size` is the
    UTF-8 bytes of the text plus 16; a null text has none, and the crc of no bytes. `dims`
    are columns of any type that can be ordered; null comes first in each. Rows that are equal in a
    dimension are told apart by a hash of id, text and row, so a value, group of copies or repeated row
    with a third of the table is split like any other, and equal texts may lie in several shards.
    `slot` counts from 0 without gaps in each shard. An empty table gives no row. Extra columns are not read.
    """
    own = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        *[F.col(d).alias(f"d{i}") for i, d in enumerate(dims)],
    )
    # Written once: everything below reads these narrow rows, never the texts.
    slim = materialize(own.withColumn("row", F.monotonically_increasing_id()))
    total = slim.agg(F.sum("size")).first()[0] or 0
    if shards is None:
        if not target_bytes:
            raise ValueError("give shards or target_bytes")
        shards = max(1, round(total / target_bytes))
    placed = slim
    for i in range(len(dims)):
        if dict(slim.dtypes)[f"d{i}"] in INTEGERS:
            value = F.col(f"d{i}").cast("bigint")
            least = slim.agg(F.min(value)).first()[0]
            placed = placed.withColumn(f"p{i}", F.coalesce(value, F.lit(LEAST if least in (None, LEAST) else least - 1)))
        else:
            # A row a value; a frequent value's rows are split by the engine's skew handling.
            places = _places_by_weight(slim, f"d{i}").withColumnsRenamed({"value": f"v{i}", "place": f"p{i}"})
            placed = placed.join(places, F.col(f"d{i}").eqNullSafe(F.col(f"v{i}"))).drop(f"v{i}")
    tie = F.xxhash64("doc_id", "text_crc32", "row").bitwiseAND(F.lit(TIES - 1))
    placed = materialize(placed.select("doc_id", "size", "text_crc32", "row", tie.alias("tie"), *[f"p{i}" for i in range(len(dims))]))
    ends = placed.agg(F.lit(0), *[f(f"p{i}") for i in range(len(dims)) for f in (F.min, F.max)]).first()
    ranges = [float((ends[2 * i + 2] or 0) - (ends[2 * i + 1] or 0)) for i in range(len(dims))]
    root = _grow(placed, shards, ranges)
    sharded = materialize(placed.select("doc_id", "size", "text_crc32", "row", root.of_rows().cast("int").alias("shard")))
    discard(slim)
    discard(placed)
    return _with_slots(sharded)


def _with_slots(sharded: DataFrame) -> DataFrame:
    """Number the rows of each shard: in bins by hash that are small, on top of the bins before."""
    largest = sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    bins = max(1, -(-largest // SLOT_ROWS))
    dealt = sharded.withColumn("bin", F.pmod(F.xxhash64("row"), F.lit(bins)))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    order = Window.partitionBy("shard", "bin").orderBy("doc_id", "text_crc32", "row")
    numbered = dealt.withColumn("r", F.row_number().over(order)).join(starts.drop("n"), ["shard", "bin"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("r") - 1).alias("slot"))
