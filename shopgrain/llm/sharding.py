"""Sharding by a hierarchical weighted hash tree.

A row descends from the root over regions and racks to a shard. At each node every child draws ``-ln(u) / weight``, with u
from a hash of the row's key and the child's name, and the smallest draw wins. So a child gets its share of weight, and
a changed weight moves rows only into or out of the subtrees on its path. A new shard comes as a region of its
own: then the only new draw is its own, and rows move into it and nowhere else.

Rows: a null text has no bytes (size 1, checksum 0). Rows with equal keys share a shard, null keys too.
Repeated rows each get a slot. Input columns other than the id and the text are left out, so no name can clash.
"""

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopgrain.sources.scratch import materialise

CHUNKS = 1024  # parts of a shard that are numbered side by side


class Leaf(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(shards: int, per_rack: int = 4, racks: int = 2) -> list[Leaf]:
    """Equal shards, ``per_rack`` to a rack and ``racks`` racks to a region."""
    return [
        Leaf(f"region-{s // (per_rack * racks)}", f"rack-{s // per_rack}", s) for s in range(shards)
    ]


def grown(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a region of its own."""
    shard = max((leaf.shard for leaf in tree), default=-1) + 1
    return [*tree, Leaf(f"own-region-{shard}", f"own-rack-{shard}", shard, weight)]


def _children(tree: list[Leaf]) -> Column:
    """Map from each inner node to its children (name, weight); nodes without weight are left out."""
    weights: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for leaf in tree:
        if leaf.weight > 0:
            rack = f"{leaf.region}/{leaf.rack}"
            weights[""][leaf.region] += leaf.weight
            weights[leaf.region][rack] += leaf.weight
            weights[rack][f"{rack}/{leaf.shard}"] += leaf.weight
    if not weights:
        raise ValueError("the tree has no shard with weight")
    pairs = []
    for node, children in weights.items():
        named = [
            F.struct(F.lit(name).alias("name"), F.lit(float(weight)).alias("weight"))
            for name, weight in sorted(children.items())
        ]
        pairs += [F.lit(node), F.array(*named)]
    return F.create_map(*pairs)


def shard_of(key: Column, tree: list[Leaf]) -> Column:
    """The shard that a key descends to."""
    children = _children(tree)

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11)
        share = (bits.cast("double") + 0.5) * F.lit(2.0**-53)
        return F.struct((-F.ln(share) / child["weight"]).alias("draw"), child["name"].alias("name"))

    node = F.lit("")
    for _ in range(3):
        node = F.array_min(F.transform(children[node], draw))["name"]
    return F.element_at(F.split(node, "/"), -1).cast("int")


def with_slots(placed: DataFrame, chunks: int = CHUNKS) -> DataFrame:
    """Adds ``slot``: gapless numbers from 0 in each shard of a written table with id and shard.

    A shard's rows are dealt to chunks; chunks are numbered side by side and offset by the chunks before them, of which
    there is one row per shard and chunk.
    """
    dealt = placed.withColumn(
        "chunk", F.pmod(F.xxhash64("id", "text_crc32"), F.lit(chunks)).cast("int")
    )
    ahead = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "chunk")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("shard", "chunk", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("shard", "chunk").orderBy("id", "size", "text_crc32")
    numbered = dealt.withColumn("at", F.row_number().over(inside))
    return (
        numbered.join(offsets, ["shard", "chunk"])
        .withColumn("slot", F.col("offset") + F.col("at") - 1)
        .drop("chunk", "offset", "at")
    )


def shard_documents(
    docs: DataFrame,
    tree: list[Leaf],
    next_tree: list[Leaf],
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard of every document; grown_shard is under ``next_tree``."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    read = docs.select(
        F.col(id_column).alias("id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = read.withColumns(
        {
            "law": F.lit("key"),
            "shard": shard_of(F.col("id"), tree),
            "grown_shard": shard_of(F.col("id"), next_tree),
        }
    )
    return (
        with_slots(materialise(placed, "shards"))
        .select("id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
        .withColumnRenamed("id", id_column)
    )
