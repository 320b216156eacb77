"""Merkle manifest of a dataset that keeps only every few levels (checkpoint and recompute).

Every row is a leaf, the digest of its fields. The leaves of a source, in the order of their ids, make a tree in which 16
consecutive nodes become the digest of their texts, up to one node, the source's subroot; the subroots, in the order of the sources,
make such a tree again, up to the root. H is the lowercase hex sha256, over the concatenated hex digests.

Of a tree only every ``STRIDE``-th level is written, each as aligned subtrees: one row with the up to 16^STRIDE nodes that
stand under one node of the next written level. Building reads a subtree and writes that one node. Proofs go down from the root: a subtree's
row meets what lies above its top node, its missing interior nodes are worked out anew from the nodes it stores, every node takes the
siblings of its levels and what is above, and the interior is dropped. No row holds more than a subtree and the siblings of one
path, however large a source is, and nothing but the heights' maximum comes to the driver.

Rows: a null field counts as ``-``, also null ids (which come first in their source), null sources (one source of their own, the first)
and null texts. Rows with equal ids follow each other by leaf; copies of a row are leaves of their own and take any order among
themselves, which no result shows but their proofs. A source with one row has its leaf as subroot, a single subroot is the root,
and a proof without siblings is H of nothing. An empty table has no root and no rows. Input columns other than the five are left out,
so no name can clash.
"""

from functools import reduce
from itertools import count, takewhile
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.operators.lookup import lookup
from shopgrain.operators.ordinal import with_ordinal
from shopgrain.sources.scratch import materialise

FANOUT = 16
STRIDE = 2  # of so many levels one is written
TAMPERED_IN = 5  # ids whose crc32 this divides
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PATH = "array<struct<left:string,right:string>>"


class Tree(NamedTuple):
    """Written levels, lowest first: tables (tree, height, subtree, nodes) and, per tree, its root's digest."""

    levels: list[DataFrame]
    roots: DataFrame  # tree, height, digest


def digest_of(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon and text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _level_above(below: Column, fanout: int) -> Column:
    """The digests of the runs of ``below``."""
    runs = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / fanout).cast("int"))
    run = lambda r: F.array_join(F.slice(below, r * fanout + 1, F.lit(fanout)), "")
    return F.transform(runs, lambda r: F.sha2(run(r), 256))


def with_interior(subtrees: DataFrame, level: int, fanout: int, stride: int) -> DataFrame:
    """Adds the levels of each subtree, worked out from its nodes: ``level_0`` to ``level_<stride>``, empty above a root."""
    out = subtrees.withColumn("level_0", F.col("nodes.digest"))
    none = F.array().cast("array<string>")
    for j in range(stride):
        made = F.when(F.col("height") > level + j, _level_above(F.col(f"level_{j}"), fanout))
        out = out.withColumn(f"level_{j + 1}", made.otherwise(none))
    return out


def build(leaves: DataFrame, payload: list[str], fanout: int = FANOUT, stride: int = STRIDE) -> Tree:
    """The trees over ``leaves``: tree, height, idx (0-based place in the tree), digest and ``payload`` columns."""
    highest = leaves.agg(F.max("height")).first()[0] or 0
    span = fanout**stride
    levels, roots, nodes, carried = [], [], leaves, payload
    for level in range(0, max(highest, 1), stride):
        grouped = nodes.groupBy("tree", "height", F.expr(f"idx div {span}").alias("subtree")).agg(
            F.sort_array(F.collect_list(F.struct("idx", "digest", *carried))).alias("nodes")
        )
        written = materialise(grouped, f"merkle-{level}")
        tops = F.flatten(F.array(*(F.col(f"level_{j}") for j in range(stride, -1, -1))))
        made = with_interior(written, level, fanout, stride).select(
            "tree", "height", F.col("subtree").alias("idx"), F.element_at(tops, 1).alias("digest")
        )
        levels.append(written)
        roots.append(made.where(F.col("height") <= level + stride).drop("idx"))
        nodes, carried = made.where(F.col("height") > level + stride), []
    return Tree(levels, materialise(reduce(DataFrame.unionByName, roots), "merkle-roots"))


def _siblings(level: Column, at: Column, fanout: int) -> Column:
    """What stands left and right of node ``at`` in its run of ``level``, each as one text."""
    first = at - at % fanout
    left = F.slice(level, first + 1, at % fanout)
    right = F.slice(level, at + 2, fanout - 1 - at % fanout)
    return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))


def with_paths(
    tree: Tree, above: DataFrame, payload: list[str], fanout: int = FANOUT, stride: int = STRIDE
) -> DataFrame:
    """tree, idx, digest, ``payload`` and path of every leaf, with the columns of ``above``.

    The path holds the siblings of each level, the leaf's own first; ``above`` gives each tree the path of its root.
    """
    span = fanout**stride
    known = [c for c in above.columns if c != "tree"]
    tops = tree.roots.select("tree", "height").join(above, "tree")
    found = None
    for k in range(len(tree.levels) - 1, -1, -1):
        level = k * stride
        own = tops.where(F.col("height") <= level + stride)
        if k:
            own = own.where(F.col("height") > level)
        heads = own.withColumn("subtree", F.lit(0).cast("bigint")).select("tree", "subtree", *known)
        if found is not None:
            heads = heads.unionByName(found.withColumnRenamed("idx", "subtree").select(heads.columns))
        interior = with_interior(tree.levels[k], level, fanout, stride)
        at = F.col("at")
        place, steps = at, []
        for j in range(stride):
            has = F.col("height") > level + j
            steps.append(F.when(has, _siblings(F.col(f"level_{j}"), place, fanout)))
            place = F.floor(place / fanout).cast("int")
        mine = F.array_compact(F.array(*steps)).cast(PATH)
        carried = payload if k == 0 else []
        found = (
            interior.join(heads, ["tree", "subtree"])
            .select("*", F.posexplode("nodes").alias("at", "node"))
            .withColumn("path", F.concat(mine, F.col("path")))
            .select(
                "tree",
                (F.col("subtree") * span + at).alias("idx"),
                *(F.col(f"node.{c}").alias(c) for c in ("digest", *carried)),
                *known,
            )
        )
        if k:
            found = materialise(found, f"merkle-paths-{level}")
    return found


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path's siblings lead to."""
    return F.aggregate(path, leaf, lambda below, step: digest_of(step["left"], below, step["right"]))


def _height(n: Column, fanout: int) -> Column:
    """Levels above ``n`` leaves until one node remains."""
    powers = takewhile(lambda p: p < 1 << 62, (fanout**k for k in count()))
    return sum(((n > F.lit(p)).cast("int") for p in powers), F.lit(0))


class Manifest(NamedTuple):
    """The trees of all sources and the tree over their subroots."""

    sources: Tree
    top: Tree


def leaves_of(
    docs: DataFrame, id_column: str, source_column: str, other_columns: list[str], text_column: str
) -> DataFrame:
    """id, source (``0`` for null, else ``1`` and its name), digest and, where the id is picked, the tampered row's digest."""
    first, text = [id_column, source_column, *other_columns], F.col(text_column)
    head = F.concat(*(field(F.col(c)) for c in first))
    picked = F.crc32(F.col(id_column).cast("string")) % TAMPERED_IN == 0
    return docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.concat(F.lit("1"), F.col(source_column).cast("string")), F.lit("0")).alias("source"),
        digest_of(head, field(text)).alias("digest"),
        F.when(picked, digest_of(head, field(F.translate(text, UPPER, LOWER)))).alias("tampered"),
    )


def manifest(
    leaves: DataFrame, payload: list[str], fanout: int = FANOUT, stride: int = STRIDE
) -> Manifest:
    """The trees over ``leaves``: id, source, digest and ``payload`` columns."""
    read = materialise(leaves.select("source", "id", "digest", *payload), "merkle-leaves")
    placed = materialise(with_ordinal(read, ["source", "id", "digest"]), "merkle-order")
    # a source's tree is named by its first ordinal, so that trees come in the order of their sources
    trees = placed.groupBy("source").agg(F.min("ord").alias("tree"), F.count(F.lit(1)).alias("n"))
    trees = trees.select("source", "tree", _height(F.col("n"), fanout).alias("height"))
    places = lookup(placed, trees, ["source"]).withColumn("idx", F.col("ord") - F.col("tree"))
    sources = build(places.select("tree", "height", "idx", "digest", "id", *payload), ["id", *payload], fanout, stride)

    subroots = with_ordinal(sources.roots.select(F.col("tree").alias("member"), "digest"), ["member"])
    height = _height(F.lit(sources.roots.count()), fanout)
    over = subroots.select(
        F.lit(0).cast("bigint").alias("tree"), height.alias("height"), (F.col("ord") - 1).alias("idx"), "digest", "member"
    )
    return Manifest(sources, build(over, ["member"], fanout, stride))


def proofs(
    made: Manifest, payload: list[str], fanout: int = FANOUT, stride: int = STRIDE
) -> DataFrame:
    """id, ``payload``, digest (the leaf), path (siblings from the leaf to the root), subroot and root of every leaf."""
    nothing = F.array().cast(PATH)
    root = made.top.roots.select("tree", nothing.alias("path"), F.col("digest").alias("root"))
    subroots = with_paths(made.top, root, ["member"], fanout, stride).select(
        F.col("member").alias("tree"), "path", F.col("digest").alias("subroot"), "root"
    )
    subroots = materialise(subroots, "merkle-subroots")
    return with_paths(made.sources, subroots, ["id", *payload], fanout, stride)


def verified_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    other_columns: tuple[str, ...] = ("lang", "n_chars"),
    text_column: str = "text",
    fanout: int = FANOUT,
    stride: int = STRIDE,
) -> DataFrame:
    """Proves every row against the manifest, after the texts of some rows were tampered with.

    id, leaf, subroot, root, proof_sha256 (H of the siblings) of the rows as they are; folded_root, worked out from the tampered leaf
    (rows with an id whose crc32 is divisible by 5: A-Z of the text lower-cased) or else the row's own, and
    verified: whether that is the root.
    """
    leaves = leaves_of(docs, id_column, source_column, list(other_columns), text_column)
    made = manifest(leaves, ["tampered"], fanout, stride)
    siblings = F.transform("path", lambda step: F.concat(step["left"], step["right"]))
    return (
        proofs(made, ["tampered"], fanout, stride)
        .select(
            F.col("id").alias(id_column),
            F.col("digest").alias("leaf"),
            "subroot",
            "root",
            F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
            folded(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
