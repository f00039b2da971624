"""A Merkle manifest of a dataset, with octopus multiproofs per partition of leaves.

Each row is a leaf, the digest of its columns.  The leaves of one group (language) ascend by key;
eight neighbours make a node, level by level, down to one subroot, and the subroots of all
groups make the root the same way.  Leaves are numbered by a range sort and the counts of its
runs, levels are aggregates: the tree is built by DataFrame functions alone.

Proofs are made for partitions of neighbouring leaves.  A partition finds the smallest set of
nodes that its leaves do not give themselves: at each level, the brothers of known nodes that
are not known.  All coordinates are fetched in one join; the partition then derives every
interior node that its leaves share once and hands out the proof of each leaf: for each level,
what stands left and right of the node in its run.  Nodes high up, which many partitions ask
for, are kept in several copies, so no key of that join is hot.

Defined results: a null column is ``-``; null keys come first, then ties by digest (equal rows
are interchangeable); a null group is a group of its own and comes first; a null key is never
tampered with; repeated rows are leaves of their own; an empty table has no root and gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streetloom.llm.common import staged

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes of a run; the shift that divides by it.
ARITY, SHIFT = 8, 3
#: Levels of a full tree of neighbouring leaves that one task proves.
PROVED = 4
#: Levels from which on nodes are asked for by very many partitions, and their copies.
UPPER, COPIES = 8, 16
#: Name of the tree over the subroots; other trees have a first character.
TOP = ""
PATH = "array<struct<left: string, right: string>>"


class Tree(NamedTuple):
    """leaves: tree, index, size, rank, trees, digest and more; nodes: tree, level, index, digest."""

    leaves: DataFrame
    nodes: DataFrame
    root: str


def leaf_digest(*values: Column) -> Column:
    """The digest of a row: each value as its length in bytes, a colon and the value."""
    texts = [v.cast("string") for v in values]
    fields = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(f, F.lit("-")) for f in fields]), 256)


def tree_name(group: Column) -> Column:
    """Names that sort as the groups do, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def numbered(spark: SparkSession, rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their ``index`` among those of their ``tree``, and its ``size``.

    Sorted by ranges, each task numbers its own runs; the counts of the runs give what to add.
    """
    rows = staged(spark, rows.withColumn("__row", F.monotonically_increasing_id()), "leaves")
    by = ["tree", *order, "__row"]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("__row")
    rows = staged(spark, rows.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    runs = rows.groupBy("__part", "tree").agg(
        F.count(F.lit(1)).alias("n"), F.min("__at").alias("first")
    )
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        "__part", "tree", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("__add"),
        F.sum("n").over(tree).alias("size"),
    )
    rows = rows.join(runs, ["__part", "tree"])
    return rows.withColumn("index", F.col("__at") + F.col("__add")).drop("__at", "__add", "__part")


def levels(spark: SparkSession, leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes above ``leaves`` (tree, size, index, digest), and the last one of each tree."""
    now = leaves.select("tree", "size", "index", "digest")
    widest = now.agg(F.max("size")).first()[0] or 0
    nodes = leaves.select("tree", F.lit(0).alias("level"), "index", "digest")
    tops, level = now.where("size = 1").select("tree", "digest"), 0
    while widest > 1:
        level, widest = level + 1, -(-widest // ARITY)
        run = F.array_sort(F.collect_list(F.struct("index", "digest")))
        run = F.transform(run, lambda node: node["digest"])
        up = now.where("size > 1").groupBy(
            "tree", F.shiftright(F.col("size") + (ARITY - 1), SHIFT).alias("size"),
            F.shiftright("index", SHIFT).alias("up"),
        )
        up = up.agg(F.sha2(F.array_join(run, ""), 256).alias("digest"))
        now = staged(spark, up.withColumnRenamed("up", "index"), "level")
        nodes = nodes.unionByName(now.select("tree", F.lit(level).alias("level"), "index", "digest"))
        tops = tops.unionByName(now.where("size = 1").select("tree", "digest"))
    return nodes, tops


def merkle_tree(spark: SparkSession, leaves: DataFrame, order: list[str]) -> Tree | None:
    """The tree over ``leaves`` (tree, digest and ``order`` columns); None without leaves."""
    leaves = numbered(spark, leaves, order)
    trees = numbered(spark, leaves.select("tree").distinct().select(
        F.lit(TOP).alias("tree"), F.col("tree").alias("of")
    ), ["of"])
    trees = staged(spark, trees.select(
        F.col("of").alias("tree"), F.col("index").alias("rank"), F.col("size").alias("trees")
    ), "trees")
    leaves = staged(spark, leaves.join(trees, "tree"), "leaves")
    nodes, tops = levels(spark, leaves)
    subroots = staged(spark, tops.join(trees, "tree").select(
        F.lit(TOP).alias("tree"), F.col("trees").alias("size"), F.col("rank").alias("index"), "digest"
    ), "subroots")
    upper, root = levels(spark, subroots)
    root = root.first()
    return None if root is None else Tree(leaves, nodes.unionByName(upper), root["digest"])


def missing(known: np.ndarray, size: int):
    """(level, index) arrays: the nodes beside the ``known`` ones that give the root of a tree."""
    level, found = 0, []
    while size > 1:
        parents = np.unique(known >> SHIFT)
        brothers = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        brothers = np.setdiff1d(brothers[brothers < size], known, assume_unique=True)
        found.append((np.full(len(brothers), level), brothers))
        known, size, level = parents, -(-size // ARITY), level + 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _coordinates(rows: pa.Table) -> pa.Table:
    """What a partition of leaves has to fetch, in its own tree and in the one above."""
    first = {c: rows.column(c)[0].as_py() for c in ("tree", "part", "size", "rank", "trees")}
    own = missing(np.unique(rows.column("index").to_numpy()), first["size"])
    top = missing(np.array([first["rank"]]), first["trees"])
    number = len(own[0]) + len(top[0])
    return pa.table({
        "tree": pa.array([first["tree"]] * number, pa.string()),
        "part": pa.array([first["part"]] * number, pa.int64()),
        "of": pa.array([first["tree"]] * len(own[0]) + [TOP] * len(top[0]), pa.string()),
        "level": pa.array(np.r_[own[0], top[0]], pa.int32()),
        "index": pa.array(np.r_[own[1], top[1]], pa.int64()),
    })


def derive(known: dict[int, str], fetched: dict, size: int):
    """The root of a tree from some of its leaves and the nodes beside them.

    ``known`` gives the digests of leaves by index, ``fetched`` those of nodes by level and
    index.  Also returns, for each level, what stands left and right of each derived node.
    """
    sides, level = [], 0
    while size > 1:
        here, above = {}, {}
        for parent in {i >> SHIFT for i in known}:
            run = range(parent * ARITY, min(parent * ARITY + ARITY, size))
            digests = [known.get(i) or fetched[level, i] for i in run]
            joined = "".join(digests)
            above[parent] = hashlib.sha256(joined.encode()).hexdigest()
            for k, i in enumerate(run):
                if i in known:
                    here[i] = joined[: 64 * k], joined[64 * k + 64 :]
        sides.append(here)
        known, size, level = above, -(-size // ARITY), level + 1
    return known[0], sides


def _expanded(names: list[str], root: str):
    """A function that makes the proofs of a partition from its leaves and fetched nodes."""

    def path(sides, index):
        return [dict(zip(("left", "right"), here[index >> (SHIFT * level)], strict=True))
                for level, here in enumerate(sides)]

    def run(rows: pa.Table, nodes: pa.Table) -> pa.Table:
        places = list(zip(nodes["level"].to_pylist(), nodes["index"].to_pylist(), strict=True))
        top = np.array([of == TOP for of in nodes["of"].to_pylist()], bool)
        digests = nodes["digest"].to_pylist()
        own = {p: d for p, d, t in zip(places, digests, top, strict=True) if not t}
        upper = {p: d for p, d, t in zip(places, digests, top, strict=True) if t}
        index = rows["index"].to_pylist()
        size, rank, trees = (rows[c][0].as_py() for c in ("size", "rank", "trees"))
        known = dict(zip(index, rows["digest"].to_pylist(), strict=True))
        subroot, sides = derive(known, own, size)
        derived, rest = derive({rank: subroot}, upper, trees)
        if derived != root:
            raise ValueError(f"the nodes fetched for {rows['tree'][0]} do not lead to the root")
        rest = path(rest, rank)
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        out = {n: rows[n] for n in names}
        out["subroot"] = pa.array([subroot] * len(index), pa.string())
        out["proof"] = pa.array([path(sides, i) + rest for i in index], kind)
        return pa.table(out)

    return run


def proofs(spark: SparkSession, tree: Tree, wanted: DataFrame | None = None) -> DataFrame:
    """The rows of ``wanted`` (all or some of ``tree.leaves``) with ``subroot`` and ``proof``.

    A proof has one entry per level from the leaf to the root: the digests left and right of
    the node on its way in its run, joined.
    """
    wanted = tree.leaves if wanted is None else wanted
    names = wanted.columns
    rows = wanted.withColumn("part", F.shiftright("index", SHIFT * PROVED))
    asked = rows.select("tree", "part", "index", "size", "rank", "trees").groupBy("tree", "part")
    asked = asked.applyInArrow(
        _coordinates, "tree string, part long, of string, level int, index long"
    )
    upper = (F.col("level") >= UPPER) | (F.col("of") == TOP)
    asked = asked.withColumn("copy", F.when(upper, F.col("part") % COPIES).otherwise(0).cast("long"))
    nodes = tree.nodes.withColumnRenamed("tree", "of")
    last = F.when(upper, F.lit(COPIES - 1)).otherwise(0).cast("long")
    nodes = nodes.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    fetched = asked.join(nodes, ["of", "level", "index", "copy"]).select(
        "tree", "part", "of", "level", "index", "digest"
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema)
    return rows.groupBy("tree", "part").cogroup(fetched.groupBy("tree", "part")).applyInArrow(
        _expanded(names, tree.root), f"{schema}, subroot string, proof {PATH}"
    )


def siblings_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf to the root."""
    parts = F.transform(proof, lambda p: F.concat(p["left"], p["right"]))
    return F.sha2(F.array_join(parts, ""), 256)


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(
        proof, digest, lambda d, p: F.sha2(F.concat(p["left"], d, p["right"]), 256)
    )


def document_leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, digest and, where a document is tampered with, the digest ``forged``."""
    lowered = F.translate(F.col("text").cast("string"), ascii_uppercase, ascii_lowercase)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    values = [F.col(c) for c in COLUMNS]
    return docs.select(
        tree_name(F.col("lang")).alias("tree"), "doc_id", leaf_digest(*values).alias("digest"),
        F.when(chosen, leaf_digest(*values[:-1], lowered)).alias("forged"),
    )


def merkle_manifest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: its leaf, subroot, root, digest of its proof, and the check of a
    copy in which every third document has its capital letters lowered.
    """
    tree = merkle_tree(spark, document_leaves(docs), ["doc_id", "digest"])
    key = docs.schema["doc_id"].dataType.simpleString()
    if tree is None:
        texts = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
        schema = f"doc_id {key}, " + ", ".join(f"{c} string" for c in texts)
        return spark.createDataFrame([], f"{schema}, verified boolean")
    found = folded(F.coalesce("forged", "digest"), F.col("proof"))
    rows = proofs(spark, tree).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(tree.root).alias("root"),
        siblings_digest(F.col("proof")).alias("proof_sha256"), found.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
