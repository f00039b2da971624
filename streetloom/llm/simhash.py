"""SimHash near-duplicates: pivot distance tables filter the pairs that are verified.

The fingerprint of a text has bit b set if more than half of its shingle hashes have.  Two
fingerprints link when they differ in at most three bits.  Equal fingerprints are one node,
so copies never form pairs.  Of six blocks of bits a linked pair shares at least three, so
nodes meet under the twenty triples of blocks; nothing is lost.  Where nodes meet, a table of
their Hamming distances to many reference fingerprints (pivots) is made: by the triangle
inequality, two nodes whose distances to any pivot differ by more than three cannot link.
Pairs that survive all pivots are verified on the bits.  Large meetings are cut into blocks
of bounded size; each task returns only a spanning forest of the links it found.

Defined results: a null or empty text (or one without words) has the fingerprint zero; a
text of one or two words has one shingle; null doc_ids count only when a component has no
other (its component_id is then null); repeated rows are returned each; an empty table gives
an empty result.  The pipeline's stage keeps the row of smallest doc_id of each component.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.llm.common import qualified, restored, staged
from streetloom.llm.graph import components

SHINGLE = 3
HASH_SEED = 42
#: Linked fingerprints differ in at most so many bits.
RADIUS = 3
#: First bit and width of the blocks; any linked pair is equal on three of six.
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
#: Rows of one meeting that one task compares with each other, times two.
MEETING = 2048
#: Reference fingerprints, drawn from a fixed seed.
PIVOTS = np.random.default_rng(5).integers(0, 2**64, 32, dtype=np.uint64)


def shingle_hashes(body: bytes | None, words: int) -> np.ndarray:
    """The hashes of all shingles of a text given as UTF-8."""
    tokens = (body or b"").lower().split()  # bytes: lowers A-Z, splits at ASCII white space
    if not tokens:
        return np.zeros(0, np.uint64)
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*[tokens[i:] for i in range(words)], strict=False))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, HASH_SEED) for s in shingles), np.uint64)


def fingerprint(body: bytes | None, words: int = SHINGLE) -> int:
    """The fingerprint of a text given as UTF-8, as a signed 64-bit number."""
    return majority(shingle_hashes(body, words))


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have, as a signed 64-bit number."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def _fingerprints(bodies: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(b) for b in bodies], dtype="int64")


def _fingerprint_column(text: Column) -> Column:
    return F.pandas_udf(_fingerprints, "long")(text.cast("binary"))


def _meetings(nodes: DataFrame, size: int = MEETING) -> DataFrame:
    """(key, i, j, fp): nodes that agree on three blocks, in blocks of bounded size."""

    def block(start, width):
        return F.shiftrightunsigned("fp", start).bitwiseAND(F.lit(2**width - 1))

    parts = [block(*b) for b in BLOCKS]
    keys = []
    for k, triple in enumerate(combinations(range(len(BLOCKS)), 3)):
        key = F.lit(k).cast("long")
        for b in triple:
            key = F.shiftleft(key, 11).bitwiseOR(parts[b])
        keys.append(key)
    keyed = nodes.select("fp", F.explode(F.array(*keys)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = keyed.join(shared, "key").withColumn("cuts", F.ceil(F.col("n") / size).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    return rows.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"
    )


def linked_pairs(group: np.ndarray, fps: np.ndarray, radius: int = RADIUS):
    """Index pairs within equal ``group`` (sorted) that differ in at most ``radius`` bits."""
    table = np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    at = np.arange(len(fps))
    shift, found = 0, []
    while len(at):
        shift += 1
        at = at[at + shift < len(fps)]
        at = at[group[at] == group[at + shift]]  # later rows of a group drop out first
        near = at
        for first in range(0, len(PIVOTS), 8):
            gap = np.abs(table[near, first : first + 8] - table[near + shift, first : first + 8])
            near = near[gap.max(axis=1, initial=0) <= radius]
        near = near[np.bitwise_count(fps[near] ^ fps[near + shift]) <= radius]
        found.append(np.stack([near, near + shift], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of the component of each of ``n`` items."""
    root = np.arange(n)
    while len(pairs):
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        before = root.copy()
        np.minimum.at(root, root[pairs[:, 0]], low)
        np.minimum.at(root, root[pairs[:, 1]], low)
        root = root[root]
        if np.array_equal(before, root):
            break
    return root


def _links(batches):
    """Links of the meetings in a sorted partition; a meeting may pass a batch's end."""
    kept: list = []

    def solve(group, fps):
        root = forest(linked_pairs(group, fps), len(fps))
        sons = np.flatnonzero(root != np.arange(len(fps)))
        u, v = fps[sons].view(np.int64), fps[root[sons]].view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def columns(batch):
        return [np.asarray(batch.column(c)) for c in ("key", "i", "j", "fp")]

    for batch in batches:
        if not batch.num_rows:
            continue
        key, i, j, fp = (
            np.concatenate(x) for x in zip(*kept, columns(batch), strict=True)
        )
        new = np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
        group, start = np.cumsum(new), int(np.flatnonzero(new)[-1])
        if start:
            yield solve(group[:start], fp[:start].view(np.uint64))
        kept = [tuple(x[start:] for x in (key, i, j, fp))]
    if kept:
        fp = kept[0][3]
        yield solve(np.zeros(len(fp), np.int64), fp.view(np.uint64))


def links(nodes: DataFrame) -> DataFrame:
    """(u, v): links between distinct fingerprints ``fp`` that keep all components whole."""
    by = ["key", "i", "j"]
    rows = _meetings(nodes).repartition(*by).sortWithinPartitions(*by, "fp")
    return rows.mapInArrow(_links, "u long, v long")


def classes(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(fp, root) of all fingerprints in ``rows``; linked ones have the same root."""
    nodes = staged(spark, rows.select("fp").distinct(), "fingerprints")
    roots = components(spark, links(nodes)).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = docs.select("doc_id", _fingerprint_column(F.col("text")).alias("fp"))
    rows = staged(spark, rows, "simhash")
    roots = staged(spark, classes(spark, rows), "classes")
    smallest = rows.groupBy("fp").agg(F.min("doc_id").alias("m")).join(roots, "fp")
    smallest = smallest.groupBy("root").agg(F.min("m").alias("component_id"))
    named = roots.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representative_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each component, the one of smallest doc_id, with all its columns."""
    renamed, names = qualified(docs.select(*docs.columns, "text", "doc_id"))
    text, doc_id = f"__in{len(docs.columns)}", f"__in{len(docs.columns) + 1}"
    rows = renamed.withColumn("fp", _fingerprint_column(F.col(text))).drop(text)
    rows = staged(spark, rows.withColumn("__rid", F.monotonically_increasing_id()), "simhash")
    roots = classes(spark, rows)
    first = F.min(F.struct(F.col(doc_id).isNull(), doc_id, "__rid"))
    best = rows.groupBy("fp").agg(first.alias("first")).join(roots, "fp")
    best = best.groupBy("root").agg(F.min("first").alias("first")).select("first.__rid")
    # the table of survivors grows with the corpus and is never broadcast
    return restored(rows.join(best.hint("merge"), "__rid", "left_semi"), names[: len(docs.columns)])
