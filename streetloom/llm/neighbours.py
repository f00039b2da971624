"""Approximate nearest neighbours with balanced posting lists.

Centroids are fitted in two levels on a bounded sample, more of them where the sample is
dense, so that lists have similar lengths.  They are searched through an in-memory graph
that links each centroid with its nearest ones.  A vector goes to the list of its nearest
centroid and, near a boundary, to those of other centroids whose distance is not much larger.
A query reads the lists whose centroid's distance is within a ratio of the nearest one's.
How many lists that may be, and the ratio, are fitted to the data: the true neighbours of a bounded
sample of queries are looked up in all rows, and beam and ratio are wide enough for nearly all of
them, whatever the number of lists.
Long lists are cut into parts, and so are the queries of a list; every task compares one
part of each.  Scores are computed on the original vectors in double precision, by one
formula for every pair, so equal vectors tie exactly and the smaller vec_id comes first.
Queries with fewer than k answers are compared with all rows, in blocks.

Bounds: the sample, the centroids and the sampled queries are broadcast; their numbers are
`SAMPLE_PER_LIST`, `MOST_LISTS` and `PROBES` at most.  Every valid vector is in a list, whatever the sample.

Defined results: vectors that are null, zero, of another length than most, or that hold a
null or non-finite component take no part, neither do rows without vec_id; repeated rows are
candidates of their own but never answers to their own vec_id; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetloom.llm.common import staged

#: Vectors per list that are aimed at.
LIST_LENGTH = 200
MOST_LISTS = 16_384
SAMPLE_PER_LIST = 20
#: Lists that the graph search looks at, for vectors and at least for queries.
BEAM = 32
#: Queries whose true neighbours tell how many lists must be read, the share of these neighbours
#: that must be met, and the room beside what the sample needs.
PROBES, MET, ROOM = 256, 0.97, 1.25
#: Distance ratio up to which a vector is replicated, and the largest number of its lists.
BOUNDARY, REPLICAS = 1.1, 4
#: Least distance ratio up to which a query reads lists, and candidates it reads in any case beside
#: further rows of its own vec_id.
REACH, LEAST_READ = 1.35, 64
#: Rows of a list and of its queries that one task compares.
LIST_PART, QUERY_PART = 4096, 512


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _means(x: np.ndarray, k: int, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means; returns unit centroids and the place of each row."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)]
    place = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        for at in range(0, len(x), 8192):
            place[at : at + 8192] = (x[at : at + 8192] @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, place, x)
        norms = np.sqrt((sums * sums).sum(axis=1))
        full = norms > 1e-12
        centres = centres.copy()
        centres[full] = sums[full] / norms[full, None]
    return centres, place


def fit_centroids(sample: np.ndarray, lists: int, seed: int = 3) -> np.ndarray:
    """About ``lists`` unit centroids of the rows of ``sample``, in two levels."""
    x = _unit(sample.astype(np.float64))
    lists = max(1, min(lists, len(x)))
    coarse = max(1, int(np.sqrt(lists)))
    _, place = _means(x, coarse, 8, seed)
    found = []
    for c in range(coarse):
        rows = x[place == c]
        if len(rows):
            # shares by density keep the lists balanced
            k = min(len(rows), max(1, round(lists * len(rows) / len(x))))
            found.append(_means(rows, k, 8, seed + 1 + c)[0])
    return np.concatenate(found)


class CentroidGraph:
    """A graph over unit centroids: near neighbours and a few far links."""

    def __init__(self, centroids: np.ndarray, near: int = 16, far: int = 4):
        n = len(centroids)
        self.points = centroids
        rng = np.random.default_rng(11)
        near = min(near, n)
        rows = []
        for at in range(0, n, 2048):
            likeness = centroids[at : at + 2048] @ centroids.T
            rows.append(np.argpartition(-likeness, near - 1, axis=1)[:, :near])
        self.links = np.hstack([np.concatenate(rows), rng.integers(0, n, (n, far))])
        self.entries = rng.permutation(n)[:BEAM]

    def search(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids of unit rows ``x``, nearest first: ids and likeness.

        A wide beam opens several centroids a step.
        """
        n, rows = len(self.points), np.arange(len(x))[:, None]
        beam = min(beam, n)
        width = max(1, beam // BEAM)
        ids = np.broadcast_to(self.entries, (len(x), len(self.entries)))
        like = x @ self.points[self.entries].T
        met = np.zeros((len(x), n), bool)
        met[:, self.entries] = True
        opened = np.zeros(ids.shape, bool)
        while True:
            order = np.argsort(-like, axis=1, kind="stable")[:, :beam]
            ids, like, opened = ids[rows, order], like[rows, order], opened[rows, order]
            todo = np.flatnonzero(~opened.all(axis=1))
            if not len(todo):
                return ids, like
            # the nearest that were not opened yet
            spot = np.argsort(opened[todo], axis=1, kind="stable")[:, :width]
            fresh = ~opened[todo[:, None], spot]
            opened[todo[:, None], spot] = True
            ahead = self.links[ids[todo[:, None], spot]]
            fresh = np.repeat(fresh, ahead.shape[2], axis=1)
            ahead = ahead.reshape(len(todo), -1)
            new = fresh & ~met[todo[:, None], ahead] & _first_in_row(ahead, fresh)
            at, place = np.nonzero(new)
            met[todo[at], ahead[at, place]] = True
            value = np.full((len(x), ahead.shape[1]), -np.inf)
            found = np.einsum("rd,rld->rl", x[todo], self.points[ahead])
            value[todo] = np.where(new, found, -np.inf)
            spread = np.zeros((len(x), ahead.shape[1]), np.int64)
            spread[todo] = ahead
            ids = np.hstack([ids, spread])
            like = np.hstack([like, value])
            opened = np.hstack([opened, ~np.isfinite(value)])


def _first_in_row(values: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """True at the first counted place of each value in its row."""
    keys = 2 * values + ~counted
    order = np.argsort(keys, axis=1, kind="stable")
    ordered = np.take_along_axis(values, order, axis=1)
    first = np.ones(values.shape, bool)
    first[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    out = np.empty(values.shape, bool)
    np.put_along_axis(out, order, first, axis=1)
    return out & counted


def _distance(like: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * like, 0))


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def valid_vectors(table: DataFrame) -> DataFrame:
    """Rows (rid, vec_id, v) with usable vectors of the usual length."""
    fine = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    ) & F.exists("embedding", lambda x: x != 0)
    rows = table.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    usual = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = usual.orderBy(F.desc("n"), "d").first()
    length = usual["d"] if usual else 0
    return rows.where(F.size("embedding") == length).select(
        F.monotonically_increasing_id().alias("rid"), "vec_id", F.col("embedding").alias("v")
    )


def _postings(
    rows: DataFrame, index, ratio: float, most: int, sizes=None, beam: int = BEAM
) -> DataFrame:
    """Rows with ``list``: one per list that a vector goes to (or, with sizes, reads).

    With sizes, a fourth column ``own`` counts the rows of the query's vec_id.
    """
    step = max(1, 1024 * BEAM // beam)

    def run(batches):
        graph, counts = index.value, None if sizes is None else sizes.value
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = _unit(_vectors(part.column(2)).astype(np.float64))
                ids, like = graph.search(x, beam)
                far = _distance(like)
                use = far <= ratio * far[:, :1] + 1e-12
                use[:, most:] = False
                if counts is not None:
                    read = np.cumsum(counts[ids], axis=1)
                    own = np.asarray(part.column(3))[:, None]
                    least = LEAST_READ + REPLICAS * np.maximum(own - 1, 0)
                    use |= np.hstack([np.ones((len(x), 1), bool), read[:, :-1] < least])
                r, c = np.nonzero(use)
                taken = part.take(pa.array(r, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns[:3], pa.array(ids[r, c], pa.int64())],
                    names=["rid", "vec_id", "v", "list"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(
        run, f"rid long, vec_id {kinds['vec_id']}, v {kinds['v']}, list long"
    )


def _best(query: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest of ``vectors`` for each of ``query``, scored by one formula."""
    q = np.stack(query["v"].to_numpy()).astype(np.float64)
    v = np.stack(vectors["v"].to_numpy()).astype(np.float64)
    q_norm, v_norm = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    ids, rid = vectors["vec_id"].to_numpy(), vectors["rid"].to_numpy()
    rough = (q / q_norm[:, None]) @ (v / v_norm[:, None]).T
    rough[query["vec_id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
    edge = -np.partition(-rough, min(k, len(v)) - 1, axis=1)[:, min(k, len(v)) - 1]
    out = []
    for i in range(len(q)):
        near = np.flatnonzero((rough[i] >= edge[i] - 1e-9) & np.isfinite(rough[i]))
        score = (v[near] * q[i]).sum(axis=1) / (v_norm[near] * q_norm[i])
        best = np.lexsort((rid[near], ids[near], -score))[:k]
        out.append(
            pd.DataFrame(
                {
                    "q_rid": query["rid"].iloc[i], "query_id": query["vec_id"].iloc[i],
                    "rid": rid[near[best]], "vec_id": ids[near[best]], "score": score[best],
                }
            )
        )
    return pd.concat(out, ignore_index=True)


def _true_neighbours(rows: DataFrame, probes, k: int) -> DataFrame:
    """Rows (probe, rid): the ``k`` nearest rows of each probe, by comparison with all."""

    def run(batches):
        own, x = probes.value
        best = [np.empty((len(x), 0)), np.empty((len(x), 0), np.int64)]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ids = part.column(1).to_numpy(zero_copy_only=False)
                like = x @ _unit(_vectors(part.column(2)).astype(np.float64)).T
                like[own[:, None] == ids[None, :]] = -np.inf
                rid = np.broadcast_to(part.column(0).to_numpy(), like.shape)
                like, rid = np.hstack([best[0], like]), np.hstack([best[1], rid])
                top = np.argsort(-like, axis=1, kind="stable")[:, :k]
                best = [np.take_along_axis(v, top, axis=1) for v in (like, rid)]
        probe, place = np.nonzero(np.isfinite(best[0]))
        columns = probe, best[0][probe, place], best[1][probe, place]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["probe", "score", "rid"])

    found = rows.select("rid", "vec_id", "v").mapInArrow(run, "probe long, score double, rid long")
    order = Window.partitionBy("probe").orderBy(F.desc("score"), "rid")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("probe", "rid")


def _spread(spark, rows, posted, asked, graph: CentroidGraph, k: int) -> tuple[int, float]:
    """Beam and distance ratio that meet `MET` of the true neighbours of a sample of queries."""
    sample = asked.orderBy(F.xxhash64("rid", "vec_id"), "rid").limit(PROBES).select("vec_id", "v").toArrow()
    if not sample.num_rows:
        return BEAM, REACH
    own = sample["vec_id"].to_numpy()
    x = _unit(_vectors(sample["v"].combine_chunks()).astype(np.float64))
    truth = _true_neighbours(rows, spark.sparkContext.broadcast((own, x)), k)
    truth = staged(spark, truth, "truth")  # k rows per sampled query
    held = posted.select("rid", "list").join(F.broadcast(truth), "rid").collect()
    order = np.argsort(-(x @ graph.points.T), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
    needed: dict[tuple[int, int], int] = {}
    for row in held:
        key = row["probe"], row["rid"]
        rank = int(place[row["probe"], row["list"]])
        needed[key] = min(rank, needed.get(key, rank))
    if not needed:
        return BEAM, REACH
    far = _distance(np.take_along_axis(x @ graph.points.T, order, axis=1))
    ratios = [far[p, rank] / max(far[p, 0], 1e-9) for (p, _), rank in needed.items()]
    ranks = np.quantile(list(needed.values()), MET, method="higher")
    beam = int(min(len(graph.points), max(BEAM, ROOM * (ranks + 1))))
    # ratios of queries that lie on a centroid say nothing; those read the least number of rows
    near = [r for r, (p, _) in zip(ratios, needed, strict=True) if far[p, 0] > 1e-6]
    reach = np.quantile(near, MET, method="higher") if near else REACH
    return beam, float(max(REACH, reach))


def nearest(
    spark: SparkSession, table: DataFrame, queries: DataFrame, k: int = 5
) -> DataFrame:
    """The ``k`` nearest rows of ``table`` for each row of ``queries`` (both vec_id, embedding).

    Returns query_id, rank, vec_id, score; a row never answers a query of its own vec_id.
    """
    rows = staged(spark, valid_vectors(table), "vectors")
    asked = staged(spark, valid_vectors(queries), "queries")
    n = rows.count()
    lists = max(1, min(MOST_LISTS, n // LIST_LENGTH))
    sample = rows.orderBy(F.xxhash64("rid", "vec_id"), "rid").limit(lists * SAMPLE_PER_LIST)
    sample = sample.select("v").toArrow()["v"].combine_chunks()
    kind = rows.schema["vec_id"].dataType.simpleString()
    result = f"q_rid long, query_id {kind}, rid long, vec_id {kind}, score double"
    if not n:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    graph = CentroidGraph(fit_centroids(_vectors(sample), lists))
    index = spark.sparkContext.broadcast(graph)
    posted = staged(spark, _postings(rows, index, BOUNDARY, REPLICAS), "postings")
    sizes = posted.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    sizes = staged(spark, sizes, "lists")
    counts = np.zeros(len(graph.points), np.int64)
    for row in sizes.toLocalIterator():  # one row per centroid, their number is bounded
        counts[row["list"]] = row["n"]
    own = rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("own"))
    counted = asked.join(own, "vec_id", "left").select(
        "rid", "vec_id", "v", F.coalesce("own", F.lit(0)).alias("own")
    )
    beam, reach = _spread(spark, rows, posted, asked, graph, k)
    read = _postings(counted, index, reach, beam, spark.sparkContext.broadcast(counts), beam)
    read = staged(spark, read, "reads")
    reads = read.groupBy("list").agg(F.count(F.lit(1)).alias("m"))
    cuts = sizes.join(reads, "list").select(
        "list", F.ceil(F.col("n") / LIST_PART).cast("int").alias("parts"),
        F.ceil(F.col("m") / QUERY_PART).cast("int").alias("blocks"),
    )

    def dealt(df, own, own_count, other, other_count):
        df = df.join(cuts, "list").withColumn(
            own, F.pmod(F.xxhash64("rid"), F.col(own_count)).cast("int")
        )
        every = F.explode(F.sequence(F.lit(0), F.col(other_count) - 1))
        return df.withColumn(other, every).select("list", "part", "block", "rid", "vec_id", "v")

    by = ["list", "part", "block"]
    left = dealt(read, "block", "blocks", "part", "parts").groupBy(*by)
    right = dealt(posted, "part", "parts", "block", "blocks").groupBy(*by)

    def compare(query, vectors):
        if query.empty or vectors.empty:
            return pd.DataFrame(columns=["q_rid", "query_id", "rid", "vec_id", "score"])
        return _best(query, vectors, k)

    found = staged(spark, left.cogroup(right).applyInPandas(compare, result).distinct(), "found")
    answers = found.groupBy(F.col("q_rid").alias("rid")).agg(F.count(F.lit(1)).alias("m"))
    short = staged(spark, asked.join(answers, "rid", "left").where(f"coalesce(m, 0) < {k}"), "short")
    # equal queries are compared once
    once = short.groupBy("vec_id", "v").agg(F.min("rid").alias("rid"))
    once = staged(spark, once.select("rid", "vec_id", "v"), "once")
    asks = once.count()
    if asks:
        blocks, parts = -(-asks // QUERY_PART), -(-n // LIST_PART)

        def spread(df, own, own_count, other, other_count):
            df = df.withColumn(own, F.pmod(F.xxhash64("rid"), F.lit(own_count)).cast("int"))
            return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_count - 1))))

        left = spread(once, "block", blocks, "part", parts).groupBy("part", "block")
        right = spread(rows, "part", parts, "block", blocks).groupBy("part", "block")
        exact = left.cogroup(right).applyInPandas(compare, result)
        same = short.select(F.col("rid").alias("__rid"), "vec_id", "v").join(
            once.select(F.col("rid").alias("q_rid"), "vec_id", "v"), ["vec_id", "v"]
        ).select("__rid", "q_rid")
        exact = exact.join(same, "q_rid").select(
            F.col("__rid").alias("q_rid"), "query_id", "rid", "vec_id", "score"
        )
        found = found.unionByName(exact).dropDuplicates(["q_rid", "rid"])
    order = Window.partitionBy("q_rid").orderBy(F.desc("score"), "vec_id", "rid")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
