"""Hard negatives by shared lists: anchors in clusters, candidates sorted once per cluster by an angular upper bound.

No score of a cluster's members with a candidate exceeds |member| |candidate| cos(max(0, angle between candidate and
centre - radius of the cluster)). A batch of candidates is sorted by that bound once for each cluster; all members walk
the one list together, and a member leaves as soon as the bound of the next candidate, and so of all behind it, is below
every score it still needs. What is left out is proven to be no result.

Anchors are taken in blocks of bounded size; each block is clustered, handed to the tasks, and walked against all
candidates where they lie, first for the positives, then for the negatives in the score windows these set. Only best
lists leave a task: no pairs, no shuffle of candidates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from boxweave.runtime import cut_lineage

# Anchors that are clustered and handed to the tasks together: bounds what the driver and a task hold.
BLOCK_ANCHORS = 8_192
# Components all anchors of a block have together at most (32 MB), for very long vectors.
BLOCK_COMPONENTS = 1 << 22
MEMBERS = 128
ROUNDS = 8
STRIDE = 512
EXACT = float(1 << 53)
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, q): one row per id, q = floor(scale * component) as whole numbers.

    Rows with a null id, label or vector, or with any null or non-finite component, take no part. Of several rows with
    one id the one with the smallest label, then the smallest vector, stays. An empty vector scores 0 with every other.
    """
    x = lambda c: c.cast("double")
    usable = vectors.where(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda c: F.coalesce(~F.isnan(x(c)) & (F.abs(x(c)) < F.lit(float("inf"))), F.lit(False)))
    )
    rows = usable.select("vec_id", F.struct("label", F.transform("embedding", lambda c: F.floor(x(c) * scale).cast("long")).alias("q")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", F.col("row.label").alias("label"), F.col("row.q").alias("q"))


def _matrix(q: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers as doubles, shorter ones ended by zeros."""
    lengths = np.diff(q.offsets.to_numpy())
    flat = q.values.to_numpy(zero_copy_only=False)[q.offsets[0].as_py() : q.offsets[-1].as_py()]
    wide = np.zeros((len(q), max(width, int(lengths.max(initial=0)))))
    wide[np.arange(wide.shape[1])[None, :] < lengths[:, None]] = flat
    return wide


def _units(x: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return x / np.where(norms > 0, norms, 1.0)[:, None]


class Cluster:
    """Members with one centre, and the angle within which all of them lie."""

    def __init__(self, index: np.ndarray, x: np.ndarray, norms: np.ndarray, centre: np.ndarray):
        self.index, self.x, self.norms, self.centre = index, x, norms, centre
        cosines = np.where(norms > 0, _units(x, norms) @ centre, 1.0)
        self.radius = float(np.arccos(np.clip(cosines, -1.0, 1.0)).max(initial=0.0)) + 1e-7

    def bounds(self, x: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Upper bound of the score with a member of length 1, generous to rounding."""
        angles = np.arccos(np.clip(_units(x, norms) @ self.centre, -1.0, 1.0))
        return norms * (np.cos(np.maximum(0.0, angles - self.radius)) + 1e-9)


def clustered(x: np.ndarray, members: int = MEMBERS) -> list[Cluster]:
    """Directions grouped by spherical k-means from evenly spaced starts; a crowded cluster is one list all the same."""
    norms = np.sqrt(np.square(x).sum(axis=1))
    units = _units(x, norms)
    k = max(1, math.ceil(len(x) / members))
    centres = units[np.linspace(0, len(x) - 1, k).astype(int)]
    home = np.zeros(len(x), int)
    for _ in range(ROUNDS):
        home = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, units)
        lengths = np.sqrt(np.square(sums).sum(axis=1))
        centres = np.where(lengths[:, None] > 0, sums / np.where(lengths > 0, lengths, 1.0)[:, None], centres)
    home = (units @ centres.T).argmax(axis=1)
    groups = (np.nonzero(home == c)[0] for c in range(k))
    return [Cluster(g, x[g], norms[g], centres[home[g[0]]]) for g in groups if len(g)]


class Best:
    """The ``k`` best (score, smaller id first) of every key; ``least`` is what a newcomer must reach."""

    def __init__(self, k: int, floor: np.ndarray):
        self.k, self.floor, self.least = k, floor, floor.copy()
        self.key, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(key)
        old = np.isin(self.key, touched)
        k, s, i = (np.concatenate([a[old], b]) for a, b in ((self.key, key), (self.score, score), (self.id, ids)))
        order = np.lexsort((i, -s, k))
        k, s, i = k[order], s[order], i[order]
        first = np.searchsorted(k, k)
        rank = np.arange(len(k)) - first
        full = k[rank == self.k - 1]
        self.least[full] = np.maximum(self.floor[full], s[rank == self.k - 1])
        stay = rank < self.k
        self.key, self.score, self.id = (np.concatenate([a[~old], b[stay]]) for a, b in ((self.key, k), (self.score, s), (self.id, i)))


class Block:
    """A bounded set of anchors in clusters, and per anchor the score windows in which its best are wanted."""

    def __init__(self, ids, labels, x, low: np.ndarray, high: np.ndarray, same_label: bool, k: int):
        self.ids, self.labels, self.low, self.high, self.same, self.k = ids, labels, low, high, same_label, k
        self.clusters, self.width = clustered(x), x.shape[1]

    def walk(self, cluster: Cluster, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, norms: np.ndarray, best: Best) -> None:
        """All members along the one sorted list until each is certified to need nothing further.

        ``best`` has a key for every member and window, in this order.
        """
        bounds = cluster.bounds(x, norms)
        order = np.argsort(-bounds, kind="stable")
        windows = self.low.shape[1]
        active = np.arange(len(cluster.index))
        for start in range(0, len(order), STRIDE):
            needed = best.least.reshape(-1, windows)[active].min(axis=1)
            active = active[bounds[order[start]] * cluster.norms[active] * (1 + 1e-9) + 1e-6 >= needed]
            if not len(active):
                return
            rows, some = cluster.index[active], order[start : start + STRIDE]
            scores = _products(cluster.x[active], x[some], cluster.norms[active], norms[some])
            fits = (self.labels[rows][:, None] == labels[some][None, :]) == self.same
            fits &= self.ids[rows][:, None] != ids[some][None, :]
            for w in range(windows):
                keys = active * windows + w
                i, j = np.nonzero(fits & (scores >= best.least[keys][:, None]) & (scores <= self.high[rows, w][:, None]))
                if len(i):
                    best.add(keys[i], scores[i, j].astype(np.int64), ids[some][j])


def _products(a: np.ndarray, b: np.ndarray, a_norms: np.ndarray, b_norms: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles where no sum can pass 2^53, else in Python's integers."""
    if a_norms.max(initial=0.0) * b_norms.max(initial=0.0) < EXACT / 2:
        return a @ b.T
    return np.array([[sum(int(p) * int(q) for p, q in zip(u, v) if p and q) for v in b] for u in a], dtype=object).astype(np.int64)


def _walk_all(rows: DataFrame, block: Block) -> DataFrame:
    """(anchor_id, window, candidate_id, score): each task's best for every anchor and window of the block."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        lists = [Best(block.k, block.low[c.index].reshape(-1)) for c in block.clusters]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(2), block.width)
            if x.shape[1] > block.width:
                clusters = [Cluster(c.index, _wider(c.x, x.shape[1]), c.norms, _wider(c.centre[None], x.shape[1])[0]) for c in block.clusters]
            else:
                clusters = block.clusters
            norms = np.sqrt(np.square(x).sum(axis=1))
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for cluster, best in zip(clusters, lists):
                block.walk(cluster, ids, labels, x, norms, best)
        for cluster, best in zip(block.clusters, lists):
            member, window = np.divmod(best.key, block.low.shape[1])
            columns = [block.ids[cluster.index[member]], window.astype(np.int32), best.id, best.score]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "window", "candidate_id", "score"])

    return rows.mapInArrow(run, "anchor_id long, window int, candidate_id long, score long")


def _wider(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best over all tasks, ranked from 1."""
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "candidate_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, block: int = BLOCK_ANCHORS
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, label, q) rows.

    The positives of an anchor are its best other rows of its label; the negatives of a positive the best rows of other
    labels whose score is between ``least`` and ``most`` percent of the positive's. Higher scores come first, ties by
    smaller id. Anchors without positives, and positives without such rows, have no result; nor has an empty table.
    Vectors of different lengths count as ended by zeros. Scores have to fit in 64 bits. ``vectors`` is read twice for
    every ``block`` anchors; blocks are cut by id, none drawn or left out.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(vectors.select("vec_id", F.col("label").cast("long").alias("label"), "q"), "vectors")
    anchors = rows.where(is_anchor)
    count, longest = anchors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    size = max(1, min(block, BLOCK_COMPONENTS // max(1, longest)))
    results, after = [], None
    for _ in range(math.ceil(count / size)):
        # At most ``size`` rows of at most BLOCK_COMPONENTS numbers together, whatever the number of anchors.
        some = (anchors if after is None else anchors.where(F.col("vec_id") > after)).orderBy("vec_id").limit(size).toArrow().combine_chunks()
        after = some.column("vec_id")[-1].as_py()
        ids, labels = (some.column(c).to_numpy() for c in ("vec_id", "label"))
        x = _matrix(some.column("q").combine_chunks(), longest)
        every = np.full((len(ids), 1), LOWEST), np.full((len(ids), 1), HIGHEST)
        near = _ranked(_walk_all(rows, Block(ids, labels, x, *every, True, positives)), positives).toArrow()
        place, rank = np.searchsorted(ids, near.column("anchor_id").to_numpy()), near.column("rank").to_numpy() - 1
        score = near.column("score").to_numpy().astype(object)
        low, high = np.full((len(ids), positives), HIGHEST), np.full((len(ids), positives), LOWEST)
        low[place, rank], high[place, rank] = -((-least * score) // 100), (most * score) // 100
        low[low > high] = HIGHEST
        hard = _ranked(_walk_all(rows, Block(ids, labels, x, low, high, False, negatives)), negatives)
        chosen = spark.createDataFrame(near).select(
            "anchor_id", (F.col("rank") - 1).alias("window"), F.col("candidate_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        hard = hard.join(F.broadcast(chosen), ["anchor_id", "window"]).select(
            "anchor_id", "positive_id", "rank", F.col("candidate_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        results.append(cut_lineage(hard, "negatives"))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return reduce(DataFrame.unionByName, results, spark.createDataFrame([], schema))
