"""Exact near search: a tree of cells in which every close pair meets once, and blockwise comparison of each cell.

A cell above its limit draws anchors from its own rows. A row goes to the child cell of its nearest anchor, its home,
and is copied to an earlier child only where the bisector between the two anchors is within the reach, which no closer
pair can violate. So a pair meets in the earlier of its two homes, level by level, and nowhere else with one of them at
home on each. Cells are split until they fit; one that splitting does not make cheaper to compare stays as it is. No
table here is collected: anchors reach their cell's rows by a join, and both in chunks of bounded size. Children are
counted before any row is copied, so only cells that are split are ever held more than once. Comparisons go by slices
of bounded size, and what they find leaves the task slice by slice, as pairs or as one row per vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import product as product_of

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from boxweave.functions.ranking import first_k, seeded
from boxweave.runtime import cut_lineage, small_side

CELL_ROWS = 8_000
BLOCK_ROWS = 16_000
CHUNK_ROWS = 4_000
# Distances of one slice of a comparison, and numbers in the vectors of the pairs whose distance is taken exactly at once.
SLICE = 1 << 20
EXACT_NUMBERS = 1 << 18
# Columns of a slice in single precision, a multiple of eight.
SLICE_COLUMNS = 2_048
# Pairs handed on at once.
PIECE_ROWS = 1 << 16
ANCHORS = 64
MAX_DEPTH = 30


def matrix(vectors) -> np.ndarray:
    return np.asarray([np.asarray(v, dtype=np.float64) for v in vectors]).reshape(len(vectors), -1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distance of each row pair, summed the same way wherever it is computed."""
    return np.sqrt(np.square(x - y).sum(axis=1))


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances by matrix product: fast, exact up to ``slack``."""
    return np.maximum(np.square(x).sum(axis=1)[:, None] + np.square(y).sum(axis=1)[None, :] - 2.0 * x @ y.T, 0.0)


def slack(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bound on the rounding of ``squares`` per row of ``x``, generous by several digits."""
    return 1e-9 * (1.0 + np.square(x).sum(axis=1) + np.square(y).sum(axis=1).max())[:, None]


def child_cells(x: np.ndarray, points: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, child, is home) of every row's home and of the earlier cells it is copied to."""
    apart, room = squares(x, points), slack(x, points)
    home = apart.argmin(axis=1)
    gaps = np.sqrt(squares(points, points))
    near = apart - apart[np.arange(len(x)), home][:, None] <= 2 * gaps[home] * reach + room
    near &= np.arange(len(points))[None, :] < home[:, None]
    near[np.arange(len(x)), home] = True
    row, child = np.nonzero(near)
    return row, child, child == home[row]


def _anchored(level: DataFrame, big: DataFrame):
    """Rows of the ``big`` cells in chunks, and the anchors of their cell for each chunk."""
    chunked = big.withColumn("chunks", F.ceil(F.col("n") / F.lit(float(CHUNK_ROWS))).cast("int"))
    rows = level.join(chunked, "cell").withColumn("chunk", F.expr("pmod(xxhash64(key), chunks)").cast("int"))
    drawn = first_k(level.join(big, "cell", "left_semi").select("cell", "draw", "key", "vec"), ["cell"], ["draw", "key"], ANCHORS)
    packs = drawn.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("rn", "vec"))).alias("anchors"))
    packs = packs.join(chunked, "cell").select("cell", F.col("anchors.vec").alias("anchors"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    return rows.select("key", "vec", "draw", "cell", "away", "chunk"), cut_lineage(packs, "anchors")


def _counted(rows: DataFrame, packs: DataFrame, reach: float) -> DataFrame:
    """(from, cell, m): how many rows of a chunk each child cell would get; no row leaves a task."""

    def count(rows: pd.DataFrame, pack: pd.DataFrame) -> pd.DataFrame:
        _, child, _ = child_cells(matrix(rows["vec"].tolist()), matrix(pack["anchors"].iloc[0]), reach)
        number, m = np.unique(child, return_counts=True)
        parent = rows["cell"].iloc[0]
        return pd.DataFrame({"from": parent, "cell": [f"{parent}.{i}" for i in number], "m": m})

    return rows.groupBy("cell", "chunk").cogroup(packs.groupBy("cell", "chunk")).applyInPandas(count, "from string, cell string, m long")


def _split(rows: DataFrame, packs: DataFrame, depth: int, reach: float) -> DataFrame:
    """Rows in their child cells."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def place(rows: pd.DataFrame, pack: pd.DataFrame) -> pd.DataFrame:
        row, child, at_home = child_cells(matrix(rows["vec"].tolist()), matrix(pack["anchors"].iloc[0]), reach)
        out = rows.iloc[row].reset_index(drop=True)
        out["cell"] = [f"{c}.{i}" for c, i in zip(out["cell"], child)]
        out["away"] = (out["away"].to_numpy() | np.where(at_home, 0, 1 << depth)).astype("int32")
        return out[["key", "vec", "draw", "cell", "away"]]

    schema = f"key {kinds['key']}, vec {kinds['vec']}, draw string, cell string, away int"
    return rows.groupBy("cell", "chunk").cogroup(packs.groupBy("cell", "chunk")).applyInPandas(place, schema)


def build(items: DataFrame, reach: float, seed: int, limit: int | None = None) -> DataFrame:
    """(key, vec, draw, cell, away) rows of distinct (key, vec): the cells in which pairs closer than ``reach`` meet.

    ``away`` has a bit for every level on which the row is not at home; a pair counts where no bit is in both.
    """
    limit = limit or CELL_ROWS
    whole = items.select("key", "vec", seeded(seed, "key").alias("draw"), F.lit("").alias("cell"), F.lit(0).alias("away"))
    level, leaves = cut_lineage(whole, "cells"), []
    for depth in range(MAX_DEPTH):
        sizes = level.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        big = cut_lineage(sizes.where(F.col("n") > limit), "big")
        if big.isEmpty():
            break
        rows, packs = _anchored(level, big)
        # Comparing the children must be cheaper by half, or the cell stays whole.
        m = F.col("m").cast("double")
        work = _counted(rows, packs, reach).groupBy("from", "cell").agg(F.sum(m).alias("m")).groupBy(F.col("from").alias("cell")).agg(F.sum(m * m).alias("work"))
        cheaper = work.join(big, "cell").where(F.col("work") * 2 <= F.col("n").cast("double") * F.col("n")).select("cell")
        cheaper = cut_lineage(cheaper, "split")
        leaves.append(level.join(cheaper, "cell", "left_anti"))
        if cheaper.isEmpty():
            return _union(leaves)
        level = cut_lineage(_split(*(x.join(cheaper, "cell", "left_semi") for x in (rows, packs)), depth, reach), "cells")
    leaves.append(level)
    return _union(leaves)


def _union(leaves: list[DataFrame]) -> DataFrame:
    columns = ["key", "vec", "draw", "cell", "away"]
    return leaves[0].select(columns) if len(leaves) == 1 else cut_lineage(reduce(DataFrame.unionByName, [x.select(columns) for x in leaves]), "cells")


def blocked(rows: DataFrame, block_rows: int) -> DataFrame:
    """Adds block, n0 and n1: each side of a cell in as many blocks as keep one near ``block_rows``.

    Cells are few, and one that stays whole may hold most rows: joined by shuffle it would go through one task.
    """
    sizes = rows.groupBy("cell").agg(
        *[F.ceil(F.count_if(F.col("side") == s) / F.lit(float(block_rows))).cast("int").alias(f"n{s}") for s in (0, 1)]
    )
    return rows.join(small_side(sizes), "cell").withColumn("block", F.expr("pmod(xxhash64(key), case when side = 0 then n0 else n1 end)").cast("int"))


def _screened(x: np.ndarray, y: np.ndarray, threshold: float, margin: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, sure) of row pairs whose product in single precision is within ``margin`` of the threshold's, or above: sure then.

    One product gives x.y - |x|**2/2 - |y|**2/2, which is half the squared distance, negative.
    """
    width = min(SLICE_COLUMNS, -(-len(y) // 8) * 8)
    columns = -(-len(y) // width) * width
    left, right = np.ones((len(x), x.shape[1] + 2), np.float32), np.zeros((x.shape[1] + 2, columns), np.float32)
    left[:, :-2], left[:, -1] = x, -np.square(x).sum(axis=1) / 2
    right[:-2, : len(y)], right[-2, : len(y)], right[-2, len(y) :], right[-1] = y.T, -np.square(y).sum(axis=1) / 2, -1e38, 1
    rows = max(1, SLICE // width)
    product, mask = np.empty((rows, width), np.float32), np.empty((rows, width), bool)
    for start, first in product_of(range(0, len(x), rows), range(0, columns, width)):
        n = min(rows, len(x) - start)
        np.matmul(left[start : start + n], right[:, first : first + width], out=product[:n])
        np.greater_equal(product[:n], np.float32(-(threshold**2) / 2 - margin), out=mask[:n])
        # Eight marks at a time: hardly any are set.
        words = np.flatnonzero(mask[:n].reshape(-1).view(np.uint64))
        word, bit = np.nonzero(mask[:n].reshape(-1, 8)[words])
        flat = words[word] * 8 + bit
        yield flat // width + start, flat % width + first, product[:n].reshape(-1)[flat] > np.float32(-(threshold**2) / 2 + margin)


def _single_margin(x: np.ndarray, y: np.ndarray, threshold: float) -> float | None:
    """Bound on the rounding of a product of ``_screened``, doubled; none where single precision would decide too little."""
    lengths = np.square(x).sum(axis=1).max() + np.square(y).sum(axis=1).max()
    margin = 2.0**-23 * (x.shape[1] + 8) * lengths + x.shape[1] * 1e-37
    return margin if lengths < 1e30 and 100 * margin <= threshold**2 else None


def close_rows(x: np.ndarray, y: np.ndarray, threshold: float, allowed=None, measured: bool = True):
    """(i, j, distance) of row pairs closer than the threshold, piece by piece; ``allowed(i, j)`` narrows them.

    Unless ``measured``, pairs that are close beyond doubt come without their distance, as None for the piece.
    """
    pairs = max(1, EXACT_NUMBERS // max(1, x.shape[1]))
    margin = _single_margin(x, y, threshold) if len(x) and len(y) else None
    if margin is None:
        yield from _close_rows(x, y, threshold, allowed, pairs)
        return
    for i, j, certain in _screened(x, y, threshold, margin):
        if allowed is not None:
            fits = allowed(i, j)
            i, j, certain = i[fits], j[fits], certain[fits]
        if not measured:
            yield i[certain], j[certain], None
            i, j = i[~certain], j[~certain]
        for at in range(0, len(i), pairs):
            some, other = i[at : at + pairs], j[at : at + pairs]
            apart = distances(x[some], y[other])
            sure = apart < threshold
            yield some[sure], other[sure], apart[sure]


def _close_rows(x: np.ndarray, y: np.ndarray, threshold: float, allowed, pairs: int):
    """As ``close_rows``, screened in double precision."""
    rows = max(1, SLICE // max(1, len(y)))
    lengths, turned = np.square(y).sum(axis=1)[None, :] / 2, np.ascontiguousarray(y.T)
    for start in range(0, len(x) if len(y) else 0, rows):
        part = x[start : start + rows]
        # As squares(part, y) <= threshold**2 + slack(part, y), in place.
        product = part @ turned
        product -= lengths
        i, j = np.nonzero(product >= (np.square(part).sum(axis=1)[:, None] - threshold**2 - slack(part, y)) / 2)
        if allowed is not None:
            fits = allowed(i + start, j)
            i, j = i[fits], j[fits]
        for at in range(0, len(i), pairs):
            some, other = i[at : at + pairs], j[at : at + pairs]
            apart = distances(part[some], y[other])
            sure = apart < threshold
            yield some[sure] + start, other[sure], apart[sure]


def _dealt(blocks: DataFrame):
    """Blocks by cell and pair of blocks, in a fixed number of tasks: they hold few bytes for the work they make, so they
    would be put together, or left together by cell alone where they are so already."""
    keys = ("cell", "block", "other")
    return blocks.repartition(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).groupBy(*keys)


def _sides(batches: Iterator[pd.DataFrame], same: bool) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    """The two blocks of a group, and whether they are one."""
    group = pd.concat(list(batches), ignore_index=True)
    first, second = group["block"].iloc[0], group["other"].iloc[0]
    if same:
        return group[group["b"] == first], group[group["b"] == second], first == second
    return group[group["side"] == 0], group[group["side"] == 1], False


def _pieces(met: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """The same rows in fewer pieces, of ``PIECE_ROWS`` or little more."""
    held, n = [], 0
    for piece in met:
        held, n = [*held, piece], n + len(piece[0])
        if n >= PIECE_ROWS:
            yield tuple(map(np.concatenate, zip(*held)))
            held, n = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _compare(blocks: DataFrame, threshold: float, same: bool) -> DataFrame:
    """(a, b, distance) of the confirmed pairs, one cell and block pair per task call."""
    kind = blocks.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right, one = _sides(batches, same)
        x_key, y_key, x_away, y_away = (side[c].to_numpy() for c in ("key", "away") for side in (left, right))
        # Places in seeded order.
        place = np.empty(len(left) + len(right), np.int64)
        draws, keys = (np.concatenate([left[c].to_numpy(), right[c].to_numpy()]) for c in ("draw", "key"))
        place[np.lexsort((keys, draws))] = np.arange(len(place))
        x_place, y_place = place[: len(left)], place[len(left) :]
        met = close_rows(matrix(left["vec"].tolist()), matrix(right["vec"].tolist()), threshold, lambda i, j: x_away[i] & y_away[j] == 0)
        for i, j, apart in _pieces(met) if len(left) and len(right) else ():
            a, b = x_key[i], y_key[j]
            keep = a != b
            if same:
                later = x_place[i] > y_place[j]
                if one:
                    keep &= ~later
                a, b = np.where(later, b, a), np.where(later, a, b)
            yield pd.DataFrame({"a": a[keep], "b": b[keep], "distance": apart[keep].astype(float)})

    return _dealt(blocks).applyInPandas(run, f"a {kind}, b {kind}, distance double")


def _block_pairs(cells: DataFrame, block_rows: int, *extra: str) -> DataFrame:
    rows = blocked(cells.withColumn("side", F.lit(0)), block_rows)
    return rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n0") - 1))).select(
        "cell", "key", "draw", "vec", "away", *extra, F.col("block").alias("b"),
        F.least("block", "o").alias("block"), F.greatest("block", "o").alias("other"),
    )


def pairs_within(cells: DataFrame, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every pair closer than the threshold, which is at most the reach of the cells; a before b in seeded order."""
    return _compare(_block_pairs(cells, block_rows), threshold, True)


def join_roots(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Lets ``root`` name the smallest node of each component once nodes ``i`` and ``j`` are linked as well."""
    while True:
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
        if not len(i):
            return
        np.minimum.at(root, np.maximum(root[i], root[j]), np.minimum(root[i], root[j]))
        while (root[root] != root).any():
            root[:] = root[root]


def links_within(cells: DataFrame, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links between the rows of ``cells``, which also have a ``size``, without listing pairs.

    Each task call gives at most two rows per vector of its blocks: (key, null, links) with the sizes of what it is
    linked to there, and (key, other, null) with the smallest key of its component there. Rows within half the
    threshold of one point are linked without being compared.
    """
    kind = cells.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right, one = _sides(batches, True)
        x, y = matrix(left["vec"].tolist()), matrix(right["vec"].tolist())
        x_away, y_away, x_size, y_size = (side[c].to_numpy() for c in ("away", "size") for side in (left, right))
        # In one block every pair comes from both of its rows, and only the first gains.
        shift = 0 if one else len(x)
        gained, root = (np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)), np.arange(shift + len(y))
        if len(x) and len(y):
            middle = np.median(np.concatenate([x, y]), axis=0)[None, :]
            x_core, y_core = (distances(side, middle) < threshold / 2 * (1 - 1e-9) for side in (x, y))
            for p in np.unique(x_away[x_core]):
                for q in np.unique(y_away[y_core]):
                    i, j = np.flatnonzero(x_core & (x_away == p)), np.flatnonzero(y_core & (y_away == q))
                    if p & q == 0:
                        gained[0][i] += y_size[j].sum() - (x_size[i] if one and p == q else 0)
                        gained[1][j] += x_size[i].sum()
                        join_roots(root, i, np.full(len(i), j[0] + shift))
                        join_roots(root, np.full(len(j), i[0]), j + shift)
            for some, others in ((~x_core, np.ones(len(y), bool)), (x_core, ~y_core)):
                rows, columns = np.flatnonzero(some), np.flatnonzero(others)
                allowed = lambda i, j: (x_away[rows[i]] & y_away[columns[j]] == 0) & (not one or rows[i] != columns[j])  # noqa: B023, E731
                for i, j, _ in close_rows(x[rows], y[columns], threshold, allowed, measured=False):
                    i, j = rows[i], columns[j]
                    gained[0][:] += np.bincount(i, y_size[j], len(x)).astype(np.int64)
                    gained[1][:] += np.bincount(j, x_size[i], len(y)).astype(np.int64)
                    join_roots(root, i, j + shift)
        keys = left["key"] if one else pd.concat([left["key"], right["key"]], ignore_index=True)
        links = gained[0] if one else np.concatenate(gained)
        frame = pd.DataFrame({"key": keys.to_numpy(), "links": links, "root": root})
        frame["other"] = frame.groupby("root")["key"].transform("min")
        yield frame.loc[frame["links"] > 0, ["key", "links"]].assign(other=None)[["key", "other", "links"]]
        yield frame.loc[frame["key"] != frame["other"], ["key", "other"]].assign(links=None)

    blocks = _block_pairs(cells, block_rows, "size").drop("draw")
    return _dealt(blocks).applyInPandas(run, f"key {kind}, other {kind}, links long")


def pairs_between(left: DataFrame, right: DataFrame, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs of different keys closer than the threshold, a from ``left`` and b from ``right``, rows of one tree."""
    both = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))
    rows = blocked(both, block_rows).where((F.col("n0") > 0) & (F.col("n1") > 0))
    o = F.explode(F.sequence(F.lit(0), F.when(F.col("side") == 0, F.col("n1")).otherwise(F.col("n0")) - 1))
    met = rows.withColumn("o", o).select(
        "cell", "side", "key", "draw", "vec", "away",
        F.when(F.col("side") == 0, F.col("block")).otherwise(F.col("o")).alias("block"),
        F.when(F.col("side") == 0, F.col("o")).otherwise(F.col("block")).alias("other"),
    )
    return _compare(met, threshold, False)
