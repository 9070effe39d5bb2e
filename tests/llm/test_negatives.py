"""Hard negatives against a plain version with Python integers: ties, windows, blocks, odd vectors, hot labels."""

import math
import random

from pyspark.sql import functions as F

from boxweave.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, q string, rank int"


def plain(rows, positives=5, negatives=10):
    usable = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(v is None or not math.isfinite(v) for v in vector):
            continue
        row = (label, [math.floor(256 * v) for v in vector])
        usable[vec_id] = min(usable.get(vec_id, row), row)
    out = set()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for anchor, (label, q) in usable.items():
        if anchor % 10:
            continue
        scored = sorted((-dot(q, other), vec_id, lab) for vec_id, (lab, other) in usable.items() if vec_id != anchor)
        for score, positive, lab in [s for s in scored if s[2] == label][:positives]:
            fits = [(-s, i) for s, i, other in scored if other != label and 30 * -score <= 100 * -s <= 90 * -score]
            out |= {(anchor, positive, n + 1, i, -score, s) for n, (s, i) in enumerate(fits[:negatives])}
    return out


def check(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA).repartition(5)
    found = negatives.mine(negatives.quantised(frame), F.col("vec_id") % 10 == 0, **more)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain(rows)
    return got


def vectors(n, dims, seed, centres=6, spread=0.4, grid=None):
    draw = random.Random(seed)
    middle = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(centres)]
    rows = []
    for i in range(n):
        c = draw.randrange(centres)
        v = [m + spread * draw.gauss(0, 1) for m in middle[c]]
        if grid:
            v = [round(x * grid) / grid for x in v]
        rows.append((i, v, draw.choice([c % 3, 0])))
    return rows


def test_blocks_clusters_and_ties(spark, monkeypatch):
    monkeypatch.setattr(negatives, "MEMBERS", 4)
    monkeypatch.setattr(negatives, "STRIDE", 16)
    assert check(spark, vectors(700, 8, 1), block=16)
    assert check(spark, vectors(400, 3, 2, grid=1), block=1_000)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(120, 4, 3) + [
        (None, [1.0, 1.0], 1), (1_000, None, 1), (1_010, [], 1), (1_020, [0.0] * 4, 0), (1_030, [nan, 1.0], 0), (1_040, [inf], 0),
        (1_050, [None, 1.0], 0), (1_060, [1.0, 2.0], None), (1_070, [3.0, 1.0], 0), (1_080, [1.0] * 9, 0), (1_090, [-1.0] * 4, 7),
        (20, [9.0, 9.0, 9.0, 9.0], 2), (30, [0.5] * 4, 0), (30, [0.5] * 4, 0),
    ]
    assert check(spark, rows)
    huge = [(i, [float((i * 37) % 11 - 5) * 5e5, float(i % 7 - 3) * 4e5], i % 2) for i in range(40)]
    assert check(spark, huge)


def test_few_or_no_rows(spark):
    assert check(spark, []) == []
    assert check(spark, [(0, [1.0], 1)]) == []
    assert check(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []
    assert len(check(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [0.95], 2)])) == 1


def test_walks_end_early_where_vectors_are_clustered():
    """The certified end leaves most of a list unread when its far part cannot matter."""
    import numpy as np

    rows = vectors(6_000, 6, 4, centres=30, spread=0.1)
    x = np.floor(256 * np.array([r[1] for r in rows]))
    ids, labels = np.arange(len(x)), np.array([r[2] for r in rows])
    read = 0
    products = negatives._products

    def counted(a, b, *norms):
        nonlocal read
        read += len(a) * len(b)
        return products(a, b, *norms)

    negatives._products = counted
    try:
        some = ids % 100 == 0
        block = negatives.Block(ids[some], labels[some], x[some], np.full((60, 1), negatives.LOWEST), np.full((60, 1), negatives.HIGHEST), True, 5)
        norms = np.sqrt((x**2).sum(axis=1))
        for c in block.clusters:
            block.walk(c, ids, labels, x, norms, negatives.Best(5, np.full(len(c.index), negatives.LOWEST)))
        few = negatives.clustered(x[some], 2)
        everything, read = read, 0
        block.clusters = few
        for c in few:
            block.walk(c, ids, labels, x, norms, negatives.Best(5, np.full(len(c.index), negatives.LOWEST)))
    finally:
        negatives._products = products
    assert everything < 0.6 * 60 * len(x) and read < 0.6 * everything
