"""Operators that avoid gathering a group, against plain Python on skewed input."""

import hashlib
import random
import statistics

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from boxweave import config
from boxweave.config import CapPolicy
from boxweave.functions.ranking import exclusive_quartiles, first_k
from boxweave.operators import cap, cells, components, dedup, score, split
from boxweave.plans.views import BOXES_SQL, derived_boxes
from boxweave.runtime import cut_lineage, join_on_group, setting


def draw(key, seed=42):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


@pytest.mark.parametrize("pad", [3e-3, 1e-5])
def test_quartiles_inside_brackets(spark, pad):
    """Also with brackets so narrow that ranks lie outside and the pass is repeated."""
    rng = random.Random(7)
    groups = {
        "spread": [rng.lognormvariate(0, 2) for _ in range(40_000)],
        "tied": [0.5] * 9_000 + [rng.random() for _ in range(9_000)],
        "steps": [float(i % 3) for i in range(9_000)],
        "n19": [rng.random() for _ in range(19)],
        "n20": [rng.random() for _ in range(20)],
        "n3": [3.0, 1.0, 2.0],
        "n2": [3.0, 1.0],
        "n1": [4.0],
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("n1", None), ("none", None)], "g string, v double").repartition(16)
    rows = exclusive_quartiles(df, ["g"], "v", pad=pad, whole_rows=1_000).collect()
    got = {r["g"]: r for r in rows}
    assert len(rows) == len(got) == len(groups)
    for name, vs in groups.items():
        assert got[name]["n"] == len(vs)
        assert got[name]["q2"] == pytest.approx(statistics.median(vs))
        if len(vs) > 1:
            want = statistics.quantiles(sorted(vs), n=4)
            assert (got[name]["q1"], got[name]["q3"]) == pytest.approx((want[0], want[2]), rel=1e-12)
    assert exclusive_quartiles(df.limit(0), ["g"], "v").count() == 0


@pytest.mark.parametrize("salts", [1, 100])
def test_first_k_with_and_without_salts(spark, salts):
    df = spark.range(5_000).select((F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("o"), "id")
    got = {(r["g"], r["rn"]): r["id"] for r in first_k(df, ["g"], ["o", "id"], 7, salts=salts).collect()}
    for g in range(3):
        ids = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i in range(g, 5_000, 3))
        assert [got[g, k] for k in range(1, 8)] == [i for _, i in ids[:7]]


def test_join_on_group_with_a_hot_key(spark, hot):
    rows = spark.createDataFrame([("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(500)], "k string, v int")
    groups = rows.groupBy("k").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    got = join_on_group(rows, groups, ["k"], "n")
    assert got.count() == 800 and got.where("k = 'hot' and m = 0").count() == 300


def smallest_reachable(edges):
    """Breadth first from every key in ascending order: the first to reach a key is its component's smallest."""
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    root = {}
    for start in sorted(near):
        if start in root:
            continue
        root[start], wave = start, [start]
        while wave:
            wave = sorted({k for seen in wave for k in near[seen]} - root.keys())
            root.update(dict.fromkeys(wave, start))
    return root


@pytest.mark.parametrize("path", ["plain", "hot"])
def test_components(spark, path, request):
    if path == "hot":
        request.getfixturevalue("hot")
    rng = random.Random(3)
    edges = [(f"n{rng.randrange(300):04d}", f"n{rng.randrange(300):04d}") for _ in range(200)]
    edges += [("n0007", f"star{i:04d}") for i in range(300)]
    edges += [(f"chain{i:04d}", f"chain{i + 1:04d}") for i in range(60)]
    edges += [("a", "a")]
    got = {r["key"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    want = {k: r for k, r in smallest_reachable([e for e in edges if e[0] != e[1]]).items() if k != r}
    assert got == want


def test_no_edges(spark):
    assert components.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_group_edges_drop_absent_members(spark, hot):
    members = [("g1", "a"), ("g1", "b"), ("g1", "c"), ("g2", "x"), ("g2", "c"), ("g3", "y"), ("g4", "a")]
    pool = spark.createDataFrame([(k,) for k in "bcxy"], "key string")
    got = components.group_edges(spark.createDataFrame(members, "grp string, key string"), pool).collect()
    assert sorted(tuple(r) for r in got) == [("b", "c"), ("c", "x")]


def test_split_keeps_components_whole_and_ratios(spark, hot):
    keys = [(f"s{i % 3}__{i:05d}", f"s{i % 3}") for i in range(3_000)] + [("tiny__1", "tiny"), ("duo__1", "duo"), ("duo__2", "duo")]
    pool = spark.createDataFrame(keys, "key string, source string")
    edges = [("s0__00000", k) for k, _ in keys[1:1_000]]
    roots = components.components(spark.createDataFrame(edges, "a string, b string"))
    assigned = split.assign(pool, roots)
    got = {r["key"]: r["split"] for r in assigned.collect()}
    assert len(got) == len(keys) and assigned.count() == len(keys)
    root = smallest_reachable(edges)
    assert len({got[k] for k in root}) == 1
    units = {}
    for k, s in keys:
        if root.get(k, k) == k:
            units.setdefault(s, []).append(k)
    for source, names in units.items():
        names.sort(key=lambda k: (draw(k), k))
        a, b = round(len(names) * 0.70), round(len(names) * 0.15)
        assert [got[k] for k in names] == ["train"] * a + ["val"] * b + ["test"] * (len(names) - a - b), source
    assert tuple(split.completeness(pool, assigned).first()) == (0, 0, 0, 0)
    again = {r["key"]: r["split"] for r in split.assign(pool.repartition(13), roots).collect()}
    assert again == got


def test_leak_gate(spark):
    members = spark.createDataFrame([("g", "a"), ("g", "b")], "grp string, key string")
    assigned = spark.createDataFrame([("a", "s", "train"), ("b", "s", "test")], "key string, source string, split string")
    assert split.require_no_leaks(members, assigned, preview=True).count() == 1
    with pytest.raises(RuntimeError):
        split.require_no_leaks(members, assigned)


def test_sides_that_grow_do_not_pass_through_the_driver(spark):
    keys = spark.range(50).select(F.concat(F.lit("k"), "id").alias("key"), F.lit("s").alias("source"), F.lit("train").alias("split"))
    members = keys.select(F.lit("g").alias("grp"), "key")
    roots = members.select("key", F.lit("k0").alias("root"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    joined = [
        split.leaks(members, keys), split.missing_labels(keys, members), split.units(keys, roots), split.completeness(keys, keys),
        components.labelled(keys, roots), join_on_group(members, sizes, ["key"], "n", 50),
    ]
    for plan in (df._jdf.queryExecution().executedPlan().toString() for df in joined):
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_boxes_shuffle_no_column_that_changes_nothing(spark, tmp_path):
    line = spark.range(400).selectExpr(
        "id % 40 as l_orderkey", "id % 3 as l_partkey", "id % 2 as l_suppkey", "cast(id % 2 as int) as l_linenumber", "double(id % 2 + 1) as l_quantity",
        "double(id % 7) as l_extendedprice", "double(id % 5) as l_discount", "double(id % 11) as l_tax", "date_add(date'2020-01-01', int(id % 13)) as l_shipdate",
    )
    line.write.parquet(f"{tmp_path}/lineitem.parquet")
    found = derived_boxes(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    wanted = con.execute(BOXES_SQL).fetchall()
    assert len(wanted) == 400
    rounded = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    assert rounded(found.collect()) == rounded(wanted)
    read = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in read(found) and "l_shipdate" not in read(found)
    # A column that can part such lines keeps the whole order.
    assert "l_tax" in read(derived_boxes(spark, str(tmp_path), "l_discount"))


def greedy(points, threshold):
    """Sequential pass over distinct vectors in seeded order, copies under their smallest key."""
    first = {}
    for k in sorted(points):
        first.setdefault(points[k], k)
    reps = sorted(first.values(), key=lambda k: (draw(k), k))
    kept = []
    for k in reps:
        if all(np.linalg.norm(np.subtract(points[k], points[j])) >= threshold for j in kept):
            kept.append(k)
    return kept


def clustered_points(seed, dims=6):
    """Scattered points, a blob with a third of the rows, a chain, and exact copies."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(400, dims))
    blob = base[0] + rng.normal(scale=0.03, size=(250, dims))
    chain = base[1] + np.arange(40)[:, None] * np.full((1, dims), 0.06)
    rows = np.vstack([base, blob, chain, np.repeat(base[2:3], 60, axis=0), base[:30]])
    return {i: tuple(map(float, v)) for i, v in enumerate(rows)}


def as_vectors(spark, points):
    return spark.createDataFrame([(k, list(v)) for k, v in points.items()], "key long, vec array<double>")


def smaller_cells(monkeypatch, rows, anchors, stretch=50):
    monkeypatch.setattr(cells, "CELL_ROWS", rows)
    monkeypatch.setattr(cells, "ANCHORS", anchors)
    monkeypatch.setattr(cells, "CHUNK_ROWS", 70)
    monkeypatch.setattr(dedup, "FIRST_STRETCH", stretch)


@pytest.mark.parametrize("limit", [8_000, 40])
def test_near_duplicates_equal_the_sequential_pass(spark, hot, monkeypatch, limit):
    smaller_cells(monkeypatch, limit, 5)
    points, threshold = clustered_points(5), 0.2
    vectors = as_vectors(spark, points)
    got_pairs = [(r["a"], r["b"]) for r in dedup.near_pairs(vectors, threshold).collect()]
    first = {}
    for k in sorted(points):
        first.setdefault(points[k], k)
    reps = sorted(first.values())
    x = np.array([points[k] for k in reps])
    close = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) < threshold
    want_pairs = {(reps[i], reps[j]) for i, j in zip(*np.nonzero(close)) if i < j}
    want_pairs |= {(first[v], k) for k, v in points.items() if first[v] != k}
    assert len(got_pairs) == len(set(got_pairs)) and set(got_pairs) == want_pairs

    kept = greedy(points, threshold)
    got = {r["duplicate"]: (r["kept"], r["distance"]) for r in dedup.near_duplicates(vectors, threshold).collect()}
    assert set(points) - set(got) == set(kept)
    for k, (to, distance) in got.items():
        best = min((np.linalg.norm(np.subtract(points[k], points[j])), j) for j in kept)
        assert to == best[1] and distance == pytest.approx(best[0], abs=1e-9)


@pytest.mark.parametrize("limit,block", [(8_000, 8_000), (40, 30)])
def test_near_links_count_every_link_and_class(spark, hot, monkeypatch, limit, block):
    smaller_cells(monkeypatch, limit, 5)
    points, threshold = clustered_points(6, dims=2), 0.15
    x = np.array(list(points.values()))
    close = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) < threshold
    np.fill_diagonal(close, False)
    want = {}
    for start in range(len(x)):
        if start not in want:
            reached, frontier = {start}, [start]
            while frontier:
                frontier = [j for i in frontier for j in np.nonzero(close[i])[0] if j not in reached and not reached.add(j)]
            want |= {int(k): (start, int(close[k].sum())) for k in reached}
    rows = dedup.near_links(as_vectors(spark, points), threshold, block_rows=block).collect()
    assert len(rows) == len(points) and {r["key"]: (r["class_id"], r["links"]) for r in rows} == want


def test_a_dense_cluster_stays_linear(spark, monkeypatch):
    """4,000 vectors within a tenth of the threshold: eight million links, few listed pairs and few rows from tasks."""
    smaller_cells(monkeypatch, 500, 16, stretch=100)
    rng = np.random.default_rng(3)
    points = {i: tuple(map(float, v)) for i, v in enumerate(np.vstack([rng.uniform(0, 0.01, size=(4_000, 3)), rng.uniform(5, 9, size=(200, 3))]))}
    listed = []
    plain_within, plain_between = cells.pairs_within, cells.pairs_between

    def counted(plain):
        def run(*args, **named):
            found = cut_lineage(plain(*args, **named), "counted")
            listed.append(found.count())
            return found

        return run

    monkeypatch.setattr(cells, "pairs_within", counted(plain_within))
    monkeypatch.setattr(cells, "pairs_between", counted(plain_between))
    rows = {r["key"]: (r["class_id"], r["links"]) for r in dedup.near_links(as_vectors(spark, points), 0.1).collect()}
    assert all(rows[k] == (0, 3_999) for k in range(4_000)) and sum(listed) < 20_000
    listed.clear()
    lost = dedup.near_duplicates(as_vectors(spark, points), 0.1)
    assert lost.where("duplicate < 4000").count() == 3_999 and sum(listed) < 20_000


def test_near_search_of_few_and_no_vectors(spark):
    for points in ({}, {1: (0.0, 0.0)}, {1: (0.0, 0.0), 2: (0.0, 0.0)}):
        vectors = as_vectors(spark, points)
        assert dedup.near_pairs(vectors, 0.5).count() == max(0, len(points) - 1)
        assert dedup.near_duplicates(vectors, 0.5).count() == max(0, len(points) - 1)
        assert sorted(tuple(r) for r in dedup.near_links(vectors, 0.5).collect()) == [(k, 1, len(points) - 1) for k in points]


@pytest.mark.parametrize("limit", [8_000, 60])
def test_near_pairs_in_small_blocks(spark, monkeypatch, limit):
    smaller_cells(monkeypatch, limit, 6)
    rng = np.random.default_rng(9)
    rows = rng.normal(size=(300, 4)) * 0.2
    placed = cut_lineage(cells.build(as_vectors(spark, {i: tuple(map(float, v)) for i, v in enumerate(rows)}), 0.25, 42), "placed")
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if np.linalg.norm(rows[i] - rows[j]) < 0.25}
    for block in (40, 8_000):
        found = cells.pairs_within(placed, 0.25, block).collect()
        assert len(found) == len(want) and {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in found} == want
    left, right = placed.where("key % 2 = 0"), placed.where("key % 2 = 1")
    for block in (40, 8_000):
        found = cells.pairs_between(left, right, 0.25, block).collect()
        assert sorted((r["a"], r["b"]) for r in found) == sorted(
            (i, j) for i in range(0, 300, 2) for j in range(1, 300, 2) if np.linalg.norm(rows[i] - rows[j]) < 0.25
        )


def sequential_cap(found, class_id, policy):
    """One class by plain loops: priority sources in list order, then everything else."""
    sources = policy.priority.get(class_id, policy.default_priority)
    each = policy.hard_cap // 3 // len(sources) if len(sources) > 1 else 0
    images, instances, chosen = policy.hard_cap, policy.instance_target, []
    for k, source in enumerate(sources):
        items = sorted((i for i in found if i[0] == source), key=lambda i: (draw(f"{i[0]}/{i[1]}"), i))
        ceiling = max(0, images - each * (len(sources) - k - 1))
        base = policy.subbudgets.get((class_id, source))
        if base is None:
            take = items[:ceiling]
        else:
            budget, used, take = round(base * policy.hard_cap / config.DEFAULT_CAP), 0, []
            for i in sorted(items, key=lambda i: i[2]):
                if len(take) >= ceiling or used + i[2] > budget:
                    break
                take.append(i)
                used += i[2]
        chosen += take
        images = max(0, images - len(take))
        instances = max(0, instances - sum(i[2] for i in take))
    rest = sorted((i for i in found if i[0] not in sources), key=lambda i: (draw(f"{i[0]}/{i[1]}"), i))
    used, taken, stop = 0, 0, "all_candidates_included"
    for i in rest:
        if taken >= images:
            stop = "image_hard_cap"
            break
        if used >= instances:
            stop = "instance_target"
            break
        chosen.append(i)
        used, taken = used + i[2], taken + 1
    return {i[:2] for i in chosen}, stop


@pytest.mark.parametrize("hard_cap,target", [(30, 60), (90, 100_000), (7, 50), (10_000, 100_000), (200, 150)])
def test_cap_equals_the_sequential_pass(spark, hard_cap, target):
    rng = random.Random(hard_cap)
    policy = CapPolicy(
        hard_cap, target, 42, ("p",), {0: ("p", "q", "r"), 1: ("q", "p", "r", "t"), 2: ("none",)}, {(0, "q"): 2500, (1, "t"): 700}
    )
    rows = [
        (c, s, f"i{i:04d}", rng.choice([1, 1, 2, 3, 9]))
        for c in range(4)
        for s, n in (("p", 80), ("q", 60), ("r", 20), ("t", 30), ("big", 300))
        for i in range(n)
    ]
    found = spark.createDataFrame(rows, "class_id int, source string, stem string, cnt long")
    result = cap.select_images(found, policy)
    got = {}
    for r in result.selected.collect():
        got.setdefault(r["class_id"], set()).add((r["source"], r["stem"]))
    stops = {r["class_id"]: r["stop_reason"] for r in cap.class_summary(result).collect()}
    for c in range(4):
        want, stop = sequential_cap([r[1:] for r in rows if r[0] == c], c, policy)
        assert got.get(c, set()) == want and stops[c] == stop


def test_lanes_are_ranked_in_pieces(spark, monkeypatch):
    """Ranks and sums of whole lanes, sparse ones beyond the told densities too, though no window spans a lane."""
    monkeypatch.setattr(cap, "DENSITIES", 3)
    rng = random.Random(6)
    rows = [(c, lane, f"i{i}", rng.choice([1, 2, 3, 5, 9])) for c in range(2) for lane in range(2) for i in range(400)]
    table = spark.createDataFrame(rows, "class_id int, lane int, stem string, cnt long").withColumns(
        {"source": F.lit("s"), "density": F.expr("if(lane = 1, cnt, 0L)"), "draw": F.expr("md5(concat(stem, class_id))")}
    )
    got = cap.first_of_lanes(table, 250)
    want = []
    for key in [(c, lane) for c in range(2) for lane in range(2)]:
        lane_rows = sorted((r.density, r.draw, r.stem, r.cnt) for r in table.collect() if (r.class_id, r.lane) == key)
        sums = 0
        for n, (_, _, stem, cnt) in enumerate(lane_rows[:250], 1):
            sums += cnt
            want.append((*key, stem, n, sums))
    assert sorted((r.class_id, r.lane, r.stem, r.rn, r.cum) for r in got.collect()) == sorted(want)
    ranked = [w for w in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window" in w and "draw" in w]
    assert ranked and all("piece" in w for w in ranked)


def test_grid_matching_equals_plain_matching(spark):
    rng = random.Random(1)
    boxes = [("s", f"i{i % 3}", n, rng.randrange(3), rng.random(), rng.random(), rng.choice([0.02, 0.05, 0.3, 0.0]), rng.uniform(0.01, 0.2))
             for n, i in enumerate(range(900))]
    gt = spark.createDataFrame(boxes, "source string, stem string, box_no int, class_id int, x double, y double, w double, h double")
    moved = [(*b[:4], b[4] + rng.uniform(-0.01, 0.01), b[5] + rng.uniform(-0.01, 0.01), b[6] * rng.uniform(0.7, 1.4), b[7] * rng.uniform(0.7, 1.4), rng.random())
             for b in boxes for _ in range(2)]
    preds = spark.createDataFrame(
        [(b[0], b[1], n, *b[3:]) for n, b in enumerate(moved)] + [("s", "i0", 10_000 + n, *boxes[0][3:], 0.5) for n in range(50)],
        "source string, stem string, pred_no int, class_id int, x double, y double, w double, h double, conf double",
    )
    for threshold in (0.1, 0.3, 0.5, 0.9):
        plain = sorted(tuple(r) for r in score.matches(gt, preds, threshold, crowded=10_000).collect())
        grid = sorted(tuple(r) for r in score.matches(gt, preds, threshold, crowded=1).collect())
        assert plain == grid and len(plain) > (300 if threshold < 0.9 else 0)
        every = preds.select("source", "stem").distinct()
        solid = preds.where("w > 0 and h > 0")
        copies = score._entries(solid, every, threshold, True).groupBy("source", "stem", "pred_no").count()
        assert copies.agg(F.max("count")).first()[0] < 100
    with pytest.raises(ValueError):
        score.matches(gt, preds, 0)


def test_near_search_in_bounded_pieces(spark, monkeypatch):
    """What is compared, taken exactly and copied at once is bounded, whatever is found and however wide the threshold is."""
    largest = {"exact": 0}
    plain = cells.distances

    def seen(x, y):
        largest["exact"] = max(largest["exact"], x.size)
        return plain(x, y)

    monkeypatch.setattr(cells, "SLICE", 5_000)
    monkeypatch.setattr(cells, "EXACT_NUMBERS", 2_000)
    monkeypatch.setattr(cells, "distances", seen)
    x = np.random.default_rng(5).normal(size=(300, 8))
    pieces = list(cells.close_rows(x, x, 100.0))
    assert sum(len(i) for i, _, _ in pieces) == 90_000 and max(len(i) for i, _, _ in pieces) <= 250
    assert largest["exact"] <= 2_000
    # All rows are in reach of all anchors: the cell stays whole and no row is copied for it.
    monkeypatch.setattr(cells, "_split", lambda *_: pytest.fail("rows copied of a cell that stays whole"))
    smaller_cells(monkeypatch, 50, 8)
    placed = cells.build(as_vectors(spark, {i: tuple(map(float, v)) for i, v in enumerate(x)}), 100.0, 42)
    assert placed.count() == 300


def test_links_of_scattered_vectors_list_no_pairs(spark, monkeypatch):
    """Vectors about as far apart as the threshold, none of them in a cluster: rows from tasks grow with vectors, not links."""
    x = np.random.default_rng(8).normal(size=(500, 12))
    x /= np.linalg.norm(x, axis=1)[:, None]
    plain, given = cells.links_within, []

    def counted(*args, **named):
        found = cut_lineage(plain(*args, **named), "counted")
        given.append(found.count())
        return found

    monkeypatch.setattr(cells, "links_within", counted)
    monkeypatch.setattr(cells, "pairs_within", lambda *_: pytest.fail("pairs listed"))
    rows = {r["key"]: r["links"] for r in dedup.near_links(as_vectors(spark, {i: tuple(map(float, v)) for i, v in enumerate(x)}), 1.3).collect()}
    close = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) < 1.3
    assert rows == {i: int(close[i].sum()) - 1 for i in range(500)} and given[0] <= 1_000 < close.sum()


def test_a_whole_cell_is_compared_by_many_tasks(spark, monkeypatch):
    """Also where Catalyst joins by shuffle, which leaves all rows of a cell in one task."""
    points = np.random.default_rng(7).normal(size=(300, 8))
    smaller_cells(monkeypatch, 50, 8)
    vectors = as_vectors(spark, {i: tuple(map(float, v)) for i, v in enumerate(points)})
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", -1):
        placed = cells.build(vectors, 100.0, 42).join(vectors.select("key", F.lit(1).alias("size")), "key")
        assert placed.select("cell").distinct().count() == 1
        for found in (cells.links_within(placed, 100.0, 30), cells.pairs_within(placed, 100.0, 30)):
            assert found.select(F.spark_partition_id().alias("task")).distinct().count() > 4


@pytest.mark.parametrize("offset, scale, single", [(0.0, 1.0, True), (0.0, 1e-3, True), (0.0, 1e-25, False), (3e3, 1.0, False), (0.0, 1e20, False)])
def test_screening_in_single_precision_decides_nothing_by_rounding(offset, scale, single):
    """Distances a hair above or below the threshold, far from the origin, tiny and huge."""
    rng = np.random.default_rng(11)
    x = (rng.normal(size=(70, 12)) + offset) * scale
    turn = rng.normal(size=(70, 12))
    length = 1.5 * scale * (1 + rng.choice([-1e-9, -1e-12, 0, 1e-12, 1e-9, -0.3, 0.3], 70))
    y = np.concatenate([x + turn / np.linalg.norm(turn, axis=1)[:, None] * length[:, None], rng.normal(size=(2_101, 12)) * 1.2 * scale + offset * scale])
    threshold = 1.5 * scale
    apart = np.sqrt(np.square(x[:, None] - y[None]).sum(axis=2))
    want = set(zip(*(side.tolist() for side in np.nonzero(apart < threshold))))
    assert (cells._single_margin(x, y, threshold) is not None) == single and len(want) > 20
    for measured in (True, False):
        found = list(cells.close_rows(x, y, threshold, lambda i, j: (i + j) % 3 > 0, measured))
        pairs = [p for i, j, _ in found for p in zip(i.tolist(), j.tolist())]
        assert len(pairs) == len(set(pairs)) and set(pairs) == {(i, j) for i, j in want if (i + j) % 3}
        assert all(d is None or np.array_equal(d, cells.distances(x[i], y[j])) for i, j, d in found)
