"""Near copies of the pipeline's stage against a comparison of all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from boxweave.llm import copies
from tests.llm.test_search import shingles

SF = "/root/testdata/sf0.01"


def plain_roots(texts):
    """Row number -> smallest row number reachable over pairs with a five-word resemblance of 0.8, breadth first."""
    sets = [shingles(t or "") for t in texts]
    near = [[] for _ in texts]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                near[i].append(j)
                near[j].append(i)
    root = [None] * len(texts)
    for start in range(len(texts)):
        wave = [start] if root[start] is None else []
        while wave:
            for i in wave:
                root[i] = start
            wave = list({j for i in wave for j in near[i] if root[j] is None})
    return root


def test_stage_drops_every_near_copy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    roots = plain_roots([t for _, t in rows])
    got = corpus_pipeline.near_deduplicated(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [rows[i][0] for i in sorted(set(roots))]


def test_edited_copies_chains_and_a_common_passage(spark, monkeypatch):
    source, texts = random.Random(8), [None, "", " \n", "a b", "A  b", "a b c"]
    word = lambda: f"w{source.randrange(5000)}"
    passage = [word() for _ in range(30)]
    for _ in range(6):
        words = [word() for _ in range(source.choice([6, 12, 60, 200]))]
        for _ in range(25):  # a chain: each is an edit of the one before
            texts.append(" ".join(words))
            words = words[:]
            for _ in range(source.randint(1, max(1, len(words) // 40))):
                words[source.randrange(len(words))] = word()
    base = [word() for _ in range(150)]
    for _ in range(80):  # a dense group
        words = base[:]
        words[source.randrange(150)] = word()
        texts.append(" ".join(words))
    texts += [" ".join(passage + [word() for _ in range(source.randint(0, 12))]) for _ in range(60)]
    texts += [" ".join([word() for _ in range(20)] + passage) for _ in range(40)]
    source.shuffle(texts)
    want = plain_roots(texts)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for sample in (0, 4000):
        monkeypatch.setattr(copies, "SAMPLE_TEXTS", sample)
        assert sorted(r.doc_id for r in copies.keep_one(table, exact=True).collect()) == sorted(set(want))
    assert sorted(r.doc_id for r in copies.keep_one(table).collect()) == sorted(set(want))
    monkeypatch.setattr(copies, "CROWD", 2)
    assert sorted(r.doc_id for r in copies.keep_one(table).collect()) == sorted(set(want))
    assert copies.keep_one(table.limit(0)).count() == 0


def test_recall_of_bands_at_the_threshold():
    """Pairs of sets at 0.80 to 0.82, where bands are weakest: nearly all share one."""
    draw, bands = np.random.default_rng(4), copies.Bands()
    found = total = 0
    for n in (9, 45, 180, 900):
        for _ in range(250):
            both = draw.integers(0, 1 << 48, n, np.uint64)
            only = draw.integers(0, 1 << 48, (2, n // 9), np.uint64)
            a, b = (np.unique(np.concatenate([both, x])) for x in only)
            total += 1
            found += bool(set(bands(a).tolist()) & set(bands(b).tolist()))
    assert total == 1000 and found >= 995


def test_clashing_columns_null_and_repeated_ids(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(2, words, "k2"), (1, words + " more", "k1"), (None, words, "k3"), (None, "alone", "k4"), (7, "same id", "k5"), (7, "other text of it", "k6"), (9, None, "k7"), (8, " ", "k8"), (5, "twice", "k9"), (5, "twice", "k9")]
    table = spark.createDataFrame(rows, "doc_id long, text string, text_key string")
    table = table.withColumns({c: F.lit("mine") for c in ("kept_id", "KEPT_KEY", "fp", "root", "point", "n")})
    got = copies.keep_one(table)
    assert got.columns == table.columns
    kept = got.collect()
    assert sorted(r["text_key"] for r in kept) == ["k1", "k4", "k5", "k6", "k8", "k9"]
    assert all(r["kept_id"] == r["KEPT_KEY"] == r["fp"] == "mine" for r in kept)


def test_a_crowded_point_forms_few_pairs(spark):
    """1,000 texts that share a long common part but differ by more: all stay, and few pairs are compared."""
    source = random.Random(2)
    common = " ".join(f"c{i}" for i in range(60))
    rows = [(i, common + " " + " ".join(f"w{source.randrange(10**6)}" for _ in range(55))) for i in range(1_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert copies.keep_one(table).count() == 1_000


def test_fingerprints_of_the_grid_are_linked(spark, monkeypatch):
    """The stage takes what the SimHash grid links as candidates: near copies are found by it where no band agrees."""
    source = random.Random(4)
    words = [f"w{source.randrange(9000)}" for _ in range(400)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(f"x{i}" for i in range(400))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    scratch = copies.Scratch(spark)
    marks = copies.marked(docs)
    nodes = scratch.keep(marks.withColumn("points", F.expr("array(doc_id)")), "nodes")
    assert copies.fingerprint_links(nodes, scratch).count() == 1
    edges = copies.links(nodes, docs, scratch).collect()
    fps = {r.doc_id: r.fp for r in nodes.collect()}
    assert [{r.a, r.b} for r in edges] == [{fps[0], fps[1]}]


def test_pairs_and_prefixes_are_stored_before_they_are_joined(spark, monkeypatch):
    """Several joins read them: derived anew for each, a prefix was joined and counted many times over."""
    monkeypatch.setattr(copies, "CROWD", 2)
    source, leaves = random.Random(3), []
    base = [f"w{source.randrange(5000)}" for _ in range(60)]
    texts = [" ".join(base[:40] + [f"v{source.randrange(5000)}" for _ in range(9 + i % 7)]) for i in range(40)]
    for name in ("_possible", "_useful"):
        plain = getattr(copies, name)

        def seen(df, *rest, plain=plain, name=name):
            leaves.append((name, df._jdf.queryExecution().optimizedPlan().collectLeaves().size()))
            return plain(df, *rest)

        monkeypatch.setattr(copies, name, seen)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r.doc_id for r in copies.keep_one(docs).collect())
    assert kept == sorted(set(plain_roots(texts)))
    assert sorted(leaves) == [("_possible", 1), ("_possible", 1), ("_useful", 1)]
