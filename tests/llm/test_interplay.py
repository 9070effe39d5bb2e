"""The filter audit against a plain version; files in any order, smaller ids arriving later, repeated batches."""

import itertools
import random

import pytest

from boxweave.llm import interplay, queries

WORDS = [f"w{i}" for i in range(400)]
DOCS = "doc_id long, text string, source string, part int, mask string"


def plain_mask(text):
    words = text.translate(str.maketrans("\t\n\x0b\x0c\r", " " * 5)).split(" ")
    words = [w for w in words if w]
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
        "D": any(c in "#$%&*|" for c in text),
    }


def plain(docs, labels):
    good, toxic = ({d for d, q, t in labels if d is not None and v(q, t)} for v in (lambda q, t: q == 1, lambda q, t: t == 1))
    rows = []
    for doc_id, text, source in docs:
        fails = plain_mask(text or "")
        fails["E"] = doc_id is not None and any(i is not None and i < doc_id and (t or "") == (text or "") for i, t, _ in docs)
        rows.append((source or "", doc_id, {f for f, v in fails.items() if v}))
    out = {}
    shapley = {}
    for order in itertools.permutations("ABCDE"):
        for part in {r[0] for r in rows}:
            left = [(d, f) for p, d, f in rows if p == part]
            gone = []
            for step, name in enumerate(order, 1):
                removed = [(d, f) for d, f in left if name in f]
                redundant = sum(name in f for _, f in gone)
                left = [(d, f) for d, f in left if name not in f]
                gone += removed
                unique = sum(f == {name} for p, _, f in rows if p == part)
                shapley[part, name] = shapley.get((part, name), 0) + len(removed)
                lost = [sum(d in marked for d, _ in removed) for marked in (good, toxic)]
                out[part, "".join(order), step] = [len(left), len(removed), redundant, unique, *lost]
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def as_dict(report):
    assert report.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = report.collect()
    out = {tuple(r[:3]): tuple(r[3:]) for r in rows}
    assert len(out) == len(rows)
    return out


def documents(n, seed):
    draw = random.Random(seed)
    texts = [" ".join(draw.choices(WORDS, k=draw.choice([3, 199, 200, 260]))) for _ in range(n // 4)]
    texts += [" ".join(draw.choices(WORDS[:20], k=230)) + draw.choice(["", " X" * 9, "$"]) for _ in range(n // 8)] + ["", " \t\n", None, "HELLO", "a#b"]
    ids = draw.sample(range(10**6), n)
    return [(i, draw.choice(texts) if draw.random() < 0.6 else texts[0], draw.choice(["s1", "s1", "s2", None, ""])) for i in ids]


@pytest.fixture
def labels(spark):
    def make(docs, seed):
        draw = random.Random(seed)
        rows = [(d[0], draw.choice([0, 1, None]), draw.choice([0, 1])) for d in docs if draw.random() < 0.5]
        rows += rows[:5] + [(None, 1, 1)]
        return rows, spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make


def write(spark, docs, path, files):
    """One file for every slice, in the order given: later files hold smaller ids too."""
    for n in range(files):
        rows = [(*d, 1, "x") for d in docs[n::files]]
        spark.createDataFrame(rows, DOCS).coalesce(1).write.mode("append").parquet(path)


def test_retractions_over_batches_and_runs(spark, tmp_path, labels, monkeypatch):
    monkeypatch.setattr(interplay, "GROUP_TEXTS", 12)
    docs = documents(160, 3)
    odd = [(7, "twice", "s1"), (7, "twice", "s2"), (7, "twice", "s1"), (None, "twice", "s2"), (None, "none", "s9"), (9, "twice", None), (2**62 + 1, "far", "s1"), (2**62, "far", "s1")]
    docs += odd
    marks, frame = labels(docs, 4)
    path, work = str(tmp_path / "docs"), str(tmp_path / "work")
    write(spark, docs[:100], path, 5)
    assert as_dict(interplay.audit(spark, path, frame, work, batches=5)) == plain(docs[:100], marks)
    write(spark, docs[100:], path, 3)
    assert as_dict(interplay.audit(spark, path, frame, work, batches=4)) == plain(docs, marks)
    taken_back = spark.read.parquet(f"{work}/changes").where("n < 0")
    assert taken_back.count() > 0
    # Nothing new: the same report.
    assert as_dict(interplay.audit(spark, path, frame, work)) == plain(docs, marks)


def test_empty_and_single(spark, tmp_path, labels):
    _, frame = labels([], 1)
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "none"))
    assert as_dict(interplay.audit(spark, str(tmp_path / "none"), frame, str(tmp_path / "w0"))) == {}
    docs = [(1, "long " * 300_000, "s"), (2, None, None)]
    write(spark, docs, str(tmp_path / "few"), 1)
    assert as_dict(interplay.audit(spark, str(tmp_path / "few"), frame, str(tmp_path / "w1"))) == plain(docs, [])


def test_query_on_whole_tables(spark):
    path = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text", "source").collect()]
    marks = [tuple(r) for r in spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert as_dict(queries.QUERIES["op13_filter_interplay"](spark, path)) == plain(docs, marks)
