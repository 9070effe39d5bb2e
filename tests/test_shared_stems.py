"""Review, merge and scoring where one stem occurs in several sources: a match on the stem alone would show."""

import pytest

from boxweave.operators import merge, review, score, selection
from boxweave.sources import sinks

BOX = "source string, stem string, line_no int, class_id int, cx double, cy double, w double, h double"


@pytest.fixture
def pool(spark):
    """Stem i in sources a and b, stem j in b alone; classes 0 and 14."""
    rows = [("a", "i", 1, 0), ("a", "i", 2, 14), ("b", "i", 1, 14), ("b", "j", 1, 0)]
    return spark.createDataFrame([(*r, 0.5, 0.5, 0.1 * r[2], 0.1) for r in rows], BOX)


def keys(df):
    return sorted({(r["source"], r["stem"]) for r in df.collect()})


def images(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, stem string")


def test_scope_and_progress(spark, pool):
    every = images(spark, ("a", "i"), ("b", "i"), ("b", "j"))
    one = images(spark, ("b", "i"))
    assert keys(review.only_merged(every, one)) == [("b", "i")]
    assert keys(review.skip_reviewed(every, one)) == [("a", "i"), ("b", "j")]
    assert keys(review.hide_duplicates(every, one, 3, every)) == [("a", "i"), ("b", "j")]
    with pytest.raises(ValueError, match="covers 2 images but the pool holds 3"):
        review.hide_duplicates(every, one, 2, every)
    counts = {r["source"]: (r["loaded"], r["skipped"]) for r in review.reread(every, one).collect()}
    assert counts == {"a": (0, 1), "b": (1, 1)}
    assert {r["source"]: r["files"] for r in review.files_per_source(every).collect()} == {"a": 1, "b": 2}
    assert keys(review.accumulate_exclusions(one, every.selectExpr("source", "stem", "if(source = 'a', 'exclude', 'keep') as tag"))) == [("a", "i"), ("b", "i")]


def test_write_back_and_store(spark, pool, tmp_path):
    scope = images(spark, ("a", "i"))
    edits = spark.createDataFrame([("a", "i", 7, 1, 0.1, 0.1, 0.1, 0.1)], BOX)
    rows = review.replace_eligible(scope, pool, edits).collect()
    other = [r for r in pool.collect() if (r["source"], r["stem"]) == ("a", "i") and r["class_id"] not in review.config.proxy_class_ids()]
    assert {(r["source"], r["stem"]) for r in rows} == {("a", "i")}
    assert [r["class_id"] for r in sorted(rows, key=lambda r: r["line_no"])] == [*(r["class_id"] for r in other), 1]
    path = str(tmp_path / "store")
    sinks.begin_store(pool, path, ["source", "stem"], review.STORE_BUCKETS)
    got = review.add_reviewed(edits, path).select("source", "stem", "line_no", "class_id").collect()
    assert sorted(tuple(r) for r in got) == [("a", "i", 7, 1), ("b", "i", 1, 14), ("b", "j", 1, 0)]


def test_flags_diff_and_promotion(spark, pool):
    flagged = pool.where("source = 'a' and line_no = 1").selectExpr("*", "array('tiny_box') as reasons")
    marked = review.flagged_boxes(pool, flagged).collect()
    assert sorted((r["source"], r["line_no"], r["flagged"]) for r in marked) == [("a", 1, True), ("a", 2, False)]
    edited = pool.where("not (source = 'b' and stem = 'i')")
    changes = {(r["source"], r["stem"]): r["change"] for r in review.diff(pool.select("source", "stem"), pool, edited).collect()}
    assert changes == {("a", "i"): "unchanged", ("b", "i"): "removed", ("b", "j"): "unchanged"}
    preds = spark.createDataFrame([("b", "i", 1, 3, 0.1, 0.1, 0.2, 0.2, 0.9, "accept")], "source string, stem string, pred_no int, class_id int, x double, y double, w double, h double, conf double, tag string")
    added = review.promote(pool, preds).where("class_id = 3").collect()
    assert [(r["source"], r["stem"], r["line_no"]) for r in added] == [("b", "i", 2)]


def test_merge_and_selection(spark, pool):
    chosen = images(spark, ("a", "i"), ("b", "i"), ("b", "j"))
    left = merge.apply_exclusions(chosen, images(spark, ("b", "i")))
    files = spark.createDataFrame([("a", "i", "i.jpg"), ("b", "i", "i.png")], "source string, stem string, filename string")
    resolved = {(r["source"], r["stem"]): (r["filename"], r["outcome"]) for r in merge.resolve_files(left, files, pool).collect()}
    assert resolved == {("a", "i"): ("i.jpg", "merged"), ("b", "j"): (None, "missing_image")}
    entries = "class_id int, source string, stem string"
    both = [spark.createDataFrame(rows, entries) for rows in ([(0, "a", "i"), (0, "b", "j")], [(0, "b", "i"), (0, "b", "j")])]
    facts = [{"seed": 42, "instance_target": 5, "class_names": ["x"]}] * 2
    assert keys(selection.intersect(both)) == [("b", "j")]
    body = selection.combined_document("intersect", both, facts).first()
    filled = {name: (b["selected"], b["final_images"]) for name, b in body["classes"].items() if b["selected"]}
    assert list(filled.values()) == [(["b/j"], 1)] and len(body["classes"]) == 16
    assert body["result_total"] == 1 and list(body["dropped_by_class"].values()) == [1] and body["hard_cap_preset"] is None
    assert selection.combined_document("union", both, facts).first()["result_total"] == 3
    with pytest.raises(ValueError, match="seed"):
        selection.combined_document("union", both, [facts[0], {**facts[1], "seed": 1}])


def test_scores(spark, pool):
    gt = score.ground_truth(pool)
    preds = gt.where("source = 'b'").selectExpr("source", "stem", "box_no as pred_no", "class_id", "x", "y", "w", "h", "0.5 as conf")
    found = {(r["source"], r["stem"]): r["mistakenness"] for r in score.image_scores(gt, preds).collect()}
    assert set(found) == set(keys(gt)) and all(v == (-1.0 if k[0] == "a" else 0.25) for k, v in found.items())
    gone = score.missing_images(pool, images(spark, ("b", "i"), ("b", "j")))
    assert keys(gone) == [k for k in keys(gt) if k[0] == "a"]
