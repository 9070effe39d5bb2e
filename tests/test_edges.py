"""Edge cases that the driver tables do not hold."""

import pytest
from pyspark.sql import functions as F

from boxweave import config
from boxweave.config import CapPolicy
from boxweave.operators import cap, dims, mapping, review, score, split
from boxweave.runtime import BROADCAST_BYTES, small_side
from boxweave.sources import annotations, labels, sinks

BOX = "source string, stem string, line_no int, class_id int, cx double, cy double, w double, h double"
ENTRY = "project string, filter_map map<string,array<string>>, filter_name string, filter_list array<string>, canonical_class string, canonical_classes array<string>"


@pytest.mark.parametrize("policy", [CapPolicy(10, default_priority=()), CapPolicy(10, priority={3: ()})])
def test_class_without_priority_source_fills_to_its_cap(spark, policy):
    found = spark.createDataFrame([(3, "s", f"i{i}", 1) for i in range(20)], "class_id int, source string, stem string, cnt long")
    assert cap.select_images(found, policy).selected.where("class_id = 3 and reason = 'general'").count() == 10


def test_pull_takes_the_largest_quota(spark):
    rows = spark.createDataFrame([(c, "train", "s", f"i{i}") for c in (0, 1) for i in range(20)], "class_id int, split string, source string, stem string")
    got = dims.seeded_pull(rows, F.when(F.col("class_id") == 0, 15).otherwise(3)).groupBy("class_id").count().collect()
    assert {tuple(r) for r in got} == {(0, 15), (1, 3)}


def test_name_of_two_classes_maps_once_and_never_doubles_boxes(spark):
    natives = spark.createDataFrame([("a", "Car"), ("d", "Car")], "project string, native_name string")
    entries = [("a", {"doors": ["Car"], "vehicle": ["Car"]}, None, None, None, None), ("d", None, None, None, None, ["CAR", "car"])]
    found = mapping.resolve_mapping(spark.createDataFrame(entries, ENTRY), natives)
    assert sorted(tuple(r) for r in found.collect()) == [("a", "Car", "vehicle"), ("d", "Car", "car")]
    index = mapping.index_map(natives.where("project = 'a'").withColumn("idx", F.lit(0)), found.where("project = 'a'"))
    boxes = spark.createDataFrame([("a", 0), ("a", 7)], "project string, native_idx int")
    assert sorted((r.native_idx, r.class_id) for r in mapping.apply_index_map(boxes, index).collect()) == [(0, 1), (7, None)]
    with pytest.raises(Exception, match="unknown class key car"):
        mapping.class_ids(found).collect()


def test_class_token_must_be_a_whole_number(spark):
    lines = spark.createDataFrame([(i, f"{t} 0.1 0.1 0.1 0.1") for i, t in enumerate(("1", "+1", "1.0", "1e0", "x"))], "file_line int, value string")
    assert [(r.file_line, r.bad) for r in labels.parse_labels(lines, []).orderBy("file_line").collect()] == [(0, False), (1, False), (2, True), (3, True), (4, True)]


def test_chunks_of_a_long_file(spark):
    rows = spark.range(10_001).select(F.lit("s").alias("source"), F.lit("i").alias("stem"), (F.col("id") + 1).cast("int").alias("line_no"), F.lit(0).alias("class_id"), *[F.lit(0.5).alias(c) for c in ("cx", "cy", "w", "h")])
    assert [(r.chunk, r.text.count("\n")) for r in sinks.label_chunks(rows).orderBy("chunk").collect()] == [(0, 10_000), (1, 1)]


def test_promoted_boxes_are_the_last_lines(spark):
    boxes = spark.createDataFrame([("s", "i", 1, 0, 0.5, 0.5, 0.1, 0.1), ("s", "i", 4, 1, 0.5, 0.5, 0.1, 0.1)], BOX)
    preds = spark.createDataFrame([("s", "i", 9, 2, 0.1, 0.1, 0.2, 0.2, 0.9), ("s", "i", 8, 3, 0.1, 0.1, 0.2, 0.2, 0.8), ("s", "new", 1, 5, 0.1, 0.1, 0.2, 0.2, 0.8)], "source string, stem string, pred_no int, class_id int, x double, y double, w double, h double, conf double")
    text = {r.path: r.text for r in sinks.label_chunks(review.promote(boxes, review.route(preds))).collect()}
    assert [line.split()[0] for line in text["s/labels/i.txt"].splitlines()] == ["0", "1", "3", "2"]
    assert len(text["s/labels/new.txt"].splitlines()) == 1


def test_gates_that_must_fire(spark):
    names = spark.createDataFrame([("s", f"i{i}") for i in range(3)], "source string, stem string")
    assert review.hide_duplicates(names, names.limit(1), 3, names).count() == 2
    with pytest.raises(ValueError, match="covers 2 images"):
        review.hide_duplicates(names, names.limit(1), 2, names)
    wrong = [(i, n if i else "Persons") for i, n in enumerate(config.CLASS_NAMES)]
    with pytest.raises(ValueError, match="fixed list"):
        dims.checked_class_list(spark.createDataFrame(wrong, "class_id int, class_name string"), spark)
    with pytest.raises(Exception, match="empty splits: val"):
        sinks.training_manifest(spark.createDataFrame([("train", 1), ("val", 0), ("test", 1)], "split string, images int")).collect()
    members = spark.createDataFrame([("g", "a"), ("g", "b")], "grp string, key string")
    with pytest.raises(Exception):  # a planted leak
        split.require_no_leaks(members, spark.createDataFrame([("a", "s", "train"), ("b", "s", "test")], "key string, source string, split string"))


def test_unknown_image_matters_only_for_known_categories(spark):
    marks = spark.createDataFrame([("f", 1, 7, 5), ("f", 2, 1, 5), ("f", 3, 7, 6)], "folder string, line_no int, image_id long, category_id long")
    kinds = spark.createDataFrame([("f", 5, "Car")], "folder string, category_id long, native_name string")
    images = spark.createDataFrame([("f", 1, "a.jpg")], "folder string, image_id long, file_name string")
    got = annotations.resolve_coco(marks.where("line_no > 1"), kinds, images).orderBy("line_no").collect()
    assert [(r.native_name, r.file_name) for r in got] == [("Car", "a.jpg"), (None, None)]
    with pytest.raises(Exception, match="unknown image 7"):
        annotations.resolve_coco(marks, kinds, images).collect()


@pytest.mark.parametrize("threshold", [0.2, 0.3, 0.5, 0.8])
def test_grid_equals_plain_matching_at_any_threshold(spark, threshold):
    size = F.element_at(F.array(*[F.lit(x) for x in (0.02, 0.05, 0.11, 0.3)]), (F.col("id") % 4 + 1).cast("int"))
    place = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1000)) / 1000.0
    gt = spark.range(500).select(F.lit("s").alias("source"), F.lit("i").alias("stem"), F.col("id").cast("int").alias("box_no"), F.lit(0).alias("class_id"), place(1).alias("x"), place(2).alias("y"), size.alias("w"), (size * 1.5).alias("h"))
    preds = gt.select("source", "stem", F.col("box_no").alias("pred_no"), "class_id", (F.col("x") + F.col("w") * 0.1).alias("x"), "y", (F.col("w") * 1.3).alias("w"), (F.col("h") * 0.85).alias("h"), F.lit(0.5).alias("conf"))
    plain = sorted(tuple(r) for r in score.matches(gt, preds, threshold).collect())
    assert plain == sorted(tuple(r) for r in score.matches(gt, preds, threshold, crowded=1).collect())
    assert plain or threshold == 0.8


def test_wide_rows_are_not_broadcast(spark):
    wide = spark.range(20).select("id", F.repeat(F.lit("x"), BROADCAST_BYTES // 10).alias("t"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert not hinted(small_side(wide)) and hinted(small_side(spark.range(20).select("id")))


def test_known_but_ineligible_projects_are_reported(spark):
    schema = "key string, audit_status string, pinned_version int"
    projects = spark.createDataFrame([("a", "pending", 1), ("b", "pending", None), ("c", "failed", 2), ("d", "pending", 4)], schema)
    ask = lambda *keys: spark.createDataFrame([(k,) for k in keys], "key string")
    kept, skipped = dims.eligible_requested(projects, ask("a", "b", "c"))
    assert [r.key for r in kept.collect()] == ["a"]
    assert sorted(tuple(r) for r in skipped.collect()) == [("b", "pending — no pinned_version"), ("c", "failed")]
    with pytest.raises(ValueError, match="unknown key"):
        dims.eligible_requested(projects, ask("a", "z"))


def test_missing_folder_of_documents_counts_as_empty(spark, tmp_path):
    (tmp_path / "there").mkdir()
    (tmp_path / "there" / "labels.json").write_text('{"images": [{"id": 1, "file_name": "a.jpg", "width": 2, "height": 2}], "categories": [], "annotations": []}')
    paths = [f"{tmp_path}/{f}/labels.json" for f in ("there", "gone")]
    with pytest.warns(UserWarning, match="gone"):
        assert [t.count() for t in annotations.coco_tables(spark, paths)] == [0, 0, 1]
    with pytest.warns(UserWarning, match="gone"):
        assert [t.count() for t in annotations.coco_tables(spark, paths[1])] == [0, 0, 0]
