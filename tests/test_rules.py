import pytest
from pyspark.sql import functions as F

from boxweave import config
from boxweave.config import CapPolicy
from boxweave.operators import audit, cap, convert, dims, mapping, review, score, selection, split

BOX = "source string, stem string, line_no int, class_id int, cx double, cy double, w double, h double"


def test_class_list_and_names(spark):
    wrong = spark.createDataFrame([(i, n if i else "Persons") for i, n in enumerate(config.CLASS_NAMES)], "class_id int, class_name string")
    with pytest.raises(ValueError):
        dims.checked_class_list(wrong, spark)
    with pytest.raises(Exception, match="unknown class name"):
        dims.with_class_id(spark.createDataFrame([("Perso",)], "class_name string")).collect()
    labels = [r[0] for r in spark.createDataFrame([(-1,), (0,), (15,), (16,)], "class_id int").select(dims.class_label()).collect()]
    assert labels == ["unknown_id_-1", "Person", "Bicycle", "unknown_id_16"]


def test_missing_status_is_active_and_rejected_stays(spark):
    rows = [("a", False, None), ("b", False, "failed"), ("c", True, "benched"), ("c", False, "rejected"), ("d", True, "blocked")]
    found = dims.inactive_sources(spark.createDataFrame(rows, "key string, is_project boolean, audit_status string"))
    assert sorted(r[0] for r in found.collect()) == ["b", "roboflow_c", "roboflow_d"]


def test_quota_needs_a_cap(spark):
    df = spark.createDataFrame([(4500,), (1,)], "cap int")
    q = dims.buffered_quota()
    assert [tuple(r) for r in df.select(q, dims.per_split_quota(q)).collect()] == [(6075, 2025), (2, 1)]
    with pytest.raises(Exception, match="no cap"):
        spark.createDataFrame([(None,)], "cap int").select(q).collect()


def test_unknown_request_is_an_error(spark):
    known = spark.createDataFrame([("a", 1), ("b", 2)], "source string, n int")
    ask = lambda *s: spark.createDataFrame([(x,) for x in s], "source string")
    assert [r["n"] for r in dims.restrict_to_requested(known, ask("b"), known, "source").collect()] == [2]
    with pytest.raises(ValueError, match="zzz"):
        dims.restrict_to_requested(known, ask("b", "zzz"), known, "source")


def test_mapping_cases(spark):
    schema = "project string, filter_map map<string,array<string>>, filter_name string, filter_list array<string>, canonical_class string, canonical_classes array<string>"
    natives = spark.createDataFrame([(p, n) for p in "abcd" for n in ("Car", "truck", "Other")], "project string, native_name string")
    entries = [
        ("a", {"vehicle": ["Car", "truck"], "doors": ["Car2"]}, None, None, "ignored", None),
        ("b", None, "Car", None, "vehicle", None),
        ("c", None, None, None, "vehicle", None),
        ("d", None, None, None, None, ["Truck", "CAR"]),
    ]
    got = sorted(tuple(r) for r in mapping.resolve_mapping(spark.createDataFrame(entries, schema), natives).collect())
    assert got == [
        ("a", "Car", "vehicle"), ("a", "Car2", "doors"), ("a", "truck", "vehicle"), ("b", "Car", "vehicle"),
        ("c", "Car", "vehicle"), ("c", "Other", "vehicle"), ("c", "truck", "vehicle"), ("d", "Car", "CAR"), ("d", "truck", "Truck"),
    ]
    bare = spark.createDataFrame([("a", None, None, ["Car"], "vehicle", None)], schema)
    with pytest.raises(Exception, match="bare list"):
        mapping.resolve_mapping(bare, natives).collect()


def test_index_override_must_be_complete(spark):
    schema = "project string, names array<string>, overrides map<string,string>"
    ok = spark.createDataFrame([("p", ["x", "y"], {"0": "A", "1": "A"}), ("q", ["x"], None)], schema)
    assert sorted(tuple(r) for r in mapping.native_index(ok).collect()) == [("p", 0, "A"), ("p", 1, "A"), ("q", 0, "x")]
    with pytest.raises(Exception, match="no override"):
        mapping.native_index(spark.createDataFrame([("p", ["x", "y"], {"0": "A"})], schema)).collect()


def test_crosswalk_must_be_known_to_the_model(spark):
    walk = mapping.crosswalk(spark)
    names = [n.upper() for ns in config.PROXY_CLASSES.values() for n in ns]
    mapping.checked_crosswalk(walk, spark.createDataFrame([(n,) for n in names], "native_name string"))
    with pytest.raises(ValueError, match="dining table"):
        mapping.checked_crosswalk(walk, spark.createDataFrame([(n,) for n in names[:-1]], "native_name string"))
    assert score.uncovered_classes(walk).count() == 9


def test_conversion_orders_differ(spark):
    box = lambda w: (0.5, 0.5, w, 0.1)
    rows = [("s", "good", 1, 0, box(0.1)), ("s", "gone_ok", 1, 0, box(0.1)), ("s", "gone_bad", 1, 0, box(0.0)),
            ("s", "bad", 1, 0, box(0.0)), ("s", "none", None, None, box(0.1)), ("s", "other", 1, None, box(0.1))]
    df = spark.createDataFrame(rows, "source string, stem string, line_no int, class_id int, box struct<cx:double,cy:double,w:double,h:double>")
    images = spark.createDataFrame([("s", n) for n in ("good", "bad", "none", "other")], "source string, stem string")
    done = convert.settled(df)
    outcome = lambda t: {r["stem"]: r["outcome"] for r in t.collect()}
    crowd, checked = convert.crowd_images(done, images), convert.validated_images(done, images)
    assert outcome(crowd) == {"good": "converted", "gone_ok": "missing", "gone_bad": "missing", "bad": "empty", "none": "empty", "other": "empty"}
    assert outcome(checked) == {"good": "converted", "gone_ok": "missing", "gone_bad": "empty", "bad": "empty", "none": "empty", "other": "empty"}
    assert set(outcome(convert.lowlight_images(done, images))) == {"good", "bad", "none", "other"}
    assert convert.tallies(crowd).first()["boxes_invalid_dropped"] == 1
    assert convert.tallies(checked).first()["boxes_invalid_dropped"] == 2
    assert convert.tallies(checked).first()["boxes_kept"] == 1
    assert convert.tallies(checked, kept_of_missing=True).first()["boxes_kept"] == 2
    assert [r["stem"] for r in convert.converted_boxes(done, checked).collect()] == ["good"]


def test_fence_needs_twenty_boxes(spark):
    rows = [("s", f"i{i}", 1, c, 0.5, 0.5, 0.1 + 0.001 * i, 0.1) for c, n in ((0, 19), (1, 20)) for i in range(n)]
    rows += [("s", "wide", 1, 1, 0.5, 0.5, 0.9, 0.9)]
    f = {(r["class_id"], r["measure"]): r["fence"] for r in audit.fences(spark.createDataFrame(rows, BOX)).collect()}
    assert f[0, "area"] is None and f[1, "area"] is not None
    flagged = audit.flag_boxes(spark.createDataFrame(rows, BOX)).collect()
    assert [(r["stem"], r["reasons"][0].split(" ")[0]) for r in flagged] == [("wide", "large_area_outlier")]
    unknown = audit.flag_boxes(spark.createDataFrame([("s", "i", 1, 16, 0.5, 0.5, 0.0, 0.1)], BOX)).first()
    assert unknown["class_name"] == "unknown_id_16" and len(unknown["reasons"]) == 2


def test_inputs_must_be_compatible(spark):
    base = {"seed": 42, "instance_target": 10, "class_names": ["a"]}
    selection.check_compatible([base, dict(base)])
    for field, other in (("seed", 1), ("instance_target", 2), ("class_names", ["b"])):
        with pytest.raises(ValueError, match=field):
            selection.check_compatible([base, {**base, field: other}])
    with pytest.raises(ValueError):
        selection.check_compatible([base])
    with pytest.raises(ValueError):
        selection.union([spark.createDataFrame([], "class_id int, source string, stem string")])


def test_default_policy_and_empty_classes(spark):
    with pytest.raises(ValueError):
        CapPolicy(hard_cap=0)
    found = spark.createDataFrame([(0, "exdark", "a", 2), (0, "web", "b", 1)], "class_id int, source string, stem string, cnt long")
    result = cap.select_images(found, CapPolicy())
    summary = cap.class_summary(result)
    rows = {r["class_id"]: r for r in summary.collect()}
    assert rows[0]["final_images"] == 2 and rows[0]["stop_reason"] == "all_candidates_included"
    assert rows[5]["final_images"] == 0 and not rows[5]["floor_met"]
    ratio = cap.ratio_invariant(summary).first()
    assert ratio["max_class"] == "Person" and ratio["min_class"] == "Vehicle" and ratio["ratio"] == float("inf")
    assert ratio["recompute_trigger"] and ratio["recomputed_cap"] == 0
    lanes = {(r["class_id"], r["source"]): r for r in cap.lane_table(spark, CapPolicy(1500)).collect()}
    assert lanes[0, "crowdhuman"]["subbudget"] == 833 and lanes[0, "exdark"]["reserved"] == 375 and lanes[5, "exdark"]["reserved"] == 0


def test_gate(spark):
    counts = spark.createDataFrame([(None, None, 5), (4, 4, 5), (5, 3, 5), (9, 9, 5), (9, None, 5)], "checked int, sampled int, pool int")
    assert [(r["applies"], r["full_scale"]) for r in split.coverage_gate(counts).collect()] == [
        (False, False), (False, False), (True, False), (True, True), (True, True),
    ]


def test_review_edges(spark):
    images = spark.createDataFrame([("s", n) for n in "abc"], "source string, stem string")
    with pytest.raises(ValueError):
        review.hide_duplicates(images, images, 2, images)
    left = review.hide_duplicates(images, images.where("stem = 'b'"), 3, images)
    assert sorted(r["stem"] for r in left.collect()) == ["a", "c"]
    old = spark.createDataFrame([("s", "a", 1, 0, 0.5, 0.5, 0.1, 0.1), ("s", "b", 1, 0, 0.5, 0.5, 0.1, 0.1)], BOX)
    new = spark.createDataFrame([("s", "a", 1, 0, 0.5, 0.5, 0.1, 0.1000001), ("s", "b", 1, 1, 0.5, 0.5, 0.1, 0.1)], BOX)
    assert {r["stem"]: r["change"] for r in review.diff(images, old, new).collect()} == {"a": "unchanged", "b": "modified", "c": "unchanged"}
    det = spark.createDataFrame([("s", "a", 1, "Pole", [0.1, 0.1, 0.2, 0.2]), ("s", "a", 2, "Pole", []), ("s", "a", 3, "Pole", None)],
                                "source string, stem string, line_no int, class_name string, bounding_box array<double>")
    rows, skipped = review.rewrite(det)
    assert [r["class_id"] for r in rows.collect()] == [3] and skipped.count() == 2
    with pytest.raises(Exception, match="unknown class name"):
        review.rewrite(det.withColumn("class_name", F.lit("Pol")))[0].collect()
    assert review.route(spark.createDataFrame([(0.7,), (0.69,)], "conf double")).where("tag = 'accept'").count() == 1
    assert review.route(spark.createDataFrame([(0.9,)], "conf double"), None).first()["tag"] == "manual"
