import math

import pytest
from pyspark.sql import functions as F

from boxweave.functions import boxes as bx

CASES = [
    # cx, cy, w, h, status after settling
    (0.5, 0.5, 0.2, 0.2, "ok"),
    (0.5, 0.5, 0.0, 0.2, "invalid"),
    (0.5, 0.5, -0.1, 0.2, "invalid"),
    (0.95, 0.5, 0.2, 0.2, "clipped"),
    (1.5, 0.5, 0.2, 0.2, "invalid"),
    (0.5, 0.5, 1.0, 1.0, "ok"),
]


def test_settle(spark):
    df = spark.createDataFrame(CASES, "cx double, cy double, w double, h double, want string")
    rows = df.withColumn("s", bx.settle(bx.box_struct("cx", "cy", "w", "h"))).select("want", "s.*").collect()
    assert [r["status"] for r in rows] == [r["want"] for r in rows]
    clipped = rows[3]["box"]
    assert clipped["w"] == pytest.approx(0.15) and clipped["cx"] == pytest.approx(0.925)
    assert rows[4]["box"]["w"] == 0.0


def test_tolerance_only_forgives_rounding(spark):
    df = spark.createDataFrame([(0.5 + 5e-7, 1.0), (0.51, 1.0)], "cx double, w double")
    kinds = [
        (r[0], r[1])
        for r in df.select(
            bx.invalid_kind("cx", F.lit(0.5), "w", F.lit(0.1)), bx.invalid_kind("cx", F.lit(0.5), "w", F.lit(0.1), 1e-4)
        ).collect()
    ]
    assert kinds == [(bx.OUT_OF_BOUNDS, None), (bx.OUT_OF_BOUNDS, bx.OUT_OF_BOUNDS)]


def test_reason_text(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.0, 0.2), (1.5, 0.5, 0.2, 0.2)], "cx double, cy double, w double, h double")
    got = [r[0] for r in df.select(bx.invalid_reason("cx", "cy", "w", "h")).collect()]
    assert got == [
        "non-positive width/height (w=0.0, h=0.2)",
        "box extends outside image bounds (x1=1.4000, y1=0.4000, x2=1.6000, y2=0.6000)",
    ]


def test_elongation_without_a_side_is_infinite(spark):
    df = spark.createDataFrame([(0.2, 0.1), (0.0, 0.1), (-0.2, 0.1)], "w double, h double")
    got = [r[0] for r in df.select(bx.elongation()).collect()]
    assert got[0] == pytest.approx(2.0) and math.isinf(got[1]) and math.isinf(got[2])


def test_names(spark):
    df = spark.createDataFrame([("a__b__c.v1.jpg",), (".hidden",), ("plain",)], "n string")
    got = [tuple(r) for r in df.select(bx.merged_source("n"), bx.stem("n")).collect()]
    assert got == [("a", "a__b__c.v1"), (".hidden", ".hidden"), ("plain", "plain")]
    assert df.select(bx.strip_project_prefix(F.lit("roboflow_x_roboflow_y"))).first()[0] == "x_roboflow_y"


def test_swapped_corners_show_as_negative_side(spark):
    b = spark.range(1).select(bx.from_corners(F.lit(0.8), F.lit(0.2), F.lit(0.4), F.lit(0.6)).alias("b")).first()["b"]
    assert b["w"] == pytest.approx(-0.4) and b["cx"] == pytest.approx(0.6)
