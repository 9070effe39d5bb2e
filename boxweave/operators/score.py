"""Disagreement between labels and predictions, per image.

Ground truth is (source, stem, box_no, class_id, x, y, w, h) and predictions are (source, stem, pred_no,
class_id, x, y, w, h, conf), both top-left.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from boxweave import config
from boxweave.functions.boxes import corners_to_top_left, overlap_ratio, to_top_left
from boxweave.operators.dims import class_dimension, class_label
from boxweave.operators.mapping import remap_predictions

IMAGE = ["source", "stem"]
SHAPE = ["x", "y", "w", "h"]
# Images with more boxes than this on either side are matched through a grid.
CROWDED = 200
# The level of the one cell that is a whole image.
WHOLE_IMAGE = -10_000


def eligible(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("class_id").isin(*config.proxy_class_ids()))


def scope_from_selection(selection: DataFrame, limit: int | None = None) -> DataFrame:
    """Images selected for any class the proxy model knows; the first ``limit`` by key if limited."""
    found = eligible(selection).select(*IMAGE).distinct()
    return found if limit is None else found.orderBy(*IMAGE).limit(limit)


def scope_from_pool(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Images with at least one box of such a class."""
    return images.join(eligible(boxes).select(*IMAGE), IMAGE, "left_semi")


def ground_truth(boxes: DataFrame) -> DataFrame:
    """Boxes of classes the model knows, as top-left boxes."""
    t = eligible(boxes).withColumn("t", to_top_left())
    return t.select(*IMAGE, F.col("line_no").alias("box_no"), "class_id", "t.x", "t.y", "t.w", "t.h")


def overlay(
    images: DataFrame, model: Callable[[pd.DataFrame], pd.DataFrame], walk: DataFrame, batch: int = 16
) -> DataFrame:
    """Run a model over image batches and remap its detections.

    ``model`` gets up to ``batch`` image rows and returns (source, stem, pred_no, native_name, x1, y1, x2, y2,
    conf); names outside the crosswalk are dropped.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for start in range(0, len(rows), batch):
                yield model(rows.iloc[start : start + batch])

    schema = "source string, stem string, pred_no int, native_name string, x1 double, y1 double, x2 double, y2 double, conf double"
    found = remap_predictions(images.mapInPandas(run, schema), walk).withColumn("t", corners_to_top_left("x1", "y1", "x2", "y2"))
    return found.select(*IMAGE, "pred_no", "class_id", "t.x", "t.y", "t.w", "t.h", "conf")


def _axis_entries(start: str, side: str, threshold: float, is_prediction: bool) -> Column:
    """(l, c, r) entries along one axis: the cells a box touches on its own level and on those above it.

    Cells of level l are 4^l wide. A box's own level is the first whose cells are at least as wide as the box, so it
    touches two of them at most, there and above. Boxes whose overlap ratio is t have sides within 1/t of each other, so
    one's own level is at most log4(1/t) above the other's: there the pair meets. ``r`` says whose own level
    it is, the ground truth's if both, so that two boxes far smaller than a cell never meet in it.
    """

    def entry(level: Column, role: str):
        return lambda cell: F.struct(level.alias("l"), cell.alias("c"), F.lit(role).alias("r"))

    own = F.ceil(F.log2(F.col(side)) / 2).cast("int")
    entries = []
    for up in range(math.ceil(math.log(1 / threshold, 4) + 1e-9) + 1):
        level = own + up
        width = F.pow(F.lit(4.0), level)
        cells = F.sequence(F.floor(F.col(start) / width), F.floor((F.col(start) + F.col(side)) / width))
        for role in ("gp" if up == 0 else "g") if is_prediction else ("g" if up == 0 else "p"):
            entries.append(F.transform(cells, entry(level, role)))
    return F.concat(*entries)


def _entries(rows: DataFrame, busy: DataFrame, threshold: float, is_prediction: bool) -> DataFrame:
    """Adds at_x and at_y, the cells of a box: one for the whole image, or those of the grid if it is crowded."""
    flagged = rows.join(busy.withColumn("crowd", F.lit(True)), IMAGE, "left")
    crowd = flagged.where("crowd").drop("crowd")
    best = F.struct((-F.col("conf")).alias("c"), "pred_no") if is_prediction else F.struct("box_no")
    grid = fold_shapes(crowd, best).select(*rows.columns)
    for axis, (start, side) in {"at_x": ("x", "w"), "at_y": ("y", "h")}.items():
        grid = grid.withColumn(axis, F.explode(_axis_entries(start, side, threshold, is_prediction)))
    whole = F.struct(F.lit(WHOLE_IMAGE).alias("l"), F.lit(0).cast("long").alias("c"), F.lit("g").alias("r"))
    plain = flagged.where("crowd is null").drop("crowd").withColumn("at_x", whole).withColumn("at_y", whole)
    return plain.unionByName(grid)


def _first_shared(at: str, g: str, p: str) -> Column:
    """Of the cells two boxes share on a level, the one where their common stretch begins."""
    begin = F.floor(F.greatest(g, p) / F.pow(F.lit(4.0), F.col(f"{at}.l")))
    return (F.col(f"{at}.l") == WHOLE_IMAGE) | (F.col(f"{at}.c") == begin)


def overlaps(gt: DataFrame, preds: DataFrame, threshold: float, crowded: int) -> DataFrame:
    """Pairs of one image at or above the overlap threshold; equal shapes of a crowded image stand for each other."""
    if not 0 < threshold <= 1:
        raise ValueError("an overlap threshold lies above 0 and at most at 1")
    counts = [side.groupBy(*IMAGE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowded) for side in (gt, preds)]
    busy = counts[0].unionByName(counts[1]).select(*IMAGE).distinct()
    names = {"g": ["box_no", F.col("class_id").alias("g_class")], "p": ["pred_no", F.col("class_id").alias("p_class"), "conf"]}
    g, p = (
        _entries(rows, busy, threshold, name == "p").select(*IMAGE, "at_x", "at_y", *names[name], *[F.col(c).alias(f"{name}{c}") for c in SHAPE])
        for name, rows in (("g", gt), ("p", preds))
    )
    met = g.join(p, [*IMAGE, "at_x", "at_y"]).where(_first_shared("at_x", "gx", "px") & _first_shared("at_y", "gy", "py"))
    ratio = overlap_ratio("gx", "gy", "gw", "gh", "px", "py", "pw", "ph")
    return met.withColumn("iou", ratio).where(F.col("iou") >= threshold).select(*IMAGE, "box_no", "g_class", "pred_no", "p_class", "conf", "iou")


def fold_shapes(rows: DataFrame, first) -> DataFrame:
    """One box per image and shape, the one that wins every tie; its copies can never be a mutual best."""
    rest = [c for c in rows.columns if c not in (*IMAGE, *SHAPE)]
    kept = rows.groupBy(*IMAGE, *SHAPE).agg(F.min_by(F.struct(*rest), first).alias("r"))
    return kept.select(*IMAGE, *SHAPE, "r.*")


def matches(gt: DataFrame, preds: DataFrame, threshold: float = config.MATCH_IOU, crowded: int = CROWDED) -> DataFrame:
    """Mutual best pairs at or above the overlap threshold.

    A box's best partner has the highest overlap, then the higher confidence, then the smaller number.
    Images with more than ``crowded`` boxes are joined cell by cell of a grid, all others whole, in one join.
    """
    solid = (F.col("w") > 0) & (F.col("h") > 0)  # nothing overlaps a box without area
    pairs = overlaps(gt.where(solid), preds.where(solid), threshold, crowded)
    by_box = Window.partitionBy(*IMAGE, "box_no").orderBy(F.desc("iou"), F.desc("conf"), "pred_no")
    by_pred = Window.partitionBy(*IMAGE, "pred_no").orderBy(F.desc("iou"), F.desc("conf"), "box_no")
    ranked = pairs.withColumn("rb", F.row_number().over(by_box)).withColumn("rp", F.row_number().over(by_pred))
    return ranked.where("rb = 1 and rp = 1").drop("rb", "rp")


def image_scores(
    gt: DataFrame, preds: DataFrame, threshold: float = config.MATCH_IOU, crowded: int = CROWDED
) -> DataFrame:
    """(source, stem, mistakenness) per image of ``gt``: the highest pair score, or -1 without any pair.

    A pair scores (1 - conf) / 2 if the classes agree and (1 + conf) / 2 if they do not.
    """
    sign = F.when(F.col("g_class") == F.col("p_class"), -1.0).otherwise(1.0)
    best = matches(gt, preds, threshold, crowded).groupBy(*IMAGE).agg(F.max((1 + sign * F.col("conf")) / 2).alias("score"))
    images = gt.select(*IMAGE).distinct()
    return images.join(best, IMAGE, "left").select(*IMAGE, F.coalesce("score", F.lit(-1.0)).alias("mistakenness"))


def ranking(gt: DataFrame, preds: DataFrame, scores: DataFrame) -> DataFrame:
    """Scored images with box counts and sorted class names, worst first."""
    g = gt.groupBy(*IMAGE).agg(
        F.count(F.lit(1)).alias("gt_box_count"),
        F.array_sort(F.collect_set(class_label())).alias("classes"),  # at most the 16 known names
    )
    p = preds.groupBy(*IMAGE).agg(F.count(F.lit(1)).alias("pred_box_count"))
    rows = scores.join(g, IMAGE).join(p, IMAGE, "left").na.fill(0, ["pred_box_count"])
    return rows.orderBy(F.desc("mistakenness"), *IMAGE)


def review_slice(ranked: DataFrame, n: int = config.REVIEW_TOP_N) -> DataFrame:
    return ranked.orderBy(F.desc("mistakenness"), *IMAGE).limit(n)


def missing_images(boxes: DataFrame, images: DataFrame) -> DataFrame:
    """Images with an eligible label but no file."""
    return eligible(boxes).select(*IMAGE).distinct().join(images.select(*IMAGE), IMAGE, "left_anti")


def uncovered_classes(walk: DataFrame) -> DataFrame:
    """Classes the proxy model has no name for, derived from the crosswalk."""
    return class_dimension(walk.sparkSession).select("class_id", "class_name").join(walk, "class_name", "left_anti")
