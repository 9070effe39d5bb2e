"""Merging selected images into one pool."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from boxweave.operators.audit import class_balance, unknown_classes
from boxweave.runtime import small_side
from boxweave.sources.files import stem_index

IMAGE = ["source", "stem"]


def apply_exclusions(selected: DataFrame, excluded: DataFrame) -> DataFrame:
    """Selected images minus reviewed exclusions; nothing is filled back in."""
    return selected.join(excluded.select(*IMAGE), IMAGE, "left_anti")


def exclusion_hits(selected: DataFrame, excluded: DataFrame) -> DataFrame:
    """The exclusions that were selected at all."""
    return selected.join(excluded.select(*IMAGE), IMAGE, "left_semi")


def resolve_files(selected: DataFrame, images: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcome per selected image. The image is looked up first, so a double miss is a missing image.

    ``images`` is (source, stem, filename); ``labels`` has one or more rows per labelled image.
    """
    files = stem_index(images)
    has = labels.select(*IMAGE).distinct().withColumn("has_label", F.lit(True))
    outcome = (
        F.when(F.col("filename").isNull(), "missing_image").when(F.col("has_label").isNull(), "missing_label").otherwise("merged")
    )
    return (
        selected.select(*IMAGE)
        .join(files, IMAGE, "left")
        .join(has, IMAGE, "left")
        .select(*IMAGE, "filename", outcome.alias("outcome"))
    )


def merged(resolved: DataFrame) -> DataFrame:
    return resolved.where("outcome = 'merged'").withColumn("dst", F.concat_ws("__", "source", "filename"))


def per_source(resolved: DataFrame) -> DataFrame:
    return resolved.where("outcome = 'merged'").groupBy("source").agg(F.count(F.lit(1)).alias("images"))


def carried_boxes(boxes: DataFrame, resolved: DataFrame) -> DataFrame:
    """All boxes of a merged image, also those of classes it was not selected for.

    A capped selection holds at most classes x cap images, so after its size is checked it is broadcast and
    the box table is not shuffled.
    """
    return boxes.join(small_side(resolved.where("outcome = 'merged'").select(*IMAGE)), IMAGE, "left_semi")


def merged_counts(carried: DataFrame) -> tuple[DataFrame, DataFrame]:
    """True images and instances per class, and instances of ids outside the list."""
    return class_balance(carried), unknown_classes(carried)
