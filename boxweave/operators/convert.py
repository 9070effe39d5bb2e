"""Conversion to the box table: settle every box, decide per image, tally per source.

Input rows are (source, stem, line_no, class_id, box): ``class_id`` is null where the native name has no
class, ``line_no`` is null on the placeholder row of an image without boxes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from boxweave.functions.boxes import settle
from boxweave.operators.dims import class_dimension
from boxweave.runtime import cut_lineage, join_on_group, setting

IMAGE = ["source", "stem"]


def settled(rows: DataFrame, box: Column | str = "box") -> DataFrame:
    """Adds the status of every mapped box and its final geometry."""
    marked = rows.withColumn("__s", F.when(F.col("class_id").isNotNull() & F.col("line_no").isNotNull(), settle(box)))
    return marked.select(
        *[c for c in rows.columns if c != "box"],
        F.col("__s.status").alias("status"),
        *[F.col(f"__s.box.{c}").alias(c) for c in ("cx", "cy", "w", "h")],
    )


def stored(rows: DataFrame) -> DataFrame:
    """Settled rows written once, so that files are read and parsed once for the outcomes and the boxes of their images.

    HotSpot compiles no method above 8,000 bytes of code, and parsing with settling makes longer ones, which then run
    interpreted; with that limit Spark splits them.
    """
    with setting(rows.sparkSession, "spark.sql.codegen.hugeMethodLimit", 8_000):
        return cut_lineage(rows, "settled")


def kept(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("status").isin("ok", "clipped"))


def per_image(rows: DataFrame, images: DataFrame) -> DataFrame:
    """Box counts per annotated image and whether its file exists."""
    counts = rows.groupBy(*IMAGE).agg(
        F.count("line_no").alias("total"),
        F.count_if(F.col("class_id").isNotNull() & F.col("line_no").isNotNull()).alias("mapped"),
        F.count_if(F.col("line_no").isNotNull() & F.col("class_id").isNull()).alias("non_canonical"),
        F.count_if(F.col("status") == "clipped").alias("clipped"),
        F.count_if(F.col("status") == "invalid").alias("invalid"),
        F.count_if(F.col("status").isin("ok", "clipped")).alias("kept"),
    )
    there = images.select(*IMAGE).distinct().withColumn("has_image", F.lit(True))
    return counts.join(there, IMAGE, "left").withColumn("has_image", F.coalesce("has_image", F.lit(False)))


def lowlight_images(rows: DataFrame, images: DataFrame) -> DataFrame:
    """Only images that exist count at all; empty before or after validation is the same."""
    seen = per_image(rows, images).where("has_image")
    return seen.withColumn("outcome", F.when(F.col("kept") == 0, "empty").otherwise("converted"))


def crowd_images(rows: DataFrame, images: DataFrame) -> DataFrame:
    """No wanted box is empty, then a missing file, then nothing valid is empty again.

    Boxes of a missing image are never validated, so they are not tallied.
    """
    seen = per_image(rows, images)
    outcome = (
        F.when(F.col("mapped") == 0, "empty")
        .when(~F.col("has_image"), "missing")
        .when(F.col("kept") == 0, "empty")
        .otherwise("converted")
    )
    unread = F.col("outcome") == "missing"
    blank = {c: F.when(unread, 0).otherwise(F.col(c)) for c in ("clipped", "invalid")}
    return seen.withColumn("outcome", outcome).withColumns(blank)


def validated_images(rows: DataFrame, images: DataFrame) -> DataFrame:
    """Corner-pair and multi-split order: emptiness after validation comes before a missing file."""
    outcome = F.when(F.col("kept") == 0, "empty").when(~F.col("has_image"), "missing").otherwise("converted")
    return per_image(rows, images).withColumn("outcome", outcome)


def pooled_images(rows: DataFrame) -> DataFrame:
    """Pooled files always exist, so an image is converted or empty."""
    return per_image(rows, rows).withColumn("outcome", F.when(F.col("kept") == 0, "empty").otherwise("converted"))


def tallies(images: DataFrame, by: str = "source", kept_of_missing: bool = False) -> DataFrame:
    """Sum per source. Kept boxes count for converted images, or for every image if so asked."""
    counts = F.col("outcome") == "converted"
    boxes_kept = F.sum("kept") if kept_of_missing else F.sum(F.when(counts, F.col("kept")).otherwise(0))
    return images.groupBy(by).agg(
        F.sum("total").alias("boxes_total"),
        boxes_kept.alias("boxes_kept"),
        F.sum("non_canonical").alias("boxes_dropped_non_canonical"),
        F.sum("invalid").alias("boxes_invalid_dropped"),
        F.sum("clipped").alias("boxes_clipped"),
        F.count_if(counts).alias("images_converted"),
        F.count_if(F.col("outcome") == "empty").alias("images_dropped_empty"),
        F.count_if(F.col("outcome") == "missing").alias("images_missing"),
    )


def converted_boxes(rows: DataFrame, images: DataFrame) -> DataFrame:
    """The boxes that are written: kept ones of converted images."""
    done = images.where("outcome = 'converted'").select(*IMAGE, "total")
    return join_on_group(kept(rows), done, IMAGE, "total").select(*IMAGE, "line_no", "class_id", "cx", "cy", "w", "h")


def drop_empty_images(images: DataFrame, rows: DataFrame) -> DataFrame:
    return images.join(kept(rows).select(*IMAGE), IMAGE, "left_semi")


def class_counts(rows: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Images and instances per class before validation, zeros for absent classes."""
    folded = rows.where(F.col("class_id").isNotNull()).groupBy("class_id", *IMAGE).agg(F.count(F.lit(1)).alias("c"))
    counts = folded.groupBy("class_id").agg(F.count(F.lit(1)).alias("images"), F.sum("c").alias("instances"))
    names = class_dimension(rows.sparkSession) if classes is None else classes
    return names.select("class_id", "class_key").join(counts, "class_id", "left").na.fill(0)


def sum_tallies(inputs: DataFrame) -> DataFrame:
    """Add (key, value) tallies over several inputs."""
    return inputs.groupBy("key").agg(F.sum("value").alias("value"))
