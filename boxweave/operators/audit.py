"""Box audit: pairing, per-group statistics and fences, flags with reasons, balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from boxweave import config
from boxweave.functions import boxes as bx
from boxweave.functions.ranking import exclusive_quartiles, first_k
from boxweave.operators.dims import class_dimension, class_label, known_class
from boxweave.runtime import small_side

GROUP = ["source", "class_id"]


def pairing(images: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per stem of a source with which sides exist."""
    left = images.select("source", "stem").distinct().withColumn("has_image", F.lit(True))
    right = labels.select("source", "stem").distinct().withColumn("has_label", F.lit(True))
    return left.join(right, ["source", "stem"], "full_outer").select(
        "source",
        "stem",
        F.coalesce("has_image", F.lit(False)).alias("has_image"),
        F.coalesce("has_label", F.lit(False)).alias("has_label"),
    )


def pairing_stats(paired: DataFrame) -> DataFrame:
    return paired.groupBy("source").agg(
        F.count_if("has_image").alias("images_total"),
        F.count_if("has_label").alias("labels_total"),
        F.count_if(F.col("has_image") & ~F.col("has_label")).alias("images_without_label"),
        F.count_if(F.col("has_label") & ~F.col("has_image")).alias("labels_without_image"),
    )


def one_sided_sample(paired: DataFrame, k: int = config.ONE_SIDED_SAMPLE) -> DataFrame:
    side = F.when(F.col("has_image"), "image").otherwise("label")
    single = paired.where(F.col("has_image") != F.col("has_label")).select("source", side.alias("side"), "stem")
    return first_k(single, ["source", "side"], ["stem"], k)


def empty_label_files(manifest: DataFrame, lines: DataFrame) -> DataFrame:
    """Label files with no non-blank line; the manifest is needed as zero-length files yield no row."""
    filled = lines.where(F.trim("value") != "").select("source", "stem").distinct()
    return manifest.select("source", "stem").join(filled, ["source", "stem"], "left_anti")


def measured(rows: DataFrame) -> DataFrame:
    return rows.withColumn("area", bx.area_fraction()).withColumn("elong", bx.elongation())


def _long(rows: DataFrame) -> DataFrame:
    """One row per box and finite measure, so one pass serves both."""
    pair = F.array(
        F.struct(F.lit("area").alias("measure"), F.col("area").alias("value")),
        F.struct(F.lit("elong").alias("measure"), F.when(F.col("elong") < float("inf"), F.col("elong")).alias("value")),
    )
    return rows.select(*GROUP, F.explode(pair).alias("m")).select(*GROUP, "m.measure", "m.value")


def fences(rows: DataFrame) -> DataFrame:
    """(source, class_id, measure, n, q1, median, q3, fence); the fence is null below the minimum size."""
    quartiles = exclusive_quartiles(_long(measured(rows)), [*GROUP, "measure"], "value")
    fence = F.when(
        F.col("n") >= config.FENCE_MIN_BOXES,
        F.col("q3") + F.lit(config.FENCE_FACTOR) * (F.col("q3") - F.col("q1")),
    )
    return quartiles.select(*GROUP, "measure", "n", "q1", F.col("q2").alias("median"), "q3", fence.alias("fence"))


def wide_fences(rows: DataFrame) -> DataFrame:
    """One row per (source, class) with both medians and both fences."""
    pick = lambda measure, column: F.max(F.when(F.col("measure") == measure, F.col(column)))
    return fences(rows).groupBy(*GROUP).agg(
        pick("area", "median").alias("area_median"),
        pick("elong", "median").alias("elong_median"),
        pick("area", "fence").alias("area_fence"),
        pick("elong", "fence").alias("elong_fence"),
    )


def group_stats(rows: DataFrame) -> DataFrame:
    """Counts and min/max/mean/median per (source, class); elongation over finite values only.

    Images are counted by first folding boxes to (group, image), so no task holds a group's image set.
    """
    finite = F.when(F.col("elong") < float("inf"), F.col("elong"))
    per_image = measured(rows).groupBy(*GROUP, "stem").agg(
        F.count(F.lit(1)).alias("c"),
        F.min("area").alias("a0"),
        F.max("area").alias("a1"),
        F.sum("area").alias("a"),
        F.min(finite).alias("e0"),
        F.max(finite).alias("e1"),
        F.sum(finite).alias("e"),
        F.count(finite).alias("ec"),
    )
    folded = per_image.groupBy(*GROUP).agg(
        F.sum("c").alias("instances"),
        F.count(F.lit(1)).alias("images"),
        F.min("a0").alias("area_min"),
        F.max("a1").alias("area_max"),
        (F.sum("a") / F.sum("c")).alias("area_mean"),
        F.min("e0").alias("elong_min"),
        F.max("e1").alias("elong_max"),
        (F.sum("e") / F.nullif(F.sum("ec"), F.lit(0))).alias("elong_mean"),
    )
    return folded.join(wide_fences(rows), GROUP, "left").withColumn("class_name", class_label())


def reasons(area_fence: Column | str = "area_fence", elong_fence: Column | str = "elong_fence") -> Column:
    invalid = bx.invalid_reason("cx", "cy", "w", "h", config.AUDIT_EPSILON)
    found = F.array(
        F.when(invalid.isNotNull(), F.concat(F.lit("invalid: "), invalid)),
        F.when(F.col("area") < config.TINY_AREA, F.lit("tiny_box")),
        F.when(F.col("area") > F.col(area_fence), F.format_string("large_area_outlier (>%.4f)", F.col(area_fence))),
        F.when(F.col("elong") > F.col(elong_fence), F.format_string("shape_outlier (elongation>%.2f)", F.col(elong_fence))),
    )
    return F.array_compact(found)


def reason_key(reason: Column) -> Column:
    return F.substring_index(F.substring_index(reason, " (", 1), ": ", 1)


def flag_boxes(rows: DataFrame) -> DataFrame:
    """Boxes with at least one reason. Fences are one row per group and joined back by checked broadcast."""
    limits = small_side(wide_fences(rows).select(*GROUP, "area_fence", "elong_fence"))
    # The cheap tests filter; reasons are only written out for what they let through.
    odd = (
        bx.invalid_kind("cx", "cy", "w", "h", config.AUDIT_EPSILON).isNotNull()
        | (F.col("area") < config.TINY_AREA)
        | (F.col("area") > F.col("area_fence"))
        | (F.col("elong") > F.col("elong_fence"))
    )
    return (
        measured(rows)
        .join(limits, GROUP, "left")
        .where(odd)
        .withColumn("reasons", reasons())
        .withColumn("class_name", class_label())
    )


def reason_counts(flagged: DataFrame) -> DataFrame:
    return (
        flagged.select("source", F.explode("reasons").alias("r"))
        .groupBy("source", reason_key(F.col("r")).alias("reason"))
        .agg(F.count(F.lit(1)).alias("boxes"))
    )


def flag_sample(flagged: DataFrame, k: int = config.FLAG_SAMPLE) -> DataFrame:
    """First ``k`` flagged boxes of a source in class, file and line order."""
    return first_k(flagged, ["source"], ["class_id", "stem", "line_no"], k)


def class_balance(rows: DataFrame) -> DataFrame:
    """Images and instances per class over all sources, zeros kept; a stem counts once per source."""
    per_image = rows.where(known_class()).groupBy("class_id", "source", "stem").agg(F.count(F.lit(1)).alias("c"))
    counts = per_image.groupBy("class_id").agg(F.count(F.lit(1)).alias("images"), F.sum("c").alias("instances"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return (
        class_dimension(rows.sparkSession)
        .select("class_id", "class_name")
        .join(counts, "class_id", "left")
        .select("class_id", "class_name", zero("images"), zero("instances"))
    )


def unknown_classes(rows: DataFrame) -> DataFrame:
    """Instances per class id outside the fixed list."""
    return rows.where(~known_class()).groupBy("class_id").agg(F.count(F.lit(1)).alias("instances"))


def flag_rates(rows: DataFrame, flagged: DataFrame) -> DataFrame:
    """Share of flagged boxes per source, highest first."""
    total = rows.groupBy("source").agg(F.count(F.lit(1)).alias("boxes"))
    bad = flagged.groupBy("source").agg(F.count(F.lit(1)).alias("flagged"))
    return (
        total.join(bad, "source", "left")
        .select("source", "boxes", F.coalesce("flagged", F.lit(0)).alias("flagged"))
        .withColumn("rate", F.col("flagged") / F.col("boxes"))
        .orderBy(F.desc("rate"), "source")
    )


def audit_totals(rows: DataFrame, flagged: DataFrame) -> DataFrame:
    total = rows.groupBy("source").agg(F.count(F.lit(1)).alias("boxes_total"))
    bad = flagged.groupBy("source").agg(
        F.count(F.lit(1)).alias("boxes_flagged"),
        F.count_if(F.exists("reasons", lambda r: r.startswith("invalid"))).alias("boxes_invalid"),
    )
    return total.join(bad, "source", "left").na.fill(0, ["boxes_flagged", "boxes_invalid"])
