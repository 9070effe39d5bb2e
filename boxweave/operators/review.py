"""Review scope and the folding of review decisions back into labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from boxweave import config
from boxweave.functions.boxes import from_top_left
from boxweave.operators.dims import with_class_id
from boxweave.runtime import cut_lineage
from boxweave.sources.sinks import read_store, upsert_store

IMAGE = ["source", "stem"]
CORNERS = ["cx", "cy", "w", "h"]
# Folders of a reviewed store: a session rewrites those its images fall into.
STORE_BUCKETS = 64


def only_merged(images: DataFrame, merged: DataFrame) -> DataFrame:
    return images.join(merged.select(*IMAGE), IMAGE, "left_semi")


def hide_duplicates(images: DataFrame, duplicates: DataFrame, checked: int, pool: DataFrame) -> DataFrame:
    """Hide the duplicate side only. A report covering fewer images than the pool is stale, hence an error."""
    size = pool.count()
    if size > checked:
        raise ValueError(f"duplicate report covers {checked} images but the pool holds {size}")
    return images.join(duplicates.select(*IMAGE), IMAGE, "left_anti")


def skip_reviewed(images: DataFrame, reviewed: DataFrame) -> DataFrame:
    """A reviewed row marks an image as done, changed or not."""
    return images.join(reviewed.select(*IMAGE), IMAGE, "left_anti")


def flagged_boxes(boxes: DataFrame, flagged: DataFrame) -> DataFrame:
    """All boxes of images with a flag, marking the flagged ones.

    Boxes meet their flag by coordinates rounded to six places; of several flags on one place the last in
    class and line order counts. The flags are found once and stored.
    """
    places = [F.round(c, 6).alias(f"r{c}") for c in CORNERS]
    marks = flagged.select(*IMAGE, *places, "class_id", "line_no", F.concat_ws(", ", "reasons").alias("text"))
    keys = [*IMAGE, *[f"r{c}" for c in CORNERS]]
    marks = marks.groupBy(*keys).agg(F.max_by("text", F.struct("class_id", "line_no")).alias("flag_reasons"))
    marks = cut_lineage(marks, "flags")
    scope = boxes.join(marks.select(*IMAGE).distinct(), IMAGE, "left_semi")
    joined = scope.select(*scope.columns, *places).join(marks, keys, "left")
    return joined.select(
        *boxes.columns,
        F.col("flag_reasons").isNotNull().alias("flagged"),
        F.coalesce("flag_reasons", F.lit("")).alias("flag_reasons"),
    )


def route(preds: DataFrame, accept: float | None = config.AUTO_ACCEPT) -> DataFrame:
    """Confident predictions are tagged for acceptance, the rest wait for a person."""
    sure = F.lit(False) if accept is None else F.col("conf") >= accept
    return preds.withColumn("tag", F.when(sure, "accept").otherwise("manual"))


def promote(boxes: DataFrame, preds: DataFrame) -> DataFrame:
    """Append accepted predictions as boxes behind the image's last line; nothing is replaced."""
    accepted = preds.where("tag = 'accept'").withColumn("b", from_top_left())
    columns = [*IMAGE, "line_no", "class_id", *CORNERS]
    last = boxes.groupBy(*IMAGE).agg(F.max("line_no").alias("last"))
    order = Window.partitionBy(*IMAGE).orderBy("pred_no", "class_id", "b.cx", "b.cy", "b.w", "b.h")
    place = (F.coalesce("last", F.lit(0)) + F.row_number().over(order)).cast("int").alias("line_no")
    added = accepted.join(last, IMAGE, "left").select(*IMAGE, place, "class_id", "b.cx", "b.cy", "b.w", "b.h")
    return boxes.select(*columns).unionByName(added)


def accumulate_exclusions(old: DataFrame, tagged: DataFrame) -> DataFrame:
    """Earlier exclusions and the images tagged ``exclude`` now."""
    new = tagged.where("tag = 'exclude'").select(*IMAGE)
    return old.select(*IMAGE).unionByName(new).distinct()


def rewrite(detections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(label rows, skipped rows) of (source, stem, line_no, class_name, bounding_box).

    An unknown class name is an error; geometry that is not four numbers is skipped and listed.
    """
    whole = F.coalesce(F.size("bounding_box"), F.lit(-1)) == 4
    named = with_class_id(detections)
    b = named.where(whole).withColumn("b", from_top_left(*[F.get("bounding_box", F.lit(i)) for i in range(4)]))
    rows = b.select(*IMAGE, "line_no", "class_id", "b.cx", "b.cy", "b.w", "b.h")
    return rows, named.where(~whole).select(*IMAGE, "line_no", "class_name")


def diff(images: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """(source, stem, change) comparing labels as they are written, to six decimals.

    Equal lines are folded with their counts first, so an image's lines are never gathered.
    """
    line = ["class_id", *[F.round(c, 6).alias(c) for c in CORNERS]]
    both = old.select(*IMAGE, *line, F.lit(1).alias("o"), F.lit(0).alias("n")).unionByName(
        new.select(*IMAGE, *line, F.lit(0).alias("o"), F.lit(1).alias("n"))
    )
    folded = both.groupBy(*IMAGE, "class_id", *CORNERS).agg(F.sum("o").alias("o"), F.sum("n").alias("n"))
    per = folded.groupBy(*IMAGE).agg(
        F.sum("o").alias("o"), F.sum("n").alias("n"), F.max((F.col("o") == 0) != (F.col("n") == 0)).alias("other")
    )
    change = (
        F.when(F.col("n") > F.col("o"), "added")
        .when(F.col("n") < F.col("o"), "removed")
        .when(F.col("other"), "modified")
        .otherwise("unchanged")
    )
    return images.select(*IMAGE).distinct().join(per, IMAGE, "left").select(*IMAGE, change.alias("change"))


def replace_eligible(images: DataFrame, boxes: DataFrame, edits: DataFrame) -> DataFrame:
    """Label rows of the reviewed images: lines of other classes first, then the edited eligible ones."""
    columns = [*IMAGE, "line_no", "class_id", *CORNERS]
    inside = boxes.join(images.select(*IMAGE), IMAGE, "left_semi").select(*columns)
    other = inside.where(~F.col("class_id").isin(*config.proxy_class_ids()))
    rows = other.withColumn("part", F.lit(0)).unionByName(edits.select(*columns).withColumn("part", F.lit(1)))
    order = Window.partitionBy(*IMAGE).orderBy("part", "line_no")
    return rows.withColumn("line_no", F.row_number().over(order)).drop("part")


def files_per_source(images: DataFrame) -> DataFrame:
    return images.select(*IMAGE).distinct().groupBy("source").agg(F.count(F.lit(1)).alias("files"))


def add_reviewed(session: DataFrame, store: str, buckets: int = STORE_BUCKETS) -> DataFrame:
    """Reviewed rows of this session replace those of the same images in the store; returns the store as it is now.

    Only the buckets of the session's images are rewritten.
    """
    upsert_store(session, store, IMAGE, buckets)
    return read_store(session.sparkSession, store)


def reread(images: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Per source: images with a reviewed row, and those skipped for having none."""
    has = reviewed.select(*IMAGE).distinct().withColumn("seen", F.lit(True))
    return images.join(has, IMAGE, "left").groupBy("source").agg(
        F.count("seen").alias("loaded"), F.count_if(F.col("seen").isNull()).alias("skipped")
    )
