"""Class and source dimensions, their checks, and the filters and quotas driven by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from boxweave import config
from boxweave.functions.ranking import first_k, seeded


def class_dimension(spark: SparkSession, caps: dict[int, int] | None = None) -> DataFrame:
    """The 16 class rows; literal, hence always small enough to broadcast."""
    rows = [
        (i, config.class_key(name), name, (caps or {}).get(i, config.DEFAULT_CAP))
        for i, name in enumerate(config.CLASS_NAMES)
    ]
    return F.broadcast(spark.createDataFrame(rows, "class_id int, class_key string, class_name string, cap int"))


def checked_class_list(listed: DataFrame, spark: SparkSession) -> DataFrame:
    """Fail unless ``listed`` (class_id, class_name) equals the fixed class list in both directions."""
    fixed = class_dimension(spark).select("class_id", "class_name")
    wrong = listed.select("class_id", "class_name").exceptAll(fixed).unionByName(fixed.exceptAll(listed.select("class_id", "class_name")))
    if not wrong.isEmpty():
        raise ValueError("class list does not match the fixed list")
    return listed


def class_label(class_id: Column | str = "class_id") -> Column:
    """Class name by id without a join; ids outside the list become unknown_id_<n>."""
    class_id = F.col(class_id) if isinstance(class_id, str) else class_id
    names = F.array(*[F.lit(n) for n in config.CLASS_NAMES])
    known = (class_id >= 0) & (class_id < len(config.CLASS_NAMES))
    return F.when(known, F.get(names, class_id)).otherwise(F.concat(F.lit("unknown_id_"), class_id.cast("string")))


def known_class(class_id: Column | str = "class_id") -> Column:
    class_id = F.col(class_id) if isinstance(class_id, str) else class_id
    return class_id.between(0, len(config.CLASS_NAMES) - 1)


def with_class_id(rows: DataFrame, name: str = "class_name") -> DataFrame:
    """Resolve names to ids; an unknown name is an error, not a dropped row."""
    ids = class_dimension(rows.sparkSession).select(F.col("class_name").alias(name), F.col("class_id").alias("__id"))
    message = F.concat(F.lit("unknown class name: "), F.coalesce(F.col(name), F.lit("null")))
    return (
        rows.join(ids, name, "left")
        .withColumn("class_id", F.coalesce(F.col("__id"), F.raise_error(message).cast("int")))
        .drop("__id")
    )


def inactive_sources(sources: DataFrame) -> DataFrame:
    """Processed names of sources whose status takes them out; a missing status keeps a source active."""
    name = F.when(F.col("is_project"), F.concat(F.lit(config.PROJECT_PREFIX), F.col("key"))).otherwise(F.col("key"))
    return sources.where(F.col("audit_status").isin(*config.INACTIVE_STATUSES)).select(name.alias("source")).distinct()


def drop_inactive(rows: DataFrame, sources: DataFrame) -> DataFrame:
    return rows.join(inactive_sources(sources), "source", "left_anti")


def eligibility(projects: DataFrame) -> DataFrame:
    """Adds ``eligible`` and, for the others, the reason they are skipped."""
    eligible = F.coalesce((F.col("audit_status") == "pending") & F.col("pinned_version").isNotNull(), F.lit(False))
    status = F.coalesce(F.col("audit_status"), F.lit("None"))
    reason = F.when(~eligible & F.col("pinned_version").isNull(), F.concat(status, F.lit(" — no pinned_version"))).when(
        ~eligible, F.col("audit_status")
    )
    return projects.withColumn("eligible", eligible).withColumn("skip_reason", reason)


def pull_targets(classes: DataFrame, source: str) -> DataFrame:
    """One row per native class of every class whose primary source is ``source``.

    ``native_class`` holds one name or ``native_classes`` a list of them.
    """
    names = F.coalesce(F.col("native_classes"), F.array("native_class"))
    return classes.where(F.col("primary_source") == source).select(
        "class_id", "class_key", "cap", F.explode(names).alias("native_name")
    )


def buffered_quota(cap: Column | str = "cap") -> Column:
    """Pull target for a cap, with the buffer; a missing cap is an error."""
    cap = F.col(cap) if isinstance(cap, str) else cap
    checked = F.coalesce(cap, F.raise_error(F.lit("no cap set for this class")).cast("int"))
    return F.ceil(checked.cast("double") * F.lit(config.PULL_BUFFER))


def per_split_quota(quota: Column) -> Column:
    return F.ceil(quota.cast("double") / F.lit(float(len(config.PULL_SPLITS))))


def seeded_pull(rows: DataFrame, quota: Column, seed: int = config.SEED) -> DataFrame:
    """Images holding a class, first ``quota`` of each (class, split) in seeded order.

    ``rows`` is (class_id, split, source, stem) with repeats. The largest quota is read from the rows first,
    so that every map task can prune to it.
    """
    most = rows.agg(F.max(quota)).first()[0] or 0
    images = rows.select("class_id", "split", "source", "stem").distinct().withColumn("draw", seeded(seed, "source", "stem"))
    return first_k(images, ["class_id", "split"], ["draw", "source", "stem"], most).where(F.col("rn") <= quota)


def real_detections(images: DataFrame) -> DataFrame:
    """Keep detections that are neither depictions nor groups, then images with at least one left."""
    keep = lambda d: ~d["is_depiction"] & ~d["is_group_of"]
    return images.withColumn("detections", F.filter("detections", keep)).where(F.size("detections") > 0)


def restrict_to_requested(rows: DataFrame, requested: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keep requested keys; a requested key nobody knows is an error."""
    unknown = [r[0] for r in requested.join(known.select(key).distinct(), key, "left_anti").select(key).take(20)]
    if unknown:
        raise ValueError(f"unknown {key}: {sorted(unknown)}")
    return rows.join(requested.select(key).distinct(), key, "left_semi")


def eligible_requested(projects: DataFrame, requested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requested projects that are eligible, and (key, skip_reason) of the others; an unknown key is an error."""
    marked = eligibility(restrict_to_requested(projects, requested, projects, "key"))
    return marked.where("eligible"), marked.where("not eligible").select("key", "skip_reason")


def deployment_labels(spark: SparkSession) -> DataFrame:
    """Runtime ids: 0 is the background, every class moves up by one."""
    background = spark.createDataFrame([(0, "Background")], "runtime_id int, class_name string")
    return background.unionByName(class_dimension(spark).select((F.col("class_id") + 1).alias("runtime_id"), "class_name"))
