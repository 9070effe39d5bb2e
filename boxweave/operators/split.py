"""Train/val/test assignment that keeps every duplicate component in one split."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from boxweave import config
from boxweave.functions.ranking import rank_cutoffs, seeded
from boxweave.operators.audit import unknown_classes
from boxweave.operators.dims import class_dimension, known_class
from boxweave.runtime import by_shuffle, cut_lineage, join_on_group, small_side, write_counted

BUCKET_DIGITS = 3


def coverage_gate(counts: DataFrame) -> DataFrame:
    """Adds whether duplicate groups may be used and whether the near check was full scale.

    ``counts`` is (checked, sampled, pool). A report covering less than the pool is not used at all; one
    covering more is fine, its absent members are dropped later. A missing report has a null ``checked``.
    """
    checked = F.coalesce("checked", F.lit(0))
    applies = checked >= F.col("pool")
    return counts.withColumn("applies", F.col("checked").isNotNull() & applies).withColumn(
        "full_scale", F.col("applies") & (F.coalesce("sampled", "checked") >= F.col("checked"))
    )


def units(pool: DataFrame, roots: DataFrame) -> DataFrame:
    """One row per component: its smallest key, under that key's source."""
    return pool.select("key", "source").join(by_shuffle(roots.select("key")), "key", "left_anti")


def assign(pool: DataFrame, roots: DataFrame, seed: int = config.SEED) -> DataFrame:
    """(key, source, split) for the whole pool of (key, source).

    Units are put in seeded order per source; the two cut points are found through a histogram over the
    order key, so no source is ever sorted as a whole. Members follow their root.
    """
    drawn = cut_lineage(units(pool, roots).withColumn("draw", seeded(seed, "key")), "units")
    n = F.col("n").cast("double")
    train, val = F.bround(n * F.lit(config.TRAIN_RATIO)), F.bround(n * F.lit(config.VAL_RATIO))
    cuts = rank_cutoffs(
        drawn, "source", ["draw", "key"], F.substring("draw", 1, BUCKET_DIGITS), {"train": train, "val": train + val}
    )
    at = F.struct("draw", "key")
    placed = drawn.join(small_side(cuts.drop("n")), "source").select(
        "key",
        "source",
        F.when(at <= F.col("train"), "train").when(at <= F.col("val"), "val").otherwise("test").alias("split"),
    )
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    rooted = cut_lineage(sizes.join(by_shuffle(placed.select(F.col("key").alias("root"), "split")), "root"), "rooted")
    followers = join_on_group(roots, rooted, ["root"], "size").select("key", "split")
    return placed.unionByName(pool.select("key", "source").join(by_shuffle(followers), "key"))


def completeness(pool: DataFrame, assigned: DataFrame) -> DataFrame:
    """One row of defects: every key once, in a known split, and no key from outside."""
    per_key = assigned.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("split").isin(*config.SPLIT_NAMES)).alias("bad")
    )
    both = pool.select("key").distinct().withColumn("in_pool", F.lit(True)).join(by_shuffle(per_key), "key", "full_outer")
    return both.agg(
        F.count_if(F.col("n").isNull()).alias("unassigned"),
        F.count_if(F.col("in_pool").isNull()).alias("foreign"),
        F.count_if(F.col("n") > 1).alias("repeated"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_split"),
    )


def leaks(members: DataFrame, assigned: DataFrame) -> DataFrame:
    """Original duplicate groups found in more than one split."""
    where = members.select("grp", "key").join(by_shuffle(assigned.select("key", "split")), "key")
    flags = [F.max(F.col("split") == s).alias(s) for s in config.SPLIT_NAMES]
    seen = where.groupBy("grp").agg(*flags, F.count(F.lit(1)).alias("members"))
    n = sum((F.col(s).cast("int") for s in config.SPLIT_NAMES[1:]), F.col(config.SPLIT_NAMES[0]).cast("int"))
    return seen.where(n > 1).select("grp", "members", n.alias("splits"))


def require_no_leaks(members: DataFrame, assigned: DataFrame, preview: bool = False) -> DataFrame:
    """The leaking groups; any at all is an error unless this is a preview."""
    found = leaks(members, assigned)
    if not preview:
        found, n, _ = write_counted(found, "leaks")
        if n:
            raise RuntimeError(f"{n} duplicate groups lie in more than one split")
    return found


def split_sizes(assigned: DataFrame) -> DataFrame:
    """Keys per split, zeros kept."""
    names = F.broadcast(assigned.sparkSession.createDataFrame([(s,) for s in config.SPLIT_NAMES], "split string"))
    counts = assigned.groupBy("split").agg(F.count(F.lit(1)).alias("images"))
    return names.join(counts, "split", "left").na.fill(0, ["images"])


def missing_labels(assigned: DataFrame, labels: DataFrame) -> DataFrame:
    return assigned.join(by_shuffle(labels.select("key")), "key", "left_anti")


def distribution(assigned: DataFrame, boxes: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(split x class with zeros, split x source per label file, unknown ids).

    ``boxes`` is (key, class_id), ``labels`` (key) with one or more rows per label file.
    """
    spark = assigned.sparkSession
    placed = boxes.join(by_shuffle(assigned.select("key", "split")), "key")
    per_image = placed.where(known_class()).groupBy("split", "class_id", "key").agg(F.count(F.lit(1)).alias("c"))
    counts = per_image.groupBy("split", "class_id").agg(F.count(F.lit(1)).alias("images"), F.sum("c").alias("instances"))
    grid = class_dimension(spark).select("class_id", F.explode(F.array(*[F.lit(s) for s in config.SPLIT_NAMES])).alias("split"))
    by_class = F.broadcast(grid).join(counts, ["split", "class_id"], "left").na.fill(0, ["images", "instances"])
    files = labels.select("key").distinct()
    by_source = assigned.join(by_shuffle(files), "key", "left_semi").groupBy("split", "source").agg(F.count(F.lit(1)).alias("label_files"))
    return by_class, by_source, unknown_classes(placed)
