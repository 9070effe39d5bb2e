"""Per-class selection under an image cap and an instance budget, with priority sources.

Every (class, lane) is pre-limited to its first ``hard_cap`` images, more than which can never be taken, and
ranked piece by piece, so running sums work on few rows at once whatever the cap and the size of a class. A lane is the position of a
priority source, or 0 for all other sources together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from boxweave import config
from boxweave.config import CapPolicy
from boxweave.functions.ranking import first_k, seeded
from boxweave.operators.dims import class_dimension, known_class

CLASS_IMAGE = ["class_id", "source", "stem"]
# A lane is ranked in pieces by the first digits of its draw, and in sparse lanes by the numbers of instances below this.
PIECE_DIGITS = 2
DENSITIES = 64


def candidates(rows: DataFrame) -> DataFrame:
    """Instances per (class, source, stem)."""
    return rows.where(known_class()).groupBy(*CLASS_IMAGE).agg(F.count(F.lit(1)).alias("cnt"))


def lane_table(spark, policy: CapPolicy) -> DataFrame:
    """Config-sized: one row per class and priority source, with floor reservation and scaled sub-budget."""
    rows = spark.createDataFrame(
        policy.lanes(), "class_id int, source string, lane int, queued int, base int"
    )
    members = F.col("lane") + F.col("queued")
    floor = F.lit(policy.hard_cap // 3)
    each = F.when(members > 1, F.expr(f"{policy.hard_cap // 3} div (lane + queued)")).otherwise(0)
    scaled = F.bround(F.col("base").cast("double") * F.lit(policy.hard_cap) / F.lit(float(config.DEFAULT_CAP)))
    return F.broadcast(
        rows.select(
            "class_id", "source", "lane", "queued", floor.alias("floor"), each.alias("each"),
            (each * F.col("queued")).alias("reserved"), scaled.cast("long").alias("subbudget"),
        )
    )


def first_of_lanes(placed: DataFrame, most: int) -> DataFrame:
    """The first ``most`` images of every (class, lane) by density and draw, with rank ``rn`` and instances up to them ``cum``.

    A lane is never sorted as a whole. The start of its order key deals it into pieces, whose counts give the rank and the sum
    at the start of each; only pieces that start early enough are ranked, each by itself. Sparse lanes have a piece per
    density below ``DENSITIES`` and draw, all others one per draw, so the counts are bounded by configuration.
    """
    dense = F.col("density") >= DENSITIES
    rows = placed.withColumns(
        {"level": F.least("density", F.lit(DENSITIES)), "piece": F.when(dense, "").otherwise(F.substring("draw", 1, PIECE_DIGITS))}
    )
    at = ["class_id", "lane", "level", "piece"]
    sizes = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("sum"))
    earlier = Window.partitionBy("class_id", "lane").orderBy("level", "piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*at, *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("n", "sum")))
    kept = rows.join(F.broadcast(starts.where(F.col("n_before") < most)), at)
    inside = Window.partitionBy(*at).orderBy("density", "draw", "source", "stem").rowsBetween(Window.unboundedPreceding, 0)
    ranked = kept.withColumns(
        {"rn": F.col("n_before") + F.count(F.lit(1)).over(inside), "cum": F.col("sum_before") + F.sum("cnt").over(inside)}
    )
    return ranked.where(F.col("rn") <= most).drop("level", "piece", "n_before", "sum_before")


@dataclass
class CapResult:
    """``ranked`` holds every image that could be taken, with lane, rank and verdict; the rest are aggregates."""

    policy: CapPolicy
    candidates: DataFrame
    lanes: DataFrame
    ranked: DataFrame
    budgets: DataFrame

    @property
    def selected(self) -> DataFrame:
        return self.ranked.where("taken").select(
            *CLASS_IMAGE, "cnt", F.when(F.col("lane") > 0, "priority").otherwise("general").alias("reason"), "lane"
        )


def select_images(found: DataFrame, policy: CapPolicy) -> CapResult:
    spark = found.sparkSession
    lanes = lane_table(spark, policy)
    placed = found.join(lanes.select("class_id", "source", "lane", "subbudget"), ["class_id", "source"], "left")
    placed = placed.withColumns(
        {
            "lane": F.coalesce("lane", F.lit(0)),
            "draw": seeded(policy.seed, "source", "stem"),
            # Sparse images first where a sub-budget applies, plain seeded order elsewhere.
            "density": F.when(F.col("subbudget").isNotNull(), F.col("cnt")).otherwise(F.lit(0)),
        }
    )
    near = first_of_lanes(placed, policy.hard_cap + config.EXCLUDED_SAMPLE).persist()

    # Images a lane could supply: all of them, or those that fit the sub-budget.
    fits = F.col("subbudget").isNull() | (F.col("cum") <= F.col("subbudget"))
    supply = near.where((F.col("lane") > 0) & fits).groupBy("class_id", "lane").agg(F.count(F.lit(1)).alias("supply"))
    per_class = (
        lanes.join(supply, ["class_id", "lane"], "left")
        .groupBy("class_id")
        .agg(F.array_sort(F.collect_list(F.struct("lane", "reserved", F.coalesce("supply", F.lit(0)).alias("supply")))).alias("l"))
    )
    # Budget left before each lane: fold over the few lanes of a class in list order.
    step = lambda left, x: left - F.least(x["supply"], F.greatest(left - x["reserved"], F.lit(0)))
    left_before = lambda lane: F.aggregate(
        F.filter("l", lambda x: x["lane"] < lane), F.lit(policy.hard_cap).cast("long"), step
    )
    claims = per_class.select("class_id", F.explode(F.transform("l", lambda x: F.struct(
        x["lane"].alias("lane"),
        left_before(x["lane"]).alias("left"),
        F.greatest(left_before(x["lane"]) - x["reserved"], F.lit(0)).alias("ceiling"),
        x["supply"].alias("supply"),
    ))).alias("c")).select("class_id", "c.*")
    claims = F.broadcast(claims.withColumn("claimed", F.least("supply", "ceiling")))  # at most one row per lane

    prioritised = near.where("lane > 0").join(claims.select("class_id", "lane", "claimed"), ["class_id", "lane"])
    taken_first = prioritised.withColumn("taken", F.col("rn") <= F.col("claimed"))
    instances = taken_first.where("taken").groupBy("class_id", "lane").agg(F.sum("cnt").alias("instances"))
    spent = instances.groupBy("class_id").agg(F.sum("instances").alias("spent"))
    images_spent = claims.groupBy("class_id").agg(F.sum("claimed").alias("claimed"))
    # Every class has a budget, also one without a priority source.
    classes = class_dimension(spark).select("class_id").unionByName(near.select("class_id").distinct()).distinct()
    budgets = classes.join(images_spent, "class_id", "left").join(spent, "class_id", "left").select(
        "class_id",
        (F.lit(policy.hard_cap) - F.coalesce("claimed", F.lit(0))).alias("images_left"),
        F.greatest(F.lit(policy.instance_target) - F.coalesce("spent", F.lit(0)), F.lit(0)).alias("instances_left"),
    )
    general = near.where("lane = 0").join(F.broadcast(budgets), "class_id")
    filled = general.withColumn(
        "taken",
        (F.col("rn") <= F.col("images_left")) & (F.col("cum") - F.col("cnt") < F.col("instances_left")),
    )
    keep = [*CLASS_IMAGE, "cnt", "lane", "rn", "cum", "taken"]
    ranked = taken_first.select(*keep).unionByName(filled.select(*keep))
    breakdown = claims.join(instances, ["class_id", "lane"], "left").na.fill(0, ["instances"])
    return CapResult(policy, found, lanes.join(breakdown, ["class_id", "lane"]), ranked, budgets)


def priority_breakdown(result: CapResult) -> DataFrame:
    """Per class and priority source: candidates, claims, reservation, sub-budget, starvation."""
    totals = result.candidates.groupBy("class_id", "source").agg(F.count(F.lit(1)).alias("candidates"))
    starved = (F.col("left") - F.col("claimed") == 0) & (F.col("queued") > 0)
    return result.lanes.join(totals, ["class_id", "source"], "left").select(
        "class_id",
        "lane",
        "source",
        F.coalesce("candidates", F.lit(0)).alias("candidates"),
        F.col("claimed").alias("selected_images"),
        F.col("instances").alias("selected_instances"),
        F.col("reserved").alias("reserved_for_later"),
        F.col("subbudget").alias("instance_subbudget"),
        starved.alias("starved_next"),
    )


def class_summary(result: CapResult) -> DataFrame:
    """One row per class, zeros kept, with the stop reason of the general fill."""
    p = result.policy
    priority_sources = result.lanes.select("class_id", "source", F.lit(True).alias("is_priority"))
    per_source = result.candidates.groupBy("class_id", "source").agg(
        F.count(F.lit(1)).alias("images"), F.sum("cnt").alias("instances")
    )
    totals = (
        per_source.join(F.broadcast(priority_sources), ["class_id", "source"], "left")
        .groupBy("class_id")
        .agg(
            F.sum("images").alias("candidate_images"),
            F.sum("instances").alias("candidate_instances"),
            F.sum(F.when(F.col("is_priority").isNull(), F.col("images")).otherwise(0)).alias("general_candidates"),
        )
    )
    chosen = result.selected.groupBy("class_id").agg(
        F.count(F.lit(1)).alias("final_images"),
        F.sum("cnt").alias("final_instances"),
        F.count_if(F.col("lane") == 0).alias("general_selected"),
    )
    names = class_dimension(result.candidates.sparkSession).select("class_id", "class_name", F.col("cap").alias("configured_cap"))
    counts = ["candidate_images", "candidate_instances", "general_candidates", "final_images", "final_instances", "general_selected"]
    rows = names.join(totals, "class_id", "left").join(chosen, "class_id", "left").na.fill(0, counts)
    rows = rows.join(result.budgets, "class_id", "left").withColumn("images_left", F.coalesce("images_left", F.lit(p.hard_cap)))
    stop = (
        F.when(F.col("general_selected") == F.col("general_candidates"), "all_candidates_included")
        .when(F.col("general_selected") >= F.col("images_left"), "image_hard_cap")
        .otherwise("instance_target")
    )
    return rows.select(
        "class_id",
        "class_name",
        *counts,
        (F.col("general_candidates") - F.col("general_selected")).alias("general_excluded"),
        (F.col("final_images") >= F.lit(p.hard_cap // 3)).alias("floor_met"),
        F.lit(p.hard_cap // 3).alias("floor"),
        stop.alias("stop_reason"),
        (F.col("configured_cap") != F.lit(p.hard_cap)).alias("cap_overridden"),
        "configured_cap",
    )


def source_counts(result: CapResult) -> DataFrame:
    """Candidate and selected images per (class, source)."""
    found = result.candidates.groupBy("class_id", "source").agg(F.count(F.lit(1)).alias("candidates"))
    chosen = result.selected.groupBy("class_id", "source").agg(F.count(F.lit(1)).alias("selected"))
    return found.join(chosen, ["class_id", "source"], "left").na.fill(0, ["selected"])


def excluded_sample(result: CapResult, k: int = config.EXCLUDED_SAMPLE) -> DataFrame:
    """First ``k`` general images not taken, in seeded order; they follow the taken prefix."""
    rest = result.ranked.where("lane = 0 and not taken")
    return first_k(rest.select(*CLASS_IMAGE, F.col("rn").alias("seeded_rank")), ["class_id"], ["seeded_rank"], k)


def ratio_invariant(summary: DataFrame) -> DataFrame:
    """Largest and smallest class by images (first class wins ties), their ratio, and the recompute trigger."""
    up = F.struct("final_images", (-F.col("class_id")).alias("i"))
    down = F.struct("final_images", F.col("class_id").alias("i"))
    r = summary.agg(
        F.max_by("class_name", up).alias("max_class"),
        F.max("final_images").alias("max_images"),
        F.min_by("class_name", down).alias("min_class"),
        F.min("final_images").alias("min_images"),
        F.max("floor").alias("floor"),
    )
    ratio = F.when(F.col("min_images") > 0, F.col("max_images") / F.col("min_images")).otherwise(F.lit(float("inf")))
    short = F.col("min_images") < F.col("floor")
    return r.withColumn("ratio", ratio).select(
        "max_class",
        "max_images",
        "min_class",
        "min_images",
        "ratio",
        (F.col("ratio") <= 3.0).alias("meets_3to1"),
        short.alias("recompute_trigger"),
        F.when(short, F.col("min_images") * 3).alias("recomputed_cap"),
    )


def selection_report(result: CapResult) -> DataFrame:
    """The one-document report: class name to its selected entries, each class bounded by the cap."""
    names = class_dimension(result.candidates.sparkSession).select("class_id", "class_name")
    entry = F.concat_ws("/", "source", "stem")
    per_class = names.join(result.selected.select("class_id", entry.alias("entry")), "class_id", "left").groupBy("class_name").agg(
        F.struct(F.array_sort(F.collect_list("entry")).alias("selected")).alias("body")
    )
    return per_class.agg(F.map_from_entries(F.collect_list(F.struct("class_name", "body"))).alias("classes")).select(
        "classes",
        F.lit(result.policy.seed).alias("seed"),
        F.lit(result.policy.instance_target).alias("instance_target"),
        F.lit(result.policy.hard_cap).alias("hard_cap_preset"),
    )
