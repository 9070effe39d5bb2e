"""Exact and near duplicates: content groups, distance pairs, classes, and which item of each group is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from boxweave import config
from boxweave.functions.ranking import first_k, seeded
from boxweave.operators import cells, components
from boxweave.runtime import cut_lineage, discard, join_on_group, scratch_path, write_counted

# Vectors of the first stretch of the seeded order, and a text behind every draw.
FIRST_STRETCH = 8_000
LAST_DRAW = "g"


# --- exact -----------------------------------------------------------------------------------------
def content_groups(files: DataFrame) -> DataFrame:
    """(content, kept, size) of every content held by more than one key; the smallest key is kept."""
    groups = files.groupBy("content").agg(F.min("key").alias("kept"), F.count(F.lit(1)).alias("size"))
    return groups.where("size > 1")


def exact_duplicates(files: DataFrame) -> DataFrame:
    """(kept, duplicate) rows of (key, content); a content with very many copies stays many rows."""
    pairs = join_on_group(files.select("key", "content"), content_groups(files), ["content"], "size")
    return pairs.where(F.col("key") != F.col("kept")).select("kept", F.col("key").alias("duplicate"))


# --- samples ---------------------------------------------------------------------------------------
def stratified_sample(files: DataFrame, size: int = config.NEAR_SAMPLE, seed: int = config.SEED) -> DataFrame:
    """Seeded sample of (key, source), at least one per source; the whole pool if it is no larger."""
    counts = files.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    share = F.col("n").cast("double") / F.col("total") * F.lit(size)
    takes = counts.withColumn("total", total).select(
        "source",
        F.when(F.col("total") <= size, F.lit(size)).otherwise(F.greatest(F.lit(1.0), F.bround(share))).alias("take"),
    )
    near = first_k(files.withColumn("draw", seeded(seed, "key")), ["source"], ["draw", "key"], size)
    return near.join(takes, "source").where(F.col("rn") <= F.col("take")).select("key", "source")


def first_by_key(files: DataFrame, n: int) -> DataFrame:
    return files.orderBy("key").limit(n)


# --- near ------------------------------------------------------------------------------------------
def fold_copies(vectors: DataFrame) -> DataFrame:
    """One row per distinct vector with its smallest key; copies never enter the distance search."""
    return vectors.groupBy("vec").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("size"))


def copy_links(vectors: DataFrame, folded: DataFrame) -> DataFrame:
    """(key, copy) rows linking every exact copy to its representative."""
    reps = folded.where("size > 1").select("vec", F.col("key").alias("rep"), "size")
    linked = join_on_group(vectors, reps, ["vec"], "size")
    return linked.where(F.col("key") != F.col("rep")).select(F.col("rep").alias("key"), F.col("key").alias("copy"))


def near_pairs(vectors: DataFrame, threshold: float = config.NEAR_THRESHOLD, seed: int = config.SEED) -> DataFrame:
    """(a, b, distance), a < b: all close pairs of distinct vectors, and each exact copy with its representative.

    A dense cluster has as many pairs as its size squared; ``near_links`` says the same of it in one row per vector.
    """
    folded = cut_lineage(fold_copies(vectors), "vectors")
    found = cells.pairs_within(cells.build(folded, threshold, seed), threshold)
    ordered = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance")
    copies = copy_links(vectors, folded).select(F.col("key").alias("a"), F.col("copy").alias("b"), F.lit(0.0).alias("distance"))
    return ordered.unionByName(copies)


def greedy_rounds(pairs: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Keys that a kept neighbour earlier in the order makes duplicates, as (key).

    Equals the sequential pass in seeded order: a key with no undecided earlier neighbour is kept, its
    neighbours are duplicates. A random order settles in few rounds. Each round adds its duplicates to one table and
    leaves fewer edges; those of the round before are deleted.
    """
    spark = pairs.sparkSession
    path = scratch_path(spark, "dropped")
    edges, rows, at = write_counted(pairs.select("a", "b"), "near")
    schema = f"key {pairs.schema['a'].dataType.simpleString()}"
    spark.createDataFrame([], schema).write.parquet(path)
    for _ in range(max_rounds):
        if not rows:
            return spark.read.schema(schema).parquet(path)
        later = edges.select(F.col("b").alias("a")).distinct()
        settled = cut_lineage(edges.join(later, "a", "left_anti").select(F.col("b").alias("key")).distinct(), "settled")
        settled.write.mode("append").parquet(path)
        left = edges.join(settled.withColumnRenamed("key", "a"), "a", "left_anti").join(settled.withColumnRenamed("key", "b"), "b", "left_anti")
        before, (edges, rows, at) = at, write_counted(left.select("a", "b"), "near")
        discard(spark, before)
    raise RuntimeError("greedy selection did not settle")


def kept_links(folded: DataFrame, threshold: float, seed: int) -> DataFrame:
    """(a, b, distance) of every duplicate among distinct vectors with each kept one closer than the threshold.

    The order is taken in stretches, each four times as long as all before. Within a stretch what no kept vector has
    reached yet is decided by rounds; then all vectors meet the newly kept ones, once. A cluster is reached
    by the first of its members that are kept, so hardly more than these ever stand in pairs with one another.
    Kept vectors are apart, so the links of a vector do not grow with the data.
    """
    spark = folded.sparkSession
    placed = cells.build(folded, threshold, seed)
    kind = folded.schema["key"].dataType.simpleString()
    schema, path = f"a {kind}, b {kind}, distance double", scratch_path(spark, "hits")
    spark.createDataFrame([], schema).write.parquet(path)
    hits = spark.read.schema(schema).parquet(path)
    order = folded.select("key", seeded(seed, "key").alias("draw"))
    share, done = FIRST_STRETCH / max(1, folded.count()), ""
    while done < LAST_DRAW:
        until = LAST_DRAW if share >= 1 else f"{int(share * 16**8):08x}"
        stretch = order.where((F.col("draw") >= done) & (F.col("draw") < until)).select("key")
        undecided = cut_lineage(stretch.join(hits.select(F.col("a").alias("key")).distinct(), "key", "left_anti"), "undecided")
        dropped = greedy_rounds(cells.pairs_within(placed.join(undecided, "key", "left_semi"), threshold))
        kept = cut_lineage(undecided.join(dropped, "key", "left_anti"), "kept")
        found = cells.pairs_between(placed, placed.join(kept, "key", "left_semi"), threshold)
        found.select("a", "b", "distance").write.mode("append").parquet(path)
        hits = spark.read.schema(schema).parquet(path)
        share, done = share * 4, until
    return hits


def near_duplicates(vectors: DataFrame, threshold: float = config.NEAR_THRESHOLD, seed: int = config.SEED) -> DataFrame:
    """(duplicate, kept, distance): every dropped key with its nearest kept key, as a stored table."""
    folded = cut_lineage(fold_copies(vectors), "vectors")
    nearest = (
        kept_links(folded, threshold, seed)
        .groupBy(F.col("a").alias("duplicate"))
        .agg(F.min(F.struct("distance", "b")).alias("n"))
        .select("duplicate", F.col("n.b").alias("kept"), F.col("n.distance").alias("distance"))
    )
    nearest = cut_lineage(nearest, "near")
    links = cut_lineage(copy_links(vectors, folded), "copies")
    sizes = links.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    targets = sizes.join(nearest.withColumnRenamed("duplicate", "key"), "key", "left").select(
        "key", "size", F.coalesce("kept", "key").alias("kept"), F.coalesce("distance", F.lit(0.0)).alias("distance")
    )
    copies = join_on_group(links, targets, ["key"], "size").select(F.col("copy").alias("duplicate"), "kept", "distance")
    return cut_lineage(nearest.unionByName(copies), "duplicates")


# --- classes of linked vectors ---------------------------------------------------------------------
def near_links(
    vectors: DataFrame, threshold: float = config.NEAR_THRESHOLD, seed: int = config.SEED, block_rows: int = cells.BLOCK_ROWS
) -> DataFrame:
    """(key, class_id, links) per key: its linked class by the smallest key, and how many other keys are closer than the threshold.

    Pairs are counted where they are found and never listed: what leaves a comparison of two blocks is at most two rows
    per vector, its number of links and the smallest key it is connected with there.
    """
    folded = cut_lineage(fold_copies(vectors), "vectors")
    placed = cells.build(folded, threshold, seed).join(folded.select("key", "size"), "key")
    found = cut_lineage(cells.links_within(placed, threshold, block_rows), "found")
    gained = found.where("links is not null").groupBy("key").agg(F.sum("links").alias("more"))
    edges = found.where("other is not null").select(F.col("key").alias("a"), F.col("other").alias("b"))
    rooted = components.labelled(folded.select("key", "size"), components.components(edges)).withColumnRenamed("root", "class_id")
    links = F.col("size") - 1 + F.coalesce("more", F.lit(0).cast("long"))
    rows = cut_lineage(rooted.join(gained, "key", "left").select("key", "class_id", "size", links.alias("links")), "links")
    copies = copy_links(vectors, folded)
    copied = join_on_group(copies, rows.where("size > 1"), ["key"], "size").select(F.col("copy").alias("key"), "class_id", "links")
    return rows.select("key", "class_id", "links").unionByName(copied)


def coverage(checked: DataFrame, sampled: DataFrame, exact: DataFrame, near: DataFrame, method: str) -> DataFrame:
    """One row: how much was checked, how, and how many groups and files were found."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    groups = lambda df, name: df.groupBy("kept").agg(F.lit(1)).agg(F.count(F.lit(1)).alias(name))
    return count(checked, "images_checked").select(
        "images_checked",
        count(sampled, "near_duplicate_sample_size").scalar().alias("near_duplicate_sample_size"),
        F.lit(method).alias("near_duplicate_sample_method"),
        groups(exact, "g").scalar().alias("exact_duplicate_groups"),
        count(exact, "f").scalar().alias("exact_duplicate_files"),
        groups(near, "g").scalar().alias("near_duplicate_groups"),
        count(near, "f").scalar().alias("near_duplicate_files"),
    )
