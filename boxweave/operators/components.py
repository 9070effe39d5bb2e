"""Duplicate groups as edges, and their connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from boxweave.runtime import HOT_FLOOR, by_shuffle, discard, join_on_group, scratch_path


def group_edges(members: DataFrame, pool: DataFrame) -> DataFrame:
    """(a, b) from each group's first present member to its others.

    ``members`` is (grp, key); members outside ``pool`` (key) are dropped. A group yields one edge fewer
    than it has members, never all its pairs.
    """
    present = members.select("grp", "key").distinct().join(by_shuffle(pool.select("key").distinct()), "key", "left_semi")
    heads = present.groupBy("grp").agg(F.min("key").alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1")
    linked = join_on_group(present, heads, ["grp"], "size")
    return linked.where(F.col("key") != F.col("head")).select(F.col("head").alias("a"), F.col("key").alias("b")).distinct()


def _stored(edges: DataFrame, name: str) -> tuple[DataFrame, tuple[int, int], str]:
    """The edges written once, with their number and a mark of the whole set, observed on the way, and their path."""
    spark, seen = edges.sparkSession, Observation()
    path = scratch_path(spark, name)
    edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("mark")).write.parquet(path)
    return spark.read.schema(edges.schema).parquet(path), (seen.get["n"], seen.get["mark"]), path


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(key, root) for every member that is not its component's smallest key.

    Each round links larger neighbours to a node's minimum, then smaller ones, halving path lengths; hubs go
    through the hot-key join. Stars to the smallest keys are what a round leaves as it is, so the rounds end when
    the number of edges and a mark of their set, observed while they are written, stay the same. Only these reach the
    driver, and a round's table is deleted once the next is written.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    current, state, at = _stored(pairs.where(F.col("hi") != F.col("lo")).distinct(), "edges")
    for _ in range(max_rounds):
        size = state[0]
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            current.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        nearest = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("size"))
        nearest = nearest.select("u", F.least("u", "m").alias("m"), "size")
        large = join_on_group(both, nearest, ["u"], "size", 2 * size).where(F.col("v") > F.col("u"))
        large, half = large.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), None
        if size > HOT_FLOOR:
            large, _, half = _stored(large, "edges")
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"), F.count(F.lit(1)).alias("size"))
        moved = join_on_group(large, lowest, ["hi"], "size", size).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = moved.where(F.col("hi") != F.col("lo")).unionByName(lowest.select("hi", F.col("m").alias("lo")))
        before, (current, reached, now) = state, _stored(small.distinct(), "edges")
        for path in (at, half):
            if path:
                discard(spark, path)
        if reached == before:
            return current.select(F.col("hi").alias("key"), F.col("lo").alias("root"))
        state, at = reached, now
    raise RuntimeError("components did not settle")


def labelled(pool: DataFrame, roots: DataFrame) -> DataFrame:
    """Every pool key with its root; singletons are their own root."""
    return pool.join(by_shuffle(roots), "key", "left").withColumn("root", F.coalesce("root", "key"))
