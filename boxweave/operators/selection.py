"""Set algebra on selections. A selection is (class_id, source, stem); inputs are numbered from 0."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from boxweave.operators.dims import class_dimension

ENTRY = ["class_id", "source", "stem"]
IMAGE = ["source", "stem"]


def numbered(inputs: list[DataFrame]) -> DataFrame:
    """All inputs in one table with the number of the input each row came from."""
    if len(inputs) < 2:
        raise ValueError("combining needs at least two selections")
    tagged = [s.select(*ENTRY).withColumn("input", F.lit(i)) for i, s in enumerate(inputs)]
    return reduce(DataFrame.unionByName, tagged)


def check_compatible(facts: list[dict]) -> None:
    """Inputs must agree on seed, instance target and class list. ``facts`` are report headers."""
    if len(facts) < 2:
        raise ValueError("combining needs at least two selections")
    for field in ("seed", "instance_target", "class_names"):
        found = {str(f.get(field)) for f in facts}
        if len(found) > 1:
            raise ValueError(f"inputs disagree on {field}: {sorted(found)}")


def union(inputs: list[DataFrame]) -> DataFrame:
    return numbered(inputs).select(*ENTRY).distinct()


def intersect(inputs: list[DataFrame]) -> DataFrame:
    """Entries present in every input, found in one shuffle however many inputs there are."""
    n = len(inputs)
    seen = numbered(inputs).groupBy(*ENTRY).agg(*[F.max((F.col("input") == i).cast("int")).alias(f"i{i}") for i in range(n)])
    return seen.where(sum((F.col(f"i{i}") for i in range(1, n)), F.col("i0")) == n).select(*ENTRY)


def dropped_by_class(first: DataFrame, result: DataFrame) -> DataFrame:
    """Entries of the first input missing from the result, per class, most first."""
    lost = first.select(*ENTRY).distinct().join(result, ENTRY, "left_anti")
    return lost.groupBy("class_id").agg(F.count(F.lit(1)).alias("dropped")).orderBy(F.desc("dropped"), "class_id")


def coverage(inputs: list[DataFrame]) -> DataFrame:
    """(label, images): only in one input, in all, in any, on images regardless of class."""
    n = len(inputs)
    flags = [F.max((F.col("input") == i).cast("int")).alias(f"i{i}") for i in range(n)]
    seen = numbered(inputs).groupBy(*IMAGE).agg(*flags)
    hits = sum((F.col(f"i{i}") for i in range(1, n)), F.col("i0"))
    only = [F.count_if((F.col(f"i{i}") == 1) & (hits == 1)).alias(f"only_{i}") for i in range(n)]
    wide = seen.agg(*only, F.count_if(hits == n).alias("intersection_all"), F.count(F.lit(1)).alias("union_all"))
    names = [f"only_{i}" for i in range(n)] + ["intersection_all", "union_all"]
    pairs = F.create_map(*[v for name in names for v in (F.lit(name), F.col(name))])
    return wide.select(F.explode(pairs).alias("label", "images"))


def stale_sources(selection: DataFrame, active: DataFrame) -> DataFrame:
    """Sources a selection refers to that are no longer active."""
    return selection.select("source").distinct().join(active.select("source").distinct(), "source", "left_anti")


def images(selection: DataFrame) -> DataFrame:
    """Distinct images over all classes."""
    return selection.select(*IMAGE).distinct()


def combined_report(op: str, inputs: list[DataFrame], paths: list[str], hashes: DataFrame) -> DataFrame:
    """Facts about each input and the result size. The preset stays null: this is no preset run.

    ``hashes`` is (path, sha256, modified) of the input files.
    """
    result = union(inputs) if op == "union" else intersect(inputs)
    per_input = numbered(inputs).select("input", *IMAGE).distinct().groupBy("input").agg(F.count(F.lit(1)).alias("selected_total"))
    spark = hashes.sparkSession
    names = F.broadcast(spark.createDataFrame(list(enumerate(paths)), "input int, path string"))
    facts = names.join(per_input, "input", "left").join(hashes, "path", "left")
    total = result.agg(F.count(F.lit(1)).alias("n")).scalar()
    return facts.select(
        F.lit(op).alias("combine_op"),
        F.lit(None).cast("int").alias("hard_cap_preset"),
        "input",
        "path",
        "sha256",
        F.coalesce("selected_total", F.lit(0)).alias("selected_total"),
        total.alias("result_total"),
    )


def combined_document(op: str, inputs: list[DataFrame], facts: list[dict]) -> DataFrame:
    """The combined report itself, one row that ``sinks.write_report`` writes and ``reports.read_selection`` reads.

    Every class has its sorted ``selected`` entries and their number, classes without any too, like a report of one
    run; ``facts`` are the headers of the inputs, which have to agree. A class holds no more than its inputs'
    budgets together, so a class's list stays bounded by configuration.
    """
    check_compatible(facts)
    result = union(inputs) if op == "union" else intersect(inputs)
    lost = dropped_by_class(inputs[0], result) if op == "intersect" else None
    names = class_dimension(result.sparkSession).select("class_id", "class_name")
    entries = result.select("class_id", F.concat_ws("/", "source", "stem").alias("entry"))
    per_class = names.join(entries, "class_id", "left").groupBy("class_id", "class_name").agg(
        F.array_sort(F.collect_list("entry")).alias("selected"), F.count("entry").alias("final_images")
    )
    if lost is not None:
        per_class = per_class.join(F.broadcast(lost), "class_id", "left")  # at most one row per class
    dropped = F.lit(0).cast("long") if lost is None else F.coalesce("dropped", F.lit(0))
    body = F.struct("class_name", F.struct("selected", "final_images").alias("body"))
    shortfall = F.struct("class_name", dropped.alias("n"))
    return per_class.agg(
        F.map_from_entries(F.array_sort(F.collect_list(body))).alias("classes"),
        F.sum("final_images").alias("result_total"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(dropped > 0, shortfall)))).alias("dropped_by_class"),
    ).select(
        "classes",
        F.lit(op).alias("combine_op"),
        F.lit(None).cast("int").alias("hard_cap_preset"),
        F.lit(facts[0]["seed"]).alias("seed"),
        F.lit(facts[0]["instance_target"]).alias("instance_target"),
        "result_total",
        "dropped_by_class",
    )
