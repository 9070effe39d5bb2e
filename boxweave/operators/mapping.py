"""Native names and indexes to canonical classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from boxweave import config
from boxweave.operators.dims import class_dimension
from boxweave.runtime import small_side


def native_index(names: DataFrame) -> DataFrame:
    """(project, idx, native_name) from (project, names, overrides map or null).

    A project with overrides must cover every index.
    """
    rows = names.select("project", "overrides", F.posexplode("names").alias("idx", "listed"))
    given = F.col("overrides")[F.col("idx").cast("string")]
    missing = F.raise_error(F.concat(F.lit("no override for index "), F.col("idx").cast("string"))).cast("string")
    return rows.select(
        "project",
        "idx",
        F.when(F.col("overrides").isNull(), F.col("listed")).otherwise(F.coalesce(given, missing)).alias("native_name"),
    )


def resolve_mapping(entries: DataFrame, natives: DataFrame) -> DataFrame:
    """(project, native_name, class_key) by the four documented cases, first match wins.

    ``entries`` is (project, filter_map map<class_key, array<string>>, filter_name, filter_list,
    canonical_class, canonical_classes). 1 map of class to names; 2 one name for the single class;
    3 no filter and one class takes every native name; 4 no filter and many classes match by name,
    ignoring case. A bare list of names is rejected. Of several classes that list one name the last one has it.
    """
    message = F.concat(F.lit("class filter of "), F.col("project"), F.lit(" is a bare list"))
    bad = F.when(F.col("filter_list").isNotNull(), F.raise_error(message).cast("int")).otherwise(F.lit(0))
    entries = entries.withColumn("__ok", bad).where(F.col("__ok") == 0)
    case = (
        F.when(F.col("filter_map").isNotNull(), 1)
        .when(F.col("filter_name").isNotNull(), 2)
        .when(F.col("canonical_class").isNotNull(), 3)
        .otherwise(4)
    )
    entries = entries.withColumn("case", case)
    only = F.lit(0).alias("place")
    by_map = entries.where("case = 1").select("project", F.posexplode("filter_map").alias("place", "class_key", "names"))
    by_map = by_map.select("project", F.explode("names").alias("native_name"), "class_key", "place")
    by_name = entries.where("case = 2").select("project", F.col("filter_name").alias("native_name"), F.col("canonical_class").alias("class_key"), only)
    blanket = entries.where("case = 3").join(natives, "project").select("project", "native_name", F.col("canonical_class").alias("class_key"), only)
    listed = entries.where("case = 4").select("project", F.posexplode("canonical_classes").alias("place", "class_key"))
    by_case = natives.withColumn("__l", F.lower("native_name")).join(
        listed.withColumn("__l", F.lower("class_key")), ["project", "__l"]
    )
    by_case = by_case.select("project", "native_name", "class_key", "place")
    found = by_map.unionByName(by_name).unionByName(blanket).unionByName(by_case)
    return found.groupBy("project", "native_name").agg(F.max_by("class_key", F.struct("place", "class_key")).alias("class_key"))


def class_ids(mapping: DataFrame) -> DataFrame:
    """Class ids of a mapping; a class key outside the class list is an error."""
    ids = class_dimension(mapping.sparkSession).select("class_key", "class_id")
    unknown = F.raise_error(F.concat(F.lit("unknown class key "), F.col("class_key"))).cast("int")
    return mapping.join(ids, "class_key", "left").select("project", "native_name", F.coalesce("class_id", unknown).alias("class_id"))


def index_map(natives: DataFrame, mapping: DataFrame) -> DataFrame:
    """(project, idx, class_id): the config-sized table that label rows are joined to."""
    return natives.join(class_ids(mapping), ["project", "native_name"]).select("project", "idx", "class_id")


def apply_index_map(rows: DataFrame, index: DataFrame) -> DataFrame:
    """class_id per (project, native_idx); null where the index is not canonical."""
    return rows.join(small_side(index.withColumnRenamed("idx", "native_idx")), ["project", "native_idx"], "left")


def literal_map(pairs: dict, key: Column) -> Column:
    """Lookup in a fixed configuration map as an expression, with no join at all."""
    return F.create_map(*[F.lit(v) for pair in pairs.items() for v in pair])[key]


def apply_name_map(rows: DataFrame, names: dict[str, int], native: str = "native_name") -> DataFrame:
    return rows.withColumn("class_id", literal_map(names, F.col(native)))


def drop_counts(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("boxes_total"),
        F.count("class_id").alias("boxes_mapped"),
        F.count_if(F.col("class_id").isNull()).alias("boxes_dropped_non_canonical"),
    )


def native_set_filter(rows: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose (folder, native_name) is wanted, and the counts per folder."""
    known = small_side(wanted.select("folder", "native_name").distinct().withColumn("__k", F.lit(True)))
    marked = rows.join(known, ["folder", "native_name"], "left")
    counts = marked.groupBy("folder").agg(
        F.count(F.lit(1)).alias("annotations_total"),
        F.count("__k").alias("annotations_kept"),
        F.count_if(F.col("__k").isNull()).alias("annotations_dropped_non_native"),
    )
    return marked.where("__k").drop("__k"), counts


def pool_by_file(rows: DataFrame) -> DataFrame:
    """Per file name over all folders: the first folder's size wins, mismatches are reported.

    Boxes are not gathered: they stay rows and take the pooled size by a join on the file name.
    """
    size = F.struct("width", "height")
    return rows.groupBy("file_name").agg(
        F.min_by(size, F.struct("folder", "line_no")).alias("size"),
        F.min("folder").alias("copy_from"),
        F.array_sort(F.collect_set("folder")).alias("folders"),
        F.count(F.lit(1)).alias("boxes"),
        ((F.min("width") != F.max("width")) | (F.min("height") != F.max("height"))).alias("size_mismatch"),
    )


def crosswalk(spark) -> DataFrame:
    """(class_name, native_name) of the proxy model's classes; fixed and small."""
    rows = [(c, n) for c, names in config.PROXY_CLASSES.items() for n in names]
    return F.broadcast(spark.createDataFrame(rows, "class_name string, native_name string"))


def checked_crosswalk(walk: DataFrame, model_names: DataFrame) -> DataFrame:
    """Every native name of the crosswalk must exist in the model's list, whatever its case."""
    known = model_names.select(F.lower("native_name").alias("native_name")).distinct()
    missing = [r[0] for r in walk.join(known, "native_name", "left_anti").select("native_name").take(20)]
    if missing:
        raise ValueError(f"model does not know {sorted(missing)}")
    return walk


def remap_predictions(preds: DataFrame, walk: DataFrame) -> DataFrame:
    """Native prediction names to canonical ids; names outside the crosswalk are dropped."""
    ids = class_dimension(preds.sparkSession).select("class_name", "class_id")
    return preds.join(small_side(walk.join(ids, "class_name")), "native_name").drop("class_name", "native_name")
