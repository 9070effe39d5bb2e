"""Readers of selection reports, exclusion files and project addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SELECTION = "classes map<string, struct<selected: array<string>>>, seed int, instance_target int, hard_cap_preset int"
EXCLUSION = "source string, excluded_filenames array<string>"


def split_entry(entry: str) -> tuple[Column, Column]:
    """(source, stem) of ``source/stem``, split at the first slash; an entry without one is an error."""
    message = F.concat(F.lit("selection entry without separator: "), F.col(entry))
    where = F.instr(entry, "/")
    source = F.when(where > 0, F.substring_index(entry, "/", 1)).otherwise(F.raise_error(message).cast("string"))
    return source, F.expr(f"substring({entry}, instr({entry}, '/') + 1)")


def read_selection(spark: SparkSession, path: str) -> DataFrame:
    """(class_name, source, stem) of a selection report; bad JSON or a missing class map is an error."""
    docs = spark.read.schema(SELECTION).option("mode", "FAILFAST").option("multiLine", True).json(path)
    checked = docs.select(
        F.coalesce("classes", F.raise_error(F.lit("report has no classes")).cast(docs.schema["classes"].dataType)).alias("c")
    )
    rows = checked.select(F.explode("c").alias("class_name", "body")).select("class_name", F.explode("body.selected").alias("entry"))
    source, stem = split_entry("entry")
    return rows.select("class_name", source.alias("source"), stem.alias("stem"))


def read_selection_facts(spark: SparkSession, path: str) -> DataFrame:
    """Seed, target, preset and class names of a selection report, for the compatibility check."""
    docs = spark.read.schema(SELECTION).option("multiLine", True).json(path)
    return docs.select("seed", "instance_target", "hard_cap_preset", F.array_sort(F.map_keys("classes")).alias("class_names"))


def read_exclusions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Distinct (source, stem) over all exclusion files; file names lose their extension to match stems."""
    docs = spark.read.schema(EXCLUSION).json(path)
    rows = docs.select("source", F.explode("excluded_filenames").alias("name"))
    return rows.select("source", F.regexp_replace("name", r"(?<=.)\.[^.]*$", "").alias("stem")).distinct()


def project_of(url: Column | str) -> tuple[Column, Column]:
    """(workspace, project) of a project address; null when it has no two path parts."""
    url = F.col(url) if isinstance(url, str) else url
    usable = url.isNotNull() & (url != "") & (url != "TBD")
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    parts = F.split(F.regexp_replace(path, "^/+|/+$", ""), "/")
    two = usable & (F.size(parts) >= 2)
    return F.when(two, F.get(parts, F.lit(0))), F.when(two, F.get(parts, F.lit(1)))
