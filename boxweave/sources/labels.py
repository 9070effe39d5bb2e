"""Label text: file scans, the two line parsers, and the merged-key split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from boxweave.sources.files import in_folders

FIELDS = ("cx", "cy", "w", "h")


def scan_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, text), one row per non-empty file. Whole text keeps the line order of each file."""
    folders, names = in_folders(spark, paths)
    return spark.read.options(**names).text(folders, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def scan_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, file_line, value) by a splittable scan, for label files of any size.

    ``file_line`` is no line number but rises along each file: the start of the line's block plus its position
    in the task, which is smaller than the block's length in bytes.
    """
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    folders, names = in_folders(spark, paths)
    return spark.read.options(**names).text(folders).select(
        F.col("_metadata.file_path").alias("path"),
        (F.col("_metadata.file_block_start") + in_task).alias("file_line"),
        "value",
    )


def with_file_names(files: DataFrame) -> DataFrame:
    """Adds source and stem from ``.../<source>/labels/<stem>.txt``."""
    return files.select(
        F.regexp_extract("path", r"([^/]+)/labels/[^/]+$", 1).alias("source"),
        F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("stem"),
        *[c for c in files.columns if c not in ("source", "stem")],
    )


def to_lines(files: DataFrame, text: str = "text") -> DataFrame:
    """One row per line with its 1-based number; the text column is replaced by ``value``."""
    keep = [c for c in files.columns if c != text]
    lines = files.select(*keep, F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("pos", "value"))
    return lines.select(*keep, (F.col("pos") + 1).alias("file_line"), "value")


def _tokens(lines: DataFrame) -> DataFrame:
    return lines.withColumn("value", F.trim(F.regexp_replace("value", r"\s+", " "))).where(F.col("value") != "").withColumn(
        "t", F.split("value", " ")
    )


def _numbers(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Tokens to numbers without failing the job; ``bad`` marks lines that are not numeric."""
    parsed = lines.select(
        *keys,
        "file_line",
        F.when(F.col("t")[0].rlike(r"^[+-]?[0-9]+$"), F.expr("try_cast(t[0] as int)")).alias("class_id"),
        *[F.expr(f"try_cast(get(t, {i}) as double)").alias(c) for i, c in enumerate(FIELDS, start=1)],
        "value",
    )
    bad = F.col("class_id").isNull()
    for c in FIELDS:
        bad = bad | F.col(c).isNull()
    return parsed.withColumn("bad", bad)


def parse_labels(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Strict parser: only lines of exactly five tokens; others are skipped."""
    return _numbers(_tokens(lines).where(F.size("t") == 5), keys)


def parse_export(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lenient parser of exports: every non-blank line counts, the first five tokens are read."""
    return _numbers(_tokens(lines), keys)


def split_merged_key(rows: DataFrame, key: str) -> DataFrame:
    """Split ``<source>__<stem>`` at the first double underscore; a missing separator is an error."""
    where = F.instr(key, "__")
    message = F.concat(F.lit("merged name without source prefix: "), F.col(key))
    source = F.when(where > 0, F.substring_index(key, "__", 1)).otherwise(F.raise_error(message).cast("string"))
    rest = F.expr(f"substring({key}, instr({key}, '__') + 2)")
    return rows.withColumns({"source": source, "stem": rest})
