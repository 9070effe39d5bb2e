"""Writers: label files, reports, rebuilt tables, pool manifests, training manifest, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from boxweave import config
from boxweave.functions.boxes import label_line
from boxweave.runtime import cut_lineage

CHUNK_LINES = 10_000


def text_chunks(rows: DataFrame, path, line, chunk_lines: int = CHUNK_LINES, by: tuple[str, ...] = ()) -> DataFrame:
    """(path, chunk, text): each file's lines in ``line_no`` order, in pieces of bounded length.

    Where the rows already lie together by columns that name a file, ``by`` keeps them there, without another shuffle.
    """
    lines = rows.select(
        *by,
        path.alias("path"),
        F.expr(f"(line_no - 1) div {chunk_lines}").alias("chunk"),
        F.struct("line_no", line.alias("line")).alias("l"),
    )
    ordered = F.sort_array(F.collect_list("l"))
    text = F.concat(F.concat_ws("\n", F.transform(ordered, lambda x: x["line"])), F.lit("\n"))
    return lines.groupBy(*by, "path", "chunk").agg(text.alias("text")).drop(*by)


def label_chunks(rows: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """Label text per image of (source, stem, line_no, class_id, cx, cy, w, h) rows."""
    path = F.concat("source", F.lit("/labels/"), "stem", F.lit(".txt"))
    return text_chunks(rows, path, label_line(), chunk_lines)


def write_report(report: DataFrame, path: str) -> None:
    """One JSON document set per stage; the input is an aggregate of a few rows."""
    report.coalesce(1).write.mode("overwrite").json(path)


def rebuild(rows: DataFrame, path: str, *partition: str) -> None:
    """Replace a table wholly, so nothing of an earlier run stays behind."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition).parquet(path)


def write_flagged(flagged: DataFrame, path: str) -> None:
    """Full flagged lists, one folder per source."""
    flagged.write.mode("overwrite").partitionBy("source").json(path)


def snapshot(rows: DataFrame, root: str, stamp: str) -> str:
    """Write a new dated copy; an existing one is never overwritten."""
    path = f"{root}/{stamp}"
    rows.write.mode("errorifexists").parquet(path)
    return path


def pool_manifest(files: DataFrame) -> DataFrame:
    """(source, filename, dst): target names prefixed with their source."""
    return files.select("source", "filename", F.concat_ws("__", "source", "filename").alias("dst"))


def collisions(manifest: DataFrame) -> DataFrame:
    """Targets claimed by more than one file."""
    return manifest.groupBy("dst").agg(F.count(F.lit(1)).alias("files")).where(F.col("files") > 1)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New keys replace old rows, all other old rows stay."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def begin_store(rows: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Write a keyed store in ``buckets`` folders by the hash of the key; an existing one is an error."""
    _bucketed(rows, keys, buckets).write.mode("errorifexists").partitionBy("bucket").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def upsert_store(new: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Replace the stored rows of the new keys; buckets that none of these falls into keep their files.

    The touched buckets are written aside whole, then swapped in as partitions, so the stored table is never read and
    written at once, and a job that is run again ends with the same rows. ``buckets`` is the store's own number.
    """
    spark = new.sparkSession
    fresh = cut_lineage(_bucketed(new, keys, buckets), "session")
    touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    if touched:
        stored = spark.read.parquet(path)
        old = stored.where(F.col("bucket").isin(touched)).select(fresh.columns)
        merged = cut_lineage(upsert(old, fresh, keys), "buckets")
        merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def _bucketed(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    return rows.withColumn("bucket", bucket).repartition("bucket")


def split_counts(assigned: DataFrame, labels: DataFrame) -> DataFrame:
    """Images and label files per split, zeros kept. ``assigned`` is (source, stem, split)."""
    spark = assigned.sparkSession
    names = F.broadcast(spark.createDataFrame([(s,) for s in config.SPLIT_NAMES], "split string"))
    has = labels.select("source", "stem").distinct().withColumn("has_label", F.lit(True))
    counts = assigned.join(has, ["source", "stem"], "left").groupBy("split").agg(
        F.count(F.lit(1)).alias("images"), F.count("has_label").alias("labels")
    )
    return names.join(counts, "split", "left").na.fill(0)


def training_manifest(counts: DataFrame) -> DataFrame:
    """The one-row training manifest; any empty split is an error. It names no root path on purpose."""
    names = F.create_map(*[F.lit(v) for pair in enumerate(config.CLASS_NAMES) for v in pair])
    empty = F.concat_ws(", ", F.sort_array(F.collect_list(F.when(F.col("images") == 0, F.col("split")))))
    message = F.concat(F.lit("empty splits: "), F.col("empty"))
    paths = [F.lit(f"{s}/images").alias(s) for s in config.SPLIT_NAMES]
    return counts.agg(empty.alias("empty")).select(
        F.when(F.col("empty") != "", F.raise_error(message).cast("string")).otherwise(F.lit(config.SPLIT_NAMES[0] + "/images")).alias("train"),
        *paths[1:],
        F.lit(len(config.CLASS_NAMES)).alias("nc"),
        names.alias("names"),
    )


