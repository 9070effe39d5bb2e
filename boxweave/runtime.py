"""Session settings, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# Rows a hinted broadcast may hold; anything larger is left to the shuffle join Catalyst picks.
BROADCAST_ROWS = 200_000
# And the bytes its rows may take as JSON text.
BROADCAST_BYTES = 32 << 20
# A key is hot when it holds more than 1/HOT_KEYS of all rows, so there are fewer than HOT_KEYS of them.
HOT_KEYS = 10_000
# Below this many rows a key is never hot: one task takes them easily.
HOT_FLOOR = 100_000


def tune(spark: SparkSession) -> SparkSession:
    """Settings the plans rely on: adaptive execution and per-map pruning of ``row_number() <= k``."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "100000")
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value) -> Iterator[None]:
    """A session setting for the jobs run inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local session that names none."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, with its file system spelled out for readers other than Spark."""
    root = shared_dir(spark).rstrip("/")
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    if root.startswith("/") and not default.startswith("file:"):
        root = default.rstrip("/") + root
    return f"{root}/boxweave/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: short lineage, true size statistics."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_counted(df: DataFrame, name: str) -> tuple[DataFrame, int, str]:
    """As ``cut_lineage``, with the number of rows, observed while they are written, and the path to discard later."""
    spark, seen = df.sparkSession, Observation()
    path = scratch_path(spark, name)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["rows"], path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that no later step reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast for an aggregate only after its rows and their bytes have been checked; only then it stays cached."""
    kept = df.persist()
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    rows, held = kept.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    if rows <= max_rows and held <= BROADCAST_BYTES:
        return F.broadcast(kept)
    kept.unpersist()
    return df


def by_shuffle(df: DataFrame) -> DataFrame:
    """Hint a shuffle join for a side that grows with the input: its files are far smaller than its rows, so Catalyst
    would send it through the driver while they are below the broadcast threshold, join by join."""
    return df.hint("merge")


def join_on_group(
    rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int | None = None
) -> DataFrame:
    """Join many rows to the one ``groups`` row of their key without sending a hot key to one task.

    ``groups`` carries in ``size`` how many rows its key has. Keys above 1/HOT_KEYS of all rows are
    fewer than HOT_KEYS, so they go by broadcast; every other key takes the shuffle join, hinted so that
    no groups pass through the driver. ``total``, the number of rows if the caller knows it, saves counting
    and the whole hot branch where it cannot matter.
    """
    if total is not None and total <= HOT_FLOOR:
        return rows.join(by_shuffle(groups), keys)
    share = groups.agg(F.coalesce(F.sum(size) / F.lit(HOT_KEYS), F.lit(0.0))).scalar() if total is None else F.lit(total / HOT_KEYS)
    limit = F.greatest(share, F.lit(float(HOT_FLOOR)))
    hot = groups.where(F.col(size) > limit)
    cold = groups.where(F.col(size) <= limit)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(by_shuffle(cold), keys))
