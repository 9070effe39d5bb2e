"""How quality filters overlap in every order of application, kept up to date by a stream that takes counts back.

All files of a document table go through one streaming query in available-now micro-batches. Four filters look at one
text alone; the fifth rejects a text that a smaller id holds too, which is known only as far as files have been read. A
keyed state remembers the smallest id of every text. When a still smaller one arrives, what the former one added to the
counters of its part is retracted and added again as a repeated text. Some thousand texts share a state entry by the hash
of their keys, as each call into Python costs milliseconds; an entry is a small table of theirs. Each micro-batch writes its changes as a table of
its own, so a repeated one replaces itself, and the sums of all changes are the counters; a later run over the same work
folder takes in only the files that are new.

The counters, documents by (part, failed filters, good, toxic), answer for all orders: a step sees the documents that
failed none of the filters before it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from contextlib import ExitStack

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from boxweave.runtime import setting

FILTERS = "ABCDE"
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
REPEATED = BIT["E"]
# Micro-batches that the files present at the start of a run are dealt into.
BATCHES = 4
# Texts that share a state entry, about, by the rows that a table has when a work folder is begun.
GROUP_TEXTS = 2_000
CHANGES = "part string, mask int, good boolean, toxic boolean, n long"
# State in RocksDB: on the executors' disks and, as changes by the checkpoint, in the shared store, not in their memory.
# Its logs are not allocated ahead: that is disk for every partition of the state, however small.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def own_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails by itself."""
    words = F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), "")
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))

    def bit(name: str, fails: Column) -> Column:
        return F.when(fails, F.lit(BIT[name])).otherwise(F.lit(0))

    return F.element_at(
        F.transform(
            F.array(words),
            lambda w: bit("A", F.size(w) < 200)
            + bit("B", 100 * F.size(F.array_distinct(w)) < 50 * F.size(w))
            + bit("C", 100 * capitals > 2 * F.char_length(text))
            + bit("D", text.rlike("[#$%&*|]")),
        ),
        1,
    )


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, doc_id, part, mask, good, toxic): the text only as its SHA-256, by which texts are identical."""
    text = F.coalesce(F.col("text"), F.lit(""))
    seen = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), own_mask(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("key"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    flag = lambda name: F.coalesce(name, F.lit(False)).alias(name)
    return seen.join(marks, "doc_id", "left").select("key", "doc_id", "part", "mask", flag("good"), flag("toxic"))


def combined(rows: DataFrame) -> DataFrame:
    """Fewer rows per text before the shuffle: (key, first, later, part, mask, good, toxic, n).

    ``first`` is the smallest id of the text in an Arrow batch, ``later`` whether the n rows have a larger one. Rows
    without id are never later. However often a text occurs, a batch of rows leaves a few of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t.join(t.group_by("key").aggregate([("doc_id", "min")]), "key")
            later = pc.fill_null(pc.greater(t["doc_id"], t["doc_id_min"]), False)
            first = pc.if_else(pc.is_null(t["doc_id"]), None, t["doc_id_min"])
            t = t.append_column("first", first.cast(pa.int64())).append_column("later", later).append_column("one", pa.array([1] * len(t), pa.int64()))
            keys = ["key", "first", "later", "part", "mask", "good", "toxic"]
            t = t.group_by(keys).aggregate([("one", "sum")]).rename_columns([*keys, "n"])
            yield from t.combine_chunks().to_batches()

    return rows.mapInArrow(run, "key binary, first long, later boolean, part string, mask int, good boolean, toxic boolean, n long")


def _merged(held: pa.Table, rows: pa.Table) -> tuple[pa.Table, pa.Table]:
    """What is held of some texts after further rows of (key, first, later, part, mask, good, toxic, n), and the changes.

    Held are the rows of each text's smallest id. What is no longer among them has become a repeated text: its count is
    taken back from the mask it was added to.
    """
    both = pa.concat_tables([held.append_column("old", pa.array([True] * len(held), pa.bool_())), rows.append_column("old", pa.array([False] * len(rows), pa.bool_()))])
    both = both.join(both.group_by("key").aggregate([("first", "min")]), "key")
    late = pc.fill_null(pc.or_(both["later"], pc.greater(both["first"], both["first_min"])), False)
    mask, repeated = both["mask"], pc.bit_wise_or(both["mask"], pa.scalar(REPEATED, pa.int32()))
    shared = [both["part"], both["good"], both["toxic"]]

    def change(mask, n, where):
        return pa.table([*shared, mask, n], ["part", "good", "toxic", "mask", "n"]).filter(where)

    new, gone = pc.invert(both["old"]), pc.and_(both["old"], late)
    moved = pa.concat_tables(
        [change(pc.if_else(late, repeated, mask), both["n"], new), change(mask, pc.negate(both["n"]), gone), change(repeated, both["n"], gone)]
    )
    moved = moved.group_by(["part", "mask", "good", "toxic"]).aggregate([("n", "sum")])
    keeps = pc.and_(pc.invert(late), pc.is_valid(both["first"]))
    fields = ["key", "first", "later", "part", "mask", "good", "toxic"]
    after = both.filter(keeps).group_by(fields).aggregate([("n", "sum")]).select([*fields, "n_sum"]).rename_columns([*fields, "n"])
    return after, moved.filter(pc.not_equal(moved["n_sum"], 0))


def changes(rows: DataFrame, groups: int) -> DataFrame:
    """Changes of the counters by the keyed state: of every text the smallest id, and what it added."""
    fields = ["key", "first", "later", "part", "mask", "good", "toxic", "n"]
    kinds = [pa.binary(), pa.int64(), pa.bool_(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64()]
    schema = pa.schema(list(zip(fields, kinds)))

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = pa.ipc.open_stream(state.get[0]).read_all() if state.exists else schema.empty_table()
        for frame in frames:
            # Ids come as text: a long with nulls would reach pandas as a double.
            columns = [pa.array(frame[f], pa.string() if f == "first" else kind, from_pandas=True) for f, kind in zip(fields, kinds)]
            columns[1] = columns[1].cast(pa.int64())
            held, moved = _merged(held, pa.table(columns, schema=schema))
            yield moved.rename_columns(["part", "mask", "good", "toxic", "n"]).to_pandas()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema) as stream:
            stream.write_table(held.cast(schema))
        state.update((sink.getvalue().to_pybytes(),))

    grouped = rows.withColumn("first", F.col("first").cast("string")).withColumn("entry", F.expr(f"pmod(xxhash64(key), {groups})"))
    return grouped.groupBy("entry").applyInPandasWithState(update, CHANGES, "held binary", "update", GroupStateTimeout.NoTimeout)


def state_groups(spark: SparkSession, path: str, work: str) -> int:
    """How many entries the state has: settled when a work folder is begun, then read from it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{work}/groups/_SUCCESS")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        groups = spark.read.parquet(path).agg(F.ceil((F.count(F.lit(1)) + 1) / F.lit(GROUP_TEXTS)).alias("groups"))
        groups.write.mode("overwrite").parquet(f"{work}/groups")
    return spark.read.parquet(f"{work}/groups").first()["groups"]


def open_stream(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """The files of a table in any store as a stream of about ``batches`` micro-batches; a single file by its folder."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = store.getContentSummary(where).getFileCount()
    reader = spark.readStream.schema(spark.read.parquet(path).select("doc_id", "text", "source").schema)
    reader = reader.option("maxFilesPerTrigger", max(1, -(-files // batches)))
    if store.getFileStatus(where).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", where.getName()).parquet(where.getParent().toString())


def run_stream(spark: SparkSession, path: str, labels: DataFrame, work: str, batches: int = BATCHES) -> DataFrame:
    """Take in the files of ``path`` that ``work`` has not seen, and return all counters (part, mask, good, toxic, n).

    ``work`` is a folder of the shared store; it holds the stream's progress and state, and the changes per micro-batch.
    """
    spark.createDataFrame([], CHANGES).write.mode("overwrite").parquet(f"{work}/changes/batch=-1")
    docs = open_stream(spark, path, batches)

    def keep(frame: DataFrame, batch: int) -> None:
        summed = frame.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")
        summed.write.mode("overwrite").parquet(f"{work}/changes/batch={batch}")

    with ExitStack() as stack:
        for name, value in STATE_SETTINGS.items():
            stack.enter_context(setting(spark, name, value))
        query = (
            changes(combined(marked(docs, labels)), state_groups(spark, path, work))
            .writeStream.outputMode("update")
            .option("checkpointLocation", f"{work}/progress")
            .trigger(availableNow=True)
            .foreachBatch(keep)
            .start()
        )
        query.awaitTermination()
    summed = spark.read.schema(CHANGES).parquet(f"{work}/changes").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    return summed.where("n <> 0")


def steps(spark: SparkSession) -> DataFrame:
    """(filter_order, step, filter, before) of all orders: 600 rows; ``before`` has the bits of the earlier filters."""
    rows = [("".join(order), i + 1, order[i], sum(BIT[f] for f in order[:i])) for order in itertools.permutations(FILTERS) for i in range(len(order))]
    return spark.createDataFrame(rows, "filter_order string, step int, filter string, before int")


def report(counters: DataFrame) -> DataFrame:
    """One row per part, order and step from the counters; every part has all 600.

    Counts are first summed for the 80 pairs of a filter and a set of filters before it, then spread over the orders.
    """
    pairs = [(name, before) for name in FILTERS for before in range(1 << len(FILTERS)) if not before & BIT[name]]
    seen = counters.select(
        "*", F.explode(F.array(*[F.struct(F.lit(name).alias("filter"), F.lit(BIT[name]).alias("bit"), F.lit(before).alias("before")) for name, before in pairs])).alias("p")
    ).select("part", "mask", "good", "toxic", "n", "p.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    left = F.col("mask").bitwiseAND(F.col("before")) == 0
    total = lambda when, name: F.sum(F.when(when, F.col("n")).otherwise(F.lit(0).cast("long"))).alias(name)
    by_pair = seen.groupBy("part", "filter", "before").agg(
        total(left & ~fails, "kept"),
        total(left & fails, "removed"),
        total(~left & fails, "redundant"),
        total(F.col("mask") == F.col("bit"), "unique_fails"),
        total(left & fails & F.col("good"), "good_lost"),
        total(left & fails & F.col("toxic"), "toxic_lost"),
        # Of the filters a document fails, each comes first in an equal share of the 120 orders.
        F.sum(F.when(fails, F.col("n") * F.expr("120 div bit_count(mask)")).otherwise(F.lit(0).cast("long"))).alias("shapley"),
    )
    named = by_pair.join(F.broadcast(steps(counters.sparkSession)), ["filter", "before"])
    return named.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(spark: SparkSession, path: str, labels: DataFrame, work: str, batches: int = BATCHES) -> DataFrame:
    """The report over all files of ``path`` with columns doc_id, text and source, others left behind.

    A null text is the empty one, a null source the part ''. Rows with equal ids and texts do not repeat each other; a
    document without id neither repeats nor is repeated. A document is good or toxic if any label row of its id says so.
    A table without rows has an empty report.
    """
    return report(run_stream(spark, path, labels, work, batches))
