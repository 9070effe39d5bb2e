"""Seeded order, bounded top-k and exact order statistics that never gather a whole group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from boxweave.runtime import cut_lineage, small_side

# Groups up to this size are ranked whole; larger ones only inside a bracket around each target rank.
WHOLE_GROUP_ROWS = 2_000
# A sketch's ranks are off by 1/SKETCH_ACCURACY of a group at most; brackets reach three times as far.
SKETCH_ACCURACY = 1_000
BRACKET_PAD = 3.0 / SKETCH_ACCURACY
# Sessions with no more shuffle partitions than this need no second pruning stage in first_k.
NARROW_SHUFFLE = 64


def seeded(seed: int, *key: Column | str) -> Column:
    """Reproducible shuffle key: md5 of the seed and the row's own key."""
    columns = [F.col(k) if isinstance(k, str) else k for k in key]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.concat_ws("/", *columns)))


def first_k(df: DataFrame, partition: list[str], order: list, k: int, rank: str = "rn", salts: int | None = None) -> DataFrame:
    """First ``k`` rows per group, whatever the size of a group.

    The literal bound lets every map task prune to ``k`` rows per group before the shuffle. With many map
    tasks those leftovers would still meet in one task per group, so wide sessions prune once more over groups
    of map tasks: the salt is the task's number, which keeps the first pruning local.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold")) < k:
        conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(k))
    salts = int(conf.get("spark.sql.shuffle.partitions")) if salts is None else salts
    if salts > NARROW_SHUFFLE:
        keys = [F.col(c) if isinstance(c, str) else c for c in order]
        salted = df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        spread = Window.partitionBy(*partition, "__salt").orderBy(*keys)
        df = salted.withColumn("__rn", F.row_number().over(spread)).where(F.col("__rn") <= k).drop("__salt", "__rn")
    window = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def _lower_rank(i: int) -> Column:
    """Rank j of quartile ``i`` in a group of ``n``; the quartile lies between the values at j and j + 1."""
    return F.greatest(F.lit(1), F.least(F.col("n") - 1, F.expr(f"({i} * (n + 1)) div 4")))


def _between(i: int, low: Column, high: Column) -> Column:
    d = F.lit(i) * (F.col("n") + 1) - 4 * _lower_rank(i)
    return F.when((d == 0) | (F.col("n") == 1), low).otherwise((low * (4 - d) + high * d) / 4)


def exclusive_quartiles(df: DataFrame, keys: list[str], value: str, pad: float = BRACKET_PAD, whole_rows: int = WHOLE_GROUP_ROWS) -> DataFrame:
    """(keys, n, q1, q2, q3) by the exclusive (n+1) rule, exact for groups of any size; keys are not null.

    One aggregate takes the sizes and a mergeable sketch, which brackets each quartile between two values. A second pass
    counts what lies outside the brackets, folded to a few rows per group, and folds equal values inside them; only those
    are ranked, about 2/100 of a group. Groups of up to ``whole_rows`` are one bracket. Should a rank lie outside
    its bracket, the groups concerned take the second pass again with brackets eight times as wide.
    """
    rows = df.select(*keys, F.col(value).alias("__v")).where(F.col("__v").isNotNull())
    found, missed, sizes = [], None, None
    while missed is None or not missed.isEmpty():
        pad, part = (pad, rows) if missed is None else (pad * 8, rows.join(small_side(missed.select(*keys)), keys, "left_semi"))
        probes = [min(max(i / 4 + side * pad, 0.0), 1.0) for i in (1, 2, 3) for side in (-1, 1)]
        sizes = part.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("__v", probes, SKETCH_ACCURACY).alias("p"))
        ranked = cut_lineage(_ranked_brackets(part, sizes, keys, whole_rows, pad), "quartiles")
        found.append(ranked.where("not missed").drop("missed"))
        missed = ranked.where("missed")
    return reduce(DataFrame.unionByName, found)


def _ranked_brackets(rows: DataFrame, sizes: DataFrame, keys: list[str], whole_rows: int, pad: float) -> DataFrame:
    """(keys, n, missed, q1, q2, q3) from the brackets that ``p`` of ``sizes`` gives."""
    whole = (F.col("n") <= whole_rows) | F.lit(pad >= 0.25)
    ends = F.array(*[F.struct(F.col("p")[2 * k].alias("lo"), F.col("p")[2 * k + 1].alias("hi")) for k in range(3)])
    brackets = small_side(sizes.select(*keys, "n", whole.alias("whole"), ends.alias("ends")))
    v = F.col("__v")
    inside = F.col("whole") | F.exists("ends", lambda e: (v >= e["lo"]) & (v <= e["hi"]))
    # Rows outside fall between brackets; those of one gap are one row, placed by their smallest value.
    gap = F.when(~inside, F.size(F.filter("ends", lambda e: e["lo"] <= v)))
    folded = (
        rows.join(brackets, keys)
        .groupBy(*keys, "n", gap.alias("gap"), F.when(inside, v).alias("x"))
        .agg(F.count(F.lit(1)).alias("c"), F.min("__v").alias("at"))
    )
    upto = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = folded.withColumn("cum", F.sum("c").over(upto))

    def hit(rank: Column) -> Column:
        """The row that a rank falls into: its value, null where it is a gap."""
        return F.max(F.when((F.col("cum") >= rank) & (F.col("cum") - F.col("c") < rank), F.struct("x")))

    picks = [hit(_lower_rank(i) + more).alias(f"{name}{i}") for i in (1, 2, 3) for more, name in ((0, "a"), (1, "b"))]
    found = placed.groupBy(*keys, "n").agg(*picks)
    gone = [F.col(f"{name}{i}").isNotNull() & F.col(f"{name}{i}.x").isNull() for i in (1, 2, 3) for name in "ab"]
    return found.select(
        *keys, "n", reduce(Column.__or__, gone).alias("missed"), *[_between(i, F.col(f"a{i}.x"), F.col(f"b{i}.x")).alias(f"q{i}") for i in (1, 2, 3)]
    )


def rank_cutoffs(
    df: DataFrame, partition: str, order: list[str], bucket: Column, targets: dict[str, Column]
) -> DataFrame:
    """Per group, the order key of the row at each target rank, without ranking the whole group.

    ``order`` starts with a uniform string key whose prefix is ``bucket``. A histogram over the buckets
    (combined map-side) places each target rank in one bucket, and only those buckets are ranked.
    ``targets`` are expressions over the group size ``n``. Returns (partition, n, name -> order struct).
    """
    rows = df.withColumn("__b", bucket)
    hist = rows.groupBy(partition, "__b").agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy(partition).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    sized = hist.select(
        partition,
        "__b",
        (F.sum("c").over(upto) - F.col("c")).alias("before"),
        F.col("c"),
        F.sum("c").over(Window.partitionBy(partition)).alias("n"),
    )
    ranks = F.array(*[F.struct(F.lit(name).alias("name"), expr.cast("long").alias("k")) for name, expr in targets.items()])
    placed = sized.select("*", F.explode(ranks).alias("t"))
    cuts = small_side(
        placed.where((F.col("t.k") > F.col("before")) & (F.col("t.k") <= F.col("before") + F.col("c"))).select(
            partition, "__b", F.col("t.name").alias("name"), (F.col("t.k") - F.col("before")).alias("need")
        )
    )
    window = Window.partitionBy(partition, "name").orderBy(*order)
    at = (
        rows.select(partition, "__b", *order)
        .join(cuts, [partition, "__b"])
        .withColumn("__rn", F.row_number().over(window))
        .where(F.col("__rn") == F.col("need"))
        .groupBy(partition)
        .agg(*[F.max(F.when(F.col("name") == name, F.struct(*order))).alias(name) for name in targets])
    )
    totals = hist.groupBy(partition).agg(F.sum("c").alias("n"))
    return totals.join(at, partition, "left")
