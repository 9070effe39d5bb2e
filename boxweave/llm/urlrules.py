"""URL rules by a sort-merge range join over reversed hosts.

The canonical key of a url is its host with the labels reversed, each closed by a dot, and then the path:
``www.example.org/es/1`` is ``org.example.www./es/1``. All hosts at or under a rule's host are then one
interval of keys, and intervals of two rules are nested or apart. Urls and rules are dealt by ranges of the
key and sorted; one sweep per range keeps the stack of rules whose interval is open, and the longest one
whose path fits wins (length of host plus path, then of the host, then block before allow).

A url that is null or without ``://`` has an empty host and path and fits no rule; without a fitting rule
the verdict is the default one; repeated urls are judged alike; without rules every url gets the default;
repeated rules count once; rules with a null host, path or verdict are an error; an empty table gives an
empty result; columns other than ``page_id`` and ``url`` are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

# Keys looked at to choose the range bounds, per range; bounds never change a verdict.
SAMPLED_KEYS = 40
# Only the head of a very long key takes part in the choice of bounds.
BOUND_CHARS = 200
VERDICTS = "page_id long, host string, path string, rule string, verdict string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host up to the first of ``/?#`` behind the first ``://``, A-Z lower-cased; path up to the first of ``?#``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*+", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*+([^?#]*+)", 1)


def reversed_host(host: Column) -> Column:
    """``www.example.org`` as ``org.example.www.``; the empty host stays empty."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page; ``rules`` are (host, path, verdict).

    One shuffle. A key so frequent that it spans several ranges is spread over all of them, with its rules
    in each; a rule goes to the ranges its interval meets, so neither side is broadcast.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("key", F.concat(reversed_host(F.col("host")), F.col("path")))
    for name in ("host", "path", "verdict"):
        rules = rules.withColumn(name, F.when(F.col(name).isNull(), F.raise_error(F.lit(f"a rule without {name}"))).otherwise(F.col(name)))
    rules = rules.select("host", "path", "verdict").distinct()
    rules = rules.withColumn("key", reversed_host(F.col("host")))
    # "/" follows "." directly, so it closes the interval of all keys that begin with the rule's host.
    rules = rules.withColumn("end", F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/")))

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    total = urls.count()
    share = F.rand(42) < min(1.0, SAMPLED_KEYS * n / max(total, 1))
    picked = sorted(r["k"] for r in urls.where(share).select(F.substring("key", 1, BOUND_CHARS).alias("k")).collect())
    bounds = [picked[i * len(picked) // n] for i in range(1, n)] if picked else []
    shared = spark.sparkContext.broadcast(bounds)

    @pandas_udf("int")
    def lowest(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: bisect_left(shared.value, k)).astype("int32")

    @pandas_udf("int")
    def highest(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: bisect_right(shared.value, k)).astype("int32")

    spread = F.pmod(F.xxhash64("page_id", F.monotonically_increasing_id()), F.col("hi") - F.col("lo") + 1)
    urls = urls.withColumn("lo", lowest("key")).withColumn("hi", highest("key")).withColumn("part", (F.col("lo") + spread).cast("int"))
    urls = urls.select("part", "key", F.lit(1).alias("kind"), F.lit("").alias("end"), "page_id", "host", "path", F.lit("").alias("verdict"))
    opened = rules.select(F.explode(F.sequence(lowest("key"), highest("end"))).alias("part"), "key", F.lit(0).alias("kind"), "end", F.lit(None).cast("long").alias("page_id"), "host", "path", "verdict")
    dealt = urls.unionByName(opened).repartition(n, "part").sortWithinPartitions("part", "key", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []  # open rules: end of the interval, path, order, name, verdict
        for batch in batches:
            out = []
            for p, key, kind, end, page, host, path, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    part, stack = p, []
                while stack and key >= stack[-1][0]:
                    stack.pop()
                if kind == 0:
                    stack.append((end, path, (len(host) + len(path), len(host), verdict), host + path, verdict))
                    continue
                fits = [r for r in stack if path.startswith(r[1])] if host else []
                best = max(fits, key=lambda r: r[2]) if fits else None
                out.append((page, host, path, best and best[3], best[4] if best else default))
            columns = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), *[pa.string()] * 4])], ["page_id", "host", "path", "rule", "verdict"])

    return dealt.mapInArrow(run, VERDICTS)
