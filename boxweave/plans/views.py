"""Stand-in annotation tables derived from the driver tables, for Spark and as oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from boxweave.runtime import scratch_path

BOXES_SQL = """
select concat('s', cast(l_orderkey % 5 as varchar)) as source,
  concat('img', lpad(cast(l_orderkey as varchar), 9, '0')) as stem,
  cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
       l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) as int) as line_no,
  cast(l_partkey % 16 as int) as class_id,
  case when l_partkey % 199 = 0 then cast(1.5 as double)
       else 0.25 + cast(l_partkey * 13 % 500 as double) / 1000 end as cx,
  0.3 + cast(l_orderkey * 7 % 400 as double) / 1000 as cy,
  l_quantity / 100 as w,
  cast(l_suppkey * 7 % 97 as double) / 120 as h
from lineitem"""

PREDS_SQL = """
select source, stem, line_no as pred_no,
  case when line_no % 7 = 0 then (class_id + 1) % 16 else class_id end as class_id,
  cx - w / 2 + 0.01 as x, cy - h / 2 as y, w, h,
  cast((class_id * 31 + line_no * 17) % 100 as double) / 100 as conf
from boxes"""

POOL_SQL = """
select doc_id, source, concat(source, '__', lpad(cast(doc_id as varchar), 9, '0')) as filename,
  md5(text) as content_key, md5(regexp_replace(text, '[0-9 .]+', '', 'g')) as body_key, concat(lang, '-', cast(n_chars as varchar)) as size_key
from documents"""

# Same boxes with the native name and the pixel box of a 1280 x 720 image.
RAW_SQL = """
select source, stem, line_no, p_brand as native_name, cast(floor((cx - w / 2) * 1280) as bigint) as x,
  cast(floor((cy - h / 2) * 720) as bigint) as y, cast(floor(w * 1280) as bigint) as pw, cast(floor(h * 720) as bigint) as ph
from (%s) b join part on p_partkey = l_partkey""" % BOXES_SQL.replace("select concat", "select l_partkey, concat", 1)

# Label text of one file per supplier, with lines of four and six tokens, blank lines and words.
FILE_LINES_SQL = """
select *, case kind when 'blank' then '   ' when 'word' then concat('x ', cx, ' ', cy, ' ', w, ' ', h)
  when 'four' then concat(class_id, ' ', cx, ' ', cy, ' ', w) when 'six' then concat(class_id, ' ', cx, ' ', cy, ' ', w, ' ', h, ' 0.5')
  else concat(class_id, ' ', cx, ' ', cy, ' ', w, ' ', h) end as value
from (
  select concat('s', cast(l_suppkey % 5 as varchar)) as source, concat('sup', lpad(cast(l_suppkey as varchar), 9, '0')) as stem,
    line_no, cast(l_partkey % 18 as int) - 1 as class_id,
    concat('0.', lpad(cast(250 + l_partkey * 13 % 500 as varchar), 3, '0')) as cx,
    concat('0.', lpad(cast(300 + l_orderkey * 7 % 400 as varchar), 3, '0')) as cy,
    concat('0.', lpad(cast(cast(l_quantity as int) as varchar), 2, '0')) as w,
    concat('0.', lpad(cast(l_suppkey * 7 % 97 as varchar), 2, '0')) as h,
    case when line_no % 11 = 0 then 'four' when line_no % 13 = 0 then 'six' when line_no % 17 = 0 then 'blank'
      when line_no % 19 = 0 then 'word' else 'five' end as kind
  from (select *, cast(row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey, l_quantity,
      l_extendedprice, l_discount, l_tax, l_shipdate) as int) as line_no from lineitem) n) t"""

SQL_VIEWS = {"raw": RAW_SQL, "file_lines": FILE_LINES_SQL, "boxes": BOXES_SQL, "preds": PREDS_SQL, "pool": POOL_SQL}
NEEDS = {"preds": ("boxes", "preds")}


def with_views(sql: str, *views: str, **extra: str) -> str:
    """Prefix oracle SQL with the stand-in views it uses and any further named subqueries."""
    named: dict[str, str] = {}
    for view in views:
        for name in NEEDS.get(view, (view,)):
            named[name] = SQL_VIEWS[name]
    named.update(extra)
    head = ",\n".join(f"{name} as ({body})" for name, body in named.items())
    return f"with recursive {head}\n{sql}" if head else sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WRITTEN: dict[tuple[str, str, str], tuple] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Derive an input table once per session and read it back, as the table an earlier job left behind."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        df, path = build(), scratch_path(spark, name)
        df.write.parquet(path)
        _WRITTEN[key] = (path, df.schema)
    path, schema = _WRITTEN[key]
    return spark.read.schema(schema).parquet(path)


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "boxes", lambda: derived_boxes(spark, sf_dir))


def derived_boxes(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Boxes of all lines, with ``extra`` columns.

    Where the SQL's last order keys only part lines that make equal rows, the same rows come out in any order of these,
    so they are not sent through the shuffle; a further column may tell such lines apart and keeps them.
    """
    line = table(spark, sf_dir, "lineitem")
    shown, ties = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], ["l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
    in_image = Window.partitionBy("l_orderkey").orderBy(*shown, *([] if set(extra) <= set(shown) else ties))
    whole = lambda text: F.expr(text).cast("double")
    return line.select(
        *extra,
        F.concat(F.lit("s"), F.expr("l_orderkey % 5").cast("string")).alias("source"),
        F.concat(F.lit("img"), F.lpad(F.col("l_orderkey").cast("string"), 9, "0")).alias("stem"),
        F.row_number().over(in_image).cast("int").alias("line_no"),
        F.expr("l_partkey % 16").cast("int").alias("class_id"),
        F.when(F.expr("l_partkey % 199 = 0"), F.lit(1.5))
        .otherwise(F.lit(0.25) + whole("l_partkey * 13 % 500") / F.lit(1000.0))
        .alias("cx"),
        (F.lit(0.3) + whole("l_orderkey * 7 % 400") / F.lit(1000.0)).alias("cy"),
        (F.col("l_quantity") / F.lit(100.0)).alias("w"),
        (whole("l_suppkey * 7 % 97") / F.lit(120.0)).alias("h"),
    )


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(spark, sf_dir).select(
        "source",
        "stem",
        F.col("line_no").alias("pred_no"),
        F.expr("case when line_no % 7 = 0 then (class_id + 1) % 16 else class_id end").alias("class_id"),
        (F.col("cx") - F.col("w") / 2 + F.lit(0.01)).alias("x"),
        (F.col("cy") - F.col("h") / 2).alias("y"),
        "w",
        "h",
        (F.expr("(class_id * 31 + line_no * 17) % 100").cast("double") / F.lit(100.0)).alias("conf"),
    )


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "pool", lambda: derived_pool(spark, sf_dir))


def derived_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        "source",
        F.concat_ws("__", "source", F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("filename"),
        F.md5(F.col("text")).alias("content_key"),
        F.md5(F.regexp_replace("text", "[0-9 .]+", "")).alias("body_key"),
        F.concat(F.col("lang"), F.lit("-"), F.col("n_chars").cast("string")).alias("size_key"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "raw", lambda: derived_raw(spark, sf_dir))


def derived_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = derived_boxes(spark, sf_dir, "l_partkey")
    named = b.join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    return named.select(
        "source",
        "stem",
        "line_no",
        F.col("p_brand").alias("native_name"),
        F.floor((F.col("cx") - F.col("w") / 2) * 1280).alias("x"),
        F.floor((F.col("cy") - F.col("h") / 2) * 720).alias("y"),
        F.floor(F.col("w") * 1280).alias("pw"),
        F.floor(F.col("h") * 720).alias("ph"),
    )


def in_file():
    """The number of a line in its supplier's file; the SQL's further order keys only part lines that make equal rows."""
    return F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")).cast("int")


def file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one file per supplier; a file's rows lie together by ``l_suppkey``."""
    tenth = lambda text, n: F.concat(F.lit("0."), F.lpad(F.expr(text).cast("string"), n, "0"))
    n = F.col("line_no")
    rows = table(spark, sf_dir, "lineitem").withColumn("line_no", in_file()).select(
        "l_suppkey",
        F.concat(F.lit("s"), F.expr("l_suppkey % 5").cast("string")).alias("source"),
        F.concat(F.lit("sup"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("stem"),
        "line_no",
        (F.expr("l_partkey % 18").cast("int") - 1).alias("class_id"),
        tenth("250 + l_partkey * 13 % 500", 3).alias("cx"),
        tenth("300 + l_orderkey * 7 % 400", 3).alias("cy"),
        tenth("cast(l_quantity as int)", 2).alias("w"),
        tenth("l_suppkey * 7 % 97", 2).alias("h"),
        F.when(n % 11 == 0, "four").when(n % 13 == 0, "six").when(n % 17 == 0, "blank").when(n % 19 == 0, "word").otherwise("five").alias("kind"),
    )
    words = lambda *c: F.concat_ws(" ", *c)
    value = (
        F.when(F.col("kind") == "blank", "   ")
        .when(F.col("kind") == "word", words(F.lit("x"), "cx", "cy", "w", "h"))
        .when(F.col("kind") == "four", words("class_id", "cx", "cy", "w"))
        .when(F.col("kind") == "six", words("class_id", "cx", "cy", "w", "h", F.lit("0.5")))
        .otherwise(words("class_id", "cx", "cy", "w", "h"))
    )
    return rows.withColumn("value", value)
