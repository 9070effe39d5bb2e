"""Readers of the other annotation formats, each giving one row per box."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxweave.runtime import cut_lineage, write_counted
from boxweave.sources.files import in_folders, in_subfolders, open_path
from boxweave.sources.json_arrays import elements
from boxweave.sources.labels import scan_files, to_lines

CROWD = "ID string, gtboxes array<struct<tag:string,vbox:array<double>,extra:struct<ignore:int>>>"
CORNERS = (
    "size struct<width:int,height:int>, "
    "objects array<struct<classTitle:string,points:struct<exterior:array<array<double>>>>>"
)
# One row per element of a document's arrays.
COCO = (
    "folder string, kind string, line_no int, id long, name string, width int, height int, image_id long, category_id long, "
    "x double, y double, w double, h double"
)
ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}


def crowd_images(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(image, boxes) of crowd JSON lines: persons not marked ignore; images without any stay, empty.

    Of repeated IDs in one file the last line wins; block and position in the block give the line order.
    """
    order = F.struct(
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("i"),
    )
    wanted = lambda g: (g["tag"] == "person") & (F.coalesce(g["extra"]["ignore"], F.lit(0)) != 1)
    rows = spark.read.schema(CROWD).json(path).select("ID", "gtboxes", order.alias("line"))
    kept = rows.select(F.col("ID").alias("image"), F.transform(F.filter("gtboxes", wanted), lambda g: g["vbox"]).alias("boxes"), "line")
    return kept.groupBy("image", "line.f").agg(F.max_by("boxes", "line").alias("boxes")).select("image", "boxes")


def crowd_boxes(images: DataFrame) -> DataFrame:
    """One row per kept box; an image without boxes keeps one row of nulls."""
    rows = images.select("image", F.posexplode_outer("boxes").alias("pos", "v"))
    return rows.select("image", (F.col("pos") + 1).alias("line_no"), *[F.get("v", i).alias(c) for i, c in enumerate("xywh")])


def headed_boxes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Object lines ``name x y w h ...`` of files whose first line is a header; names are taken from a path once a file."""
    image, folder = F.regexp_extract("path", r"([^/]+)\.txt$", 1), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    named = scan_files(spark, path).select("path", image.alias("image"), folder.alias("folder"), "text")
    lines = to_lines(named).where(F.col("file_line") > 1)
    tokens = lines.withColumn("t", F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")).where(F.trim("value") != "")
    return tokens.select(
        "path",
        "image",
        "folder",
        (F.col("file_line") - 1).alias("line_no"),
        F.col("t")[0].alias("native_name"),
        *[F.expr(f"try_cast(get(t, {i}) as int)").alias(c) for i, c in enumerate("xywh", start=1)],
    )


def corner_boxes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Two-corner objects of one JSON document per image; the image is named by the file."""
    folders, names = in_folders(spark, path)
    docs = spark.read.schema(CORNERS).options(multiLine=True, **names).json(folders)
    image = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
    rows = docs.select(image.alias("image"), "size", "objects").select(
        "image",
        F.col("size.width").alias("width"),
        F.col("size.height").alias("height"),
        F.posexplode_outer("objects").alias("pos", "o"),
    )
    corner = lambda p, k: F.get(F.get("o.points.exterior", F.lit(p)), F.lit(k))
    return rows.select(
        "image",
        "width",
        "height",
        (F.col("pos") + 1).alias("line_no"),
        F.col("o.classTitle").alias("native_name"),
        corner(0, 0).alias("x1"),
        corner(0, 1).alias("y1"),
        corner(1, 0).alias("x2"),
        corner(1, 1).alias("y2"),
    )


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The files that the paths or patterns match, by the file system of each; those without any are warned about."""
    files, found = spark.sparkContext._jvm.org.apache.hadoop.fs, []
    for path in paths:
        at = files.Path(path)
        store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        there = list(store.globStatus(at) or [])
        if not there:
            warnings.warn(f"no annotations at {path}", stacklevel=3)
        for status in there:
            inside = store.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [s.getPath().toString() for s in inside if not s.isDirectory()]
    return found


def _documents(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, int]:
    """(path) of the documents and their number. The files of ``base/*/name`` are as many as folders: tasks find these."""
    wide = [re.fullmatch(r"([^*?\[{]+)/\*/([^/*?\[{]+)", p) for p in paths]
    there = existing(spark, [p for p, w in zip(paths, wide) if not w])
    found, n = [spark.createDataFrame([(p,) for p in there], "path string")], len(there)
    for w in filter(None, wide):
        files, rows, _ = write_counted(in_subfolders(spark, *w.groups()), "documents")
        if not rows:
            warnings.warn(f"no annotations at {w.group()}", stacklevel=4)
        found, n = [*found, files], n + rows
    return reduce(DataFrame.unionByName, found), n


def _column(values: tuple, kind: pa.DataType) -> pa.Array:
    """Values of one type; texts and whole floats count as the number they show, where one is asked for."""
    try:
        return pa.array(values, kind)
    except (pa.ArrowInvalid, pa.ArrowTypeError):
        if kind == pa.string():
            return pa.array([None if v is None else str(v) for v in values], kind)
        return pa.array(pd.Series(values, dtype=object).astype("Int64"), kind)


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements of each document of (path) rows, in pieces of bounded size."""
    names, kinds = zip(*(c.split(" ") for c in COCO.split(", ")))

    def row(folder: str, kind: str, number: int, e: dict) -> tuple:
        box = (e.get("bbox") or []) if kind == "annotations" else []
        name = e.get("file_name") if kind == "images" else e.get("name")
        size = (e.get("width"), e.get("height"))
        return (folder, kind, number, e.get("id"), name, *size, e.get("image_id"), e.get("category_id"), *[*map(float, box[:4]), *[None] * 4][:4])

    for batch in batches:
        for path in batch.column(0).to_pylist():
            folder = path.split("/")[-2] if "/" in path else ""
            system, at = open_path(path)
            with system.open_input_stream(at) as stream:
                rows = (row(folder, *found) for found in elements(stream.read, {"images", "categories", "annotations"}))
                while some := list(islice(rows, 10_000)):
                    yield pa.RecordBatch.from_arrays([_column(v, ARROW[k]) for v, k in zip(zip(*some), kinds)], list(names))


def coco_tables(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(annotations, categories, images) of COCO documents, keyed by the folder each lies in.

    Every document is read once, by one task that streams its elements into a stored table, whatever its size; the
    three results are parts of that table. A path without a file is skipped with a warning: its folder counts as
    empty. A document that is no JSON object is an error.
    """
    docs, n = _documents(spark, [path] if isinstance(path, str) else path)
    # Many small documents share a task; a task a document would mostly start tasks.
    docs = docs.repartition(max(1, min(n, spark.sparkContext.defaultParallelism * 16)))
    stored = cut_lineage(docs.mapInArrow(_elements, COCO), "coco")
    part = lambda kind: stored.where(F.col("kind") == kind)
    annotations = part("annotations").select("folder", "line_no", "image_id", "category_id", *"xywh")
    categories = part("categories").select("folder", F.col("id").alias("category_id"), F.col("name").alias("native_name"))
    images = part("images").select("folder", F.col("id").alias("image_id"), F.col("name").alias("file_name"), "width", "height")
    return annotations, categories, images


def resolve_coco(annotations: DataFrame, categories: DataFrame, images: DataFrame) -> DataFrame:
    """Name and image of each annotation; an unknown category leaves the name null.

    An unknown image is an error, but not for an annotation of an unknown category, which is dropped anyway.
    """
    named = annotations.join(categories, ["folder", "category_id"], "left")
    missing = F.concat(F.lit("annotation of unknown image "), F.col("image_id").cast("string"))
    return named.join(images, ["folder", "image_id"], "left").withColumn(
        "file_name", F.when(F.col("native_name").isNotNull() & F.col("file_name").isNull(), F.raise_error(missing).cast("string")).otherwise(F.col("file_name"))
    )
