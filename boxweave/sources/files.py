"""File listing, content hashes and writing of named files from tasks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from itertools import islice
from uuid import uuid4

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxweave import config
from boxweave.runtime import cut_lineage, setting

LISTING = "path string, length long, mtime timestamp"
HASHED_BLOCK = 8 << 20
LISTED_ROWS = 10_000


def open_path(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1))


def in_folders(spark: SparkSession, paths: str | list[str]) -> tuple[list[str], dict[str, str]]:
    """The folders of ``folder/*.ext`` patterns and the read option that picks the names.

    Given as patterns, every file would be a path of its own to look up and to list, in a task each.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    names = {p.rsplit("/", 1)[-1] for p in paths}
    if len(names) != 1 or not all("/" in p for p in paths) or not (name := names.pop()).startswith("*."):
        return paths, {}
    fs, folders = spark.sparkContext._jvm.org.apache.hadoop.fs, []
    for path in paths:
        at = fs.Path(_folder(path))
        store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        folders += [s.getPath().toString() for s in store.globStatus(at) or [] if s.isDirectory()]
    return (folders, {"pathGlobFilter": name}) if folders else (paths, {})


def _listed(directory: str, recursive: bool) -> Iterator[tuple]:
    """(path, length, mtime) of the files of a directory, one after the other as the file system names them.

    A local or mounted folder is never held whole, however many names it has; other stores answer for a folder at once.
    """
    from pyarrow import fs

    system, root = open_path(directory)
    if not isinstance(system, fs.LocalFileSystem):
        for f in system.get_file_info(fs.FileSelector(root, recursive=recursive)):
            if f.type == fs.FileType.File:
                yield f.path, f.size, f.mtime
        return
    waiting = [root]
    while waiting:
        with os.scandir(waiting.pop()) as entries:
            for e in entries:
                if e.is_file():
                    state = e.stat()
                    yield e.path, state.st_size, datetime.fromtimestamp(state.st_mtime, timezone.utc)
                elif recursive and e.is_dir():
                    waiting.append(e.path)


def list_files(spark: SparkSession, directories: list[str] | DataFrame, recursive: bool = True) -> DataFrame:
    """(path, length, mtime) of every file, zero-length ones included; a missing directory is an error.

    The directories are spread over tasks, so a wide tree lists in parallel, and rows leave a task while it lists.
    """
    if not isinstance(directories, DataFrame):
        directories = spark.createDataFrame([(d,) for d in directories], "directory string").repartition(len(directories))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for directory in batch["directory"]:
                rows = _listed(directory, recursive)
                while some := list(islice(rows, LISTED_ROWS)):
                    yield pd.DataFrame(some, columns=["path", "length", "mtime"])

    return directories.mapInPandas(run, LISTING)


def in_subfolders(spark: SparkSession, base: str, name: str) -> DataFrame:
    """(path) of the files ``base/*/name``: one task names the folders as they come, many look into them."""

    def folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, root = open_path(base)
        for _ in batches:
            if system.get_file_info(root).type != fs.FileType.Directory:
                continue
            if isinstance(system, fs.LocalFileSystem):
                with os.scandir(root) as entries:
                    names = (e.name for e in entries if e.is_dir())
                    while some := list(islice(names, LISTED_ROWS)):
                        yield pd.DataFrame({"path": [f"{base}/{n}/{name}" for n in some]})
            else:
                found = [f.base_name for f in system.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.Directory]
                yield pd.DataFrame({"path": [f"{base}/{n}/{name}" for n in found]})

    def there(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            yield batch[[system.get_file_info(at).type == fs.FileType.File for system, at in map(open_path, batch["path"])]]

    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    base = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    at = spark.createDataFrame([(base,)], "path string").coalesce(1)
    return at.mapInPandas(folders, "path string").repartition(spark.sparkContext.defaultParallelism).mapInPandas(there, "path string")


def file_names(files: DataFrame) -> DataFrame:
    """Adds filename, stem and lower-case extension from the path."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.withColumn("filename", name).withColumns(
        {
            "stem": F.regexp_replace("filename", r"(?<=.)\.[^.]*$", ""),
            "extension": F.lower(F.regexp_extract("filename", r".\.([^.]+)$", 1)),
        }
    )


def only_images(files: DataFrame) -> DataFrame:
    """Image files by extension, whatever its case."""
    return file_names(files).where(F.col("extension").isin(*config.IMAGE_EXTENSIONS))


def stem_index(images: DataFrame) -> DataFrame:
    """One file per (source, stem); of two files with one stem the last name wins."""
    return images.groupBy("source", "stem").agg(F.max("filename").alias("filename"))


def complete_sources(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Sources that have both images and labels."""
    return images.select("source").distinct().join(labels.select("source").distinct(), "source", "left_semi").orderBy("source")


def with_image_size(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Attach width and height from the image table; both inputs are keyed by image."""
    return rows.join(sizes.select("source", "stem", "width", "height"), ["source", "stem"])


def content_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, length, modified) of every file below ``path``, empty ones too.

    A file is read in blocks, so its size does not matter; files are spread over tasks by name.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from hashlib import sha256

        for batch in batches:
            hashes = []
            for name in batch["path"]:
                system, at = open_path(f"{store}{name}")
                digest = sha256()
                with system.open_input_stream(at) as stream:
                    while block := stream.read(HASHED_BLOCK):
                        digest.update(block)
                hashes.append(digest.hexdigest())
            yield pd.DataFrame({"path": batch["path"], "sha256": hashes, "length": batch["length"], "modified": batch["mtime"]})

    # Listed paths are those of the store alone; its scheme and host are those of ``path``.
    store = path[: path.index("/", path.index("://") + 3)] if "://" in path else ""
    listed = list_files(spark, [path]).repartition("path")
    return listed.mapInPandas(run, "path string, sha256 string, length long, modified timestamp")


# --- writing ---------------------------------------------------------------------------------------
# Tasks stage files beside their targets, each attempt under names of its own, and return what they staged. Spark keeps
# the rows of the attempts that count. Only then are staged files moved into place, by tasks that may be repeated: a file
# that is no longer staged but at its target has been moved. At the end, or after an error, the staging folders go.
PLACES = "staged string, target string, source string"
# Bytes of text in a batch that a staging task holds.
BATCH_BYTES = 32 << 20


def _folder(path: str) -> str:
    return path.rsplit("/", 1)[0]


def _staging(target: str, job: str) -> str:
    return f"{_folder(target)}/.staged-{job}"


def _exists(path: str) -> bool:
    from pyarrow import fs

    system, at = open_path(path)
    return system.get_file_info(at).type != fs.FileType.NotFound


def _on_rows(rows: DataFrame, act: Callable[[dict], None]) -> int:
    """Run ``act`` on every row inside tasks; the number of rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                act(row)
            yield pd.DataFrame({"n": [len(batch)]})

    return rows.mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _place(staged: DataFrame, targets: DataFrame, job: str, overwrite: bool, move: bool = False) -> None:
    """Stage, move into place, drop sources if asked to; ``targets`` has the (target) of every row, for the clean-up after an error."""

    def into_place(row: dict) -> None:
        from pyarrow import fs

        system, at = open_path(row["staged"])
        to = open_path(row["target"])[1]
        if system.get_file_info(at).type == fs.FileType.NotFound:
            if system.get_file_info(to).type == fs.FileType.NotFound:
                raise FileNotFoundError(at)
            return
        if not overwrite and system.get_file_info(to).type != fs.FileType.NotFound:
            raise FileExistsError(to)
        system.move(at, to)

    def drop_source(row: dict) -> None:
        system, at = open_path(row["source"])
        if _exists(row["source"]):
            system.delete_file(at)

    def drop_staging(row: dict) -> None:
        from pyarrow import fs

        system, at = open_path(row["folder"])
        if system.get_file_info(at).type == fs.FileType.Directory:
            system.delete_dir(at)

    done = None
    try:
        done = cut_lineage(staged, "staged")
        twice = done.groupBy("target").agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
        if twice:
            raise FileExistsError(f"{twice['n']} rows for {twice['target']}")
        _on_rows(done, into_place)
        if move:
            _on_rows(done.where("source <> target"), drop_source)
    finally:
        # Only if staging failed are the targets derived once more.
        folders = (targets if done is None else done).select(F.regexp_replace("target", "/[^/]*$", f"/.staged-{job}").alias("folder")).distinct()
        # A fixed number of tasks: the names are few bytes and would be put into one.
        _on_rows(folders.repartition(folders.sparkSession.sparkContext.defaultParallelism, "folder"), drop_staging)


def _check_target(target: str, overwrite: bool) -> None:
    if not overwrite and _exists(target):
        raise FileExistsError(target)


def write_files(chunks: DataFrame, root: str, overwrite: bool = False, dealt: bool = False) -> None:
    """Write (path, chunk, text) as named files under ``root``.

    A file's chunks reach one task in order and are streamed, so no file is held in memory. A target that exists is an
    error unless overwritten; then, as after any other error, no file of this call is left half written or staged.
    ``dealt`` says that a file's chunks lie in one task already, so the text is not shuffled; a file found in two is an error.
    """
    job = uuid4().hex
    base = root.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, current, out = uuid4().hex, None, None
        for batch in batches:
            places = []
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path != current:
                    if out:
                        out.close()
                    current, target = path, f"{base}/{path}"
                    _check_target(target, overwrite)
                    staged = f"{_staging(target, job)}/{attempt}-{target.rsplit('/', 1)[1]}"
                    system, at = open_path(staged)
                    system.create_dir(_folder(at), recursive=True)
                    out = system.open_output_stream(at)
                    places.append((staged, target, target))
                out.write((text or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in places], pa.string()) for i in range(3)], ["staged", "target", "source"])
        if out:
            out.close()

    placed = chunks if dealt else chunks.repartition("path")
    sorted_chunks = placed.sortWithinPartitions("path", "chunk").select("path", "text")
    targets = chunks.select(F.concat(F.lit(f"{base}/"), "path").alias("target"))
    with setting(chunks.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES):
        _place(sorted_chunks.mapInArrow(run, PLACES), targets, job, overwrite)


def copy_files(manifest: DataFrame, overwrite: bool = False, move: bool = False) -> None:
    """Copy or move the (src, dst) rows of a manifest; an existing or repeated target fails unless overwritten.

    Moved sources are deleted once all targets are in place. A source that is its own target stays as it is.
    """
    job = uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        attempt = uuid4().hex
        for batch in batches:
            places = []
            for src, dst in zip(batch["src"], batch["dst"]):
                source, at = open_path(src)
                if source.get_file_info(at).type != fs.FileType.File:
                    raise FileNotFoundError(src)
                _check_target(dst, overwrite)
                staged = f"{_staging(dst, job)}/{attempt}-{dst.rsplit('/', 1)[1]}"
                target, to = open_path(staged)
                target.create_dir(_folder(to), recursive=True)
                fs.copy_files(at, to, source_filesystem=source, destination_filesystem=target)
                places.append((staged, dst, src))
            yield pd.DataFrame(places, columns=["staged", "target", "source"])

    _place(manifest.mapInPandas(run, PLACES), manifest.select(F.col("dst").alias("target")), job, overwrite, move)
