"""Writers when tasks fail half way and are repeated, and the store that rewrites only what a session touches."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from boxweave.sources import files, sinks


def tree(root):
    """Path below ``root`` -> text, staged and hidden files included."""
    return {os.path.relpath(p, root): open(p).read() for p in glob.glob(f"{root}/**/*", recursive=True, include_hidden=True) if os.path.isfile(p)}


def chunks(spark, names, bad=()):
    rows = [(n, c, None if n in bad and c == 2 else f"{n} {c}\n") for n in names for c in range(3)]
    return spark.createDataFrame(rows, "path string, chunk long, text string").repartition(5)


@pytest.fixture
def retries():
    """A local session has no task retries, so jobs are repeated by hand with the same arguments."""

    def twice(job):
        with pytest.raises(Exception, match="lost"):
            job()
        job()

    return twice


def test_write_repeated_after_a_failure(spark, tmp_path, retries, monkeypatch):
    root, names = str(tmp_path / "out"), [f"s/{i}.txt" for i in range(20)]
    wanted = {n: "".join(f"{n} {c}\n" for c in range(3)) for n in names}
    monkeypatch.setattr(files, "_check_target", failing_check(str(tmp_path / "m1"), files._check_target, "/9.txt"))
    retries(lambda: files.write_files(chunks(spark, names), root))
    assert tree(root) == wanted
    # An existing target is an error that changes nothing; overwriting replaces.
    with pytest.raises(Exception, match="FileExists"):
        files.write_files(chunks(spark, [*names, "s/new.txt"]), root)
    assert tree(root) == wanted
    files.write_files(chunks(spark, names[:3], bad=names[:1]), root, overwrite=True)
    assert tree(root) == wanted | {names[0]: f"{names[0]} 0\n{names[0]} 1\n"}


def failing_check(marker, check, end):
    """Fails the task that comes to the target ``end``, once, with other files of it staged."""

    def run(target, overwrite):
        if target.endswith(end) and not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("lost")
        return check(target, overwrite)

    return run


def test_a_repeated_move_step_ends_well(spark, tmp_path, monkeypatch):
    """Half of the files are in place already when the step that moves them is run again."""
    root = str(tmp_path / "out")
    os.makedirs(f"{root}/.staged-x")
    for n in range(6):
        where = f"{root}/{n}" if n % 2 else f"{root}/.staged-x/a-{n}"
        with open(where, "w") as out:
            out.write(str(n))
    staged = spark.createDataFrame([(f"{root}/.staged-x/a-{n}", f"{root}/{n}", f"{root}/{n}") for n in range(6)], files.PLACES)
    files._place(staged, staged.select("target"), "x", overwrite=False)
    assert tree(root) == {str(n): str(n) for n in range(6)}


@pytest.mark.parametrize("move", [False, True])
def test_copy_and_move_repeated_after_a_failure(spark, tmp_path, retries, monkeypatch, move):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for n in range(12):
        (source / f"{n}.jpg").write_text(str(n))
    plan = spark.createDataFrame([(f"{source}/{n}.jpg", f"{target}/s__{n}.jpg") for n in range(12)], "src string, dst string").repartition(3)
    monkeypatch.setattr(files, "_check_target", failing_check(str(tmp_path / "m2"), files._check_target, "__7.jpg"))
    retries(lambda: files.copy_files(plan, move=move))
    assert tree(str(target)) == {f"s__{n}.jpg": str(n) for n in range(12)}
    assert len(tree(str(source))) == (0 if move else 12)
    twice = spark.createDataFrame([(f"{target}/s__1.jpg", f"{target}/x"), (f"{target}/s__2.jpg", f"{target}/x")], "src string, dst string")
    with pytest.raises(FileExistsError, match="2 rows"):
        files.copy_files(twice, move=move)
    same = spark.createDataFrame([(f"{target}/s__1.jpg", f"{target}/s__1.jpg")], "src string, dst string")
    files.copy_files(same, overwrite=True, move=move)
    assert len(tree(str(target))) == 12


def test_nothing_to_write(spark, tmp_path):
    files.write_files(chunks(spark, []), str(tmp_path / "out"))
    files.copy_files(spark.createDataFrame([], "src string, dst string"))
    assert tree(str(tmp_path / "out")) == {}


def test_store_rewrites_only_touched_buckets(spark, tmp_path):
    path, keys = str(tmp_path / "store"), ["source", "stem"]
    rows = spark.range(600).select(F.lit("s").alias("source"), (F.col("id") % 200).cast("string").alias("stem"), F.col("id").alias("line"))
    sinks.begin_store(rows, path, keys, 16)
    before = set(glob.glob(f"{path}/bucket=*/*.parquet"))
    session = spark.createDataFrame([("s", "7", 1000), ("s", "7", 1001), ("t", "new", 5)], "source string, stem string, line long")
    for _ in range(2):  # the second time changes no rows
        sinks.upsert_store(session, path, keys, 16)
        got = sorted(tuple(r) for r in sinks.read_store(spark, path).select("source", "stem", "line").collect())
        kept = [("s", str(i % 200), i) for i in range(600) if i % 200 != 7]
        assert got == sorted([*kept, ("s", "7", 1000), ("s", "7", 1001), ("t", "new", 5)])
    after = set(glob.glob(f"{path}/bucket=*/*.parquet"))
    changed = {os.path.dirname(p) for p in before ^ after}
    assert 1 <= len(changed) <= 2 and len(before & after) >= 14
    sinks.upsert_store(session.where("false"), path, keys, 16)
    assert set(glob.glob(f"{path}/bucket=*/*.parquet")) == after


def test_many_files_are_derived_once_and_listed_by_folder(spark, tmp_path):
    """Chunks are derived once, also for the clean-up; a pattern of many files is read as its folders."""
    from boxweave.sources import labels

    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.createDataFrame([(f"s{i % 2}/labels/f{i}.txt", 0, f"{i} 0.5 0.5 0.1 0.1\n") for i in range(40)], "path string, chunk int, text string")
    files.write_files(rows.mapInPandas(run, rows.schema), str(tmp_path))
    assert seen.value == 40
    (tmp_path / "s0" / "labels" / "notes.md").write_text("no labels\n")
    (tmp_path / "stray.txt").write_text("no folder\n")
    folders, names = files.in_folders(spark, f"{tmp_path}/*/labels/*.txt")
    assert len(folders) == 2 and names == {"pathGlobFilter": "*.txt"}
    assert labels.scan_files(spark, f"{tmp_path}/*/labels/*.txt").count() == 40
    assert files.in_folders(spark, f"{tmp_path}/*/labels") == ([f"{tmp_path}/*/labels"], {})


def test_many_documents_share_tasks(spark, tmp_path):
    from boxweave.sources import annotations

    for i in range(300):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "labels.json").write_text('{"images": [{"id": 1, "file_name": "a.jpg", "width": 4, "height": 3}]}')
    _, _, images = annotations.coco_tables(spark, f"{tmp_path}/*/labels.json")
    assert images.count() == 300 and len(images.inputFiles()) <= 16 * spark.sparkContext.defaultParallelism < 300


def test_chunks_that_lie_together_are_written_without_a_shuffle(spark, tmp_path):
    from boxweave.plans import queries_sources, views

    rows = views.file_lines(spark, "/root/testdata/sf0.001")
    path = F.concat("source", F.lit("/"), "stem", F.lit(".txt"))
    lying, dealt = (sinks.text_chunks(rows, path, F.col("value"), 100, by) for by in (queries_sources.BY_FILE, ()))
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges(lying) == 1 and exchanges(dealt) == 2
    files.write_files(lying, str(tmp_path / "a"), dealt=True)
    files.write_files(dealt, str(tmp_path / "b"))
    written = tree(str(tmp_path / "a"))
    assert len(written) > 5 and written == tree(str(tmp_path / "b"))


def test_a_file_found_in_two_tasks_is_an_error(spark, tmp_path):
    with pytest.raises(FileExistsError, match="rows for"):
        files.write_files(chunks(spark, ["s/0.txt"]).repartition(3, "chunk"), str(tmp_path / "out"), dealt=True)
    assert tree(str(tmp_path / "out")) == {}


def test_documents_of_many_folders_are_named_by_tasks(spark, tmp_path, monkeypatch):
    """The driver looks up none of them; folders without a document, and files beside the folders, are passed over."""
    from boxweave.sources import annotations

    for i in range(30):
        (tmp_path / f"d{i}").mkdir()
        if i % 3:
            (tmp_path / f"d{i}" / "labels.json").write_text('{"images": [{"id": "7", "file_name": "a.jpg", "width": 4.0, "height": 3}]}')
    (tmp_path / "labels.json").write_text("no document")
    named = []
    monkeypatch.setattr(annotations, "existing", lambda spark, paths: named.extend(paths) or [])
    _, _, images = annotations.coco_tables(spark, f"{tmp_path}/*/labels.json")
    assert [tuple(r) for r in images.orderBy("folder").collect()] == [(f, 7, "a.jpg", 4, 3) for f in sorted(f"d{i}" for i in range(30) if i % 3)]
    assert not named
    for wide in (f"{tmp_path}/*/gone.json", f"{tmp_path}/none/*/labels.json"):
        with pytest.warns(UserWarning, match="no annotations"):
            assert annotations.coco_tables(spark, wide)[2].count() == 0


@pytest.mark.parametrize("job, writer", [("v1_images", "written_headed"), ("v3_images", "written_corners"), ("v5_images", "written_export")])
def test_conversions_read_their_files_once(spark, monkeypatch, job, writer):
    """Outcomes and boxes come from one reading: nothing goes back to the files."""
    import shutil

    from boxweave.plans import queries_convert

    roots, write = [], getattr(queries_convert, writer)
    monkeypatch.setattr(queries_convert, writer, lambda spark, d: roots.append(write(spark, d)) or roots[0])
    done, images = getattr(queries_convert, job)(spark, "/root/testdata/sf0.001")
    for folder in glob.glob(roots[0].split("/*")[0].removeprefix("file:")):
        shutil.rmtree(folder)
    assert queries_convert.written_boxes(done, images).count() > 100


def test_pooled_documents_are_resolved_once(spark, monkeypatch):
    """Sizes, outcomes and boxes are taken from one stored table, not from the joins behind it."""
    from boxweave.plans.catalog import QUERIES

    rows = QUERIES["v4_pooled_convert"](spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "category_id" not in plan and "raise_error" not in plan.lower() and rows.count() > 100
