import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from boxweave.sources import annotations as an
from boxweave.sources import files, labels, reports, sinks
from boxweave.sources.json_arrays import elements


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def scan(spark, root):
    return labels.with_file_names(labels.scan_files(spark, f"{root}/*/labels/*.txt")).drop("path")


def test_both_parsers(spark, tmp_path):
    text = "0 0.5 0.5 0.1 0.1\n\n 1 0.5 0.5 0.1\n2 0.5 0.5 0.1 0.1 9\nx 0.5 0.5 0.1 0.1\r\n16 0.5\t0.5 0.1 0.1\n-1 0 0 0 0"
    write(f"{tmp_path}/s/labels/a.b.txt", text)
    write(f"{tmp_path}/s/labels/empty.txt", "")
    lines = labels.to_lines(scan(spark, tmp_path))
    strict = labels.parse_labels(lines, ["source", "stem"]).orderBy("file_line").collect()
    assert [(r["file_line"], r["class_id"], r["bad"]) for r in strict] == [(1, 0, False), (5, None, True), (6, 16, False), (7, -1, False)]
    assert {(r["source"], r["stem"]) for r in strict} == {("s", "a.b")}
    loose = labels.parse_export(lines, ["source", "stem"]).orderBy("file_line").collect()
    assert [r["file_line"] for r in loose] == [1, 3, 4, 5, 6, 7]
    assert [r["bad"] for r in loose] == [False, True, False, True, False, False]


def test_listing_sees_zero_length_files_and_any_case(spark, tmp_path):
    for name in ("a.JPG", "b.png", "c.txt", ".DS_Store", "d.webp"):
        write(f"{tmp_path}/images/{name}", "")
    found = files.only_images(files.list_files(spark, [f"{tmp_path}/images"]))
    assert [r["filename"] for r in found.orderBy("filename").collect()] == ["a.JPG", "b.png", "d.webp"]
    with pytest.raises(Exception):
        files.list_files(spark, [f"{tmp_path}/nowhere"]).count()


def test_merged_key(spark):
    df = spark.createDataFrame([("src__a__b",)], "k string")
    assert tuple(labels.split_merged_key(df, "k").select("source", "stem").first()) == ("src", "a__b")
    with pytest.raises(Exception, match="without source prefix"):
        labels.split_merged_key(spark.createDataFrame([("plain",)], "k string"), "k").collect()


def test_crowd_keeps_empty_images_and_last_line(spark, tmp_path):
    box = lambda tag, x, extra=None: {"tag": tag, "vbox": [x, 1, 2, 3], **({"extra": extra} if extra is not None else {})}
    rows = [
        {"ID": "a", "gtboxes": [box("person", 1)]},
        {"ID": "b", "gtboxes": [box("mask", 1), box("person", 2, {"ignore": 1})]},
        {"ID": "c", "gtboxes": [box("person", 3, {"ignore": 0}), box("person", 4, {})]},
        {"ID": "a", "gtboxes": [box("person", 9)]},
    ]
    write(f"{tmp_path}/x.odgt", "\n".join(json.dumps(r) for r in rows) + "\n")
    got = an.crowd_boxes(an.crowd_images(spark, f"{tmp_path}/x.odgt")).orderBy("image", "line_no").collect()
    assert [(r["image"], r["line_no"], r["x"]) for r in got] == [("a", 1, 9.0), ("b", None, None), ("c", 1, 3.0), ("c", 2, 4.0)]


def test_headed_file_skips_first_line_always(spark, tmp_path):
    write(f"{tmp_path}/Dog/i.jpg.txt", "Dog 1 2 3 4\nDog 5 6 7 8 0 0\n\nBoat 1 1 1 1\n")
    got = an.headed_boxes(spark, f"{tmp_path}/*/*.txt").orderBy("line_no").collect()
    assert [(r["image"], r["folder"], r["native_name"], r["x"]) for r in got] == [("i.jpg", "Dog", "Dog", 5), ("i.jpg", "Dog", "Boat", 1)]


def test_coco_unknown_category_and_image(spark, tmp_path):
    doc = {
        "images": [{"id": 1, "file_name": "a.jpg", "width": 10, "height": 20}],
        "categories": [{"id": 5, "name": "Car"}],
        "annotations": [{"image_id": 1, "category_id": 5, "bbox": [1, 2, 3, 4]}, {"image_id": 1, "category_id": 6, "bbox": [1, 2, 3, 4]}],
    }
    write(f"{tmp_path}/vehicle/labels.json", json.dumps(doc))
    got = an.resolve_coco(*an.coco_tables(spark, f"{tmp_path}/*/labels.json")).orderBy("line_no").collect()
    assert [(r["folder"], r["native_name"], r["file_name"]) for r in got] == [("vehicle", "Car", "a.jpg"), ("vehicle", None, "a.jpg")]
    doc["annotations"][0]["image_id"] = 7
    write(f"{tmp_path}/bad/labels.json", json.dumps(doc))
    with pytest.raises(Exception, match="unknown image"):
        an.resolve_coco(*an.coco_tables(spark, f"{tmp_path}/bad/labels.json")).collect()


def test_selection_report_errors(spark, tmp_path):
    write(f"{tmp_path}/ok.json", json.dumps({"classes": {"Person": {"selected": ["s/a/b"]}}, "seed": 42}))
    assert tuple(reports.read_selection(spark, f"{tmp_path}/ok.json").first()) == ("Person", "s", "a/b")
    write(f"{tmp_path}/entry.json", json.dumps({"classes": {"Person": {"selected": ["nosep"]}}}))
    with pytest.raises(Exception, match="without separator"):
        reports.read_selection(spark, f"{tmp_path}/entry.json").collect()
    write(f"{tmp_path}/none.json", json.dumps({"seed": 1}))
    with pytest.raises(Exception, match="no classes"):
        reports.read_selection(spark, f"{tmp_path}/none.json").collect()
    write(f"{tmp_path}/broken.json", "{not json")
    with pytest.raises(Exception):
        reports.read_selection(spark, f"{tmp_path}/broken.json").collect()


def test_exclusions_lose_their_extension(spark, tmp_path):
    write(f"{tmp_path}/a_excluded.json", json.dumps({"source": "s", "excluded_filenames": ["x.txt", "y.v2.txt"]}))
    write(f"{tmp_path}/b_excluded.json", json.dumps({"source": "s", "excluded_filenames": ["x.txt"]}))
    got = reports.read_exclusions(spark, f"{tmp_path}/*_excluded.json").orderBy("stem").collect()
    assert [tuple(r) for r in got] == [("s", "x"), ("s", "y.v2")]


def test_project_urls(spark):
    urls = [None, "", "TBD", "https://h.example/one", "https://h.example/ws/proj/", "https://h.example/ws/proj/3?x=/y", "/a/b"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    w, p = reports.project_of("url")
    assert [tuple(r) for r in df.select(w, p).collect()] == [(None, None)] * 4 + [("ws", "proj"), ("ws", "proj"), ("a", "b")]


def test_write_and_read_back(spark, tmp_path):
    rows = [("s", "a", i, i % 16, 0.1234565, 0.5, 0.25, 0.125) for i in range(1, 26)] + [("s", "b", 1, 3, 0.5, 0.5, 0.1, 0.1)]
    df = spark.createDataFrame(rows, "source string, stem string, line_no int, class_id int, cx double, cy double, w double, h double")
    files.write_files(sinks.label_chunks(df, chunk_lines=4), str(tmp_path))
    with open(f"{tmp_path}/s/labels/a.txt", encoding="utf-8") as fh:
        text = fh.read()
    assert text.endswith("\n") and [int(line.split()[0]) for line in text.splitlines()] == [i % 16 for i in range(1, 26)]
    back = labels.parse_labels(labels.to_lines(scan(spark, tmp_path)), ["source", "stem"])
    assert back.count() == 26 and back.where(F.abs(F.col("cx") - 0.1234565) < 1e-6).count() == 25
    with pytest.raises(Exception):
        files.write_files(sinks.label_chunks(df), str(tmp_path))
    files.write_files(sinks.label_chunks(df), str(tmp_path), overwrite=True)


def test_copy_move_and_snapshot(spark, tmp_path):
    write(f"{tmp_path}/in/a.jpg", "abc")
    plan = spark.createDataFrame([(f"{tmp_path}/in/a.jpg", f"{tmp_path}/out/s__a.jpg")], "src string, dst string")
    files.copy_files(plan)
    assert os.path.exists(f"{tmp_path}/out/s__a.jpg") and os.path.exists(f"{tmp_path}/in/a.jpg")
    with pytest.raises(Exception):
        files.copy_files(plan)
    files.copy_files(plan, overwrite=True, move=True)
    assert not os.path.exists(f"{tmp_path}/in/a.jpg")
    sinks.snapshot(spark.range(3), str(tmp_path), "one")
    with pytest.raises(Exception):
        sinks.snapshot(spark.range(3), str(tmp_path), "one")


def test_training_manifest(spark):
    full = spark.createDataFrame([("train", 3, 3), ("val", 1, 1), ("test", 1, 0)], "split string, images long, labels long")
    row = sinks.training_manifest(full).first()
    assert row["nc"] == 16 and row["train"] == "train/images" and row["names"][15] == "Bicycle" and "path" not in row.asDict()
    with pytest.raises(Exception, match="empty splits: val"):
        sinks.training_manifest(full.withColumn("images", F.when(F.col("split") == "val", 0).otherwise(F.col("images")))).collect()


def test_splittable_scan_keeps_order(spark, tmp_path):
    for name, n in (("a", 400), ("b", 3), ("c", 90)):
        write(f"{tmp_path}/s/labels/{name}.txt", "".join(f"{i} 0.5 0.5 0.1 0.1\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        lines = labels.scan_lines(spark, f"{tmp_path}/s/labels/*.txt").orderBy("path", "file_line").collect()
        assert labels.scan_lines(spark, f"{tmp_path}/s/labels/*.txt").rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [int(r["value"].split()[0]) for r in lines] == [*range(400), *range(3), *range(90)]
    assert len({(r["path"], r["file_line"]) for r in lines}) == 493


def pieces(text, size):
    """A reader that never returns more than ``size`` bytes."""
    data = memoryview(text.encode())
    at = 0

    def read(n):
        nonlocal at
        part = bytes(data[at : at + min(n, size)])
        at += len(part)
        return part

    return read


def test_json_elements_in_small_pieces():
    doc = {
        "info": {"a": [1, {"b": "]}"}], "t": "é\"\\"}, "n": 12345, "other": [[1, 2], {"annotations": [9]}, "x,]"], "empty": [], "f": -1.5e3,
        "annotations": [{"id": 1, "bbox": [1.5, 2, 3, 4], "t": "é😀]"}, {}, 17, None, "s"], "images": [], "categories": [{"id": 2}],
    }
    want = [(k, n, v) for k in ("annotations", "categories") for n, v in enumerate(doc[k], 1)]
    for text in (json.dumps(doc), json.dumps(doc, ensure_ascii=False, indent=2), "﻿ \n" + json.dumps(doc) + " \n"):
        for size in (1, 2, 3, 7, 10_000):
            assert list(elements(pieces(text, size), {"annotations", "images", "categories"})) == want
    for bad in ("", "[]", "1", "{", '{"a": [1, 2', '{"a": [1 2]}', '{"a": 1} {"a": 1}', '{"a" 1}', "{nonsense}"):
        with pytest.raises(ValueError):
            list(elements(pieces(bad, 5), {"a"}))
    assert list(elements(pieces("{}", 1), {"a"})) == []


def test_json_elements_hold_little_of_a_large_document():
    import tracemalloc

    def read(n, left=[400_000], head=[b'{"annotations": [']):
        part = head.pop() if head else b""
        if left[0] > 0:
            take = min(left[0], max(1, n // 64))
            left[0] -= take
            part += b'{"image_id": 1, "category_id": 2, "bbox": [1.0, 2.0, 3.0, 4.0]},' * take
            if not left[0]:
                part = part[:-1] + b"]}"
        return part

    tracemalloc.start()
    count = sum(1 for _ in elements(read, {"annotations"}))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == 400_000 and peak < 12 << 20  # the document has 25 MB


def test_coco_is_parsed_once(spark, tmp_path):
    doc = {"images": [{"id": 1, "file_name": "a.jpg"}], "categories": [{"id": 5, "name": "Car"}], "annotations": [{"image_id": 1, "category_id": 5}]}
    write(f"{tmp_path}/v/labels.json", json.dumps(doc))
    found = an.resolve_coco(*an.coco_tables(spark, f"{tmp_path}/v"))
    os.remove(f"{tmp_path}/v/labels.json")  # nothing goes back to it
    assert [tuple(r) for r in found.select("file_name", "native_name", "x", "h", "width").collect()] == [("a.jpg", "Car", None, None, None)]
    write(f"{tmp_path}/v/labels.json", "[]")
    with pytest.raises(Exception, match="not a JSON object"):
        an.coco_tables(spark, f"{tmp_path}/v/*.json")


def test_hashes_of_empty_and_long_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "HASHED_BLOCK", 1000)
    write(f"{tmp_path}/d/empty.jpg", "")
    write(f"{tmp_path}/d/deep/long.jpg", "x" * 123_457)
    got = {os.path.basename(r["path"]): (r["sha256"], r["length"]) for r in files.content_hashes(spark, f"{tmp_path}/d").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {"empty.jpg": (sha(""), 0), "long.jpg": (sha("x" * 123_457), 123_457)}
    assert files.content_hashes(spark, f"file://{tmp_path}/d").count() == 2


def test_a_flat_folder_is_listed_piece_by_piece(spark, tmp_path, monkeypatch):
    import tracemalloc

    (tmp_path / "d" / "deep").mkdir(parents=True)
    for n in range(20_000):
        os.close(os.open(f"{tmp_path}/d/{n}.jpg", os.O_CREAT))
    (tmp_path / "d" / "deep" / "x.png").write_text("abc")
    tracemalloc.start()
    count = sum(1 for _ in files._listed(f"{tmp_path}/d", True))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == 20_001 and peak < 1 << 20
    monkeypatch.setattr(files, "LISTED_ROWS", 7)
    found = files.list_files(spark, [f"{tmp_path}/d/deep", f"file://{tmp_path}/d"], recursive=False)
    assert found.count() == 20_001 and found.where("length = 3 and path like '%deep/x.png'").count() == 1
    assert found.where("abs(unix_timestamp(mtime) - unix_timestamp()) > 600").count() == 0
