"""Registered queries: readers and writers on files that Spark writes from the driver tables."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from boxweave.operators import audit
from boxweave.plans import sql_parts as sp
from boxweave.plans.queries_audit import IMAGES_SQL, images
from boxweave.plans.registry import register
from boxweave.plans.views import boxes, file_lines, in_file, pool, raw, table, with_views
from boxweave.runtime import scratch_path
from boxweave.sources import annotations as an
from boxweave.sources import files, labels, reports, sinks

PARSED_SQL = """select source, stem, line_no as file_line, case when kind <> 'word' then class_id end as class_id,
  cast(cx as double) as cx, cast(cy as double) as cy, cast(w as double) as w, case when kind <> 'four' then cast(h as double) end as h,
  kind in ('word', 'four') as bad from file_lines"""


# The lines of a file lie together by its supplier.
BY_FILE = ("l_suppkey",)


def written_labels(spark, d, merged: bool = False) -> str:
    """One label file per supplier, in per-source folders or in one merged folder."""
    root = scratch_path(spark, "labels")
    path = F.concat("source", F.lit("/labels/"), "stem", F.lit(".txt"))
    if merged:
        path = F.concat(F.lit("merged/labels/"), F.concat_ws("__", "source", "stem"), F.lit(".txt"))
    files.write_files(sinks.text_chunks(file_lines(spark, d), path, F.col("value"), 100, BY_FILE), root, dealt=True)
    return root


@register("s1_label_scan", with_views(PARSED_SQL + " where kind in ('five', 'word')", "file_lines"))
def s1(spark, d):
    scan = labels.with_file_names(labels.scan_files(spark, written_labels(spark, d) + "/*/labels/*.txt"))
    rows = labels.parse_labels(labels.to_lines(scan.drop("path")), ["source", "stem"])
    return rows.drop("value")


@register(
    "s1_splittable_scan",
    with_views(
        """select source, stem, row_number() over (partition by source, stem order by line_no) as nth, class_id, cast(h as double) as h
from file_lines where kind = 'five'""",
        "file_lines",
    ),
)
def s1_lines(spark, d):
    """The line-by-line scan keeps the order of each file."""
    scan = labels.with_file_names(labels.scan_lines(spark, written_labels(spark, d) + "/*/labels/*.txt"))
    rows = labels.parse_labels(scan.drop("path"), ["source", "stem"]).where("not bad")
    nth = F.row_number().over(Window.partitionBy("source", "stem").orderBy("file_line"))
    return rows.select("source", "stem", nth.alias("nth"), "class_id", "h")


@register("s2_merged_scan", with_views(PARSED_SQL + " where kind in ('five', 'word')", "file_lines"))
def s2(spark, d):
    scan = labels.with_file_names(labels.scan_files(spark, written_labels(spark, d, merged=True) + "/merged/labels/*.txt"))
    rows = labels.parse_labels(labels.to_lines(scan.select("stem", "text")), ["stem"])
    return labels.split_merged_key(rows, "stem").drop("value")


@register(
    "s7_export_scan",
    with_views(
        """select source, stem, line_no as file_line, case when kind <> 'word' then class_id end as class_id,
  cast(cx as double) as cx, cast(cy as double) as cy, cast(w as double) as w, case when kind <> 'four' then cast(h as double) end as h,
  kind in ('word', 'four') as bad from file_lines where kind <> 'blank'""",
        "file_lines",
    ),
)
def s7(spark, d):
    return labels.parse_export(export_lines(spark, written_export(spark, d)), ["source", "stem"]).drop("value")


def written_export(spark, d) -> str:
    """The label files of an export, dealt over its three splits."""
    root = scratch_path(spark, "export")
    by_file = F.expr("element_at(array('train', 'valid', 'test'), cast(cast(right(stem, 1) as int) div 4 + 1 as int))")
    path = F.concat("source", F.lit("/"), by_file, F.lit("/labels/"), "stem", F.lit(".txt"))
    files.write_files(sinks.text_chunks(file_lines(spark, d), path, F.col("value"), 100, BY_FILE), root, dealt=True)
    return root


def export_lines(spark, root: str):
    scan = labels.scan_files(spark, [f"{root}/*/{s}/labels/*.txt" for s in ("train", "valid", "test")])
    named = scan.select(
        F.regexp_extract("path", r"([^/]+)/[^/]+/labels/[^/]+$", 1).alias("source"),
        F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("stem"),
        "text",
    )
    return labels.to_lines(named)


# Crowd records: every order, and for one priority a second record in another file; files are read each by itself.
CROWD_SQL = """select r.*, native_name = 'Brand#1' as is_mask, case when native_name in ('Brand#2', 'Brand#3') then 1
  when native_name = 'Brand#4' then 0 end as ignore from raw r"""


def _crowd(rows):
    tag = F.when(F.col("native_name") == "Brand#1", "mask").otherwise("person")
    ignore = F.when(F.col("native_name").isin("Brand#2", "Brand#3"), 1).when(F.col("native_name") == "Brand#4", 0)
    box = F.struct(
        tag.alias("tag"),
        F.array(*[F.col(c).cast("double") for c in ("x", "y", "pw", "ph")]).alias("vbox"),
        F.when(ignore.isNotNull(), F.struct(ignore.alias("ignore"))).alias("extra"),
    )
    per_image = rows.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("line_no", box.alias("g")))).alias("l"))
    return per_image.select(F.to_json(F.struct(F.col("stem").alias("ID"), F.transform("l", lambda x: x["g"]).alias("gtboxes"))).alias("value"))


@register(
    "s3_crowd_scan",
    with_views(
        """select i.stem as image, n.line_no, n.x, n.y, n.w, n.h from (select distinct stem, part from records) i left join (
  select stem, part, row_number() over (partition by stem, part order by line_no) as line_no, cast(x as double) as x, cast(y as double) as y,
    cast(pw as double) as w, cast(ph as double) as h
  from records where not is_mask and coalesce(ignore, 0) <> 1) n on n.stem = i.stem and n.part = i.part""",
        "raw",
        crowd=CROWD_SQL.replace("select r.*", "select r.*, o.late").replace("from raw r", """from raw r
join (select concat('img', lpad(cast(o_orderkey as varchar), 9, '0')) as stem, o_orderpriority = '2-HIGH' as late from orders) o on o.stem = r.stem"""),
        records="select *, 1 as part from crowd union all select *, 2 from crowd where late and line_no = 1",
    ),
)
def s3(spark, d):
    root = written_crowd(spark, d)
    out = an.crowd_boxes(an.crowd_images(spark, [f"{root}/{part}" for part in CROWD_PARTS]))
    return out.withColumn("line_no", F.col("line_no").cast("long"))


CROWD_PARTS = ("1-first", "2-later")


def written_crowd(spark, d) -> str:
    """Two sets of crowd records; the later one repeats some images with one box."""
    root = scratch_path(spark, "crowd")
    rows = raw(spark, d)
    _crowd(rows).write.text(f"{root}/1-first")
    late = table(spark, d, "orders").where("o_orderpriority = '2-HIGH'").select(
        F.concat(F.lit("img"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("stem")
    )
    _crowd(rows.where("line_no = 1").join(late, "stem", "left_semi")).write.text(f"{root}/2-later")
    return root


# One annotation document per supplier for the per-file formats.
DOC_SQL = """select concat('s', cast(l_suppkey % 5 as varchar)) as source, concat('sup', lpad(cast(l_suppkey as varchar), 9, '0')) as stem,
  cast(row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) as int) as line_no,
  concat('kind', cast(l_partkey % 20 as varchar)) as native_name, l_partkey % 20 as kind_no, l_partkey % 1000 as x, l_orderkey % 600 as y, cast(l_quantity as int) as pw, l_suppkey % 97 as ph
from lineitem"""


def documents(spark, d):
    # Numbered first, so that the shuffle carries the columns of the table and not the names made of them.
    return table(spark, d, "lineitem").withColumn("line_no", in_file()).select(
        *BY_FILE,
        F.concat(F.lit("s"), F.expr("l_suppkey % 5").cast("string")).alias("source"),
        F.concat(F.lit("sup"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("stem"),
        "line_no",
        F.concat(F.lit("kind"), F.expr("l_partkey % 20").cast("string")).alias("native_name"),
        F.expr("l_partkey % 20").alias("kind_no"),
        F.expr("l_partkey % 1000").alias("x"),
        F.expr("l_orderkey % 600").alias("y"),
        F.col("l_quantity").cast("int").alias("pw"),
        F.expr("l_suppkey % 97").alias("ph"),
    )


@register(
    "s4_headed_scan",
    with_views(
        "select stem as image, source as folder, line_no, native_name, cast(x as int) as x, cast(y as int) as y, pw as w, cast(ph as int) as h from docs",
        docs=DOC_SQL,
    ),
)
def s4(spark, d):
    return an.headed_boxes(spark, written_headed(spark, d)).drop("path").withColumn("line_no", F.col("line_no").cast("int"))


def written_headed(spark, d) -> str:
    root = scratch_path(spark, "headed")
    line = F.concat_ws(" ", "native_name", *[F.col(c).cast("string") for c in ("x", "y", "pw", "ph")], F.lit("0 0"))
    path = F.concat("source", F.lit("/"), "stem", F.lit(".txt"))
    body = sinks.text_chunks(documents(spark, d), path, line, by=BY_FILE)
    headed = F.when(F.col("chunk") == 0, F.concat(F.lit("% bbGt version=3\n"), "text")).otherwise(F.col("text"))
    files.write_files(body.withColumn("text", headed), root, dealt=True)
    return f"{root}/*/*.txt"


def _document(rows, path, value) -> str:
    """One document per row, written where the row lies."""
    root = scratch_path(rows.sparkSession, "json")
    docs = rows.select(path.alias("path"), F.lit(0).alias("chunk"), F.to_json(value).alias("text"))
    files.write_files(docs, root, dealt=True)
    return root


@register(
    "s5_corner_scan",
    with_views(
        """select concat(stem, '.jpg') as image, 1280 as width, 720 as height, line_no, native_name, cast(x as double) as x1, cast(y as double) as y1,
  cast(x + pw as double) as x2, cast(y + ph as double) as y2 from docs""",
        docs=DOC_SQL,
    ),
)
def s5(spark, d):
    return an.corner_boxes(spark, written_corners(spark, d)).withColumn("line_no", F.col("line_no").cast("int"))


def written_corners(spark, d) -> str:
    point = lambda a, b: F.array(F.expr(a).cast("double"), F.expr(b).cast("double"))
    o = F.struct(
        F.col("native_name").alias("classTitle"),
        F.struct(F.array(point("x", "y"), point("x + pw", "y + ph")).alias("exterior")).alias("points"),
    )
    per = documents(spark, d).groupBy(*BY_FILE, "stem").agg(F.sort_array(F.collect_list(F.struct("line_no", o.alias("o")))).alias("l"))
    size = F.struct(F.lit(1280).alias("width"), F.lit(720).alias("height")).alias("size")
    value = F.struct(size, F.transform("l", lambda x: x["o"]).alias("objects"))
    root = _document(per, F.concat(F.lit("ann/"), "stem", F.lit(".jpg.json")), value)
    return f"{root}/ann/*.json"


@register(
    "s6_coco_scan",
    with_views(
        """select stem as folder, line_no, concat('img', cast(y as varchar), '.jpg') as file_name, 640 + cast(y as int) as width,
  case when kind_no < 16 then native_name end as native_name, cast(x as double) as x, cast(y as double) as y, cast(pw as double) as w, cast(ph as double) as h
from docs""",
        docs=DOC_SQL,
    ),
)
def s6(spark, d):
    found = an.resolve_coco(*an.coco_tables(spark, written_coco(spark, d)))
    return found.select("folder", F.col("line_no").cast("int").alias("line_no"), "file_name", "width", "native_name", *"xywh")


def written_coco(spark, d) -> str:
    rows = documents(spark, d)
    images_ = F.collect_set(
        F.struct(F.col("y").alias("id"), F.concat(F.lit("img"), F.col("y").cast("string"), F.lit(".jpg")).alias("file_name"),
                 (F.col("y") + 640).alias("width"), F.lit(480).alias("height"))
    )
    kinds = F.collect_set(F.when(F.col("kind_no") < 16, F.struct(F.col("kind_no").alias("id"), F.col("native_name").alias("name"))))
    note = F.struct(
        F.col("y").alias("image_id"), F.col("kind_no").alias("category_id"),
        F.array(*[F.col(c).cast("double") for c in ("x", "y", "pw", "ph")]).alias("bbox"),
    )
    per = rows.groupBy(*BY_FILE, "stem").agg(
        images_.alias("images"), kinds.alias("categories"), F.sort_array(F.collect_list(F.struct("line_no", note.alias("a")))).alias("l")
    )
    value = F.struct("images", "categories", F.transform("l", lambda x: x["a"]).alias("annotations"))
    root = _document(per, F.concat("stem", F.lit("/labels.json")), value)
    return f"{root}/*/labels.json"


@register(
    "s9_image_listing",
    with_views(
        """select filename, length from (
  select concat(stem, case right(stem, 1) when '1' then '.JPG' when '2' then '.txt' when '3' then '.Jpeg' when '4' then '' else '.png' end) as filename,
    sum(length(value) + 1)::bigint as length from file_lines group by 1) f where lower(filename) similar to '.*\\.(jpg|jpeg|png|bmp|webp)'""",
        "file_lines",
    ),
)
def s9(spark, d):
    root = scratch_path(spark, "images")
    kind = F.right("stem", F.lit(1))
    ext = F.when(kind == "1", ".JPG").when(kind == "2", ".txt").when(kind == "3", ".Jpeg").when(kind == "4", "").otherwise(".png")
    path = F.concat("source", F.lit("/images/"), "stem", ext)
    files.write_files(sinks.text_chunks(file_lines(spark, d), path, F.col("value"), by=BY_FILE), root, dealt=True)
    found = files.list_files(spark, [f"{root}/s{i}/images" for i in range(5)])
    return files.only_images(found).select("filename", "length").orderBy("filename")


@register(
    "s10_stem_index",
    with_views(
        """select source, size_key as stem, max(concat(size_key, '.', body_key)) as filename from pool group by source, size_key""", "pool"
    ),
)
def s10(spark, d):
    rows = pool(spark, d).select("source", F.col("size_key").alias("stem"), F.concat_ws(".", "size_key", "body_key").alias("filename"))
    return files.stem_index(rows)


@register(
    "s11_complete_sources",
    """select distinct source from documents d where exists (
  select 1 from documents l join labels q on q.doc_id = l.doc_id where l.source = d.source)""",
)
def s11(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return files.complete_sources(docs, docs.join(table(spark, d, "labels"), "doc_id", "left_semi"))


@register(
    "s12_image_sizes",
    with_views(
        """select b.source, b.stem, b.line_no, cast(640 + o.o_custkey % 5 * 160 as int) as width, cast(480 + o.o_custkey % 3 * 120 as int) as height
from boxes b join orders o on b.stem = concat('img', lpad(cast(o.o_orderkey as varchar), 9, '0'))""",
        "boxes",
    ),
)
def s12(spark, d):
    sizes = table(spark, d, "orders").select(
        F.concat(F.lit("s"), F.expr("o_orderkey % 5").cast("string")).alias("source"),
        F.concat(F.lit("img"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("stem"),
        F.expr("cast(640 + o_custkey % 5 * 160 as int)").alias("width"),
        F.expr("cast(480 + o_custkey % 3 * 120 as int)").alias("height"),
    )
    return files.with_image_size(boxes(spark, d).select("source", "stem", "line_no"), sizes)


@register(
    "s14_exclusions",
    with_views(
        """select distinct b.source, b.stem from boxes b join orders o on b.stem = concat('img', lpad(cast(o.o_orderkey as varchar), 9, '0'))
where o.o_orderpriority = '3-MEDIUM'""",
        "boxes",
    ),
)
def s14(spark, d):
    """Several exclusion files per source, with repeats across them."""
    root = scratch_path(spark, "excluded")
    picked = table(spark, d, "orders").where("o_orderpriority = '3-MEDIUM'").select(
        F.concat(F.lit("img"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("stem"), "o_custkey"
    )
    rows = boxes(spark, d).join(picked, "stem")
    docs = rows.groupBy("source", "o_custkey").agg(F.collect_list(F.concat("stem", F.lit(".txt"))).alias("excluded_filenames"))
    docs.select("source", "excluded_filenames").write.json(root)
    return reports.read_exclusions(spark, root)


@register(
    "s15_project_of_url",
    """select page_id, case when len(parts) >= 2 then parts[1] end as workspace, case when len(parts) >= 2 then parts[2] end as project
from (select page_id, string_split(trim(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/'), '/') as parts from pages) p""",
)
def s15(spark, d):
    workspace, project = reports.project_of("url")
    return table(spark, d, "pages").select("page_id", workspace.alias("workspace"), project.alias("project"))


@register(
    "s16_content_hashes",
    with_views(
        """select concat(source, '/labels/', stem, '.txt') as name, sha256(text) as sha256, cast(length(text) as bigint) as length from (
  select source, stem, concat(string_agg(value, chr(10) order by line_no), chr(10)) as text from file_lines group by source, stem) t""",
        "file_lines",
    ),
)
def s16(spark, d):
    hashes = files.content_hashes(spark, written_labels(spark, d))
    return hashes.select(F.regexp_extract("path", r"([^/]+/labels/[^/]+)$", 1).alias("name"), "sha256", "length")


# --- sinks ---------------------------------------------------------------------------------------
@register(
    "w1_label_text",
    with_views(
        """select concat(source, '/labels/', stem, '.txt') as path,
  cast((line_no - 1) // 10000 as bigint) as chunk,
  concat(string_agg(printf('%d %.6f %.6f %.6f %.6f', class_id, cx, cy, w, h), chr(10) order by line_no), chr(10)) as text from boxes group by 1, 2""",
        "boxes",
    ),
)
def w1(spark, d):
    return sinks.label_chunks(boxes(spark, d)).select("path", "chunk", "text")


@register(
    "w2_report_round_trip",
    with_views("select source, count(*) as boxes, count(distinct class_id) as classes from boxes group by source", "boxes"),
)
def w2(spark, d):
    path = scratch_path(spark, "report")
    report = boxes(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("boxes"), F.count_distinct("class_id").alias("classes"))
    sinks.write_report(report, path)
    return spark.read.schema("source string, boxes long, classes long").json(path)


@register("w4_rebuilt_table", with_views("select source, stem, count(*) as boxes from boxes where w > h group by 1, 2", "boxes"))
def w4(spark, d):
    """Written twice with different rows: only the second run's rows remain."""
    path = scratch_path(spark, "rebuilt")
    per = boxes(spark, d).withColumn("wide", F.col("w") > F.col("h")).groupBy("source", "stem", "wide").agg(F.count(F.lit(1)).alias("boxes"))
    sinks.rebuild(per.drop("wide"), path, "source")
    sinks.rebuild(per.where("wide").drop("wide"), path, "source")
    return spark.read.schema("stem string, boxes long, source string").parquet(path)


@register(
    "w5_pool_manifest",
    with_views(
        """select source, concat(size_key, '.jpg') as filename, concat(source, '__', size_key, '.jpg') as dst from pool""", "pool"
    ),
)
def w5(spark, d):
    rows = pool(spark, d).select("source", F.concat("size_key", F.lit(".jpg")).alias("filename"))
    return sinks.pool_manifest(rows)


@register(
    "w5_collisions",
    with_views(
        """select dst, count(*) as files from (select concat(source, '__', size_key, '.jpg') as dst from pool) m group by dst having count(*) > 1""",
        "pool",
    ),
)
def w5_collisions(spark, d):
    rows = pool(spark, d).select("source", F.concat("size_key", F.lit(".jpg")).alias("filename"))
    return sinks.collisions(sinks.pool_manifest(rows))


@register(
    "w6_report_upsert",
    with_views(
        """select source, stem, case when max(case when w > h then 1 else 0 end) = 1 then 'new' else 'old' end as version from boxes group by 1, 2""",
        "boxes",
    ),
)
def w6(spark, d):
    keys = boxes(spark, d).groupBy("source", "stem").agg(F.max(F.col("w") > F.col("h")).alias("wide"))
    old = keys.select("source", "stem", F.lit("old").alias("version"))
    new = keys.where("wide").select("source", "stem", F.lit("new").alias("version"))
    return sinks.upsert(old, new, ["source", "stem"])


SPLIT_OF = "case o_orderstatus when 'F' then 'train' when 'O' then 'val' else 'test' end"


@register(
    "w7_split_counts",
    with_views(
        f"""select split, count(*) as images, count(l.stem) as labels from (
  select concat('img', lpad(cast(o_orderkey as varchar), 9, '0')) as stem, {SPLIT_OF} as split from orders) a
left join (select distinct stem from boxes) l on l.stem = a.stem group by split""",
        "boxes",
    ),
)
def w7(spark, d):
    assigned = table(spark, d, "orders").select(
        F.concat(F.lit("s"), F.expr("o_orderkey % 5").cast("string")).alias("source"),
        F.concat(F.lit("img"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("stem"),
        F.expr(SPLIT_OF).alias("split"),
    )
    counts = sinks.split_counts(assigned, boxes(spark, d))
    sinks.training_manifest(counts).collect()  # an empty split ends the job here
    return counts


@register("w8_review_snapshot", with_views("select source, stem, line_no, class_id from boxes", "boxes"))
def w8(spark, d):
    path = sinks.snapshot(boxes(spark, d).select("source", "stem", "line_no", "class_id"), scratch_path(spark, "backup"), "20260101_000000")
    return spark.read.parquet(path)


@register(
    "a9_flagged_by_source",
    with_views("select source, stem, line_no from flagged", "boxes", **{k: sp.AUDIT[k] for k in ("measured", "fences", "wide_fences", "flagged")}),
)
def a9(spark, d):
    path = scratch_path(spark, "flagged")
    sinks.write_flagged(audit.flag_boxes(boxes(spark, d)).select("source", "stem", "line_no", "class_name", "reasons"), path)
    return spark.read.schema("stem string, line_no int, source string").json(path)
