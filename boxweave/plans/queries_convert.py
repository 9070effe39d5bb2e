"""Registered queries: class and source dimensions, mapping joins and conversions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from boxweave import config
from boxweave.functions import boxes as bx
from boxweave.operators import audit, convert, dims, mapping
from boxweave.plans import sql_parts as sp
from boxweave.plans.queries_audit import CLIPPED, IMAGES_SQL, SETTLED, images
from boxweave.plans.queries_sources import CROWD_PARTS, CROWD_SQL, DOC_SQL, export_lines, written_coco, written_corners, written_crowd, written_export, written_headed
from boxweave.plans.registry import register
from boxweave.plans.views import boxes, derived_boxes, raw, table, with_views
from boxweave.runtime import cut_lineage, small_side
from boxweave.sources import annotations as an, labels

# The first 16 brands stand for the canonical classes, the other brands have none.
BRAND_MAP = {f"Brand#{i + 1}": i for i in range(16)}
BRANDS = sp.values("native_name, class_id", list(BRAND_MAP.items()))

# Source configuration: key, is_project, audit_status, pinned_version
SOURCES = [
    ("s0", False, None, None),
    ("s1", False, "approved", None),
    ("s2", False, "benched", None),
    ("s3", True, "pending", 3),
    ("s4", True, "failed", 1),
    ("s0", True, "rejected", 2),
    ("s1", True, "pending", None),
    ("s2", True, "blocked", None),
]
SOURCES_SCHEMA = "key string, is_project boolean, audit_status string, pinned_version int"
SOURCES_SQL = """select * from (values ('s0', false, null, null), ('s1', false, 'approved', null), ('s2', false, 'benched', null),
  ('s3', true, 'pending', 3), ('s4', true, 'failed', 1), ('s0', true, 'rejected', 2), ('s1', true, 'pending', null),
  ('s2', true, 'blocked', null)) v(key, is_project, audit_status, pinned_version)"""
NAMED_SQL = "select *, concat(case when source in ('s3', 's4') then 'roboflow_' else '' end, source) as name from boxes"


def sources(spark):
    return spark.createDataFrame(SOURCES, SOURCES_SCHEMA)


def named_boxes(spark, d):
    """Boxes under processed source names: two of the five sources are projects."""
    prefix = F.when(F.col("source").isin("s3", "s4"), config.PROJECT_PREFIX).otherwise("")
    return boxes(spark, d).withColumn("source", F.concat(prefix, "source"))


@register(
    "c1_class_ids_by_name",
    with_views(
        """select c.class_id, c.class_name, count(*) as instances from boxes b join classes c on c.class_id = b.class_id group by 1, 2""",
        "boxes",
        classes=sp.CLASSES,
    ),
)
def c1(spark, d):
    rows = boxes(spark, d)
    dims.checked_class_list(dims.class_dimension(spark), spark)
    named = rows.select(dims.class_label().alias("class_name"))
    counts = named.groupBy("class_name").agg(F.count(F.lit(1)).alias("instances"))
    return dims.with_class_id(counts).select("class_id", "class_name", "instances")


@register(
    "c2_active_boxes",
    with_views(
        """select name as source, count(*) as boxes from named where name not in (
  select concat(case when is_project then 'roboflow_' else '' end, key) from sources
  where audit_status in ('failed', 'benched', 'blocked')) group by 1""",
        "boxes",
        named=NAMED_SQL,
        sources=SOURCES_SQL,
    ),
)
def c2(spark, d):
    active = dims.drop_inactive(named_boxes(spark, d), sources(spark))
    return active.groupBy("source").agg(F.count(F.lit(1)).alias("boxes"))


@register(
    "c3_eligible_projects",
    with_views(
        """select s.key, s.eligible, s.skip_reason, coalesce(b.boxes, 0) as boxes from (
  select key, coalesce(audit_status = 'pending' and pinned_version is not null, false) as eligible,
    case when coalesce(audit_status = 'pending' and pinned_version is not null, false) then null
      when pinned_version is null then concat(coalesce(audit_status, 'None'), ' — no pinned_version') else audit_status end as skip_reason
  from sources where is_project) s
left join (select source, count(*) as boxes from boxes group by source) b on b.source = s.key""",
        "boxes",
        sources=SOURCES_SQL,
    ),
)
def c3(spark, d):
    projects = dims.eligibility(sources(spark).where("is_project")).select("key", "eligible", "skip_reason")
    counts = boxes(spark, d).groupBy(F.col("source").alias("key")).agg(F.count(F.lit(1)).alias("boxes"))
    return projects.join(counts, "key", "left").na.fill(0, ["boxes"])


PULL = [
    (0, "person", 400, "wide", "Brand#1", None),
    (1, "vehicle", 300, "wide", None, ["Brand#2", "Brand#17", "Brand#18"]),
    (2, "motorcycle", 45, "wide", "Brand#3", None),
    (7, "doors", 300, "other", "Brand#8", None),
]
PULL_SCHEMA = "class_id int, class_key string, cap int, primary_source string, native_class string, native_classes array<string>"
PULL_SQL = sp.values(
    "class_id, class_key, cap, native_name",
    [(0, "person", 400, "Brand#1"), (1, "vehicle", 300, "Brand#2"), (1, "vehicle", 300, "Brand#17"),
     (1, "vehicle", 300, "Brand#18"), (2, "motorcycle", 45, "Brand#3")],
)


def pull_targets(spark):
    return F.broadcast(dims.pull_targets(spark.createDataFrame(PULL, PULL_SCHEMA), "wide"))


@register(
    "c5_pull_targets",
    with_views(
        """select t.class_key, t.native_name, count(*) as boxes from targets t join raw r on r.native_name = t.native_name group by 1, 2""",
        "raw",
        targets=PULL_SQL,
    ),
)
def c5(spark, d):
    return raw(spark, d).join(pull_targets(spark), "native_name").groupBy("class_key", "native_name").agg(
        F.count(F.lit(1)).alias("boxes")
    )


@register(
    "c6_pull_quotas",
    with_views(
        """select t.class_key, cast(ceil(t.cap * cast(1.35 as double)) as bigint) as quota,
  cast(ceil(ceil(t.cap * cast(1.35 as double)) / 3) as bigint) as per_split, count(distinct concat(r.source, '/', r.stem)) as images
from targets t join raw r on r.native_name = t.native_name group by t.class_key, t.cap""",
        "raw",
        targets=PULL_SQL,
    ),
)
def c6(spark, d):
    quota = dims.buffered_quota()
    found = raw(spark, d).join(pull_targets(spark), "native_name").select("class_key", "cap", "source", "stem").distinct()
    counts = found.groupBy("class_key", "cap").agg(F.count(F.lit(1)).alias("images"))
    return counts.select("class_key", quota.alias("quota"), dims.per_split_quota(quota).alias("per_split"), "images")


SPLIT_SQL = "case o_orderstatus when 'F' then 'train' when 'O' then 'validation' else 'test' end"


@register(
    "c7_seeded_pull",
    with_views(
        """select class_id, split, source, stem, rn from (
  select *, row_number() over (partition by class_id, split order by md5(concat('42|', source, '/', stem)), source, stem) as rn
  from (select distinct t.class_id, t.cap, s.split, r.source, r.stem from targets t join raw r on r.native_name = t.native_name
    join splits s on s.stem = r.stem) x) y where rn <= ceil(ceil(cap * cast(1.35 as double)) / 3)""",
        "raw",
        targets=PULL_SQL,
        splits=f"select concat('img', lpad(cast(o_orderkey as varchar), 9, '0')) as stem, {SPLIT_SQL} as split from orders",
    ),
)
def c7(spark, d):
    split = F.expr(SPLIT_SQL).alias("split")
    splits = table(spark, d, "orders").select(
        F.concat(F.lit("img"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("stem"), split
    )
    targets = pull_targets(spark)
    rows = raw(spark, d).join(targets, "native_name").join(splits, "stem")
    quota = dims.per_split_quota(dims.buffered_quota(mapping.literal_map({0: 400, 1: 300, 2: 45}, F.col("class_id"))))
    drawn = dims.seeded_pull(rows, quota)
    return drawn.select("class_id", "split", "source", "stem", "rn")


@register(
    "c8_real_detections",
    with_views(
        """select source, stem, count(*) as detections, cast(sum(class_id) as bigint) as class_sum
from (select b.*, l_returnflag = 'A' as is_depiction, case when l_linestatus = 'O' then l_quantity > 40 end as is_group_of
  from boxes_x b) x where not is_depiction and not is_group_of group by 1, 2""",
        boxes_x="""select *, concat('s', cast(l_orderkey % 5 as varchar)) as source, concat('img', lpad(cast(l_orderkey as varchar), 9, '0')) as stem,
  cast(l_partkey % 16 as int) as class_id from lineitem""",
    ),
)
def c8(spark, d):
    rows = derived_boxes(spark, d, "l_returnflag", "l_linestatus", "l_quantity").select(
        "source",
        "stem",
        F.struct(
            "class_id",
            (F.col("l_returnflag") == "A").alias("is_depiction"),
            F.when(F.col("l_linestatus") == "O", F.col("l_quantity") > 40).alias("is_group_of"),
        ).alias("d"),
    )
    nested = rows.groupBy("source", "stem").agg(F.collect_list("d").alias("detections"))
    real = dims.real_detections(nested)
    total = F.aggregate("detections", F.lit(0).cast("long"), lambda a, x: a + x["class_id"])
    return real.select("source", "stem", F.size("detections").cast("long").alias("detections"), total.alias("class_sum"))


@register(
    "c9_requested_sources",
    with_views("select source, count(*) as boxes from boxes where source in ('s1', 's4') group by source", "boxes"),
)
def c9(spark, d):
    rows = boxes(spark, d)
    wanted = spark.createDataFrame([("s1",), ("s4",)], "source string")
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("boxes"))
    return dims.restrict_to_requested(counts, wanted, counts, "source")


@register(
    "c9_skipped_projects",
    with_views(
        """select s.key, case when pinned_version is null then concat(coalesce(audit_status, 'None'), ' — no pinned_version') else audit_status end as skip_reason,
  count(b.stem) as boxes from sources s left join boxes b on b.source = s.key
where is_project and key in ('s0', 's1', 's3') and not coalesce(audit_status = 'pending' and pinned_version is not null, false) group by all""",
        "boxes",
        sources=SOURCES_SQL,
    ),
)
def c9_skipped(spark, d):
    """Known projects that were asked for but are not eligible, with the boxes they would have brought."""
    wanted = spark.createDataFrame([("s0",), ("s1",), ("s3",)], "key string")
    _, skipped = dims.eligible_requested(sources(spark).where("is_project"), wanted)
    counts = boxes(spark, d).groupBy(F.col("source").alias("key")).agg(F.count(F.lit(1)).alias("boxes"))
    return skipped.join(counts, "key", "left").na.fill(0, ["boxes"])


@register(
    "c10_deployment_labels",
    with_views(
        """select r.runtime_id, r.class_name, count(b.stem) as instances from (
  select 0 as runtime_id, 'Background' as class_name union all select class_id + 1, class_name from classes) r
left join boxes b on b.class_id + 1 = r.runtime_id group by 1, 2""",
        "boxes",
        classes=sp.CLASSES,
    ),
)
def c10(spark, d):
    counts = boxes(spark, d).groupBy((F.col("class_id") + 1).alias("runtime_id")).agg(F.count(F.lit(1)).alias("instances"))
    return dims.deployment_labels(spark).join(counts, "runtime_id", "left").na.fill(0, ["instances"])


# --- mapping -------------------------------------------------------------------------------------
ENTRIES = [
    ("s0", {"person": ["Brand#1", "Brand#2"], "vehicle": ["Brand#3"]}, None, None, None, ["person", "vehicle"]),
    ("s1", None, "Brand#4", None, "pole", None),
    ("s2", None, None, None, "stairs", None),
    ("s3", None, None, None, None, ["brand#5", "BRAND#6", "shelf"]),
    ("s4", {"doors": ["Brand#7"]}, "Brand#8", None, "doors", None),
]
ENTRY_SCHEMA = (
    "project string, filter_map map<string,array<string>>, filter_name string, filter_list array<string>, "
    "canonical_class string, canonical_classes array<string>"
)
MAPPED_SQL = """
select 's0' as project, 'Brand#1' as native_name, 'person' as class_key union all select 's0', 'Brand#2', 'person'
union all select 's0', 'Brand#3', 'vehicle' union all select 's1', 'Brand#4', 'pole'
union all select distinct 's2', p_brand, 'stairs' from part
union all select distinct 's3', p_brand, case lower(p_brand) when 'brand#5' then 'brand#5' else 'BRAND#6' end from part
  where lower(p_brand) in ('brand#5', 'brand#6')
union all select 's4', 'Brand#7', 'doors'"""


def natives(spark, d):
    """Every project lists all brands, in name order, as its native classes."""
    brands = table(spark, d, "part").select(F.col("p_brand").alias("native_name")).distinct()
    return brands.select(F.explode(F.array(*[F.lit(f"s{i}") for i in range(5)])).alias("project"), "native_name")


@register(
    "m1_resolved_mapping",
    with_views(
        """select m.project, m.native_name, m.class_key, count(r.stem) as boxes from mapped m
left join raw r on r.source = m.project and r.native_name = m.native_name group by 1, 2, 3""",
        "raw",
        mapped=MAPPED_SQL,
    ),
)
def m1(spark, d):
    entries = spark.createDataFrame(ENTRIES, ENTRY_SCHEMA)
    resolved = mapping.resolve_mapping(entries, natives(spark, d))
    counts = raw(spark, d).groupBy(F.col("source").alias("project"), "native_name").agg(F.count(F.lit(1)).alias("boxes"))
    return resolved.join(counts, ["project", "native_name"], "left").na.fill(0, ["boxes"])


@register(
    "m2_index_mapping",
    with_views(
        """select source as project, count(*) as boxes_total, count(class_id) as boxes_mapped,
  count(*) - count(class_id) as boxes_dropped_non_canonical
from (select b.source, m.class_id from boxes b left join index_map m on m.project = b.source and m.idx = b.class_id) x group by 1""",
        "boxes",
        index_map=sp.values(
            "project, idx, class_id",
            [(f"s{p}", i, c) for p in range(5) for i, c in ((0, 0), (1, 0), (2, 2), (3, 10), (4, 1))] ,
        ),
    ),
)
def m2(spark, d):
    listed = ["bike", "x1", "x2", "x3", "x4", "sign"]
    fixed = {"0": "Walker", "1": "Walker", "2": "Motorcycle", "3": "Tricycle", "4": "Van", "5": "Sign"}
    names = spark.createDataFrame(
        [(f"s{p}", listed, fixed) for p in range(5)], "project string, names array<string>, overrides map<string,string>"
    )
    entries = spark.createDataFrame(
        [(f"s{p}", {"person": ["Walker"], "vehicle": ["Van"], "motorcycle": ["Motorcycle"], "tricycle": ["Tricycle"]}, None, None, None, None) for p in range(5)],
        ENTRY_SCHEMA,
    )
    index = mapping.native_index(names)
    by_index = mapping.index_map(index, mapping.resolve_mapping(entries, index.select("project", "native_name")))
    rows = boxes(spark, d).select(F.col("source").alias("project"), F.col("class_id").alias("native_idx"))
    return mapping.drop_counts(mapping.apply_index_map(rows, by_index), "project")


@register(
    "m3_name_mapping",
    with_views(
        """select r.source, count(*) as boxes_total, count(m.class_id) as boxes_mapped,
  count(*) - count(m.class_id) as boxes_dropped_non_canonical from raw r left join brands m on m.native_name = r.native_name group by 1""",
        "raw",
        brands=BRANDS,
    ),
)
def m3(spark, d):
    return mapping.drop_counts(mapping.apply_name_map(raw(spark, d), BRAND_MAP), "source")


@register(
    "m4_native_set",
    with_views(
        """select source as folder, count(*) as annotations_total,
  sum(case when keep then 1 else 0 end)::bigint as annotations_kept, sum(case when keep then 0 else 1 end)::bigint as annotations_dropped_non_native
from (select source, (source = 's0' and native_name in ('Brand#1', 'Brand#2')) or (source = 's3' and native_name = 'Brand#9') as keep from raw) x
group by 1""",
        "raw",
    ),
)
def m4(spark, d):
    wanted = spark.createDataFrame([("s0", "Brand#1"), ("s0", "Brand#2"), ("s3", "Brand#9")], "folder string, native_name string")
    return mapping.native_set_filter(raw(spark, d).withColumnRenamed("source", "folder"), wanted)[1]


# Class folders by native name; two folders disagree about the size.
POOLED_SQL = """select native_name as folder, concat(stem, '.jpg') as file_name, line_no,
  case when native_name in ('Brand#3', 'Brand#4') then 1281 else 1280 end as width, 720 as height from raw"""


def pooled_rows(spark, d):
    odd = F.col("native_name").isin("Brand#3", "Brand#4")
    return raw(spark, d).select(
        F.col("native_name").alias("folder"),
        F.concat("stem", F.lit(".jpg")).alias("file_name"),
        "line_no",
        F.when(odd, 1281).otherwise(1280).alias("width"),
        F.lit(720).alias("height"),
    )


@register(
    "m5_pooled_files",
    with_views(
        """select file_name, arg_min(width, folder) as width, min(folder) as copy_from, count(distinct folder) as folders, count(*) as boxes,
  min(width) <> max(width) as size_mismatch from pooled group by file_name""",
        "raw",
        pooled=POOLED_SQL,
    ),
)
def m5(spark, d):
    p = mapping.pool_by_file(pooled_rows(spark, d))
    return p.select(
        "file_name", F.col("size.width").alias("width"), "copy_from", F.size("folders").cast("long").alias("folders"), "boxes", "size_mismatch"
    )


MODEL_NAMES = {"Brand#1": "person", "Brand#2": "car", "Brand#3": "bus", "Brand#4": "truck", "Brand#5": "motorcycle",
               "Brand#6": "bicycle", "Brand#7": "dog", "Brand#8": "cat", "Brand#9": "chair", "Brand#10": "dining table",
               "Brand#11": "kite", "Brand#12": "oven"}
WALK_SQL = sp.values("class_name, native_name", [(c, n) for c, ns in config.PROXY_CLASSES.items() for n in ns])


@register(
    "m6_crosswalk",
    with_views(
        """select w.class_name, w.native_name, count(*) as predictions from raw r join model m on m.brand = r.native_name
join walk w on w.native_name = m.native_name group by 1, 2""",
        "raw",
        model=sp.values("brand, native_name", list(MODEL_NAMES.items())),
        walk=WALK_SQL,
    ),
)
def m6(spark, d):
    named = raw(spark, d).withColumn("native_name", mapping.literal_map(MODEL_NAMES, F.col("native_name")))
    model = spark.createDataFrame([(n,) for n in MODEL_NAMES.values()], "native_name string")
    walk = mapping.checked_crosswalk(mapping.crosswalk(spark), model)
    return named.join(walk, "native_name").groupBy("class_name", "native_name").agg(F.count(F.lit(1)).alias("predictions"))


# --- conversions ---------------------------------------------------------------------------------
MAPPED_BOXES_SQL = """select r.source, r.stem, r.line_no, r.native_name, m.class_id, (x + pw / 2) / 1280 as cx, (y + ph / 2) / 720 as cy,
  pw / 1280 as w, ph / 720 as h from raw r left join brands m on m.native_name = r.native_name"""
CONVERT = {
    "brands": BRANDS,
    "mapped": MAPPED_BOXES_SQL,
    "clipped": CLIPPED.replace("from boxes", "from mapped"),
    "settled": SETTLED,
    "present": "select stem from (" + IMAGES_SQL.replace("select distinct", "select distinct o_orderpriority,") + ") i where o_orderpriority <> '1-URGENT'",
    "img": """select s.source, s.stem, count(line_no) as total, count(class_id) as mapped, count(line_no) - count(class_id) as non_canonical,
  sum(case when class_id is not null and status = 'clipped' then 1 else 0 end) as clipped,
  sum(case when class_id is not null and status = 'invalid' then 1 else 0 end) as invalid,
  sum(case when class_id is not null and status <> 'invalid' then 1 else 0 end) as kept,
  max(case when p.stem is not null then 1 else 0 end) = 1 as has_image
from settled s left join present p on p.stem = s.stem group by s.source, s.stem""",
}
TALLY_SQL = """select source, sum(total)::bigint as boxes_total, sum({kept})::bigint as boxes_kept,
  sum(non_canonical)::bigint as boxes_dropped_non_canonical, sum(invalid)::bigint as boxes_invalid_dropped, sum(clipped)::bigint as boxes_clipped,
  sum(case when outcome = 'converted' then 1 else 0 end)::bigint as images_converted,
  sum(case when outcome = 'empty' then 1 else 0 end)::bigint as images_dropped_empty,
  sum(case when outcome = 'missing' then 1 else 0 end)::bigint as images_missing from outc group by source"""
KEPT_CONVERTED = "case when outcome = 'converted' then kept else 0 end"
OUTCOMES = {
    "lowlight": "select *, case when kept = 0 then 'empty' else 'converted' end as outcome from img where has_image",
    "crowd": """select * replace (case when outcome = 'missing' then 0 else clipped end as clipped, case when outcome = 'missing' then 0 else invalid end as invalid)
from (select *, case when mapped = 0 then 'empty' when not has_image then 'missing' when kept = 0 then 'empty' else 'converted' end as outcome from img) o""",
    "validated": "select *, case when kept = 0 then 'empty' when not has_image then 'missing' else 'converted' end as outcome from img",
    "pooled": "select *, case when kept = 0 then 'empty' else 'converted' end as outcome from img",
}


def mapped_boxes(spark, d):
    rows = mapping.apply_name_map(raw(spark, d), BRAND_MAP)
    box = bx.from_pixels("x", "y", "pw", "ph", F.lit(1280), F.lit(720))
    return convert.settled(rows.select("source", "stem", "line_no", "native_name", "class_id", box.alias("box")))


def present_images(spark, d):
    return table(spark, d, "orders").where("o_orderpriority <> '1-URGENT'").select(
        F.concat(F.lit("s"), F.expr("o_orderkey % 5").cast("string")).alias("source"),
        F.concat(F.lit("img"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("stem"),
    )


# The files of the jobs below are those of the readers' own queries: one document per supplier, classes by name.
KINDS = {f"kind{i}": i for i in range(16)}
KINDS_SQL = sp.values("native_name, class_id", list(KINDS.items()))
SUPPLIED_SQL = "select concat('sup', lpad(cast(s_suppkey as varchar), 9, '0')) as stem from supplier where s_suppkey % 10 <> 3"
HEADED_SQL = """select d.source, d.stem, d.line_no, m.class_id, (x + pw / 2) / 640 as cx, (y + ph / 2) / 480 as cy, pw / 640 as w, ph / 480 as h
from docs d left join kinds m on m.native_name = d.native_name"""
CROWDED_SQL = """select concat('part', cast(part as varchar)) as source, i.stem, n.line_no, case when n.line_no is not null then 0 end as class_id,
  (x + pw / 2) / 1280 as cx, (y + ph / 2) / 720 as cy, pw / 1280 as w, ph / 720 as h
from (select distinct stem, part from records) i left join (select * replace (cast(row_number() over (partition by stem, part order by line_no) as int) as line_no) from records
  where not is_mask and coalesce(ignore, 0) <> 1) n using (stem, part)"""
CORNER_SQL = """select 'corners' as source, d.stem, d.line_no, m.class_id, (x / 1280 + (x + pw) / 1280) / 2 as cx, (y / 720 + (y + ph) / 720) / 2 as cy,
  (x + pw) / 1280 - x / 1280 as w, (y + ph) / 720 - y / 720 as h from docs d left join kinds m on m.native_name = d.native_name"""
EXPORT_SQL = """select source, stem, line_no, case when class_id between 0 and 11 then class_id end as class_id, cast(cx as double) as cx,
  cast(cy as double) as cy, cast(w as double) as w, cast(h as double) as h from file_lines where kind in ('five', 'six')"""
POOLED_NOTES_SQL = """select 'pooled' as source, concat('img', cast(y as varchar)) as stem, line_no, cast(kind_no as int) as class_id,
  (x + pw / 2) / (640 + y) as cx, (y + ph / 2) / 480 as cy, pw / (640 + y) as w, ph / 480 as h from docs where kind_no < 12"""


def _tally(outcome: str, mapped: str = MAPPED_BOXES_SQL, present: str = CONVERT["present"], kept: str = KEPT_CONVERTED, views=("raw",), **inputs: str) -> str:
    parts = {**inputs, **CONVERT, "mapped": mapped, "present": present}
    return with_views(TALLY_SQL.format(kept=kept), *views, **parts, outc=OUTCOMES[outcome])


def _written(outcome: str, mapped: str, present: str = CONVERT["present"], views=("raw",), **inputs: str) -> str:
    """The label rows of the images a job converts."""
    parts = {**inputs, **CONVERT, "mapped": mapped, "present": present, "outc": OUTCOMES[outcome]}
    pick = lambda c: f"round(case when kind is null then {c} else k{c} end, 9) as {c}"
    body = f"""select s.source, s.stem, s.line_no, s.class_id, {", ".join(map(pick, ("cx", "cy", "w", "h")))} from settled s
join outc o on o.source = s.source and o.stem = s.stem where o.outcome = 'converted' and s.class_id is not null and s.status <> 'invalid'"""
    return with_views(body, *views, **parts)


def written_boxes(done, images_):
    rows = convert.converted_boxes(done, images_)
    return rows.select("source", "stem", F.col("line_no").cast("int").alias("line_no"), "class_id", *[F.round(c, 9).alias(c) for c in ("cx", "cy", "w", "h")])


def supplied_images(spark, d, *sources: str):
    """Images of the suppliers that sent any, under their own source or under the one given."""
    kept = table(spark, d, "supplier").where("s_suppkey % 10 <> 3")
    own = F.concat(F.lit("s"), F.expr("s_suppkey % 5").cast("string"))
    named = F.explode(F.array(*[F.lit(x) for x in sources])) if sources else own
    return kept.select(named.alias("source"), F.concat(F.lit("sup"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("stem"))


@register(
    "v1_lowlight_convert",
    "select *, images_converted + images_dropped_empty as images_total from ("
    + _tally("lowlight", HEADED_SQL, SUPPLIED_SQL, views=(), docs=DOC_SQL, kinds=KINDS_SQL)
    + ") t",
)
def v1(spark, d):
    """Headed text files to settled boxes, tallied per native folder."""
    per = convert.tallies(v1_images(spark, d)[1])
    return per.withColumn("images_total", F.col("images_converted") + F.col("images_dropped_empty"))


@register("v1_lowlight_boxes", _written("lowlight", HEADED_SQL, SUPPLIED_SQL, views=(), docs=DOC_SQL, kinds=KINDS_SQL))
def v1_boxes(spark, d):
    return written_boxes(*v1_images(spark, d))


def v1_images(spark, d):
    """Settled boxes of the job, and the outcome of each image."""
    rows = an.headed_boxes(spark, written_headed(spark, d))
    rows = mapping.apply_name_map(rows.withColumnsRenamed({"folder": "source", "image": "stem"}), KINDS)
    box = bx.from_pixels("x", "y", "w", "h", F.lit(640), F.lit(480))
    done = convert.stored(convert.settled(rows.select("source", "stem", "line_no", "class_id", box.alias("box"))))
    return done, convert.lowlight_images(done, supplied_images(spark, d))


CROWD_INPUTS = {
    "crowd": CROWD_SQL.replace("select r.*", "select r.*, o.late").replace("from raw r", """from raw r
join (select concat('img', lpad(cast(o_orderkey as varchar), 9, '0')) as stem, o_orderpriority = '2-HIGH' as late from orders) o on o.stem = r.stem"""),
    "records": "select *, 1 as part from crowd union all select *, 2 from crowd where late and line_no = 1",
}


@register("v2_crowd_convert", _tally("crowd", CROWDED_SQL, **CROWD_INPUTS))
def v2(spark, d):
    """Crowd records to boxes of the person class, one tally per set of records."""
    return reduce(DataFrame.unionByName, [convert.tallies(images_) for _, images_ in v2_images(spark, d)])


@register("v2_crowd_boxes", _written("crowd", CROWDED_SQL, **CROWD_INPUTS))
def v2_boxes(spark, d):
    return reduce(DataFrame.unionByName, [written_boxes(*both) for both in v2_images(spark, d)])


def v2_images(spark, d):
    """Settled boxes and outcomes of each set of records."""
    root, found = written_crowd(spark, d), []
    for i, part in enumerate(CROWD_PARTS, start=1):
        rows = an.crowd_boxes(an.crowd_images(spark, f"{root}/{part}"))
        class_id = F.when(F.col("line_no").isNotNull(), F.lit(0)).alias("class_id")
        box = bx.from_pixels("x", "y", "w", "h", F.lit(1280), F.lit(720))
        source = F.lit(f"part{i}").alias("source")
        done = convert.stored(convert.settled(rows.select(source, F.col("image").alias("stem"), "line_no", class_id, box.alias("box"))))
        found.append((done, convert.crowd_images(done, present_images(spark, d).select(source, "stem"))))
    return found


@register("v3_corner_convert", _tally("validated", CORNER_SQL, SUPPLIED_SQL, views=(), docs=DOC_SQL, kinds=KINDS_SQL))
def v3(spark, d):
    """Corner pairs, divided by the size their document gives, to settled boxes."""
    return convert.tallies(v3_images(spark, d)[1])


@register("v3_corner_boxes", _written("validated", CORNER_SQL, SUPPLIED_SQL, views=(), docs=DOC_SQL, kinds=KINDS_SQL))
def v3_boxes(spark, d):
    return written_boxes(*v3_images(spark, d))


def v3_images(spark, d):
    rows = mapping.apply_name_map(an.corner_boxes(spark, written_corners(spark, d)), KINDS)
    box = bx.from_corners(*[F.col(c) / F.col(side) for c, side in (("x1", "width"), ("y1", "height"), ("x2", "width"), ("y2", "height"))])
    done = convert.settled(rows.select(F.lit("corners").alias("source"), bx.stem("image").alias("stem"), "line_no", "class_id", box.alias("box")))
    done = convert.stored(done)
    return done, convert.validated_images(done, supplied_images(spark, d, "corners"))


@register(
    "v4_pooled_convert",
    with_views(
        """select s.source, s.stem, s.line_no, s.class_id, round(case when kind is null then cx else kcx end, 9) as cx,
  round(case when kind is null then cy else kcy end, 9) as cy, round(case when kind is null then w else kw end, 9) as w,
  round(case when kind is null then h else kh end, 9) as h from settled s where status <> 'invalid'""",
        docs=DOC_SQL,
        mapped=POOLED_NOTES_SQL,
        clipped=CONVERT["clipped"],
        settled=SETTLED,
    ),
)
def v4(spark, d):
    """COCO documents: annotations of wanted names are pooled by file over the folders, then settled."""
    notes, categories, images_ = an.coco_tables(spark, written_coco(spark, d))
    wanted = categories.where(F.col("native_name").isin([f"kind{i}" for i in range(12)]))
    wanted_notes = cut_lineage(mapping.native_set_filter(an.resolve_coco(notes, categories, images_), wanted)[0], "notes")
    sizes = mapping.pool_by_file(wanted_notes).select("file_name", F.col("size.width").alias("pooled_width"), F.col("size.height").alias("pooled_height"))
    rows = mapping.apply_name_map(wanted_notes.join(small_side(sizes), "file_name"), KINDS)
    box = bx.from_pixels("x", "y", "w", "h", "pooled_width", "pooled_height")
    done = convert.settled(rows.select(F.lit("pooled").alias("source"), bx.stem("file_name").alias("stem"), "line_no", "class_id", box.alias("box")))
    done = convert.stored(done)
    written = convert.converted_boxes(done, convert.pooled_images(done))
    return written.select("source", "stem", "line_no", "class_id", *[F.round(c, 9).alias(c) for c in ("cx", "cy", "w", "h")])


@register("v5_export_convert", _tally("validated", EXPORT_SQL, SUPPLIED_SQL, "kept", ("file_lines",)))
def v5(spark, d):
    """Export files of three splits: native indexes to classes, boxes as they are."""
    return convert.tallies(v5_images(spark, d)[1], kept_of_missing=True)


@register("v5_export_boxes", _written("validated", EXPORT_SQL, SUPPLIED_SQL, ("file_lines",)))
def v5_boxes(spark, d):
    return written_boxes(*v5_images(spark, d))


def v5_images(spark, d):
    rows = labels.parse_export(export_lines(spark, written_export(spark, d)), ["source", "stem"]).where("not bad")
    names = [f"n{i}" for i in range(17)]
    listed = spark.createDataFrame([(f"s{p}", names, None) for p in range(5)], "project string, names array<string>, overrides map<string,string>")
    by_class = {config.class_key(n): [f"n{i}"] for i, n in enumerate(config.CLASS_NAMES[:12])}
    entries = spark.createDataFrame([(f"s{p}", by_class, None, None, None, None) for p in range(5)], ENTRY_SCHEMA)
    index = mapping.native_index(listed)
    by_index = mapping.index_map(index, mapping.resolve_mapping(entries, index.select("project", "native_name")))
    numbered = rows.select(F.col("source").alias("project"), "stem", F.col("file_line").alias("line_no"), F.col("class_id").alias("native_idx"), bx.box_struct("cx", "cy", "w", "h").alias("box"))
    mapped = mapping.apply_index_map(numbered, by_index)
    done = convert.stored(convert.settled(mapped.select(F.col("project").alias("source"), "stem", "line_no", "class_id", "box")))
    return done, convert.validated_images(done, supplied_images(spark, d))


@register(
    "v6_images_with_boxes",
    with_views(
        """select source, stem from images i where exists (
  select 1 from settled s where s.source = i.source and s.stem = i.stem and class_id is not null and status <> 'invalid')""",
        "raw",
        **{k: CONVERT[k] for k in ("brands", "mapped", "clipped", "settled")},
        images=IMAGES_SQL,
    ),
)
def v6(spark, d):
    return convert.drop_empty_images(images(spark, d), mapped_boxes(spark, d))


@register("v7_conversion_tallies", _tally("pooled"))
def v7(spark, d):
    return convert.tallies(convert.pooled_images(mapped_boxes(spark, d)))


@register(
    "v8_class_counts",
    with_views(
        """select c.class_id, lower(replace(c.class_name, ' ', '_')) as class_key, count(distinct m.stem) as images, count(m.stem) as instances
from classes c left join (select * from mapped where class_id < 12) m on m.class_id = c.class_id group by 1, 2""",
        "raw",
        brands=BRANDS,
        mapped=MAPPED_BOXES_SQL,
        classes=sp.CLASSES,
    ),
)
def v8(spark, d):
    twelve = {k: v for k, v in BRAND_MAP.items() if v < 12}
    return convert.class_counts(mapping.apply_name_map(raw(spark, d), twelve))


@register(
    "v9_summed_tallies",
    with_views(
        """select key, sum(value)::bigint as value from (
  select 'boxes' as key, count(*) as value from boxes group by source
  union all select 'positive', sum(case when w > 0 and h > 0 then 1 else 0 end) from boxes group by source) x group by key""",
        "boxes",
    ),
)
def v9(spark, d):
    per = boxes(spark, d).groupBy("source").agg(
        F.count(F.lit(1)).alias("boxes"), F.count_if((F.col("w") > 0) & (F.col("h") > 0)).alias("positive")
    )
    pairs = per.select(F.explode(F.create_map(F.lit("boxes"), "boxes", F.lit("positive"), "positive")).alias("key", "value"))
    return convert.sum_tallies(pairs)
