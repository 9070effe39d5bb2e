"""Registered queries: box functions and the box audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxweave.functions import boxes as bx
from boxweave.operators import audit
from boxweave.operators.audit import reason_key
from boxweave.plans import sql_parts as sp
from boxweave.plans.registry import register
from boxweave.plans.views import boxes, table, with_views

KEY = ["source", "stem", "line_no"]


def _keys_text():
    return F.concat_ws(",", F.transform("reasons", reason_key)).alias("reasons")


@register(
    "b1_pixels_to_box",
    with_views(
        """select source, stem, line_no, round((x + pw / 2) / 1280, 9) as ncx, round((y + ph / 2) / 720, 9) as ncy,
  round(pw / 1280, 9) as nw, round(ph / 720, 9) as nh
from (select *, cx * 1280 - w * 640 as x, cy * 720 - h * 360 as y, w * 1280 as pw, h * 720 as ph from boxes) p""",
        "boxes",
    ),
)
def b1(spark, d):
    px = boxes(spark, d).select(
        *KEY,
        (F.col("cx") * 1280 - F.col("w") * 640).alias("x"),
        (F.col("cy") * 720 - F.col("h") * 360).alias("y"),
        (F.col("w") * 1280).alias("pw"),
        (F.col("h") * 720).alias("ph"),
    )
    b = px.withColumn("b", bx.from_pixels("x", "y", "pw", "ph", F.lit(1280), F.lit(720)))
    return b.select(*KEY, *[F.round(f"b.{c}", 9).alias(n) for c, n in (("cx", "ncx"), ("cy", "ncy"), ("w", "nw"), ("h", "nh"))])


@register(
    "b2_corners_round_trip",
    with_views(
        """select source, stem, line_no, round(x1, 9) as x1, round(y1, 9) as y1, round(x2, 9) as x2, round(y2, 9) as y2,
  round((x2 + x1) / 2, 9) as bcx, round((y2 + y1) / 2, 9) as bcy, round(x1 - x2, 9) as swapped_w, round(y2 - y1, 9) as bh
from (select *, cx - w / 2 as x1, cy - h / 2 as y1, cx + w / 2 as x2, cy + h / 2 as y2 from boxes) p""",
        "boxes",
    ),
)
def b2(spark, d):
    c = boxes(spark, d).withColumn("c", bx.to_corners("cx", "cy", "w", "h"))
    c = c.withColumn("b", bx.from_corners("c.x2", "c.y1", "c.x1", "c.y2"))
    return c.select(
        *KEY,
        *[F.round(f"c.{k}", 9).alias(k) for k in ("x1", "y1", "x2", "y2")],
        F.round("b.cx", 9).alias("bcx"),
        F.round("b.cy", 9).alias("bcy"),
        F.round("b.w", 9).alias("swapped_w"),
        F.round("b.h", 9).alias("bh"),
    )


@register(
    "b3_invalid_kind",
    with_views(
        f"""select source, stem, line_no, {sp.INVALID_KIND.format(eps='0')} as strict_kind,
  {sp.INVALID_KIND.format(eps='cast(1e-4 as double)')} as audit_kind from boxes""",
        "boxes",
    ),
)
def b3(spark, d):
    return boxes(spark, d).select(
        *KEY,
        bx.invalid_kind("cx", "cy", "w", "h").alias("strict_kind"),
        bx.invalid_kind("cx", "cy", "w", "h", 1e-4).alias("audit_kind"),
    )


CLIPPED = """select *, (x1 + x2) / 2 as kcx, (y1 + y2) / 2 as kcy, x2 - x1 as kw, y2 - y1 as kh from (
  select *, least(greatest(cx - w / 2, 0), 1) as x1, least(greatest(cy - h / 2, 0), 1) as y1,
    least(greatest(cx + w / 2, 0), 1) as x2, least(greatest(cy + h / 2, 0), 1) as y2 from boxes) p"""


@register(
    "b4_clip",
    with_views(
        """select source, stem, line_no, round(kcx, 9) as kcx, round(kcy, 9) as kcy, round(kw, 9) as kw, round(kh, 9) as kh
from clipped""",
        "boxes",
        clipped=CLIPPED,
    ),
)
def b4(spark, d):
    b = boxes(spark, d).withColumn("k", bx.clip("cx", "cy", "w", "h"))
    return b.select(*KEY, *[F.round(f"k.{c}", 9).alias(f"k{c}") for c in ("cx", "cy", "w", "h")])


SETTLED = f"""select *, case when kind is null then 'ok' when w <= 0 or h <= 0 or kw <= 0 or kh <= 0 then 'invalid'
  else 'clipped' end as status from (select *, {sp.INVALID_KIND.format(eps='0')} as kind from clipped) q"""


@register(
    "b5_settle_status",
    with_views(
        """select source, stem, line_no, status,
  case when status <> 'invalid' then round(case when kind is null then w else kw end, 9) end as final_w,
  case when status <> 'invalid' then round(case when kind is null then h else kh end, 9) end as final_h
from settled""",
        "boxes",
        clipped=CLIPPED,
        settled=SETTLED,
    ),
)
def b5(spark, d):
    b = boxes(spark, d).withColumn("s", bx.settle(bx.box_struct("cx", "cy", "w", "h")))
    kept = F.col("s.status") != "invalid"
    return b.select(
        *KEY,
        F.col("s.status").alias("status"),
        F.when(kept, F.round("s.box.w", 9)).alias("final_w"),
        F.when(kept, F.round("s.box.h", 9)).alias("final_h"),
    )


@register(
    "b6_area_elongation",
    with_views(
        """select source, stem, line_no, round(area, 9) as area, elong = cast('inf' as double) as unbounded,
  case when elong < cast('inf' as double) then round(elong, 6) end as elong from measured""",
        "boxes",
        measured=sp.MEASURED,
    ),
)
def b6(spark, d):
    inf = F.col("elong") == float("inf")
    return audit.measured(boxes(spark, d)).select(
        *KEY, F.round("area", 9).alias("area"), inf.alias("unbounded"), F.when(~inf, F.round("elong", 6)).alias("elong")
    )


@register(
    "b7_centre_top_left",
    with_views(
        """select source, stem, line_no, round(cx - w / 2, 9) as x, round(cy - h / 2, 9) as y,
  round((cx - w / 2) + w / 2, 9) as back_cx, round((cy - h / 2) + h / 2, 9) as back_cy from boxes""",
        "boxes",
    ),
)
def b7(spark, d):
    b = boxes(spark, d).withColumn("t", bx.to_top_left())
    b = b.withColumn("r", bx.from_top_left("t.x", "t.y", "t.w", "t.h"))
    return b.select(
        *KEY,
        F.round("t.x", 9).alias("x"),
        F.round("t.y", 9).alias("y"),
        F.round("r.cx", 9).alias("back_cx"),
        F.round("r.cy", 9).alias("back_cy"),
    )


@register(
    "b8_corner_predictions",
    with_views(
        """select source, stem, pred_no, round(x, 9) as px, round(y, 9) as py, round((x + w) - x, 9) as pw,
  round((y + h) - y, 9) as ph from preds""",
        "preds",
    ),
)
def b8(spark, d):
    from boxweave.plans.views import preds

    p = preds(spark, d).withColumn("t", bx.corners_to_top_left("x", "y", F.col("x") + F.col("w"), F.col("y") + F.col("h")))
    return p.select(
        "source", "stem", "pred_no", *[F.round(f"t.{c}", 9).alias(f"p{c}") for c in ("x", "y", "w", "h")]
    )


@register(
    "b9_names",
    with_views(
        """select doc_id, split_part(filename, '__', 1) as merged_source,
  regexp_replace(concat('roboflow_', source), '^roboflow_', '') as bare_source,
  regexp_replace(concat(filename, '.v1.jpg'), '\\.[^.]*$', '') as stem from pool""",
        "pool",
    ),
)
def b9(spark, d):
    from boxweave.plans.views import pool

    return pool(spark, d).select(
        "doc_id",
        bx.merged_source("filename").alias("merged_source"),
        bx.strip_project_prefix(F.concat(F.lit("roboflow_"), "source")).alias("bare_source"),
        bx.stem(F.concat("filename", F.lit(".v1.jpg"))).alias("stem"),
    )


# --- audit ---------------------------------------------------------------------------------------
IMAGES_SQL = """select distinct concat('s', cast(o_orderkey % 5 as varchar)) as source,
  concat('img', lpad(cast(o_orderkey as varchar), 9, '0')) as stem from orders"""
PAIRED_SQL = """select coalesce(i.source, l.source) as source, coalesce(i.stem, l.stem) as stem,
  i.stem is not null as has_image, l.stem is not null as has_label
from images i full outer join (select distinct source, stem from boxes) l on i.source = l.source and i.stem = l.stem"""


def images(spark, d):
    """Images are the orders; labels exist where an order has lines."""
    return table(spark, d, "orders").select(
        F.concat(F.lit("s"), F.expr("o_orderkey % 5").cast("string")).alias("source"),
        F.concat(F.lit("img"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("stem"),
    )


@register(
    "a1_pairing_counts",
    with_views(
        """select source, sum(cast(has_image as bigint))::bigint as images_total, sum(cast(has_label as bigint))::bigint as labels_total,
  sum(case when has_image and not has_label then 1 else 0 end)::bigint as images_without_label,
  sum(case when has_label and not has_image then 1 else 0 end)::bigint as labels_without_image
from paired group by source""",
        "boxes",
        images=IMAGES_SQL,
        paired=PAIRED_SQL,
    ),
)
def a1(spark, d):
    return audit.pairing_stats(audit.pairing(images(spark, d), boxes(spark, d)))


@register(
    "a1_one_sided_sample",
    with_views(
        """select source, side, stem, rn from (
  select source, case when has_image then 'image' else 'label' end as side, stem,
    row_number() over (partition by source, has_image order by stem) as rn
  from paired where has_image <> has_label) r where rn <= 20""",
        "boxes",
        images=IMAGES_SQL,
        paired=PAIRED_SQL,
    ),
)
def a1_sample(spark, d):
    return audit.one_sided_sample(audit.pairing(images(spark, d), boxes(spark, d)))


LABEL_LINES_SQL = """select source, stem, line_no, case when h > 0 then concat(class_id, ' ', cx) else '  ' end as value from boxes"""


@register(
    "a2_empty_label_files",
    with_views(
        """select source, stem from images
where not exists (select 1 from lines l where l.source = images.source and l.stem = images.stem and trim(l.value) <> '')""",
        "boxes",
        images=IMAGES_SQL,
        lines=LABEL_LINES_SQL,
    ),
)
def a2(spark, d):
    text = F.when(F.col("h") > 0, F.concat(F.col("class_id").cast("string"), F.lit(" "), F.col("cx").cast("string")))
    lines = boxes(spark, d).select("source", "stem", "line_no", F.coalesce(text, F.lit("  ")).alias("value"))
    return audit.empty_label_files(images(spark, d), lines)


@register(
    "a3_group_stats",
    with_views(
        """select b.source, b.class_id, max(c.class_name) as class_name, count(*) as instances, count(distinct b.stem) as images,
  round(min(area), 9) as area_min, round(max(area), 9) as area_max, round(avg(area), 8) as area_mean, round(max(f.area_median), 9) as area_median,
  round(min(e), 6) as elong_min, round(max(e), 6) as elong_max, round(avg(e), 6) as elong_mean, round(max(f.elong_median), 6) as elong_median
from (select *, case when elong < cast('inf' as double) then elong end as e from measured) b
left join wide_fences f on f.source = b.source and f.class_id = b.class_id left join classes c on c.class_id = b.class_id
group by b.source, b.class_id""",
        "boxes",
        **{k: sp.AUDIT[k] for k in ("measured", "fences", "wide_fences", "classes")},
    ),
)
def a3(spark, d):
    s = audit.group_stats(boxes(spark, d))
    r = lambda c, n: F.round(c, n).alias(c)
    return s.select(
        "source", "class_id", "class_name", "instances", "images",
        r("area_min", 9), r("area_max", 9), r("area_mean", 8), r("area_median", 9),
        r("elong_min", 6), r("elong_max", 6), r("elong_mean", 6), r("elong_median", 6),
    )


@register(
    "a4_upper_fences",
    with_views(
        """select source, class_id, measure, n, round(q1, 8) as q1, round(median, 8) as median, round(q3, 8) as q3, round(fence, 8) as fence
from fences""",
        "boxes",
        measured=sp.MEASURED,
        fences=sp.FENCES,
    ),
)
def a4(spark, d):
    f = audit.fences(boxes(spark, d))
    return f.select("source", "class_id", "measure", "n", *[F.round(c, 8).alias(c) for c in ("q1", "median", "q3", "fence")])


FLAG_COLUMNS = "b.source, b.stem, b.line_no, c.class_name"


@register(
    "a5_flagged_boxes",
    with_views(
        f"""select b.source, b.stem, b.line_no, c.class_name, {sp.REASON_KEYS} as reasons
from flagged b left join classes c on c.class_id = b.class_id""",
        "boxes",
        **sp.AUDIT,
    ),
)
def a5(spark, d):
    return audit.flag_boxes(boxes(spark, d)).select(*KEY, "class_name", _keys_text())


REASON_COUNTS_SQL = """select source, reason, count(*) as boxes from (
  select source, unnest(string_split(reasons, ',')) as reason from keyed) e group by source, reason"""


@register(
    "a6_reason_counts",
    with_views(
        REASON_COUNTS_SQL, "boxes", **sp.AUDIT, keyed=f"select source, {sp.REASON_KEYS} as reasons from flagged"
    ),
)
def a6(spark, d):
    return audit.reason_counts(audit.flag_boxes(boxes(spark, d)))


@register(
    "a7_flag_sample",
    with_views(
        f"""select source, rn, stem, line_no, class_id, reasons from (
  select *, {sp.REASON_KEYS} as reasons, row_number() over (partition by source order by class_id, stem, line_no) as rn
  from flagged) r where rn <= 300""",
        "boxes",
        **sp.AUDIT,
    ),
)
def a7(spark, d):
    s = audit.flag_sample(audit.flag_boxes(boxes(spark, d)))
    return s.select("source", "rn", "stem", "line_no", "class_id", _keys_text())


@register(
    "a8_class_balance",
    with_views(
        """select c.class_id, c.class_name, count(distinct concat(b.source, '/', b.stem)) as images, count(b.stem) as instances
from classes c left join boxes b on b.class_id = c.class_id group by c.class_id, c.class_name""",
        "boxes",
        classes=sp.CLASSES,
    ),
)
def a8(spark, d):
    return audit.class_balance(boxes(spark, d))


@register(
    "a10_audit_merged",
    with_views(
        f"""select regexp_extract(key, '^(.*?)__(.*)$', 1) as source, count(*) as boxes_flagged,
  sum(case when r_invalid then 1 else 0 end)::bigint as boxes_invalid
from (select *, concat(source, '__', stem) as key from flagged) k group by 1""",
        "boxes",
        **sp.AUDIT,
    ),
)
def a10(spark, d):
    """The same audit over a pool whose only key is the merged name."""
    from boxweave.sources.labels import split_merged_key

    merged = boxes(spark, d).withColumn("stem", F.concat_ws("__", "source", "stem")).drop("source")
    rows = split_merged_key(merged, "stem")
    return audit.audit_totals(rows, audit.flag_boxes(rows)).select("source", "boxes_flagged", "boxes_invalid")


@register(
    "a11_class_labels",
    with_views(
        """select b.class_id, coalesce(c.class_name, concat('unknown_id_', cast(b.class_id as varchar))) as class_name, count(*) as instances
from (select * replace (cast(class_id * 2 - 3 as int) as class_id) from boxes) b left join classes c on c.class_id = b.class_id group by 1, 2""",
        "boxes",
        classes=sp.CLASSES,
    ),
)
def a11(spark, d):
    shifted = boxes(spark, d).withColumn("class_id", F.expr("class_id * 2 - 3"))
    return shifted.groupBy("class_id").agg(F.count(F.lit(1)).alias("instances")).withColumn(
        "class_name", audit.class_label()
    )


@register(
    "a12_flag_rates",
    with_views(
        """select b.source, b.boxes, coalesce(f.flagged, 0) as flagged, coalesce(f.flagged, 0) / cast(b.boxes as double) as rate
from (select source, count(*) as boxes from boxes group by source) b
left join (select source, count(*) as flagged from flagged group by source) f on f.source = b.source order by rate desc, b.source""",
        "boxes",
        **sp.AUDIT,
    ),
)
def a12(spark, d):
    rows = boxes(spark, d)
    return audit.flag_rates(rows, audit.flag_boxes(rows))
