"""Registered queries: label-mistake scoring, review scope and write-back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from boxweave import config
from boxweave.operators import audit, dedup, mapping, review, score
from boxweave.plans import sql_parts as sp
from boxweave.plans.queries_audit import IMAGES_SQL, images
from boxweave.plans.queries_convert import WALK_SQL, present_images
from boxweave.plans.queries_select import SMALL, SQL_SMALL, stored
from boxweave.plans.registry import register
from boxweave.plans.views import BOXES_SQL, boxes, once, preds, raw, table, with_views
from boxweave.runtime import scratch_path
from boxweave.sources import sinks

ELIGIBLE = "(" + ", ".join(str(i) for i in config.proxy_class_ids()) + ")"
KEY = ["source", "stem"]

GT_SQL = f"select source, stem, line_no as box_no, class_id, cx - w / 2 as x, cy - h / 2 as y, w, h from boxes where class_id in {ELIGIBLE}"
SCORE = {
    "gt": GT_SQL,
    "pr": f"select * from preds where class_id in {ELIGIBLE}",
    "pairs": """select * from (
  select g.source, g.stem, g.box_no, g.class_id as g_class, p.pred_no, p.class_id as p_class, p.conf,
    greatest(least(g.x + g.w, p.x + p.w) - greatest(g.x, p.x), 0) * greatest(least(g.y + g.h, p.y + p.h) - greatest(g.y, p.y), 0) as inter,
    g.w * g.h + p.w * p.h as both_areas
  from gt g join pr p on p.source = g.source and p.stem = g.stem) c where both_areas - inter > 0 and inter / (both_areas - inter) >= 0.5""",
    "best": """select * from (
  select *, row_number() over (partition by source, stem, box_no order by inter / (both_areas - inter) desc, conf desc, pred_no) as rb,
    row_number() over (partition by source, stem, pred_no order by inter / (both_areas - inter) desc, conf desc, box_no) as rp from pairs) r
where rb = 1 and rp = 1""",
    "scores": """select i.source, i.stem, coalesce(max((1 + case when g_class = p_class then -1 else 1 end * conf) / 2), -1) as mistakenness
from (select distinct source, stem from gt) i left join best b on b.source = i.source and b.stem = i.stem group by 1, 2""",
    "classes": sp.CLASSES,
    "ranked": """select s.source, s.stem, round(s.mistakenness, 6) as mistakenness, g.n as gt_box_count, coalesce(p.n, 0) as pred_box_count, g.classes
from scores s join (select source, stem, count(*) as n, string_agg(distinct class_name, ',' order by class_name) as classes
  from gt join classes c on c.class_id = gt.class_id group by 1, 2) g on g.source = s.source and g.stem = s.stem
left join (select source, stem, count(*) as n from pr group by 1, 2) p on p.source = s.source and p.stem = s.stem""",
}


def truth(spark, d):
    return score.ground_truth(boxes(spark, d))


def eligible_preds(spark, d):
    return score.eligible(preds(spark, d))


@register(
    "x1_scope_from_selection",
    with_views(f"select distinct source, stem from sel_a where class_id in {ELIGIBLE}", "boxes", classes=sp.CLASSES, **SQL_SMALL),
)
def x1(spark, d):
    return score.scope_from_selection(stored(spark, d, SMALL))


@register(
    "x2_scope_from_pool",
    with_views(f"select source, stem from images i where exists (select 1 from boxes b where b.stem = i.stem and b.class_id in {ELIGIBLE})", "boxes", images=IMAGES_SQL),
)
def x2(spark, d):
    return score.scope_from_pool(images(spark, d), boxes(spark, d))


@register("x3_ground_truth", with_views("select * replace (round(x, 9) as x, round(y, 9) as y) from gt", "boxes", gt=GT_SQL))
def x3(spark, d):
    return truth(spark, d).withColumns({c: F.round(c, 9) for c in ("x", "y")})


MODEL = ["person", "car", "bus", "truck", "motorcycle", "bicycle", "dog", "cat", "chair", "dining table", "kite", "oven"]


def toy_model(rows: pd.DataFrame) -> pd.DataFrame:
    """Stands for a detector: one detection per image, made from the image's own numbers."""
    c = rows["o_custkey"]
    left, top = c % 50 / 100.0, c % 40 / 100.0
    return pd.DataFrame(
        {
            "source": rows["source"], "stem": rows["stem"], "pred_no": 1, "native_name": [MODEL[i % 12] for i in c],
            "x1": left, "y1": top, "x2": left + 0.25, "y2": top + 0.5, "conf": c % 100 / 100.0,
        }
    )


@register(
    "x4_prediction_overlay",
    with_views(
        """select source, stem, 1 as pred_no, class_id, round(c % 50 / 100, 9) as x, round(c % 40 / 100, 9) as y, 0.25::double as w, 0.5::double as h,
  c % 100 / 100 as conf from (
  select concat('s', cast(o_orderkey % 5 as varchar)) as source, concat('img', lpad(cast(o_orderkey as varchar), 9, '0')) as stem, o_custkey as c from orders) o
join model m on m.i = c % 12 join walk w on w.native_name = m.native_name join classes k on k.class_name = w.class_name""",
        model=sp.values("i, native_name", list(enumerate(MODEL))),
        walk=WALK_SQL,
        classes=sp.CLASSES,
    ),
)
def x4(spark, d):
    rows = table(spark, d, "orders").select(
        F.concat(F.lit("s"), F.expr("o_orderkey % 5").cast("string")).alias("source"),
        F.concat(F.lit("img"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("stem"),
        "o_custkey",
    )
    found = score.overlay(rows, toy_model, mapping.crosswalk(spark))
    return found.withColumns({c: F.round(c, 9) for c in ("x", "y", "w", "h")})


@register("x5_image_scores", with_views("select source, stem, round(mistakenness, 6) as mistakenness from scores", "preds", **SCORE))
def x5(spark, d):
    s = score.image_scores(truth(spark, d), eligible_preds(spark, d))
    return s.withColumn("mistakenness", F.round("mistakenness", 6))


@register("x5_matches", with_views("select source, stem, box_no, g_class, pred_no, p_class, conf from best", "preds", **{k: SCORE[k] for k in ("gt", "pr", "pairs", "best")}))
def x5_matches(spark, d):
    return score.matches(truth(spark, d), eligible_preds(spark, d)).drop("iou")


def ranked(spark, d):
    gt, p = truth(spark, d), eligible_preds(spark, d)
    r = score.ranking(gt, p, score.image_scores(gt, p))
    return r.withColumn("classes", F.concat_ws(",", "classes")).withColumn("mistakenness", F.round("mistakenness", 6))


@register("x6_ranked_images", with_views("select * from ranked order by mistakenness desc, source, stem", "preds", **SCORE))
def x6(spark, d):
    return ranked(spark, d)


@register("x7_review_slice", with_views("select * from ranked order by mistakenness desc, source, stem limit 1000", "preds", **SCORE))
def x7(spark, d):
    return score.review_slice(ranked(spark, d))


PRESENT_SQL = "select concat('img', lpad(cast(o_orderkey as varchar), 9, '0')) as stem from orders where o_orderpriority <> '1-URGENT'"


@register(
    "x8_missing_images",
    with_views(f"select distinct source, stem from boxes where class_id in {ELIGIBLE} and stem not in ({PRESENT_SQL})", "boxes"),
)
def x8(spark, d):
    return score.missing_images(boxes(spark, d), present_images(spark, d))


@register(
    "x9_uncovered_classes",
    with_views(
        f"select c.class_id, c.class_name, count(b.stem) as instances from classes c left join boxes b on b.class_id = c.class_id where c.class_id not in {ELIGIBLE} group by 1, 2",
        "boxes",
        classes=sp.CLASSES,
    ),
)
def x9(spark, d):
    counts = boxes(spark, d).groupBy("class_id").agg(F.count(F.lit(1)).alias("instances"))
    return score.uncovered_classes(mapping.crosswalk(spark)).join(counts, "class_id", "left").na.fill(0, ["instances"])


# --- review ----------------------------------------------------------------------------------------
MERGED_SQL = f"select concat('s', cast(o_orderkey % 5 as varchar)) as source, concat('img', lpad(cast(o_orderkey as varchar), 9, '0')) as stem from orders where o_orderpriority <> '1-URGENT'"
REVIEWED_SQL = MERGED_SQL.replace("o_orderpriority <> '1-URGENT'", "o_orderstatus = 'F'")


def reviewed(spark, d):
    return table(spark, d, "orders").where("o_orderstatus = 'F'").select(
        F.concat(F.lit("s"), F.expr("o_orderkey % 5").cast("string")).alias("source"),
        F.concat(F.lit("img"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("stem"),
    )


@register("r1_only_merged", with_views("select distinct b.source, b.stem from boxes b join merged m on m.stem = b.stem and m.source = b.source", "boxes", merged=MERGED_SQL))
def r1(spark, d):
    return review.only_merged(boxes(spark, d).select(*KEY).distinct(), present_images(spark, d))


@register(
    "r2_without_duplicates",
    """select source, filename as stem from (select source, concat('d', doc_id) as filename, doc_id, text from documents) d
where doc_id = (select min(doc_id) from documents e where e.text = d.text)""",
)
def r2(spark, d):
    """The report is a table that the duplicate search left behind, with the number of files it was made for."""
    docs = table(spark, d, "documents").select("doc_id", "source", F.sha2("text", 256).alias("content"))
    names = docs.select("source", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("stem"), F.col("doc_id").alias("key"), "content")

    def report():
        copies = dedup.exact_duplicates(names.select("key", "content"))
        return dedup.coverage(names, names, copies, copies, "full pool").select("images_checked", "exact_duplicate_files")

    stored = once(spark, d, "duplicate_report", report)
    copies = once(spark, d, "duplicates", lambda: dedup.exact_duplicates(names.select("key", "content")).select(F.col("duplicate").alias("key")))
    return review.hide_duplicates(names.select(*KEY), names.join(copies, "key", "left_semi"), stored.first()["images_checked"], names)


@register("r3_unreviewed", with_views("select source, stem from images i where not exists (select 1 from reviewed r where r.source = i.source and r.stem = i.stem)", images=IMAGES_SQL, reviewed=REVIEWED_SQL))
def r3(spark, d):
    return review.skip_reviewed(images(spark, d), reviewed(spark, d))


@register(
    "r4_marked_boxes",
    with_views(
        f"""select b.source, b.stem, b.line_no, m.source is not null as flagged, coalesce(m.reasons, '') as flag_reasons from boxes b
left join (select source, stem, round(cx, 6) as rcx, round(cy, 6) as rcy, round(w, 6) as rw, round(h, 6) as rh,
    arg_max({sp.REASON_KEYS.replace("','", "', '", 1)}, struct_pack(a := class_id, b := line_no)) as reasons from flagged group by 1, 2, 3, 4, 5, 6) m
  on m.source = b.source and m.stem = b.stem and m.rcx = round(b.cx, 6) and m.rcy = round(b.cy, 6) and m.rw = round(b.w, 6) and m.rh = round(b.h, 6)
where b.stem in (select stem from flagged)""",
        "boxes",
        **{k: sp.AUDIT[k] for k in ("measured", "fences", "wide_fences", "flagged")},
    ),
)
def r4(spark, d):
    rows = boxes(spark, d)
    flagged = audit.flag_boxes(rows).withColumn("reasons", F.transform("reasons", audit.reason_key))
    return review.flagged_boxes(rows, flagged).select(*KEY, "line_no", "flagged", "flag_reasons")


@register("r5_routed_predictions", with_views("select source, stem, pred_no, conf, case when conf >= 0.7 then 'accept' else 'manual' end as tag from preds", "preds"))
def r5(spark, d):
    return review.route(preds(spark, d)).select(*KEY, "pred_no", "conf", "tag")


PROMOTED = {
    "promoted": """select source, stem, line_no, class_id, cx, cy, w, h from boxes
union all select p.source, p.stem, l.last + row_number() over (partition by p.source, p.stem order by p.pred_no), p.class_id, x + w / 2, y + h / 2, w, h
from preds p join (select source, stem, max(line_no) as last from boxes group by 1, 2) l on l.source = p.source and l.stem = p.stem where conf >= 0.7"""
}


@register("r6_promoted_boxes", with_views("select source, stem, line_no, class_id, round(cx, 9) as cx, round(cy, 9) as cy from promoted", "preds", **PROMOTED))
def r6(spark, d):
    p = review.promote(boxes(spark, d), review.route(preds(spark, d)))
    return p.select(*KEY, "line_no", "class_id", F.round("cx", 9).alias("cx"), F.round("cy", 9).alias("cy"))


@register(
    "r7_exclusions",
    with_views(
        "select source, stem from reviewed union select source, stem from images where stem not in (select stem from merged)",
        images=IMAGES_SQL,
        merged=MERGED_SQL,
        reviewed=REVIEWED_SQL,
    ),
)
def r7(spark, d):
    tag = F.when(F.col("keep").isNull(), "exclude").otherwise("keep")
    present = present_images(spark, d).withColumn("keep", F.lit(True))
    tagged = images(spark, d).join(present, KEY, "left").withColumn("tag", tag)
    return review.accumulate_exclusions(reviewed(spark, d), tagged)


DETECTIONS_SQL = "select source, stem, line_no, class_id, cx, cy, w, h, h > 0.05 as whole from boxes"


def detections(spark, d):
    """Reviewed detections by class name; very flat ones lost their geometry."""
    b = boxes(spark, d)
    shape = F.array(F.col("cx") - F.col("w") / 2, F.col("cy") - F.col("h") / 2, F.col("w"), F.col("h"))
    return b.select(
        *KEY,
        "line_no",
        audit.class_label().alias("class_name"),
        F.when(F.col("h") > 0.05, shape).otherwise(F.array().cast("array<double>")).alias("bounding_box"),
    )


@register(
    "r8_rewritten_labels",
    with_views("select source, stem, line_no, class_id, round(cx - w / 2 + w / 2, 9) as cx, round(cy - h / 2 + h / 2, 9) as cy, w, h from det where whole", "boxes", det=DETECTIONS_SQL),
)
def r8(spark, d):
    return review.rewrite(detections(spark, d))[0].withColumns({c: F.round(c, 9) for c in ("cx", "cy")})


@register(
    "r8_malformed",
    with_views("select source, stem, line_no, class_name from det join classes c on c.class_id = det.class_id where not whole", "boxes", det=DETECTIONS_SQL, classes=sp.CLASSES),
)
def r8_malformed(spark, d):
    return review.rewrite(detections(spark, d))[1]


EDITED_SQL = """select * replace (case when line_no = 2 then (class_id + 1) % 16 else class_id end as class_id) from boxes where h > 0.05
union all select source, stem, 99, class_id, cx, cy, w, h from boxes where line_no = 1 and w > 0.3"""


def edited(spark, d):
    """A review session: flat boxes removed, second boxes relabelled, some first boxes doubled."""
    b = boxes(spark, d)
    other = F.when(F.col("line_no") == 2, (F.col("class_id") + 1) % 16).otherwise(F.col("class_id"))
    return b.where("h > 0.05").withColumn("class_id", other).unionByName(
        b.where("line_no = 1 and w > 0.3").withColumn("line_no", F.lit(99))
    )


@register(
    "r9_diff_classes",
    with_views(
        """select i.source, i.stem, case when coalesce(n.c, 0) > coalesce(o.c, 0) then 'added' when coalesce(n.c, 0) < coalesce(o.c, 0) then 'removed'
  when n.lines is distinct from o.lines then 'modified' else 'unchanged' end as change from images i
left join (select source, stem, count(*) as c, list_sort(list_distinct(list(printf('%d %.6f %.6f %.6f %.6f', class_id, cx, cy, w, h)))) as lines from boxes group by 1, 2) o
  on o.source = i.source and o.stem = i.stem
left join (select source, stem, count(*) as c, list_sort(list_distinct(list(printf('%d %.6f %.6f %.6f %.6f', class_id, cx, cy, w, h)))) as lines from edited group by 1, 2) n
  on n.source = i.source and n.stem = i.stem""",
        "boxes",
        images=IMAGES_SQL,
        edited=EDITED_SQL,
    ),
)
def r9(spark, d):
    return review.diff(images(spark, d), boxes(spark, d), edited(spark, d))


@register(
    "r10_partial_overwrite",
    with_views(
        f"""select source, stem, row_number() over (partition by source, stem order by part, line_no) as line_no, class_id from (
  select source, stem, line_no, class_id, 0 as part from boxes where class_id not in {ELIGIBLE}
  union all select source, stem, line_no, class_id, 1 from edited where class_id in {ELIGIBLE}) x
where exists (select 1 from reviewed r where r.source = x.source and r.stem = x.stem)""",
        "boxes",
        edited=EDITED_SQL,
        reviewed=REVIEWED_SQL,
    ),
)
def r10(spark, d):
    scope = reviewed(spark, d)
    edits = score.eligible(edited(spark, d)).join(scope, KEY, "left_semi")
    return review.replace_eligible(scope, boxes(spark, d), edits).select(*KEY, "line_no", "class_id")


@register(
    "r10_files_per_source",
    with_views("select source, count(distinct stem) as files from reviewed group by source", reviewed=REVIEWED_SQL),
)
def r10_files(spark, d):
    return review.files_per_source(reviewed(spark, d))


R11_SQL = f"""with boxes as materialized ({BOXES_SQL}), reviewed as materialized ({REVIEWED_SQL}), edited as materialized ({EDITED_SQL}),
session as materialized (select e.source, e.stem, e.line_no, e.class_id from edited e join reviewed r on r.source = e.source and r.stem = e.stem),
touched as materialized (select distinct source, stem from session)
select source, stem, line_no, class_id from session
union all select b.source, b.stem, b.line_no, b.class_id from boxes b left join touched t on t.source = b.source and t.stem = b.stem where t.stem is null"""


@register("r11_reviewed_store", R11_SQL)
def r11(spark, d):
    """A store of all boxes in key buckets, into which one session is folded."""
    store = scratch_path(spark, "store")
    sinks.begin_store(boxes(spark, d), store, KEY, review.STORE_BUCKETS)
    session = edited(spark, d).join(reviewed(spark, d), KEY, "left_semi")
    return review.add_reviewed(session, store).select(*KEY, "line_no", "class_id")


@register(
    "r12_reread_counts",
    with_views(
        """select i.source, count(r.stem) as loaded, count(*) - count(r.stem) as skipped
from images i left join (select distinct source, stem from reviewed) r on r.source = i.source and r.stem = i.stem group by i.source""",
        images=IMAGES_SQL,
        reviewed=REVIEWED_SQL,
    ),
)
def r12(spark, d):
    return review.reread(images(spark, d), reviewed(spark, d))
