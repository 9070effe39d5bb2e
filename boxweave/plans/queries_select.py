"""Registered queries: capping, selection algebra and merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxweave.config import CapPolicy
from boxweave.operators import cap, merge, selection
from boxweave.operators.dims import drop_inactive, with_class_id
from boxweave.plans import sql_parts as sp
from boxweave.plans.queries_convert import NAMED_SQL, SOURCES_SQL, named_boxes, present_images, sources
from boxweave.plans.registry import register
from boxweave.plans.views import boxes, once, table, with_views
from boxweave.runtime import scratch_path
from boxweave.sources import files, reports, sinks

PRIORITY = {0: ("s0", "s1", "s2"), 1: ("s3", "s0"), 2: ("s1",), 3: ("s9",)}
SUBBUDGETS = {(0, "s1"): 2500, (2, "s1"): 900}
SMALL = CapPolicy(300, 340, 42, ("s0",), PRIORITY, SUBBUDGETS)
LARGE = CapPolicy(900, 10000, 42, ("s0",), PRIORITY, SUBBUDGETS)
# No general source is left over, so every candidate can be taken.
HUGE = CapPolicy(1_000_000, 10_000_000, 42, ("s0",), PRIORITY, {})


def _cap_sql(policy: CapPolicy, tag: str) -> dict[str, str]:
    """Plain windows over whole classes: lanes, then four sequential claims, then the general fill."""
    cap_, floor = policy.hard_cap, policy.hard_cap // 3
    lanes = sp.values("class_id, source, lane, queued, base", policy.lanes())
    ctes = {
        f"lanes{tag}": f"""select *, case when lane + queued > 1 then {floor} // (lane + queued) else 0 end * queued as reserved,
  cast(round_even(cast(base as double) * {cap_} / cast(4500 as double), 0) as bigint) as subbudget from ({lanes}) l""",
        f"cand{tag}": "select class_id, source, stem, count(*) as cnt from boxes group by class_id, source, stem",
        f"rk{tag}": f"""select *, sum(cnt) over (partition by class_id, lane order by rn rows unbounded preceding) as cum from (
  select c.*, coalesce(l.lane, 0) as lane, l.subbudget, row_number() over (partition by c.class_id, coalesce(l.lane, 0)
    order by case when l.subbudget is not null then cnt else 0 end, md5(concat('{policy.seed}|', c.source, '/', stem)), c.source, stem) as rn
  from cand{tag} c left join lanes{tag} l on l.class_id = c.class_id and l.source = c.source) r""",
        f"supply{tag}": f"""select class_id, lane, count(*) as supply, from rk{tag}
  where lane > 0 and (subbudget is null or cum <= subbudget) group by class_id, lane""",
        f"plan{tag}": f"""select l.*, coalesce(s.supply, 0) as supply from lanes{tag} l
  left join supply{tag} s on s.class_id = l.class_id and s.lane = l.lane""",
    }
    previous = f"select class_id, cast({cap_} as bigint) as left_ from plan{tag} group by class_id"
    claims = []
    for k in (1, 2, 3, 4):
        ctes[f"left{k}{tag}"] = previous
        ctes[f"claim{k}{tag}"] = f"""select p.class_id, p.source, p.lane, p.queued, p.reserved, p.subbudget, b.left_,
  least(supply, greatest(b.left_ - reserved, 0)) as claimed from plan{tag} p join left{k}{tag} b on b.class_id = p.class_id where p.lane = {k}"""
        claims.append(f"select * from claim{k}{tag}")
        previous = f"""select b.class_id, b.left_ - coalesce(c.claimed, 0) as left_ from left{k}{tag} b
  left join claim{k}{tag} c on c.class_id = b.class_id"""
    ctes[f"left5{tag}"] = previous
    ctes[f"claims{tag}"] = " union all ".join(claims)
    ctes[f"prio{tag}"] = f"""select r.class_id, r.source, r.stem, r.cnt, r.lane, r.rn from rk{tag} r join claims{tag} c
  on c.class_id = r.class_id and c.lane = r.lane where r.rn <= c.claimed"""
    ctes[f"budget{tag}"] = f"""select b.class_id, b.left_ as images_left,
  greatest({policy.instance_target} - coalesce((select sum(cnt) from prio{tag} p where p.class_id = b.class_id), 0), 0) as instances_left
  from left5{tag} b"""
    ctes[f"gen{tag}"] = f"""select r.*, r.rn <= b.images_left and r.cum - r.cnt < b.instances_left as taken, b.images_left
  from rk{tag} r join budget{tag} b on b.class_id = r.class_id where r.lane = 0"""
    ctes[f"sel{tag}"] = f"""select class_id, source, stem, cnt, lane from prio{tag}
  union all select class_id, source, stem, cnt, lane from gen{tag} where taken"""
    ctes[f"sum{tag}"] = f"""select c.class_id, c.class_name, coalesce(t.images, 0) as candidate_images, coalesce(t.instances, 0) as candidate_instances,
  coalesce(g.n, 0) as general_candidates, coalesce(s.images, 0) as final_images, coalesce(s.instances, 0) as final_instances,
  coalesce(g.taken, 0) as general_selected, coalesce(g.n, 0) - coalesce(g.taken, 0) as general_excluded,
  coalesce(s.images, 0) >= {floor} as floor_met, {floor} as floor,
  case when coalesce(g.n, 0) = coalesce(g.taken, 0) then 'all_candidates_included'
    when g.taken >= b.images_left then 'image_hard_cap' else 'instance_target' end as stop_reason,
  4500 <> {cap_} as cap_overridden, 4500 as configured_cap
from classes c
left join (select class_id, count(*) as images, sum(cnt)::bigint as instances from cand{tag} group by 1) t on t.class_id = c.class_id
left join (select class_id, count(*) as n, sum(case when taken then 1 else 0 end)::bigint as taken from gen{tag} group by 1) g on g.class_id = c.class_id
left join (select class_id, count(*) as images, sum(cnt)::bigint as instances from sel{tag} group by 1) s on s.class_id = c.class_id
left join budget{tag} b on b.class_id = c.class_id"""
    return ctes


SQL_SMALL, SQL_LARGE, SQL_HUGE = _cap_sql(SMALL, "_a"), _cap_sql(LARGE, "_b"), _cap_sql(HUGE, "_c")
# Same seed and target as SMALL, so their reports may be combined.
MEDIUM = CapPolicy(600, 340, 42, ("s0",), PRIORITY, SUBBUDGETS)
SQL_MEDIUM = _cap_sql(MEDIUM, "_m")


def _sql(body: str, *sets: dict[str, str], **extra: str) -> str:
    named = {"classes": sp.CLASSES}
    for s in sets:
        named.update(s)
    named.update(extra)
    return with_views(body, "boxes", **named)


def result(spark, d, policy):
    return cap.select_images(cap.candidates(boxes(spark, d)), policy)


def stored(spark, d, policy):
    """The selection table a capping run left behind."""
    name = f"selected-{policy.hard_cap}-{policy.instance_target}"
    return once(spark, d, name, lambda: result(spark, d, policy).selected)


@register("k1_candidates", with_views("select class_id, source, stem, count(*) as cnt from boxes group by 1, 2, 3", "boxes"))
def k1(spark, d):
    return cap.candidates(boxes(spark, d))


@register(
    "k2_reservations",
    _sql(
        """select l.class_id, l.source, l.lane, l.reserved, l.subbudget, count(c.stem) as candidates from lanes_b l
left join cand_b c on c.class_id = l.class_id and c.source = l.source group by all""",
        SQL_LARGE,
    ),
)
def k2(spark, d):
    counts = cap.candidates(boxes(spark, d)).groupBy("class_id", "source").agg(F.count(F.lit(1)).alias("candidates"))
    lanes = cap.lane_table(spark, LARGE).select("class_id", "source", "lane", "reserved", "subbudget")
    return lanes.join(counts, ["class_id", "source"], "left").na.fill(0, ["candidates"])


@register("k3_priority_claims", _sql("select class_id, source, stem, cnt, lane from prio_b", SQL_LARGE))
def k3(spark, d):
    return result(spark, d, LARGE).selected.where("lane > 0").select("class_id", "source", "stem", "cnt", "lane")


@register(
    "k4_sparse_first",
    _sql("select p.* exclude (rn) from prio_b p join lanes_b l on l.class_id = p.class_id and l.lane = p.lane where l.subbudget is not null", SQL_LARGE),
)
def k4(spark, d):
    r = result(spark, d, LARGE)
    sub = F.broadcast(r.lanes.where("subbudget is not null").select("class_id", "lane"))
    return r.selected.join(sub, ["class_id", "lane"]).select("class_id", "source", "stem", "cnt", "lane")


@register("k5_selected_images", _sql("select class_id, source, stem, cnt, case when lane > 0 then 'priority' else 'general' end as reason from sel_a", SQL_SMALL))
def k5(spark, d):
    return result(spark, d, SMALL).selected.drop("lane")


@register(
    "k6_stop_reasons",
    _sql("select class_id, stop_reason from sum_a union all select class_id + 100, stop_reason from sum_b union all select class_id + 200, stop_reason from sum_c", SQL_SMALL, SQL_LARGE, SQL_HUGE),
)
def k6(spark, d):
    found = cap.candidates(boxes(spark, d))
    per = [
        cap.class_summary(cap.select_images(found, p)).select((F.col("class_id") + 100 * i).alias("class_id"), "stop_reason")
        for i, p in enumerate((SMALL, LARGE, HUGE))
    ]
    return per[0].unionByName(per[1]).unionByName(per[2])


@register("k7_class_summary", _sql("select * exclude (cap_overridden, configured_cap) from sum_a", SQL_SMALL))
def k7(spark, d):
    return cap.class_summary(result(spark, d, SMALL)).drop("cap_overridden", "configured_cap")


@register(
    "k7_source_counts",
    _sql(
        """select c.class_id, c.source, count(*) as candidates, count(s.stem) as selected from cand_a c
left join sel_a s on s.class_id = c.class_id and s.source = c.source and s.stem = c.stem group by 1, 2""",
        SQL_SMALL,
    ),
)
def k7_sources(spark, d):
    return cap.source_counts(result(spark, d, SMALL))


@register(
    "k8_excluded_sample",
    _sql(
        """select class_id, source, stem, seeded_rank, rn from (select class_id, source, stem, rn as seeded_rank,
  row_number() over (partition by class_id order by rn) as rn from gen_a where not taken) x where rn <= 50""",
        SQL_SMALL,
    ),
)
def k8(spark, d):
    return cap.excluded_sample(result(spark, d, SMALL))


RATIO_SQL = """select max_class, max_images, min_class, min_images, ratio, ratio <= 3 as meets_3to1, min_images < floor as recompute_trigger,
  case when min_images < floor then min_images * 3 end as recomputed_cap from (
  select arg_max(class_name, struct_pack(a := final_images, b := -class_id)) as max_class, max(final_images) as max_images,
    arg_min(class_name, struct_pack(a := final_images, b := class_id)) as min_class, min(final_images) as min_images,
    case when min(final_images) > 0 then max(final_images) / cast(min(final_images) as double) else cast('inf' as double) end as ratio,
    max(floor) as floor from {0}) x"""


@register("k9_ratio_invariant", _sql(RATIO_SQL.format("sum_a"), SQL_SMALL))
def k9(spark, d):
    return cap.ratio_invariant(cap.class_summary(result(spark, d, SMALL)))


@register("k10_recompute_trigger", _sql(f"select recompute_trigger, recomputed_cap from ({RATIO_SQL.format('sum_c')}) y", SQL_HUGE))
def k10(spark, d):
    return cap.ratio_invariant(cap.class_summary(result(spark, d, HUGE))).select("recompute_trigger", "recomputed_cap")


BREAKDOWN_SQL = """select c.class_id, c.lane, c.source, coalesce(n.candidates, 0) as candidates, c.claimed as selected_images,
  coalesce(p.instances, 0) as selected_instances, c.reserved as reserved_for_later, c.subbudget as instance_subbudget,
  c.left_ - c.claimed = 0 and c.queued > 0 as starved_next
from claims{0} c left join (select class_id, source, count(*) as candidates from cand{0} group by 1, 2) n on n.class_id = c.class_id and n.source = c.source
left join (select class_id, lane, sum(cnt)::bigint as instances from prio{0} group by 1, 2) p on p.class_id = c.class_id and p.lane = c.lane"""
TIGHT = CapPolicy(5, 10000, 42, ("s0",), PRIORITY, SUBBUDGETS)
SQL_TIGHT = _cap_sql(TIGHT, "_t")


@register("k11_starvation", _sql(BREAKDOWN_SQL.format("_t"), SQL_TIGHT))
def k11(spark, d):
    return cap.priority_breakdown(result(spark, d, TIGHT))


@register("k11_priority_breakdown", _sql(BREAKDOWN_SQL.format("_b"), SQL_LARGE))
def k11_large(spark, d):
    return cap.priority_breakdown(result(spark, d, LARGE))


@register("k12_cap_overrides", _sql("select class_id, class_name, configured_cap, candidate_images from sum_a where cap_overridden", SQL_SMALL))
def k12(spark, d):
    s = cap.class_summary(result(spark, d, SMALL))
    return s.where("cap_overridden").select("class_id", "class_name", "configured_cap", "candidate_images")


# --- selection algebra -----------------------------------------------------------------------------
U_SETS = (SQL_SMALL, SQL_LARGE)


def two(spark, d):
    return [stored(spark, d, p) for p in (SMALL, LARGE)]


@register("u1_union", _sql("select class_id, source, stem from sel_a union select class_id, source, stem from sel_b", *U_SETS))
def u1(spark, d):
    return selection.union(two(spark, d))


@register("u2_intersection", _sql("select class_id, source, stem from sel_a intersect select class_id, source, stem from sel_b", *U_SETS))
def u2(spark, d):
    return selection.intersect(two(spark, d))


@register(
    "u3_dropped_by_class",
    _sql(
        """select class_id, count(*) as dropped from (select class_id, source, stem from sel_b except select class_id, source, stem from sel_a) x group by 1""",
        *U_SETS,
    ),
)
def u3(spark, d):
    small, large = two(spark, d)
    return selection.dropped_by_class(large, selection.intersect([large, small]))


@register(
    "u5_coverage",
    _sql(
        """select unnest(['only_0', 'only_1', 'intersection_all', 'union_all']) as label,
  unnest([sum(case when a and not b then 1 else 0 end), sum(case when b and not a then 1 else 0 end), sum(case when a and b then 1 else 0 end), count(*)])::bigint as images
from (select source, stem, bool_or(i = 0) as a, bool_or(i = 1) as b from (
  select source, stem, 0 as i from sel_a union all select source, stem, 1 from sel_b) x group by 1, 2) y""",
        *U_SETS,
    ),
)
def u5(spark, d):
    return selection.coverage(two(spark, d))


@register(
    "u6_stale_sources",
    with_views(
        """select distinct name as source from named where name in (
  select concat(case when is_project then 'roboflow_' else '' end, key) from sources where audit_status in ('failed', 'benched', 'blocked'))""",
        "boxes",
        named=NAMED_SQL,
        sources=SOURCES_SQL,
    ),
)
def u6(spark, d):
    rows = named_boxes(spark, d)
    return selection.stale_sources(rows, drop_inactive(rows.select("source").distinct(), sources(spark)))


@register("u7_selected_images", _sql("select distinct source, stem from sel_a", SQL_SMALL))
def u7(spark, d):
    return selection.images(stored(spark, d, SMALL))


BOTH = "select class_id, source, stem from sel_a intersect select class_id, source, stem from sel_m"


@register(
    "u8_combined_report",
    _sql(
        f"""select 'intersect' as combine_op, cast(null as int) as hard_cap_preset, i.input, i.n as selected_total,
  (select count(*) from ({BOTH}) b) as result_total, true as hashed
from (select 0 as input, count(*) as n from (select distinct source, stem from sel_a) x
  union all select 1, count(*) from (select distinct source, stem from sel_m) y) i""",
        SQL_SMALL,
        SQL_MEDIUM,
    ),
)
def u8(spark, d):
    """Both reports are written, checked for compatibility, read back and combined."""
    read, facts, hashes, paths = written_reports(spark, d)
    selection.check_compatible(facts)
    report = selection.combined_report("intersect", read, paths, hashes)
    return report.withColumn("hashed", F.length("sha256") == 64).drop("path", "sha256")


def written_reports(spark, d):
    """Selections, headers, hashes and paths of the reports of two runs, from their files."""
    found = cap.candidates(boxes(spark, d))
    paths, read, facts, hashes = [], [], [], []
    for policy in (SMALL, MEDIUM):
        path = scratch_path(spark, "selection")
        sinks.write_report(cap.selection_report(cap.select_images(found, policy)), path)
        read.append(with_class_id(reports.read_selection(spark, path)).select("class_id", "source", "stem"))
        facts.append(reports.read_selection_facts(spark, path).first().asDict())
        hashes.append(files.content_hashes(spark, path).where("path like '%.json'").withColumn("path", F.lit(path)))
        paths.append(path)
    return read, facts, hashes[0].unionByName(hashes[1]), paths


def combined_path(spark, d, op):
    """A combined report on disk, as the job that combines leaves it."""
    read, facts, _, _ = written_reports(spark, d)
    path = scratch_path(spark, "combined")
    sinks.write_report(selection.combined_document(op, read, facts), path)
    return path


@register(
    "u8_combined_classes",
    _sql(
        f"""select c.class_name, coalesce(n.final_images, 0) as final_images, coalesce(n.first_entry, '') as first_entry, coalesce(f.n, 0) - coalesce(n.final_images, 0) as dropped,
  (select count(*) from ({BOTH}) t) as result_total
from classes c left join (select class_id, count(*) as final_images, min(concat(source, '/', stem)) as first_entry from ({BOTH}) b group by class_id) n on n.class_id = c.class_id
left join (select class_id, count(*) as n from sel_a group by class_id) f on f.class_id = c.class_id""",
        SQL_SMALL,
        SQL_MEDIUM,
    ),
)
def u8_classes(spark, d):
    """The body of the combined report as it is read from its file."""
    kind = "classes map<string, struct<selected: array<string>, final_images: bigint>>, result_total bigint, dropped_by_class map<string, bigint>"
    doc = spark.read.schema(kind).json(combined_path(spark, d, "intersect"))
    rows = doc.select(F.explode("classes").alias("class_name", "body"), "result_total", "dropped_by_class")
    return rows.select(
        "class_name",
        "body.final_images",
        F.coalesce(F.get("body.selected", F.lit(0)), F.lit("")).alias("first_entry"),
        F.coalesce(F.element_at("dropped_by_class", F.col("class_name")), F.lit(0)).alias("dropped"),
        "result_total",
    )


@register(
    "s13_selection_report",
    _sql("select c.class_name, s.source, s.stem from sel_a s join classes c on c.class_id = s.class_id", SQL_SMALL),
)
def s13(spark, d):
    root = scratch_path(spark, "selection")
    sinks.write_report(cap.selection_report(result(spark, d, SMALL)), root)
    return reports.read_selection(spark, root)


# --- merge -----------------------------------------------------------------------------------------
MERGE = {
    **SQL_SMALL,
    "union_": "select distinct source, stem from sel_a",
    "excluded": """select distinct b.source, b.stem from boxes b join orders o on b.stem = concat('img', lpad(cast(o.o_orderkey as varchar), 9, '0'))
where o.o_orderpriority = '3-MEDIUM'""",
    "present": "select stem from (select concat('img', lpad(cast(o_orderkey as varchar), 9, '0')) as stem from orders where o_orderpriority <> '1-URGENT') p",
    "labelled": "select distinct source, stem from boxes where w > 0.05",
    "resolved": """select u.source, u.stem, case when p.stem is not null then concat(u.stem, '.jpg') end as filename,
  case when p.stem is null then 'missing_image' when l.stem is null then 'missing_label' else 'merged' end as outcome
from union_ u left join present p on p.stem = u.stem left join labelled l on l.source = u.source and l.stem = u.stem
where not exists (select 1 from excluded e where e.source = u.source and e.stem = u.stem)""",
}


def exclusions(spark, d):
    picked = table(spark, d, "orders").where("o_orderpriority = '3-MEDIUM'").select(
        F.concat(F.lit("s"), F.expr("o_orderkey % 5").cast("string")).alias("source"),
        F.concat(F.lit("img"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("stem"),
    )
    return picked


def resolved(spark, d):
    chosen = selection.images(stored(spark, d, SMALL))
    left = merge.apply_exclusions(chosen, exclusions(spark, d))
    images_ = present_images(spark, d).withColumn("filename", F.concat("stem", F.lit(".jpg")))
    return merge.resolve_files(left, images_, boxes(spark, d).where("w > 0.05"))


@register(
    "g1_exclusion_hits",
    _sql("select u.source, count(*) as excluded from union_ u join excluded e on e.source = u.source and e.stem = u.stem group by 1", MERGE),
)
def g1(spark, d):
    chosen = selection.images(stored(spark, d, SMALL))
    return merge.exclusion_hits(chosen, exclusions(spark, d)).groupBy("source").agg(F.count(F.lit(1)).alias("excluded"))


@register("g2_resolved_files", _sql("select * from resolved", MERGE))
def g2(spark, d):
    return resolved(spark, d)


@register(
    "g2_resolved_from_combined",
    _sql("select u.source, u.stem, case when p.stem is null then 'missing_image' when l.stem is null then 'missing_label' else 'merged' end as outcome "
    "from (select source, stem from sel_a union select source, stem from sel_m) u left join present p on p.stem = u.stem "
    "left join labelled l on l.source = u.source and l.stem = u.stem", {k: v for k, v in MERGE.items() if k in ("present", "labelled")}, SQL_SMALL, SQL_MEDIUM),
)
def g2_combined(spark, d):
    """Merging from the union of two runs, read from the combined report's file."""
    chosen = reports.read_selection(spark, combined_path(spark, d, "union"))
    images_ = present_images(spark, d).withColumn("filename", F.concat("stem", F.lit(".jpg")))
    return merge.resolve_files(selection.images(chosen), images_, boxes(spark, d).where("w > 0.05")).select("source", "stem", "outcome")


@register("g3_merged_per_source", _sql("select source, count(*) as images from resolved where outcome = 'merged' group by 1", MERGE))
def g3(spark, d):
    return merge.per_source(resolved(spark, d))


@register(
    "g4_carried_boxes",
    _sql("select b.source, b.stem, b.line_no, b.class_id from boxes b join resolved r on r.source = b.source and r.stem = b.stem where r.outcome = 'merged'", MERGE),
)
def g4(spark, d):
    return merge.carried_boxes(boxes(spark, d).select("source", "stem", "line_no", "class_id"), resolved(spark, d))


@register(
    "g5_merged_counts",
    _sql(
        """select coalesce(c.class_id, b.class_id) as class_id, count(distinct b.stem) as images, count(b.stem) as instances
from classes c full outer join (select b.* replace (case when b.line_no = 7 then 16 when b.line_no = 8 then -1 else b.class_id end as class_id)
  from boxes b join resolved r on r.source = b.source and r.stem = b.stem where r.outcome = 'merged') b on c.class_id = b.class_id
group by 1""",
        MERGE,
    ),
)
def g5(spark, d):
    """Some labels carry ids outside the list; they are tallied apart and appended here."""
    bad = F.when(F.col("line_no") == 7, 16).when(F.col("line_no") == 8, -1).otherwise(F.col("class_id"))
    carried = merge.carried_boxes(boxes(spark, d).withColumn("class_id", bad), resolved(spark, d))
    known, unknown = merge.merged_counts(carried)
    images_ = carried.select("class_id", "source", "stem").distinct().groupBy("class_id").agg(F.count(F.lit(1)).alias("images"))
    return known.drop("class_name").unionByName(unknown.join(images_, "class_id").select("class_id", "images", "instances"))
