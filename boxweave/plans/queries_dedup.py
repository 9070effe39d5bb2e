"""Registered queries: duplicates and the leak-free split."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxweave.operators import components as comp
from boxweave.operators import dedup, split
from boxweave.plans import sql_parts as sp
from boxweave.plans.registry import register
from boxweave.plans.views import once, pool, table, with_views
from boxweave.runtime import by_shuffle

# Distances of the test vectors start near 0.99, so the default threshold would find nothing.
NEAR = 1.15
SAMPLE = 200


def documents(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("key"), F.sha2("text", 256).alias("content"))


EXACT_SQL = """select k.kept, d.doc_id as duplicate from documents d
join (select text, min(doc_id) as kept from documents group by text having count(*) > 1) k on k.text = d.text where d.doc_id <> k.kept"""


@register("d1_exact_duplicates", EXACT_SQL)
def d1(spark, d):
    return dedup.exact_duplicates(documents(spark, d))


SAMPLE_SQL = f"""select filename as key, source from (
  select *, row_number() over (partition by source order by md5(concat('42|', filename)), filename) as rn,
    count(*) over (partition by source) as n, count(*) over () as total from pool) x
where total <= {SAMPLE} or rn <= greatest(1, round_even(cast(n as double) / total * {SAMPLE}, 0))"""


def files(spark, d):
    return pool(spark, d).select(F.col("filename").alias("key"), "source")


@register("d2_stratified_sample", with_views(SAMPLE_SQL, "pool"))
def d2(spark, d):
    return dedup.stratified_sample(files(spark, d), SAMPLE)


@register("d3_first_files", with_views("select filename as key, source from pool order by filename limit 150", "pool"))
def d3(spark, d):
    return dedup.first_by_key(files(spark, d), 150)


VECTORS_SQL = """select vec_id as key, cast(embedding as double[]) as vec from embeddings
union all select vec_id + 1000000, cast(embedding as double[]) from embeddings where label = 3"""
REPS_SQL = "select min(key) as key, vec from vectors group by vec"
PAIRS_SQL = f"""select a.key as a, b.key as b, list_distance(a.vec, b.vec) as distance from reps a join reps b on a.key < b.key
where list_distance(a.vec, b.vec) < {NEAR}"""
COPIES_SQL = "select r.key, v.key as copy from vectors v join reps r on r.vec = v.vec where v.key <> r.key"
GREEDY = {
    "vectors": VECTORS_SQL,
    "reps": REPS_SQL,
    "pairs": PAIRS_SQL,
    "ord": "select key, row_number() over (order by md5(concat('42|', cast(key as varchar))), key) as i from reps",
    "sides": "select a, b, distance from pairs union all select b, a, distance from pairs",
    "earlier": """select o.key, o.i, coalesce(list(p.b) filter (where q.i < o.i), []) as nbrs from ord o
  left join sides p on p.a = o.key left join ord q on q.key = p.b group by o.key, o.i""",
    "greedy": """select cast(0 as bigint) as i, cast([] as bigint[]) as kept union all
  select e.i, case when list_has_any(g.kept, e.nbrs) then g.kept else list_append(g.kept, e.key) end
  from greedy g join earlier e on e.i = g.i + 1""",
    "kept": "select unnest(kept) as key from (select kept from greedy order by i desc limit 1) x",
    "near": """select o.key as duplicate, arg_min(b.b, struct_pack(d := b.distance, k := b.b)) as kept, min(b.distance) as distance
  from ord o join sides b on b.a = o.key join kept k on k.key = b.b where o.key not in (select key from kept) group by o.key""",
    "copies": COPIES_SQL,
    "dups": """select duplicate, kept, distance from near union all
  select c.copy, coalesce(n.kept, c.key), coalesce(n.distance, 0) from copies c left join near n on n.duplicate = c.key""",
}


def vectors(spark, d):
    """All embeddings, and an exact copy of those of one label under another key."""
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("key"), F.col("embedding").alias("vec")).unionByName(
        e.where("label = 3").select((F.col("vec_id") + 1000000).alias("key"), F.col("embedding").alias("vec"))
    )


@register(
    "d4_near_pairs",
    with_views(
        "select a, b, round(distance, 6) as distance from pairs union all select key, copy, 0 from copies",
        **{k: GREEDY[k] for k in ("vectors", "reps", "pairs", "copies")},
    ),
)
def d4(spark, d):
    found = dedup.near_pairs(vectors(spark, d), NEAR)
    return found.select("a", "b", F.round("distance", 6).alias("distance"))


def near_kept(spark, d):
    """The stored result of one near search, which all that follows reads."""
    return once(spark, d, "near", lambda: dedup.near_duplicates(vectors(spark, d), NEAR))


LINKS = {
    "links": f"select a.key as a, b.key as b from vectors a join vectors b on a.key <> b.key where list_distance(a.vec, b.vec) < {NEAR}",
    "reach": "select key as n, key as r from vectors union select l.b, r.r from reach r join links l on l.a = r.n",
}


@register(
    "d4_near_links",
    with_views(
        """select c.key, c.class_id, (select count(*) from links l where l.a = c.key) as links
from (select n as key, min(r) as class_id from reach group by n) c""",
        vectors=VECTORS_SQL,
        **LINKS,
    ),
)
def d4_links(spark, d):
    """The same links in one row per vector: its class and how many it has."""
    return dedup.near_links(vectors(spark, d), NEAR)


@register("d5_near_kept", with_views("select v.key from vectors v where v.key not in (select duplicate from dups)", **GREEDY))
def d5(spark, d):
    return vectors(spark, d).select("key").join(near_kept(spark, d).select(F.col("duplicate").alias("key")), "key", "left_anti")


@register("d6_nearest_kept", with_views("select duplicate, kept, round(distance, 4) as distance from dups", **GREEDY))
def d6(spark, d):
    return near_kept(spark, d).select("duplicate", "kept", F.round("distance", 4).alias("distance"))


@register(
    "d7_dedup_coverage",
    with_views(
        """select (select count(*) from vectors) as images_checked, (select count(*) from vectors) as near_duplicate_sample_size,
  'full pool' as near_duplicate_sample_method, (select count(distinct key) from copies) as exact_duplicate_groups,
  (select count(*) from copies) as exact_duplicate_files, (select count(distinct kept) from dups) as near_duplicate_groups,
  (select count(*) from dups) as near_duplicate_files""",
        **GREEDY,
    ),
)
def d7(spark, d):
    """One pool for all figures: the vectors, whose equal components are equal content."""
    v = vectors(spark, d)
    exact = dedup.exact_duplicates(v.select("key", F.sha2(F.to_json("vec"), 256).alias("content")))
    return dedup.coverage(v, v, exact, near_kept(spark, d), "full pool")


# --- split -----------------------------------------------------------------------------------------
# Groups overlap: equal content, equal content but for digits and blanks, equal language and length.
SPLIT = {
    "live": "select filename as key, source from pool",
    "members": """select concat('c', content_key) as grp, filename as key from pool union select concat('b', body_key), filename from pool
union select concat('s', size_key), filename from pool""",
    "present": "select m.grp, m.key from members m join live l on l.key = m.key",
    "heads": "select grp, min(key) as head from present group by grp",
    "edges": "select distinct h.head as a, p.key as b from present p join heads h on h.grp = p.grp where h.head <> p.key",
    "sym": "select a, b from edges union select b, a from edges",
    "reach": "select key as n, key as r from live union select s.b, r.r from reach r join sym s on s.a = r.n",
    "comp": "select n as key, min(r) as root from reach group by n",
    "drawn": """select l.key, l.source, md5(concat('42|', l.key)) as draw from live l join comp c on c.key = l.key where c.root = l.key""",
    "placed": """select key, source, case when rn <= nt then 'train' when rn <= nt + nv then 'val' else 'test' end as split from (
  select *, round_even(cast(n as double) * cast(0.7 as double), 0) as nt, round_even(cast(n as double) * cast(0.15 as double), 0) as nv from (
    select *, row_number() over (partition by source order by draw, key) as rn, count(*) over (partition by source) as n from drawn) x) y""",
    "assigned": "select l.key, l.source, p.split from live l join comp c on c.key = l.key join placed p on p.key = c.root",
}


def live(spark, d):
    return files(spark, d)


def members(spark, d):
    p = pool(spark, d)
    keys = [("c", "content_key"), ("b", "body_key"), ("s", "size_key")]
    groups = F.array(*[F.concat(F.lit(tag), F.col(c)) for tag, c in keys])
    return p.select(F.explode(groups).alias("grp"), F.col("filename").alias("key"))


def roots(spark, d):
    return comp.components(comp.group_edges(members(spark, d), live(spark, d)))


def known_roots(spark, d):
    return once(spark, d, "roots", lambda: roots(spark, d))


def assigned(spark, d):
    """The stored assignment that the checks after the split read."""
    return once(spark, d, "assigned", lambda: split.assign(live(spark, d), known_roots(spark, d)))


@register(
    "p1_coverage_gate",
    """select source, checked, sampled, pool, checked >= pool as applies, checked >= pool and sampled >= checked as full_scale
from (select d.source, count(*) as pool, sum(case when d.lang = 'en' then 2 else 1 end)::bigint as checked, count(distinct d.n_chars) as sampled
from documents d group by d.source) x""",
)
def p1(spark, d):
    docs = table(spark, d, "documents")
    counts = docs.groupBy("source").agg(
        F.count(F.lit(1)).alias("pool"),
        F.sum(F.when(F.col("lang") == "en", 2).otherwise(1)).alias("checked"),
        F.count_distinct("n_chars").alias("sampled"),
    )
    return split.coverage_gate(counts)


def _sql(body: str, last: str, **extra: str) -> str:
    names = list(SPLIT)
    return with_views(body, "pool", **{k: SPLIT[k] for k in names[: names.index(last) + 1]}, **extra)


# P2's own feature: members that are no longer in the pool are left out, here those of one source.
@register("p2_group_edges", _sql("select a, b from edges", "edges").replace(SPLIT["live"], SPLIT["live"] + " where source <> 'src0'"))
def p2(spark, d):
    return comp.group_edges(members(spark, d), live(spark, d).where("source <> 'src0'"))


@register("p3_components", _sql("select l.key, l.source, c.root from live l join comp c on c.key = l.key", "comp"))
def p3(spark, d):
    return comp.labelled(live(spark, d), roots(spark, d)).select("key", "source", "root")


@register("p4_units_per_source", _sql("select source, count(*) as units from drawn group by source", "drawn"))
def p4(spark, d):
    return split.units(live(spark, d), known_roots(spark, d)).groupBy("source").agg(F.count(F.lit(1)).alias("units"))


@register("p5_assigned_splits", _sql("select key, source, split from assigned", "assigned"))
def p5(spark, d):
    return split.assign(live(spark, d), roots(spark, d))


@register(
    "p6_completeness",
    _sql(
        """select sum(case when a.key is null then 1 else 0 end)::bigint as unassigned, (select count(*) from assigned where key not in (select key from live)) as foreign,
  (select count(*) from (select key from assigned group by key having count(*) > 1) x) as repeated,
  sum(case when a.split not in ('train', 'val', 'test') then 1 else 0 end)::bigint as bad_split from live l left join assigned a on a.key = l.key""".replace("as foreign", 'as "foreign"'),
        "assigned",
    ),
)
def p6(spark, d):
    return split.completeness(live(spark, d), assigned(spark, d))


@register(
    "p7_leaks_without_groups",
    _sql(
        """select grp, count(*) as members, count(distinct split) as splits from present p join naive a on a.key = p.key group by grp having count(distinct split) > 1""",
        "heads",
        naive="""select key, case when rn <= round_even(cast(n as double) * cast(0.7 as double), 0) then 'train'
  when rn <= round_even(cast(n as double) * cast(0.7 as double), 0) + round_even(cast(n as double) * cast(0.15 as double), 0) then 'val' else 'test' end as split
from (select *, row_number() over (partition by source order by md5(concat('42|', key)), key) as rn, count(*) over (partition by source) as n from live) x""",
    ),
)
def p7_naive(spark, d):
    """What the gate reports when duplicates are split as if they were unrelated."""
    pool_ = live(spark, d)
    none = pool_.select("key", F.col("key").alias("root")).where("false")
    return split.require_no_leaks(members(spark, d), split.assign(pool_, none), preview=True)


@register(
    "p7_leaks",
    _sql("select grp, count(*) as members, count(distinct split) as splits from present p join assigned a on a.key = p.key group by grp having count(distinct split) > 1", "assigned"),
)
def p7(spark, d):
    """The hard gate on the real assignment: it raises unless this is empty."""
    return split.require_no_leaks(members(spark, d), assigned(spark, d))


@register("p8_split_sizes", _sql("select s.split, count(a.key) as images from (values ('train'), ('val'), ('test')) s(split) left join assigned a on a.split = s.split group by s.split", "assigned"))
def p8(spark, d):
    return split.split_sizes(assigned(spark, d))


LABELLED = {
    "marks": """select concat(d.source, '__', lpad(cast(d.doc_id as varchar), 9, '0')) as key,
  cast(case when l.quality = 1 and l.toxic = 1 then 16 else l.quality + 2 * l.toxic end as int) as class_id
from labels l join documents d on d.doc_id = l.doc_id"""
}


def marks(spark, d):
    """One box per labelled document; ids of one combination lie outside the class list."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    class_id = F.when((F.col("quality") == 1) & (F.col("toxic") == 1), 16).otherwise(F.col("quality") + 2 * F.col("toxic"))
    key = F.concat_ws("__", "source", F.lpad(F.col("doc_id").cast("string"), 9, "0"))
    return by_shuffle(table(spark, d, "labels")).join(by_shuffle(docs), "doc_id").select(key.alias("key"), class_id.cast("int").alias("class_id"))


@register("p9_missing_labels", _sql("select * from assigned a where key not in (select key from marks)", "assigned", **LABELLED))
def p9(spark, d):
    return split.missing_labels(assigned(spark, d), marks(spark, d))


@register(
    "p10_class_distribution",
    _sql(
        """select s.split, c.class_id, count(distinct m.key) as images, count(m.key) as instances
from (values ('train'), ('val'), ('test')) s(split) cross join classes c
left join (select a.split, m.* from marks m join assigned a on a.key = m.key) m on m.split = s.split and m.class_id = c.class_id group by 1, 2""",
        "assigned",
        **LABELLED,
        classes=sp.CLASSES,
    ),
)
def p10_class(spark, d):
    m = marks(spark, d)
    return split.distribution(assigned(spark, d), m, m)[0]


@register(
    "p10_source_distribution",
    _sql("select split, source, count(*) as label_files from assigned a where key in (select key from marks) group by 1, 2", "assigned", **LABELLED),
)
def p10_source(spark, d):
    m = marks(spark, d)
    return split.distribution(assigned(spark, d), m, m)[1]


@register(
    "p10_unknown_classes",
    _sql("select m.class_id, count(*) as instances from marks m join assigned a on a.key = m.key where m.class_id not between 0 and 15 group by 1", "assigned", **LABELLED),
)
def p10_unknown(spark, d):
    m = marks(spark, d)
    return split.distribution(assigned(spark, d), m, m)[2]
