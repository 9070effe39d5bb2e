"""Near copies by resemblance of word shingles: candidates by bands of least hashes or by exact prefixes, all verified.

Two texts are near copies if the sets of their shingles of ``WORDS`` words have a Jaccard resemblance of at least
4/5; near copies of near copies belong together. A set's least hashes under ``BANDS`` times ``ROWS`` orders agree with
those of another by chance equal to their resemblance, so of two sets at 4/5 some band of ``ROWS`` agrees with
probability 1 - (1 - 0.8^5)^20 = 0.9996, above it with more; an equi-join on bands finds them. With ``exact`` the join
is on prefixes instead: in one fixed order of all shingles, common ones last, sets that resemble each other so much
share one of the first n/5 + 1 shingles of both, so every pair is found, at five times the rows. Each set also has counts
of its shingles by ``BINS`` bins, which differ by no more than the sets do: pairs whose counts differ too much are
out, and the texts of the others are compared by all their shingles.

Pairs are formed only where they can still connect something: first each text is compared with those that ``simhash``
finds within 2 bits of its fingerprint, made of the same shingles, by the grid of segment popcounts, with the smallest one
it shares a band with and with the one that shares most, as the original of many copies does, and after that only texts
of different components are paired. Fingerprints of edited copies differ by up to some ten bits, more than a grid can
reach, so the bands stay beside it and all that either finds is compared by shingles. Where more than ``CROWD`` components are left in a band, its texts are paired by
prefixes, exactly: a copy edited too much to resemble any other has a prefix of its own shingles alone, and a shingle
so far back in a set that what follows can no longer make 4/5 of the sets at that point pairs nothing.

Words are split at white space and lower-cased; a text of fewer than ``WORDS`` words is one shingle; a null text
counts as the empty one, and texts without words are copies of one another; texts are read whole; texts with equal
64-bit hashes of their shingle sets are one node; of equal rows one stays, and rows with a null doc_id count like
others; an empty table gives an empty result; other columns are kept whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxweave.llm import simhash
from boxweave.llm.common import keyed_texts, map_batches
from boxweave.llm.sketch import Sketcher
from boxweave.operators.components import components as connected
from boxweave.runtime import BROADCAST_ROWS, cut_lineage, discard, join_on_group, setting, write_counted

WORDS = 5
BANDS, ROWS = 20, 5
SEED = 11
CROWD = 16
# Texts whose shingles are counted to put common ones last, and the most that are told apart. Results never depend on them.
SAMPLE_TEXTS = 4_000
COMMON = 200_000
BINS = 128
# Bytes of texts in a batch that a task hands to Python: two texts a row are compared at once.
BATCH_BYTES = 4 << 20
KEY = ["doc_id", "text_key"]


class Scratch:
    """Tables of one run, deleted together at its end."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return self.keep_counted(df, name)[0]

    def keep_counted(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        kept, rows, path = write_counted(df, name)
        self.paths.append(path)
        return kept, rows

    def clear(self) -> None:
        for path in self.paths:
            discard(self.spark, path)


def shingle_set(text: str) -> set[str]:
    words = text.lower().split()
    width = min(WORDS, len(words))
    return {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def alike(a: set, b: set) -> bool:
    both = len(a & b)
    return 5 * both >= 4 * (len(a) + len(b) - both)


def _keyed(docs: DataFrame) -> DataFrame:
    return keyed_texts(docs).withColumn("text_key", F.xxhash64("text"))


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the shingles that several texts of a bounded sample hold, by hash."""
    n = docs.count()
    some = keyed_texts(docs).select("text").where(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1_000_003)) <= int(1_000_003 * min(1.0, SAMPLE_TEXTS / max(n, 1))))

    def run(batches):
        tool = Sketcher(WORDS)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(tool.shingles(text)).astype(np.int64))], ["shingle"])

    counts = some.distinct().mapInArrow(run, "shingle long").groupBy("shingle").count().where("count > 1")
    rows = counts.orderBy(F.desc("count"), "shingle").limit(COMMON).toPandas().sort_values("shingle")
    return rows["shingle"].to_numpy(np.int64), rows["count"].to_numpy(np.int64)


class Bands:
    """Hashes of a set's bands: equal for two sets whose least hashes agree in all rows of the band."""

    def __init__(self):
        draw = np.random.default_rng(SEED)
        self.factor, self.shift = (draw.integers(1, 1 << 63, (BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
        self.join = draw.integers(1, 1 << 63, (1, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
        self.number = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        if not len(h):
            return np.empty(0, np.int64)
        slices = (h[None, at : at + 4096] for at in range(0, len(h), 4096))
        least = np.minimum.reduce([(x * self.factor + self.shift).min(axis=1) for x in slices]).reshape(BANDS, ROWS)
        mixed = ((least ^ (least >> np.uint64(29))) * self.join).sum(axis=1, dtype=np.uint64) + self.number
        return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


class Prefixes:
    """The first n/5 + 1 shingles of a set, common ones last."""

    def __init__(self, common: np.ndarray, counts: np.ndarray):
        self.common, self.counts = common, counts

    def __call__(self, h: np.ndarray) -> np.ndarray:
        h = h.astype(np.int64)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, h), len(self.common) - 1)
            h = h[np.argsort(np.where(self.common[at] == h, self.counts[at], 0), kind="stable")]
        return h[: len(h) // 5 + 1]


def marked(docs: DataFrame, exact: bool = False) -> DataFrame:
    """(doc_id, text_key, fp, sim, n, bins, points): the node of every row, its SimHash, the size of its set, its counts by bins, where it meets others."""
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs)) if exact else None

    def make():
        from xxhash import xxh64_intdigest

        tool, points_of = Sketcher(WORDS), Prefixes(*shared.value) if exact else Bands()

        def step(batch):
            fps, sims, sizes, bins, points = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                h = np.unique(tool.shingles(text))
                fps.append(xxh64_intdigest(h.tobytes()))
                sims.append(simhash.fingerprint(text, WORDS))
                sizes.append(len(h))
                bins.append(np.minimum(np.bincount((h % np.uint64(BINS)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes())
                points.append(points_of(h))
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(2), *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (fps, sims)), pa.array(sizes, pa.int64()), pa.array(bins, pa.binary()), pa.array(points, pa.list_(pa.int64()))],
                [*KEY, "fp", "sim", "n", "bins", "points"],
            )

        return step

    return map_batches(_keyed(docs), make, "doc_id long, text_key long, fp long, sim long, n long, bins binary, points array<long>")


def _possible(pairs: DataFrame, nodes: DataFrame, total: int) -> DataFrame:
    """The ``pairs`` (a, b), ``total`` in number, whose counts by bins do not rule them out."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                n, m = (batch.column(i).to_numpy() for i in (2, 4))
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16) for i in (3, 5))
                # Of sets of n and m with a resemblance of 4/5, (n + m) / 9 elements at most are in one only.
                yield batch.select(["a", "b"]).filter(pa.array(9 * np.abs(x - y).sum(1, dtype=np.int64) <= n + m))

    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("size"))
    heads = sizes.join(nodes.select(F.col("fp").alias("a"), "n", "bins"), "a")
    both = join_on_group(pairs, heads, ["a"], "size", total).join(nodes.select(F.col("fp").alias("b"), F.col("n").alias("m"), F.col("bins").alias("other")), "b")
    return both.select("a", "b", "n", "bins", "m", "other").mapInArrow(run, "a long, b long")


def _texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(fp, text) of the ``wanted`` nodes (fp)."""
    named, rows = scratch.keep_counted(nodes.join(wanted, "fp").select("fp", F.col("doc_id").alias("id"), F.col("text_key").alias("hash")), "named")
    # A row of a repeated id is told from the others by its text. Three numbers a row: counted, it goes by broadcast.
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("hash"))
    return _keyed(docs).join(F.broadcast(named) if rows <= BROADCAST_ROWS else named, same).select("fp", "text").dropDuplicates(["fp"])


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The ``pairs`` (a, b) of nodes whose texts are near copies; stored before they are read, as several joins do."""
    pairs, total = scratch.keep_counted(pairs, "pairs")
    pairs, total = scratch.keep_counted(_possible(pairs, nodes, total), "possible")
    texts = scratch.keep(_texts(pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct(), nodes, docs, scratch), "texts")

    def run(batches):
        last, held = None, set()
        for batch in batches:
            a, b, text, other = (c.to_pylist() for c in batch.columns)
            good = []
            for x, t, o in zip(a, text, other):
                if x != last:
                    last, held = x, shingle_set(t)
                good.append(alike(held, shingle_set(o)))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("size"))
    heads = sizes.join(texts.withColumnRenamed("fp", "a"), "a")
    both = join_on_group(pairs, heads, ["a"], "size", total).join(texts.select(F.col("fp").alias("b"), F.col("text").alias("other")), "b")
    return both.select("a", "b", "text", "other").mapInArrow(run, "a long, b long")


def _across(rooted: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts of different components at one point whose sizes allow a resemblance of 4/5."""
    groups = rooted.groupBy("point", "root").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    others = groups.select("point", *(F.col(c).alias(f"{c}_b") for c in ("root", "least", "most")))
    fits = (F.col("root") < F.col("root_b")) & (4 * F.col("least") <= 5 * F.col("most_b")) & (4 * F.col("least_b") <= 5 * F.col("most"))
    across = groups.join(others, "point").where(fits).select("point", "root", "root_b")
    left = rooted.select("point", "root", F.col("fp").alias("x"), F.col("n").alias("n_x"))
    right = rooted.select("point", F.col("root").alias("root_b"), F.col("fp").alias("y"), F.col("n").alias("n_y"))
    pairs = across.join(left, ["point", "root"]).join(right, ["point", "root_b"]).where((4 * F.col("n_x") <= 5 * F.col("n_y")) & (4 * F.col("n_y") <= 5 * F.col("n_x")))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _useful(placed: DataFrame) -> DataFrame:
    """Rows (fp, n, i, point, root) of prefixes that can still belong to a pair at their point.

    From the i-th shingle on a set of n has n - i left; with a set of m it has to share 4/9 (n + m), and m is at least 4n/5
    and at least the smallest at the point.
    """
    least = placed.groupBy("point").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("size")).where("size > 1").hint("merge")
    there = join_on_group(placed, least, ["point"], "size")
    m = F.greatest(F.ceil(F.col("n") * 4 / 5), F.col("least"))
    return there.where(9 * (F.col("n") - F.col("i")) >= 4 * (F.col("n") + m)).select("fp", "n", "root", "point")


def _prefixed(texts: DataFrame) -> DataFrame:
    """(fp, root, n, i, point) of (fp, root, text): the prefix of every set by the counts of the shingles among these texts."""
    shared = texts.sparkSession.sparkContext.broadcast(common_shingles(texts.select(F.col("fp").alias("doc_id"), "text")))

    def make():
        tool, prefix_of = Sketcher(WORDS), Prefixes(*shared.value)

        def step(batch):
            sets = [np.unique(tool.shingles(text)) for text in batch.column(2).to_pylist()]
            prefixes = [prefix_of(h) for h in sets]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(h) for h in sets], pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))],
                ["fp", "root", "n", "prefix"],
            )

        return step

    found = map_batches(texts.select("fp", "root", "text"), make, "fp long, root long, n long, prefix array<long>")
    return found.select("fp", "root", "n", F.posexplode("prefix").alias("i", "point"))


def _rest(rooted: DataFrame, nodes: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of different components that share a band; those of crowded bands share a useful prefix shingle."""
    roots = rooted.groupBy("point").agg(F.count_distinct("root").alias("roots"))
    crowded = scratch.keep(roots.where(F.col("roots") > CROWD).select("point"), "crowded")
    if crowded.isEmpty():
        return _across(rooted)
    inside = scratch.keep(rooted.join(crowded, "point", "left_semi").select("fp", "root").distinct(), "inside")
    # A text is joined with its root before its prefix is taken: one row then, up to thousands after.
    texts = scratch.keep(_texts(inside.select("fp"), nodes, docs, scratch).join(inside, "fp"), "crowd")
    fine = scratch.keep(_useful(scratch.keep(_prefixed(texts), "prefixed")), "fine")
    return _across(rooted.join(crowded, "point", "left_anti")).unionByName(_across(fine)).distinct()


def fingerprint_links(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of nodes that connect all whose fingerprints ``sim`` are equal or within the bits that ``simhash`` links."""
    sims = scratch.keep(nodes.groupBy("sim").agg(F.min("fp").alias("head"), F.count(F.lit(1)).alias("size")), "sims")
    same = join_on_group(nodes.select("sim", "fp"), sims.where("size > 1"), ["sim"], "size").select("head", "fp").where("head != fp")
    near = scratch.keep(simhash.links(sims.select(F.col("sim").alias("fp"))), "near")
    for side in ("a", "b"):
        near = near.join(sims.select(F.col("sim").alias(side), F.col("head").alias(f"{side}_fp")), side)
    return near.select("a_fp", "b_fp").unionByName(same.toDF("a_fp", "b_fp")).select(F.least("a_fp", "b_fp").alias("a"), F.greatest("a_fp", "b_fp").alias("b"))


def links(nodes: DataFrame, docs: DataFrame, scratch: Scratch, exact: bool = False) -> DataFrame:
    """Edges (a, b) that connect all near copies among ``nodes`` (fp, sim, n, bins, points, doc_id, text_key)."""
    placed = nodes.select("fp", "n", F.posexplode("points").alias("i", "point"))
    sizes = placed.groupBy("point").agg(F.count(F.lit(1)).alias("size")).where("size > 1").hint("merge")
    shared = scratch.keep(join_on_group(placed, sizes, ["point"], "size"), "shared")
    # What a text shares at all its points: the original of many copies shares most.
    weights = shared.groupBy("fp").agg(F.sum("size").alias("weight"))
    weighed = shared.select("fp", "point", "size").join(weights, "fp")
    ends = scratch.keep(
        weighed.groupBy("point").agg(F.min("fp").alias("low"), F.max(F.struct("weight", "fp")).alias("most"), F.first("size").alias("size")), "ends"
    )
    met = join_on_group(shared.select("fp", "point"), ends, ["point"], "size")
    tops = met.groupBy("fp").agg(F.min("low").alias("low"), F.max(F.when(F.col("most.fp") != F.col("fp"), F.col("most"))).alias("most"))
    stars = tops.select(F.explode(F.array_compact(F.array("low", "most.fp"))).alias("end"), "fp").where("end != fp")
    stars = stars.select(F.least("end", "fp").alias("a"), F.greatest("end", "fp").alias("b"))
    stars = stars.unionByName(fingerprint_links(nodes, scratch)).distinct()
    first = scratch.keep(_verified(stars, nodes, docs, scratch), "stars")
    roots = connected(first).withColumnRenamed("key", "fp")
    rooted = scratch.keep(shared.select("fp", "n", "i", "point").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    rest = _across(_useful(rooted)) if exact else _rest(rooted, nodes, docs, scratch)
    return first.unionByName(_verified(rest, nodes, docs, scratch))


def components(docs: DataFrame, exact: bool = False) -> DataFrame:
    """(doc_id, text_key, root) of every row, stored: rows of one root are near copies, directly or over others."""
    scratch = Scratch(docs.sparkSession)
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES):
        marks = scratch.keep(marked(docs, exact), "marked")
        nodes = marks.groupBy("fp").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(*KEY, "sim", "n", "bins", "points")).alias("head"))
        nodes = scratch.keep(nodes.select("fp", "size", "head.*"), "nodes")
        roots = connected(scratch.keep(links(nodes, docs, scratch, exact), "links")).withColumnRenamed("key", "fp")
        rooted = nodes.join(roots, "fp", "left").select("fp", "size", F.coalesce("root", "fp").alias("root"))
        named = cut_lineage(join_on_group(marks.select(*KEY, "fp"), scratch.keep(rooted, "named"), ["fp"], "size").select(*KEY, "root"), "rows")
    scratch.clear()
    return named


def _unused(columns: list[str], name: str) -> str:
    while name.lower() in (c.lower() for c in columns):
        name += "_"
    return name


def keep_one(docs: DataFrame, exact: bool = False) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id, null last, then the smallest hash of its text."""
    linked = components(docs, exact)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    heads = linked.groupBy("root").agg(F.min(order).alias("head")).select("head.doc_id", "head.text_key")
    own, the_id, the_key = (_unused(docs.columns, name) for name in ("text_key", "kept_id", "kept_key"))
    wanted = cut_lineage(heads.select(F.col("doc_id").alias(the_id), F.col("text_key").alias(the_key)), "heads")
    same = F.col("doc_id").eqNullSafe(F.col(the_id)) & (F.col(own) == F.col(the_key))
    kept = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit("")))).join(wanted, same, "left_semi")
    again = linked.groupBy(*KEY).count().where("count > 1").select(F.col("doc_id").alias(the_id), F.col("text_key").alias(the_key))
    again = cut_lineage(again, "again")
    if again.isEmpty():
        return kept.select(docs.columns)
    single = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", own])
    return kept.join(again, same, "left_anti").unionByName(single).select(docs.columns)
