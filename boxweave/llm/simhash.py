"""Near duplicates by SimHash with a segment-popcount grid.

A fingerprint's embedding is the number of set bits in each of its segments. The Manhattan distance of two
embeddings never exceeds the Hamming distance of the fingerprints, so the embedding is a grid in which
near fingerprints are near. Two points at distance 2 or less always share a grid point within distance 1
of both: each fingerprint is put on its own point and all neighbouring ones, and an equi-join on points
finds every candidate, which is then compared bit by bit.

Grid points with more than ``CROWD`` fingerprints are refined to segments of one bit. There the bound is
the Hamming distance itself: fingerprints that share a point are within 2 bits of one another, so a star
to the smallest one keeps all of them connected and no pairs are formed. Nothing is dropped on either path.

A null text counts as the empty one; a text without words has the zero fingerprint, which links like any
other; texts of any length are hashed whole; equal fingerprints are one node, so copies form no pairs;
null doc_ids never name a component unless it has no other; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are ignored by ``components`` and kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from boxweave.llm.common import keyed_texts, map_batches
from boxweave.operators.components import components as connected
from boxweave.runtime import cut_lineage, join_on_group

WORDS = 3
SEED = 42
# Differing bits that still link; the grid's neighbourhoods are made for 2.
NEAR_BITS = 2
SEGMENT_BITS = 4
CROWD = 16


def fingerprint(text: str, words: int = WORDS) -> int:
    """The bits that more than half of the shingle hashes set, repeats included; a text without words has 0."""
    from xxhash import xxh64_intdigest

    parts = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not parts:
        return 0
    joined = memoryview(b" ".join(parts))
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    width = min(words, len(parts))
    starts, stops = (ends - sizes)[: len(parts) - width + 1], ends[width - 1 :]
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        some = np.array(hashes[at : at + (1 << 15)], "<u8")
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.flatnonzero(2 * ones > len(hashes))
    return sum(1 << int(b) for b in bits)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed 64-bit number."""

    def make():
        def step(batch):
            out = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
            return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(out.view(np.int64), pa.int64())], ["doc_id", "fp"])

        return step

    return map_batches(keyed_texts(docs), make, "doc_id long, fp long")


def _points(fp: Column, bits: int) -> Column:
    """The grid points within Manhattan distance 1 of a fingerprint, as packed numbers.

    With segments of one bit a packed point is a fingerprint again: the own one and those one bit away.
    """
    if bits == 1:
        return F.array(fp, *(fp.bitwiseXOR(F.lit(1).cast("long") if i == 0 else F.shiftleft(F.lit(1).cast("long"), i)) for i in range(64)))
    width = bits.bit_length()
    counts = [F.bit_count(F.shiftrightunsigned(fp, i * bits).bitwiseAND(F.lit((1 << bits) - 1))).cast("long") for i in range(64 // bits)]
    own = counts[0]
    for i, c in enumerate(counts[1:], 1):
        own = own + F.shiftleft(c, i * width)
    near = []
    for i, c in enumerate(counts):
        step = F.lit(1 << (i * width)).cast("long")
        near += [F.when(c < bits, own + step), F.when(c > 0, own - step)]
    return F.array_compact(F.array(own, *near))


def links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all fingerprints of ``nodes`` (fp) within NEAR_BITS, without forming all pairs."""
    # Stored: the expression of all points is long, and several plans read them.
    placed = cut_lineage(nodes.select("fp", F.explode(_points(F.col("fp"), SEGMENT_BITS)).alias("point")), "placed")
    # The planner sizes the points by the table they come from, a few tens of times too small to broadcast them.
    sizes = placed.groupBy("point").agg(F.count(F.lit(1)).alias("size")).where("size > 1").hint("merge")
    shared = cut_lineage(join_on_group(placed, sizes, ["point"], "size"), "points")
    few = shared.where(F.col("size") <= CROWD).select("fp", "point")
    other = few.select(F.col("fp").alias("other"), "point")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= NEAR_BITS
    pairs = few.join(other, "point").where((F.col("fp") < F.col("other")) & near).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    crowd = shared.where(F.col("size") > CROWD).select("fp").distinct()
    fine = crowd.select("fp", F.explode(_points(F.col("fp"), 1)).alias("point"))
    heads = fine.groupBy("point").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("size")).where("size > 1").hint("merge")
    stars = join_on_group(fine, heads, ["point"], "size").where(F.col("fp") != F.col("a")).select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable over links; fingerprints are made once and stored."""
    marked = cut_lineage(fingerprints(docs), "fingerprints")
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size")), "nodes")
    roots = connected(links(nodes)).withColumnRenamed("key", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
    named = join_on_group(rooted, least, ["root"], "members").select("fp", "size", "component_id")
    return join_on_group(marked, cut_lineage(named, "named"), ["fp"], "size").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one of the smallest id.

    Equal rows of one id and text stay once; rows with a null doc_id cannot be named and stay.
    """
    linked = components(docs)
    lost = linked.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(lost, "doc_id", "left_anti")
    again = linked.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    single = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, "doc_id", "left_anti").unionByName(single).select(docs.columns)
