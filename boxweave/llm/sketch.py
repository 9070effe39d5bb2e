"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the ``SIZE`` smallest distinct 48-bit hashes of a text's shingles, ascending. Sketches of parts
merge into the sketch of the whole, and two of them estimate resemblance, containment and distinct
shingle counts. Words are split at white space and lower-cased; a text of fewer than five words is one
shingle; a text without words has the empty sketch.

A null text counts as the empty one; two empty sketches resemble each other fully, an empty and another
one not at all; texts of any length are read whole; repeated rows get equal sketches; in the order of
documents equal doc_ids follow by text and null doc_ids come first; a single document is its own
successor; an empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from base64 import b64decode, b64encode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from boxweave.llm.common import Memo, keyed_texts, map_batches, part_of

SIZE = 128
WORDS = 5
BITS = 48
NEIGHBOURS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_shingles double, edited_n_shingles double, contained_in_edited double"
)


def _mixed(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Sketcher:
    """Makes sketches; remembers word hashes."""

    def __init__(self, words: int = WORDS, size: int = SIZE):
        from xxhash import xxh64_intdigest

        self.words, self.size = words, size
        self.memo = Memo(lambda w: xxh64_intdigest(w))

    def shingles(self, text: str) -> np.ndarray:
        """48-bit hashes of all shingles, repeats included."""
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        width = min(self.words, len(h))
        out = np.full(len(h) - width + 1, width, np.uint64)
        for i in range(width):
            out = _mixed(out + h[i : len(h) - width + 1 + i] * np.uint64(2 * i + 1))
        return out >> np.uint64(64 - BITS)

    def sketch(self, text: str) -> np.ndarray:
        return smallest(self.shingles(text), self.size)


def smallest(h: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The ``size`` smallest distinct values: a growing share is cut off first, so most values are never sorted."""
    take = 2 * size
    while take < len(h):
        low = np.unique(np.partition(h, take - 1)[:take])
        if len(low) >= size:
            return low[:size]
        take *= 4
    return np.unique(h)[:size]


def to_text(sketch: np.ndarray) -> str:
    return b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    six = np.frombuffer(b64decode(text), np.uint8).reshape(-1, 6)
    return np.hstack([np.zeros((len(six), 2), np.uint8), six]).copy().view(">u8").ravel().astype(np.uint64)


def distinct_count(sketch: np.ndarray, size: int = SIZE) -> float:
    """Estimated number of distinct shingles; exact below ``size``."""
    return float(len(sketch)) if len(sketch) < size else (size - 1) * float(1 << BITS) / (float(sketch[size - 1]) + 1)


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Share of the union's bottom-k that both sketches hold."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:size]
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean())


def containment(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated share of the first text's distinct shingles that the second one has."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, size) * distinct_count(np.union1d(a, b)[:size], size)
    return min(1.0, both / distinct_count(a, size))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, n_shingles) of every document."""

    def make():
        tool = Sketcher()

        def step(batch):
            out = [tool.sketch(t) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([to_text(s) for s in out], pa.string()), pa.array([distinct_count(s) for s in out], pa.float64())],
                ["doc_id", "fingerprint", "n_shingles"],
            )

        return step

    return map_batches(keyed_texts(docs), make, "doc_id long, fingerprint string, n_shingles double")


def merge(parts: DataFrame, key: str) -> DataFrame:
    """One fingerprint per ``key`` from those of its parts.

    Hashes are made distinct and cut to the smallest ``SIZE`` per task before the shuffle, so a key with a
    third of the rows sends no more than one sketch per task.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, out = [], []
            for k, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = from_text(f or "").astype(np.int64).tolist() or [None]
                keys += [k] * len(values)
                out += values
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), pa.array(out, pa.int64())], ["key", "h"])

    kind = parts.schema[key].dataType.simpleString()
    single = parts.select(key, "fingerprint").mapInArrow(hashes, f"key {kind}, h long").distinct()
    order = Window.partitionBy("key").orderBy(F.col("h").asc_nulls_last())
    low = single.withColumn("r", F.row_number().over(order)).where(F.col("r") <= SIZE)
    lists = low.groupBy("key").agg(F.array_sort(F.collect_list("h")).alias("hs"))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [to_text(np.array(hs, np.uint64)) for hs in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["key", "fingerprint"])

    return lists.mapInArrow(texts, f"key {kind}, fingerprint string").withColumnRenamed("key", key)


def with_neighbours(docs: DataFrame) -> DataFrame:
    """Every document's sketch, that of its edited text, and its likeness to both the edit and the next document.

    The edited text is the text whose last quarter is replaced by the start of the next document's text.
    Texts are dealt once by ranges of doc_id. The first document of each range also goes to the range
    before it, so every range sees the successor of its last document and no whole-table order is needed;
    the driver gets one id per range.
    """
    spark = docs.sparkSession
    n = 2 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = sorted(set(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.25 / n)))
    rows = keyed_texts(docs).withColumn("part", part_of(F.col("doc_id"), [int(b) for b in bounds]))
    firsts = docs.select("doc_id").withColumn("part", part_of(F.col("doc_id"), [int(b) for b in bounds]))
    firsts = firsts.groupBy("part").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("null")).collect()
    head = {r["part"]: None if r["null"] else r["first"] for r in firsts}
    filled = sorted(head)
    if not filled:
        return spark.createDataFrame([], NEIGHBOURS)
    before = {p: filled[i - 1] for i, p in enumerate(filled)}
    heads = spark.createDataFrame([(p, head[p], before[p]) for p in filled], "part int, head long, previous int")
    ranged = rows.join(F.broadcast(heads), "part")
    places = F.array(F.struct("part", F.lit(False).alias("ahead")))
    also = F.array(F.struct(F.col("previous").alias("part"), F.lit(True).alias("ahead")))
    dealt = ranged.select("doc_id", "text", F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.concat(places, also)).otherwise(places)).alias("p"))
    dealt = dealt.select("p.part", "p.ahead", "doc_id", "text").repartition(n, "part").sortWithinPartitions("part", "ahead", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Sketcher()
        last = None  # part, doc_id, text and sketch of the document that waits for its successor
        names = [f.strip().split(" ")[0] for f in NEIGHBOURS.split(",")]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 5]
        for batch in batches:
            out = []
            for part, ahead, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                sketch = tool.sketch(text)
                if last is not None and last[0] == part:
                    _, own, old, mine = last
                    cut = len(old) // 4
                    edited = old[: len(old) - cut] + text[:cut]
                    other = tool.sketch(edited)
                    out.append((own, len(old), hashlib.sha256(edited.encode()).hexdigest(), to_text(mine), to_text(other), resemblance(mine, other), resemblance(mine, sketch), distinct_count(mine), distinct_count(other), containment(mine, other)))
                last = None if ahead else (part, key, text, sketch)
            columns = list(zip(*out)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return dealt.mapInArrow(run, NEIGHBOURS)
