"""Quality scores by compression: a text is good if a dictionary of good texts compresses it better.

Two zstandard dictionaries are built from labelled texts, one of good and one of bad ones. The features of
a text are the normalised difference of its two compressed sizes and its own compression ratio, measured
over the whole text in windows of ``WINDOW`` bytes so that a long text is judged like a short one; a
logistic curve, fitted on labelled texts that built neither dictionary, turns them into a score.

Only rows that are not held out are learned from, at most about ``TRAINING_ROWS`` of them. A null text
counts as the empty one, whose features are zero; conflicting repeated labels count as separate
examples; null labels are left out; without both labels every score is 0.5; an empty table gives an
empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from boxweave.llm.common import held_out, keyed_texts, map_batches

# Bound of the labelled sample, and of the bytes of one dictionary.
TRAINING_ROWS = 12_000
DICTIONARY_BYTES = 110 << 10
SAMPLE_BYTES = 6 << 20
WINDOW = 1 << 12
LEVEL = 3
# Score from which a document is kept.
KEEP = 0.3
SCORES = "doc_id long, held_out boolean, score double, predicted int"


@dataclass
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # one per feature, then the intercept

    def scorer(self):
        """A function of one text: its score. The compressors live in the task."""
        sizes = _sizes(self.good, self.bad)

        def score(text: str) -> float:
            x = (_features(text, sizes) - self.mean) / self.scale
            return float(1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30))))

        return score


def _sizes(good: bytes, bad: bytes):
    import zstandard as z

    def compressor(data: bytes):
        dictionary = z.ZstdCompressionDict(data) if data else None
        if dictionary:  # digested once a task, not once a text
            dictionary.precompute_compress(level=LEVEL)
        return z.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)

    tools = [compressor(good), compressor(bad), compressor(b"")]
    return lambda part: [len(t.compress(part)) for t in tools]


def _features(text: str, sizes) -> np.ndarray:
    """Normalised size differences and ratios, averaged over the windows of a text by their length."""
    raw = text.encode()
    if not raw:
        return np.zeros(4)
    total = np.zeros(3)
    for at in range(0, len(raw), WINDOW):
        total += sizes(raw[at : at + WINDOW])
    good, bad, none = total
    return np.array([(bad - good) / (bad + good), none / len(raw), (none - good) / none, np.log1p(min(len(raw), WINDOW))])


def labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, quality) of about ``most`` rows at most that are not held out, by a hash of the id."""
    marks = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    n = marks.count()
    if n > most:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(1_000_003 * most / n))
    # The labels of the sample are bounded, so the large side is never shuffled.
    return keyed_texts(docs).join(F.broadcast(marks), "doc_id").select("text", "quality")


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> Model:
    """Dictionaries from one half of the labelled sample, the curve from the other half.

    The driver holds at most SAMPLE_BYTES of windows of each label; features are made in tasks.
    """
    import zstandard as z

    nothing = Model(b"", b"", np.zeros(4), np.ones(4), np.zeros(5))
    rows = labelled(docs, labels, most).withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)))
    totals = {r["quality"]: r["n"] for r in rows.where("half = 0").groupBy("quality").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return nothing
    share = {q: min(1.0, SAMPLE_BYTES / totals[q]) for q in (0, 1)}

    def windows(batches):
        for batch in batches:
            parts, marks = [], []
            for text, quality, key in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                for i, at in enumerate(range(0, len(raw), WINDOW)):
                    if quality in share and (key * 31 + i * 7919) % 10_007 < share[quality] * 10_007:
                        parts.append(raw[at : at + WINDOW])
                        marks.append(quality)
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int32()), pa.array(parts, pa.binary())], ["quality", "part"])

    seen = rows.where("half = 0").select("text", "quality", F.pmod(F.xxhash64("text", F.lit(7)), F.lit(10_007)).alias("key"))
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    for r in seen.mapInArrow(windows, "quality int, part binary").orderBy("quality", "part").collect():
        samples[r["quality"]].append(bytes(r["part"]))
    dictionaries = []
    for q in (1, 0):
        try:
            dictionaries.append(z.train_dictionary(DICTIONARY_BYTES, samples[q]).as_bytes())
        except z.ZstdError:  # too few samples to train on: the texts themselves serve
            dictionaries.append(b"".join(samples[q])[-DICTIONARY_BYTES:])
    good, bad = dictionaries
    shared = docs.sparkSession.sparkContext.broadcast((good, bad))

    def features(batches):
        sizes = _sizes(*shared.value)
        for batch in batches:
            x = np.array([_features(t, sizes) for t in batch.column(0).to_pylist()]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(x[:, i], pa.float64()) for i in range(4))], ["quality", "a", "b", "c", "d"])

    measured = rows.where("half = 1").select("text", "quality").mapInArrow(features, "quality int, a double, b double, c double, d double").orderBy("quality", "a", "b", "c", "d").toPandas()
    x, y = measured[["a", "b", "c", "d"]].to_numpy(float), (measured["quality"].to_numpy() == 1).astype(float)
    if len(set(y)) < 2:
        return nothing
    mean, scale = x.mean(0), x.std(0) + 1e-9
    return Model(good, bad, mean, scale, _logistic((x - mean) / scale, y))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Newton steps on the penalised logistic loss."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; one scan, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        score_of = shared.value.scorer()

        def step(batch):
            out = [score_of(t) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(2), pa.array(out, pa.float64()), pa.array([int(s >= KEEP) for s in out], pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

        return step

    return map_batches(keyed_texts(docs, held_out(F.col("doc_id")).alias("held_out")), make, SCORES)


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all their columns, whose score is at least KEEP."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def make():
        score_of, at = shared.value.scorer(), columns.index("text")

        def step(batch):
            return batch.filter(pa.array([score_of(t or "") >= KEEP for t in batch.column(at).to_pylist()], pa.bool_()))

        return step

    return map_batches(docs, make, docs.schema)
