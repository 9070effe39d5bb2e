"""Language identification by error-correcting output codes over character n-grams.

Every language has a codeword of bits. One binary n-gram classifier per bit votes with the averaged
log-odds of the text's n-grams; decoding weighs each bit's loss by how reliable the bit was on labelled
texts and picks the codeword with the least loss. A small gap to the second codeword marks the answer
ambiguous.

Only text and non-null lang of rows that are not held out are learned from, and at most about
``TRAINING_ROWS`` of them. A null text or one without a letter is ``und`` with score 0; texts of any length
are read whole; equal losses go to the first language by name; without labelled rows everything is
``und``; an empty table gives an empty result; columns other than ``doc_id``, ``text`` and ``lang`` are
ignored, and ``lang`` is never an input of a prediction.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from boxweave.llm.common import held_out, map_batches, portions

# Bound of the labelled sample.
TRAINING_ROWS = 20_000
BUCKETS = 1 << 15
# Character n-gram lengths, over lower-cased letters with one blank between words.
GRAMS = (1, 2, 3)
# Pseudo-count of every bucket.
SMOOTHING = 0.5
# Loss gap under which the answer is ambiguous.
AMBIGUOUS = 0.15
SEED = 42
NOT_LETTERS = re.compile(r"[\W\d_]+")
PREDICTION = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"


def letters(text: str) -> str:
    """Lower-cased words of letters, a blank before, between and after them; empty without letters."""
    words = NOT_LETTERS.sub(" ", text.lower()).strip(" ")
    return f" {words} " if words else ""


def grams(text: str) -> np.ndarray:
    """Buckets of all n-grams of ``letters(text)``, of every length in GRAMS."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, rolled = [], np.zeros(len(code), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        rolled = (rolled[: len(code) - n + 1] + code[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        if n in GRAMS:
            out.append((rolled >> np.uint64(49)).astype(np.int64) % BUCKETS)
    return np.concatenate(out)


def codewords(n: int, seed: int = SEED) -> np.ndarray:
    """An n x bits matrix of -1 and 1, rows far apart, every column splitting the languages.

    Up to six languages get all 2^(n-1)-1 splits (distance 2^(n-2)); more get seeded random columns.
    """
    if n == 1:
        return np.ones((1, 1), np.int64)
    if n <= 6:
        columns = [[1 if (c >> i) & 1 else -1 for i in range(n)] for c in range(1, 1 << n, 2)]
        columns = [c for c in columns if -1 in c]
        return np.array(columns, np.int64).T
    bits = int(np.ceil(10 * np.log2(n)))
    source, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(50):
        m = source.choice([-1, 1], (n, bits))
        m = m[:, np.abs(m.sum(0)) < n]
        far = m.shape[1] - m @ m.T
        np.fill_diagonal(far, 4 * bits)
        if far.min() > apart:
            best, apart = m, far.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # buckets x bits, log-odds
    trust: np.ndarray  # weight of each bit

    def margins(self, text: str) -> np.ndarray:
        """Mean log-odds per n-gram of a text, one number per bit; slices bound the memory of a long text."""
        total, n = np.zeros(self.code.shape[1]), 0
        for at in range(0, len(text), 1 << 18):
            g = grams(text[at : at + (1 << 18)])
            total += np.bincount(g, minlength=BUCKETS) @ self.weights if len(g) > BUCKETS // 8 else self.weights[g].sum(0)
            n += len(g)
        return total / max(n, 1)

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Reliability-weighted logistic loss of every codeword."""
        pull = np.clip(4 * margins, -20, 20)
        return (np.logaddexp(0, -self.code * pull) * self.trust).sum(1) / self.trust.sum()

    def predict(self, text: str) -> tuple[str, float, bool]:
        clean = letters(text)
        if not clean or not self.languages:
            return "und", 0.0, True
        loss = self.losses(self.margins(clean))
        order = np.argsort(loss, kind="stable")
        share = np.exp(-len(self.code[0]) * (loss - loss[order[0]]))
        gap = loss[order[1]] - loss[order[0]] if len(order) > 1 else np.inf
        return self.languages[order[0]], float(share[order[0]] / share.sum()), bool(gap < AMBIGUOUS)


def training_rows(docs: DataFrame, most: int) -> DataFrame:
    """(text, lang) of about ``most`` labelled rows at most, chosen by a hash of text."""
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    n = known.count()
    if n <= most:
        return known
    return known.where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < int(1_000_003 * most / n))


def fit(docs: DataFrame, most: int = TRAINING_ROWS) -> Model:
    """Count n-grams per language in Spark, then turn counts into one log-odds table per bit.

    The driver gets one row per language and bucket, whatever the size of the input.
    """
    kinds = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                clean = letters(text)
                if clean:
                    counts = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    for at in range(0, len(clean), 1 << 18):
                        counts += np.bincount(grams(clean[at : at + (1 << 18)]), minlength=BUCKETS)
        for lang, counts in held.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())],
                schema=kinds,
            )

    sample = training_rows(docs, most)
    parts = sample.mapInArrow(run, "lang string, bucket int, n long")
    rows = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(rows["lang"].unique())
    if not names:
        return Model([], np.ones((0, 1), np.int64), np.zeros((BUCKETS, 1)), np.ones(1))
    counts = np.zeros((len(names), BUCKETS))
    counts[[names.index(x) for x in rows["lang"]], rows["bucket"]] = rows["n"]
    share = np.log(counts + SMOOTHING) - np.log((counts + SMOOTHING).sum(1, keepdims=True))
    code = codewords(len(names))
    weights = np.zeros((BUCKETS, code.shape[1]))
    for b in range(code.shape[1]):
        sides = [share[code[:, b] == s] for s in (1, -1)]
        if all(len(x) for x in sides):
            weights[:, b] = np.logaddexp.reduce(sides[0], 0) - np.log(len(sides[0])) - np.logaddexp.reduce(sides[1], 0) + np.log(len(sides[1]))
    model = Model(names, code, weights, np.ones(code.shape[1]))
    model.trust = reliability(sample, model)
    return model


def reliability(sample: DataFrame, model: Model) -> np.ndarray:
    """Log-odds of each bit being right on the labelled texts, at least 0.1."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        right, n = np.zeros(model.code.shape[1], np.int64), 0
        row = {lang: i for i, lang in enumerate(model.languages)}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                clean = letters(text)
                if clean:
                    right += (model.margins(clean) * model.code[row[lang]]) > 0
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(len(right)), pa.int32()), pa.array(right, pa.int64()), pa.array([n] * len(right), pa.int64())], ["bit", "ok", "n"])

    rows = sample.mapInArrow(run, "bit int, ok long, n long").groupBy("bit").agg(F.sum("ok").alias("ok"), F.sum("n").alias("n")).collect()
    trust = np.ones(model.code.shape[1])
    for r in rows:
        p = (r["ok"] + 1) / (r["n"] + 2)
        trust[r["bit"]] = max(0.1, np.log(p / (1 - p)))
    return trust


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of every document; one scan, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def step(batch):
            out = [model.predict(t or "") for some in portions([(t or "",) for t in batch.column(2).to_pylist()]) for (t,) in some]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    batch.column(1),
                    pa.array([x[0] for x in out], pa.string()),
                    pa.array([x[1] for x in out], pa.float64()),
                    pa.array([x[2] for x in out], pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

        return step

    return map_batches(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), make, PREDICTION)
