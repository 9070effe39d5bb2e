"""Helpers the text operators share: keyed text input, per-task memos, id tables and the learn/hold-out rule."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Entries a per-task memo may hold before it starts afresh; results never depend on it.
MEMO_ENTRIES = 400_000


def keyed_texts(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, text, more...) with a null text as the empty one; other columns are left behind."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text is divisible by 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply per-task state built by ``make`` to every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            yield step(batch)

    return df.mapInArrow(run, schema)


def byte_letters() -> dict[str, int]:
    """Printable letter -> byte, as byte-level BPE spells its vocabulary: shown bytes stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Memo(dict):
    """A dict that computes missing values, emptied when it outgrows MEMO_ENTRIES."""

    def __init__(self, compute: Callable):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class Runs:
    """Rows of different lengths in one flat array, gathered by row number without a loop."""

    def __init__(self, dtype):
        self.flat = np.empty(1 << 12, dtype)
        self.starts = np.empty(1 << 10, np.int64)
        self.lengths = np.empty(1 << 10, np.int64)
        self.used = self.rows = 0

    @classmethod
    def of(cls, rows: list, dtype) -> Runs:
        runs = cls(dtype)
        runs.extend(rows)
        return runs

    def extend(self, rows: list) -> None:
        """Append rows: arrays, lists, or their bytes."""
        if not rows:
            return
        added = np.fromiter(map(len, rows), np.int64, len(rows))
        dtype = self.flat.dtype
        if isinstance(rows[0], bytes):
            fresh = np.frombuffer(b"".join(rows), dtype)
            added //= dtype.itemsize
        elif isinstance(rows[0], list):
            fresh = np.fromiter(chain.from_iterable(rows), dtype, int(added.sum()))
        else:
            fresh = np.concatenate(rows).astype(dtype)
        self.append(fresh, added)

    def append(self, fresh: np.ndarray, added: np.ndarray) -> None:
        """Append rows that lie back to back in ``fresh``, of the lengths ``added``."""
        more = len(added)
        self.flat = _room(self.flat, self.used + len(fresh))
        self.starts, self.lengths = (_room(a, self.rows + more) for a in (self.starts, self.lengths))
        self.flat[self.used : self.used + len(fresh)] = fresh
        self.starts[self.rows : self.rows + more] = self.used + np.cumsum(added) - added
        self.lengths[self.rows : self.rows + more] = added
        self.used += len(fresh)
        self.rows += more

    def gather(self, index: np.ndarray) -> np.ndarray:
        lengths = self.lengths[index]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self.starts[index] - (ends - lengths), lengths)
        return self.flat[shift + np.arange(total)]


def _room(a: np.ndarray, size: int) -> np.ndarray:
    if size <= len(a):
        return a
    return np.concatenate([a, np.empty(max(size, 2 * len(a)) - len(a), a.dtype)])


def portions(rows: list[tuple], chars: int = 1 << 22) -> Iterator[list[tuple]]:
    """Consecutive rows whose texts (last field) add up to about ``chars``; a longer text goes alone."""
    some, held = [], 0
    for row in rows:
        if some and held + len(row[-1]) > chars:
            yield some
            some, held = [], 0
        some.append(row)
        held += len(row[-1])
    if some:
        yield some


def part_of(key: Column, bounds: list) -> Column:
    """Number of the ascending ``bounds`` that are at most ``key``, searched in batches; null keys are in part 0."""
    from pyspark.sql.functions import pandas_udf

    edges = np.array(bounds, np.int64)

    @pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy(np.int64), side="right").astype(np.int32))

    return F.when(key.isNotNull(), place(F.coalesce(key, F.lit(0)))).otherwise(F.lit(0))
