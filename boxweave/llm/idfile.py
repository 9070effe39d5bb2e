"""Token-id files: frequency-ranked ids, 1 to 4 bytes each, with their lengths in separate control bytes.

A file is a Parquet part of block rows, so Spark commits it atomically and a lost task is redone:

- ``part, before, tokens``: place of the block; ``before`` are the tokens of its part ahead of it;
- ``doc_ids, lengths``: the documents of the block and their token counts;
- ``control``: two bits per value, four values a byte, low bits first: byte length minus one;
- ``data``: the values, little-endian, back to back. A value is an id's rank by corpus frequency.

``ranks`` beside the blocks maps ranks back to ids. A null or empty text is just the end id, a document
is never split over blocks, equal doc_ids follow in order of their text, null doc_ids come first, an
empty table gives no blocks, and columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxweave.llm.common import Runs, byte_letters, keyed_texts

BLOCK_TOKENS = 1 << 18
# Bytes of text that are encoded together, and parts of words that the model is asked for together.
PORTION, ABREAST = 1 << 23, 1 << 12
# Parts of words that a worker remembers; ids never depend on it.
PARTS = 1 << 19
BLOCK = "part int, before long, tokens long, doc_ids array<long>, lengths array<long>, control binary, data binary"
# Byte lengths of the four values behind each control byte.
LENGTHS = (((np.arange(256)[:, None] >> np.arange(0, 8, 2)) & 3) + 1).astype(np.int64)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    v = values.astype(np.uint32)
    size = 1 + (v > 0xFF).astype(np.int64) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[: len(v)] = size - 1
    four = codes.reshape(-1, 4)
    control = four[:, 0] | (four[:, 1] << 2) | (four[:, 2] << 4) | (four[:, 3] << 6)
    ends = np.cumsum(size)
    starts = ends - size
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for b in range(int(size.max()) if len(size) else 0):
        at = np.flatnonzero(size > b)
        data[starts[at] + b] = (v[at] >> np.uint32(8 * b)) & np.uint32(0xFF)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values behind control and data bytes."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    starts = np.cumsum(size) - size
    raw = np.frombuffer(data, np.uint8)
    out = raw[starts].astype(np.uint32)
    for b in range(1, int(size.max()) if n else 0):
        at = np.flatnonzero(size > b)
        out[at] |= raw[starts[at] + b].astype(np.uint32) << np.uint32(8 * b)
    return out


class Known(dict):
    """Row number of every string met, its ids in that row of ``runs``; emptied when it outgrows PARTS."""

    def __init__(self, learn: Callable[[list[str]], Iterator[tuple[np.ndarray, np.ndarray]]]):
        super().__init__()
        self.learn = learn
        self.restart()

    def restart(self) -> None:
        # Row 0 is the line end between words, which has no ids.
        self.clear()
        self["\n"] = 0
        self.fresh: list[str] = []
        self.runs = Runs.of([b""], np.uint32)

    def __missing__(self, string: str) -> int:
        at = self[string] = len(self)
        self.fresh.append(string)
        return at

    def rows(self, strings: list[str]) -> np.ndarray:
        if len(self) > PARTS or self.runs.used > 8 * PARTS:
            self.restart()
        rows = np.fromiter(map(self.__getitem__, strings), np.int64, len(strings))
        for ids, sizes in self.learn(self.fresh) if self.fresh else ():
            self.runs.append(ids, sizes)
        self.fresh.clear()
        return rows


class WordIds:
    """Ids of a text from those of its words: white space always ends a word, so distinct words are encoded once.

    A word goes through the library's normaliser, pre-tokeniser and model, one after the other. For words
    of Latin letters, digits and ASCII marks the first two are lower-casing and the file's own pattern,
    which spares most of the work: such words are cut together, and the model sees each part of them once.
    """

    def __init__(self, spec: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(spec)
        self.lib.no_truncation()
        self.lib.no_padding()
        data = json.loads(spec)
        self.added = [t["content"] for t in data["added_tokens"]]
        steps = [x["type"] for x in (data["normalizer"] or {}).get("normalizers", [])]
        parts = (data["pre_tokenizer"] or {}).get("pretokenizers", [])
        plain = steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in parts] == ["Split", "ByteLevel"]
        plain = plain and parts[0]["behavior"] == "Removed" and parts[0]["invert"] and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"]
        pattern = parts[0]["pattern"].get("Regex", "") if plain else ""
        # A pattern that looks around itself may cut a word otherwise when others stand beside it; one with groups finds these.
        plain = pattern and not regex.search(r"[($]|\\[bBAZzGKXmM]|(?<!\[)\^", pattern)
        self.cut = regex.compile(f"{pattern}|\n" if plain else "\n").findall
        # What leaves a word to the library: other letters, and special strings.
        self.other = regex.compile("|".join(["[\u0130\u0250-\U0010ffff]+", *map(regex.escape, self.added)]) if plain else "[^\n]+").finditer
        self.letters = {b: c for c, b in byte_letters().items()} | {ord("\n"): "\n"}
        self.parts, self.wholes = Known(self._parts), Known(self._wholes)

    def encode(self, word: str) -> bytes:
        """Ids of one word as 32-bit numbers, in bytes."""
        if any(a in word for a in self.added):
            return array("I", self.lib.encode(word, add_special_tokens=False).ids).tobytes()
        whole = self.lib.normalizer.normalize_str(word) if self.lib.normalizer else word
        parts = [p for p, _ in self.lib.pre_tokenizer.pre_tokenize_str(whole)] if self.lib.pre_tokenizer else [whole]
        return b"".join([array("I", [t.id for t in self.lib.model.tokenize(p)]).tobytes() for p in parts])

    def _wholes(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ids = [self.encode(w) for w in words]
        yield np.frombuffer(b"".join(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)) // 4

    def _parts(self, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The model has parts spelled by byte letters."""
        spelled = "\n".join(parts).encode().decode("latin-1").translate(self.letters).split("\n")
        for at in range(0, len(parts), ABREAST):
            some = list(map(self.lib.model.tokenize, spelled[at : at + ABREAST]))
            sizes = np.fromiter(map(len, some), np.int64, len(some))
            yield np.fromiter(map(attrgetter("id"), chain.from_iterable(some)), np.uint32, int(sizes.sum())), sizes

    def of_words(self, text: str, n: int) -> Runs:
        """Ids of the ``n`` words of ``text``, each with a line end behind it."""
        wholes, place = [], np.empty(0, np.int64)
        if at := [m.start() for m in self.other(text)]:
            words = text[:-1].split("\n")
            place = np.unique(np.searchsorted(np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1), at, side="right"))
            # Their lines stay, empty, so the others keep their numbers.
            for i in place.tolist():
                wholes.append(words[i])
                words[i] = ""
            text = "\n".join([*words, ""])
        text = text.lower()
        parts = self.cut(text)
        if parts.count("\n") != n:  # the pattern takes line ends for its own
            parts = [p for w in text[:-1].split("\n") for p in (*self.cut(w), "\n")]
        rows, found = self.parts.rows(parts), Runs(np.uint32)
        ends = np.cumsum(self.parts.runs.lengths[rows])[rows == 0]
        found.append(self.parts.runs.gather(rows), np.diff(ends, prepend=0))
        if wholes:
            rows = self.wholes.rows(wholes)
            found.append(self.wholes.runs.gather(rows), self.wholes.runs.lengths[rows])
            for a in (found.starts, found.lengths):
                a[place] = a[n : n + len(place)]
        return found

    def of_texts(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text, cut at ASCII white space only: other white space is left to the library."""
        cut = pc.ascii_split_whitespace(texts)
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary())
        n = len(words)
        text = pc.binary_join(pa.ListArray.from_arrays([0, n], words), pa.scalar(b"\n", words.type))[0].as_py() + b"\n"
        runs = self.of_words(text.decode("utf-8", "replace"), n)
        rows = coded.indices.to_numpy()
        # A text ends behind the ids of its last word.
        ends = np.concatenate([[0], np.cumsum(runs.lengths[rows])])
        return np.split(runs.gather(rows), ends[np.cumsum(pc.list_value_length(cut).to_numpy())[:-1]])


@lru_cache(maxsize=1)
def word_ids(spec: str) -> WordIds:
    """One coder for all tasks of a worker: parts of words are remembered from task to task."""
    return WordIds(spec)


def stretches(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive rows whose sizes add up to at most ``most``; a larger row goes alone."""
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        behind = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, behind + most, side="right")))
        yield at, to
        at = to


def encode_ids(docs: DataFrame, spec: str, end_id: int) -> DataFrame:
    """Blocks of plain ids in ascending doc_id order: (part, before, tokens, doc_ids, lengths, ids).

    Texts are range-partitioned by doc_id once, and encoded behind that shuffle; a task holds one block.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = word_ids(shared.value), TaskContext.get().partitionId()
        before, keys, rows, held = 0, [], [], 0
        kinds = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("ids", pa.binary())])

        def block() -> pa.RecordBatch:
            ids = np.concatenate(rows)
            # Two bytes an id where they suffice: the reader tells by the length.
            ids = ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes()
            values = [part, before, held, keys, [len(r) for r in rows], ids]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, kinds)], schema=kinds)

        end = np.array([end_id], np.uint32)
        for batch in batches:
            all_keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for at, to in stretches(pc.binary_length(texts).to_numpy(), PORTION):
                for key, ids in zip(all_keys[at:to], coder.of_texts(texts.slice(at, to - at))):
                    if rows and held + len(ids) >= BLOCK_TOKENS:
                        yield block()
                        before, keys, rows, held = before + held, [], [], 0
                    keys.append(key)
                    rows.append(np.concatenate([ids, end]))
                    held += len(ids) + 1
        if rows:
            yield block()

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = keyed_texts(docs).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return ranged.mapInArrow(run, "part int, before long, tokens long, doc_ids array<long>, lengths array<long>, ids binary")


def plain_ids(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")


def id_counts(blocks: DataFrame) -> np.ndarray:
    """How often each id occurs in all blocks; what reaches the driver is one row per id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = np.bincount(plain_ids(raw, n), minlength=len(total))
                seen[: len(total)] += total
                total = seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["id", "n"])

    rows = blocks.select("tokens", "ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Write the ids of every document to ``path``/blocks in ascending doc_id order.

    Texts are encoded once, to plain ids beside the files; their counts give the ranks, and a second pass
    over the plain ids packs them block by block.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    encode_ids(docs, spec, end_id).write.option("compression", "zstd").parquet(f"{path}/plain")
    plain = spark.read.parquet(f"{path}/plain")
    counts = id_counts(plain)
    order = np.lexsort((np.arange(len(counts)), -counts))
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(order)], "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.empty(len(order), np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of = shared.value
        for batch in batches:
            packed = [pack(rank_of[plain_ids(raw, n)]) for n, raw in zip(batch.column(2).to_pylist(), batch.column(5).to_pylist())]
            both = [pa.array([p[i] for p in packed], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *both], [f.strip().split(" ")[0] for f in BLOCK.split(",")])

    plain.mapInArrow(run, BLOCK).write.option("compression", "zstd").parquet(f"{path}/blocks")


def map_ids(spark: SparkSession, path: str, each: Callable[[list, np.ndarray, list[np.ndarray]], pa.RecordBatch], schema: str) -> DataFrame:
    """Read blocks back and apply ``each(doc_ids, starts, ids per document)`` to every one.

    ``starts`` are global: the driver adds up one number per part.
    """
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    sums = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("tokens").alias("n")).collect()}
    base, total = {}, 0
    for part in sorted(sums):
        base[part] = total
        total += sums[part]
    ranks = spark.read.parquet(f"{path}/ranks").collect()
    id_of = np.zeros(len(ranks), np.uint32)
    for r in ranks:
        id_of[r["rank"]] = r["id"]
    shared = spark.sparkContext.broadcast((base, id_of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, id_of = shared.value
        for batch in batches:
            for b in batch.to_pylist():
                ids = id_of[unpack(b["control"], b["data"], b["tokens"])]
                ends = np.cumsum(np.array(b["lengths"], np.int64))
                starts = ends - b["lengths"] + (base[b["part"]] + b["before"])
                yield each(b["doc_ids"], starts, np.split(ids, ends[:-1]))

    return blocks.mapInArrow(run, schema)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document in the files."""

    def each(keys, starts, ids):
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array([x.tolist() for x in ids], pa.list_(pa.int64()))], ["doc_id", "start", "ids"]
        )

    return map_ids(spark, path, each, "doc_id long, start long, ids array<long>")
