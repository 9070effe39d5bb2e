"""BPE encoding and decoding over a minimal acyclic transducer of frequent words.

The words of the whole table are counted, the most frequent ones are compiled into an automaton that
shares prefixes and suffixes and numbers its words, and the number leads to the word's ids. The file is
placed in the shared folder, shipped to each executor once and memory-mapped by its workers. Words it
does not hold are merged exactly.

A null or empty text has no ids, special strings inside a text are their own id as the library has it by
default, texts of any length are taken whole, repeated rows are encoded alike, words of equal counts are in the
automaton or out of it together, an empty table gives an empty result and an empty automaton, and columns other than ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

import json
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxweave.llm.common import Runs, byte_letters, keyed_texts, portions
from boxweave.runtime import cut_lineage, scratch_path

# Words of the automaton.
LEXICON_WORDS = 1 << 17
# Chunks a task remembers: what is in use stays when they are full.
CHUNKS = 250_000
# Characters of text that are encoded together.
PORTION = 1 << 21
# The published splitting pattern of byte-level BPE
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space other than blanks and line ends: such texts are not cut into chunks first.
RARE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
RARE_ASCII = "".join(c for c in RARE_SPACE if c.isascii())
CHUNK = "[ \n]*[^ \n]+|[ \n]+"
# Words of at most so many bytes are merged by looking for the least rank anew each time.
SHORT = 48
# Words merged side by side at once.
ABREAST = 1 << 12
LOW, NEVER = (1 << 32) - 1, 1 << 62


class Vocabulary:
    """Byte-level merges of a tokenizer file: ids of single bytes, ranks of id pairs, bytes of every id."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        letters = byte_letters()
        ids = data["model"]["vocab"]
        self.single = [0] * 256
        for letter, b in letters.items():
            self.single[b] = ids[letter]
        self.pairs = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs.setdefault(ids[a] << 32 | ids[b], rank + 1 << 32 | ids[a + b])
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        spelled = {i: bytes(letters[c] for c in p) for p, i in ids.items() if all(c in letters for c in p)}
        spelled |= {i: p.encode() for p, i in self.added.items()}
        self.spelled = [spelled.get(i, b"") for i in range(max(spelled, default=-1) + 1)]
        # Sorted id pairs, what becomes of each, the same for every two bytes, and the ids of the bytes.
        keys = sorted(self.pairs)
        first = [self.pairs.get(a << 32 | b, NEVER) for a in self.single for b in self.single]
        self.tables = [np.array(x, np.int64) for x in (keys, [self.pairs[k] for k in keys], first, self.single)]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the lowest-rank pair first, leftmost on ties."""
        find, part = self.pairs.get, [self.single[b] for b in word]
        if len(part) > SHORT:
            return self._merge_long(part)
        # Rank and new id of every neighbouring pair, one number each, so the least one is the next merge.
        near = [find(a << 32 | b, NEVER) for a, b in zip(part, part[1:])]
        while near:
            best = min(near)
            if best == NEVER:
                break
            i = near.index(best)
            part[i : i + 2] = [best & LOW]
            del near[i]
            if i < len(near):
                near[i] = find(part[i] << 32 | part[i + 1], NEVER)
            if i:
                near[i - 1] = find(part[i - 1] << 32 | part[i], NEVER)
        return part

    def _merge_long(self, part: list[int]) -> list[int]:
        """The same over a heap and a linked list."""
        n, find = len(part), self.pairs.get
        heap = [p & ~LOW | i for i in range(n - 1) if (p := find(part[i] << 32 | part[i + 1]))]
        heapify(heap)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i = entry & LOW
            j = right[i]
            p = find(part[i] << 32 | part[j]) if part[i] >= 0 and j < n else None
            if p is None or p >> 32 != entry >> 32:
                continue
            part[i], part[j] = p & LOW, -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if p := find(part[i] << 32 | part[k]):
                    heappush(heap, p & ~LOW | i)
            h = left[i]
            if h >= 0 and (p := find(part[h] << 32 | part[i])):
                heappush(heap, p & ~LOW | h)
        return [x for x in part if x >= 0]

    def merge_all(self, words: list[bytes]) -> Runs:
        """Ids of many words: those of about one length are merged side by side, one merge of each per step."""
        found: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        order, long = order[sizes[order] <= SHORT], order[sizes[order] > SHORT]
        for i in long.tolist():
            found[i] = array("I", self._merge_long([self.single[b] for b in words[i]])).tobytes()
        for at in range(0, len(order), ABREAST):
            some = order[at : at + ABREAST].tolist()
            ids, ends = self._merge_abreast([words[i] for i in some])
            raw, ends = ids.tobytes(), (ends * 4).tolist()
            for i, a, b in zip(some, [0, *ends], ends):
                found[i] = raw[a:b]
        return Runs.of(found, np.uint32)

    def _merge_abreast(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids back to back, end of each word's) of words of at most SHORT bytes; every row is one word's linked list."""
        pair_keys, pair_news, first, single = self.tables
        n, sizes = len(words), np.fromiter(map(len, words), np.int64, len(words))
        # The last column belongs to no word: what lies before a word's start and behind its end.
        width = int(sizes.max()) + 1
        column = np.arange(width)
        inside = column < sizes[:, None]
        raw = np.zeros((n, width), np.int64)
        raw[inside] = np.frombuffer(b"".join(words), np.uint8)
        part = np.where(inside, single[raw], -1)
        near = np.full((n, width), NEVER)
        near[:, :-1] = np.where(inside[:, 1:], first[raw[:, :-1] << 8 | raw[:, 1:]], NEVER)
        right = np.where(column + 1 < sizes[:, None], column + 1, width - 1)
        left = np.tile(column - 1, (n, 1))
        left[:, 0] = width - 1

        def find(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            key = a << 32 | b
            at = np.minimum(np.searchsorted(pair_keys, key), len(pair_keys) - 1)
            return np.where((a >= 0) & (b >= 0) & (pair_keys[at] == key), pair_news[at], NEVER)

        row = np.arange(n) if len(pair_keys) else np.arange(0)
        while len(row):
            i = near[row].argmin(axis=1)
            best = near[row, i]
            go = best != NEVER
            row, i, best = row[go], i[go], best[go]
            j = right[row, i]
            k, h = right[row, j], left[row, i]
            part[row, i], part[row, j], near[row, j] = best & LOW, -1, NEVER
            right[row, i], left[row, k] = k, i
            near[row, i] = find(part[row, i], part[row, k])
            near[row, h] = find(part[row, h], part[row, i])
        live = part >= 0
        return part[live].astype("<u4"), np.cumsum(live.sum(axis=1))


class Cutter:
    """Words of a text as the library cuts them, special strings as words of their own."""

    def __init__(self, added: dict[str, int]):
        import re

        import regex

        self.added = added
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.chunk = re.compile(CHUNK)
        self.words = regex.compile(PATTERN).findall

    def chunks(self, text: str) -> list[str]:
        """Pieces of the text whose words can be found apart: a word never spans the cut before white space."""
        if self.special and any(a in text for a in self.added):
            out = []
            for i, part in enumerate(self.special.split(text)):
                out += [part] if i % 2 else self.plain(part)
            return out
        return self.plain(text)

    def inside(self, chunk: str) -> list[str]:
        """Words of a chunk: letters, with or without a blank before, are one word."""
        if chunk.isascii() and (chunk[1:] if chunk[0] == " " else chunk).isalpha():
            return [chunk]
        return self.words(chunk)

    def plain(self, text: str) -> list[str]:
        # One quick scan per character, which a search for any of them is not.
        if any(c in text for c in (RARE_ASCII if text.isascii() else RARE_SPACE)):
            return self.words(text)
        return self.chunk.findall(text)


class Automaton:
    """Minimal acyclic automaton over byte words; ``number`` is a word's place in sorted order, or -1."""

    def __init__(self, keys: np.ndarray, target: np.ndarray, skip: np.ndarray, final: np.ndarray):
        self.keys, self.target, self.skip, self.final = keys, target, skip, final

    @classmethod
    def build(cls, words: list[bytes]) -> Automaton:
        """From sorted distinct words, one at a time: a finished suffix is replaced by its equal if one exists."""
        edges: list[dict[int, int]] = [{}]
        final = [False]
        register: dict[tuple, int] = {}
        path, last = [0], b""

        def settle(depth: int) -> None:
            for d in range(len(last), depth, -1):
                state, parent = path[d], path[d - 1]
                shape = (final[state], tuple(edges[state].items()))
                edges[parent][last[d - 1]] = register.setdefault(shape, state)
            del path[depth + 1 :]

        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            settle(same)
            for b in word[same:]:
                edges.append({})
                final.append(False)
                edges[path[-1]][b] = len(edges) - 1
                path.append(len(edges) - 1)
            final[path[-1]] = True
            last = word
        settle(0)
        # Number the live states and count the words each one leads to.
        order, number, stack = [], {}, [(0, False)]
        while stack:
            state, done = stack.pop()
            if done:
                order.append(state)
            elif state not in number:
                number[state] = len(number)
                stack.append((state, True))
                stack += [(t, False) for t in edges[state].values() if t not in number]
        below: dict[int, int] = {}
        rows = []
        for state in order:
            n = int(final[state])
            for b, t in sorted(edges[state].items()):
                rows.append((number[state] << 8 | b, number[t], n))
                n += below[t]
            below[state] = n
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 3)
        ends = np.zeros(len(number), np.int64)
        for state, i in number.items():
            ends[i] = final[state]
        return cls(table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy(), ends)

    def number(self, words: list[bytes]) -> np.ndarray:
        """Numbers of many words at once, walking all of them one byte per step."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.keys):
            return out
        lengths = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        live = np.arange(n)
        state, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for depth in range(int(lengths.max()) + 1):
            ended = lengths[live] == depth
            done = live[ended]
            good = self.final[state[done]] == 1
            out[done[good]] = place[done[good]]
            live = live[~ended]
            if not len(live):
                break
            key = state[live] << 8 | flat[starts[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            live, at = live[found], at[found]
            state[live] = self.target[at]
            place[live] += self.skip[at]
        return out


def save(auto: Automaton, ids: Runs) -> bytes:
    """One array of 64-bit numbers: six lengths, then the parts back to back."""
    parts = [auto.keys, auto.target, auto.skip, auto.final, ids.lengths[: ids.rows], ids.flat[: ids.used].astype(np.int64)]
    return np.concatenate([np.array([len(p) for p in parts], np.int64), *parts]).astype("<i8").tobytes()


def load(path: str) -> tuple[Automaton, Runs]:
    """Memory-map a saved automaton; its id lists are few and copied."""
    raw = np.memmap(path, "<i8", "r")
    bounds = 6 + np.concatenate([[0], np.cumsum(raw[:6])])
    keys, target, skip, final, lengths, flat = (raw[a:b] for a, b in zip(bounds, bounds[1:]))
    ids = Runs(np.uint32)
    ids.flat, ids.lengths = np.array(flat, np.uint32), np.array(lengths)
    ids.starts, ids.used, ids.rows = np.cumsum(ids.lengths) - ids.lengths, len(flat), len(lengths)
    return Automaton(keys, target, skip, final), ids


def frequent_words(docs: DataFrame, spec: str, most: int) -> list[str]:
    """The frequent words of the whole table, ``most`` at most.

    Words of one count are in or out together, so a threshold found on the histogram of counts replaces a
    sort, and the driver gets the words of the automaton alone.
    """
    added = {t["content"]: t["id"] for t in json.loads(spec)["added_tokens"]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, chunks = Cutter(added), Counter()

        def settle():
            words = Counter()
            for c, n in chunks.items():
                if c not in added:
                    for w in cutter.inside(c):
                        words[w] += n
            chunks.clear()
            # A word that several tasks see is added up behind the shuffle.
            return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                chunks.update(cutter.chunks(text))
                if len(chunks) > CHUNKS:
                    yield settle()
        yield settle()

    counted = keyed_texts(docs).select("text").mapInArrow(run, "word string, n long")
    words = cut_lineage(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # Counts above ``most`` words apart are few: their number grows with the root of the text at most.
    held, least = 0, None
    for r in words.groupBy("n").count().orderBy(F.desc("n")).limit(most).collect():
        held += r["count"]
        if held > most:
            break
        least = r["n"]
    return [] if least is None else [r["word"] for r in words.where(F.col("n") >= least).select("word").collect()]


def compile_lexicon(docs: DataFrame, spec: str, most: int = LEXICON_WORDS) -> str:
    """Build the automaton of the table's frequent words and ship it; returns the file's name on the executors."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(spec)
    words = sorted(w.encode() for w in frequent_words(docs, spec, most))
    data = save(Automaton.build(words), vocabulary.merge_all(words))
    name = f"lexicon-{uuid4().hex}"
    path = f"{scratch_path(spark, 'lexicon')}/{name}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(data)
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return name


class Places(dict):
    """Row number of every chunk met, given out as chunks are first asked for; ``fresh`` are those not learned yet."""

    def __init__(self, kept=()):
        super().__init__(zip(kept, range(len(kept))))
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        at = self[chunk] = len(self)
        self.fresh.append(chunk)
        return at


class Coder:
    """Ids of whole texts: chunks are resolved once, by the automaton or else by exact merging."""

    def __init__(self, vocabulary: Vocabulary, path: str):
        self.vocabulary = vocabulary
        self.cutter = Cutter(vocabulary.added)
        self.automaton, self.lexicon = load(path)
        self.restart()

    def restart(self, kept=()) -> None:
        """Forget all chunks but the ``kept`` ones."""
        at = [self.index[c] for c in kept]
        rows = [self.runs.flat[a : a + n].tobytes() for a, n in zip(self.runs.starts[at].tolist(), self.runs.lengths[at].tolist())] if at else []
        self.index = Places(kept)
        self.runs = Runs.of(rows, np.uint32)

    def learn(self, fresh: list[str]) -> None:
        """Ids of new chunks; their words are looked up together in one walk of the automaton, the rest merged together."""
        added, words, counts = self.vocabulary.added, [], []
        for c in fresh:
            found = [c] if c in added else self.cutter.inside(c)
            counts.append(len(found))
            words += found
        place = {w: i for i, w in enumerate(dict.fromkeys(words))}
        spelled = [w.encode() for w in place]
        numbers = self.automaton.number(spelled)
        special = [(i, added[w]) for w, i in place.items() if w in added] if added else []
        numbers[[i for i, _ in special]] = -1
        unknown = np.flatnonzero(numbers < 0)
        merged = self.vocabulary.merge_all([spelled[i] for i in unknown.tolist()])
        # Where each distinct word's ids lie: in the lexicon, or behind it.
        lexicon = self.lexicon
        flat = np.concatenate([lexicon.flat[: lexicon.used], merged.flat[: merged.used], np.array([x for _, x in special], np.uint32)])
        starts, lengths, known = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64), numbers >= 0
        starts[known], lengths[known] = lexicon.starts[numbers[known]], lexicon.lengths[numbers[known]]
        starts[unknown], lengths[unknown] = lexicon.used + merged.starts[: merged.rows], merged.lengths[: merged.rows]
        for n, (i, _) in enumerate(special):
            starts[i], lengths[i] = lexicon.used + merged.used + n, 1
        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        ends = np.cumsum(lengths[at])
        ids = flat[np.repeat(starts[at] - (ends - lengths[at]), lengths[at]) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.cumsum([0, *counts])]
        self.runs.append(ids, np.diff(bounds))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.cutter.chunks(t) for t in texts]
        row = self.index.__getitem__
        rows = [np.fromiter(map(row, c), np.int64, len(c)) for c in cut]
        self.learn(self.index.fresh)
        self.index.fresh.clear()
        found = [self.runs.gather(r) for r in rows]
        if len(self.index) > CHUNKS:
            self.restart(set().union(*cut))
        return found


def decoder(spelled: list[bytes]) -> Callable[[np.ndarray], str]:
    """Text of an id array: the ids' bytes joined, broken UTF-8 shown by the replacement character."""
    table = Runs.of(spelled, np.uint8)
    return lambda ids: table.gather(ids).tobytes().decode("utf-8", "replace")


def map_codes(docs: DataFrame, tokenizer_path: str, finish: Callable[[pa.RecordBatch, list[np.ndarray], Callable], pa.RecordBatch], schema: str, most: int = LEXICON_WORDS) -> DataFrame:
    """Encode every row's text and let ``finish(rows, ids per row, decode)`` make the result rows.

    ``docs`` needs ``doc_id`` and ``text``; its last column must be the text.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    name = compile_lexicon(docs, spec, most)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(spec))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value, SparkFiles.get(name))
        decode = decoder(shared.value.spelled)
        for batch in batches:
            at = 0
            for some in portions([(t,) for t in batch.column(batch.num_columns - 1).to_pylist()], PORTION):
                yield finish(batch.slice(at, len(some)), coder.encode([t for (t,) in some]), decode)
                at += len(some)

    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    return keyed_texts(docs.select("doc_id", *rest, "text")).mapInArrow(run, schema)


def encode(docs: DataFrame, tokenizer_path: str, most: int = LEXICON_WORDS) -> DataFrame:
    """(doc_id, ids) of every document."""

    def finish(rows, ids, decode):
        return pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), pa.array([x.tolist() for x in ids], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return map_codes(docs, tokenizer_path, finish, "doc_id long, ids array<long>", most)


def decode(spark: SparkSession, codes: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(Vocabulary(f.read()).spelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = decoder(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([text_of(np.array(x or [], np.int64)) for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return codes.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
