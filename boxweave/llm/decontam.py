"""Benchmark decontamination: CGK embedding and bit-sampling LSH, then exact edit verification.

Texts and items are lower-cased words. An item of n words is found in a text where some stretch is within
``k = floor((1 - SIMILARITY) * n)`` word edits of it. A window of n words is embedded by random walks: at each step the
current word is written out and the walk moves on or stays by a random bit of that word, so few edits lead to few
differing outputs. Each of several tables samples outputs of a walk of its own; an item and a window of its length
that agree in a table are a candidate, and an alignment with free ends in the text decides. Every item length has as
many tables as bring ``RECALL`` of the texts with k edits together, by the worst agreement measured on its items.

Windows are laid only where a match is possible: a stretch within k edits of an item shares at least n + 1 - g - k*g of
its runs of g words on diagonals at most 2k apart (q-gram lemma), so windows start on such diagonals. Where a text and an
item have that many in common but agree in no table, or agree at places that are no match, the alignment is made
on all these diagonals, so no match is lost to chance.

A null text or item counts as the empty one and matches nothing; items of fewer than five words allow no edit
and are found as they are; each letter of a script without blanks is a word; texts of any length are read whole; runs that
very many items or places share are expanded in slices of bounded size; of equal distances the earliest place is
reported; repeated documents or items give a row each; empty tables give an empty result; columns other
than ``doc_id``, ``text``, ``item_id`` are ignored by ``matches`` and kept by ``drop_matching``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from boxweave.llm.common import keyed_texts, map_batches, portions

SIMILARITY = 0.8
RECALL = 0.99
# Outputs sampled per table, the most tables of a length, and items of a length tried for their number.
SAMPLED, MOST_TABLES, TRIED = 2, 64, 50
SEED = 42
# Shared runs that are expanded together.
EXPANDED = 1 << 20
# Words of the items that one pass over the documents looks for; more items take more passes.
BLOCK_WORDS = 2_000_000
# Characters of text that a task looks at together.
PORTION = 1 << 24
# Letters of scripts written without blanks: Thai to Myanmar, Khmer, kana, Han.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"[^\W{UNSPACED}]+|[{UNSPACED}]")
# Every ASCII byte that is no word character, as a blank.
GAPS = bytes(b if b > 127 or chr(b).isalnum() or chr(b) == "_" else 32 for b in range(256))
MATCHES = "doc_id long, item_id long, distance int, similarity double, start long, end long"


def allowed(n: int) -> int:
    return int((1 - SIMILARITY) * n + 1e-9)


def _mixed(x: np.ndarray) -> np.ndarray:
    h = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def embedded(words: np.ndarray, tables: int) -> np.ndarray:
    """One key per row and table: the sampled outputs of that table's random walk over the row's words."""
    rows, n = words.shape
    samples = np.stack([np.random.default_rng([SEED, t, n]).choice(2 * n, min(SAMPLED, 2 * n), replace=False) for t in range(tables)])
    ended = np.hstack([words, np.full((rows, 1), -1, np.int64)]).astype(np.uint64)
    keys, at = np.zeros((rows, tables), np.uint64), np.zeros((rows, tables), np.int64)
    row, table = np.arange(rows)[:, None], np.arange(1, tables + 1, dtype=np.uint64) << np.uint64(20)
    for j in range(int(samples.max()) + 1):
        now = np.uint64(j)
        seen = ended[row, at]
        taken = np.flatnonzero((samples == j).any(axis=1))
        keys[:, taken] = _mixed(keys[:, taken] ^ (seen[:, taken] + now))
        # A random bit of table, step and word decides whether the walk moves on.
        at = np.minimum(at + (_mixed(seen + table + now) & np.uint64(1)).astype(np.int64), n)
    return keys


def edited(item: np.ndarray, edits: int, draw: np.random.Generator) -> np.ndarray:
    """The item after random word edits, cut or filled by unknown words to its length."""
    words = item.tolist()
    for _ in range(edits):
        place, kind = int(draw.integers(len(words))), int(draw.integers(3))
        words[place : place + (kind != 0)] = [] if kind == 2 else [0]
    return np.array((words + [0] * len(item))[: len(item)], np.int64)


class Tables:
    """The bit-sampling tables of all items of one length."""

    def __init__(self, numbers: list[int], items: list[np.ndarray]):
        self.edits = allowed(len(items[0]))
        self.count = self._needed(items)
        self.found: list[dict[int, list[int]]] = [defaultdict(list) for _ in range(self.count)]
        for number, keys in zip(numbers, embedded(np.stack(items), self.count).tolist()):
            for table, key in zip(self.found, keys):
                table[key].append(number)

    def _needed(self, items: list[np.ndarray]) -> int:
        """Tables for RECALL at the most edits, by the share of a table's agreements on edited items, least over four trials."""
        if not self.edits:
            return 1
        draw, shares = np.random.default_rng(SEED), []
        some = items[:: max(1, len(items) // TRIED)]
        some = some * max(1, TRIED // len(some))
        for _ in range(4):
            there = embedded(np.stack(some), 16) == embedded(np.stack([edited(x, self.edits, draw) for x in some]), 16)
            shares.append(there.mean())
        share = min(max(min(shares), 0.01), 0.999)
        return int(min(MOST_TABLES, max(4, np.ceil(2 * np.log(1 - RECALL) / np.log(1 - share)))))

    def agreeing(self, windows: np.ndarray) -> Iterator[set[int]]:
        """Per window the items that agree with it in some table."""
        for keys in embedded(windows, self.count).tolist():
            yield {i for table, key in zip(self.found, keys) for i in table.get(key, ())}


def best_place(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of the item to a stretch of ``words``, with the stretch: earliest end, longest start."""
    m = len(words)
    row, begin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    step = np.arange(m + 1)
    for i, w in enumerate(item):
        down = row + 1
        across = row[:-1] + (words != w)
        fresh, origin = down.copy(), begin.copy()
        better = across < fresh[1:]
        fresh[1:][better] = across[better]
        origin[1:][better] = begin[:-1][better]
        # Insertions run along the row: the running minimum of value minus place.
        low = np.minimum.accumulate(fresh - step)
        source = np.maximum.accumulate(np.where(fresh - step == low, step, 0))
        row, begin = low + step, origin[source]
    end = int(row.argmin())
    return int(row[end]), int(begin[end]), end


class Matcher:
    """A block of items, ready to be sought in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        cut = [(key, WORD.findall(text.lower())) for key, text in items]
        self.items = [(key, words) for key, words in cut if words]
        self.number = {w: i for i, w in enumerate(dict.fromkeys(w for _, ws in self.items for w in ws), 1)}
        self.number |= {w.encode(): i for w, i in self.number.items()}
        self.words = [np.array([self.number[w] for w in ws], np.int64) for _, ws in self.items]
        # Runs of g words of the items, by g: sorted codes and where each occurs.
        self.runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        found = defaultdict(list)
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.most = np.array([allowed(n) for n in self.length.tolist()], np.int64)
        runs = np.minimum(3, -(-(self.length - self.most) // (self.most + 1)))
        self.least = np.maximum(1, self.length + 1 - runs - self.most * runs)
        for i, (w, g) in enumerate(zip(self.words, runs.tolist())):
            found[g] += [(code, i, o) for o, code in enumerate(self._codes(w, g).tolist())]
        for g, rows in found.items():
            rows.sort()
            codes, which, offsets = (np.array(c, np.int64) for c in zip(*rows))
            self.runs[g] = codes, which, offsets
        by_length = defaultdict(list)
        for i, n in enumerate(self.length.tolist()):
            by_length[n].append(i)
        self.tables = {n: Tables(group, [self.words[i] for i in group]) for n, group in by_length.items()}

    def _codes(self, words: np.ndarray, g: int) -> np.ndarray:
        """Runs of g words as numbers; -1 where a word is in no item."""
        base = len(self.number) // 2 + 1
        m = max(0, len(words) - g + 1)
        code, known = np.zeros(m, np.int64), np.ones(m, bool)
        for i in range(g):
            code = code * base + words[i : m + i]
            known &= words[i : m + i] > 0
        return np.where(known, code, -1)

    def numbers(self, text: str) -> np.ndarray:
        """Word numbers of a text, 0 for words of no item."""
        lower = text.lower()
        found = lower.encode().translate(GAPS).split() if lower.isascii() else WORD.findall(lower)
        return np.fromiter(map(self.number.get, found, repeat(0)), np.int64, len(found))

    def candidates(self, words: np.ndarray, ends: np.ndarray) -> Iterator[list[tuple[int, int, np.ndarray]]]:
        """Lists of (text, item, ascending diagonals) where the item may occur; ``words`` holds texts up to their ``ends``.

        What places and items share is expanded in slices: first counted per text and item, then laid out for as many
        pairs as fit together.
        """
        span = len(words) + 4 * int(self.length.max(initial=0)) + 1
        for g, (codes, which, offsets) in self.runs.items():
            seen = self._codes(words, g)
            places = np.flatnonzero(seen >= 0)
            low = np.searchsorted(codes, seen[places], "left")
            many = np.searchsorted(codes, seen[places], "right") - low
            some = many > 0
            places, low, many = places[some], low[some], many[some]
            upto = np.concatenate([[0], np.cumsum(many)])

            def shared(first: int, last: int, low=low, many=many, places=places, which=which, offsets=offsets, upto=upto):
                """(pair, diagonal) of what the places from ``first`` to ``last`` share, in slices."""
                while first < last:
                    stop = min(last, max(first + 1, int(np.searchsorted(upto, upto[first] + EXPANDED, "right")) - 1))
                    m = many[first:stop]
                    row = np.repeat(low[first:stop] - (upto[first:stop] - upto[first]), m) + np.arange(m.sum())
                    at = np.repeat(places[first:stop], m)
                    yield np.searchsorted(ends, at, "right") * len(self.items) + which[row], at - offsets[row]
                    first = stop

            counted = [np.unique(pair, return_counts=True) for pair, _ in shared(0, len(places))]
            if not counted:
                continue
            pairs, back = np.unique(np.concatenate([c[0] for c in counted]), return_inverse=True)
            times = np.bincount(back, np.concatenate([c[1] for c in counted])).astype(np.int64)
            # A text and item with too few runs in common have too few on any band.
            enough = times >= self.least[pairs % len(self.items)]
            pairs, times = pairs[enough], times[enough]
            bounds, start = np.concatenate([[0], np.cumsum(times)]), 0
            while start < len(pairs):
                stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + EXPANDED, "right")) - 1)
                yield self._on_bands(pairs[start:stop], shared, places, ends, span)
                start = stop

    def _on_bands(self, pairs: np.ndarray, shared, places: np.ndarray, ends: np.ndarray, span: int) -> list[tuple[int, int, np.ndarray]]:
        """The diagonals of the ``pairs`` around which enough runs are shared."""
        texts = pairs[[0, -1]] // len(self.items)
        first = np.searchsorted(places, ends[texts[0] - 1] if texts[0] else 0)
        last = np.searchsorted(places, ends[texts[1]])
        kept = []
        for pair, diagonal in shared(int(first), int(last)):
            at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            fits = pairs[at] == pair
            kept.append((at[fits], diagonal[fits]))
        at, diagonals = (np.concatenate([k[i] for k in kept]) for i in (0, 1))
        key = at * span + diagonals
        order = np.argsort(key, kind="stable")
        key, at, diagonals = key[order], at[order], diagonals[order]
        items = pairs[at] % len(self.items)
        # A band of width 2k to both sides of a diagonal holds all of a match that lies on it.
        reach = 2 * self.most[items]
        good = np.searchsorted(key, key + reach, "right") - np.searchsorted(key, key - reach, "left") >= self.least[items]
        at, diagonals = at[good], diagonals[good]
        firsts = np.flatnonzero(np.diff(at, prepend=-1))
        return [(*divmod(int(pairs[at[f]]), len(self.items)), np.unique(some)) for f, some in zip(firsts.tolist(), np.split(diagonals, firsts[1:]))]

    def _agreeing(self, some: list[tuple[int, int, np.ndarray]], each: list[np.ndarray]) -> dict[tuple[int, int], list[int]]:
        """(text, item) -> starts of the windows that agree with the item in a table; ``some`` has starts of windows."""
        wanted = defaultdict(set)
        for x, i, starts in some:
            wanted[int(self.length[i])].update((x, s) for s in starts.tolist())
        agreed = defaultdict(list)
        for n, windows in wanted.items():
            ordered = sorted(windows)
            for at in range(0, len(ordered), 1024):
                part = ordered[at : at + 1024]
                rows = np.zeros((len(part), n), np.int64)
                for row, (x, s) in zip(rows, part):
                    a, b = max(0, s), min(len(each[x]), s + n)
                    row[a - s : max(a, b) - s] = each[x][a : max(a, b)]
                for (x, s), items in zip(part, self.tables[n].agreeing(rows)):
                    for i in items:
                        agreed[x, i].append(s)
        return agreed

    def find(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """Per text, (item number, distance, first word, end word) of every item found, by item."""
        each = [self.numbers(t) for t in texts]
        gap = np.zeros(1, np.int64)
        words = np.concatenate([x for w in each for x in (w, gap)]) if each else gap
        ends = np.cumsum([len(w) + 1 for w in each])
        found: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        for some in self.candidates(words, ends):
            some = [(x, i, diagonals - (int(ends[x]) - len(each[x]) - 1)) for x, i, diagonals in some]
            agreed = self._agreeing(some, each)
            for x, i, starts in some:
                near = np.array(agreed.get((x, i), []), np.int64)
                hits = [self._align(i, each[x], near), None]
                # Not the item itself where the tables point: a nearer place may lie on the other diagonals.
                if not hits[0] or hits[0][0]:
                    hits[1] = self._align(i, each[x], starts)
                if hits := [h for h in hits if h]:
                    found[x][i] = min(hits)
        return [[(i, *hits[i]) for i in sorted(hits)] for hits in found]

    def _align(self, i: int, words: np.ndarray, starts: np.ndarray) -> tuple[int, int, int] | None:
        """The best (distance, first, end) within the allowed edits around ascending ``starts``."""
        n, k, best = int(self.length[i]), int(self.most[i]), None
        # Starts that overlap in their reach are verified as one stretch.
        for some in np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1) if len(starts) else []:
            first = max(0, int(some[0]) - 2 * k)
            distance, a, b = best_place(self.words[i], words[first : max(0, int(some[-1]) + n + 2 * k)])
            if distance <= k and (best is None or distance < best[0]):
                best = distance, first + a, first + b
            if distance == 0:  # no later place is better
                break
        return best


def places(text: str, hits: list[tuple[int, int, int, int]]) -> list[tuple[int | None, int | None]]:
    """Start and end of each hit in code points; unknown where lower-casing changes the length of the text."""
    if not hits or len(text.lower()) != len(text):
        return [(None, None)] * len(hits)
    spans = [m.span() for m in WORD.finditer(text.lower())]
    return [(spans[a][0], spans[b - 1][1]) for _, _, a, b in hits]


def _blocks(benchmark: DataFrame) -> Iterator[Matcher]:
    """Matchers of all items, each of about BLOCK_WORDS words: what a task and the driver hold is bounded."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + total // (4 * BLOCK_WORDS)
    numbered = items.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(n)))
    for b in range(n):
        yield Matcher([(r["item_id"], r["text"]) for r in numbered.where(F.col("block") == b).orderBy("item_id", "text").collect()])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, similarity, start, end) of every item found in a document, in code points.

    A scan of the documents per block of items, no shuffle.
    """
    found = None
    for matcher in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(matcher)

        def make(shared=shared):
            matcher = shared.value

            def step(batch):
                out = []
                for some in portions(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())), PORTION):
                    for (key, text), hits in zip(some, matcher.find([t for _, t in some])):
                        out += [(key, matcher.items[i][0], d, 1 - d / len(matcher.words[i]), *place) for (i, d, *_), place in zip(hits, places(text, hits))]
                columns = list(zip(*out)) if out else [()] * 6
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64()]
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "item_id", "distance", "similarity", "start", "end"])

            return step

        rows = map_batches(keyed_texts(docs), make, MATCHES)
        found = rows if found is None else found.unionByName(rows)
    return found


def drop_matching(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    columns = docs.columns
    for matcher in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(matcher)

        def make(shared=shared):
            matcher, at = shared.value, columns.index("text")

            def step(batch):
                rows = [(t or "",) for t in batch.column(at).to_pylist()]
                clean = [not hits for some in portions(rows, PORTION) for hits in matcher.find([t for (t,) in some])]
                return batch.filter(pa.array(clean, pa.bool_()))

            return step

        docs = map_batches(docs, make, docs.schema)
    return docs
