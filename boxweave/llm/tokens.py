"""Token counts by byte-pair merging over a heap and a linked list, without producing identifiers.

A null or empty text has 0 tokens, a text of any length is counted whole, repeated rows are counted
alike, equal ranks merge leftmost first, an empty table gives an empty result, and columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from boxweave.llm.common import Memo, keyed_texts, map_batches

SPACE = "▁"
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def load_pieces(model: bytes) -> dict[str, float]:
    """Mergeable piece -> rank (lower merges first) of a piece model."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    plain = (i for i in range(lib.get_piece_size()) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i)))
    return {lib.id_to_piece(i): -lib.get_score(i) for i in plain}


def cutter(pieces: dict[str, float]) -> re.Pattern | None:
    """A pattern whose matches can be merged apart: no piece spans one of its cuts.

    A cut lies before a run of spaces, and before those punctuation marks that no piece holds behind a
    letter or another uncut character. None if some piece has a space behind another character.
    """
    after: dict[str, set[str]] = {}
    for p in pieces:
        for a, b in zip(p, p[1:]):
            after.setdefault(b, set()).add(a)
    if after.get(SPACE, set()) - {SPACE}:
        return None
    marks = {c for p in pieces for c in p if not (c.isalnum() or c == SPACE)} | {"\n", "\t", "\r"}
    while unsafe := {c for c in marks if after.get(c, set()) - marks - {SPACE}}:
        marks -= unsafe
    cut = re.escape("".join(sorted(marks)))
    if not marks:
        return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
    return re.compile(f"{SPACE}*[{cut}]*[^{SPACE}{cut}]+|{SPACE}*[{cut}]+|{SPACE}+")


def count_tokens(text: str, pieces: dict[str, float]) -> int:
    """Initial symbols minus merges; a character that is no piece counts as its UTF-8 bytes."""
    part: list[str | None] = list(text)
    n = len(part)
    heap = []
    for i in range(n - 1):
        rank = pieces.get(part[i] + part[i + 1])
        if rank is not None:
            heap.append((rank, i, 2))
    count = n
    if heap:
        heapify(heap)
        right = list(range(1, n + 1))
        left = list(range(-1, n - 1))
        while heap:
            _, i, size = heappop(heap)
            a = part[i]
            j = right[i]
            if a is None or j >= n or len(a) + len(part[j]) != size:
                continue
            part[i] = a = a + part[j]
            part[j] = None
            count -= 1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                rank = pieces.get(a + part[k])
                if rank is not None:
                    heappush(heap, (rank, i, size + len(part[k])))
            h = left[i]
            if h >= 0:
                rank = pieces.get(part[h] + a)
                if rank is not None:
                    heappush(heap, (rank, h, len(part[h]) + size))
    for p in part:
        if p is not None and p not in pieces:
            count += len(p.encode()) - 1
    return count


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per document; one scan, no shuffle.

    The model travels as a broadcast (its size is the vocabulary's). Each task merges a distinct piece of
    text between two safe cuts once and remembers its count.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((model, load_pieces(model)))

    def make():
        import sentencepiece

        model, pieces = shared.value
        normal = sentencepiece.SentencePieceNormalizer(model_proto=model)
        pattern = cutter(pieces)
        memo = Memo(lambda w: count_tokens(w, pieces))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, counts = [], []
            for text in batch.column(1).to_pylist():
                sizes.append(len(text.encode()))
                whole = normal.normalize(text)
                words = pattern.findall(whole) if pattern else [whole]
                counts.append(sum(map(memo.__getitem__, words)))
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

        return step

    return map_batches(keyed_texts(docs), make, COUNTS)
