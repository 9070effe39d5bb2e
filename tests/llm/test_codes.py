"""Token counts, token-id files and BPE codes against the libraries whose results they must equal."""

import hashlib
import json
import os
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from boxweave.llm import idfile, lexicon, queries, tokens
from boxweave.llm.common import Runs
from boxweave.runtime import scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both(odd, documents):
    return odd.select("doc_id", "text").unionByName(documents.selectExpr("doc_id + 1000 as doc_id", "text"))


def test_counts_equal_the_library(both):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {(r.doc_id, len((r.text or "").encode())): r.text or "" for r in both.collect()}
    got = tokens.token_counts(both, PIECES, limit=50).collect()
    assert len(got) == both.count()
    for r in got:
        n = len(lib.encode(texts[r.doc_id, r.n_bytes]))
        assert (r.n_tokens, r.over_limit) == (n, n > 50)


def test_counts_of_an_uncut_text():
    with open(PIECES, "rb") as f:
        pieces = tokens.load_pieces(f.read())
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    source = random.Random(1)
    for _ in range(300):
        text = "".join(source.choice("ab  ,.\néthe😀") for _ in range(source.randint(1, 60)))
        assert tokens.count_tokens("▁" + text.replace(" ", "▁"), pieces) == len(lib.encode(text)), text


def test_id_files_equal_the_library(spark, both):
    lib = Tokenizer.from_file(WORDS)
    path = scratch_path(spark, "ids")
    idfile.write_ids(both, path, WORDS, end_id=2)
    got = sorted(idfile.read_ids(spark, path).collect(), key=lambda r: r.start)
    want = sorted(((r.doc_id, r.text or "") for r in both.collect()), key=lambda r: (r[0] is not None, r[0], r[1]))
    start = 0
    for r, (key, text) in zip(got, want, strict=True):
        ids = lib.encode(text, add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.ids) == (key, start, ids)
        start += len(ids)


def word_coder(pattern=None):
    with open(WORDS, encoding="utf-8") as f:
        spec = json.load(f)
    if pattern:
        spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = pattern
    return idfile.WordIds(json.dumps(spec)), Tokenizer.from_str(json.dumps(spec))


# The file's own pattern; line ends taken with other characters; a look at what follows; a group.
@pytest.mark.parametrize("pattern", [None, r"[a-z]+|[^\sa-z]+|[\n!]+", r"[a-z]+(?=[^,]|$)|[^\sa-z]+", r"([a-z])+|\d"])
def test_words_cut_together_have_the_library_s_ids(monkeypatch, pattern):
    coder, lib = word_coder(pattern)
    monkeypatch.setattr(idfile, "PARTS", 60)
    monkeypatch.setattr(idfile, "ABREAST", 7)
    source = random.Random(4)
    marks = [*"abIL'.,<|>!7 \t\n\x0b\x1c\x85\u00a0éÉÇß\u0130\u0250ΣΑ日ǅ\u0301😀", "'ll", "<|endoftext|>", "<|ENDOFTEXT|>", "don't"]
    for _ in range(20):
        texts = ["".join(source.choices(marks, k=source.randint(0, 60))) for _ in range(20)]
        got = coder.of_texts(pa.array(["dropped", *texts]).slice(1))
        assert [x.tolist() for x in got] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in coder.of_texts(pa.array(["", ""]))] == [[], []]
    broken = [b"a\xe2\x82 \xffb c", b"\xf0\x9f"]
    got = coder.of_texts(pa.array(broken, pa.binary()).view(pa.string()))
    assert [x.tolist() for x in got] == [lib.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in broken]


def test_new_words_of_known_parts_take_no_call_each():
    coder, lib = word_coder()
    names = [f"{a}{b}" for a in "abcdefgh" for b in "aeiou"]
    coder.of_texts(pa.array([" ".join(names) + " , ."]))
    texts = [" ".join(f"{a.upper()},{b}.{c}" for b in names for c in names) for a in names[:5]]
    calls = []
    sys.setprofile(lambda _, event, __: calls.append(event) if event in ("call", "c_call") else None)
    try:
        got = coder.of_texts(pa.array(texts))
    finally:
        sys.setprofile(None)
    assert len(calls) < 1_000  # 8,000 words
    assert [x.tolist() for x in got] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_stretches_hold_every_row_once():
    assert list(idfile.stretches(np.array([3, 3, 9, 0, 1, 4, 4]), 6)) == [(0, 2), (2, 3), (3, 6), (6, 7)]
    assert list(idfile.stretches(np.array([0, 0]), 6)) == [(0, 2)]
    assert list(idfile.stretches(np.array([], np.int64), 6)) == []


def test_packing_round_trip():
    values = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7], np.uint32)
    control, data = idfile.pack(values)
    assert len(control) == 3 and len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4 + 1
    assert idfile.unpack(control, data, len(values)).tolist() == values.tolist()
    assert idfile.unpack(*idfile.pack(values[:0]), 0).tolist() == []


def test_codes_equal_the_library(spark, both):
    lib = Tokenizer.from_file(BYTES)
    for most in (1 << 16, 40, 0):  # all words, some words, and merges alone
        texts = {}
        for r in both.collect():
            texts.setdefault(r.doc_id, r.text or "")
        for r in lexicon.encode(both, BYTES, most).collect():
            assert r.ids == lib.encode(texts[r.doc_id], add_special_tokens=False).ids
    coded = lexicon.encode(both, BYTES)
    for r in lexicon.decode(spark, coded, BYTES).collect():
        assert r.text == texts[r.doc_id]


def test_merges_of_short_and_long_words():
    with open(BYTES, encoding="utf-8") as f:
        vocabulary = lexicon.Vocabulary(f.read())
    source = random.Random(2)
    for _ in range(500):
        word = bytes(source.choice(b"thein gradou!") for _ in range(source.randint(1, 40)))
        assert vocabulary.merge(word) == vocabulary._merge_long([vocabulary.single[b] for b in word])


def test_words_merged_side_by_side(monkeypatch):
    with open(BYTES, encoding="utf-8") as f:
        vocabulary = lexicon.Vocabulary(f.read())
    monkeypatch.setattr(lexicon, "ABREAST", 300)
    source = random.Random(3)
    words = [bytes(source.choice(b"thein gradou!\xc3\xa9") for _ in range(source.randint(1, 70))) for _ in range(1_000)]
    words += [b"a" * n for n in range(1, 60)] + [b"", b"ab" * 24, b"ab" * 200, bytes(range(256))]
    runs = vocabulary.merge_all(words)
    assert [runs.gather(np.array([i])).tolist() for i in range(len(words))] == [vocabulary.merge(w) for w in words]
    assert vocabulary.merge_all([]).rows == 0


def test_few_chunks_remembered_give_the_same_ids(spark, monkeypatch):
    texts = [" ".join(f"w{(i * j) % 97} x\n{j}," for j in range(40)) for i in range(30)] + ["<|endoftext|> a", "a\tb  c", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lib = Tokenizer.from_file(BYTES)
    monkeypatch.setattr(lexicon, "PORTION", 500)
    monkeypatch.setattr(lexicon, "CHUNKS", 20)
    vocabulary, path = lexicon.Vocabulary(lib.to_str()), f"{scratch_path(spark, 'words')}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(lexicon.save(lexicon.Automaton.build([b" x"]), vocabulary.merge_all([b" x"])))
    coder = lexicon.Coder(vocabulary, path)
    for r in docs.collect():
        (ids,) = coder.encode([r.text])
        assert ids.tolist() == lib.encode(r.text, add_special_tokens=False).ids
        assert len(coder.index) <= 20 + len(coder.cutter.chunks(r.text))


def test_automaton_numbers_words_and_shares_suffixes():
    words = sorted({f"{a}{b}ing".encode() for a in "abcdef" for b in "uvwxyz"} | {b"", b"a", b"zzz"})
    auto = lexicon.Automaton.build(words)
    assert auto.number(words).tolist() == list(range(len(words)))
    assert auto.number([b"q", b"auin", b"auingg", b"zz"]).tolist() == [-1] * 4
    assert len(auto.final) < 15
    assert lexicon.Automaton.build([]).number([b"a"]).tolist() == [-1]


def test_runs():
    runs = Runs.of([[1, 2], [], [3]], np.uint32)
    runs.extend([[4] * 5000])
    assert runs.gather(np.array([2, 0, 1])).tolist() == [3, 1, 2]
    assert runs.gather(np.array([3])).tolist() == [4] * 5000


def test_empty_tables(spark, nothing):
    assert tokens.token_counts(nothing, PIECES).count() == 0
    assert lexicon.encode(nothing, BYTES).count() == 0
    path = scratch_path(spark, "ids")
    idfile.write_ids(nothing, path, WORDS, end_id=2)
    assert idfile.read_ids(spark, path).count() == 0


def test_query_digests(spark, monkeypatch, odd):
    monkeypatch.setattr(queries, "table", lambda *_: odd)
    lib = Tokenizer.from_file(WORDS)
    row = {r.doc_id: r for r in queries.op3(spark, "").collect()}[4]
    ids = lib.encode("  a  b \n\n c", add_special_tokens=False).ids + [2]
    assert (row.n_tokens, row.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    row = {r.doc_id: r for r in queries.op8(spark, "").collect()}[6]
    text = {r.doc_id: r.text for r in odd.collect()}[6]
    ids = Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False).ids
    assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
