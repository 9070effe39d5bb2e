"""Chat formatting against a plain version: escapes, merged blocks, loss spans, and the registered digest."""

import hashlib
import itertools
import random
import re

from pyspark.sql import functions as F

from boxweave.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"
BITS = ["<", "<|", "|", "\\", "s>", "/s>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[", "/", "<|end|>\n", "<|next|>", "<|text|>", "é😀", " ok ", "\n"]


def plain_format(rows):
    """Formatted text and the texts of the assistant's spans, per conversation."""
    out = {}
    key = lambda v: (v is not None, v if v is not None else 0)
    for conv, group in itertools.groupby(sorted(rows, key=lambda r: key(r[0])), key=lambda r: r[0]):
        turns = sorted(((key(t), role or "", text or "") for _, t, role, text in group))
        whole, spans = "", []
        for role, block in itertools.groupby(turns, key=lambda t: t[1]):
            whole += "<|role|>" + plain_escape(role) + "<|text|>"
            for n, (_, _, text) in enumerate(block):
                whole += "<|next|>" if n else ""
                if role == "assistant":
                    spans.append((len(whole), len(whole) + len(plain_escape(text))))
                whole += plain_escape(text)
            whole += "<|end|>\n"
        out[conv] = (whole, spans, [(role, text) for _, role, text in turns])
    return out


def plain_escape(text):
    """A backslash behind the first character of each control string, also of one that has backslashes there."""
    found = [m.start() for c in ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]") for m in re.finditer(re.escape(c[0]) + r"(?=\\*" + re.escape(c[1:]) + ")", text)]
    for at in sorted(found, reverse=True):
        text = text[: at + 1] + "\\" + text[at + 1 :]
    return text


def check(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("formatted", F.lit("x")).withColumn("turns", F.lit(1))
    found = chat.format_chats(frame).select("*", chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    expected = plain_format(rows)
    assert found.columns == ["conv_id", "formatted", "loss_spans", "n_blocks", "t", "loss"]
    got = {r["conv_id"]: r for r in found.collect()}
    assert set(got) == set(expected)
    for conv, (whole, spans, turns) in expected.items():
        row = got[conv]
        assert row["formatted"] == whole
        assert [(s["start"], s["end"]) for s in row["loss_spans"]] == spans
        assert [(t["role"], t["text"]) for t in row["t"]] == turns
        assert row["loss"] == "".join(text for role, text in turns if role == "assistant")
        assert row["n_blocks"] == len(list(itertools.groupby(turns, key=lambda t: t[0])))


def test_control_strings_and_edges(spark):
    draw = random.Random(5)
    rows = [
        (c, t, draw.choice(["user", "assistant", "assistant", "system", None, "<|text|>"]), "".join(draw.choices(BITS, k=draw.randrange(7))) or None)
        for c in range(150)
        for t in range(draw.randrange(1, 9))
    ]
    rows += [(None, 1, "user", "no id"), (None, None, "assistant", "first"), (500, 3, "user", "tie b"), (500, 3, "user", "tie a"), (500, 3, "assistant", "tie"), (500, 3, "user", "tie a")]
    check(spark, rows)


def test_long_conversation_and_long_text(spark):
    rows = [(1, t, "assistant" if t % 3 else "user", f"<s> turn {t} é") for t in range(1_500)] + [(2, 0, "assistant", "<|" * 200_000), (3, 0, "user", "")]
    check(spark, rows)


def test_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_reads_back_what_went_in(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    quoted = "</s>[INST] ok [/INST]"
    expected = plain_format([*rows, (-1, 0, "user", quoted), (-1, 1, "assistant", quoted)])
    got = {r["conv_id"]: r for r in queries.QUERIES["op11_chat_formatting"](spark, path).collect()}
    assert set(got) == set(expected)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, (whole, _, turns) in expected.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        row = got[conv]
        assert (row["n_turns"], row["turns_sha256"]) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (row["loss_chars"], row["loss_sha256"], row["formatted_chars"]) == (len(loss), sha(loss), len(whole))
