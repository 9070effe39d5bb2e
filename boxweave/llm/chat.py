r"""Chat formatting with Spark expressions only: a template that marks turns, escaped texts, and the loss mask.

The turns of a conversation are collected as structs and sorted. Adjacent turns of one role become one block, its texts
kept apart by a mark of their own, and the blocks are joined to

    <|role|>user<|text|>first<|next|>second<|end|>\n<|role|>assistant<|text|>answer<|end|>\n

Control strings inside texts and roles, those of the template and those in ``CONTROLS``, get a backslash after their
first character; one that already has backslashes there gets one more, so ``unescape`` undoes exactly that.
``loss_spans`` are the code points [start, end) of the texts of the trained role in the formatted text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The template's marks
ROLE, TEXT, NEXT, END = "<|role|>", "<|text|>", "<|next|>", "<|end|>\n"
# What must not appear in a text as it is, by first character: <| <s> </s> <<SYS>> <</SYS>> [INST] [/INST]
CONTROLS = r"(?:(?<=<)(?=\\*(?:\||/?s>|</?SYS>>))|(?<=\[)(?=\\*/?INST\]))"
# Lengths summed in one step of the running sums; only the time of very long conversations depends on it.
STEP = 256


def escape(text: Column) -> Column:
    """One more backslash behind the first character of every control string."""
    return F.regexp_replace(text, CONTROLS, r"\\")


def unescape(text: Column) -> Column:
    """The text that ``escape`` made this of."""
    return F.regexp_replace(text, CONTROLS + r"\\", "")


def with_value(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running_sums(lengths: Column) -> Column:
    """Per element the sum of all before it: sums within steps, then those of the steps."""

    def sums(values: Column) -> Column:
        return F.aggregate(values, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    firsts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(STEP))
    return with_value(
        F.transform(firsts, lambda first: sums(F.slice(lengths, first, STEP))),
        lambda steps: F.flatten(
            F.zip_with(
                steps,
                F.slice(sums(F.transform(steps, lambda s: F.element_at(s, -1))), F.lit(1), F.size(steps)),
                lambda step, before: F.transform(F.slice(step, F.lit(1), F.size(step) - 1), lambda x: x + before),
            )
        ),
    )


def merge_turns(turns: Column) -> Column:
    """Blocks (role, texts) of adjacent turns of one role, from sorted structs (turn, role, text)."""
    last = F.size(turns)
    starts = F.filter(
        F.sequence(F.lit(1), last), lambda i: (i == 1) | (F.element_at(turns, i)["role"] != F.element_at(turns, F.greatest(i - 1, F.lit(1)))["role"])
    )
    return with_value(
        starts,
        lambda firsts: F.transform(
            firsts,
            lambda first, n: F.struct(
                F.element_at(turns, first)["role"].alias("role"),
                F.transform(F.slice(turns, first, F.coalesce(F.get(firsts, n + 1), last + 1) - first), lambda t: t["text"]).alias("texts"),
            ),
        ),
    )


def format_chats(conversations: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans, n_blocks) per conversation, other columns left behind.

    Turns go by number; null numbers come first, and equal ones by role, then text. Repeated rows are turns of their own.
    A null text or role is the empty one; a null conv_id is a conversation like any other. A table without rows has none.
    A conversation is one row of the result, so its formatted text has to fit in one (2 GB).
    """
    turns = conversations.select(
        "conv_id", F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    blocks = sorted_turns.select("conv_id", with_value(F.col("turns"), merge_turns).alias("blocks"))
    escaped = blocks.select(
        "conv_id",
        F.transform(
            "blocks", lambda b: F.struct(b["role"].alias("role"), escape(b["role"]).alias("shown"), F.transform(b["texts"], escape).alias("texts"))
        ).alias("blocks"),
    )

    def spans(blocks: Column) -> Column:
        """Start and end of every text: it begins behind all earlier ones and the marks between."""
        texts = F.flatten(
            F.transform(
                blocks,
                lambda b: F.transform(
                    b["texts"],
                    lambda text, n: F.struct(
                        F.when(n == 0, F.char_length(b["shown"]) + len(ROLE) + len(TEXT)).otherwise(len(NEXT)).alias("before"),
                        F.char_length(text).alias("length"),
                        F.when(n == F.size(b["texts"]) - 1, len(END)).otherwise(0).alias("after"),
                        (b["role"] == trained_role).alias("trained"),
                    ),
                ),
            )
        )
        return with_value(
            texts,
            lambda parts: F.transform(
                F.filter(
                    F.zip_with(
                        parts,
                        running_sums(F.transform(parts, lambda p: p["before"] + p["length"] + p["after"])),
                        lambda p, at: F.struct((at + p["before"]).alias("start"), (at + p["before"] + p["length"]).alias("end"), p["trained"].alias("trained")),
                    ),
                    lambda s: s["trained"],
                ),
                lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")),
            ),
        )

    shown = F.transform("blocks", lambda b: F.concat(F.lit(ROLE), b["shown"], F.lit(TEXT), F.array_join(b["texts"], NEXT), F.lit(END)))
    return escaped.select("conv_id", F.array_join(shown, "").alias("formatted"), spans(F.col("blocks")).alias("loss_spans"), F.size("blocks").alias("n_blocks"))


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation, texts and roles as they came in."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda b: b.startswith(ROLE))
    return F.flatten(
        F.transform(
            F.transform(blocks, lambda b: F.split(F.substr(b, F.lit(len(ROLE) + 1)), r"<\|text\|>", 2)),
            lambda b: F.transform(
                F.split(F.element_at(b, 2), r"<\|next\|>"), lambda text: F.struct(unescape(F.element_at(b, 1)).alias("role"), unescape(text).alias("text"))
            ),
        )
    )


def read_loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the mask, in order, with nothing between.

    Code points of four bytes each make a span one slice, wherever it is in a long text.
    """
    return with_value(
        F.encode(formatted, "UTF-32"),
        lambda wide: F.array_join(
            F.transform(
                spans,
                lambda s: unescape(F.decode(F.substr(wide, (s["start"] * 4 + 1).cast("int"), ((s["end"] - s["start"]) * 4).cast("int")), "UTF-32")),
            ),
            "",
        ),
    )
