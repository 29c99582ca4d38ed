"""Chat formatting by prefix-target expansion: every assistant turn is an example, with all turns before as context.

An example is laid out as text: all turns up to its target, formatted one after another, with a mask under which the
target's text alone is trainable. Turns after the last assistant turn form one example without a target. Texts are
laid out in parts of TURNS turns, so a row is bounded by the turns and not by the conversation; most examples are
one row. As each example repeats its context, the parts' text grows with the square of a conversation's turns, which
is what the expansion means.

Turns are marked by [INST] ... [/INST] or <s> ... </s>. Inside texts, a control string gets a backslash after its
first character, and one that has backslashes there gets one more. So no text holds a control string, and taking one
backslash away restores it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import ship, staged

_ESCAPE = re.compile(r"([<\[])(\\*)(?=/?s>|/?INST\])")
_UNESCAPE = re.compile(r"([<\[])\\(\\*)(?=/?s>|/?INST\])")
#: Turns in a part of an example.
TURNS = 64
_TURN = re.compile(r"\[INST\] ((?:[^\\\n]|\\.)*)\n(.*?) \[/INST\]|<s>(.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def format_turn(role: str | None, text: str | None) -> tuple[str, int, int]:
    """(piece, start and stop of the text that may be trained on); the two are equal for other roles than assistant."""
    inner = escape(text or "")
    if role == "assistant":
        return f"<s>{inner}</s>", 3, 3 + len(inner)
    named = (role or "").replace("\\", "\\\\").replace("\n", "\\n")
    return f"[INST] {escape(named)}\n{inner} [/INST]", 0, 0


def parse_turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted text. As texts hold no control string, each turn ends at the next one."""
    at = 0
    while at < len(text):
        found = _TURN.match(text, at)
        if found is None:
            raise ValueError("not a formatted text")
        at = found.end()
        if found[3] is not None:
            yield "assistant", unescape(found[3])
        else:
            yield re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(found[1])), unescape(found[2])


def _ordered(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions("conv", *order)


def format_conversations(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Pieces: (conv, ordinal, piece, start, stop, loss_start, loss_stop), with places in code points of the stream.

    Rows are taken by turn, null turns first, ties by role and text. A null text is empty; a null role is the role
    of empty name. Rows with a null key are one conversation. Repeated rows are turns of their own. An empty table
    gives no pieces. Columns other than the four named ones are not read. A task reads the rows of a conversation
    in order and in batches, and holds one batch.
    """
    ship(df.sparkSession)
    rows = df.select(df[f"`{key}`"].cast("string").alias("conv"), df[f"`{turn}`"].alias("turn"), df[f"`{role}`"].cast("string").alias("role"), df[f"`{text}`"].cast("string").alias("text"))
    kind = df.schema[key].dataType.simpleString()

    def formatted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, ordinal, at = object(), 0, 0
        for batch in batches:
            out = []
            for conv, r, t in zip(batch["conv"], batch["role"], batch["text"], strict=True):
                if conv != last:
                    last, ordinal, at = conv, 0, 0
                piece, a, b = format_turn(r, t)
                out.append((conv, ordinal, piece, at, at + len(piece), at + a, at + b))
                ordinal, at = ordinal + 1, at + len(piece)
            yield pd.DataFrame(out, columns=["conv", "ordinal", "piece", "start", "stop", "loss_start", "loss_stop"])

    # keys go through Python as text: a batch with a null makes numbers of other keys inexact
    made = _ordered(rows, "turn", "role", "text").mapInPandas(formatted, "conv string, ordinal long, piece string, start long, stop long, loss_start long, loss_stop long")
    return made.withColumn("conv", F.col("conv").cast(kind))


def laid_out(pieces: DataFrame, turns: int = TURNS) -> DataFrame:
    """(conv, ordinal, part, last, text, loss_start, loss_stop): the examples as texts, a row for each part of `turns` turns.

    An example is named by the place of its last turn. loss_start and loss_stop are places in the part's text; the
    mask of a part without trainable text is empty. `last` marks a conversation's longest example, which holds each
    of its turns. The parts before the one that holds the target are shared by many examples and are joined
    to each of them; rows of one part are spread over tasks, also where one conversation has most of the rows.
    """
    placed = pieces.withColumn("part", F.floor(F.col("ordinal") / turns))
    parts = placed.groupBy("conv", "part").agg(F.array_sort(F.collect_list(F.struct("ordinal", "piece", "start", "stop", "loss_start", "loss_stop"))).alias("p"))
    parts = staged(parts.select("conv", "part", "p", F.array_join("p.piece", "").alias("text")), "parts")
    ends = pieces.groupBy("conv").agg(F.max("ordinal").alias("end"))
    # the part that holds the target (or the last turns): the turns up to it, with the mask
    cut = parts.select("conv", "part", "text", F.expr("p[0].start").alias("begin"), F.explode("p").alias("t")).select("conv", "part", "text", "begin", "t.*")
    cut = cut.join(ends.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    chosen = cut.where(F.startswith("piece", F.lit("<s>")) | (F.col("ordinal") == F.col("end")))
    own = chosen.select("conv", "ordinal", "part", (F.col("ordinal") == F.col("end")).alias("last"), F.expr("substring(text, 1, int(stop - begin))").alias("text"), (F.col("loss_start") - F.col("begin")).alias("loss_start"), (F.col("loss_stop") - F.col("begin")).alias("loss_stop"))
    # whole parts before it
    longer = own.where("part > 0").select("conv", "ordinal", "last", F.explode(F.expr("sequence(0L, part - 1)")).alias("before"))
    whole = parts.select(F.col("conv").alias("c"), "part", "text")
    context = longer.join(whole.hint("merge"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("before") == F.col("part")))
    return own.unionByName(context.select("conv", "ordinal", "part", "last", "text", F.lit(0).cast("long").alias("loss_start"), F.lit(0).cast("long").alias("loss_stop")))


def read_back(examples: DataFrame) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), all from the laid-out examples.

    Turns are parsed from the longest example of a conversation, the trainable text is what lies under the mask of
    each example, and formatted_chars is the length of all their texts. A digest reads a conversation's texts in
    order, so one task reads them, in batches, whatever their number.
    """
    kind = examples.schema["conv"].dataType.simpleString()
    named = F.col("conv").cast("string").alias("conv")
    masked = examples.where("loss_stop > loss_start").select(named, F.lit(1).alias("what"), F.col("ordinal").alias("at"), F.expr("substring(text, int(loss_start + 1), int(loss_stop - loss_start))").alias("text"))
    texts = examples.where("last").select(named, F.lit(0).alias("what"), F.col("part").alias("at"), "text")

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, state = object(), None
        row = lambda: (last, state[0], state[1].hexdigest(), state[2], state[3].hexdigest())
        for batch in batches:
            out = []
            for conv, what, text in zip(batch["conv"], batch["what"], batch["text"], strict=True):
                if state is None or conv != last:
                    if state is not None:
                        out.append(row())
                    last, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256()]
                if what:
                    loss = unescape(text)
                    state[2] += len(loss)
                    state[3].update(loss.encode("utf-8", "surrogatepass"))
                else:
                    for role, said in parse_turns(text):
                        state[0] += 1
                        state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
            yield pd.DataFrame(out, columns=columns)
        if state is not None:
            yield pd.DataFrame([row()], columns=columns)

    columns = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    read = _ordered(texts.unionByName(masked), "what", "at").mapInPandas(digests, "conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string")
    read = read.withColumn("conv", F.col("conv").cast(kind))
    sizes = examples.groupBy(F.col("conv").alias("c")).agg(F.sum(F.char_length("text")).alias("formatted_chars"))
    return read.join(sizes, read.conv.eqNullSafe(sizes.c)).drop("c")


def format_and_read(df: DataFrame, key: str = "conv_id", turns: int = TURNS) -> DataFrame:
    """The digests of the examples of all conversations, which are laid out in the shared folder and read back from it."""
    pieces = staged(format_conversations(df, key), "pieces")
    return read_back(staged(laid_out(pieces, turns), "examples")).withColumnRenamed("conv", key)
