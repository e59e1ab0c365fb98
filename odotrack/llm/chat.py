"""Chat formatting over typed content parts.

A message is an ordered list of parts. Each part type has a visitor that yields what the
part writes into the turn, the attachment it refers to, and how many tokens its
placeholder stands for. Text is escaped, so no text can write a control string.

A conversation is written turn by turn and joined at the end. The result has, per
conversation: ``formatted``; ``loss_mask``, one (turn, start, length) per trained turn, in
code points from that turn's first character; ``attachments`` in order; ``n_turns`` and
``expanded_tokens``. ``read_back`` parses ``formatted`` again.

Null text is empty, a null role is an empty role, null or empty parts write nothing.
Null ``conv_id`` is a conversation of its own. Turns go by number, nulls first; turns with
equal numbers go by role and content, so repeated rows stay and the order is fixed. Other
columns of the input are not read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odotrack.llm.common import let, or_empty

START, END = "<|turn|>", "<|end|>"
#: First characters of what templates in use take for control strings.
CONTROL = r"<(?=\||/?s>|/?\w*_of_)|\[(?=/?[A-Z_]+\])"
TRAINED = ("assistant",)

PART = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("pages", T.IntegerType()),
    ]
)


def escape(text: Column) -> Column:
    r"""Doubles each backslash, then puts one behind what could begin a control string."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({CONTROL})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    r"""``escape`` on one line: a line break becomes a backslash and a comma, which nothing
    else does."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\,"))


def unescape_role(role: Column) -> Column:
    # Behind an even number of backslashes the next one is no escaped backslash's half.
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\,", "$1\n"))


@dataclass(frozen=True)
class Visitor:
    """What one part type does; ``tokens`` is None for plain text."""

    write: Callable[[Column], Column]
    tokens: Callable[[Column], Column] | None = None


def _placeholder(kind: str) -> Callable[[Column], Column]:
    return lambda part: F.concat(F.lit(f"<|{kind}:"), escape(or_empty(part["ref"])), F.lit("|>"))


def _known(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


#: Patches of 14 pixels, 25 frames a second, 256 tokens a page.
VISITORS: dict[str, Visitor] = {
    "text": Visitor(lambda part: escape(or_empty(part["text"]))),
    "image": Visitor(
        _placeholder("image"),
        lambda p: F.ceil(_known(p["width"]) / 14) * F.ceil(_known(p["height"]) / 14),
    ),
    "audio": Visitor(_placeholder("audio"), lambda p: F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * 25)),
    "document": Visitor(_placeholder("document"), lambda p: _known(p["pages"]) * 256),
}


def _visit(part: Column, of: Callable[[Visitor], Column], other: Column) -> Column:
    chosen = None
    for kind, visitor in VISITORS.items():
        case = part["type"] == kind
        chosen = F.when(case, of(visitor)) if chosen is None else chosen.when(case, of(visitor))
    return chosen.otherwise(other)


def text_part(text: Column) -> Column:
    """A message of one text part."""
    values = {"type": F.lit("text"), "text": text}
    return F.array(
        F.struct(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PART))
    )


def format_turns(messages: DataFrame, trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """One row per message of (conv_id, turn, role, parts array<PART>)."""
    role, parts = or_empty(F.col("role")), F.coalesce(F.col("parts"), F.array().cast(T.ArrayType(PART)))
    none = F.lit(None).cast("long")
    head = F.concat(F.lit(START), escape_role(role), F.lit("\n"))
    body = F.array_join(F.transform(parts, lambda p: _visit(p, lambda v: v.write(p), F.lit(""))), "")
    tokens = lambda p: _visit(p, lambda v: v.tokens(p).cast("long") if v.tokens else none, none)
    attached = F.transform(
        F.filter(parts, lambda p: tokens(p).isNotNull()),
        lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), tokens(p).alias("tokens")),
    )
    return (
        messages.select("conv_id", "turn", role.alias("role"), head.alias("head"), body.alias("body"), attached.alias("attached"))
        .withColumn("written", F.concat("head", "body", F.lit(END)))
        .withColumn("start", F.when(F.col("role").isin(*trained), F.length("head")))
        .withColumn("length", F.when(F.col("start").isNotNull(), F.length("body")))
    )


def format_chat(messages: DataFrame, trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """One row per conversation."""
    turns = format_turns(messages, trained)
    order = F.struct("turn", "role", "written", "start", "length", "attached")
    joined = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(order)).alias("t"))
    attached = F.flatten(F.transform("t", lambda x: x["attached"]))
    return joined.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["written"]), "").alias("formatted"),
        F.filter(
            F.transform("t", lambda x, i: F.struct(i.alias("turn"), x["start"].alias("start"), x["length"].alias("length"))),
            lambda m: m["start"].isNotNull(),
        ).alias("loss_mask"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` (role, text as it was, placeholders included) and
    ``loss_texts``, both parsed from the formatted string and its mask."""
    written = F.slice(F.split("formatted", r"<\|end\|>"), 1, F.col("n_turns").cast("int"))

    def parsed(turns: Column) -> Column:
        def turn(x: Column) -> Column:
            inner = F.substr(x, F.lit(len(START) + 1))
            return let(
                inner,
                lambda y: F.struct(
                    unescape_role(F.substring_index(y, "\n", 1)).alias("role"),
                    unescape(F.substr(y, F.locate("\n", y) + 1)).alias("text"),
                ),
            )

        def trained(m: Column) -> Column:
            return unescape(F.substr(F.get(turns, m["turn"]), m["start"] + 1, m["length"]))

        return F.struct(
            F.transform(turns, turn).alias("turns"), F.transform("loss_mask", trained).alias("loss_texts")
        )

    return formatted.withColumn("__read", let(written, parsed)).select(
        *formatted.columns, F.col("__read.turns").alias("turns"), F.col("__read.loss_texts").alias("loss_texts")
    )
