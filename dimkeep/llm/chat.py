"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A conversation becomes one text; every assistant turn in it is an example of its
own: all that precedes the reply is context, the reply alone is trainable. The
examples of a conversation are prefixes of the same text, so they are kept as
spans of it and written out only where the whole texts are wanted (``expand``).

Template, for each turn::

    <turn ROLE>
    TEXT</turn>

In texts and roles ``\\`` becomes ``\\\\``, ``<turn `` ``\\b`` and ``</turn>`` ``\\e``, and in roles a
line end ``\\n``: a marker in the output is always the template's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template and its escapes.
_OPEN, _CLOSE = "<turn ", "</turn>"
_ESCAPES = (("\\", "\\\\"), (_OPEN, "\\b"), (_CLOSE, "\\e"))


def escape(text: Column) -> Column:
    for plain, coded in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    """Undo ``escape``: doubled backslashes are read first, from the left."""
    parts = F.split(text, r"\\\\")

    def plain(part: Column) -> Column:
        for control, coded in reversed(_ESCAPES[1:]):
            part = F.replace(part, F.lit(coded), F.lit(control))
        return F.replace(part, F.lit("\\n"), F.lit("\n"))

    return F.array_join(F.transform(parts, plain), "\\")


def format_conversations(
    turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trainable: str = "assistant"
) -> DataFrame:
    """A row for each conversation: ``conv_id``, ``text`` and ``examples``, the spans of its trainable turns.

    An example has ``turn`` (position of the reply, from 1) and ``start`` and ``end`` of the
    reply in ``text`` (code points; the context is ``text`` up to ``start``). A
    conversation without a trainable turn has no examples but its text.

    Turns are ordered by ``turn`` (null first), ties by role and text; repeated
    rows are turns of their own. Null roles and texts count as empty, a null id
    is a conversation like others. Other columns are not looked at.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(_OPEN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit(">\n"))
    said = rows.select(
        "conv_id", "turn", "role", "text", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == trainable).alias("train")
    ).withColumn("segment", F.concat("head", "body", F.lit(f"{_CLOSE}\n")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(F.length("segment").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = said.select(
        "conv_id",
        F.row_number().over(order).alias("n"),
        "segment",
        "train",
        (before + F.length("head")).alias("start"),
        (before + F.length("head") + F.length("body")).alias("end"),
    )
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "segment", "train", "start", "end"))).alias("all"))
    spans = F.transform(
        F.filter("all", lambda t: t["train"]),
        lambda t: F.struct(t["n"].cast("long").alias("turn"), t["start"].alias("start"), t["end"].alias("end")),
    )
    return gathered.select("conv_id", F.array_join(F.transform("all", lambda t: t["segment"]), "").alias("text"), spans.alias("examples"))


def examples_of(formatted: DataFrame) -> DataFrame:
    """A row for each example: ``conv_id``, ``turn``, ``start``, ``end`` and ``reply``, the text under its loss mask.

    ``start`` and ``end`` are looked up within the segment in which they lie, whose place in the text
    is the sum of all lengths before it. So a conversation of n turns is read once and not n times.
    """
    segments = formatted.select("conv_id", F.posexplode(F.split("text", f"(?<={_CLOSE}\n)")).alias("_n", "_segment"))
    before = Window.partitionBy("conv_id").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    placed = segments.withColumn("_begin", F.coalesce(F.sum(F.length("_segment").cast("long")).over(before), F.lit(0)))
    spans = formatted.select(F.col("conv_id").alias("_conv"), F.explode("examples").alias("e"))
    found = placed.join(spans, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_n") == F.col("e.turn") - 1))
    reply = F.substring("_segment", (F.col("e.start") - F.col("_begin") + 1).cast("int"), (F.col("e.end") - F.col("e.start")).cast("int"))
    return found.select("conv_id", "e.turn", "e.start", "e.end", reply.alias("reply"))


def expand(formatted: DataFrame) -> DataFrame:
    """The examples written out: ``conv_id``, ``turn``, ``context`` and ``reply``.

    The contexts of a conversation of n turns add up to the square of its length.
    """
    one = formatted.select("conv_id", "text", F.explode("examples").alias("e"))
    return one.select(
        "conv_id",
        F.col("e.turn").alias("turn"),
        F.substring("text", F.lit(1), F.col("e.start").cast("int")).alias("context"),
        F.substring("text", (F.col("e.start") + 1).cast("int"), (F.col("e.end") - F.col("e.start")).cast("int")).alias("reply"),
    )


def turns_of(text: Column) -> Column:
    """The array of (role, text) that a formatted text stands for."""
    segments = F.split(text, f"{_CLOSE}\n")
    whole = F.slice(segments, 1, F.greatest(F.size(segments) - 1, F.lit(0)))
    ended = lambda s: F.locate("\n", s)
    return F.transform(
        whole,
        lambda s: F.struct(
            unescape(F.substring(s, F.lit(len(_OPEN) + 1), ended(s) - len(_OPEN) - 2)).alias("role"),
            unescape(F.substring(s, ended(s) + 1, F.length(s))).alias("text"),
        ),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` of each formatted text."""
    return formatted.select("conv_id", turns_of(F.col("text")).alias("turns"))
