"""Conversations rebuilt from event logs and rendered with a chat template. DataFrame functions only.

A log row is an event: ``conv_id``, ``seq`` (order within the conversation), ``msg`` (the message it
is about), ``kind``, ``role`` and ``text``. Kinds:

- ``start``: the message begins; its first event gives its place, its last ``start`` its role;
- ``delta``: the text is put after what the message holds;
- ``edit``: the text replaces what the message holds; later deltas are put after it;
- ``regenerate``: what the message holds is given up, and so are all messages that begin between it
  and this event; its later deltas make the new text.

Events without order, kind or text: a NULL ``seq`` comes first, an unknown kind changes nothing, a
NULL text is empty, a NULL role is the empty role. Rows with a NULL ``conv_id`` or ``msg`` are one
conversation or message. Equal events count as often as they occur; events with the same ``seq`` are
taken in the order of kind and text.

Events are folded per message before a conversation is put together, so a long conversation is
spread over its messages first. One conversation's rendered text is one value, as the result asks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN = "<|im_start|>"
CLOSE = "<|im_end|>"
END = CLOSE + "\n"


def escape(text: Column) -> Column:
    """Text in which no control string can occur: each ``<``, backslashes, ``|`` gets one more backslash."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """An escaped role also stays on one line."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def fold(events: DataFrame) -> DataFrame:
    """Final messages (``conv_id``, ``place``, ``role``, ``text``) of an event log."""
    resets = F.col("kind").isin("edit", "regenerate")
    events = events.select("conv_id", "seq", "msg", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    messages = events.groupBy("conv_id", "msg").agg(
        F.min(F.struct("seq", "msg")).alias("place"),
        F.max(F.when(F.col("kind") == "start", F.struct("seq", "role"))).alias("started"),
        F.max(F.when(resets, F.struct("seq", "kind", "text"))).alias("reset"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
        F.sort_array(
            F.collect_list(F.when(F.col("kind").isin("delta", "edit"), F.struct("seq", "kind", "text")))
        ).alias("parts"),
    )
    # what the last reset gave up is left out; an edit itself is the first part that stays
    after = lambda part: F.col("reset").isNull() | (
        F.struct(part["seq"], part["kind"], part["text"]) >= F.col("reset")
    )
    text = F.array_join(F.transform(F.filter("parts", after), lambda p: p["text"]), "")
    earlier = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        messages.select("conv_id", "place", F.coalesce("started.role", F.lit("")).alias("role"), text.alias("text"), "regenerated")
        .withColumn("given_up", F.max("regenerated").over(earlier) > F.col("place.seq"))
        .where(F.coalesce("given_up", F.lit(False)) == F.lit(False))
        .drop("given_up", "regenerated")
    )


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: its ``formatted`` text and ``loss_spans``.

    The spans (start, length in code points, from 0) cover the texts of the messages with the role
    ``learn``: the loss mask.
    """
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    own = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    turns = (
        messages.select("conv_id", "place", "role", head.alias("head"), escape(F.col("text")).alias("body"))
        .withColumn("size", F.length("head") + F.length("body") + F.lit(len(END)))
        .withColumn("at", F.coalesce(F.sum("size").over(own), F.lit(0)))
        .withColumn("turn", F.concat("head", "body", F.lit(END)))
    )
    span = F.struct((F.col("at") + F.length("head")).alias("start"), F.length("body").cast("bigint").alias("length"))
    return (
        turns.groupBy("conv_id")
        .agg(
            F.sort_array(F.collect_list(F.struct("place", "turn"))).alias("turns"),
            F.sort_array(F.collect_list(F.when(F.col("role") == learn, span))).alias("loss_spans"),
        )
        .select("conv_id", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"), "loss_spans")
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: an array of structs (role, text), read back from it alone."""
    turns = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda t: t != "")
    begin = len(OPEN) + 1

    def turn(t: Column) -> Column:
        line = F.locate("\n", t)
        return F.struct(
            unescape_role(F.substring(t, F.lit(begin), line - F.lit(begin))).alias("role"),
            unescape(F.substring(t, line + F.lit(1), F.length(t))).alias("text"),
        )

    return F.transform(turns, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    piece = lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return F.array_join(F.transform(spans, piece), "")


def turn_events(conversations: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as an event log.

    Each turn is a message of its own: a start and its text in two deltas. Turns with the same
    number, repeated rows too, follow each other in the order of role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    half = F.ceil(F.length("text") / 2).cast("int")
    event = lambda step, kind, text: F.struct(
        (F.col("msg") * 4 + step).alias("seq"), F.lit(kind).alias("kind"), text.alias("text")
    )
    return (
        conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("msg", F.row_number().over(order).cast("bigint"))
        .withColumn(
            "event",
            F.explode(
                F.array(
                    event(0, "start", F.lit("")),
                    event(1, "delta", F.substring(F.col("text"), F.lit(1), half)),
                    event(2, "delta", F.substring(F.col("text"), half + 1, F.length("text"))),
                )
            ),
        )
        .select("conv_id", "msg", "role", "event.*")
    )
