"""Chat formatting by event sourcing: fold a log of messages, deltas, edits and regenerations, then render.

Native DataFrame code.  A log row is an event ``conv_id, message, seq, kind, role, text``:
``message`` orders and identifies a message of its conversation, ``seq`` orders its events.

* ``message`` and ``edit`` set the whole text, ``regenerate`` discards it (and sets ``text`` if
  there is one), ``delta`` appends to it.  The role is that of the latest event that has one.

The fold groups by (conversation, message), so that a busy conversation is spread over tasks
and only final messages meet in its single output row.

Defined cases: null texts are empty; null roles are the empty role; a conversation or turn that
is null is a group of its own, first in order; events of equal ``seq`` apply in the order of kind
and text; repeated rows given as messages of their own stay separate turns; an empty log has no output.

Template: ``[INST]role|text[/INST]`` for all roles but the assistant's, whose turns are
``<s>text</s>``.  Inside texts and roles a backslash is doubled and a control string gets one after its first
character, so the markers occur at turn borders only; reading back drops each escaping backslash.
The loss mask covers the assistant's texts without their markers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONTROL = r"([<\[])(/?s>|/?INST\])"
ASSISTANT = "assistant"
KINDS = ("message", "regenerate", "edit", "delta")  # the order in which events of equal seq apply


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, message, role, text`` of an event log."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    event = F.struct("seq", order.alias("order"), F.coalesce("text", F.lit("")).alias("text"), "role")
    log = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("log"))
    last = len(KINDS)
    # Position of the last event that sets the text; deltas before it are lost.
    resets = F.transform("log", lambda e, i: F.when(e["order"] < last, i + 1).otherwise(0))
    kept = F.slice("log", F.greatest(F.array_max(resets), F.lit(1)), F.size("log"))
    roles = F.filter("log", lambda e: e["role"].isNotNull())
    return log.select(
        "conv_id", "message", F.coalesce(F.try_element_at(roles, F.lit(-1))["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(kept, lambda e: e["text"]), "").alias("text"))


def turn_text(role: Column, text: Column) -> Column:
    other = F.concat(F.lit("[INST]"), F.replace(escaped(role), F.lit("|"), F.lit("\\|")), F.lit("|"), escaped(text),
                     F.lit("[/INST]"))
    return F.when(role == ASSISTANT, F.concat(F.lit("<s>"), escaped(text), F.lit("</s>"))).otherwise(other)


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, formatted``, its messages in order."""
    turns = messages.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("message", turn_text(F.col("role"), F.col("text")).alias("turn")))).alias("turns"))
    return turns.select("conv_id", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, formatted, turns``: the array of (role, text, loss) that a formatted conversation holds.

    ``loss`` tells whether the turn's text is under the loss mask.
    """
    pieces = F.filter(F.split("formatted", r"(?<=\[/INST\])|(?<=</s>)"), lambda p: p != "")

    def parsed(p: Column) -> Column:
        mine = p.startswith("<s>")
        body = F.substring(p, F.lit(7), F.length(p) - 13)
        name = F.regexp_extract(body, r"^((?:[^\\|]|\\.)*+)\|", 1)
        text = F.when(mine, F.substring(p, F.lit(4), F.length(p) - 7)).otherwise(
            F.substring(body, F.length(name) + 2, F.length(body)))
        return F.struct(F.when(mine, F.lit(ASSISTANT)).otherwise(unescaped(name)).alias("role"),
                        unescaped(text).alias("text"), mine.alias("loss"))

    return formatted.select("conv_id", "formatted", F.transform(pieces, parsed).alias("turns"))


def digests(read: DataFrame) -> DataFrame:
    """Counts and digests of what was read back from formatted conversations."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return (read.withColumn("_loss", loss).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars")))


def message_events(rows: DataFrame) -> DataFrame:
    """Events of a table of finished turns ``conv_id, turn, role, text``; each row is a message of its own.

    The row number only separates rows that are equal in all else, so its value has no effect.
    """
    row = rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    return row.select(
        "conv_id", F.struct("turn", "role", "text", F.monotonically_increasing_id().alias("row")).alias("message"),
        F.lit(0).cast("long").alias("seq"), F.lit("message").alias("kind"), "role", "text")


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7: two turns that consist of control strings."""
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit(ASSISTANT)).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
