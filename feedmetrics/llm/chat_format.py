"""Chat logs folded into conversations and rendered with a template that can be read back.

The log is event-sourced: deltas are appended to a message, an edit replaces its text, a
regeneration starts it anew and takes back every message begun after it. All of it is DataFrame code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Template. Inside roles and texts the four characters that start or hold control strings are
# written as a backslash and a letter, so that no control string can occur there.
BEGIN = "<s>"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("[", "\\o"), ("]", "\\c"))    # the backslash first
USER, ASSISTANT = "user", "assistant"
TURN = r"\[INST\] [^\[<]* \[/INST\]|\[ROLE [^\[\]<]*\] [^\[<]* \[/ROLE\]|[^\[<]*</s>"

EVENT_KINDS = ("delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ESCAPES, text)


def unescape(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), text)


def fold(events: DataFrame) -> DataFrame:
    """Final messages of an event log ``conv_id, seq, message, role, kind, text``.

    Kinds are ``delta`` (append), ``edit`` (replace the message's text) and ``regenerate`` (replace
    it, and take back all messages of the conversation that began before this event and stand after
    the message). Returns ``conv_id, message, role, text``.

    Events are ordered by ``seq``, ties by kind, then text. Messages are ordered by ``message``. The
    role is that of the message's first event that has one, or empty. A null text is empty; an
    unknown or null kind counts as ``delta``. Null conversation ids are one conversation.

    A message's events are combined first, so a conversation with very many deltas spreads over
    its messages before it is brought together.
    """
    kind = F.when(F.col("kind").isin(*EVENT_KINDS), F.col("kind")).otherwise("delta")
    clean = events.select(
        "conv_id", "seq", "message", "role", kind.alias("kind"), F.coalesce("text", F.lit("")).alias("text"))
    entry = F.struct("seq", "kind", "text", "role")
    messages = clean.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(entry)).alias("log"),
        F.min("seq").alias("first_seq"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
    )
    # Each replacing event starts the text anew; what counts is the tail from the last one on.
    starts = F.transform(
        F.sequence(F.lit(1), F.size("log")),
        lambda i: F.when(F.element_at("log", i)["kind"] != "delta", i).otherwise(1))
    tail = F.slice("log", F.array_max(starts), F.size("log"))
    roles = F.filter("log", lambda e: e["role"].isNotNull())
    earlier = W.partitionBy("conv_id").orderBy("message").rowsBetween(W.unboundedPreceding, -1)
    return (
        messages
        .withColumn("taken_back", F.max("regenerated").over(earlier))
        .filter("taken_back IS NULL OR first_seq > taken_back")
        .select(
            "conv_id", "message",
            F.coalesce(F.get(roles, F.lit(0))["role"], F.lit("")).alias("role"),
            F.array_join(F.transform(tail, lambda e: e["text"]), "").alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, formatted``, the messages in order within the template.

    User turns stand in ``[INST] ... [/INST]``, assistant turns end with ``</s>``, any other role is
    named in ``[ROLE ...] ... [/ROLE]``. Null roles are empty, null texts too.
    """
    role, text = F.coalesce("role", F.lit("")), escape(F.coalesce("text", F.lit("")))
    turn = (
        F.when(role == USER, F.concat(F.lit("[INST] "), text, F.lit(" [/INST]")))
        .when(role == ASSISTANT, F.concat(text, F.lit("</s>")))
        .otherwise(F.concat(F.lit("[ROLE "), escape(role), F.lit("] "), text, F.lit(" [/ROLE]")))
    )
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("message", turn.alias("turn")))).alias("turns"))
    body = F.array_join(F.transform("turns", lambda t: t["turn"]), "")
    return turns.select("conv_id", F.concat(F.lit(BEGIN), body).alias("formatted"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns of rendered conversations: ``conv_id, formatted, turns array<struct<role, text>>``."""
    found = F.regexp_extract_all(F.substr("formatted", F.lit(len(BEGIN) + 1)), F.lit(TURN), F.lit(0))

    def parse(turn: Column) -> Column:
        inst, named = turn.startswith("[INST] "), turn.startswith("[ROLE ")
        stop = F.instr(turn, "] ")
        role = F.when(inst, F.lit(USER)).when(named, F.substr(turn, F.lit(7), stop - 7)).otherwise(F.lit(ASSISTANT))
        text = (
            F.when(inst, F.substr(turn, F.lit(8), F.length(turn) - 15))
            .when(named, F.substr(turn, stop + 2, F.length(turn) - stop - 9))
            .otherwise(F.substr(turn, F.lit(1), F.length(turn) - 4))
        )
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return formatted.select("conv_id", "formatted", F.transform(found, parse).alias("turns"))


def events_of_turns(conversations: DataFrame) -> DataFrame:
    """The event log of a table ``conv_id, turn, role, text``: each row is one message, in one delta.

    Rows are numbered by turn (null first); rows that share a turn follow by role, then text.
    """
    number = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return conversations.select(
        "conv_id", number.alias("seq"), number.alias("message"), "role", F.lit("delta").alias("kind"), "text")


def format_chats(events: DataFrame) -> DataFrame:
    """Event log to ``conv_id, formatted, turns``: folded, rendered and read back.

    Nulls, ties and repeated events are treated as in ``fold``. Long texts stay whole: a conversation is one
    row. An empty log gives an empty table; other columns are not read.
    """
    return read_back(render(fold(events)))


def digests(chats: DataFrame) -> DataFrame:
    """What the turns read back say, and the text under the loss mask (assistant texts in order).

    A row per conversation, a null id too; one without assistant turns has the digest of the empty text.
    """
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    answers = F.filter("turns", lambda t: t["role"] == ASSISTANT)
    loss = F.array_join(F.transform(answers, lambda t: t["text"]), "")
    return chats.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
