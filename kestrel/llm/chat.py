"""Chat formatting by event-sourced reconstruction. DataFrame functions only.

A log holds events of conversations. ``reconstruct`` groups the events of a message,
sorts them by sequence and folds them into the final message:

``delta``       appends its text;
``edit``        replaces the text so far;
``regenerate``  starts the message over (with its text, if any) and discards every later
                message of the conversation whose events all came before it.

``render`` writes each conversation as one string and marks what a model is trained on:
``loss_spans`` lists (start, length) in bytes of the formatted string's UTF-8 form.

A turn is ``<|role|>``, a line feed, the text, ``</s>`` and a line feed. Inside roles and
texts every ``<``, ``[`` and backslash is followed by an inserted backslash (in roles also
every ``|``), so no text can spell a control string, and ``unescape`` takes the marks out.

Defined results: null roles and texts count as empty, null conversations as one conversation;
an unknown kind of event acts as ``delta``; events of one message with one sequence number fold
as regenerate, edit, delta, then by text; repeated events each count; an empty log gives no
conversations; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ref

OPEN, CLOSE, END = "<|", "|>\n", "</s>\n"


def escape(text: Column, extra: str = "") -> Column:
    return F.regexp_replace(text, rf"([<\[\\{extra}])", r"$1\\")


def unescape(text: Column, extra: str = "") -> Column:
    return F.regexp_replace(text, rf"([<\[\\{extra}])\\", "$1")


def reconstruct(events: DataFrame, conv: str = "conv_id", message: str = "message", seq: str = "seq", kind: str = "kind", role: str = "role", text: str = "text") -> DataFrame:
    """One row per final message: conv, message (orders the conversation), role, text."""
    rank = F.when(ref(kind) == "regenerate", 0).when(ref(kind) == "edit", 1).otherwise(2)
    event = F.struct(ref(seq).alias("seq"), rank.alias("rank"), F.coalesce(ref(text), F.lit("")).alias("text"), F.coalesce(ref(role), F.lit("")).alias("role"))
    log = events.groupBy(ref(conv).alias("conv"), ref(message).alias("message")).agg(F.array_sort(F.collect_list(event)).alias("log"))
    restart = F.array_max(F.transform("log", lambda e, i: F.when(e["rank"] < 2, i).otherwise(F.lit(0))))
    live = F.slice("log", restart + 1, F.size("log"))
    folded = log.select(
        "conv",
        "message",
        F.element_at("log", -1)["role"].alias("role"),
        F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"),
        F.element_at("log", -1)["seq"].alias("last_seq"),
        F.array_max(F.transform("log", lambda e: F.when(e["rank"] == 0, e["seq"]))).alias("regenerated"),
    )
    earlier = Window.partitionBy("conv").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    discarded = F.max("regenerated").over(earlier) > F.col("last_seq")
    kept = folded.withColumn("gone", F.coalesce(discarded, F.lit(False))).where(~F.col("gone"))
    return kept.select("conv", "message", "role", "text")


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv, formatted, loss_spans (array of start and length in bytes)."""
    head = F.concat(F.lit(OPEN), escape("role", "|"), F.lit(CLOSE))
    body = escape("text")
    parts = messages.select("conv", "message", "role", F.concat(head, body, F.lit(END)).alias("turn"), F.octet_length(head).alias("head"), F.octet_length(body).alias("body"))
    before = Window.partitionBy("conv").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.octet_length("turn")).over(before), F.lit(0)) + F.col("head")
    parts = parts.withColumn("span", F.struct(start.cast("long").alias("start"), F.col("body").cast("long").alias("length")))
    turns = F.array_sort(F.collect_list(F.struct("message", "turn")))
    spans = F.array_sort(F.collect_list(F.when(F.col("role") == loss_role, F.col("span"))))
    return parts.groupBy("conv").agg(turns.alias("t"), spans.alias("loss_spans")).select(
        "conv", F.array_join(F.transform("t", lambda x: x["turn"]), "").alias("formatted"), "loss_spans"
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), escapes taken out."""
    pieces = F.split(formatted, END)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, CLOSE, 1)
        text = F.substr(piece, F.length(role) + len(CLOSE) + 1)
        return F.struct(unescape(F.substr(role, F.lit(len(OPEN) + 1)), "|").alias("role"), unescape(text).alias("text"))

    return F.transform(turns, turn)


def loss_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, escapes taken out, in order."""
    raw = F.encode(formatted, "utf-8")
    cut = F.transform(loss_spans, lambda s: unescape(F.substr(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")))
    return F.array_join(cut, "")
