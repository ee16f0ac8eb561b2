"""Chat logs to rendered conversations, by event sourcing, with DataFrame functions only (operator 6).

A log holds events (conv_id, seq, message, kind, role, text). Folding a message's events in the order of seq:

* delta: its text is appended to what the message holds (streamed output)
* edit: its text replaces what the message holds
* regenerate: what the message holds is thrown away, and with it all that later messages of the conversation hold, for
  these answered the text that is gone; a later message is there again if events after it write it anew

So an event counts if no earlier message was regenerated after it, the last edit or regenerate that counts is a
message's base, and the message is the base's text (an edit's) and the deltas after it. A message without text stays,
empty, if any of its events counts. An event that is delivered twice (equal in all fields) counts once.

Rendering: each message is `<turn ROLE>TEXT</turn>` and a newline. In roles and texts a backslash is written `\\b`, `<`
as `\\l` and `>` as `\\g`, so a raw `<` is always a control string, and undoing `\\l`, `\\g`, `\\b` in this order restores
every text. segments holds the rendering in runs with a loss flag (the assistant's texts), so formatted is their
concatenation and the mask can't drift from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<turn ", ">", "</turn>\n"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")), F.lit("\\b"), F.lit("\\"))


def fold_messages(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): the final messages of each log. Null kinds count as deltas, null texts as empty,
    a null role as the message's first other role or else ''. Repeated rows are one event. Different events that share
    a sequence number come in the order of kind, role and text (so a regeneration is the last of them), those without
    one first. Null ids form a conversation of their own, null messages its first message."""
    e = events.select(
        "conv_id", "message", "seq", F.coalesce("kind", F.lit("delta")).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text")
    )
    folded = e.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_set(F.struct("seq", "kind", "role", "text"))).alias("events"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("redone"),
    )
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    live = F.filter("events", lambda x: F.col("cut").isNull() | F.coalesce(x["seq"] > F.col("cut"), F.lit(False)))
    base = F.array_max(F.filter("live", lambda x: x["kind"].isin("edit", "regenerate")))
    kept = F.filter("live", lambda x: (x["kind"] != "regenerate") & (F.col("base").isNull() | (x >= F.col("base"))))
    roles = F.filter("live", lambda x: x["role"].isNotNull())
    counted = folded.withColumn("cut", F.max("redone").over(before)).withColumn("live", live).where(F.size("live") > 0).withColumn("base", base)
    return counted.select(
        "conv_id", "message", F.coalesce(F.get(roles, F.lit(0))["role"], F.lit("")).alias("role"), F.array_join(F.transform(kept, lambda x: x["text"]), "").alias("text")
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, segments): a row for each conversation; segments is an array of (text, loss)."""
    turns = F.sort_array(F.collect_list(F.struct("message", "role", "text")))
    segment = lambda text, loss: F.struct(text.alias("text"), F.lit(loss).alias("loss"))
    runs = lambda x: F.array(
        segment(F.concat(F.lit(OPEN), escape(x["role"]), F.lit(CLOSE)), False),
        F.struct(escape(x["text"]).alias("text"), (x["role"] == LEARNED).alias("loss")),
        segment(F.lit(END), False),
    )
    out = messages.groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", F.flatten(F.transform("turns", runs)).alias("segments"))
    return out.select("conv_id", F.array_join(F.transform("segments", lambda x: x["text"]), "").alias("formatted"), "segments")


def format_chats(events: DataFrame) -> DataFrame:
    """Logs to (conv_id, formatted, segments). An empty log table gives no rows; other columns are dropped."""
    return render(fold_messages(events))


def read_back(formatted: Column) -> Column:
    """The turns of a rendering, an array of (role, text)."""
    pieces = F.filter(F.split(formatted, END), lambda x: x != "")
    inner = lambda x: F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), CLOSE, 1)
    return F.transform(
        pieces,
        lambda x: F.struct(
            unescape(inner(x)).alias("role"), unescape(F.substr(x, F.lit(len(OPEN) + 1) + F.length(inner(x)) + F.lit(len(CLOSE)))).alias("text")
        ),
    )


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda x: x["loss"]), lambda x: unescape(x["text"])), "")


def log_of_turns(rows: DataFrame) -> DataFrame:
    """Finished turns (conv_id, turn, role, text) as the log that a streaming client would have written: an assistant's
    text follows a draft that was regenerated and comes in two deltas; another's is an edit of a first wording. Rows of
    a conversation with the same turn keep the order of role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    t = rows.select("conv_id", F.row_number().over(order).alias("message"), "role", F.coalesce("text", F.lit("")).alias("text"))
    seq = F.col("message").cast("long") * 4
    half = F.floor(F.length("text") / 2).cast("int")
    draft = F.substr(F.col("text"), F.lit(1), F.lit(8))
    event = lambda k, kind, text: F.struct((seq + k).alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))
    spoken = F.array(
        event(0, "delta", draft), event(1, "regenerate", F.lit(None).cast("string")),
        event(2, "delta", F.substr(F.col("text"), F.lit(1), half)), event(3, "delta", F.substr(F.col("text"), half + 1)),
    )
    typed = F.array(event(0, "delta", draft), event(1, "edit", F.col("text")))
    log = t.select("conv_id", "message", "role", F.explode(F.when(F.col("role") == LEARNED, spoken).otherwise(typed)).alias("e"))
    return log.select("conv_id", "message", "role", "e.seq", "e.kind", "e.text")
