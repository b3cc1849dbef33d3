"""Chat formatting from an event log: fold events into messages, render, read back.

A log row is one event: conv_id, seq, kind, message_id, role, text. Kinds:
- `delta`: the text is appended to its message (the first event of a message opens it);
- `edit`: the text replaces all that its message held;
- `regenerate`: the message is emptied and written anew by the events that follow, and
  every message opened after it and before this event is dropped.
Events are folded per message, then messages per conversation, in the order of their first
event. The template writes `<|turn|>role`, a line end, the text and `<|end|>` with a line
end. Control strings inside texts and roles (those of this template and of other common
ones) get a backslash after their first bracket; one that stands there already gets a
further one, so undoing takes away exactly one and any text comes back.

The output holds the rendering as segments (text, loss): the concatenation is the formatted
string, and loss marks what a model is trained on, the texts of assistant messages.

All of it is DataFrame functions. Events are combined per message before conversations are
gathered; a conversation itself is one row of the result, as its digest needs all of it.

Defined cases: a null text is empty, a null role is the empty role, a line end in a role is
spelt on its line and comes back; a null conv_id is a conversation of its own; a null turn comes
first; kinds other than these three are dropped; texts of any length are rendered whole; events with equal seq are taken in order of kind and text; rows
that repeat are events of their own; an empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("delta", "edit", "regenerate")

# The template, and what counts as a control string after its first bracket.
TURN, END = "<|turn|>", "<|end|>"
_CONTROL = r"(?=\||/?s>|/?INST\]|/?SYS>>|/?SYS>|/?INST>)"
_ESCAPE = r"([<\[])(\\*)" + _CONTROL
_UNDO = r"([<\[])\\(\\*)" + _CONTROL
_MARK = "\x1a"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPE), F.lit(r"$1\\$2"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNDO), F.lit("$1$2"))


def role_line(role: Column) -> Column:
    """A role on one line: a line end and the sign that marks it are spelt with that sign."""
    return F.replace(F.replace(role, F.lit(_MARK), F.lit(_MARK + "e")), F.lit("\n"), F.lit(_MARK + "n"))


def role_of(line: Column) -> Column:
    return F.replace(F.replace(line, F.lit(_MARK + "n"), F.lit("\n")), F.lit(_MARK + "e"), F.lit(_MARK))


def messages(events: DataFrame) -> DataFrame:
    """conv_id, message_id, opened, regenerated, role, text: one row per message."""
    log = events.select(
        "conv_id", "message_id", F.col("seq").cast("long").alias("seq"),
        F.coalesce(F.col("kind"), F.lit("delta")).alias("kind"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    replaces = F.col("kind").isin("edit", "regenerate")
    one = log.groupBy("conv_id", "message_id").agg(
        F.min("seq").alias("opened"),
        F.max(F.when(replaces, F.col("seq"))).alias("restart"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
        F.min(F.struct("seq", "kind", "role")).alias("first"),
        F.array_sort(F.collect_list(F.struct("seq", "kind", "text"))).alias("parts"),
    )
    # of several restarts at one seq the last in order of kind counts, then all deltas at or after it
    last = F.array_max(
        F.transform(
            F.filter(
                F.col("parts"),
                lambda p: (p["kind"] != "delta") & (p["seq"] == F.col("restart")),
            ),
            lambda p: F.struct(p["kind"].alias("kind"), p["text"].alias("text")),
        )
    )
    base = F.when(last["kind"] == "edit", last["text"]).otherwise(F.lit(""))
    added = F.filter(
        F.col("parts"),
        lambda p: (p["kind"] == "delta")
        & (F.col("restart").isNull() | (p["seq"] > F.col("restart"))),
    )
    return one.select(
        "conv_id", "message_id", "opened", "regenerated", F.col("first.role").alias("role"),
        F.concat(
            F.coalesce(base, F.lit("")), F.array_join(F.transform(added, lambda p: p["text"]), "")
        ).alias("text"),
    )


def conversations(events: DataFrame) -> DataFrame:
    """conv_id, turns: array of (opened, message_id, role, text) that the log ends with."""
    gathered = messages(events).groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(F.struct("opened", "message_id", "role", "text", "regenerated"))
        ).alias("all")
    )
    again = F.filter("all", lambda m: m["regenerated"].isNotNull())
    stays = F.filter(
        "all",
        lambda m: ~F.exists(
            again, lambda r: (r["opened"] < m["opened"]) & (m["opened"] < r["regenerated"])
        ),
    )
    kept = F.when(F.size(again) == 0, F.col("all")).otherwise(stays)
    return gathered.select("conv_id", kept.alias("turns"))


def rendered(folded: DataFrame) -> DataFrame:
    """conv_id, segments: array of (text, loss) whose texts in a row are the formatted string."""
    def pieces(m: Column) -> Column:
        head = F.concat(F.lit(TURN), escaped(role_line(m["role"])), F.lit("\n"))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(m["text"]).alias("text"), (m["role"] == "assistant").alias("loss")),
            F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")),
        )

    return folded.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("segments"))


def format_chats(events: DataFrame) -> DataFrame:
    """conv_id, formatted, segments."""
    return rendered(conversations(events)).select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
    )


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) parsed from the formatted string, loss_texts from the mask."""
    blocks = F.filter(F.split(F.col("formatted"), F.lit(r"<\|turn\|>")), lambda b: b != "")

    def turn(block: Column) -> Column:
        cut = F.instr(block, "\n")
        text = F.substring(block, cut + 1, F.length(block) - cut - len(END) - 1)
        return F.struct(
            role_of(unescaped(F.substring(block, F.lit(1), cut - 1))).alias("role"),
            unescaped(text).alias("text"),
        )

    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"]))
    return chats.select(
        "conv_id", F.transform(blocks, turn).alias("turns"), masked.alias("loss_texts"), "formatted"
    )


def digests(chats: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    back = read_back(chats)
    plain = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(plain, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def log_of(rows: DataFrame) -> DataFrame:
    """The event log of plain conversation rows: each row is one message, streamed as deltas.

    Equal rows are counted, not gathered, and told apart by their number.
    """
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    told = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    message = F.concat_ws(
        "/", F.coalesce("role", F.lit("")), F.sha2(F.coalesce("text", F.lit("")), 256),
        F.lpad(F.col("copy").cast("string"), 19, "0"),
    )
    return told.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("seq"),
        F.lit("delta").alias("kind"), message.alias("message_id"), "role", "text",
    )
