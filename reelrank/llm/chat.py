"""Chat formatting: conversations rebuilt from event logs, rendered with a loss mask.

A log row is an event on one message: ``message`` sets its text, ``delta`` appends to it (a
streamed piece), ``edit`` replaces it and ``regenerate`` empties it for the deltas of a new
answer. Events are folded per message first, in parallel, and messages then per
conversation. DataFrame functions only.

The template marks a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts
``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so no text holds a marker and the output
can be read back; in roles line ends become ``\\n``, so that the first one ends the role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"
#: Turns of these roles are under the loss mask.
LOSS_ROLES = ("assistant",)
#: Events that set a message's text, whatever came before.
RESETS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`: after a backslash a character stands for itself."""
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # Pairs of backslashes are set apart, so that what follows one is never misread.
    parts = F.split(role, r"\\\\", -1)

    def plain(part: Column) -> Column:
        lines = F.replace(part, F.lit("\\n"), F.lit("\n"))
        return F.replace(lines, F.lit("\\|"), F.lit("|"))

    return F.array_join(F.transform(parts, plain), "\\")


def fold_events(events: DataFrame) -> DataFrame:
    """``(conv_id, turn, message, role, text)``: the final messages.

    ``events`` has ``conv_id, turn, message, seq, kind, role, text``; ``message`` tells
    messages of one turn apart. Events count in the order of ``seq``, ties by kind and text;
    other kinds are ignored, null texts are empty. A message's text is that of its last
    resetting event and of the deltas after it; its role is the last one given.
    """
    at = F.struct("seq", "kind", "text", "role")
    text = F.when(F.col("kind") == "regenerate", F.lit("")).otherwise(
        F.coalesce("text", F.lit(""))
    )
    known = events.withColumn("text", text).filter(F.col("kind").isin(*RESETS, "delta"))
    folded = known.groupBy("conv_id", "turn", "message").agg(
        F.sort_array(F.collect_list(at)).alias("log"),
        F.max(F.when(F.col("kind").isin(*RESETS), at)).alias("last"),
        F.max_by("role", F.when(F.col("role").isNotNull(), at)).alias("role"),
    )
    alive = F.filter("log", lambda e: F.col("last").isNull() | (e >= F.col("last")))
    # Events equal in everything sort together; of equal resets one counts.
    resets = F.filter(alive, lambda e: e["kind"].isin(*RESETS))
    deltas = F.filter(alive, lambda e: e["kind"] == "delta")
    joined = F.concat(F.slice(resets, 1, 1), deltas)
    return folded.select(
        "conv_id",
        "turn",
        "message",
        "role",
        F.array_join(F.transform(joined, lambda e: e["text"]), "").alias("text"),
    )


def render(messages: DataFrame, loss_roles=LOSS_ROLES) -> DataFrame:
    """``(conv_id, formatted, segments)`` of messages ``(conv_id, turn, message, role, text)``.

    ``segments`` cuts ``formatted`` into pieces ``(text, loss)``: a turn's head, its text,
    its end. Turns are in order of ``turn``, then ``message``, then role and text; a null
    role or text counts as empty, a null ``turn`` comes first. Rows that repeat are turns of
    their own.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct("turn", "message", role.alias("role"), text.alias("text"))
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def pieces(one: Column) -> Column:
        def piece(content: Column, loss: Column) -> Column:
            return F.struct(content.alias("text"), loss.alias("loss"))

        head = F.concat(F.lit(START), escape_role(one["role"]), F.lit("\n"))
        return F.array(
            piece(head, F.lit(False)),
            piece(escape(one["text"]), one["role"].isin(*loss_roles)),
            piece(F.lit(END + "\n"), F.lit(False)),
        )

    segments = turns.select(
        "conv_id", F.flatten(F.transform("turns", pieces)).alias("segments")
    )
    return segments.withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    ).select("conv_id", "formatted", "segments")


def read_back(rendered: DataFrame) -> DataFrame:
    """``rendered`` with ``turns array<struct<role, text>>`` and ``loss_text`` read from it."""
    parts = F.filter(F.split("formatted", r"<\|im_start\|>", -1), lambda x, i: i > 0)

    def turn(part: Column) -> Column:
        body = F.substring_index(part, END, 1)
        role = F.substring_index(body, "\n", 1)
        text = F.substr(body, F.length(role) + 2)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    under = F.filter("segments", lambda s: s["loss"])
    return rendered.withColumn("turns", F.transform(parts, turn)).withColumn(
        "loss_text", F.array_join(F.transform(under, lambda s: unescape(s["text"])), "")
    )


def digests(rendered: DataFrame) -> DataFrame:
    """Counts and digests of what :func:`read_back` finds."""
    spoken = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
        "",
    )
    return read_back(rendered).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def message_events(rows: DataFrame) -> DataFrame:
    """A log of finished messages from rows ``(conv_id, turn, role, text)``.

    Every row is a message; those of one turn are numbered in the order of role and text.
    """
    place = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    return rows.select(
        "conv_id",
        "turn",
        F.row_number().over(place).alias("message"),
        F.lit(0).cast("long").alias("seq"),
        F.lit("message").alias("kind"),
        "role",
        "text",
    )
