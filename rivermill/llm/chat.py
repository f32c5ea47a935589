"""Chat formatting from event logs (DataFrame functions only).

A log row is an event of a message of a conversation: ``start`` (role and text), ``delta`` (text streamed to its end),
``edit`` (its text anew), ``regenerate`` (its text anew; later messages begun before are dropped, as the conversation goes
on from here) or ``delete``. Logs are partitioned by conversation; the events of a message are sorted by sequence number
and folded: the last event that sets the text, and the deltas after it, make the final message.

The template is ``[INST]role[/INST]text</s>`` per turn after one ``<s>``. In roles and texts each of ``\\``, ``<`` and ``[`` is
followed by a ``\\``, so no control string can occur there, and dropping those marks gives the text back. The output is a
list of segments (text, loss): loss is true for the texts of assistants.

Defined cases: a null text or role is empty; a null conversation id is a conversation of its own; events of one message
with equal sequence numbers apply in the order start, regenerate, edit, delta, delete, then by text; repeated events
apply twice; deltas before any start make a message with an empty role; an unknown kind raises an error; a conversation
of which no message is left gives no row. A conversation is one output row, so one task holds its messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, ROLE, ROLE_END, TURN_END = "<s>", "[INST]", "[/INST]", "</s>"
KINDS = ("start", "regenerate", "edit", "delta", "delete")
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def events_of(rows: DataFrame) -> DataFrame:
    """Every row (conv_id, turn, role, text) as the start of a message of its own, by turn, then role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.select(
        "conv_id", F.row_number().over(order).cast("long").alias("message"), F.lit(0).cast("long").alias("seq"),
        F.lit("start").alias("kind"), "role", "text",
    )


def messages(events: DataFrame) -> DataFrame:
    """conv_id, message, role and text of every final message.

    ``events``: conv_id, message (orders the messages), seq, kind, role, text.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    known = F.when(rank > 0, rank).otherwise(F.raise_error(F.concat(F.lit("unknown kind: "), F.col("kind"))).cast("long"))
    event = F.struct("seq", known.alias("rank"), F.coalesce("text", F.lit("")).alias("text"), "role")
    sets = lambda e: e["rank"] < 4
    folded = (
        events.groupBy("conv_id", "message")
        .agg(F.array_sort(F.collect_list(event)).alias("log"))
        .withColumn("set", F.array_max(F.filter(F.transform("log", lambda e, i: F.when(sets(e), i)), lambda i: i.isNotNull())))
        .withColumn("tail", F.filter("log", lambda e, i: i >= F.coalesce("set", F.lit(0))))
        .withColumn("text", F.array_join(F.transform("tail", lambda e: e["text"]), ""))
        .withColumn("role", F.try_element_at(F.filter("log", lambda e: e["rank"] == 1), F.lit(-1))["role"])
        .withColumn("alive", ~F.exists("tail", lambda e: e["rank"] == 5))
        .withColumn("begun", F.element_at("tail", 1)["seq"])
        .withColumn("redone", F.array_max(F.transform(F.filter("log", lambda e: e["rank"] == 2), lambda e: e["seq"])))
    )
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    cutoff = F.max("redone").over(before)
    current = folded.withColumn("cutoff", cutoff).filter("alive and (cutoff is null or begun > cutoff)")
    return current.select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), "text")


def render(final: DataFrame) -> DataFrame:
    """conv_id and segments (text, loss) of every conversation."""
    turn = F.struct("message", "role", "text")
    listed = final.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def pieces(t: Column) -> Column:
        head = F.concat(F.lit(ROLE), escape(t["role"]), F.lit(ROLE_END))
        loss = t["role"] == LOSS_ROLE
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), loss.alias("loss")),
            F.struct(F.lit(TURN_END).alias("text"), F.lit(False).alias("loss")),
        )

    start = F.array(F.struct(F.lit(OPEN).alias("text"), F.lit(False).alias("loss")))
    return listed.select("conv_id", F.concat(start, F.flatten(F.transform("turns", pieces))).alias("segments"))


def formatted(segments: Column) -> Column:
    """The whole text of a conversation."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_back(rendered: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) parsed from the formatted text, and ``loss``: the unescaped text under the mask."""
    body = F.substring(F.col("formatted"), len(OPEN) + 1, 2**31 - 1)

    def turn(piece: Column) -> Column:
        # Escaped texts hold no control string, so the first end of a role is the only one.
        head = F.locate(ROLE_END, piece)
        role = F.substring(piece, F.lit(len(ROLE) + 1), head - 1 - len(ROLE))
        return F.struct(
            unescape(role).alias("role"), unescape(F.substring(piece, head + len(ROLE_END), F.length(piece))).alias("text")
        )

    def located(piece: Column) -> Column:
        return F.element_at(F.transform(F.array(piece), turn), 1)

    pieces = F.filter(F.split(body, TURN_END, -1), lambda p: p != "")
    under = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return (
        rendered.withColumn("formatted", formatted(F.col("segments")))
        .withColumns({"turns": F.transform(pieces, located), "loss": F.array_join(under, "")})
    )


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation what its formatted output gives back."""
    back = read_back(render(messages(events_of(rows))))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
