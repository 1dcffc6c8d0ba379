r"""Chat formatting from event logs, in column functions only.

A log has one row per event: conversation, sequence number, turn, kind, role, text. Kinds: "delta" adds its text
to the message of its turn; "edit" replaces that message by its text; "regenerate" empties it, deltas that follow write it anew.
An edit or a regeneration of a turn also withdraws whatever later turns had got before it, as an interface that
branches off there does. Messages are what is left, in order of turns.

Folding goes by (conversation, turn), so a conversation of any length spreads over tasks. What an event may withdraw
further down the conversation is a running maximum over turns, taken by chunks of turns and carried from chunk to
chunk. Rendering is row by row. Only a reader who wants one text of a whole conversation puts its rows together.

Template: <|im_start|>role, newline, text, <|im_end|>, newline. Inside texts and roles each backslash is doubled and
a backslash is put after the first character of every control string, so none survives and unescaping is exact:
a backslash stands for the character after it. Newlines in roles become \n and unescape to newlines.

Defined cases: null texts and roles are empty; null conversations are one conversation, null turns and sequence numbers come
first; of events with the same number, resets go before deltas and then texts decide; a repeated row is a turn or event of
its own; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Fixed strings that chat templates use for control.
CONTROL = (
    START, END, "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
_QUOTED = "|".join(r"\Q" + c[1:] + r"\E" for c in sorted(CONTROL, key=len, reverse=True))
_CONTROL = rf"([<\[])(?=(?:{_QUOTED}))"
_LEARNT = "assistant"
_CHUNK = 10  # bits of a turn's place that are numbered by one task
DELTA = 512


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    """\\n is a newline unless its backslash is the second of a pair; pairs are set aside first."""
    pieces = F.split(role, r"\\\\")
    return F.array_join(F.transform(pieces, lambda p: unescape(F.replace(p, F.lit("\\n"), F.lit("\n")))), "\\")


def events_of(messages: DataFrame, piece: int = DELTA) -> DataFrame:
    """The log that streaming finished messages leaves: each row a turn, its text in deltas of up to piece characters.

    Rows with the same turn are turns of their own, in order of role and text (part counts them).
    """
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.length("text") - 1) / piece), F.lit(0)).cast("int")),
        lambda i: F.substring(F.col("text"), i * piece + 1, F.lit(piece)),
    )
    return (
        messages.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
        .withColumn("part", F.row_number().over(same))
        .select("conv_id", "turn", "part", "role", F.posexplode(cut).alias("_i", "text"))
        .select("conv_id", F.struct("turn", "part", "_i").alias("seq"), "turn", "part", F.lit("delta").alias("kind"), "role", "text")
    )


def fold(events: DataFrame) -> DataFrame:
    """conv_id, turn, part, role, text of the messages that the events leave.

    Columns: conv_id, seq (of any type with an order), turn (whole number), part (order among rows of one turn), kind,
    role, text.
    """
    # The greatest reset of each chunk of turns, and of all chunks before it; narrow rows, no texts.
    resets = events.where(F.col("kind").isin("edit", "regenerate")).groupBy("conv_id", _chunk().alias("_chunk")).agg(F.max("seq").alias("_most"))
    marks = events.select("conv_id", _chunk().alias("_chunk")).distinct().alias("m").join(
        resets.alias("r"), F.col("m.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("m._chunk") == F.col("r._chunk")), "left")
    chunks = Window.partitionBy("m.conv_id").orderBy("m._chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select(F.col("m.conv_id").alias("_c"), F.col("m._chunk").alias("_k"), F.max("_most").over(chunks).alias("_carried"))
    carried = carried.where("_carried is not null")

    event = F.struct("seq", F.when(F.col("kind") == "delta", 1).otherwise(0).alias("o"), "text", "kind", "role")
    turns = events.groupBy("conv_id", _chunk().alias("_chunk"), "turn", "part").agg(F.array_sort(F.collect_list(event)).alias("_e"))
    own = F.array_max(F.transform(F.filter("_e", lambda e: e["o"] == 0), lambda e: e["seq"]))
    inside = Window.partitionBy("conv_id", "_chunk").orderBy("turn", "part").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("_cut", F.max(own).over(inside)).join(
        carried, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_chunk") == F.col("_k")), "left")
    turns = turns.withColumn("_cut", F.greatest("_cut", "_carried"))
    turns = turns.withColumn("_e", F.filter("_e", lambda e: F.col("_cut").isNull() | (e["seq"] > F.col("_cut")))).where(F.size("_e") > 0)
    # From the last reset on: an edit's own text counts, a regeneration's does not.
    turns = turns.withColumn("_last", F.coalesce(F.array_max(F.transform("_e", lambda e, i: F.when(e["o"] == 0, i))), F.lit(0)))
    live = F.filter("_e", lambda e, i: (i >= F.col("_last")) & (e["kind"] != "regenerate"))
    text = F.array_join(F.transform(live, lambda e: F.coalesce(e["text"], F.lit(""))), "")
    role = F.coalesce(F.get(F.filter(F.transform("_e", lambda e: e["role"]), lambda r: r.isNotNull()), F.lit(0)), F.lit(""))
    return turns.select("conv_id", "turn", "part", role.alias("role"), text.alias("text"))


def _chunk() -> Column:
    return F.coalesce(F.shiftright(F.col("turn").cast("long"), _CHUNK), F.lit(-(1 << 60)))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, turn, part, formatted, loss_start, loss_end: one row per message, places in code points of its row.

    A conversation's text is its rows in order of turn; the loss mask covers the assistant's texts.
    """
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    learnt = F.col("role") == _LEARNT
    return messages.select(
        "conv_id", "turn", "part", F.concat(head, body, F.lit(END + "\n")).alias("formatted"),
        F.when(learnt, F.length(head)).otherwise(0).alias("loss_start"),
        F.when(learnt, F.length(head) + F.length(body)).otherwise(0).alias("loss_end"),
    )


def parse(rendered: DataFrame) -> DataFrame:
    """conv_id, turn, part, role, text, learnt (the text under the mask) and size, read back from formatted rows."""
    pattern = r"(?s)^\Q" + START + r"\E([^\n]*)\n(.*)\Q" + END + r"\E\n$"
    part = F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    return rendered.select(
        "conv_id", "turn", "part", unescape_role(F.regexp_extract("formatted", pattern, 1)).alias("role"),
        unescape(F.regexp_extract("formatted", pattern, 2)).alias("text"), unescape(part).alias("learnt"),
        F.length("formatted").cast("long").alias("size"),
    )


def digests(parsed: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest is of one text, so the texts of a conversation, and nothing else, meet in one row here.
    """
    rows = parsed.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.sum("size").alias("formatted_chars"), F.sum(F.length("learnt").cast("long")).alias("loss_chars"),
        F.array_sort(F.collect_list(F.struct("turn", "part", "role", "text", "learnt"))).alias("_m"),
    )
    told = F.array_join(F.transform("_m", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform("_m", lambda m: m["learnt"]), "")
    return rows.select(
        "conv_id", "n_turns", F.sha2(told, 256).alias("turns_sha256"), "loss_chars", F.sha2(learnt, 256).alias("loss_sha256"),
        "formatted_chars",
    )
