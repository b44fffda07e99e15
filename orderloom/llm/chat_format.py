"""Chat formatting with a grammar round trip.

A conversation renders as a sequence of turns

    turn  ::=  "<s>[INST] " role " [/INST]" text "</s>"

and is read back by a deterministic parser: split at ``</s>``, then at the first
`` [/INST]``, then unescape. A turn is first rendered as it is. Where the parser does
not give back exactly that turn, its content holds control strings or backslashes and
is rendered again, escaped: a backslash goes behind each backslash and behind the first
character of each control string. Unescaping drops a backslash and keeps what follows,
which undoes that wholly. ``round_trip`` compares the whole parsed conversation with
its source.

Only SQL expressions are used. Rows are grouped by conversation, since a rendered
conversation is one value; one conversation is the largest unit of work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
LEARNED_ROLE = "assistant"

# A backslash, or the first character of a control string.
_CONFLICT = r"\\|[<\[](?=/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONFLICT, r"$0\\")


def unescape(text: Column) -> Column:
    return F.when(text.contains("\\"), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation: array<struct<role, text>>.

    Text that isn't in the grammar gives null fields, equal to no source.
    """
    pieces = F.split(formatted, CLOSE, -1)

    def turn(piece: Column) -> Column:
        body = F.when(piece.startswith(OPEN) & piece.contains(MIDDLE), F.substring(piece, len(OPEN) + 1, 1 << 30))
        role = F.substring_index(body, MIDDLE, 1)
        text = body.substr(F.length(role) + len(MIDDLE) + 1, F.length(body))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    closed = F.when(F.endswith(formatted, F.lit(CLOSE)), F.size(pieces) - 1)
    return F.transform(F.slice(pieces, F.lit(1), closed), turn)


def format_turns(turns: DataFrame) -> DataFrame:
    """Each row's rendered turn: conv_id, turn, role, text, ``level`` and ``rendered``.

    ``level`` is 0 for plain content, 1 for escaped. Null role and text: empty.
    """
    source = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    plain = _render(F.col("role"), F.col("text"))
    same = F.coalesce(
        parse(F.col("_plain")) == F.array(F.struct("role", "text")), F.lit(False)
    )
    escaped = _render(escape(F.col("role")), escape(F.col("text")))
    return (
        source.withColumn("_plain", plain)
        .withColumn("level", F.when(same, 0).otherwise(1))
        .withColumn("rendered", F.when(F.col("level") == 0, F.col("_plain")).otherwise(escaped))
        .drop("_plain")
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text).

    ``formatted``; ``parsed``, its turns read back; ``loss_spans``, where assistants'
    texts stand in it (code points, end exclusive); ``level``, the highest escape
    level; ``round_trip``, whether ``parsed`` is the source.

    Turns are ordered by turn (null first), then role, then text; repeated rows are
    turns of their own. A null conv_id is one conversation. Null role and text are
    empty. An empty table has no conversations. Other columns are not used.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    head = F.lit(len(OPEN)) + F.length(
        F.when(F.col("level") == 0, F.col("role")).otherwise(escape(F.col("role")))
    ) + len(MIDDLE)
    placed = (
        format_turns(turns)
        .withColumn("_size", F.length("rendered").cast("bigint"))
        .withColumn("_end", F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_from", F.col("_end") - F.col("_size") + head)
    )
    entry = F.struct("turn", "role", "text", "_from", "_end", "rendered", "level")
    grouped = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    learned = F.filter("_rows", lambda r: r["role"] == LEARNED_ROLE)
    return (
        grouped.withColumn("formatted", F.array_join(F.transform("_rows", lambda r: r["rendered"]), ""))
        .withColumn("parsed", parse(F.col("formatted")))
        .select(
            "conv_id",
            "formatted",
            "parsed",
            F.transform(
                learned, lambda r: F.struct(r["_from"].alias("start"), (r["_end"] - len(CLOSE)).alias("end"))
            ).alias("loss_spans"),
            F.array_max(F.transform("_rows", lambda r: r["level"])).alias("level"),
            F.coalesce(
                F.col("parsed")
                == F.transform("_rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))),
                F.lit(False),
            ).alias("round_trip"),
        )
    )


def masked_text(parsed: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(F.filter(parsed, lambda t: t["role"] == LEARNED_ROLE), lambda t: t["text"]), ""
    )
