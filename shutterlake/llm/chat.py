"""Chat formatting whose output is read back before it is trusted.

A turn is written as ``### <Role>: <text>``, a line break, ``</turn>`` and another line break.
``### `` begins a turn and ``</turn>`` ends one wherever no backslash stands before them; that is
all the parser goes by. Every turn is first written as it is and parsed again. If what the parser
finds is not the one turn that was given, control strings inside the text get a backslash; if
that is not enough, the role is escaped as well. Only then do turns become a conversation. All of
it is Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, STOP = "### ", "</turn>"
CONTROL = r"(?:### |</turn>)"
# What a role's characters become if it can not be written as it is; the backslash goes first.
ROLE_ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"), ("\n", "\\n"))
LEARNED = "assistant"  # the role whose texts a model is to learn


def escape_text(text: Column) -> Column:
    """One more backslash before every control string, whatever stands before it already."""
    return F.regexp_replace(text, r"(?<!\\)(\\*+" + CONTROL + ")", r"\\$1")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<!\\)\\(\\*+" + CONTROL + ")", "$1")


def escape_role(role: Column) -> Column:
    for plain, written in ROLE_ESCAPES:
        role = F.replace(role, F.lit(plain), F.lit(written))
    return role


def unescape_role(role: Column) -> Column:
    for plain, written in reversed(ROLE_ESCAPES):
        role = F.replace(role, F.lit(written), F.lit(plain))
    return role


def written(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit(": "), text, F.lit(f"\n{STOP}\n"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text as ``array<struct<role, text>>``.

    A turn begins at every control string ``### `` without a backslash before it. A piece that
    does not end as a turn does, that holds another end, or that has no role, becomes a turn
    with NULL role and text; so does anything before the first turn.
    """
    pieces = F.split(formatted, r"(?<!\\)### ", -1)
    rest = F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1)))
    turns = F.transform(rest, parse_turn)
    nothing = F.struct(F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    return F.when(F.get(pieces, F.lit(0)) == "", turns).otherwise(F.concat(F.array(nothing), turns))


def parse_turn(piece: Column) -> Column:
    tail = len(STOP) + 2
    colon = F.instr(piece, ": ")
    body = F.substring(piece, F.lit(1), F.greatest(F.length(piece) - tail, F.lit(0)))
    text = F.substring(body, colon + 2, F.length(body))
    ends = F.size(F.split(piece, r"(?<!\\)</turn>", -1)) == 2
    good = F.endswith(piece, F.lit(f"\n{STOP}\n")) & ends & (colon > 0) & (F.length(body) > colon)
    role = unescape_role(F.substring(piece, F.lit(1), colon - 1))
    return F.struct(
        F.when(good, role).alias("role"), F.when(good, unescape_text(text)).alias("text")
    )


def render(role: Column, text: Column) -> Column:
    """A turn written with as little escaping as lets the parser find it again.

    The last form is always found: in an escaped text no control string is without a backslash,
    none can arise where it touches the template's line breaks, and an escaped role has neither
    control characters nor a colon.
    """
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    plain, careful = written(role, text), written(role, escape_text(text))
    return (
        F.when(parse(plain) == source, plain)
        .when(parse(careful) == source, careful)
        .otherwise(written(escape_role(role), escape_text(text)))
    )


def format_conversations(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row for each conversation: its id, ``formatted``, and ``segments`` under the loss mask.

    ``formatted`` has the turns in order behind each other, ready to be parsed by ``parse``.
    ``segments`` is the same text cut into ``struct<text, loss>``: the loss mask covers what the
    assistant says, as written, and neither the marks of its turns nor other turns. ``n_turns``
    counts the rows.

    Turns are ordered by number, NULL first; rows with the same number by role and text, so
    repeated rows are repeated turns. A null role or text counts as empty. Rows with a null
    conversation id are one conversation. Other columns are not read. Rows are rendered where
    they are; a conversation as a whole, which is one string of the result, meets in one task.
    """
    rows = df.select(
        F.col(conversation).alias("id"),
        F.col(turn).alias("number"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    turns = rows.withColumn("rendered", render(F.col("role"), F.col("text")))
    ordered = F.array_sort(F.collect_list(F.struct("number", "role", "text", "rendered")))
    grouped = turns.groupBy("id").agg(ordered.alias("turns"))
    texts = F.transform("turns", lambda t: t["rendered"])
    segments = F.flatten(F.transform("turns", _segments))
    return grouped.select(
        F.col("id").alias(conversation),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(texts, "").alias("formatted"),
        segments.alias("segments"),
    )


def _segments(turn: Column) -> Column:
    """The text under the mask, with what stands before and behind it in the turn."""
    whole = turn["rendered"]
    begin, behind = F.instr(whole, ": ") + 1, len(STOP) + 2

    def piece(text: Column, loss: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    learned = F.array(
        piece(F.substring(whole, F.lit(1), begin), False),
        piece(F.substring(whole, begin + 1, F.length(whole) - begin - behind), True),
        piece(F.lit(f"\n{STOP}\n"), False),
    )
    return F.when(turn["role"] == LEARNED, learned).otherwise(F.array(piece(whole, False)))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask as it was before escaping, with nothing between."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescape_text(s["text"])), "")


def transcript(formatted: Column) -> Column:
    """Role and text of every turn found in a formatted text, each on lines of its own."""
    lines = F.transform(
        parse(formatted), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    return F.array_join(lines, "")
