r"""Chat formatting checked by a grammar round trip.

Grammar of a formatted conversation::

    conversation := turn*
    turn         := "<s>" role "\n" body "</s>"
    body         := "[INST] " text " [/INST]"     for the role user
                  | text                          for any other role

The four control strings are reserved: neither role nor text may hold one. A turn is rendered plainly first and parsed again. Where
the parse does not give back exactly that turn, its role and text are escaped and parsed again;
the escape splits every control string with an escape character, and doubles
as "ESC 0" what was an escape character already, so it can always be undone.
The whole conversation is then parsed once more, and only an equal sequence of
turns counts as ``round_trip``.

Defined results
* NULL role or text counts as empty. A NULL conversation id is a conversation.
* Turns are ordered by (turn, role, text), NULL turns first; repeated rows are
  repeated turns.
* Only the named columns are read; further ones may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ESC = "\x1b"
# control strings of the template
OPEN, CLOSE, INST, INST_END = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = [OPEN, CLOSE, INST, INST_END]


def escaped(value: Column) -> Column:
    """``value`` without control strings or line ends in a role's way; undone by ``unescaped``."""
    out = F.replace(value, F.lit(ESC), F.lit(ESC + "0"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + ESC + mark[1:]))
    return out


def unescaped(value: Column) -> Column:
    out = value
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark[0] + ESC + mark[1:]), F.lit(mark))
    out = F.replace(out, F.lit(ESC + "n"), F.lit("\n"))
    return F.replace(out, F.lit(ESC + "0"), F.lit(ESC))


def _escaped_role(value: Column) -> Column:
    return F.replace(escaped(value), F.lit("\n"), F.lit(ESC + "n"))


def _before(role: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit("\n"), F.when(role == "user", INST + " ").otherwise(""))


def _after(role: Column) -> Column:
    return F.concat(F.when(role == "user", " " + INST_END).otherwise(""), F.lit(CLOSE))


def parsed_turn(piece: Column) -> Column:
    """(role, body as written) of what stands between two turn ends; NULL if it is no turn."""
    role = F.substring_index(F.substr(piece, F.lit(len(OPEN) + 1)), "\n", 1)
    at = F.lit(len(OPEN)) + F.length(role) + 2
    body = F.substr(piece, at)
    lead, tail = INST + " ", " " + INST_END
    inner = F.substr(body, F.lit(len(lead) + 1), F.greatest(F.length(body) - F.lit(len(lead) + len(tail)), F.lit(0)))
    text = F.when(role == "user", inner).otherwise(body)
    free = reduce(lambda a, b: a & b, [~F.contains(part, F.lit(m)) for part in (role, text) for m in CONTROL])
    wrapped = F.startswith(body, F.lit(lead)) & F.endswith(body, F.lit(tail)) & (F.length(body) >= len(lead) + len(tail))
    well_formed = F.startswith(piece, F.lit(OPEN)) & F.contains(piece, F.lit("\n")) & ((role != "user") | wrapped)
    return F.when(well_formed & free, F.struct(role.alias("role"), text.alias("body")))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, body), still escaped."""
    pieces = F.split(formatted, r"\Q" + CLOSE + r"\E", -1)
    return F.transform(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), parsed_turn)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as (role, text), escapes undone."""
    return F.transform(
        parsed(formatted),
        lambda t: F.struct(unescaped(t["role"]).alias("role"), unescaped(t["body"]).alias("text")),
    )


def _renders_alone(role: Column, text: Column, piece: Column) -> Column:
    """Whether the plain piece parses into exactly this turn."""
    back = read_turns(piece)
    return (F.size(back) == 1) & F.coalesce(back[0] == F.struct(role.alias("role"), text.alias("text")), F.lit(False))


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its id, ``n_turns``, ``formatted``, ``loss_spans`` and ``round_trip``.

    ``loss_spans`` holds [start, end) in code points of every assistant text as
    written; ``round_trip`` says that reading ``formatted`` gave back all turns.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    plain = F.concat(_before(F.col("role")), F.col("text"), _after(F.col("role")))
    rows = rows.withColumn("fits", _renders_alone(F.col("role"), F.col("text"), plain))
    rows = rows.withColumn(
        "as_role", F.when(F.col("fits"), F.col("role")).otherwise(_escaped_role(F.col("role")))
    ).withColumn("as_text", F.when(F.col("fits"), F.col("text")).otherwise(escaped(F.col("text"))))
    lead, tail = _before(F.col("as_role")), _after(F.col("as_role"))
    rows = rows.withColumn("piece", F.concat(lead, F.col("as_text"), tail))
    earlier = Window.partitionBy("conv").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("piece").cast("bigint")).over(earlier), F.lit(0)))
    start = F.col("at") + F.length(lead)
    parts = F.struct(
        "at",
        "piece",
        "role",
        "text",
        F.when(F.col("role") == "assistant", F.struct(start.alias("start"), (start + F.length("as_text")).alias("end"))).alias("loss"),
    )
    whole = rows.groupBy("conv").agg(F.sort_array(F.collect_list(parts)).alias("parts"))
    formatted = whole.select(
        "conv",
        F.size("parts").cast("bigint").alias("n_turns"),
        F.concat_ws("", F.transform("parts", lambda p: p["piece"])).alias("formatted"),
        F.filter(F.transform("parts", lambda p: p["loss"]), lambda s: s.isNotNull()).alias("loss_spans"),
        F.transform("parts", lambda p: F.struct(p["role"].alias("role"), p["text"].alias("text"))).alias("source"),
    )
    return formatted.select(
        F.col("conv").alias(conv_id),
        "n_turns",
        "formatted",
        "loss_spans",
        (read_turns(F.col("formatted")) == F.col("source")).alias("round_trip"),
    )


def read_chats(formatted: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """Digests of what a reader of ``formatted`` recovers: turns, and the text under the loss mask.

    The loss text is cut out of ``formatted`` by ``loss_spans`` and then unescaped, as a trainer would.
    """
    turns = read_turns(F.col("formatted"))
    cut = F.transform(
        "loss_spans",
        lambda s: unescaped(
            F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ),
    )
    masked = F.concat_ws("", cut)
    read = formatted.select(
        F.col(conv_id), turns.alias("turns"), masked.alias("loss"), F.length("formatted").cast("bigint").alias("formatted_chars"), "round_trip"
    )
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = F.col("loss")
    return read.select(
        conv_id,
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
        "round_trip",
    )
