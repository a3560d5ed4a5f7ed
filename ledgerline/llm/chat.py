"""Chat formatting by DataFrame functions alone: a role state machine and a declarative template.

Every turn is written as its role's opening, the escaped text, and its role's closing; the segments
carry a loss flag each. Control strings all start with ``<`` or ``[`` and never continue with a
backslash; escaping puts a backslash behind every ``<``, ``[`` and backslash of a text, so no
control string can come out of a text, and unescaping takes those backslashes away again.

Turns are ordered by turn, then role, then text (so ties and repeated rows have one order); a null
turn comes first; null text and null role count as empty. Roles outside the template are written
with their name. Columns other than conv_id, turn, role and text are not read. One conversation
makes one row: its turns meet in one task, which the result (one string) needs anyway.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPECIAL = r"([<\[\\])"
ESCAPED = r"([<\[\\])\\"
FLAGGED, PLAIN = "1", "0"


@dataclass(frozen=True)
class Template:
    """Openings and closings by role, roles under the loss mask, and the allowed turn order."""

    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<s>[SYS] ", " [/SYS]</s>"),
        "user": ("<s>[INST] ", " [/INST]</s>"),
        "assistant": ("<s>[OUT] ", " [/OUT]</s>"),
    })
    other: tuple[str, str, str] = ("<s>[ROLE] ", " [TEXT] ", " [/TEXT]</s>")
    end: str = "</s>"
    loss: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state; a state is the role last seen
    moves: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })
    accept: tuple[str, ...] = ("assistant",)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, SPECIAL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1")


def _by_role(role: Column, template: Template, part: int, otherwise: Column) -> Column:
    out = F
    for name, marks in template.marks.items():
        out = out.when(role == name, F.lit(marks[part]))
    return out.otherwise(otherwise)


def _pieces(role: Column, text: Column, template: Template) -> Column:
    """Opening, escaped text and closing of a turn."""
    before, between, after = template.other
    opening = _by_role(role, template, 0, F.concat(F.lit(before), escape(role), F.lit(between)))
    closing = _by_role(role, template, 1, F.lit(after))
    return F.struct(opening.alias("opening"), escape(text).alias("text"), closing.alias("closing"))


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, n_turns, formatted, segments (text, loss), valid, first_bad_turn (0-based, or null)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    # escaping happens per turn, before the turns of a conversation meet
    rows = rows.select("conv_id", F.struct("turn", "role", "text", _pieces(F.col("role"), F.col("text"), template)
                                           .alias("pieces")).alias("t"))
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("seen"), F.lit(None).cast("int").alias("bad"),
                     F.lit("").alias("flags"))
    walked = F.aggregate(F.transform("t", lambda x: x["role"]), start, lambda acc, r: _step(acc, r, template))
    conv = conv.select("conv_id", "t", F.size("t").cast("bigint").alias("n_turns"), walked.alias("walk"))

    def emitted(turn: Column, place: Column) -> Column:
        """The segments of a turn; its text is under the loss mask if the machine flagged the turn."""
        flag = F.substring(F.col("walk.flags"), place + 1, F.lit(1)) == FLAGGED
        return F.array(F.struct(turn["pieces"]["opening"].alias("text"), F.lit(False).alias("loss")),
                       F.struct(turn["pieces"]["text"].alias("text"), flag.alias("loss")),
                       F.struct(turn["pieces"]["closing"].alias("text"), F.lit(False).alias("loss")))

    conv = conv.select("conv_id", "n_turns", "walk", F.flatten(F.transform("t", emitted)).alias("segments"))
    return conv.select(
        "conv_id", "n_turns", F.concat_ws("", F.transform("segments", lambda s: s["text"])).alias("formatted"),
        "segments", (F.col("walk.bad").isNull() & F.col("walk.state").isin(list(template.accept))).alias("valid"),
        F.col("walk.bad").alias("first_bad_turn"))


def _step(acc: Column, role: Column, template: Template) -> Column:
    """One move of the state machine, and the loss flag of the state that it enters; a role that may not follow
    is noted, and the walk goes on from it."""
    state = F
    for here, moves in template.moves.items():
        for seen, there in moves.items():
            state = state.when((acc["state"] == here) & (role == seen), F.lit(there))
    to = state.otherwise(F.lit(None).cast("string"))
    entered = F.coalesce(to, role)
    flag = F.when(entered.isin(list(template.loss)), F.lit(FLAGGED)).otherwise(F.lit(PLAIN))
    return F.struct(entered.alias("state"), (acc["seen"] + 1).alias("seen"),
                    F.coalesce(acc["bad"], F.when(to.isNull(), acc["seen"])).alias("bad"),
                    F.concat(acc["flags"], flag).alias("flags"))


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Add ``turns`` (role, text), read from the formatted string, and ``loss_text`` from the segments."""
    before, between, after = template.other
    pieces = F.split("formatted", _literal(template.end))
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        rest = F.substring(piece, F.lit(len(before) + 1), F.char_length(piece))
        parts = F.split(rest, _literal(between), 2)
        role, text = unescape(parts[0]), _without(parts[1], 0, len(after) - len(template.end))
        for name, (opening, closing) in template.marks.items():
            own = piece.startswith(opening)
            role = F.when(own, F.lit(name)).otherwise(role)
            text = F.when(own, _without(piece, len(opening), len(closing) - len(template.end))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return formatted.withColumn("turns", F.transform(pieces, turn)).withColumn("loss_text", F.concat_ws("", loss))


def _without(text: Column, head: int, tail: int) -> Column:
    return F.substring(text, F.lit(head + 1), F.char_length(text) - F.lit(head + tail))


def _literal(mark: str) -> str:
    return r"\Q" + mark + r"\E"
