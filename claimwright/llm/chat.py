"""Chat formatting: a finite-state machine over roles and a declarative template.

A conversation's rows are ordered by turn and turned into *segments*: pieces
of text with a loss flag.  Each turn gives an opening marker, its escaped text
and a closing marker, as the template says for its role; the formatted text is
all segments joined.  A state machine over the roles says whether the order of
turns is valid (:data:`TRANSITIONS`); conversations in another order are
formatted too and marked ``valid_order = false``.

Escaping is reversible and keeps every control string out of the texts: the
escape character is doubled out first (``\\`` becomes ``\\0``), then each
control string becomes ``\\a``, ``\\b`` and so on.  As every escape character
of the source is followed by 0, the codes can be undone one after the other,
in the opposite order.  No marker can arise across a border either: a marker's
first character occurs nowhere else in a marker.

DataFrame functions only: one shuffle by conversation.  A conversation is one
value of the result, so its rows meet in one row; nothing else does.

Defined cases: null text is empty; null or unknown roles use the template's
general markers, which carry the (escaped) role, null as the empty role; rows
with equal turn are ordered by role, then text, null first; repeated rows are
repeated turns; rows with a null conversation id form one conversation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """How one role's turn is marked, and whether its text is learned."""
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict[str, Turn] = field(default_factory=lambda: {
        "system": Turn("[SYS]", "[/SYS]"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("<s>", "</s>", loss=True),
    })
    #: Any other role: open, role, between, text, close.
    other: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/ROLE]")
    escape: str = "\\"

    def controls(self) -> list[str]:
        """All control strings, longest first."""
        marks = {m for t in self.roles.values() for m in (t.open, t.close)} | set(self.other)
        return sorted(marks, key=lambda m: (-len(m), m))


#: State machine over roles: (state, role) -> state; anything else is an error state.
TRANSITIONS = {
    ("start", "system"): "system",
    ("start", "user"): "user",
    ("system", "user"): "user",
    ("user", "assistant"): "assistant",
    ("assistant", "user"): "user",
}
ERROR = "error"


def _code(i: int) -> str:
    """Escape code of the i-th control string: a letter, so never the code 0."""
    return "abcdefghijklmnopqrstuvwxyz"[i - 1]


def escape(text: Column, template: Template) -> Column:
    out = F.replace(text, F.lit(template.escape), F.lit(template.escape + "0"))
    for i, mark in enumerate(template.controls(), 1):
        out = F.replace(out, F.lit(mark), F.lit(template.escape + _code(i)))
    return out


def unescape(text: Column, template: Template) -> Column:
    for i, mark in reversed(list(enumerate(template.controls(), 1))):
        text = F.replace(text, F.lit(template.escape + _code(i)), F.lit(mark))
    return F.replace(text, F.lit(template.escape + "0"), F.lit(template.escape))


def _segment(text: Column, loss: bool) -> Column:
    return F.struct(text.alias("text"), F.lit(loss).alias("loss"))


def _turn_segments(turn: Column, template: Template) -> Column:
    body = escape(F.coalesce(turn["text"], F.lit("")), template)
    role = F.coalesce(turn["role"], F.lit(""))
    first, middle, last = (F.lit(m) for m in template.other)
    out = F.array(_segment(F.concat(first, escape(role, template), middle), False), _segment(body, False), _segment(last, False))
    for name, mark in template.roles.items():
        marked = F.array(_segment(F.lit(mark.open), False), _segment(body, mark.loss), _segment(F.lit(mark.close), False))
        out = F.when(role == name, marked).otherwise(out)
    return out


def _valid_order(turns: Column) -> Column:
    table = F.create_map(*[F.lit(x) for (state, role), to in TRANSITIONS.items() for x in (f"{state}>{role}", to)])

    def step(state: Column, turn: Column) -> Column:
        at = F.concat(state, F.lit(">"), F.coalesce(turn["role"], F.lit("")))
        return F.coalesce(F.element_at(table, at), F.lit(ERROR))

    return F.aggregate(turns, F.lit("start"), step) != ERROR


def format_chats(rows: DataFrame, template: Template | None = None, conv: str = "conv_id",
                 turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv``, formatted, segments (text, loss), valid_order."""
    template = template or Template()
    one = F.struct(rows[turn].alias("turn"), rows[role].alias("role"), rows[text].alias("text"))
    chats = rows.groupBy(rows[conv].alias(conv)).agg(F.array_sort(F.collect_list(one)).alias("__turns"))
    segments = F.flatten(F.transform("__turns", lambda t: _turn_segments(t, template)))
    return (chats.withColumn("segments", segments)
            .select(conv, F.array_join(F.col("segments.text"), "").alias("formatted"), "segments",
                    _valid_order(F.col("__turns")).alias("valid_order")))


def read_back(formatted: Column, template: Template | None = None) -> Column:
    """Turns (role, text, loss) of a formatted text, from the text alone."""
    template = template or Template()
    # Texts hold no control string, so the closing markers end the turns.
    ends = [t.close for t in template.roles.values()] + [template.other[2]]
    pieces = F.filter(F.split(formatted, "(?<=" + "|".join(_quoted(e) for e in ends) + ")"), lambda p: p != "")
    first, middle, last = template.other

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(first) + 1), F.length(piece) - len(first) - len(last))
        out = F.struct(unescape(F.substring_index(inner, middle, 1), template).alias("role"),
                       unescape(F.substring_index(inner, middle, -1), template).alias("text"), F.lit(False).alias("loss"))
        for name, mark in template.roles.items():
            body = F.substring(piece, F.lit(len(mark.open) + 1), F.length(piece) - len(mark.open) - len(mark.close))
            out = F.when(F.startswith(piece, F.lit(mark.open)),
                         F.struct(F.lit(name).alias("role"), unescape(body, template).alias("text"),
                                  F.lit(mark.loss).alias("loss"))).otherwise(out)
        return out

    return F.transform(pieces, turn)


def _quoted(mark: str) -> str:
    return "\\Q" + mark + "\\E"
