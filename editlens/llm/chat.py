"""Chat formatting: a finite-state machine over roles and a declarative template.

A template names the marks around a turn, the roles that carry loss and the
allowed moves between roles. A conversation becomes a list of text segments, each
with a loss flag; joined, they are the formatted text. Control strings inside
texts are escaped reversibly, so that the turns can be read back.

Escapes: ``<`` followed by any backslashes and ``|`` gains one backslash
(``<|`` becomes ``<\\|``, ``<\\|`` becomes ``<\\\\|``), so that no text holds a mark.
Roles, which end at the first newline, are percent-encoded (``%``, newline,
``<|``) as they share a line with the mark.

All of it is SQL functions; a conversation's turns meet in one row because its
output is one text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: allowed moves; "" is the beginning of a conversation
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", "tool"), "tool": ("assistant",)})
    #: roles a conversation may end on
    final: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")),
                     F.lit("<|"), F.lit("%3C|"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C|"), F.lit("<|")), F.lit("%0A"), F.lit("\n")),
                     F.lit("%25"), F.lit("%"))


def _check(turns: str, t: Template) -> Column:
    """Runs the machine; the number of the first turn out of order (from 0), the
    number of turns if only the end is wrong, or null."""
    moves = [F.lit(f"{a}\n{b}") for a, bs in t.moves.items() for b in bs]
    state = F.aggregate(
        turns, F.struct(F.lit("").alias("at"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("bad")),
        lambda s, x: F.struct(
            x["role"].alias("at"), (s["i"] + 1).alias("i"),
            F.coalesce(s["bad"], F.when(~F.concat(s["at"], F.lit("\n"), x["role"]).isin(*moves), s["i"])).alias("bad")),
        lambda s: F.coalesce(s["bad"], F.when(~s["at"].isin(*t.final), s["i"])))
    return state


def format_chat(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", template: Template = CHATML) -> DataFrame:
    """One row per conversation: conv id, n_turns, segments (array of text,
    loss), formatted, valid, bad_turn.

    Turns are ordered by (turn, role, text), nulls first, so that ties and
    repeated rows (which are kept) have one order. Null roles and texts count as
    empty; an empty or unknown role is formatted like any other and makes the
    conversation invalid. Rows with a null conversation id form one
    conversation. Other columns are ignored.
    """
    t = template
    turn = F.struct(F.col(turn_col).alias("turn"),
                    F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # one struct column: other columns of any name cannot interfere
    convs = rows.select(F.col(conv_col).alias("_conv"), turn.alias("_turn")).groupBy("_conv").agg(
        F.sort_array(F.collect_list("_turn")).alias("_turns"))
    segments = F.flatten(F.transform("_turns", lambda x: F.array(
        F.struct(F.concat(F.lit(t.start), escape_role(x["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(x["text"]).alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
        F.struct(F.lit(f"{t.end}\n").alias("text"), F.lit(False).alias("loss")))))
    out = convs.select("_conv", F.size("_turns").cast("long").alias("n_turns"), segments.alias("segments"),
                       _check("_turns", t).alias("bad_turn"))
    return out.select(F.col("_conv").alias(conv_col), "n_turns", "segments",
                      F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                      F.col("bad_turn").isNull().alias("valid"), "bad_turn")


def read_back(formatted: Column, template: Template = CHATML) -> Column:
    """array<struct<role, text>> from the formatted text."""
    t = template
    pieces = F.filter(F.split(formatted, r"\Q" + t.start + r"\E"), lambda p, i: i > 0)
    role = lambda p: F.substring_index(p, "\n", 1)
    return F.transform(pieces, lambda p: F.struct(
        unescape_role(role(p)).alias("role"),
        unescape(F.substr(p, F.length(role(p)) + 2,
                          F.length(p) - F.length(role(p)) - 1 - len(t.end) - 1)).alias("text")))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
