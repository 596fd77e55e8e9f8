"""Chat formatting from a declarative template, in DataFrame functions only.

The template names, for each role, what opens and closes a turn and whether its text bears loss. Control strings
cannot occur inside roles and texts: `\\`, `#`, `<` and (in roles) `:` are written as `\\b`, `\\h`, `\\l`, `\\c`, so
every remaining `#`, `<` and first `: ` is the template's, and the writing is undone by plain replacements.
A finite-state machine over the roles, given as a transition table, validates turn order.

Defined results: null texts and roles are empty; turns are ordered by turn (null first), then role, then text;
an unknown role is formatted like the others, bears no loss and is invalid; a conversation is one row however its
turns are repeated; a null conv_id is a conversation of its own; an empty table gives an
empty one. A turn's formatting happens before turns meet; one conversation must fit in one row (2 GB), since its
digest is one digest.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How turns are written, which roles bear loss, and which role may follow which ('' is the start)."""

    open: str = "### "
    middle: str = ": "
    close: str = "</turn>\n"
    loss: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant",),
        }
    )
    ends: tuple[str, ...] = ("assistant",)


#: Character and its writing, in the order in which they are replaced; undone in reverse order.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))


def escape(text: Column, more: tuple[tuple[str, str], ...] = ()) -> Column:
    for raw, written in (*ESCAPES, *more):
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column, more: tuple[tuple[str, str], ...] = ()) -> Column:
    for raw, written in reversed((*ESCAPES, *more)):
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


IN_ROLE = ((":", "\\c"),)


def format_chats(turns: DataFrame, template: Template = Template(), key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: key, formatted, segments (text, loss), valid, first_bad (index of the first turn out of order)."""
    role_of, text_of = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    one = turns.select(
        F.col(key).alias("key"),
        F.struct(
            F.col(turn).alias("turn"),
            role_of.alias("role"),
            text_of.alias("order"),
            F.concat(F.lit(template.open), escape(role_of, IN_ROLE), F.lit(template.middle)).alias("head"),
            escape(text_of).alias("body"),
        ).alias("t"),
    )
    chats = one.groupBy("key").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    loss = F.array(*map(F.lit, template.loss)) if template.loss else F.array().cast("array<string>")
    segments = F.flatten(
        F.transform(
            "ts",
            lambda t: F.array(
                F.struct(t["head"].alias("text"), F.lit(False).alias("loss")),
                F.struct(t["body"].alias("text"), F.array_contains(loss, t["role"]).alias("loss")),
                F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    allowed = F.array(*[F.lit(f"{a}\n{b}") for a, bs in template.follows.items() for b in bs])
    roles = F.transform("ts", lambda t: t["role"])
    before = F.concat(F.array(F.lit("")), roles)
    steps = F.transform(roles, lambda r, i: F.array_contains(allowed, F.concat(F.get(before, i), F.lit("\n"), r)))
    out = chats.select("key", segments.alias("segments"), F.array_position(steps, False).cast("int").alias("bad"), F.element_at(roles, -1).alias("last"))
    return out.select(
        F.col("key").alias(key),
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        ((F.col("bad") == 0) & F.col("last").isin(*template.ends)).alias("valid"),
        F.when(F.col("bad") > 0, F.col("bad") - 1).alias("first_bad"),
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    parts = F.split(formatted, F.lit(template.close))
    whole = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        at = F.instr(part, F.lit(template.middle))
        head = len(template.open)
        return F.struct(
            unescape(F.substring(part, F.lit(head + 1), at - 1 - head), IN_ROLE).alias("role"),
            unescape(F.substring(part, at + len(template.middle), F.char_length(part))).alias("text"),
        )

    return F.transform(whole, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
