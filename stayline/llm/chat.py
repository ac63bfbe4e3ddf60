r"""Chat formatting: a finite-state machine over roles and a declarative
template, in DataFrame functions only.

A :class:`Template` names the marks around a turn, the roles under the loss and
the machine's transitions. Every turn becomes segments (mark, text, mark) with
a loss flag each; the machine reads the roles of a conversation in turn order
and tells the first turn it refuses.

Control strings inside texts and roles are escaped reversibly: every ``<`` that
is followed by backslashes (none included) and ``|`` gets one backslash more,
so no text holds ``<|``, which begins all marks; texts without such a place
stay as they are. Roles also write ``%`` as ``%25`` and a line end as ``%0A``.

The texts move once, grouped by conversation. A conversation is one training
example and one row of the result, so it has to fit a row, as a text has to.

Rows are ordered by turn (null first), then role, then escaped text; repeated
rows are repeated turns. A null text or role is empty (no machine of ours has
an empty role, so it is refused). Rows without conv_id form one conversation
without id. Conversations the machine refuses are formatted all the same and
marked, none is dropped. Only conv_id, turn, role and text are read, whatever
other columns there are; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "start"


@dataclass(frozen=True)
class Template:
    """Marks begin with ``<|``; ``{role}`` in ``before`` is the turn's role and
    is followed by the mark's only line end. ``accept``: states in which a
    conversation may end."""

    before: str = "<|im_start|>{role}\n"
    after: str = "<|im_end|>\n"
    loss_roles: tuple = ("assistant",)
    transitions: dict = field(default_factory=lambda: {
        START: ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user", "tool"),
        "tool": ("assistant", "tool"),
    })
    accept: tuple = ("user", "assistant")


CHATML = Template()


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(c: Column) -> Column:
    return F.replace(F.replace(unescape(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def segments(role: Column, text: Column, template: Template = CHATML) -> Column:
    """array<struct<text, loss>> of one turn; role and text are escaped."""
    left, right = template.before.split("{role}")
    under = F.coalesce(role.isin(*[r for r in template.loss_roles]), F.lit(False))
    off = F.lit(False)
    return F.array(F.struct(F.concat(F.lit(left), role, F.lit(right)).alias("text"), off.alias("loss")),
                   F.struct(text.alias("text"), under.alias("loss")),
                   F.struct(F.lit(template.after).alias("text"), off.alias("loss")))


def machine(roles: Column, template: Template = CHATML) -> Column:
    """struct<state, n, bad>: the state after all roles, their number and the
    index of the first role without a transition (null: none). The machine
    stays where it was refused."""
    edges = [F.lit(x) for s, nexts in template.transitions.items() for r in nexts for x in (f"{s}\0{r}", r)]
    table = F.create_map(*edges)

    def step(acc, role):
        to = F.try_element_at(table, F.concat(acc["state"], F.lit("\0"), role))
        stuck = acc["bad"].isNotNull()
        return F.struct(F.when(stuck, acc["state"]).otherwise(F.coalesce(to, acc["state"])).alias("state"),
                        (acc["n"] + 1).alias("n"),
                        F.when(stuck, acc["bad"]).when(to.isNull(), acc["n"]).alias("bad"))

    zero = F.struct(F.lit(START).alias("state"), F.lit(0).cast("long").alias("n"),
                    F.lit(None).cast("long").alias("bad"))
    return F.aggregate(roles, zero, step)


def formatted(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation: conv_id, segments, valid (no turn refused and
    the last state accepted), bad_turn (index of the first turn refused)."""
    t = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                     escape(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    c = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    c = c.select("conv_id", "turns", machine(F.col("turns.role"), template).alias("end"))
    parts = F.flatten(F.transform("turns", lambda x: segments(escape_role(x["role"]), x["text"], template)))
    return c.select("conv_id", parts.alias("segments"),
                    (F.col("end.bad").isNull() & F.col("end.state").isin(*template.accept)).alias("valid"),
                    F.col("end.bad").alias("bad_turn"))


def training_text(segs: Column) -> Column:
    """The text a model is trained on: all segments, one after another."""
    return F.array_join(F.transform(segs, lambda s: s["text"]), "")


def loss_text(segs: Column) -> Column:
    """All text under the loss, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segs, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def parsed(text: Column, template: Template = CHATML) -> Column:
    """Formatted text back to array<struct<role, text>>."""
    left, right = template.before.split("{role}")
    pieces = F.filter(F.split(text, r"\Q" + template.after + r"\E", -1), lambda p: p != "")

    def turn(p):
        cut = F.instr(p, right)
        role = F.substr(p, F.lit(len(left) + 1), cut - F.lit(len(left) + 1))
        return F.struct(unescape_role(role).alias("role"),
                        unescape(F.substr(p, cut + F.lit(len(right)))).alias("text"))
    return F.transform(pieces, turn)


def digests(conv: DataFrame, template: Template = CHATML) -> DataFrame:
    """What the formatted conversations say when they are read back: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid,
    bad_turn."""
    c = conv.select("conv_id", "valid", "bad_turn", training_text(F.col("segments")).alias("text"),
                    loss_text(F.col("segments")).alias("loss"))
    c = c.select("*", parsed(F.col("text"), template).alias("turns"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return c.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                    F.char_length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"),
                    F.char_length("text").cast("long").alias("formatted_chars"), "valid", "bad_turn")
