"""Chat formatting: a state machine over roles and a declarative template, all native.

Turns of a conversation are put in order of (turn, role, text); a state machine
checks that roles follow each other as the template allows; the template gives
text segments, each with a loss flag. Control strings inside texts and roles are
escaped, and reading the formatted text back gives the turns unchanged.

Defined results: null text and null role are empty strings; a null turn comes
first; rows with a null conversation id form one conversation; repeated rows are
repeated turns; an invalid order is reported in ``valid`` and still formatted; an
empty table gives an empty result. A conversation is one row of output, so its
turns meet in one task whatever the method: its formatted text and digest are sequential.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``opening`` role ``named`` text ``closing`` for each turn; loss on the texts of ``trained`` roles.

    ``escapes``: control string -> letter that stands for it after a backslash. Each
    control string contains what ``opening``, ``named`` and ``closing`` need to stand out.
    """

    opening: str = "### "
    named: str = ": "
    closing: str = "</turn>\n"
    trained: tuple[str, ...] = ("assistant",)
    escapes: tuple[tuple[str, str], ...] = (("###", "h"), ("</turn>", "e"), (":", "c"))
    transitions: tuple[tuple[str, str, str], ...] = field(
        default=(
            ("start", "system", "system"),
            ("start", "user", "user"),
            ("system", "user", "user"),
            ("user", "assistant", "assistant"),
            ("assistant", "user", "user"),
        )
    )

    def __post_init__(self):
        """Refuses templates that could not be read back."""
        controls, letters = [c for c, _ in self.escapes], [x for _, x in self.escapes]
        for mark in (self.named, self.closing):
            if not any(c in mark for c in controls):
                raise ValueError(f"no control string keeps {mark!r} out of texts")
            if any(mark.startswith(mark[k:]) for k in range(1, len(mark))):
                raise ValueError(f"{mark!r} overlaps itself")
        if len({*letters}) < len(letters) or any(len(x) != 1 or x == "\\" or any(x in c for c in controls) for x in letters):
            raise ValueError("letters of escapes must be single, different, and in no control string")
        if any("\\" in c for c in (*controls, self.named, self.closing)):
            raise ValueError("a control string may hold no backslash")


DEFAULT = Template()


def escaped(text: Column, template: Template = DEFAULT) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control, letter in template.escapes:
        out = F.replace(out, F.lit(control), F.lit("\\" + letter))
    return out


def unescaped(text: Column, template: Template = DEFAULT) -> Column:
    """Every backslash of an escaped text begins a pair, so splitting at doubled ones leaves only the letters."""

    def letters(part: Column) -> Column:
        for control, letter in reversed(template.escapes):
            part = F.replace(part, F.lit("\\" + letter), F.lit(control))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), letters), "\\")


def format_conversations(
    turns: DataFrame,
    template: Template = DEFAULT,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """conversation id, formatted, segments array<struct<text, loss>>, valid, final_state."""
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    ordered = rows.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    table = F.create_map(*[F.lit(x) for a, by, b in template.transitions for x in (f"{a}>{by}", b)])
    state = F.aggregate(
        "turns",
        F.lit("start"),
        lambda s, t: F.coalesce(F.try_element_at(table, F.concat(s, F.lit(">"), t.role)), F.lit("invalid")),
    )

    def segment(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                segment(F.concat(F.lit(template.opening), escaped(t.role, template), F.lit(template.named)), no),
                segment(escaped(t.text, template), t.role.isin(*template.trained)),
                segment(F.lit(template.closing), no),
            ),
        )
    )
    made = ordered.select("conv", segments.alias("segments"), state.alias("final_state"))
    return made.select(
        F.col("conv").alias(conv),
        F.array_join(F.transform("segments", lambda s: s.text), "").alias("formatted"),
        "segments",
        (F.col("final_state") != "invalid").alias("valid"),
        "final_state",
    )


def read_back(formatted: DataFrame, template: Template = DEFAULT, conv: str = "conv_id") -> DataFrame:
    """The turns parsed from ``formatted`` and the text under the loss flags, both unescaped."""
    literally = "\\Q" + template.closing + "\\E"  # a template's closing holds no backslash
    pieces = F.split("formatted", literally)  # the last piece, after the last closing, is empty
    cut = F.lit(len(template.opening) + 1)

    def parsed(piece: Column) -> Column:
        head = F.locate(template.named, piece, len(template.opening) + 1)
        return F.struct(
            unescaped(F.substr(piece, cut, head - cut), template).alias("role"),
            unescaped(F.substr(piece, head + F.lit(len(template.named))), template).alias("text"),
        )

    loss = F.transform(F.filter("segments", lambda s: s.loss), lambda s: unescaped(s.text, template))
    return formatted.select(
        conv,
        "formatted",
        F.transform(F.slice(pieces, 1, F.size(pieces) - 1), parsed).alias("turns"),
        F.array_join(loss, "").alias("loss_text"),
        *[c for c in ("valid", "final_state") if c in formatted.columns],
    )


def digests(back: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Counts and digests of what was read back."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return back.select(
        conv,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
