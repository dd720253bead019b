r"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of the rendered text (literal marks, one space inside each):

    conversation := turn*
    turn         := "[INST] " text " [/INST]"          user
                  | "<s> " text " </s>"                assistant
                  | "<<SYS>> " text " <</SYS>>"        system
                  | "[ROLE] " role " [SEP] " text " [/ROLE]"   any other role

The parser is deterministic: it cuts at every closing mark that follows a
space, and reads each piece's opening mark.  A text that does not come back
from rendering and parsing alone is escaped: each control mark in it gets one
more backslash in front of the backslashes that precede it.  In an escaped text
no mark follows a space directly, so the second round trip is exact; the result
of the comparison is returned as ``identical``.

Nulls and edge cases: a null text is empty, a null role is the empty role; a
null ``conv_id`` is a conversation of its own.  Rows of one conversation are
ordered by turn (null first), ties by role, then text; repeated rows are
repeated turns.  An empty table gives an empty result.  A conversation is one
row of the result, so its turns meet in one row by definition.  Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import let

#: Role, opening mark, closing mark.
MARKS = (("user", "[INST]", "[/INST]"), ("assistant", "<s>", "</s>"), ("system", "<<SYS>>", "<</SYS>>"))
OTHER = ("[ROLE]", "[/ROLE]")
SEP = "[SEP]"


def _quoted(mark: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in mark)


_ALL = [m for _, a, b in MARKS for m in (a, b)] + [*OTHER, SEP]
CONTROL = "(?:" + "|".join(map(_quoted, _ALL)) + ")"
_CLOSING = " (?:" + "|".join(_quoted(m) for m in [*(b for _, _, b in MARKS), OTHER[1]]) + ")"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"(\\\\*)({CONTROL})", "\\\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, f"\\\\(\\\\*)({CONTROL})", "$1$2")


def _clean(text: Column) -> Column:
    """The text itself where it survives the grammar alone, else its escaped form."""
    conflict = text.rlike(CONTROL)
    return F.when(conflict, escape(text)).otherwise(text)


def _render_turn(role: Column, text: Column) -> Column:
    out = F.concat(F.lit(OTHER[0] + " "), _clean(role), F.lit(f" {SEP} "), _clean(text),
                   F.lit(" " + OTHER[1]))
    for name, a, b in reversed(MARKS):
        out = F.when(role == name, F.concat(F.lit(a + " "), _clean(text), F.lit(" " + b))).otherwise(out)
    return out


def _parse(rendered: Column) -> Column:
    """array<struct<role, raw, text, start, length>>: turns with the span of the raw text."""
    pieces = F.split(rendered, _CLOSING, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def one(p: Column) -> Column:
        mark = F.substring_index(p, " ", 1)
        rest = F.substr(p, F.length(mark) + 2, F.length(p))
        head = F.substring_index(rest, f" {SEP} ", 1)
        other = mark == OTHER[0]
        role = F.when(other, unescape(head))
        close = F.when(other, F.lit(len(OTHER[1]) + 1))
        for name, a, b in MARKS:
            role = role.when(mark == a, F.lit(name))
            close = close.when(mark == a, F.lit(len(b) + 1))
        raw = F.when(other, F.substr(rest, F.length(head) + len(SEP) + 3, F.length(rest))).otherwise(rest)
        return F.struct(role.alias("role"), raw.alias("raw"), unescape(raw).alias("text"),
                        (F.length(p) - F.length(raw)).alias("skip"), (F.length(p) + close).alias("all"))

    def place(turns: Column) -> Column:
        ends = F.aggregate(turns, F.array(F.lit(0)), lambda a, t: F.concat(
            a, F.array(F.element_at(a, -1) + t["all"])))
        return let(ends, lambda e: F.transform(turns, lambda t, i: F.struct(
            t["role"].alias("role"), t["raw"].alias("raw"), t["text"].alias("text"),
            (e[i] + t["skip"]).alias("start"), F.length(t["raw"]).alias("length"))))

    return let(F.transform(pieces, one), place)


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation.

    conv_id, formatted, loss_spans (array of start, length in code points of
    ``formatted``: the assistant texts), turns (array of role, text, as parsed
    back), loss_text (unescaped text under the mask), identical (the parsed
    turns equal the source).
    """
    src = rows.select("conv_id", F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    conv = src.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("src"))
    conv = conv.withColumn("formatted", F.concat_ws("", F.transform(
        "src", lambda t: _render_turn(t["role"], t["text"]))))
    conv = conv.withColumn("parsed", _parse(F.col("formatted")))
    mine = F.filter("parsed", lambda t: t["role"] == "assistant")
    return conv.select(
        "conv_id", "formatted",
        F.transform(mine, lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
        .alias("loss_spans"),
        F.transform("parsed", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
        F.transform("src", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("_src"),
    ).select(
        "conv_id", "formatted", "loss_spans", "turns",
        F.concat_ws("", F.transform("loss_spans", lambda s: unescape(
            F.substr(F.col("formatted"), s["start"] + 1, s["length"])))).alias("loss_text"),
        (F.col("turns") == F.col("_src")).alias("identical"))


def digest(conv: DataFrame) -> DataFrame:
    """Digest columns of formatted conversations, read back from the rendered text."""
    flat = F.concat_ws("", F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return conv.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "identical")
