"""Render conversations of typed parts into one training string with a loss mask.

A visitor turns each part into text: text is escaped, an attachment becomes a numbered
placeholder whose reference and expanded token count are recorded. Only built-in
functions; turns are rendered where they are read and move once, to their conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, SEPARATOR, END = "<|turn|>", "<|says|>", "<|end|>"
#: Kinds of attachment and the tokens one unit (tile, second, page) of each stands for.
ATTACHMENT_TOKENS = {"image": 256, "audio": 25, "document": 512}
LOSS_ROLE = "assistant"

# Where a control string begins; a backslash is put behind this character.
_CONTROL = r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\]))"
#: What a part of a kind that is not known is shown as; a unit of it counts as one token.
UNKNOWN = "attachment"
# A text that ends so may be the begin of a control string that the next part goes on with.
_BEGUN = r"(<(/?s?|</?(S(YS?)?)?|</?SYS)|\[/?(I(N(S(T)?)?)?)?)$"
PART = "struct<kind:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    """No control string is left, and ``unescape`` gives the text back: backslashes are
    doubled, then a single one is put into each control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def placeholder(kind: str) -> str:
    return f"<|{kind}|>"


def visit_parts(parts: Column) -> Column:
    """The parts of a turn as one string, in order.

    A control string that would come about across two text parts is broken by a backslash
    between them, which ``unescape`` takes out again.
    """
    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))

    def visit(part: Column, at: Column) -> Column:
        text = F.coalesce(part["text"], F.lit(""))
        goes_on = (F.try_element_at(parts, at + 2)["kind"] == "text") & text.rlike(_BEGUN)
        out = F.when(part["kind"] == "text", F.concat(escape(text), F.when(goes_on, "\\").otherwise("")))
        for kind in ATTACHMENT_TOKENS:
            out = out.when(part["kind"] == kind, F.lit(placeholder(kind)))
        return F.when(part.isNotNull(), out.otherwise(F.lit(placeholder(UNKNOWN)))).otherwise("")

    return F.array_join(F.transform(parts, visit), "")


def attachments_of(parts: Column) -> Column:
    """What the placeholders of a turn stand for, in order: kind, reference, tokens."""
    known = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")),
                     lambda p: p.isNotNull() & ~p["kind"].eqNullSafe(F.lit("text")))

    def record(part: Column) -> Column:
        rate = F.create_map(*[F.lit(x) for kv in ATTACHMENT_TOKENS.items() for x in kv])
        return F.struct(part["kind"].alias("kind"), part["ref"].alias("ref"),
                        (F.coalesce(part["units"], F.lit(1))
                         * F.coalesce(F.try_element_at(rate, part["kind"]), F.lit(1)))
                        .cast("long").alias("tokens"))

    return F.transform(known, record)


def text_part(text: Column) -> Column:
    """One text as the only part of a turn."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"),
                            F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("long").alias("units")))


def format_chats(turns: DataFrame) -> DataFrame:
    """A row per conversation: ``conv_id, formatted, loss_spans, attachments, n_turns``.

    ``turns`` has ``conv_id, turn, role, parts``. Turns follow by number, null first;
    turns of one number by role and content, repeated rows each count. A null role is
    an empty one, null parts are empty text. A part of an unknown (or null) kind is an
    attachment with a placeholder of its own. ``loss_spans`` has start (from
    0) and length, in code points of ``formatted``, of what assistant turns say.
    ``attachments`` numbers the placeholders of the conversation in order, with kind,
    reference and tokens. An empty table gives an empty table; other columns are not
    read. A conversation is one output row, so it must fit a row.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    said = turns.select(
        "conv_id", "turn", role.alias("role"),
        F.concat(F.lit(TURN), escape(role), F.lit(SEPARATOR)).alias("head"),
        visit_parts(F.col("parts")).alias("body"), attachments_of(F.col("parts")).alias("held"))
    grouped = said.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "body", "head", "held"))).alias("turns"))

    def step(state: Column, t: Column) -> Column:
        before = state["at"] + F.char_length(t["head"])
        size = F.char_length(t["body"])
        return F.struct(
            (before + size + len(END)).alias("at"),
            F.when(t["role"] == LOSS_ROLE,
                   F.concat(state["spans"], F.array(F.struct(before.alias("start"), size.alias("length")))))
            .otherwise(state["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,length:int>>")
    spans = F.aggregate("turns", F.struct(F.lit(0).alias("at"), none.alias("spans")), step,
                        lambda state: state["spans"])
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
        .alias("formatted"),
        spans.alias("loss_spans"),
        F.transform(F.flatten(F.transform("turns", lambda t: t["held"])),
                    lambda a, i: F.struct((i + 1).alias("number"), a["kind"].alias("kind"),
                                          a["ref"].alias("ref"), a["tokens"].alias("tokens")))
        .alias("attachments"),
        F.size("turns").cast("long").alias("n_turns"))


def read_turns(formatted: Column) -> Column:
    """Read a formatted string back: an array of (role, text), unescaped. Placeholders
    stay what they are."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(p, SEPARATOR, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, SEPARATOR, -1), END, 1)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["start"] + 1, s["length"]))), "")
