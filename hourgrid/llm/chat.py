"""Chat formatting with Spark expressions only.

Turns are collected and sorted per conversation, adjacent turns of one role become one block, and blocks are
concatenated under a template:  <s><turn>role\\ntext<cont>text<end>...</s>
A control string inside a text gets a backslash behind its bracket (``<end>`` becomes ``<\\end>``, ``<\\end>`` becomes
``<\\\\end>``), so texts never hold a control string and the format can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import col

START, STOP, TURN, MORE, END = "<s>", "</s>", "<turn>", "<cont>", "<end>"
#: Control strings of this template and of another common one, without brackets.
_ANGLED = r"(/?(?:s|turn|cont|end)>)"
_SQUARE = r"(/?INST\])"


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<(\\*)" + _ANGLED, r"<\\$1$2")
    return F.regexp_replace(text, r"\[(\\*)" + _SQUARE, r"[\\$1$2")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<\\(\\*)" + _ANGLED, "<$1$2")
    return F.regexp_replace(text, r"\[\\(\\*)" + _SQUARE, "[$1$2")


def _escape_role(role: Column) -> Column:
    """Roles stand on a line of their own."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def merge_turns(turns: str) -> Column:
    """Adjacent turns of one role as one block: an array of ``role, texts`` from an array of ``role, text``.

    A block reaches from a turn whose role is not that of the turn before to the next such turn, so the work grows with the
    number of turns, however long a block is. An empty array has no blocks.
    """
    role = lambda i: F.get(turns, i)["role"]
    places = F.transform(turns, lambda t, i: i)
    starts = F.filter(places, lambda i: (i == 0) | (role(i - 1) != role(i)))
    ends = F.filter(F.concat(starts, F.array(F.size(turns))), lambda i: i > 0)
    return F.zip_with(starts, ends, lambda a, b: F.struct(
        role(a).alias("role"), F.transform(F.slice(turns, a + 1, b - a), lambda t: t["text"]).alias("texts")))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv``, ``segments`` and ``formatted``.

    ``segments`` is an array of ``text, loss``; joined they are ``formatted``, and those with ``loss`` are the texts (escaped)
    of the roles in ``learn``. Null texts and roles are empty. Turns are ordered by number (null first), then role
    and text; repeated rows stay. Rows without a conversation id make up one conversation. A conversation is one
    row of the result, so it has to fit into one; different conversations are independent. Texts of any length are
    formatted whole. Other columns of ``turns``, whatever their names, are neither read nor returned; an empty table
    gives no rows.
    """
    one = F.struct(col(turns, turn).alias("turn"), F.coalesce(col(turns, role), F.lit("")).alias("role"),
                   F.coalesce(col(turns, text), F.lit("")).alias("text"))
    chats = turns.groupBy(col(turns, conv).alias(conv)).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    chats = chats.select(conv, F.explode(F.array("turns")).alias("turns"))  # sorted once

    chats = chats.select(conv, F.explode(F.array(merge_turns("turns"))).alias("blocks"))

    def pieces(block: Column, i: Column) -> Column:
        head = F.concat(F.when(i > 0, END).otherwise(START), F.lit(TURN), _escape_role(block["role"]), F.lit("\n"))
        return F.flatten(F.transform(block["texts"], lambda t, k: F.array(
            F.struct(F.when(k > 0, MORE).otherwise(head).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t).alias("text"), block["role"].isin(*learn).alias("loss")))))

    last = F.array(F.struct(F.lit(END + STOP).alias("text"), F.lit(False).alias("loss")))
    segments = F.concat(F.flatten(F.transform("blocks", pieces)), last)
    chats = chats.select(conv, F.explode(F.array(segments)).alias("segments"))
    return chats.select(conv, "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_turns(formatted: Column) -> Column:
    """The turns behind a formatted conversation: an array of ``role, text``."""
    body = F.substring(formatted, len(START) + 1, F.length(formatted) - len(START + STOP))
    blocks = F.filter(F.split(body, END), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        texts = F.split(F.substring(block, F.length(role) + 2, F.length(block)), MORE)
        name = _unescape_role(F.substring(role, len(TURN) + 1, F.length(role)))
        return F.transform(texts, lambda t: F.struct(name.alias("role"), unescape(t).alias("text")))
    return F.flatten(F.transform(blocks, turns))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
