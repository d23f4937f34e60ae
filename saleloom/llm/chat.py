"""Chat formatting of typed content parts, with reversible escaping and a loss mask, in SQL expressions only.

A turn is written as ``<|turn|>role<|text|>content<|end|>``. Text parts are escaped, every other part becomes a
placeholder ``<|type:turn.part|>``. Escaping puts a backslash behind the first character of a control string, and behind
a backslash, so that no control string is left in a text and the change can be undone exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
BLOCK_TURNS = 256  # a conversation is put together in blocks of so many turn numbers, then from its blocks

# Control strings of this template and of common others: <|...|>, <s>, </s>, [INST], [/INST], <<SYS>>, <</SYS>>.
_CONTROL = r"(\\|<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\]))"
_ESCAPED = r"([\\<\[])\\"

PATCH, SECOND_TOKENS, PAGE_TOKENS = 14, 25.0, 1024  # defaults of the expanded token counts


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def text_part(text: Column) -> Column:
    """Content of a plain text: one text part."""
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"),
                                                      ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), *empty))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def _tokens(part: Column, patch: int, second_tokens: float, page_tokens: int) -> Column:
    """Tokens a placeholder stands for once a model expands it; null measures count as 0."""
    image = F.ceil(part["width"] / patch) * F.ceil(part["height"] / patch)
    found = (
        F.when(part["type"] == "image", image)
        .when(part["type"] == "audio", F.ceil(part["seconds"] * second_tokens))
        .when(part["type"] == "document", part["pages"] * page_tokens)
    )
    return F.coalesce(found.cast("long"), F.lit(0).cast("long"))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         content_col: str = "content", block_turns: int = BLOCK_TURNS, patch: int = PATCH,
                         second_tokens: float = SECOND_TOKENS, page_tokens: int = PAGE_TOKENS) -> DataFrame:
    """conv_id, n_turns long, formatted string, attachments array, attachment_tokens long: one row per conversation.

    ``content_col`` holds an array of parts (``PART``); ``text_part`` makes one of a string. Attachments list type, ref,
    turn, part (position in the turn) and tokens in reading order. Turns are ordered by number (null first), equal
    numbers by role and content. Null role, content and text count as empty, parts without a type as text, null parts
    are skipped, an unknown type keeps its placeholder with 0 tokens. Repeated rows are turns of their own.
    """
    turn = F.col(turn_col).cast("long")
    content = F.coalesce(F.filter(F.col(content_col), lambda p: p.isNotNull()), F.array().cast(f"array<{PART}>"))
    rows = turns.select(F.col(conv_col).alias("conv_id"), turn.alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), content.alias("content"))
    place = F.coalesce(F.col("turn").cast("string"), F.lit(""))

    def flat(part: Column, index: Column) -> Column:
        kind = F.regexp_replace(part["type"], r"[^A-Za-z0-9_]", "_")
        mark = F.concat(F.lit("<|"), kind, F.lit(":"), place, F.lit("."), index.cast("string"), F.lit("|>"))
        return F.when(_is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(mark)

    def attached(part: Column, index: Column) -> Column:
        tokens = _tokens(part, patch, second_tokens, page_tokens)
        found = F.struct(part["type"].alias("type"), part["ref"].alias("ref"), F.col("turn").alias("turn"),
                         index.alias("part"), tokens.alias("tokens"))
        return F.when(~_is_text(part), found)

    body = F.array_join(F.transform("content", flat), "")
    written = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT), body, F.lit(END))
    attachments = F.filter(F.transform("content", attached), lambda a: a.isNotNull())
    lines = rows.select("conv_id", F.floor(F.col("turn") / block_turns).alias("block"),
                        F.struct("turn", "role", written.alias("written"), attachments.alias("attachments")).alias("line"))

    # A conversation with very many turns is sorted and joined in blocks by many tasks.
    sorted_lines = F.sort_array(F.collect_list("line"))
    blocks = lines.groupBy("conv_id", "block").agg(sorted_lines.alias("lines"))
    blocks = blocks.select("conv_id", F.struct(
        "block", F.array_join("lines.written", "").alias("written"), F.size("lines").cast("long").alias("n"),
        F.flatten("lines.attachments").alias("attachments")).alias("piece"))
    whole = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    attachments = F.flatten("pieces.attachments")
    zero = F.lit(0).cast("long")
    return whole.select(
        "conv_id",
        F.aggregate("pieces.n", zero, lambda a, x: a + x).alias("n_turns"),
        F.array_join("pieces.written", "").alias("formatted"),
        attachments.alias("attachments"),
        F.aggregate(F.transform(attachments, lambda a: a["tokens"]), zero, lambda a, x: a + x).alias("attachment_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of (role, text, loss); placeholders stay in the text.

    ``loss`` marks the assistant turns: the span between their text and end marks is under the loss mask.
    """
    pieces = F.slice(F.split(formatted, r"<\|turn\|>", -1), 2, F.greatest(F.size(F.split(formatted, r"<\|turn\|>", -1)), F.lit(1)))

    def turn(piece: Column) -> Column:
        role = unescape(F.substring_index(piece, TEXT, 1))
        text = F.substring_index(F.substring_index(piece, TEXT, -1), END, 1)
        return F.struct(role.alias("role"), unescape(text).alias("text"), (role == "assistant").alias("loss"))

    return F.transform(pieces, turn)
