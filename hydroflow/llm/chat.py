"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is a list of typed parts. A visitor flattens it in order: text parts are escaped, image, audio
and document parts become a placeholder, and each placeholder leaves an attachment reference and the number of
model tokens that it expands to. The template puts marks around role and content::

    <|turn|>ROLE<|text|>CONTENT<|end|>\\n

Control strings all begin with ``<|``. Inside content and role a backslash is doubled and then ``<|`` becomes
``<\\|``; no content can so hold a control string, and undoing both steps in the other order gives it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydroflow.llm.common import text_or_empty

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
LEARNED_ROLE = "assistant"
PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
# Tokens that a placeholder expands to.
IMAGE_TILE, IMAGE_TILE_TOKENS, IMAGE_BASE_TOKENS = 512, 170, 85
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 640


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """One text part; a NULL text counts as empty."""
    empty = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            text_or_empty(text).alias("text"),
            *[F.lit(None).cast(kind).alias(name) for name, kind in empty.items()],
        )
    )


def _tokens(part: Column) -> Column:
    """Tokens of a placeholder; unknown sizes count as one tile, one second, one page."""

    def tiles(side: str) -> Column:
        return F.greatest(F.ceil(F.coalesce(part[side], F.lit(1)) / IMAGE_TILE), F.lit(1))

    seconds, pages = F.coalesce(part["seconds"], F.lit(1.0)), F.coalesce(part["pages"], F.lit(1))
    return (
        F.when(part["kind"] == "image", IMAGE_BASE_TOKENS + IMAGE_TILE_TOKENS * tiles("width") * tiles("height"))
        .when(part["kind"] == "audio", F.ceil(seconds * AUDIO_TOKENS_PER_SECOND))
        .when(part["kind"] == "document", pages * DOCUMENT_TOKENS_PER_PAGE)
        .otherwise(0)
        .cast("long")
    )


def _is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def _visit(part: Column) -> Column:
    """What a part puts into the content; a kind that is not known has the placeholder ``<|attachment|>``."""
    known = F.when(part["kind"].isin("image", "audio", "document"), part["kind"]).otherwise("attachment")
    return F.when(_is_text(part), escape(text_or_empty(part["text"]))).otherwise(F.concat(F.lit("<|"), known, F.lit("|>")))


def content(parts: Column) -> Column:
    """The visited parts in order. Neighbouring text parts are escaped as the one text that they make: where one ends in
    ``<`` and the next begins with ``|`` a backslash comes between them."""
    shown = F.filter(parts, lambda p: F.coalesce(~_is_text(p) | (text_or_empty(p["text"]) != ""), F.lit(True)))

    def visit(part: Column, at: Column) -> Column:
        before = F.get(shown, at - 1)
        meet = (at > 0) & _is_text(part) & _is_text(before) & F.endswith(before["text"], F.lit("<")) & F.startswith(part["text"], F.lit("|"))
        return F.concat(F.when(F.coalesce(meet, F.lit(False)), "\\").otherwise(""), _visit(part))

    return F.array_join(F.transform(shown, visit), "")


def attachments(parts: Column) -> Column:
    """Placeholders in order: kind, ref, tokens, and the part's place in its turn."""
    placed = F.transform(
        parts,
        lambda p, i: F.struct(
            i.alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens"), _is_text(p).alias("skip")
        ),
    )
    kept = F.filter(placed, lambda p: ~p["skip"])
    return F.transform(kept, lambda p: F.struct(p["place"], p["kind"], p["ref"], p["tokens"]))


def format_conversations(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts"
) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns, attachments, expanded_tokens.

    ``turns`` of the result has, in order, where each turn starts in ``formatted``, where its content starts and how
    long it is (code points), and whether it is learned: the loss mask is the content of the learned turns.

    Turns are ordered by ``turn``, NULL first; equal numbers by role, then content, and repeated rows all stay. A
    NULL role counts as empty; NULL or empty parts give empty content. Rows with a NULL id are one conversation.
    Other columns are not looked at. A conversation is one string in the result, so its own turns meet in one task;
    formatting happens before, and offsets are a running sum over its sorted rows.
    """
    body = text_or_empty(content(F.col(parts)))
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        text_or_empty(role).alias("role"),
        body.alias("body"),
        attachments(F.coalesce(F.col(parts), F.array().cast(PARTS))).alias("files"),
    )
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    pieces = rows.select(
        "conv_id",
        "turn",
        "role",
        "body",
        "files",
        F.char_length(head).alias("head_chars"),
        F.char_length("body").alias("body_chars"),
        F.concat(head, F.col("body"), F.lit(END)).alias("piece"),
        (F.col("role") == LEARNED_ROLE).alias("learned"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", unescape(F.col("body")))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.select(
        "conv_id",
        F.row_number().over(order).alias("place"),
        F.coalesce(F.sum(F.char_length("piece").cast("long")).over(before), F.lit(0).cast("long")).alias("start"),
        "head_chars",
        "body_chars",
        "learned",
        "piece",
        "files",
    )
    ordered = F.sort_array(F.collect_list(F.struct("place", "start", "head_chars", "body_chars", "learned", "piece", "files")))
    grouped = placed.groupBy("conv_id").agg(ordered.alias("all"))
    files = F.flatten(
        F.transform(
            "all",
            lambda t: F.transform(
                t["files"],
                lambda f: F.struct(t["place"].alias("turn"), f["place"].alias("place"), f["kind"], f["ref"], f["tokens"]),
            ),
        )
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("all", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(
            "all",
            lambda t: F.struct(
                t["start"].alias("start"),
                (t["start"] + t["head_chars"]).alias("content_start"),
                t["body_chars"].alias("content_chars"),
                t["learned"].alias("learned"),
            ),
        ).alias("turns"),
        files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda n, f: n + f["tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """What ``format_conversations`` wrote, read from its strings and offsets alone: conv_id, n_turns, turns (role,
    text), learned_text, formatted_chars. Placeholders stay in the text as they are.

    Turns come from the marks in the string. The learned text comes from the mask: each span is cut out of the
    turn that it lies in, so that reading is linear in the string.
    """
    cut = F.split("formatted", r"<\|turn\|>")
    pieces = F.slice(cut, F.lit(2), F.size(cut))

    def turn(piece: Column) -> Column:
        inner = F.substring_index(piece, END, 1)
        return F.struct(
            unescape(F.substring_index(inner, TEXT, 1)).alias("role"),
            unescape(F.substring(inner, F.instr(inner, TEXT) + len(TEXT), F.length(inner))).alias("text"),
        )

    def learned(piece: Column, mask: Column) -> Column:
        at = (mask["content_start"] - mask["start"] - len(TURN) + 1).cast("int")
        return F.when(mask["learned"], unescape(F.substring(piece, at, mask["content_chars"]))).otherwise("")

    return formatted.select(
        "conv_id",
        F.col("formatted"),
        F.size(pieces).cast("long").alias("n_turns"),
        F.transform(pieces, turn).alias("read_turns"),
        F.array_join(F.zip_with(pieces, "turns", learned), "").alias("learned_text"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
