"""Chat formatting with typed content parts (native).

A turn is a list of parts: text, image, audio or document. A fold visits them in order: text is
escaped and added, any other part becomes a numbered placeholder, recorded as an attachment
with its reference and the number of tokens that it will expand to. Turns are wrapped as
``<turn ROLE>...</turn>``, one per line; the escape leaves no ``<`` in texts, so nothing that a
text says can open or close a turn, and it is undone exactly.

Defined cases: a NULL text is empty, a NULL role is the empty role, NULL parts are no parts; rows
are ordered by turn, then role and content (NULL turns first), so repeated rows are turns of
their own; NULL conv_ids are one conversation; an empty table gives no conversation; parts of
unknown kind become placeholders of 0 tokens; further columns are ignored. A conversation is
one output string, so its turns meet in one row; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn ", "</turn>\n"
#: Escapes, in the order in which they are applied; undone in reverse order.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), (">", "\\g"))
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
SPAN = "struct<start:int,end:int>"
ATTACHMENT = "struct<kind:string,ref:string,at:int,n_tokens:bigint>"
#: Tokens: an image has one per square patch, audio so many a second, a document so many a page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 12.5, 1024


def escape(text: Column) -> Column:
    """The text without control characters of the template."""
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    """The text that ``escape`` was given."""
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A list of one text part."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    return F.array(part).cast("array<struct<kind:string,text:string>>")


def n_tokens(part: Column, media: bool) -> Column:
    """Tokens that a part other than text expands to."""
    if not media:
        return F.lit(0).cast("bigint")
    patches = lambda side: F.ceil(F.coalesce(part[side], F.lit(0)) / F.lit(PATCH))
    return (
        F.when(part["kind"] == "image", patches("width") * patches("height"))
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS)
        .otherwise(0)
        .cast("bigint")
    )


def visit(parts: Column, media: bool) -> Column:
    """Content string, spans of its texts and attachments, by one fold over the parts."""
    start = F.struct(
        F.lit("").alias("content"),
        F.array().cast(f"array<{SPAN}>").alias("texts"),
        F.array().cast(f"array<{ATTACHMENT}>").alias("attachments"),
    )

    def step(done: Column, part: Column) -> Column:
        at = F.length(done["content"])
        is_text = F.coalesce(part["kind"] == "text", F.lit(True))
        text = escape(F.coalesce(part["text"], F.lit("")))
        if not media:
            span = F.struct(at.alias("start"), (at + F.length(text)).alias("end"))
            return F.struct(
                F.concat(done["content"], text).alias("content"),
                F.concat(done["texts"], F.array(span)).alias("texts"),
                done["attachments"].alias("attachments"),
            )
        mark = F.concat(F.lit("<"), escape(part["kind"]), F.lit(" "), (F.size(done["attachments"]) + 1).cast("string"), F.lit(">"))
        span = F.struct(at.alias("start"), (at + F.length(text)).alias("end"))
        attachment = F.struct(part["kind"].alias("kind"), part["ref"].alias("ref"), at.alias("at"), n_tokens(part, media).alias("n_tokens"))
        return F.struct(
            F.concat(done["content"], F.when(is_text, text).otherwise(mark)).alias("content"),
            F.when(is_text, F.concat(done["texts"], F.array(span))).otherwise(done["texts"]).alias("texts"),
            F.when(is_text, done["attachments"]).otherwise(F.concat(done["attachments"], F.array(attachment))).alias("attachments"),
        )

    return F.aggregate(parts, start, step)


def format_chats(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask and attachments; one row per conversation.

    ``rows`` has conv_id, turn, role and either ``parts`` (array of PART) or ``text``. loss_mask
    lists the assistant's texts as (turn_no, block_start, start, end), attachments are (turn_no,
    kind, ref, at, n_tokens); offsets are code points of ``formatted``, end exclusive.
    """
    media = "parts" in rows.columns
    parts = F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")) if media else text_part(F.col("text"))
    turns = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), visit(parts, media).alias("c"))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(">"))
    turns = turns.select(
        "conv_id", "turn", "role", "c.texts", "c.attachments",
        F.length(head).alias("head"),
        F.concat(head, F.col("c.content"), F.lit(CLOSE)).alias("block"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "block")
    length = F.length("block").cast("long")
    turns = turns.withColumns({
        "turn_no": F.row_number().over(order),
        "block_start": F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - length,
    })
    base = F.col("block_start") + F.col("head")
    mask = F.transform("texts", lambda s: F.struct(
        F.col("turn_no"), F.col("block_start"), (base + s["start"]).alias("start"), (base + s["end"]).alias("end")
    ))
    attached = F.transform("attachments", lambda a: F.struct(
        F.col("turn_no"), a["kind"].alias("kind"), a["ref"].alias("ref"), (base + a["at"]).alias("at"), a["n_tokens"].alias("n_tokens")
    ))
    turns = turns.select(
        "conv_id", "turn_no", "block",
        F.when(F.col("role") == "assistant", mask).otherwise(F.slice(mask, 1, 0)).alias("mask"),
        attached.alias("attached"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn_no", "block", "mask", "attached"))).alias("t"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: t["block"]), "").alias("formatted"),
        F.flatten(F.transform("t", lambda t: t["mask"])).alias("loss_mask"),
        F.flatten(F.transform("t", lambda t: t["attached"])).alias("attachments"),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, formatted, ``turns`` (role, text) and ``loss_texts``, parsed from ``formatted`` alone."""
    blocks = F.split("formatted", CLOSE)
    rows = chats.select("conv_id", "formatted", "loss_mask", F.slice(blocks, F.lit(1), F.size(blocks) - 1).alias("_b"))
    text = lambda b: unescape(F.regexp_replace(F.regexp_replace(b, "^<[^>]*>", ""), "<[^<>]* [0-9]+>", ""))
    turn = lambda b: F.struct(unescape(F.regexp_extract(b, "^<turn ([^>]*)>", 1)).alias("role"), text(b).alias("text"))
    piece = lambda s: F.substr(
        F.get("_b", s["turn_no"] - 1), (s["start"] - s["block_start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")
    )
    return rows.select(
        "conv_id",
        "formatted",
        F.transform("_b", turn).alias("turns"),
        F.transform("loss_mask", lambda s: unescape(piece(s))).alias("loss_texts"),
    )
