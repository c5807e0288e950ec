"""Chat formatting: conversations of typed content parts become one training text each.

A turn is ``<|turn|>role<|text|>content<|end|>`` and a line break. Everything that starts with ``<|`` is control; a
``<|`` inside a text, with any number of backslashes after the ``<``, gets one backslash more, and one less when it is
read back, so texts come back as they were and can never form a control string. Attachments stand as ``<|image|>``,
``<|audio|>`` or ``<|document|>`` in the order of the parts. Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
TRAINED_ROLE = "assistant"
#: Tokens that an attachment takes when it is expanded: image tiles, audio frames a second, tokens a page.
TILE, FRAMES, PAGE = 28, 25, 512

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<turn:int,part:int,kind:string,ref:string,tokens:bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _tokens(part: Column) -> Column:
    """Expanded tokens of an attachment; 1 where its size is not known."""
    image = F.ceil(part["width"] / TILE) * F.ceil(part["height"] / TILE)
    audio = F.ceil(part["seconds"] * FRAMES)
    pages = part["pages"].cast("long") * PAGE
    kind = F.lower(part["type"])
    size = F.when(kind == "image", image).when(kind == "audio", audio).when(kind == "document", pages)
    return F.greatest(F.coalesce(size.cast("long"), F.lit(1)), F.lit(1)).cast("long")


def _attached(part: Column) -> Column:
    return F.coalesce(F.lower(part["type"]).isin("image", "audio", "document"), F.lit(False))


def _visit(parts: Column) -> Column:
    """Parts as formatted text: placeholders for attachments, and each run of texts between them escaped as a whole,
    so that neighbouring texts cannot form a control string. A part of another type counts as its text."""

    def step(acc, part):
        mark = F.concat(F.lit("<|"), F.lower(part["type"]), F.lit("|>"))
        return F.when(
            _attached(part),
            F.struct(F.concat(acc["done"], escape(acc["text"]), mark).alias("done"), F.lit("").alias("text")),
        ).otherwise(
            F.struct(acc["done"], F.concat(acc["text"], F.coalesce(part["text"], F.lit(""))).alias("text"))
        )

    empty = F.struct(F.lit("").alias("done"), F.lit("").alias("text"))
    return F.aggregate(parts, empty, step, lambda acc: F.concat(acc["done"], escape(acc["text"])))


def text_parts(text: Column) -> Column:
    """The content of a message that is only a text."""
    return F.array(F.struct(
        F.lit("text").alias("type"), text.cast("string").alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    )).cast(f"array<{PART}>")


def format_chats(turns: DataFrame) -> DataFrame:
    """One row for each conversation: ``conv_id``, ``formatted``, ``loss`` (spans of assistant content, code points,
    end exclusive), ``attachments`` (turn and part numbers from 0, kind, reference, expanded tokens) and
    ``attachment_tokens``.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and either ``content``, an array of parts, or ``text``; other columns
    are left out. Rows are put in order of turn, then role, then content, nulls first; repeated rows are repeated
    turns. Null roles, texts and contents are empty; rows without a conv_id form one conversation of id null.
    A conversation is one text, so the rows of a conversation meet in one cell.
    """
    parts = F.col("content").cast(f"array<{PART}>") if "content" in turns.columns else text_parts(F.col("text"))
    none = F.array().cast(f"array<{PART}>")
    rows = turns.select(
        "conv_id",
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce(parts, none).alias("parts")).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    pieces = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"),
        _visit(t["parts"]).alias("body"),
        (t["role"] == TRAINED_ROLE).alias("trained"),
    ))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))

    def place(acc, p):
        start = acc["at"] + F.length(p["head"])
        stop = start + F.length(p["body"])
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct(
            (stop + len(END)).alias("at"), F.when(p["trained"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans")
        )

    attached = F.flatten(F.transform("turns", lambda t, k: F.filter(
        F.transform(t["parts"], lambda p, n: F.when(_attached(p), F.struct(
            k.alias("turn"), n.alias("part"), F.lower(p["type"]).alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens"),
        ))), lambda a: a.isNotNull(),
    ))).cast(f"array<{ATTACHMENT}>")
    return chats.withColumns({"pieces": pieces, "attachments": attached}).select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate("pieces", begin, place, lambda acc: acc["spans"]).alias("loss"),
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text); placeholders stay in the texts."""
    cut = F.split(formatted, r"<\|turn\|>", -1)
    each = F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 1, F.lit(0)))

    def read(piece):
        halves = F.split(piece, r"<\|text\|>", 2)
        body = F.element_at(halves, 2)
        return F.struct(
            unescape(F.element_at(halves, 1)).alias("role"),
            unescape(F.substring(body, F.lit(1), F.length(body) - len(END))).alias("text"),
        )

    return F.transform(each, read)


def loss_text(formatted: Column, loss: Column) -> Column:
    """What stands under the loss mask, unescaped, one text after the other."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))), ""
    )


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op2_chat(spark, sf_dir) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    turns = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], turns.schema)
    chats = format_chats(turns.union(extra))
    back = chats.withColumns({"read": read_turns(F.col("formatted")), "trained": loss_text(F.col("formatted"), F.col("loss"))})
    lines = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        _digest(lines).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        _digest(F.col("trained")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP2_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), chats AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS lines,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS trained,
    sum(length(role) + length(text) + 24) AS n,
    sum(len(regexp_extract_all(role || chr(10) || text, '<\\*\|'))) AS escapes
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, CAST(length(trained) AS BIGINT) AS loss_chars,
  sha256(trained) AS loss_sha256, CAST(n + escapes AS BIGINT) AS formatted_chars
FROM chats
"""
