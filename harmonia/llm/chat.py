"""Operator 1: chat formatting with typed content parts (DataFrame functions only).

A turn's content is an array of typed parts ``struct<type, text, ref, units>``.
The visitor flattens the parts in order: text parts are escaped, and image,
audio and document parts become a placeholder; their references and expanded
token counts are recorded in the order of the placeholders.

Template of a turn: ``<|turn|>role<|body|>content<|end|>``.  Every control
string begins with ``<``, so texts and roles are escaped per character
(backslash ``\\b``, ``<`` ``\\l``) and the instruction marks ``[INST]`` and
``[/INST]`` as ``\\i`` and ``\\j``; unescaping reverses this exactly.

Cases: null text, role, part or part list: empty; null conversation id: a
conversation of its own; turns in order of (turn, role, content), null turns
first; repeated rows are turns of their own; other columns are ignored; no
rows: no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Tokens that one unit of a part stands for (image tile, second of audio, page).
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}
ESCAPES = [("\\", "\\b"), ("[INST]", "\\i"), ("[/INST]", "\\j"), ("<", "\\l")]
PART = "struct<type:string,text:string,ref:string,units:bigint>"


def escape(c: Column) -> Column:
    for raw, coded in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for raw, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(raw))
    return c


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"),
                            F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("bigint").alias("units"))).cast(f"array<{PART}>")


def _visit(part: Column) -> Column:
    out = F.when(part["type"] == "text", escape(F.coalesce(part["text"], F.lit(""))))
    for kind, mark in PLACEHOLDERS.items():
        out = out.when(part["type"] == kind, F.lit(mark))
    return F.coalesce(out, F.lit(""))


def _expanded(part: Column) -> Column:
    per = F.lit(0)
    for kind, n in UNIT_TOKENS.items():
        per = F.when(part["type"] == kind, F.lit(n)).otherwise(per)
    return (per * F.coalesce(part["units"], F.lit(1))).cast("bigint")


def flatten_parts(parts: Column) -> Column:
    """Visitor over the parts: ``struct<content, attachments>``."""
    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    attached = F.filter(parts, lambda p: p["type"].isin(*PLACEHOLDERS))
    return F.struct(
        F.array_join(F.transform(parts, _visit), "").alias("content"),
        F.transform(attached, lambda p: F.struct(
            p["type"].alias("type"), p["ref"].alias("ref"), _expanded(p).alias("tokens"))).alias("attachments"))


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                parts: str = "parts", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss_spans,
    attachments, expanded_tokens``.

    ``loss_spans`` are (start, length) in code points of ``formatted`` and
    cover the content of the trained roles.  Offsets are running sums by
    conversation; the grouping reuses their partitioning (one exchange).
    """
    flat = flatten_parts(F.col(parts))
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("t"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), flat.alias("f"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY))
    rows = rows.select("conv_id", "t", "role", "f", F.concat(head, F.col("f.content"), F.lit(END)).alias("piece"),
                       F.length(head).cast("bigint").alias("before"))
    order = Window.partitionBy("conv_id").orderBy("t", "role", "f.content")
    rows = (rows.withColumn("no", F.row_number().over(order))
            .withColumn("start", F.sum(F.length("piece").cast("bigint"))
                        .over(order.rowsBetween(Window.unboundedPreceding, -1))))
    span = F.struct((F.coalesce(F.col("start"), F.lit(0)) + F.col("before")).alias("start"),
                    F.length("f.content").cast("bigint").alias("length"))
    got = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "no", "piece", F.when(F.col("role").isin(*loss_roles), span).alias("span"),
        F.col("f.attachments").alias("attachments")))).alias("rows"))
    attachments = F.flatten(F.col("rows.attachments"))
    return got.select(
        "conv_id", F.size("rows").cast("bigint").alias("n_turns"),
        F.array_join(F.col("rows.piece"), "").alias("formatted"),
        F.filter(F.col("rows.span"), lambda s: s.isNotNull()).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda a, x: a + x["tokens"]).alias("expanded_tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse ``formatted`` again: turns (role, text) and the unescaped loss text."""
    pieces = F.filter(F.split("formatted", "\\Q" + END + "\\E"), lambda p: p != "")
    turns = F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(F.replace(p, F.lit(TURN), F.lit("")), BODY, 1)).alias("role"),
        unescape(F.substring_index(p, BODY, -1)).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(
        F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.withColumns({"turns": turns, "loss_text": F.array_join(loss, "")})
