"""Chat formatting: typed content parts flattened into turns with reversible escapes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import session

#: Control strings of the template. A role's turn is BEGIN role newline content END newline.
BEGIN, END = "<|turn|>", "<|end|>"
#: Placeholders of attachments by kind: the string that stands for one token of the attachment.
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Control strings of this and of common other templates: none may stand unescaped in a text.
CONTROLS = (BEGIN, END, *PLACEHOLDERS.values(), "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
#: Put behind the first character of a control string, and behind each of itself that follows such a
#: character, so that the text can be restored.
GUARD = "\u2060"
#: Tokens an attachment expands to, by kind: per image tile, second of sound and document page.
IMAGE_TILE, IMAGE_TOKENS, AUDIO_TOKENS, PAGE_TOKENS = 512, 256, 25, 400

PART = "struct<type:string, text:string, ref:string, width:int, height:int, seconds:double, pages:int>"


def escape(text: Column) -> Column:
    """``text`` without control strings: a guard follows every ``<`` and ``[`` that starts one, or a guard."""
    starts = "|".join(_literal(c[1:]) for c in CONTROLS)
    return F.regexp_replace(text, rf"([<\[])(?={GUARD}|{starts})", f"$1{GUARD}")


def unescape(text: Column) -> Column:
    """The text ``escape`` was given."""
    return F.regexp_replace(text, rf"([<\[]){GUARD}", "$1")


def escape_line(text: Column) -> Column:
    """``escape`` for a text that must stay on one line: a line break becomes a guarded ``[n``."""
    return F.regexp_replace(escape(text), "\n", f"[{GUARD}n")


def unescape_line(text: Column) -> Column:
    return unescape(F.regexp_replace(text, rf"\[{GUARD}n", "\n"))


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() or c in "<>_/" else f"\\{c}" for c in text)


def part_tokens(part: Column) -> Column:
    """Tokens a part's placeholder is expanded to; 0 for text. Unknown sizes count as the smallest."""

    def units(value: Column, per: int) -> Column:
        return F.greatest(F.ceil(F.coalesce(value.cast("double"), F.lit(0.0)) / per), F.lit(1)).cast("long")

    return (
        F.when(part["type"] == "image", units(part["width"], IMAGE_TILE) * units(part["height"], IMAGE_TILE) * IMAGE_TOKENS)
        .when(part["type"] == "audio", units(part["seconds"], 1) * AUDIO_TOKENS)
        .when(part["type"] == "document", units(part["pages"], 1) * PAGE_TOKENS)
        .otherwise(F.lit(0).cast("long"))
    )


def flatten(parts: Column) -> Column:
    """Visit typed parts in order: ``struct<content, attachments>``.

    Text is escaped; each attachment leaves its kind's placeholder. ``attachments`` lists, in the
    placeholders' order, kind, reference and expanded token count, so the n-th placeholder is the n-th
    entry. A part of unknown kind is kept as escaped text. Null parts are skipped.
    """
    known = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())

    def shown(p: Column) -> Column:
        out = escape(F.coalesce(p["text"], F.lit("")))
        for kind, mark in PLACEHOLDERS.items():
            out = F.when(p["type"] == kind, F.lit(mark)).otherwise(out)
        return out

    attached = F.filter(known, lambda p: p["type"].isin(*PLACEHOLDERS))
    return F.struct(
        F.array_join(F.transform(known, shown), "").alias("content"),
        F.transform(
            attached, lambda p: F.struct(p["type"].alias("kind"), p["ref"].alias("ref"), part_tokens(p).alias("tokens"))
        ).alias("attachments"),
    )


def text_parts(text: Column) -> Column:
    """A plain text as the one part of a turn."""
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), *nothing))


def format_turns(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    parts_col: str | None = None,
) -> DataFrame:
    """One row per turn: ``conv_id, turn, tie, role, segment, loss_from, loss_to, attachments``.

    A conversation's formatted text is its segments in the order of ``turn, tie``; it is never held in one
    cell, so a conversation with a large share of all turns is as many rows as turns. Code points
    ``loss_from`` to ``loss_to`` of a segment (from 0, end excluded) are under the loss mask: an assistant's
    content, without the marks around it.

    ``parts_col`` names a column of typed parts (``array<PART>``); without it the text is the only part. Nulls: a
    null text or part list is empty, a null role is the empty role, a null turn comes first, null conversation
    ids are one conversation. Turns with equal numbers are ordered by a hash of role and content; repeated rows stay.
    An empty table gives no rows. Other columns are ignored.
    """
    session(turns.sparkSession)
    role = F.coalesce(F.col(role_col), F.lit(""))
    parts = F.col(parts_col) if parts_col else text_parts(F.col(text_col))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), flatten(parts).alias("flat")
    )
    head = F.concat(F.lit(BEGIN), escape_line(F.col("role")), F.lit("\n"))
    assistant = F.col("role") == "assistant"
    start = F.length(head)
    return rows.select(
        "conv_id",
        "turn",
        F.xxhash64("role", "flat.content").alias("tie"),
        "role",
        F.concat(head, F.col("flat.content"), F.lit(END + "\n")).alias("segment"),
        F.when(assistant, start).otherwise(0).cast("long").alias("loss_from"),
        F.when(assistant, start + F.length("flat.content")).otherwise(0).cast("long").alias("loss_to"),
        F.col("flat.attachments").alias("attachments"),
    )


def parse_segments(segments: DataFrame) -> DataFrame:
    """Read role and text back from ``segment`` alone, and the text under the loss mask."""
    begin, end = len(BEGIN), len(END) + 1
    inner = F.expr(f"substring(segment, {begin + 1}, length(segment) - {begin + end})")
    cut = segments.select("*", inner.alias("__inner")).select("*", F.expr("locate('\n', __inner)").alias("__at"))
    return cut.select(
        *[c for c in segments.columns if c not in ("role",)],
        unescape_line(F.expr("substring(__inner, 1, __at - 1)")).alias("role"),
        unescape(F.expr("substring(__inner, __at + 1)")).alias("text"),
        unescape(F.expr("substring(segment, loss_from + 1, loss_to - loss_from)")).alias("loss_text"),
    )


def digests(segments: DataFrame) -> DataFrame:
    """Per conversation, from its segments: counts and digests of what can be read back from them.

    Turns are brought together by conversation and sorted, then streamed through running digests: memory holds
    one batch of turns, however long a conversation is. A digest is a chain, so one conversation is read by one task.
    """
    rows = parse_segments(segments).select("conv_id", "turn", "tie", "role", "text", "loss_text", F.length("segment").cast("long").alias("chars"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        begun, current = False, None
        n = loss_chars = chars = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss_text", "chars")]
            for conv, role, text, own_loss, own_chars in zip(*columns):
                if not begun or conv != current:
                    if begun:
                        done.append((current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    begun, current = True, conv
                    n = loss_chars = chars = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                n += 1
                chars += own_chars
                loss_chars += len(own_loss)
                turns.update(f"{role}\n{text}\n".encode())
                loss.update(own_loss.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
        if begun:
            last = (current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(last, types)], names=names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return rows.mapInArrow(run, schema)
