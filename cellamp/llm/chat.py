"""Chat formatting of typed content parts.

A turn is a list of parts: text, image, audio or document. A visitor goes through the parts in order and flattens them: text is
escaped, any other part becomes a numbered placeholder, its reference is recorded, and the number of tokens that it will
expand to is added up. A formatted turn is

    ### role
    content</turn>

Control strings cannot be forged from inside a text: every backslash, number sign and less-than sign of a text is preceded by a
backslash, so an unescaped number sign or less-than sign is always the template's own. Reading back removes those backslashes again.
Turns are formatted where they are read. A conversation is the concatenation of its turns and is read back in their
order, one turn at a time, so its length does not matter for memory.

Null texts and roles are empty; a turn without parts has an empty content. Turns with equal numbers are ordered by role and content; a missing
number comes first, a missing conversation is one conversation. Unknown kinds of parts get a placeholder without tokens.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
OPEN, CLOSE = "### ", "</turn>\n"
# Tokens: one per tile of an image, per second of audio, per page of a document.
TILE = 28
PER_SECOND = 25
PER_PAGE = 256
LOSS_ROLE = "assistant"
_PART = re.compile(r"((?:[^\\<#]+|\\.)++)|<\|(\w*):(\d+)\|>", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\<#\n]|\\.)*+)\n(.*)</turn>\n", re.DOTALL)


def escaped(text: Column, more: str = "") -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"([\\#<{more}])", r"\\$1")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def text_part(text: Column) -> Column:
    """A list with one text part."""
    none = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("kind"), text.alias("text"), none.cast("string").alias("ref"), none.cast("int").alias("width"),
            none.cast("int").alias("height"), none.cast("double").alias("seconds"), none.cast("int").alias("pages"),
        )
    )


def part_tokens(part: Column) -> Column:
    """Tokens that an attachment will be expanded to."""

    def tiles(side: str) -> Column:
        return F.ceil(F.coalesce(part[side], F.lit(0)) / TILE)

    return (
        F.when(part["kind"] == "image", tiles("width") * tiles("height"))
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * PER_SECOND))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)) * PER_PAGE)
        .otherwise(0)
        .cast("bigint")
    )


def format_turns(turns: DataFrame, role: str = "role", parts: str = "parts") -> DataFrame:
    """Append content, formatted, attachments (number, kind, ref, tokens) and attachment_tokens to every turn; a map over the rows."""
    listed = F.coalesce(F.col(parts), F.array().cast(PARTS))
    files = F.filter(listed, lambda p: F.coalesce(p["kind"], F.lit("")) != "text")
    numbered = F.transform(
        files,
        lambda p, k: F.struct(
            (k + 1).cast("int").alias("number"), F.coalesce(p["kind"], F.lit("")).alias("kind"), p["ref"].alias("ref"), part_tokens(p).alias("tokens")
        ),
    )
    # The visitor's state is the content so far and the number of placeholders in it.
    start = F.struct(F.lit("").alias("content"), F.lit(0).alias("seen"))

    def visit(state: Column, part: Column) -> Column:
        is_text = F.coalesce(part["kind"], F.lit("")) == "text"
        kind = F.regexp_replace(F.coalesce(part["kind"], F.lit("")), r"\W", "_")
        mark = F.concat(F.lit("<|"), kind, F.lit(":"), (state["seen"] + 1).cast("string"), F.lit("|>"))
        return F.struct(
            F.concat(state["content"], F.when(is_text, escaped(part["text"])).otherwise(mark)).alias("content"),
            (state["seen"] + F.when(is_text, 0).otherwise(1)).alias("seen"),
        )

    content = F.aggregate(listed, start, visit, lambda state: state["content"])
    return (
        turns.withColumn("content", content)
        .withColumn("formatted", F.concat(F.lit(OPEN), escaped(F.col(role), r"\n"), F.lit("\n"), "content", F.lit(CLOSE)))
        .withColumn("attachments", numbered)
        .withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]))
    )


def read_turn(formatted: str) -> tuple[str, list[tuple[str, str | int]]]:
    """Role and parts of a formatted turn: ("text", text) or (kind, number)."""
    turn = _TURN.fullmatch(formatted)
    if turn is None:
        raise ValueError("not a formatted turn")
    parts, at, body = [], 0, turn[2]
    while at < len(body):
        part = _PART.match(body, at)
        if part is None:
            raise ValueError("not a formatted content")
        parts.append(("text", unescaped(part[1])) if part[1] is not None else (part[2], int(part[3])))
        at = part.end()
    return unescaped(turn[1]), parts


def read_back(formatted: DataFrame, conversation: str = "conv_id", turn: str = "turn", loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation, from the formatted turns alone: sizes and digests of all turns and of what the loss covers.

    The loss covers the texts of ``loss_role``, unescaped and without placeholders. Turns are dealt out by conversation and sorted, and a task
    keeps running digests only.
    """
    kind = formatted.schema[conversation].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, key = None, None
        for batch in batches:
            done, key = [], batch.schema.field(0).type
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is None or state["conv"] != conv:
                    done += [state] if state else []
                    state = {"conv": conv, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "n": 0, "chars": 0, "all": 0}
                role, parts = read_turn(line)
                text = "".join(value for what, value in parts if what == "text")
                state["turns"].update(f"{role}\n{text}\n".encode())
                state["n"] += 1
                state["all"] += len(line)
                if role == loss_role:
                    state["loss"].update(text.encode())
                    state["chars"] += len(text)
            if done:
                yield rows(done, key)
        if state:
            yield rows([state], key)

    def rows(states: list[dict], key: pa.DataType) -> pa.RecordBatch:
        return pa.record_batch(
            [
                pa.array([s["conv"] for s in states], key), pa.array([s["n"] for s in states], pa.int64()),
                pa.array([s["turns"].hexdigest() for s in states]), pa.array([s["chars"] for s in states], pa.int64()),
                pa.array([s["loss"].hexdigest() for s in states]), pa.array([s["all"] for s in states], pa.int64()),
            ],
            ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )

    ordered = (
        formatted.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), "formatted")
        .repartition("conv")
        .sortWithinPartitions("conv", "turn", "formatted")
        .select("conv", "formatted")
    )
    return ordered.mapInArrow(digests, schema)
