"""Conversations rebuilt from an event log and rendered for training.

Events of a message: ``open`` (its role), ``delta`` (text to append), ``edit`` (text that replaces all so
far) and ``regenerate`` (all so far goes, new deltas follow). An edit or a regeneration of a message also
takes back every later message begun before it. Events of a conversation are in order of ``seq``.

The template writes a message as ``<|role|>``, newline, text, ``</s>``, newline. Control strings inside
roles and texts are broken by an escape that can be undone, so that none of them can be read as markup.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdtide.llm.common import parts

EVENT = "conv_id long, seq long, turn long, kind string, role string, text string"
#: Strings that mark turns here or in other common chat templates: never left whole inside a text.
CONTROLS = ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\\"
TRAINED = "assistant"
#: Characters of a delta when finished texts are turned into a log.
DELTA = 2000

#: Only the first character is taken, so that control strings that overlap are all found.
_CONTROL = re.compile("|".join([re.escape(ESCAPE), *(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS)]))
_ESCAPED = re.compile(r"\\(\\|!)")


def escape(text: str) -> str:
    """Every control string gets ``\\!`` after its first character, every backslash another."""
    return _CONTROL.sub(lambda m: ESCAPE * 2 if m[0] == ESCAPE else f"{m[0]}{ESCAPE}!", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: ESCAPE if m[1] == ESCAPE else "", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A message in the template, and where in it the text under the loss mask begins and ends."""
    head, body = f"<|{escape(role)}|>\n", escape(text)
    on = role == TRAINED
    return f"{head}{body}</s>\n", len(head), len(head) + len(body) if on else len(head)


_MESSAGE = re.compile(r"<\|(.*?)\|>\n(.*?)</s>\n", re.DOTALL)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each message of formatted text."""
    found, at = [], 0
    for m in _MESSAGE.finditer(formatted):
        if m.start() != at:
            raise ValueError("text between messages")
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("text after the last message")
    return found


def as_events(messages: DataFrame) -> DataFrame:
    """A log of rows (conv_id, turn, role, text): an open for each, its text in deltas.

    Rows of one turn are messages of their own, in order of role and text. ``seq`` leaves room for the
    deltas of each message.
    """
    text, place = F.coalesce("text", F.lit("")), Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = messages.select("conv_id", F.row_number().over(place).cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.length("text") / DELTA)), lambda i: F.substring("text", (i * DELTA + 1).cast("int"), F.lit(DELTA)))
    first = F.array(F.struct(F.lit("open").alias("kind"), F.lit("").alias("piece")))
    deltas = F.transform(pieces, lambda p: F.struct(F.lit("delta").alias("kind"), p.alias("piece")))
    rows = rows.select("conv_id", "turn", "role", F.posexplode(F.concat(first, deltas)).alias("i", "e"))
    return rows.select("conv_id", (F.col("turn") * F.lit(1 << 32) + F.col("i")).alias("seq"), "turn", "e.kind", "role", F.col("e.piece").alias("text"))


def alive(events: DataFrame) -> DataFrame:
    """Events that no later edit or regeneration, of their message or an earlier one, has taken back."""
    later = Window.partitionBy("conv_id").orderBy(F.desc("seq"), F.desc("turn")).rowsBetween(Window.unboundedPreceding, -1)
    reset = F.min(F.when(F.col("kind").isin("edit", "regenerate"), F.col("turn"))).over(later)
    # The opening of a message that is itself edited stays, for its role.
    taken = (F.col("_reset") < F.col("turn")) | ((F.col("_reset") == F.col("turn")) & (F.col("kind") != "open"))
    return events.withColumn("_reset", reset).where(~F.coalesce(taken, F.lit(False))).drop("_reset")


_FORMATTED = "conv_id long, turn long, formatted string, loss_start int, loss_end int"


def _render_log(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds sorted events; holds one message at a time."""
    key = role = None
    pieces: list[str] = []

    def message() -> tuple:
        return (*key, *render(role or "", "".join(pieces)))

    for batch in batches:
        out = []
        for conv, turn, kind, who, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "kind", "role", "text")), strict=True):
            if (conv, turn) != key:
                if key is not None:
                    out.append(message())
                key, role, pieces = (conv, turn), None, []
            role = who if who is not None else role
            if kind in ("edit", "regenerate"):
                pieces = []
            if kind in ("edit", "delta"):
                pieces.append(text or "")
        yield _rows(out)
    if key is not None:
        yield _rows([message()])


def _rows(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [()] * 5
    types = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32())
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["conv_id", "turn", "formatted", "loss_start", "loss_end"])


def format_chats(events: DataFrame) -> DataFrame:
    """(conv_id, turn, formatted, loss_start, loss_end), one row per message of the log.

    A conversation's training text is its ``formatted`` values in order of ``turn``; the loss mask of each
    covers the escaped text of an assistant's message and nothing else, as code points of ``formatted``.
    Messages without an open have the role of their events, or none. Null texts are empty; events of an
    unknown kind are left out; a null conversation is one. An empty log gives no rows.
    """
    known = events.where(F.col("kind").isin("open", "delta", "edit", "regenerate"))
    sorted_log = alive(known).repartition(parts(events.sparkSession), "conv_id", "turn").sortWithinPartitions("conv_id", "turn", "seq")
    return sorted_log.select("conv_id", "turn", "kind", "role", "text").mapInArrow(_render_log, _FORMATTED)


_SUMMARY = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads formatted messages in order, with running digests; holds one message at a time."""
    names = [c.split()[0] for c in _SUMMARY.split(", ")]
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    key: tuple | None = None
    n = chars = trained = 0
    turns, loss = hashlib.sha256(), hashlib.sha256()

    def row() -> tuple:
        return (key[0], n, turns.hexdigest(), trained, loss.hexdigest(), chars)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        done = []
        for conv, text, a, b in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")), strict=True):
            if key != (conv,):
                if key is not None:
                    done.append(row())
                key, n, chars, trained = (conv,), 0, 0, 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            for role, said in read_back(text):
                n += 1
                turns.update(f"{role}\n{said}\n".encode())
            masked = unescape(text[a:b])
            trained += len(masked)
            loss.update(masked.encode())
            chars += len(text)
        yield batch_of(done)
    if key is not None:
        yield batch_of([row()])


def summarise(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from formatted messages: turns, their digest, and what the loss mask covers."""
    ordered = formatted.repartition(parts(formatted.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn")
    return ordered.mapInArrow(_summarise, _SUMMARY)
