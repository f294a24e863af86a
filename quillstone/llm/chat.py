"""Chat formatting over typed content parts.

A turn is a list of parts (kind, value, tokens). A visitor flattens it: text parts, and parts without a kind, are escaped
and written out; image, audio and document parts become placeholders in their order, each with an attachment reference
and the number of tokens to which it expands, and parts of any other kind a placeholder "other" that keeps their kind in
the attachment; null parts add nothing. The template is

    <turn ROLE>\\n TEXT </turn>\\n

and in roles and texts a backslash is written before every backslash, "<" and ">", so that no text can hold a control
string and each text is read back exactly. The loss mask covers what assistant turns say.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = "array<struct<kind:string,value:string,tokens:int>>"
FORMATTED = "conv_id long, position long, role string, formatted string, loss boolean, attachments array<struct<kind:string,ref:string,tokens:int,start:int>>"
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^\\<>]++|\\.)*+)>\n((?:[^\\<]++|\\.|<(?:image|audio|document|other) \d+ \d+>)*+)</turn>\n", re.S)
_PLACE = re.compile(r"(?:[^\\<]++|\\.)++|<(image|audio|document|other) \d+ \d+>", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<").replace(">", "\\>")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class Flattener:
    """Visits the parts of a turn; attachments are numbered within the turn."""

    out: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    length: int = 0

    def visit(self, part: dict | None) -> None:
        if part is not None:
            visitors = {None: self.visit_text, "text": self.visit_text, "image": self.visit_image, "audio": self.visit_audio, "document": self.visit_document}
            visitors.get(part["kind"], self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self._write(escape(part["value"] or ""))

    def visit_other(self, part: dict) -> None:
        self._attach(part, "other")

    def visit_image(self, part: dict) -> None:
        self._attach(part, "image")

    def visit_audio(self, part: dict) -> None:
        self._attach(part, "audio")

    def visit_document(self, part: dict) -> None:
        self._attach(part, "document")

    def _attach(self, part: dict, shown: str) -> None:
        n, tokens = len(self.attachments), max(0, int(part["tokens"] or 0))
        self.attachments.append({"kind": part["kind"], "ref": part["value"] or "", "tokens": tokens, "start": self.length})
        self._write(f"<{shown} {n} {tokens}>")

    def _write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)


def format_turn(role: str | None, parts: list[dict] | None) -> tuple[str, list[dict]]:
    """The template's text for a turn and its attachments, whose start counts from the turn's text."""
    f = Flattener()
    for p in [] if parts is None else parts:
        f.visit(p)
    return f"<turn {escape(role or '')}>\n{''.join(f.out)}</turn>\n", f.attachments


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Turns (role, text) of a formatted string, unescaped; a placeholder adds nothing to the text."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        body = m[2]
        yield unescape(m[1]), unescape("".join(p[0] for p in _PLACE.finditer(body) if not p[1])) if "<" in body else unescape(body)
        at = m.end()


def text_parts(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as turns of one text part."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce("text", F.lit("")).alias("value"), F.lit(0).alias("tokens"))
    return conversations.select("conv_id", "turn", "role", F.array(part).cast(PARTS).alias("parts"))


def ordered(turns: DataFrame) -> DataFrame:
    """turns dealt by conversation and sorted by turn (nulls first; ties by role, then content), for one streaming pass."""
    key = F.coalesce("role", F.lit(""))
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), key, F.to_json(F.struct("parts")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """Formatted turns, in order: conv_id, position from 0, role, formatted, loss, attachments.

    turns: conv_id, turn, role, parts. A conversation's text is its rows' formatted joined by nothing. Rows pass through
    one at a time, so a conversation of any length needs the memory of one batch. Null parts, an empty list and an
    empty text add nothing and give a turn with an empty text; a null role is written as an empty one; null conv_ids are one
    conversation; repeated rows are repeated turns. Other columns are dropped.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, position = None, -1
        for b in batches:
            rows = []
            for conv, role, parts in zip(b["conv"], b["role"], b["parts"], strict=True):
                position = position + 1 if conv == last else 0
                last = conv
                formatted, attachments = format_turn(role, parts)
                rows.append((None if conv == "" else int(conv), position, role or "", formatted, role == "assistant", attachments))
            yield pd.DataFrame(rows, columns=["conv_id", "position", "role", "formatted", "loss", "attachments"]).astype({"conv_id": "Int64"})

    rows = ordered(turns).select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "role", "parts")
    return rows.mapInPandas(run, FORMATTED)


def digests(turns: DataFrame) -> DataFrame:
    """One row for each conversation, from its formatted text read back: the columns of op2.

    The pass streams: hashes are fed turn by turn and only a conversation's state is held, however long it is. Null and
    unknown parts, null roles, null conv_ids and repeated rows are treated as by format_conversations(); other columns
    are dropped, and an empty table gives an empty one.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: list = []

        def row() -> tuple:
            conv, n, turns_hash, loss_chars, loss_hash, chars, attached, tokens = state
            return None if conv == "" else int(conv), n, turns_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), chars, attached, tokens

        def frame(rows: list[tuple]) -> pd.DataFrame:
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_attachments", "attachment_tokens"]
            return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})

        for b in batches:
            rows = []
            for conv, role, parts in zip(b["conv"], b["role"], b["parts"], strict=True):
                if not state or state[0] != conv:
                    if state:
                        rows.append(row())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                formatted, attachments = format_turn(role, parts)
                for said_by, text in read_turns(formatted):
                    state[1] += 1
                    state[2].update(f"{said_by}\n{text}\n".encode("utf-8", "surrogatepass"))
                    if said_by == "assistant":
                        state[3] += len(text)
                        state[4].update(text.encode("utf-8", "surrogatepass"))
                state[5] += len(formatted)
                state[6] += len(attachments)
                state[7] += sum(a["tokens"] for a in attachments)
            yield frame(rows)
        if state:
            yield frame([row()])

    out = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, attachment_tokens long"
    rows = ordered(turns).select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "role", "parts")
    return rows.mapInPandas(run, out)
