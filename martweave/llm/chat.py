"""Chat formatting with typed content parts, a loss mask and reversible escapes.

One turn becomes ``<|turn|>role\\n`` body ``<|end|>\\n``. The body's texts are escaped, so no control
string of this or another template survives inside one. A visitor flattens the parts of a turn in
order: texts as they are, images, audio and documents as placeholders, whose references and
expanded token counts are recorded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martweave.llm.words import ship

TURN, END = "<|turn|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
_ESCAPES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_UNESCAPES = {v: k for k, v in _ESCAPES.items()} | {"\\n": "\n"}
_TURN_TEXT = re.compile(rf"{re.escape(TURN)}([^\n]*)\n(.*){re.escape(END)}\n", re.S)

PART_TYPE = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT_TYPE = "struct<ordinal:int,kind:string,ref:string,tokens:bigint>"


def escape(text: str) -> str:
    """Text without ``<`` and ``[``, which begin the control strings of all common templates."""
    return re.sub(r"[\\<\[]", lambda m: _ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\.", lambda m: _UNESCAPES[m[0]], text, flags=re.S)


@dataclass(frozen=True)
class TokenCosts:
    """Tokens that a placeholder stands for."""

    patch: int = 28
    audio_per_second: float = 25.0
    document_page: int = 512

    def image(self, width: int | None, height: int | None) -> int:
        return max(1, ceil((width or 0) / self.patch)) * max(1, ceil((height or 0) / self.patch))

    def audio(self, seconds: float | None) -> int:
        return max(1, ceil((seconds or 0) * self.audio_per_second))

    def document(self, pages: int | None) -> int:
        return max(1, pages or 0) * self.document_page


@dataclass
class PartVisitor:
    """Walks the parts of one turn in order. Unknown types count as text; NULL parts and texts are empty."""

    costs: TokenCosts = TokenCosts()
    body: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict | None) -> None:
        if part is not None:
            getattr(self, f"visit_{part.get('type')}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        self.body.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, self.costs.image(part.get("width"), part.get("height")))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, self.costs.audio(part.get("seconds")))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, self.costs.document(part.get("pages")))

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.body.append(PLACEHOLDERS[kind])
        self.attachments.append({"ordinal": len(self.attachments), "kind": kind, "ref": part.get("ref"), "tokens": tokens})


def format_turn(role: str | None, parts: list[dict | None], costs: TokenCosts = TokenCosts()) -> tuple[str, int, int, list[dict]]:
    """Formatted turn, the code points [start, end) of its body, and its attachments."""
    visitor = PartVisitor(costs)
    for part in parts:
        visitor.visit(part)
    head = f"{TURN}{escape(role or '').replace(chr(10), chr(92) + 'n')}\n"
    body = "".join(visitor.body)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body), visitor.attachments


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn, as they were; placeholders stay in the text."""
    role, body = _TURN_TEXT.fullmatch(formatted).groups()
    return unescape(role), unescape(body)


def format_turns(turns: DataFrame, costs: TokenCosts = TokenCosts(), loss_role: str = "assistant") -> DataFrame:
    """One row per turn: conv_id, turn, formatted, loss_start, loss_end, attachments.

    ``turns`` has conv_id, turn, role, text and, if wanted, ``parts`` (an array of ``PART_TYPE``)
    that stands for the text wherever it is not NULL. The loss mask covers the bodies of
    ``loss_role`` in code points; elsewhere it is empty (0, 0). Turns need no neighbours, so
    nothing is shuffled here. NULL texts and roles are empty; repeated rows are turns of their own.
    """
    ship(turns.sparkSession)
    parts = F.col("parts") if "parts" in turns.columns else F.lit(None)
    picked = turns.select("conv_id", "turn", "role", "text", parts.cast(f"array<{PART_TYPE}>").alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("conv_id", picked_arrow["conv_id"]),
                ("turn", picked_arrow["turn"]),
                ("formatted", pa.string()),
                ("loss_start", pa.int64()),
                ("loss_end", pa.int64()),
                ("attachments", pa.list_(pa.struct([("ordinal", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))),
            ]
        )
        for batch in batches:
            rows = []
            roles, texts, all_parts = (batch.column(i).to_pylist() for i in (2, 3, 4))
            for role, text, given in zip(roles, texts, all_parts, strict=True):
                formatted, start, end, attachments = format_turn(role, given if given is not None else [{"type": "text", "text": text}], costs)
                rows.append((formatted, start, end, attachments) if role == loss_role else (formatted, 0, 0, attachments))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            arrays = [pa.array(c, t) for c, t in zip(columns, [f.type for f in schema][2:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], schema=schema)

    kinds = dict(picked.dtypes)
    picked_arrow = {c: _arrow(kinds[c]) for c in ("conv_id", "turn")}
    return picked.mapInArrow(
        run,
        f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, formatted string, loss_start bigint, loss_end bigint, attachments array<{ATTACHMENT_TYPE}>",
    )


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Per conversation, what reading the formatted turns back gives.

    Turns are ordered by turn (NULL first), equal ones by their formatted text. A hash over a whole
    conversation is sequential by nature; a sorted stream feeds it turn by turn, so even a
    conversation of very many turns takes no memory to speak of.
    """
    n = int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        formatted.select("conv_id", "turn", "formatted", "loss_start", "loss_end")
        .repartition(n, "conv_id")
        .sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "formatted")
    )
    kind = dict(ordered.dtypes)["conv_id"]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [_arrow(kind), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)

        current, open_, done = None, None, []
        for batch in batches:
            ids, texts, starts, ends = (batch.column(i).to_pylist() for i in (0, 2, 3, 4))
            for conv_id, text, start, end in zip(ids, texts, starts, ends, strict=True):
                if open_ is None or conv_id != current:
                    if open_ is not None:
                        done.append((current, open_[0], open_[1].hexdigest(), open_[2], open_[3].hexdigest(), open_[4]))
                    current, open_ = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body = read_turn(text)
                learned = unescape(text[start:end])
                open_[0] += 1
                open_[1].update(f"{role}\n{body}\n".encode())
                open_[2] += len(learned)
                open_[3].update(learned.encode())
                open_[4] += len(text)
            if len(done) >= 10_000:
                yield emit(done)
                done = []
        if open_ is not None:
            done.append((current, open_[0], open_[1].hexdigest(), open_[2], open_[3].hexdigest(), open_[4]))
        if done:
            yield emit(done)

    return ordered.mapInArrow(
        run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
