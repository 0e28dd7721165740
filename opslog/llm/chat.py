"""Chat formatting of conversations with typed content parts (operator 11).

A turn is a role and a list of parts: text, image, audio, document. A visitor flattens the
parts in their order: texts are escaped and written out, every other part becomes one
placeholder, and its reference and the number of tokens it expands to are recorded.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import small, stored, tasks_for

# The marks of the template.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>", "other": "<|other|>"}
LEARNED_ROLE = "assistant"

#: A conversation longer than this is written in pieces of whole turns.
PIECE_CHARS = 1 << 20
ROWS_PER_TASK = 20_000

PART_TYPE = (
    "array<struct<type: string, text: string, ref: string, width: int, height: int, "
    "seconds: double, pages: int>>"
)
PIECE_SCHEMA = (
    "conv_id bigint, seq bigint, whole boolean, n_turns bigint, formatted string, "
    "loss array<struct<start: bigint, end: bigint>>, "
    "attachments array<struct<at: bigint, kind: string, ref: string, tokens: bigint>>, "
    "media_tokens bigint"
)

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_MARK = re.compile("|".join(re.escape(m) for m in (TURN_START, TURN_END, *PLACEHOLDERS.values())))
_KIND = {mark: kind for kind, mark in PLACEHOLDERS.items()}


def escape(text: str) -> str:
    """One more backslash inside every ``<|``, ``<\\|``, ``<\\\\|`` and so on: no mark is left."""
    return _CONTROL.sub(r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def _role_line(role: str | None) -> str:
    return escape((role or "").replace("\\", "\\\\").replace("\n", "\\n"))


def _role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


@dataclass(frozen=True)
class Expansion:
    """How many tokens a placeholder stands for when the model reads the attachment."""

    patch: int = 28
    image: int = 256
    audio_per_second: float = 12.5
    document_page: int = 1024

    def of_image(self, width: int | None, height: int | None) -> int:
        """Patches of the image; ``image`` tokens where its size is not known."""
        if not width or not height or min(width, height) < 1:
            return self.image
        return -(-width // self.patch) * -(-height // self.patch)

    def of_audio(self, seconds: float | None) -> int:
        known = seconds is not None and math.isfinite(seconds) and seconds > 0
        return math.ceil(seconds * self.audio_per_second) if known else 0

    def of_document(self, pages: int | None) -> int:
        return max(pages or 1, 1) * self.document_page


class PartVisitor:
    """Sends every part to the method of its type; a part without a type is text."""

    def visit(self, parts: list[dict | None] | None) -> None:
        for part in parts or []:
            if part is not None:
                kind = part.get("type") or "text"
                getattr(self, f"visit_{kind}" if kind in ("text", *PLACEHOLDERS) else "visit_other")(part)

    def visit_text(self, part: dict) -> None:
        raise NotImplementedError

    def visit_image(self, part: dict) -> None:
        raise NotImplementedError

    def visit_audio(self, part: dict) -> None:
        raise NotImplementedError

    def visit_document(self, part: dict) -> None:
        raise NotImplementedError

    def visit_other(self, part: dict) -> None:
        raise NotImplementedError


@dataclass
class Flattener(PartVisitor):
    """Writes turns one after another and keeps loss spans and attachments by position.

    Positions count code points from the start of the output. Texts that follow each other
    directly are one text, so an escaped control string can not arise between them.
    """

    expansion: Expansion = field(default_factory=Expansion)
    out: list[str] = field(default_factory=list)
    length: int = 0
    turns: int = 0
    loss: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    _text: list[str] = field(default_factory=list)
    _learned: bool = False

    def turn(self, role: str | None, parts: list[dict | None] | None) -> None:
        self._learned = role == LEARNED_ROLE
        self._write(f"{TURN_START}{_role_line(role)}\n")
        self.visit(parts)
        self._flush()
        self._write(f"{TURN_END}\n")
        self.turns += 1

    def visit_text(self, part: dict) -> None:
        self._text.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, self.expansion.of_image(part.get("width"), part.get("height")))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, self.expansion.of_audio(part.get("seconds")))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, self.expansion.of_document(part.get("pages")))

    def visit_other(self, part: dict) -> None:
        """A type this template does not know keeps its place and reference and costs nothing."""
        self._attach("other", part, 0)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self._flush()
        self.attachments.append({"at": self.length, "kind": kind, "ref": part.get("ref"), "tokens": tokens})
        self._write(PLACEHOLDERS[kind])

    def _flush(self) -> None:
        text = escape("".join(self._text))
        self._text.clear()
        if text and self._learned:
            self.loss.append({"start": self.length, "end": self.length + len(text)})
        self._write(text)

    def _write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def piece(self, conv_id: int | None, seq: int, whole: bool) -> dict:
        return {
            "conv_id": conv_id, "seq": seq, "whole": whole, "n_turns": self.turns,
            "formatted": "".join(self.out), "loss": self.loss, "attachments": self.attachments,
            "media_tokens": sum(a["tokens"] for a in self.attachments),
        }


def parse_turns(formatted: str) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """(role, parts) of every turn; a part is ("text", its text) or (kind, "")."""
    role, parts, at = "", [], 0
    for mark in _MARK.finditer(formatted):
        between, at = formatted[at:mark.start()], mark.end()
        if mark[0] == TURN_START:
            line = formatted.index("\n", at)
            role, parts, at = _role_of(formatted[at:line]), [], line + 1
            continue
        if between:
            parts.append(("text", unescape(between)))
        if mark[0] == TURN_END:
            yield role, parts
        else:
            parts.append((_KIND[mark[0]], ""))


# --- jobs -----------------------------------------------------------------------------

def _arrow(rows: list[dict]) -> pa.RecordBatch:
    long = pa.int64()
    kinds = {
        "conv_id": long, "seq": long, "whole": pa.bool_(), "n_turns": long, "formatted": pa.string(),
        "loss": pa.list_(pa.struct([("start", long), ("end", long)])),
        "attachments": pa.list_(pa.struct([("at", long), ("kind", pa.string()), ("ref", pa.string()), ("tokens", long)])),
        "media_tokens": long,
    }
    return pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], k) for n, k in kinds.items()})


def format_conversations(
    turns: DataFrame, content: str | Column | None = None, expansion: Expansion | None = None,
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """Formatted conversations of (conv_id, turn, role, text), kept in the shared folder.

    ``content`` names a column of typed parts (:data:`PART_TYPE`); without it the ``text`` of
    a row is its one part. Rows of the result are pieces of whole turns: (part, seq) is their
    order, ``whole`` says that a piece is known to be all of its conversation. Loss spans
    cover the assistant texts, escaped as they stand in ``formatted``.

    Turns are in ascending order of ``turn``, nulls first; rows that share it are ordered by a
    hash of role and content, and repeated rows are repeated turns. Rows are dealt by range of
    (conv_id, turn), so one conversation with very many turns is spread over tasks and no task
    holds more of it than a piece. Null text, parts and role are empty; rows with a null
    conv_id are one conversation. An empty table gives no rows; extra columns are ignored.
    """
    spark = turns.sparkSession
    parts = F.array(F.struct(F.lit("text").alias("type"), F.col("text").cast("string").alias("text")))
    if content is not None:
        parts = (F.col(content) if isinstance(content, str) else content).cast(PART_TYPE)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), parts.alias("parts"),
    ).withColumn("tie", F.xxhash64("role", F.to_json("parts")))
    how = expansion or Expansion()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[dict] = []
        begun, here, inside, seq, chars = False, None, False, 0, 0
        flat = Flattener(how)
        for batch in small(batches, 512):
            for row in batch.to_pylist():
                if begun and row["conv_id"] != here:
                    ready.append(flat.piece(here, seq, inside))
                    chars += flat.length
                    flat, seq, here, inside = Flattener(how), seq + 1, row["conv_id"], True
                elif flat.length >= piece_chars:
                    ready.append(flat.piece(here, seq, False))
                    chars += flat.length
                    flat, seq, inside = Flattener(how), seq + 1, False
                begun, here = True, row["conv_id"]
                flat.turn(row["role"], row["parts"])
                if chars >= 4 * PIECE_CHARS or len(ready) >= 5_000:
                    yield _arrow(ready)
                    ready, chars = [], 0
        if begun:
            # The conversation may go on in the next task, as the first may have begun before.
            ready.append(flat.piece(here, seq, False))
            yield _arrow(ready)

    order = ["conv_id", "turn", "tie"]
    width = tasks_for(spark, rows.count(), ROWS_PER_TASK)
    dealt = rows.repartitionByRange(width, *order).sortWithinPartitions(*order).drop("turn", "tie")
    pieces = dealt.mapInArrow(run, PIECE_SCHEMA)
    return stored(pieces.withColumn("part", F.spark_partition_id()), "chat")


def conversation_digests(pieces: DataFrame) -> DataFrame:
    """What a reader of formatted conversations gets, one row per conversation.

    Turns come from parsing ``formatted``, learned text from its loss spans. Whole pieces are
    read where they lie; only the pieces of the others are brought together and read in order,
    one after another, so a task never holds more than a few pieces.
    """
    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint, n_attachments bigint, media_tokens bigint"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]

    def answers(rows: list[list]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), kinds, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, here, sums, hashes, done = False, None, [0] * 5, None, []

        def result() -> list:
            turns, chars, size, attached, tokens = sums
            return [here, turns, hashes[0].hexdigest(), chars, hashes[1].hexdigest(), size, attached, tokens]

        for batch in small(batches, 64):
            for row in batch.to_pylist():
                if not begun or row["conv_id"] != here or row["whole"]:
                    if begun:
                        done.append(result())
                    begun, here, sums, hashes = True, row["conv_id"], [0] * 5, (hashlib.sha256(), hashlib.sha256())
                text = row["formatted"]
                for role, parts in parse_turns(text):
                    said = "".join(t for kind, t in parts if kind == "text")
                    hashes[0].update(f"{role}\n{said}\n".encode())
                    sums[0] += 1
                for span in row["loss"]:
                    learned = unescape(text[span["start"]:span["end"]])
                    hashes[1].update(learned.encode())
                    sums[1] += len(learned)
                sums[2] += len(text)
                sums[3] += len(row["attachments"])
                sums[4] += row["media_tokens"]
            if len(done) >= 5_000:
                yield answers(done)
                done = []
        if begun:
            done.append(result())
            yield answers(done)

    cut = pieces.where(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    used = ["conv_id", "whole", "formatted", "loss", "attachments", "media_tokens"]
    return (
        pieces.where("whole").select(*used).mapInArrow(run, schema)
        .unionByName(cut.select(*used).mapInArrow(run, schema))
    )
