"""Chat formatting with typed content parts.

A message is a list of parts: text, image, audio or document. A visitor walks through them in order.
Text is escaped; each other part becomes a placeholder numbered by kind, and its reference and the
number of tokens it will expand to are recorded. A turn is written as

    <|turn:ROLE|>CONTENT<|end|>

Every control string, placeholders and those of other common templates included, begins with ``<``
or ``[``. Both characters are replaced inside roles and texts, together with the escape character
itself, so no text can hold a control string and the original comes back by the reverse
replacement. The loss mask covers the content of assistant turns.

Turns are rows of the output, in the order of ``ORDER``: ties on the turn stand in the order of the
formatted text, null turns first. Range partitions split even a conversation that holds most rows; it
is read back in a stream, never held as one string.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from revlake.llm.common import partitions, stored

OPEN, CLOSE_ROLE, END = "<|turn:", "|>", "<|end|>"
#: Replacement of each reserved character; the escape character comes first.
RESERVED = {"&": "&amp;", "<": "&lt;", "[": "&lsq;"}
ATTACHMENT = "struct<kind:string,number:int,ref:string,tokens:long>"
ORDER = ["conv_id", "turn", "segment"]
FORMATTED = (
    "conv_id long, turn long, segment string, loss_start int, loss_end int, "
    f"attachments array<{ATTACHMENT}>, expanded_tokens long"
)


def escape(text: str) -> str:
    for char, code in RESERVED.items():
        text = text.replace(char, code)
    return text


def unescape(text: str) -> str:
    for char, code in reversed(RESERVED.items()):
        text = text.replace(code, char)
    return text


@dataclass
class PartVisitor:
    """Flattens parts in order; numbers run through the turn by kind.

    Expanded tokens: an image has one for each started patch of ``patch`` by ``patch`` pixels, audio
    ``audio_rate`` a started second, a document ``page_tokens`` a page. Unknown types raise.
    """

    patch: int = 28
    audio_rate: int = 25
    page_tokens: int = 512
    out: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part["type"]
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown content part: {kind!r}")
        method(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        across, down = (-(-(part[side] or 0) // self.patch) for side in ("width", "height"))
        self._attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, int(-(-(part["seconds"] or 0) // 1)) * self.audio_rate)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part["pages"] or 0) * self.page_tokens)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        number = 1 + sum(a["kind"] == kind for a in self.attachments)
        self.out.append(f"<|{kind}:{number}|>")
        self.attachments.append({"kind": kind, "number": number, "ref": part["ref"], "tokens": tokens})


def text_part(text: Column) -> Column:
    """A content list of one text part; null text is empty."""
    empty = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            F.coalesce(text, F.lit("")).alias("text"),
            *(F.lit(None).cast(kind).alias(name) for name, kind in empty.items()),
        )
    )


def format_turns(messages: DataFrame, **visitor) -> DataFrame:
    """Every message as a formatted turn, in place: no rows move.

    ``messages`` has ``conv_id, turn, role`` and ``content`` (array of parts, null: none); other
    columns are not read. A null role is empty. ``loss_start`` and ``loss_end`` are code points
    within the segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for m in batch.to_pylist():
                seen = PartVisitor(**visitor)
                for part in m["content"] or []:
                    seen.visit(part)
                head, body = OPEN + escape(m["role"] or "") + CLOSE_ROLE, "".join(seen.out)
                loss = (len(head), len(head) + len(body)) if m["role"] == "assistant" else (0, 0)
                rows.append(
                    {
                        "conv_id": m["conv_id"], "turn": m["turn"], "segment": head + body + END,
                        "loss_start": loss[0], "loss_end": loss[1], "attachments": seen.attachments,
                        "expanded_tokens": sum(a["tokens"] for a in seen.attachments),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(FORMATTED))
    whole = [F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")]
    return messages.select(*whole, "role", "content").mapInArrow(run, FORMATTED)


TURN = re.compile(re.escape(OPEN) + r"(.*?)" + re.escape(CLOSE_ROLE) + r"(.*)" + re.escape(END), re.S)


def read_turns(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, parsed from its formatted turns alone. Null ids are one conversation.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, expanded_tokens``. The
    rows of a conversation pass through one task in a stream; only its digests are held.
    """
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, expanded_tokens long"
    )
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, out = None, []

        def done() -> tuple:
            return (state["id"], state["n"], state["all"].hexdigest(), state["loss"], state["masked"].hexdigest(), state["chars"], state["more"])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for m in batch.to_pylist():
                if state is None or m["conv_id"] != state["id"]:
                    if state:
                        out.append(done())
                    state = {"id": m["conv_id"], "n": 0, "all": hashlib.sha256(), "loss": 0, "masked": hashlib.sha256(), "chars": 0, "more": 0}
                segment = m["segment"]
                found = TURN.fullmatch(segment)
                if found is None:
                    raise ValueError(f"conversation {m['conv_id']}: a turn does not parse")
                role, text = unescape(found[1]), unescape(found[2])
                masked = unescape(segment[m["loss_start"] : m["loss_end"]])
                state["n"] += 1
                state["all"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                state["loss"] += len(masked)
                state["masked"].update(masked.encode("utf-8", "surrogatepass"))
                state["chars"] += len(segment)
                state["more"] += m["expanded_tokens"]
            if out:
                yield batch_of(out)
                out = []
        if state:
            yield batch_of([done()])

    ordered = formatted.repartition("conv_id").sortWithinPartitions(*ORDER)
    return ordered.select("conv_id", "segment", "loss_start", "loss_end", "expanded_tokens").mapInArrow(run, schema)


def write_and_read(messages: DataFrame) -> DataFrame:
    """Format, write below the shared folder, and digest what was written."""
    turns = format_turns(messages).repartitionByRange(partitions(messages.sparkSession), *ORDER).sortWithinPartitions(*ORDER)
    return read_turns(stored(turns, "chat-turns"))
