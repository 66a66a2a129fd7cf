"""SentencePiece ids of whole texts for merge-type (BPE) vocabularies, and their texts again.

Encoding keeps an agenda of adjacent symbol pairs whose union is a piece. The pair with the best score
is merged first, the leftmost of equal ones; its new neighbours join the agenda. No pair is left in the
end, and symbols without a piece become bytes. No merge crosses two neighbouring characters that stand
side by side in no piece, so texts are cut there and equal cuts are encoded once. Where the vocabulary
allows it, which is checked, they are cut before every run of spaces first.

The sentencepiece library is not used for the ids. ``round_trip`` compares with it, batch by batch.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, groupby, pairwise
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.llm.shingles import slices

#: The symbol that stands for a space, and the kinds of pieces of the model format.
SPACE_SYMBOL = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
#: Cuts remembered by a worker, and the length up to which they are; only speed depends on them.
REMEMBERED, REMEMBERED_LENGTH = 600_000, 40


class Vocabulary:
    """Pieces, scores and rules of a model file.

    A model that needs more than the rules below raises ``ValueError``: another model type, a character
    map, user-defined or unused pieces, or spaces as suffixes.
    """

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rules, kinds = proto.normalizer_spec, {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != BPE or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("not a plain merge-type vocabulary")
        if rules.precompiled_charsmap or not rules.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model's normalisation is not supported")
        self.prefix, self.trimmed = rules.add_dummy_prefix, rules.remove_extra_whitespaces
        self.end_id = next((i for i, p in enumerate(proto.pieces) if p.type == CONTROL and p.piece == proto.trainer_spec.eos_piece), -1)
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        place = {score: r for r, score in enumerate(sorted({p.score for p in proto.pieces}, reverse=True))}
        #: Pieces by score, best first; equal scores share a rank.
        self.ranks = {p.piece: place[p.score] for p in proto.pieces if p.type == NORMAL}
        bytes_of = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte_ids = [bytes_of[b] for b in range(256)] if proto.trainer_spec.byte_fallback else None
        self.cuts = not any(re.search(f"[^{SPACE_SYMBOL}]{SPACE_SYMBOL}", p) for p in self.ids)
        # Spaces with what follows them; a character that stands in no longer piece is a cut of its own.
        joined = re.escape("".join({c for p in self.ids if len(p) > 1 for c in p} - {SPACE_SYMBOL}) or " ")
        self.cut = re.compile(f"[ {SPACE_SYMBOL}]*[{joined}]+|[ {SPACE_SYMBOL}]+|[^ {SPACE_SYMBOL}]")
        self.side_by_side = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.kinds = [p.type for p in proto.pieces]
        self.control = [i for i, kind in enumerate(self.kinds) if kind == CONTROL]
        surface = proto.trainer_spec.unk_surface.encode()
        self.contents = [self._content(p, surface) for p in proto.pieces]
        #: Ids of cuts met of late, and of those met before these: full tables age, and a cut met again is young.
        self._known: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def _content(piece, surface: bytes) -> bytes:
        if piece.type == CONTROL:
            return b""
        if piece.type == UNKNOWN:
            return surface
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        return piece.piece.replace(SPACE_SYMBOL, " ").encode()

    def prepared(self, text: str) -> str:
        """The text as it is cut, with plain spaces."""
        if self.trimmed:
            text = re.sub(" +", " ", text.strip(" "))
        return " " + text if text and self.prefix else text

    def _merge_few(self, parts: list[str]) -> None:
        """Merge by an agenda in the order of the places; the next pair is its least rank."""
        rank, none = self.ranks.get, len(self.ranks)
        agenda = [rank(a + b, none) for a, b in pairwise(parts)]
        least = min(agenda, default=none)
        while least < none:
            i = agenda.index(least)
            parts[i] = piece = parts[i] + parts.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = rank(piece + parts[i + 1], none)
            if i:
                agenda[i - 1] = rank(parts[i - 1] + piece, none)
            least = min(agenda, default=none)

    def _merge_many(self, parts: list[str]) -> None:
        """Merge by an agenda that is a heap: a rank with the place of the pair's left symbol below it."""
        rank = self.ranks.get
        after, before = [*range(1, len(parts)), -1], list(range(-1, len(parts) - 1))
        agenda = [r << 32 | i for i, r in enumerate(map(rank, map(add, parts, parts[1:]))) if r is not None]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            left = entry & 0xFFFFFFFF
            right = after[left]
            if right < 0 or not parts[left]:
                continue
            piece = parts[left] + parts[right]
            if rank(piece) != entry >> 32:
                continue  # one of the two has been merged since
            parts[left], parts[right] = piece, ""
            after[left] = following = after[right]
            if following >= 0:
                before[following] = left
                r = rank(piece + parts[following])
                if r is not None:
                    heappush(agenda, r << 32 | left)
            leading = before[left]
            if leading >= 0:
                r = rank(parts[leading] + piece)
                if r is not None:
                    heappush(agenda, r << 32 | leading)
        parts[:] = [p for p in parts if p]

    def merged(self, cut: str) -> tuple[int, ...]:
        """Ids of one cut by the agenda."""
        parts = list(cut.replace(" ", SPACE_SYMBOL))
        (self._merge_few if len(parts) <= REMEMBERED_LENGTH else self._merge_many)(parts)
        ids = list(map(self.ids.get, parts))
        if None in ids:  # characters without a piece
            spelt = [(i,) if i is not None else [self.byte_ids[b] for b in p.encode()] if self.byte_ids else (self.unknown,) for i, p in zip(ids, parts, strict=True)]
            ids = list(chain.from_iterable(spelt))
        return tuple(ids)

    def _found(self, cut: str) -> tuple[int, ...]:
        """Ids of a cut not met of late. A long one is cut finer, where no piece joins two neighbours."""
        if len(cut) > REMEMBERED_LENGTH:
            together, symbols = self.side_by_side, cut.replace(" ", SPACE_SYMBOL)
            ends = [i for i in range(1, len(cut)) if symbols[i - 1 : i + 1] not in together]
            parts = [cut[a:b] for a, b in zip([0, *ends], [*ends, len(cut)], strict=True)]
            return tuple(chain.from_iterable(self.merged(p) if len(p) > REMEMBERED_LENGTH else self._known.get(p) or self._found(p) for p in parts))
        found = self._older.get(cut) or self.merged(cut)
        if len(self._known) >= REMEMBERED:
            self._known, self._older = {}, self._known
        self._known[cut] = found
        return found

    def encode(self, text: str, end: bool = True) -> list[int]:
        """Ids of a text, with the end id; unknown characters in a row are one unknown id."""
        ready = self.prepared(text)
        cuts = self.cut.findall(ready) if self.cuts else [ready] if ready else []
        ids: list[int] = []
        for cut in cuts:
            ids.extend(self._known.get(cut) or self._found(cut))
        if not self.byte_ids:
            ids = [x for i, x in enumerate(ids) if x != self.unknown or i == 0 or ids[i - 1] != x]
        return ids + [self.end_id] if end else ids

    def decode(self, ids: list[int]) -> str:
        """Text of ids: control ids say nothing, the space before the first piece goes, bad bytes become U+FFFD."""
        kinds, first, last = self.kinds, 0, len(ids)
        while first < last and kinds[ids[first]] == CONTROL:
            first += 1
        while first < last and kinds[ids[last - 1]] == CONTROL:
            last -= 1
        ids = ids[first:last]
        bare = bool(ids) and kinds[ids[0]] == NORMAL and (self.prefix or self.trimmed)
        if any(c in ids for c in self.control):  # bytes on both sides of it are not one character
            runs = [list(run) for control, run in groupby(ids, lambda i: kinds[i] == CONTROL) if not control]
        else:
            runs = [ids]
        text = "".join(b"".join(map(self.contents.__getitem__, run)).decode("utf-8", "one-each") for run in runs)
        return text[1:] if bare and text[:1] == " " else text


def _one_each(error: UnicodeError) -> tuple[str, int]:
    """One U+FFFD for a byte that belongs to no character, then on with the next byte."""
    return "\ufffd", error.start + 1


codecs.register_error("one-each", _one_each)


@lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Vocabulary:
    """The vocabulary of a model, built once per worker process."""
    return Vocabulary(model)


def _lists(rows: list[list[int]]) -> pa.Array:
    bounds = np.cumsum([0, *map(len, rows)])
    values = np.fromiter(chain.from_iterable(rows), np.int32, int(bounds[-1]))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))


def _inputs(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, ids`` of every whole text, with the end id.

    ``docs`` needs ``doc_id, text``; other columns are not read. Null and empty texts have the end id
    alone; repeated rows and null ids stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(shared.value)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                rows = [known.encode(t or "") for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), _lists(rows)], ["doc_id", "ids"])
                at += len(texts)

    return _inputs(docs, "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id, ids``. Null ids give an empty text; a null id in a list is left out."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(shared.value)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                texts = [known.decode(ids or []) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return _inputs(rows, F.array_compact("ids").alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, ids, decoded, same_as_library``: both ways in one pass over the texts, checked.

    The last column says whether the library gives the same ids for the text and the same text for the
    ids. Inputs as for ``encode``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        known, library = vocabulary(shared.value), SentencePieceProcessor(model_proto=shared.value)
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                texts = [t or "" for t in part.to_pylist()]
                rows = [known.encode(t) for t in texts]
                back = [known.decode(ids) for ids in rows]
                same = [
                    own == ids and text == again
                    for own, ids, text, again in zip(
                        rows, library.encode(texts, add_eos=True, num_threads=1), back, library.decode(rows, num_threads=1), strict=True
                    )
                ]
                columns = [batch.column(0).slice(at, len(part)), _lists(rows), pa.array(back, pa.string()), pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded", "same_as_library"])
                at += len(part)

    return _inputs(docs, "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string, same_as_library boolean")


def digests(rows: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, same_as_library`` of the rows of ``round_trip``."""
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "same_as_library",
    )
