"""Benchmark decontamination by edit distance.

Every place of a document is compared with every place of an item by a seed of letters in a row, whose
length follows from the share of edits and the item's size: with the most edits allowed, spread at random,
about ``RUNS`` unchanged runs of an item are at least that long. Each place where a seed puts an item is
a candidate. The least distances of the item's parts to the text around, one machine word each, add up to
no more than the item's own, so the bound they give drops no match; the exact edit distance against the
whole item decides about the rest.

Texts are compared in lower case (A-Z) with runs of white space as one blank.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.llm.shingles import slices, text_bytes

#: Most edits, as a share of the item's length.
EDITS = 0.2
#: Unchanged runs as long as a seed that an item with the most edits has on average; e ** -RUNS of such items have none.
RUNS = 3.5
#: Letters of an item's part, and places that count as one candidate.
WORD, SPOT = 64, 8
#: Bytes of items that one pass over the documents looks for; more take further passes.
ITEM_BYTES = 8_000_000
SLICE_BYTES = 2_000_000
CHUNK = 8_192
_BITS = 20
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[ord("A") : ord("Z") + 1] += 32
_PLAIN[_SPACES] = 32


def normalise(text: str) -> str:
    """Lower case for A-Z, one blank for white space, none at the ends."""
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    return re.sub(r"[\x20\x09-\x0d]+", " ", low).strip(" ")


def seed_size(letters: int, edits: float) -> int:
    """Letters of a seed: a run that any ``edits`` leave, or the longer one that random ones leave ``RUNS`` times."""
    most = int(edits * letters)
    if not most:
        return min(letters, 16)
    often = math.log(RUNS / most) / math.log(1 - edits) if 0 < edits < 1 else 0
    return min(16, letters, max(1, letters // (most + 1), int(often)))


def symbols(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte for each code point of UTF-8, equal for equal ones, and where each begins."""
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    out = data[begins].copy()
    for k in range(1, 4):
        longer = np.flatnonzero(out >= 0xC0) if k == 1 else longer[lead[longer] >= (0xE0, 0xF0)[k - 2]]
        if k == 1:
            lead = out.copy()
        out[longer] = out[longer] * 31 + data[np.minimum(begins[longer] + k, len(data) - 1)]
    return out, begins


def _extend(keys: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Keys of seeds one letter longer."""
    keys = keys[: len(more)]
    np.multiply(keys, np.uint64(0x9E3779B97F4A7C15), out=keys)
    np.add(keys, more, out=keys)
    return keys


class Items:
    """Seeds of all items, and the exact comparison."""

    def __init__(self, items: list[tuple[int, str]], edits: float = EDITS):
        self.rows = [(i, normalise(t)) for i, t in items]
        self.edits = edits
        self.sizes = np.array([len(t) for _, t in self.rows], np.int64)
        self.limits = np.array([int(edits * n) for n in self.sizes.tolist()], np.int64)
        parts: list[tuple[int, int]] = []
        masks, self.first_part = [], [0]
        found: dict[int, list[tuple[np.ndarray, ...]]] = defaultdict(list)
        for number, (_, text) in enumerate(self.rows):
            own = symbols(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))[0]
            if len(own):
                size = seed_size(len(own), edits)
                keys = np.zeros(len(own), np.uint64)
                for k in range(size):
                    keys = _extend(keys, own[k:])
                found[size].append((keys * np.uint64(0xD6E8FEB86659FD93), np.full(len(keys), number), np.arange(len(keys))))
            count = -(-len(own) // WORD)
            for i in range(count):
                low, high = len(own) * i // count, len(own) * (i + 1) // count
                mask = np.zeros(257, np.uint64)
                np.bitwise_or.at(mask, own[low:high], np.uint64(1) << np.arange(high - low, dtype=np.uint64))
                masks.append(mask)
                parts.append((low, high - low))
            self.first_part.append(len(parts))
        self.first_part = np.array(self.first_part, np.int64)
        self.parts = np.array(parts, np.int64).reshape(-1, 2)
        self.masks = np.concatenate(masks) if masks else np.zeros(0, np.uint64)
        self.seeds = {}
        for size, entries in sorted(found.items()):
            keys, numbers, places = (np.concatenate(x) for x in zip(*entries, strict=True))
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << _BITS, bool)
            seen[keys >> np.uint64(64 - _BITS)] = True
            self.seeds[size] = seen, keys[order], numbers[order], places[order]

    def candidates(self, letters: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Rows (document, item, where the item would begin) for places that share a seed and may be near enough."""
        out, keys, size = [np.zeros((0, 3), np.int64)], np.zeros(len(letters), np.uint64), 0
        for wanted, (seen, known, numbers, places) in self.seeds.items():
            while size < wanted and len(keys):
                keys = _extend(keys, letters[size:])
                size += 1
            spread = keys * np.uint64(0xD6E8FEB86659FD93)
            maybe = np.flatnonzero(seen[spread >> np.uint64(64 - _BITS)])
            low = np.searchsorted(known, spread[maybe], "left")
            counts = np.searchsorted(known, spread[maybe], "right") - low
            # Blocks bound the memory of texts that repeat an item's seeds.
            ends, at = np.cumsum(counts), 0
            while at < len(maybe):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4_000_000, "right")))
                n = counts[at:to]
                which = np.repeat(low[at:to] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                place = np.repeat(maybe[at:to], n)
                doc = np.searchsorted(bounds, place, "right") - 1
                inside = place + wanted <= bounds[doc + 1]
                found = np.column_stack([doc, numbers[which], place - places[which]])[inside]
                out.append(self._near(letters, bounds, self._spots(found)))
                at = to
        return self._spots(np.concatenate(out))

    @staticmethod
    def _spots(rows: np.ndarray) -> np.ndarray:
        """One row for each document, item and spot."""
        spot = rows[:, 2] // SPOT
        order = np.lexsort((rows[:, 2], spot, rows[:, 1], rows[:, 0]))
        rows, spot = rows[order], spot[order]
        new = (rows[1:, :2] != rows[:-1, :2]).any(1) | (spot[1:] != spot[:-1])
        return rows[np.append(True, new)] if len(rows) else rows

    def _near(self, letters: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Rows whose items' parts are together within the limit; never fewer than those whose items are."""
        # Rows of one length run equally many steps.
        rows = rows[np.argsort(self.sizes[rows[:, 1]], kind="stable")]
        kept = [np.zeros((0, 3), np.int64)]
        for low in range(0, len(rows), CHUNK):
            some = rows[low : low + CHUNK]
            total, part = np.zeros(len(some), np.int64), self.first_part[some[:, 1]]
            done = [np.zeros((0, 3), np.int64)]
            while len(some):
                over = part >= self.first_part[some[:, 1] + 1]
                done.append(some[over])
                some, total, part = some[~over], total[~over], part[~over]
                if len(some):
                    total = total + self._part_distance(letters, bounds, some, part)
                    near = total <= self.limits[some[:, 1]]
                    some, total, part = some[near], total[near], part[near] + 1
            kept += done
        return np.concatenate(kept)

    def _part_distance(self, letters: np.ndarray, bounds: np.ndarray, rows: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Least edit distances of one part of each row's item to the text around: bit-parallel columns, a row in each lane."""
        offset, m = self.parts[part].T
        slack = self.limits[rows[:, 1]] + SPOT
        at, top = rows[:, 2] + offset - slack, (m - 1).astype(np.uint64)
        begin, end = bounds[rows[:, 0]], np.minimum(bounds[rows[:, 0] + 1], rows[:, 2] + offset + m + slack)
        one, base = np.uint64(1), part * 257
        rises, falls = np.full(len(rows), ~np.uint64(0)), np.zeros(len(rows), np.uint64)
        distance, best = m.copy(), m.copy()
        for _ in range(int((m + 2 * slack).max())):
            # Outside the text nothing is equal.
            same = self.masks[base + np.where((at >= begin) & (at < end), np.take(letters, at, mode="clip"), 256)]
            diagonal = (((same & rises) + rises) ^ rises) | same | falls
            up, down = falls | ~(diagonal | rises), rises & diagonal
            distance += ((up >> top) & one).astype(np.int64) - ((down >> top) & one).astype(np.int64)
            np.minimum(best, distance, out=best)
            up, down = up << one, down << one
            rises, falls = down | ~(diagonal | up), up & diagonal
            at = at + 1
        return best

    def verify(self, number: int, part: str) -> tuple[int, int, int] | None:
        """Least edit distance of the item to a piece of ``part``: distance, start, stop (bytes); none beyond the limit."""
        item, limit = self.rows[number][1], int(self.limits[number])
        at = part.find(item)
        if at >= 0:
            distance, start, stop = 0, at, at + len(item)
        else:
            distance, stop = least_distance(item, part)
            if distance > limit:
                return None
            start = stop - least_distance(item[::-1], part[:stop][::-1])[1]
        start, stop = (len(part[:x].encode("utf-8", "surrogatepass")) for x in (start, stop))
        return distance, start, stop


def least_distance(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any part of ``text``, and where the first such part ends.

    Bit-parallel columns: one integer holds where the column rises, another where it falls.
    """
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    rises, falls, distance = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text):
        same = masks.get(c, 0)
        diagonal = (((same & rises) + rises) ^ rises) | same | falls
        up, down = falls | (full & ~(diagonal | rises)), rises & diagonal
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        if distance < best:
            best, end = distance, i + 1
        up, down = (up << 1) & full, (down << 1) & full
        rises, falls = down | (full & ~(diagonal | up)), up & diagonal
    return best, end


def plain_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Normalised bytes of all texts in a row and where each begins. Ends keep at most one blank."""
    data, bounds = text_bytes(texts)
    space = _SPACES[data]
    first = np.zeros(len(data), bool)
    first[bounds[:-1][bounds[:-1] < len(data)]] = True
    keep = ~space.copy()
    keep[1:] |= ~space[:-1]
    keep |= first
    total = np.append(0, np.cumsum(keep))
    return _PLAIN[data[keep]], total[bounds]


def item_blocks(items: DataFrame) -> list[Broadcast]:
    """The items (``item_id, text``) for each pass, none without text. They are a query set that does
    not grow with the documents; each ``ITEM_BYTES`` of them take one pass."""
    known = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.length(F.trim("text")) > 0)
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes, out = max(1, -(-total // ITEM_BYTES)), []
    for number in range(passes):
        rows = known.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == number).collect()
        block = sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[1], r[0] is None, r[0] or 0))
        out.append(items.sparkSession.sparkContext.broadcast(block))
    return out


def best_matches(column: pa.Array, looked: Items) -> Iterator[tuple]:
    """Rows (text, item_id, distance, similarity, start, stop) for texts of a batch, in order of text and distance."""
    at = 0
    for texts in slices(column, SLICE_BYTES):
        data, bounds = plain_bytes(texts)
        letters, begins = symbols(data)
        edges, begins = np.searchsorted(begins, bounds), np.append(begins, len(data))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, item, begin in looked.candidates(letters, edges).tolist():
            if best.get((doc, item), (1,))[0] == 0:
                continue
            slack = int(looked.limits[item]) + SPOT
            low = max(int(edges[doc]), begin - slack)
            high = min(int(edges[doc + 1]), begin + int(looked.sizes[item]) + slack)
            shift = int(begins[low] - bounds[doc])
            found = looked.verify(item, data[begins[low] : begins[high]].tobytes().decode("utf-8", "surrogatepass"))
            found = found and (found[0], shift + found[1], shift + found[2])
            if found and found < best.get((doc, item), (1 << 30,)):
                best[doc, item] = found
        rows = [
            (at + doc, looked.rows[item][0], distance, 1 - distance / len(looked.rows[item][1]), start, stop)
            for (doc, item), (distance, start, stop) in best.items()
        ]
        yield from sorted(rows, key=lambda r: (r[0], r[2], r[1] or 0))
        at += len(texts)


def matches(docs: DataFrame, items: DataFrame, edits: float = EDITS) -> DataFrame:
    """``doc_id, item_id, distance, similarity, start, stop``, the best match of each item in each row.

    A row matches where some part of its text is at most ``edits`` times the item's length (code
    points) away from the whole item. ``start`` and ``stop`` are byte offsets in the normalised text.
    Exact occurrences are found, and so is any that keeps one of the item's seeds: at a fifth of the letters
    changed at random about 0.95 do, with fewer changes more. Items without text match nothing; null texts have no match. Repeated rows match each by
    itself. ``docs`` needs ``doc_id, text``; more is not read.
    """
    names = ["doc_id", "item_id", "distance", "similarity", "start", "stop"]
    kinds = [pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.int32()]
    wanted, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    for block in item_blocks(items):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            looked = Items(block.value, edits)
            for batch in batches:
                rows = list(best_matches(batch.column("text"), looked))
                if rows:
                    index, *columns = zip(*rows, strict=True)
                    found = [batch.column("doc_id").take(pa.array(index)), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
                    yield pa.RecordBatch.from_arrays(found, names)

        found = wanted.mapInArrow(run, "doc_id long, item_id long, distance int, similarity double, start int, stop int")
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, items: DataFrame, edits: float = EDITS) -> DataFrame:
    """The rows of ``docs``, all columns, that match no item."""
    for block in item_blocks(items):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            looked = Items(block.value, edits)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[row[0] for row in best_matches(batch.column("text"), looked)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
