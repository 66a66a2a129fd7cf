"""Periodic runs of words: maximal stretches that repeat with a smallest period, at least three times.

Words are numbered and all texts of a slice stand in one row, each closed by a number of its own. At
the scale t (a power of two) a position is a synchronising one when the least hash of the t-word
pieces that start in the t + 1 places from it on is that of the first or the last of them. Pieces with
a period of at most t / 3 have no hash. Whether a position is chosen follows from its 2t words alone,
and every stretch of t places holds a chosen one, unless 3t - 1 words from there have such a small
period. So a run with its period in [3t, 6t) holds two chosen positions with equal contexts of 2t words
one period apart: every pair of equal contexts at such a distance proposes its distance as a period,
and the proposal is extended both ways. Periods below the first scale's, and the small periods that
have no hash, come from comparing the row with itself some words on. Scales rise, so the highly
periodic regions of a scale are runs already found.

Hashes only propose and extend. Every run is compared word by word in the end; a slice in which a hash
misled is done again with exact names in place of hashes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.llm.common import WORD
from revlake.llm.shingles import mix, slices

LEAST_WORDS, REPEATS = 24, 3
#: Smallest scale, as a power of two. Periods below three times that are found by direct comparison.
FIRST_SCALE = 2
#: Steps, as powers of two, in which a proposal is extended.
STEPS = (9, 6, 3)
RUN = "array<struct<start:long,length:long,period:long>>"
_WORD = re.compile(WORD)
_NONE = np.uint64(2**64 - 1)


def _hashed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right + np.uint64(0x632BE59BD9B4E019))


def _named(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact names in place of hashes: equal pairs, and no others, share one. Spread to serve as order."""
    order = np.lexsort((right, left))
    new = np.append(True, (left[order][1:] != left[order][:-1]) | (right[order][1:] != right[order][:-1]))
    names = np.empty(len(left), np.uint64)
    names[order] = np.cumsum(new).astype(np.uint64)
    return mix(names)  # one to one


def _doubled(level: np.ndarray, width: int, combine: Callable) -> np.ndarray:
    """Hashes of twice ``width`` words. Places too near the end get values of their own."""
    n = len(level)
    out = mix(np.arange(n, dtype=np.uint64) + np.uint64(2**40 + width))
    if n > width:
        out[: n - width] = combine(level[: n - width], level[width:])
    return out


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of true flags begin and end."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def _extended(steps: list[tuple[int, np.ndarray]], left: np.ndarray, right: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from ``left`` and ``right`` on are the same, or before them."""
    n, total = len(steps[-1][1]), np.zeros(len(left), np.int64)
    for width, level in steps:
        active = np.arange(len(left))
        while len(active):
            a, b = left[active], right[active]
            a, b = (a + total[active], b + total[active]) if forward else (a - total[active] - width, b - total[active] - width)
            inside = (b + width <= n) if forward else (a >= 0)
            active, a, b = active[inside], a[inside], b[inside]
            active = active[level[a] == level[b]]
            total[active] += width
    return total


def _proposals(words: np.ndarray, level: np.ndarray, width: int, wide: np.ndarray, small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of pairs of equal contexts among the chosen positions of one scale.

    ``small`` holds the runs whose period is at most a third of ``width``. Chosen positions with equal contexts
    are more than that apart, so the loop over how many of them a pair skips is short.
    """
    n = len(words)
    covered = np.zeros(n + 1, np.int64)
    held = small[small[:, 1] - small[:, 0] >= width]
    np.add.at(covered, held[:, 0], 1)
    np.add.at(covered, held[:, 1] - width + 1, -1)
    ids = np.where(np.cumsum(covered[:-1]) > 0, _NONE, level)
    least, step = ids.copy(), 1
    while step < width:
        least[: n - step] = np.minimum(least[: n - step], least[step:])
        step *= 2
    whole = n - 2 * width + 1
    if whole <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = ids[:whole], ids[width : width + whole]
    minimum = np.minimum(least[:whole], last)
    chosen = np.flatnonzero(((minimum == first) | (minimum == last)) & (minimum != _NONE))
    order = np.argsort(wide[chosen], kind="stable")
    places, contexts = chosen[order], wide[chosen][order]
    at, by = [], []
    skip = 1
    while skip < len(places):
        near = (contexts[skip:] == contexts[:-skip]) & (places[skip:] - places[:-skip] < 6 * width)
        if not near.any():
            break
        hit = np.flatnonzero(near)
        gap = places[hit + skip] - places[hit]
        far = gap >= 3 * width
        at.append(places[hit][far])
        by.append(gap[far])
        skip += 1
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, by = np.concatenate(at), np.concatenate(by)
    order = np.lexsort((at, by))
    at, by = at[order], by[order]
    # Pairs whose contexts touch lie in one stretch with that period: the first stands for all.
    fresh = np.append(True, (by[1:] != by[:-1]) | (at[1:] > at[:-1] + 2 * width)) if len(at) else np.zeros(0, bool)
    return at[fresh], by[fresh]


def _search(words: np.ndarray, lengths: np.ndarray, combine: Callable) -> np.ndarray:
    """All runs that repeat at least three times, as rows of begin, end, smallest period.

    ``words`` holds the texts by falling number of words, each closed by its own number.
    """
    ends = np.cumsum(lengths + 1)
    found = []
    for period in range(1, REPEATS << FIRST_SCALE):
        begin, end = _stretches(words[period:] == words[:-period])
        long = end - begin >= (REPEATS - 1) * period
        found.append(np.stack([begin[long], end[long] + period, np.full(long.sum(), period)], axis=1))
    runs = _least_periods(np.concatenate(found))
    level, levels = mix(words.astype(np.uint64)), {}
    for k in range(max(STEPS)):
        if 1 << k > len(words):
            break
        level = _doubled(level, 1 << k, combine)
        levels[k + 1] = level
    steps = [(1 << k, levels[k]) for k in STEPS if k in levels] + [(1, words)]
    k = FIRST_SCALE
    while True:
        width = 1 << k
        texts = int(np.searchsorted(-lengths, -(REPEATS * 3 * width), "right"))
        if not texts:
            return runs
        n = int(ends[texts - 1])
        level = levels[k][:n]
        if k + 1 not in levels:
            levels[k + 1] = _doubled(level, width, combine)
        at, by = _proposals(words[:n], level, width, levels[k + 1][:n], runs[(3 * runs[:, 2] <= width) & (runs[:, 1] <= n)])
        if k not in STEPS:
            del levels[k]
        if len(at):
            begin = at - _extended(steps, at, at + by, False)
            end = at + by + _extended(steps, at, at + by, True)
            long = end - begin >= REPEATS * by
            runs = _least_periods(np.concatenate([runs, np.stack([begin, end, by], axis=1)[long]]))
        k += 1


def _least_periods(runs: np.ndarray) -> np.ndarray:
    """One row per stretch: multiples of its period extend to the same begin and end."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if not len(runs):
        return runs
    return runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))]


def _holds(words: np.ndarray, begin: int, end: int, period: int) -> bool:
    """Whether the stretch has the period and no neighbour extends it."""
    return (
        np.array_equal(words[begin : end - period], words[begin + period : end])
        and (begin == 0 or words[begin - 1] != words[begin + period - 1])
        and (end == len(words) or words[end] != words[end - period])
    )


def word_runs(texts: list[list], combine: Callable = _hashed) -> list[np.ndarray]:
    """The runs of each text, a list of words: rows of begin, end, smallest period, by begin, then period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order], np.int64)
    flat = pa.array(list(chain.from_iterable(texts[i] for i in order)), pa.large_string()).dictionary_encode()
    firsts = np.cumsum(lengths + 1) - lengths - 1
    words = np.empty(len(flat) + len(texts), np.int64)
    words[firsts + lengths] = len(flat) + np.arange(len(texts))
    inside = np.ones(len(words), bool)
    inside[firsts + lengths] = False
    words[inside] = flat.indices.to_numpy(zero_copy_only=False)
    runs = _search(words, lengths, combine)
    runs = runs[runs[:, 1] - runs[:, 0] >= LEAST_WORDS]
    if combine is not _named and not all(_holds(words, *r) for r in runs.tolist()):
        return word_runs(texts, _named)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = np.searchsorted(firsts, runs[:, 0], "right") - 1
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    out: list[np.ndarray] = [np.zeros((0, 3), np.int64)] * len(texts)
    for place, text in enumerate(order):
        out[text] = runs[bounds[place] : bounds[place + 1]] - np.array([firsts[place], firsts[place], 0])
    return out


def collapsed(words: list[str], runs: np.ndarray) -> str:
    """The text without the repeats: of every run only the words of its first period stay."""
    if not len(runs):
        return " ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    dropped = np.cumsum(depth[:-1]) > 0
    return " ".join([w for w, d in zip(words, dropped.tolist(), strict=True) if not d])


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs, collapsed`` of every whole text.

    ``runs`` lists ``start, length, period`` (in words) of every run of at least 24 words and three
    periods, by start, then period. ``collapsed`` has the words that stay, joined by one blank. ``docs`` needs
    ``doc_id, text``; other columns are not read. Null and empty texts have no words; repeated rows and
    null ids stay as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                texts = [_WORD.findall(t or "") for t in part.to_pylist()]
                runs = word_runs(texts)
                rows = np.concatenate(runs)
                values = [rows[:, 0], rows[:, 1] - rows[:, 0], rows[:, 2]]
                listed = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in values], ["start", "length", "period"]),
                )
                kept = pa.array(map(collapsed, texts, runs), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), listed, kept], ["doc_id", "runs", "collapsed"])
                at += len(part)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, runs {RUN}, collapsed string")


def digests(rows: DataFrame) -> DataFrame:
    """Number of runs, the most repeated run, and checksums of all runs and of the collapsed text."""
    best = F.array_max(
        F.transform(
            "runs", lambda r: F.struct((r["length"] / r["period"]).alias("x"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["length"].alias("n"))
        )
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return rows.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.s")).alias("start"),
        F.col("_best.n").alias("length"),
        (-F.col("_best.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("_best.n") / -F.col("_best.p")).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
