"""Spelling variants: words one edit apart, each with its more frequent form and the last form of its chain.

Two words one inserted, deleted or replaced character apart have letter counts whose squared distance
is 1, 2 or 0 and lengths that differ by one at most. So words are put into blocks by length and by how
many letters they have of each of a few letter groups. One edit changes one group by one, or moves one
letter between two groups, or stays inside a group: a block is compared with itself and with the blocks
those steps lead to, and no pair is lost. Blocks are cut into tiles of bounded size. A row with two
tiles gives all squared distances of their letter counts by one matrix product; pairs at most two apart
are compared letter by letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.llm.common import stored

LETTERS = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: Letter groups by code point modulo this number; words in a tile.
GROUPS, TILE = 6, 512
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CELLS = 1 << 22


def letter_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, run``: every run of letters of the whole texts, A-Z in lower case. Null text has none."""
    return docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("run")).select(
        "doc_id", F.translate("run", _UPPER, _LOWER).alias("run")
    )


def counted_words(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words long and frequent enough. ``words`` needs ``word``; nulls are no words."""
    return (
        words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)
    )


def _block(word: Column) -> list[Column]:
    """Length and letters of each group but the last, which follows from these."""
    codes = [*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0xC0, 0x100)]
    groups = ["".join(chr(c) for c in codes if c % GROUPS == g) for g in range(GROUPS)]
    return [F.length(word), *[F.length(word) - F.length(F.translate(word, letters, "")) for letters in groups[:-1]]]


def _steps() -> list[list[int]]:
    """What one edit adds to a block's numbers, of each pair of opposite steps the one."""
    def step(length: int, **changes: int) -> list[int]:
        return [length, *[changes.get(f"g{g}", 0) for g in range(GROUPS - 1)]]

    inserted = [step(1, **{f"g{g}": 1}) for g in range(GROUPS)]
    replaced = [step(0, **{f"g{g}": -1, f"g{h}": 1}) for g in range(GROUPS) for h in range(g + 1, GROUPS)]
    return [step(0), *inserted, *replaced]


def _counts(codes: np.ndarray) -> np.ndarray:
    n, length = codes.shape
    flat = (np.arange(n)[:, None] * 256 + codes).ravel()
    return np.bincount(flat, minlength=n * 256).reshape(n, 256).astype(np.float32)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters are one edit apart; ``b`` is as long as ``a`` or one letter longer."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    same, moved = a == b[:, :-1], a == b[:, 1:]
    ones = np.ones((len(a), 1), bool)
    begins = np.concatenate([ones, np.logical_and.accumulate(same, axis=1)], axis=1)
    ends = np.concatenate([np.logical_and.accumulate(moved[:, ::-1], axis=1)[:, ::-1], ones], axis=1)
    return (begins & ends).any(axis=1)


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def near_in_tiles(left: list[str], right: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs one edit apart. Words of a tile are equally long; ``same``: both tiles are one."""
    a, b = _codes(left), _codes(right)
    x, y = _counts(a), _counts(b)
    used = x.any(axis=0) | y.any(axis=0)
    x, y = x[:, used], y[:, used]
    squared = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero(squared < 2.5)
    if same:
        i, j = i[i < j], j[i < j]
    at_once = max(1, _CELLS // a.shape[1])
    hits = [_one_edit(a[i[k : k + at_once]], b[j[k : k + at_once]]) for k in range(0, len(i), at_once)]
    hit = np.concatenate(hits) if hits else np.zeros(0, bool)
    return i[hit], j[hit]


def _tiles(words: DataFrame) -> DataFrame:
    """``block, tile, words, counts``: blocks dealt to tiles of about ``TILE`` words by a hash of the word."""
    blocked = words.select("word", "n", F.array(*_block(F.col("word"))).alias("block"))
    sizes = blocked.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    dealt = blocked.join(sizes.withColumnRenamed("block", "_block"), F.col("block") == F.col("_block"))
    tile = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    return (
        dealt.groupBy("block", tile.alias("tile"))
        .agg(F.collect_list(F.struct("word", "n")).alias("_rows"))
        .select("block", "tile", F.col("_rows.word").alias("words"), F.col("_rows.n").alias("counts"))
    )


PAIRS = "a string, a_n long, b string, b_n long"


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of words one edit apart, once.

    ``words`` needs distinct ``word`` of letters up to U+00FF, and ``n``.
    """
    tiles = stored(_tiles(words), "spelling-tiles")
    number = F.expr("transform(_step, (s, i) -> s + block[i])")
    steps = F.array(*[F.array(*[F.lit(x) for x in s]) for s in _steps()])
    # Number and words of a tile meet their partner tiles; most blocks are one tile.
    left = tiles.select("block", "tile", "words", "counts", F.explode(steps).alias("_step")).withColumn("_to", number)
    right = tiles.select(
        F.col("block").alias("b_block"), F.col("tile").alias("b_tile"), F.col("words").alias("b_words"), F.col("counts").alias("b_counts")
    )
    meet = left.join(right, F.col("_to") == F.col("b_block")).where("block != b_block or tile <= b_tile")
    rows = meet.select("words", "counts", "b_words", "b_counts", F.expr("block = b_block and tile = b_tile").alias("same"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                a, a_n, b, b_n, same = (c.slice(at, 1)[0] for c in batch.columns)
                i, j = near_in_tiles(a.values.to_pylist(), b.values.to_pylist(), same.as_py())
                if len(i):
                    out = [a.values.take(pa.array(i)), a_n.values.take(pa.array(i)), b.values.take(pa.array(j)), b_n.values.take(pa.array(j))]
                    yield pa.RecordBatch.from_arrays(out, ["a", "a_n", "b", "b_n"])

    return rows.mapInArrow(run, PAIRS)


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last form of every chain. Each pass doubles the steps that a word looks ahead.

    A form is at least twice as frequent, so chains are as short as the logarithm of the largest count.
    """
    ahead = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = ahead.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = stored(
            ahead.join(further, F.col("root") == F.col("_word"), "left").select(
                "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        ahead = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return ahead


def variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    ``n_near`` counts the words one edit away. ``form`` is the most frequent of them (of equal ones the first in
    code-point order) if at least twice as frequent as the word, else null. ``root`` follows forms to the
    last and is the word itself where it has none. ``words`` needs distinct ``word`` of letters up to
    U+00FF, and ``n``, as from ``counted_words``; no words give no rows.
    """
    words = stored(words.select("word", "n"), "spelling-words")
    pairs = near_pairs(words)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = both.groupBy(F.col("a").alias("_a")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("b"))).alias("best")
    )
    often = -F.col("best.n") >= 2 * F.col("n")
    forms = stored(
        words.join(best, F.col("word") == F.col("_a"), "left").select(
            "word",
            F.when(often, F.col("best.b")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, -F.col("best.n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(forms.where("form is not null")).select(F.col("word").alias("_w"), F.col("root").alias("_root"))
    return forms.join(roots, F.col("word") == F.col("_w"), "left").select(
        "word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n"
    )
