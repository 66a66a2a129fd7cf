"""Similarity join on word shingles with several global token orders.

The hashes of shingles lie on a circle; an order begins at one of three points of it and goes round.
In all of them the shingles that very many texts share come last.
Two sets with Jaccard similarity t or more share a token among the first ``n - ceil(t n) + 1`` of each
of them under any order. Candidates come from the first order, must meet in the other two as well,
must pass a bound from bitmaps of their sets, and only then are compared whole.

Rows with equal sets are one class; classes are joined. In every list of classes that share a token:

1. All are compared with one of them, the hub, which joins the classes of a group of near copies
   with as many comparisons as it has members.
2. Lists that would still make many pairs are dealt into small parts by chance, a few times over, and only
   classes of one part are compared. That joins large groups of near copies whose members link with many
   others, but not with the hub, in proportion to their size.
3. What is still apart is compared pair by pair, but no pairs are made within a component. Lists are
   split by size, since similar sets have similar sizes. A list of many pairs is laid out in tiles of
   bounded size; a task compares the bitmaps of a tile and passes on only pairs that may link. Splitting
   such a list by the tokens of other orders made more pairs than the list has, since near copies share
   many. No list is cut.

The place of a shared token bounds what two sets can have in common: no more than what either has from
there on. Of two linked sets, the first token they share keeps this bound, so pairs are made only where
places allow them. In particular the smaller set shares one of its first ``n - ceil(2 t n / (1 + t)) + 1``.

The links' components are found by contraction, round by round, on stored tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.llm.common import stored
from revlake.llm.shingles import shingle_sets, slices

#: The bitmaps in a list with more pairs than the square of this are compared in tiles.
LONG = 64
#: Sets on either side of a tile, and bytes of their bitmaps.
LONGER, TILE_BYTES = 1024, 4_000_000
#: Times that lists of many pairs are dealt into parts, and classes of either side in a part.
DEALS, PER_PART = 3, 16
#: Texts that a task holds to compare others with, and others compared with one copy of them.
PER_TEAM, PER_HUB = 64, 256
#: A shingle counts as common when more than one in so many texts has it.
COMMON = 500
COUNT_BYTES = 12_000_000
#: Hashes of the texts to compare that are broadcast at most, so that other texts need not move.
SENT = 1 << 18
PROFILE = "doc_id long, mark long, n long, digest binary, first array<long>, second array<smallint>, third array<smallint>, bits array<long>"


def common_tokens(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles that come last in every order, sorted.

    Any choice gives the same links; a good one keeps lists short. Tasks count over slices of texts
    and report what at least three texts of a slice share. The driver gets the shingles of more than
    one in ``COMMON`` texts: fewer than ``COMMON`` times a text's average number of shingles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text"), COUNT_BYTES):
                sets = [shingle_sets(part, width)[0] for part in slices(texts)]
                tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
                shared = counts >= 3
                columns = [pa.array(tokens[shared].view(np.int64)), pa.array(counts[shared], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["token", "n"])

    counted = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") * COMMON > docs.count()).collect()
    return np.sort(np.array([r["token"] for r in rows], np.int64).view(np.uint64))


def rotated(tokens: np.ndarray, start: np.uint64, size: int) -> np.ndarray:
    """The first ``size`` of sorted ``tokens`` from ``start`` on, round the circle."""
    begin = int(np.searchsorted(tokens, start))
    part = tokens[begin : begin + size]
    return part if len(part) == size else np.concatenate([part, tokens[: min(begin, size - len(part))]])


def bitmaps(tokens: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """A bitmap of each set in 64-bit words: a power of two of bits, two to four times the set's size."""
    sizes = np.diff(bounds)
    bits = 1 << np.ceil(np.log2(np.maximum(2 * sizes, 64))).astype(np.int64)
    starts = np.append(0, np.cumsum(bits))
    marked = np.zeros(starts[-1], bool)
    marked[np.repeat(starts[:-1], sizes) + (tokens & np.repeat(bits - 1, sizes).astype(np.uint64)).astype(np.int64)] = True
    words = np.packbits(marked, bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array(starts // 64, pa.int32()), pa.array(words))


def profiles(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """For every row: set size, digest of the set, its prefix under three orders, and its bitmap.

    The second and third prefix keep 16 bits of each hash, which can only add candidates.
    """
    starts = [np.uint64(i * (2**64 // 3)) for i in range(3)]
    shared = docs.sparkSession.sparkContext.broadcast(common_tokens(docs, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        maybe = np.zeros(1 << 20, bool)
        maybe[common >> np.uint64(44)] = True
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                tokens, bounds = shingle_sets(texts, width)
                late = maybe[tokens >> np.uint64(44)]
                late[late] = np.isin(tokens[late], common)
                digests, prefixes, sizes = [], ([], [], []), np.diff(bounds)
                lengths = np.where(sizes > 0, sizes - -(-percent * sizes // 100) + 1, 0)
                for i, (n, p) in enumerate(zip(sizes.tolist(), lengths.tolist(), strict=True)):
                    own = tokens[bounds[i] : bounds[i + 1]]
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    last = late[bounds[i] : bounds[i + 1]]
                    rare = own[~last]
                    for start, out in zip(starts, prefixes, strict=True):
                        part = rotated(rare, start, p)
                        out.append(part if len(part) == p else np.concatenate([part, rotated(own[last], start, p - len(part))]))
                offsets = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
                whole = [np.concatenate(p) if p else np.zeros(0, np.uint64) for p in prefixes]
                lists = [pa.ListArray.from_arrays(offsets, pa.array(whole[0].view(np.int64)))]
                lists += [pa.ListArray.from_arrays(offsets, pa.array((w >> np.uint64(20)).astype(np.uint16).view(np.int16))) for w in whole[1:]]
                lists.append(bitmaps(tokens, bounds))
                ids = [batch.column(c).slice(at, len(texts)) for c in ("doc_id", "mark")]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), *lists], [c.split()[0] for c in PROFILE.split(", ")]
                )

    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    return marked.mapInArrow(run, PROFILE)


def _meet(n: str, at: str, m: str, bt: str, percent: int) -> Column:
    """Whether sets of ``n`` and ``m`` tokens may link if the first they share has ``at`` and ``bt`` before it."""
    most = F.least(F.col(n) - F.col(at), F.col(m) - F.col(bt))
    return (100 + percent) * most >= percent * (F.col(n) + F.col(m))


def _largest(at: str, percent: int) -> Column:
    """Size of the largest set that one of ``n`` tokens may link with, the first they share being at ``at``."""
    return F.expr(f"(100 + {percent}) * (n - {at}) div {percent}") - F.col("n")


def possible(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (``a, b``, more is kept) that may link as far as bitmaps tell. ``bits``: ``cid, n, bits``.

    A bit of one set that the other lacks is an element that the other lacks, which bounds what they
    have in common from above: no link is lost. The larger bitmap is folded to the size of the other;
    sets more than twice as large as the other are left to the comparison of whole sets.
    """
    side = lambda name: bits.select(F.col("cid").alias(f"_{name}"), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))
    joined = pairs.join(side("a"), F.col("a") == F.col("_a")).join(side("b"), F.col("b") == F.col("_b"))
    words = F.least(F.size("bits_a"), F.size("bits_b"))
    halves = lambda x: F.zip_with(F.slice(x, F.lit(1), words), F.slice(x, words + 1, words), lambda p, q: p.bitwiseOR(q))
    even = lambda x: F.when(F.size(x) > words, halves(x)).otherwise(F.col(x))
    alone = lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))
    absent = lambda x, y: F.aggregate(F.zip_with(x, y, alone), F.lit(0), lambda sum_, k: sum_ + k)
    joined = joined.withColumns({"_x": even("bits_a"), "_y": even("bits_b")})
    both = F.least(F.col("n_a") - absent("_x", "_y"), F.col("n_b") - absent("_y", "_x"))
    far = F.greatest(F.size("bits_a"), F.size("bits_b")) > 2 * words
    return joined.where(far | (100 * both >= percent * (F.col("n_a") + F.col("n_b") - both))).select(*pairs.columns)


def verify(pairs: DataFrame, keys: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs that link, by comparing whole sets. ``pairs``: ``team, a, b``; ``keys``: ``cid, doc_id, mark``.

    Texts of a team's first sides move together, about ``PER_TEAM`` to a task's memory at a time, and
    those of their partners follow once for all of them. Large teams are split on both sides.
    """
    sizes = pairs.groupBy(F.col("team").alias("_team")).agg(F.approx_count_distinct("a").alias("na"), F.approx_count_distinct("b").alias("nb"))
    part = lambda side, n, most: F.pmod(F.xxhash64(side), F.ceil(F.col(n) / most)).cast("int")
    split = pairs.join(sizes, F.col("team") == F.col("_team")).select(
        "team", part("a", "na", PER_TEAM).alias("pa"), part("b", "nb", PER_HUB).alias("pb"), "a", "b"
    )
    team = ["team", "pa", "pb"]
    none = F.lit(None).cast("array<long>")
    need = (
        split.groupBy(*team, F.col("b").alias("cid")).agg(F.collect_list("a").alias("partners")).withColumn("second", F.lit(1))
        .unionByName(split.select(*team, F.col("a").alias("cid")).distinct().withColumns({"partners": none, "second": F.lit(0)}))
        .join(keys.select(F.col("cid").alias("_cid"), F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark")), F.col("cid") == F.col("_cid"))
        .drop("_cid")
    )
    bucket = lambda mark: F.pmod(mark, F.lit(SENT)).cast("int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    wanted = stored(need.select(bucket(F.col("_mark")).alias("_bucket")).distinct(), "jaccard-wanted")
    texts = texts.join(F.broadcast(wanted), bucket(F.col("mark")) == F.col("_bucket"), "left_semi")
    shipped = texts.join(need, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in batches:
            found, at = [], 0
            columns = [*team, "second", "cid", "partners"]
            rows = list(zip(*(batch.column(c).to_pylist() for c in columns), strict=True))
            for texts in slices(batch.column("text")):
                tokens, bounds = shingle_sets(texts, width)
                for i, (*own_team, second, cid, partners) in enumerate(rows[at : at + len(texts)]):
                    own = tokens[bounds[i] : bounds[i + 1]]
                    if own_team != now:
                        now, held = own_team, {}
                    if not second:
                        held[cid] = own.copy()
                        continue
                    for a in partners:
                        other = held.get(a)
                        if other is None or not len(other) or not len(own):
                            continue
                        place = np.minimum(np.searchsorted(other, own), len(other) - 1)
                        both = int((other[place] == own).sum())
                        if 100 * both >= percent * (len(other) + len(own) - both):
                            found.append((a, cid))
                at += len(texts)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    return (
        shipped.select(*team, "second", "cid", "partners", "text")
        .repartition(*team)
        .sortWithinPartitions(*team, "second")
        .mapInArrow(run, "a long, b long")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of all ends of ``links`` (``a``, ``b``): the smallest node of each component.

    In every round each node turns to its smallest neighbour if that is smaller, and the links are
    carried over; at least half of the nodes that still have links go.
    """
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        turn = stored(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("to")), "turns"
        )
        to = lambda name: turn.select(F.col("node").alias(f"_{name}"), F.col("to").alias(f"to_{name}"))  # noqa: E731, B023
        moved = edges.join(to("a"), F.col("a") == F.col("_a")).join(to("b"), F.col("b") == F.col("_b"))
        edges = stored(
            moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).where("a <> b").distinct(), "links"
        )
        if labels is None:
            labels = turn.select("node", F.col("to").alias("component"))
        else:
            next_ = turn.select(F.col("node").alias("_n"), "to")
            labels = stored(
                labels.join(next_, F.col("component") == F.col("_n"), "left").select("node", F.coalesce("to", "component").alias("component")),
                "labels",
            )
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _with_component(df: DataFrame, labels: DataFrame, key: str = "cid") -> DataFrame:
    own = labels.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    return df.join(own, F.col(key) == F.col("_node"), "left").withColumn("comp", F.coalesce("_component", key)).drop("_node", "_component")


def _mixed(lists: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of lists that hold more than one component and a smaller side, with the number of pairs ``m`` at most."""
    sizes = lists.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(
        (F.count_if(F.col("smaller")) * F.count_if(~F.col("smaller"))).alias("m"), F.min("comp").alias("_low"), F.max("comp").alias("_high")
    )
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    return lists.join(sizes.where("m > 0 and _low <> _high"), same).drop("_low", "_high", *(f"_{k}" for k in keys))


def _pairs(lists: DataFrame, keys: list[str], places: list[str], percent: int, *carried: str) -> DataFrame:
    """Pairs of a list's smaller and larger sets whose ``places`` allow a link; of sets of one size the first is the smaller."""
    renamed = {"cid": "b", **{c: f"_{c}" for c in ["n", "comp", *keys, *places]}}
    other = lists.where(~F.col("smaller")).select(*(F.col(c).alias(r) for c, r in renamed.items()))
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    order = (F.col("n") < F.col("_n")) | ((F.col("n") == F.col("_n")) & (F.col("cid") < F.col("b")))
    near = [_meet("n", p, "_n", f"_{p}", percent) for p in places]
    joined = lists.where("smaller").join(other, [*same, order, F.col("comp") != F.col("_comp"), *near])
    return joined.select(*carried, F.least("cid", "b").alias("a"), F.greatest("cid", "b").alias("b"))


def _banded(lists: DataFrame, percent: int) -> DataFrame:
    """Rows of ``lists`` in the band of their size, and again as a pair's smaller side in the bands of its partners.

    ``lists``: token, at, cid, n, comp, where ``at`` is the token's place in the set's first order.
    """
    band = lambda n: F.floor(F.log(n) / -float(np.log(percent / 100))).cast("int")
    bands = F.sequence(band(F.col("n")), band(_largest("at", percent)))
    smaller = lists.where(_largest("at", percent) >= F.col("n")).withColumns({"band": F.explode(bands), "smaller": F.lit(True)})
    return lists.withColumns({"band": band(F.col("n")), "smaller": F.lit(False)}).unionByName(smaller)


def mixed_lists(lists: DataFrame, percent: int) -> DataFrame:
    """Rows of ``lists``, in bands of their sizes, that hold more than one component, with the number of pairs ``m`` at most."""
    return _mixed(_banded(lists, percent), ["token", "band"])


def dealt_pairs(many: DataFrame, percent: int, deal: int) -> DataFrame:
    """``team, a, b``: pairs of different components that one deal of lists of many pairs brings together. ``many`` as from ``mixed_lists``."""
    keys = ["token", "band"]
    many = _mixed(many.drop("m"), keys)
    parts = F.ceil(F.sqrt("m") / PER_PART)
    many = stored(many.withColumn("part", F.pmod(F.xxhash64("cid", F.lit(deal)), parts)).withColumn("team", F.xxhash64(*keys, "part")), "jaccard-deal")
    return _pairs(many, [*keys, "part"], ["at"], percent, "team").groupBy("a", "b").agg(F.min("team").alias("team")).select("team", "a", "b")


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps, one a row, folded to ``width`` words where they have twice as many."""
    return words if words.shape[1] == width else words[:, :width] | words[:, width:]


def _by_width(lists: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places of the bitmaps of each length and their words, one bitmap a row."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets, words = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
    sizes, out = np.diff(offsets), {}
    for width in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == width)
        out[width] = at, words[offsets[at][:, None] + np.arange(width)]
    return out


def tile_pairs(tile: pa.Table, percent: int) -> pa.Table:
    """Pairs of a tile's smaller and larger sets, of different components, that places and bitmaps allow.

    The rules are those of ``_pairs`` and ``possible``.
    """
    tile = tile.combine_chunks()
    smaller = tile.column("smaller").to_numpy()
    first, second = tile.filter(pa.array(smaller)), tile.filter(pa.array(~smaller))
    x, y = ({c: t.column(c).to_numpy() for c in ("cid", "n", "comp", "at")} for t in (first, second))
    rows, columns, found = _by_width(first.column("bits")), _by_width(second.column("bits")), []
    for ours, (at, words) in rows.items():
        for theirs, (bt, others) in columns.items():
            width, far = min(ours, theirs), max(ours, theirs) > 2 * min(ours, theirs)
            if not far:
                left, right = _folded(words, width), _folded(others, width)
            cid, n, comp, after = y["cid"][bt], y["n"][bt], y["comp"][bt], y["n"][bt] - y["at"][bt]
            for k, i in enumerate(at.tolist()):
                size = x["n"][i]
                near = (100 + percent) * np.minimum(size - x["at"][i], after) >= percent * (size + n)
                near &= ((size < n) | ((size == n) & (x["cid"][i] < cid))) & (x["comp"][i] != comp)
                j = np.flatnonzero(near)
                if len(j) and not far:
                    other = right[j]
                    absent = np.bitwise_count(left[k] & ~other).sum(1, dtype=np.int64)
                    lacks = np.bitwise_count(other & ~left[k]).sum(1, dtype=np.int64)
                    both = np.minimum(size - absent, n[j] - lacks)
                    j = j[100 * both >= percent * (size + n[j] - both)]
                if len(j):
                    found.append((np.minimum(x["cid"][i], cid[j]), np.maximum(x["cid"][i], cid[j])))
    sides = [np.concatenate(side) for side in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 2
    return pa.table([pa.array(side, pa.int64()) for side in sides], ["a", "b"])


def tiled_pairs(many: DataFrame, bits: DataFrame, percent: int, longer: int = LONGER) -> DataFrame:
    """Pairs of ``many`` lists (as from ``mixed_lists``) that places and bitmaps allow; a tile's sides are bounded."""
    keys = ["token", "band"]
    # A bitmap has half a byte a token at most.
    most = F.greatest(F.lit(1), F.least(F.lit(longer), F.floor(2 * TILE_BYTES / F.max("n"))))
    parts = lambda here: F.ceil(F.count_if(here) / most).cast("int")
    sizes = many.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(
        parts(F.col("smaller")).alias("rows"), parts(~F.col("smaller")).alias("columns")
    )
    own = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = many.join(sizes, [F.col(k) == F.col(f"_{k}") for k in keys])
    across = dealt.where("smaller").withColumn("row", own("rows")).withColumn("column", every("columns"))
    down = dealt.where(~F.col("smaller")).withColumn("column", own("columns")).withColumn("row", every("rows"))
    tiles = across.unionByName(down).select(F.xxhash64(*keys, "row", "column").alias("tile"), "smaller", "cid", "n", "comp", "at")
    tiles = tiles.join(bits.select(F.col("cid").alias("_cid"), "bits"), F.col("cid") == F.col("_cid")).drop("_cid")
    return tiles.groupBy("tile").applyInArrow(lambda tile: tile_pairs(tile, percent), "a long, b long").distinct()


def remaining_pairs(
    lists: DataFrame, prefixes: DataFrame, bits: DataFrame, percent: int, long: int = LONG, longer: int = LONGER
) -> DataFrame:
    """Pairs of classes in different components that meet under all three orders. ``lists`` are as from ``mixed_lists``."""
    found = _pairs(lists.where(F.col("m") <= long * long), ["token", "band"], ["at"], percent).distinct()
    many = _mixed(lists.where(F.col("m") > long * long).drop("m"), ["token", "band"])
    pairs = stored(found.unionByName(tiled_pairs(stored(many, "jaccard-lists"), bits, percent, longer)).distinct(), "jaccard-pairs")
    for column in ("second", "third"):
        side = lambda name, column=column: prefixes.select(F.col("cid").alias(f"_{name}"), F.col(column).alias(f"of_{name}"))
        joined = pairs.join(side("a"), F.col("a") == F.col("_a")).join(side("b"), F.col("b") == F.col("_b"))
        pairs = stored(joined.where(F.arrays_overlap("of_a", "of_b")).select("a", "b"), "jaccard-pairs")
    return pairs


def teamed(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs turned so that ``a`` is in the larger component so far, which is their team."""
    sizes = labels.groupBy(F.col("component").alias("_c")).agg(F.count(F.lit(1)).alias("size"))
    sized = lambda df, key, c, n: (
        _with_component(df, labels, key).withColumnRenamed("comp", c).join(sizes, F.col(c) == F.col("_c"), "left")
        .withColumn(n, F.coalesce("size", F.lit(1))).drop("size", "_c")
    )
    both = sized(sized(pairs, "a", "ca", "na"), "b", "cb", "nb")
    turn = (F.col("nb") > F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("cb") < F.col("ca")))
    either = lambda x, y: F.when(turn, F.col(y)).otherwise(F.col(x))
    return both.select(either("ca", "cb").alias("team"), either("a", "b").alias("a"), either("b", "a").alias("b"))


def link_components(
    docs: DataFrame, percent: int = 90, width: int = 3, long: int = LONG, longer: int = LONGER
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``docs`` (``doc_id, text``; more is not read).

    Words are runs of other characters than blank and tab to carriage return, A-Z in lower case. Two
    rows link when ``100 * common >= percent * united`` for their sets of ``width``-word shingles; a
    text with fewer words has its whole sequence as one; one without words, or null, links with
    nothing. ``component_id`` is the smallest ``doc_id`` that links reach (null only where all are).
    Repeated rows have equal sets and share a component; repeated ids of different texts do not join
    their components. An added ``mark`` (64-bit hash of the text) tells such rows apart, and ``stays``
    is true for one row of each component, with its smallest ``doc_id``, and for rows without words.
    """
    rows = stored(profiles(docs, percent, width).withColumn("row", F.monotonically_increasing_id()), "jaccard-profiles")
    classes = rows.where("n > 0").groupBy("digest").agg(
        F.min("row").alias("cid"), F.min("doc_id").alias("least"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"),
    )
    # Joined over another key than they are grouped by, so that large classes can be dealt out.
    members = stored(
        rows.select("row", "doc_id", "mark", "n", F.when(F.col("n") > 0, F.struct("digest", F.lit(0))).alias("key"))
        .join(classes.select(F.struct("digest", F.lit(0)).alias("_key"), "cid", "least", "first"), F.col("key") == F.col("_key"), "left")
        .select("row", "doc_id", "mark", "n", "cid", "least", "first"),
        "jaccard-members",
    )
    keys = members.where("row = cid").select("cid", "doc_id", "mark", "n", "least", "first")
    prefixes = rows.join(keys.select("cid"), F.col("row") == F.col("cid")).select("cid", "n", "first", "second", "third")
    postings = prefixes.select("cid", "n", F.posexplode("first").alias("at", "token"))
    hub = F.min(F.struct("cid", "n", "at")).alias("hub")
    # A list without a smaller side has no pair that its places allow.
    least = F.min(F.when(_largest("at", percent) >= F.col("n"), F.lit(0)))
    shared = postings.groupBy(F.col("token").alias("_token")).agg(F.count(F.lit(1)).alias("m"), least.alias("_side"), hub).where("m > 1 and _side = 0")
    lists = postings.join(shared, F.col("token") == F.col("_token"))
    lists = stored(
        lists.select("token", "at", "cid", "n", F.col("hub.cid").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.at").alias("hub_at")),
        "jaccard-postings",
    )
    stars = lists.where((F.col("cid") != F.col("hub")) & _meet("n", "at", "hub_n", "hub_at", percent)).select("cid", "hub").distinct()
    stars = stars.select(F.col("hub").alias("team"), F.col("hub").alias("a"), F.col("cid").alias("b"))
    bits = rows.join(keys.select("cid"), F.col("row") == F.col("cid")).select("cid", "n", "bits")
    stars = stored(possible(stars, bits, percent), "jaccard-stars")
    links = stored(verify(stars, keys, docs, percent, width), "jaccard-links")
    near = components(links)
    mixed = stored(mixed_lists(_with_component(lists.select("token", "at", "cid", "n"), near), percent), "jaccard-lists").drop("comp")
    for deal in range(DEALS):
        many = _with_component(mixed.where(F.col("m") > long * long), near)
        dealt = stored(possible(dealt_pairs(many, percent, deal), bits, percent), "jaccard-dealt")
        if dealt.isEmpty():
            break
        links = links.unionByName(stored(verify(dealt, keys, docs, percent, width), "jaccard-links"))
        near = components(links)
    pairs = remaining_pairs(_with_component(mixed, near), prefixes.drop("first", "n"), bits, percent, long, longer)
    pairs = stored(possible(pairs, bits, percent), "jaccard-possible")
    pairs = stored(teamed(pairs, near), "jaccard-teams")
    late = verify(pairs, keys, docs, percent, width)
    late = _with_component(late, near, "a").withColumnRenamed("comp", "ca")
    late = _with_component(late, near, "b").select(F.col("ca").alias("a"), F.col("comp").alias("b"))
    joined = components(late)
    final = _with_component(keys, near).withColumnRenamed("comp", "one")
    final = stored(_with_component(final, joined, "one").select("cid", "least", "first", "comp"), "jaccard-classes")
    least = final.groupBy(F.col("comp").alias("_comp")).agg(
        F.min("least").alias("component_id"), F.min("first").alias("best")
    )
    named = final.join(least, F.col("comp") == F.col("_comp")).select(F.struct("cid", F.lit(0)).alias("_cid"), "component_id", "best")
    out = members.withColumn("_key", F.when(F.col("cid").isNotNull(), F.struct("cid", F.lit(0)))).join(named, F.col("_key") == F.col("_cid"), "left")
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    stays = F.col("cid").isNull() | (F.col("row") == F.col("best.row"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "mark", stays.alias("stays"))


def one_of_each(docs: DataFrame, percent: int = 90, width: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when one document of each component does.

    The one with the smallest ``doc_id`` stays. Rows without words stay. Repeated rows of one
    ``doc_id`` and text are one document.
    """
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"))
    kept = link_components(docs, percent, width).where("stays").select(F.struct("doc_id", "mark").alias("_key"))
    whole = docs.select(key.alias("_key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    return whole.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")
