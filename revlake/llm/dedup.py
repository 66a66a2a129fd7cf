"""Exact duplicates by deterministic block naming.

A text is cut into fixed-size blocks. All distinct blocks of the corpus are sorted and numbered, so
a block's number is its name. Adjacent names are then paired, the distinct pairs sorted and numbered
in turn, and so on until each document has a single name. Documents with as many blocks and the same
last name are equal, and no others: names come from comparing contents, not from a hash.

Blocks move between tasks with a 64-bit fingerprint. Rows meet their names over the fingerprint
where it stands for one content, which is looked up, and over the content itself where it does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.llm.common import stored

BLOCK = 4096
#: Bits of a fingerprint that name a bucket; a bucket's names are numbered by one task.
BUCKET_BITS = 12


def without_spaces(text: Column) -> Column:
    """The text without blanks and the control characters from tab to carriage return."""
    out = F.coalesce(text, F.lit(""))
    for c in " \n\t\r\x0b\x0c":
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def numbered(distinct: DataFrame, hashed: Column, *order: str) -> DataFrame:
    """Add ``name``: distinct rows sorted and numbered, bucket by bucket.

    The bucket stands in the upper bits of the name, so names are unique and follow the order of
    (bucket, ``hashed``, ``order``) without any task seeing more than its bucket. ``hashed`` spreads
    distinct rows evenly. Buckets hold 1/4096 of the distinct rows; their numbering is a sort, which
    spills.
    """
    bucket = F.shiftrightunsigned(hashed, 64 - BUCKET_BITS)
    place = F.row_number().over(W.partitionBy("_bucket").orderBy("_hash", *order))
    return (
        distinct.withColumns({"_hash": hashed, "_bucket": bucket})
        .withColumn("name", F.shiftleft(F.col("_bucket"), 64 - BUCKET_BITS - 1).bitwiseOR(place.cast("long")))
        .drop("_hash", "_bucket")
    )


def _block_names(texts: DataFrame) -> DataFrame:
    """``row, pos, blocks, name`` for every block of ``texts``."""
    contents = texts.select(F.explode(F.arrays_zip("prints", "contents")).alias("b")).select(
        F.col("b.prints").alias("print"), F.col("b.contents").alias("content")
    )
    # Copies merge in the map tasks: the hottest block arrives once from each of them.
    prints = contents.groupBy("print").agg(F.min("content").alias("lo"), F.max("content").alias("hi"))
    # Stored, so that contents move once whatever reads the names.
    names = stored(
        numbered(prints.select("print", (F.col("lo") != F.col("hi")).alias("shared")), F.xxhash64("print"), "print"), "dedup-prints"
    )
    rows = texts.select("row", "blocks", F.posexplode("prints").alias("pos", "print")).join(
        names.withColumnRenamed("print", "_print"), F.col("print") == F.col("_print")
    )
    if names.where("shared").isEmpty():
        return rows.select("row", "pos", "blocks", "name")
    # Some fingerprints stand for several contents: their rows are named by the content.
    shared = names.where("shared").select(F.col("print").alias("_print"))
    each = texts.select("row", "blocks", F.posexplode(F.arrays_zip("prints", "contents")).alias("pos", "b")).select(
        "row", "pos", "blocks", F.col("b.prints").alias("print"), F.col("b.contents").alias("content")
    )
    open_rows = each.join(shared, F.col("print") == F.col("_print"), "left_semi").drop("print")
    # Below zero, which keeps these names apart from the others.
    own = numbered(open_rows.select("content").distinct(), F.xxhash64("content"), "content").select(
        F.col("content").alias("_content"), (-F.col("name") - 1).alias("name")
    )
    resolved = open_rows.join(own, F.col("content") == F.col("_content")).select("row", "pos", "blocks", "name")
    return rows.where(~F.col("shared")).select("row", "pos", "blocks", "name").unionByName(resolved)


def _pair_names(level: DataFrame) -> DataFrame:
    """The next level: names of adjacent pairs. A last name without a partner is paired with null."""
    side = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
    pairs = level.groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
        F.max("blocks").alias("blocks"), side(0).alias("l"), side(1).alias("r")
    )
    names = numbered(pairs.select("l", "r").distinct(), F.xxhash64("l", "r"), "l", "r").select(
        F.col("l").alias("_l"), F.col("r").alias("_r"), "name"
    )
    joined = pairs.join(names, (F.col("l") == F.col("_l")) & F.col("r").eqNullSafe(F.col("_r")))
    return joined.select("row", "pos", "blocks", "name")


def exact_groups(docs: DataFrame, block: int = BLOCK, print_bits: int = 64) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, n_chars``, one row per row of ``docs``.

    Texts are equal when identical without white space (blank, tab to carriage return); null counts
    as empty. The row with the most code points in the original text stays, then the smallest
    ``doc_id`` (null last), then any one of repeated rows. ``docs`` needs ``doc_id, text``; other
    columns are not read. ``print_bits`` narrows the fingerprint, for tests.
    """
    plain = without_spaces(F.col("text"))
    count = F.greatest(F.lit(1), F.ceil(F.length("plain") / block)).cast("int")
    cut = F.when(F.length("plain") <= block, F.array("plain")).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.substring(F.col("plain"), i * block + 1, F.lit(block)))
    )
    mark = F.xxhash64 if print_bits == 64 else lambda c: F.xxhash64(c) % (1 << print_bits)
    texts = stored(
        docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"), plain.alias("plain"))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumns({"blocks": count, "text_sha256": F.sha2("plain", 256)})
        .withColumn("contents", cut)
        .drop("plain")
        .withColumn("prints", F.transform("contents", lambda c: mark(c))),
        "dedup-texts",
    )
    level = stored(_block_names(texts), "dedup-names")
    most = texts.agg(F.max("blocks")).first()[0] or 1
    done, left = [level.where("blocks = 1").select("row", "blocks", "name")], 1
    level = level.where("blocks > 1")
    while left < most:
        # Stored by level, so that no level computes the ones below it again.
        level = stored(_pair_names(level), "dedup-names")
        left *= 2
        done.append(level.where(F.col("blocks") <= left).select("row", "blocks", "name"))
        level = level.where(F.col("blocks") > left)
    named = done[0]
    for part in done[1:]:
        named = named.unionByName(part)
    rows = texts.select("row", "doc_id", "n_chars", "text_sha256").join(
        named.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row")
    )
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = rows.groupBy("blocks", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    # Joined over another key than they are grouped by, so that the rows of a large group can be
    # dealt to several tasks.
    groups = groups.select(F.struct("name", "blocks").alias("_key"), "group_size", "best")
    return rows.withColumn("key", F.struct("name", "blocks")).join(groups, F.col("key") == F.col("_key")).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
        F.col("n_chars").cast("long").alias("n_chars"),
    )
