"""Token ids in a Huffman-coded binary format.

Documents are tokenised once and their ids stored. The ids' global counts give a canonical Huffman
code whose lengths stop at 16 bits. The ids are then written in ascending ``doc_id`` order: each row
of the output is a segment of whole documents with its bit stream and a bit offset for every block
of 256 ids. Blocks start at known offsets and so decode independently of each other, all blocks of a
segment at once, by one table look-up for each id.

The stores a cluster uses are reached through Spark alone, so segments are rows of Parquet files:
``part`` (range partition, in order), ``segment``, ``first`` (ids before it in its part), ``n_ids``,
``doc_ids``, ``lengths``, ``stream``, ``checkpoints``. A second table holds the code lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.llm.common import partitions, stored
from revlake.session import fresh_path

END_ID = 2
LIMIT = 16
BLOCK = 256
SEGMENT = 1 << 18
TEXT_BYTES = 6_000_000
CACHED = 800_000

#: The tokenizer's own splitting pattern.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Words of these characters need no normalisation but lower case.
PLAIN = regex.compile("[\x21-\x7e\xa1-ɏ]+")
TOKENS_SCHEMA = "doc_id long, n_tokens int, ids binary"
SEGMENT_SCHEMA = (
    "part int, segment int, first long, n_ids long, doc_ids array<long>, lengths array<int>, stream binary, checkpoints binary"
)


class WordEncoder:
    """Token ids of texts, word by word.

    The tokenizer splits at white space and its pieces do not depend on what stands beside them, so
    each distinct word is looked up once for a batch and its pieces are encoded once for a worker, as
    long as they fit the worker's table. Words with characters outside plain Latin, and the
    tokenizer's control strings, go to it as they are. Ids are kept as bytes of little-endian uint32.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = (b for b in range(256) if b not in set(visible))
        names = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.byte_name = [names[b] for b in range(256)]
        self.pieces: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        ids = self.pieces.get(text)
        if ids is None:
            if len(self.pieces) >= CACHED:
                self.pieces.clear()
            named = "".join(map(self.byte_name.__getitem__, text.encode()))
            ids = np.fromiter((t.id for t in self.model.tokenize(named)), "<u4").tobytes()
            self.pieces[text] = ids
        return ids

    def word(self, text: str) -> bytes:
        if PLAIN.fullmatch(text) and "<|" not in text:
            low = text.lower()
            return self.piece(low) if low.isalpha() else b"".join(map(self.piece, PIECES.findall(low)))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in a row, and how many belong to each text."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        known = [self.word(w) for w in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat = np.frombuffer(b"".join(known), "<u4")
        starts = np.concatenate([[0], np.cumsum(sizes)])
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        each = sizes[index]
        ends = np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.repeat(starts[index] - ends[:-1], each) + np.arange(ends[-1])]
        at = ends[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return ids, np.diff(at)


@lru_cache(maxsize=1)
def _encoder(definition: str) -> WordEncoder:
    return WordEncoder(definition)


def _pieces_of(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices with about ``TEXT_BYTES`` of text each; a longer text is a slice of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + TEXT_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def tokenise(docs: DataFrame, definition: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, n_tokens, ids``: the ids of each whole text and ``end_id``, little-endian.

    An id takes two bytes where the vocabulary fits, else four.
    ``definition`` is the tokenizer's JSON. Null counts as empty: such documents have the end id only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        width = 2 if max(encoder.tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        for whole in batches:
            for part in _pieces_of(whole, "text"):
                ids, counts = encoder.encode(part.column("text"))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype(f"<u{width}")
                offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
                blob = pa.Array.from_buffers(
                    pa.large_binary(), len(ends), [None, pa.py_buffer((offsets * width).astype("<i8")), pa.py_buffer(ids)]
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets), pa.int32()), blob.cast(pa.binary())],
                    ["doc_id", "n_tokens", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, TOKENS_SCHEMA)


def ids_of(blob: pa.BinaryScalar, n: int) -> np.ndarray:
    data = blob.as_buffer()
    return np.frombuffer(data, "<u2" if data.size == 2 * n else "<u4")


def global_counts(tokens: DataFrame) -> np.ndarray:
    """Occurrences of each id. Tasks count their rows; the driver gets one row per id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for blob, n in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                part = np.bincount(ids_of(blob, n))
                if len(part) > len(total):
                    total = np.concatenate([total, np.zeros(len(part) - len(total), np.int64)])
                total[: len(part)] += part
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    rows = tokens.select("ids", "n_tokens").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits (package-merge); 0 for unused ids."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit into codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    level, kinds = leaves, []
    for _ in range(limit - 1):
        paired = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, paired])
        order = np.argsort(both, kind="stable")
        level = both[order]
        kinds.append(order < len(leaves))
    take, depth = 2 * len(leaves) - 2, np.zeros(len(leaves), np.int64)
    for is_leaf in reversed(kinds):
        n = int(is_leaf[:take].sum())
        depth[:n] += 1
        take = 2 * (take - n)
    depth[:take] += 1
    lengths[used] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, id), each one more than the last, shifted where lengths grow."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    sizes = lengths[order].astype(np.int64)
    # In units of the longest code, codes are running sums of what each shorter one spans.
    spans = np.left_shift(1, LIMIT - sizes)
    codes[order] = (np.cumsum(spans) - spans) >> (LIMIT - sizes)
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit stream of ``ids``, first bit highest, and the bit offset of every block."""
    sizes = lengths[ids].astype(np.int64)
    ends = np.cumsum(sizes)
    at = ends - sizes
    word, shift = at >> 5, 64 - (at & 31) - sizes
    wide = codes[ids] << shift.astype(np.uint64)
    total = int(ends[-1]) if len(ends) else 0
    n = total // 32 + 2
    # Codes do not overlap, so sums of their halves are exact and equal the joined bits.
    high = np.bincount(word, (wide >> np.uint64(32)).astype(np.float64), n)
    high[1:] += np.bincount(word, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), n)[:-1]
    return high.astype(np.uint64).astype(">u4").tobytes()[: (total + 7) // 8], at[::BLOCK].astype("<u8")


def unpack(stream: bytes, checkpoints: np.ndarray, n_ids: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ids of a stream: all blocks advance together, one id at each step."""
    symbols, sizes = table
    data = np.concatenate([np.frombuffer(stream, np.uint8), np.zeros(BLOCK * 2 + 8, np.uint8)]).astype(np.uint32)
    three = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    at = checkpoints.astype(np.int64)
    out = np.empty((len(at), BLOCK), np.uint32)
    for step in range(min(BLOCK, n_ids)):
        if step == (n_ids - 1) % BLOCK + 1 and len(at) * BLOCK > n_ids:
            at = at[:-1]  # the last block is shorter
        window = (three[at >> 3] >> (8 - (at & 7))) & 0xFFFF
        out[: len(at), step] = symbols[window]
        at = at + sizes[window]
    return out.reshape(-1)[:n_ids]


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for each value of the next 16 bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = np.left_shift(1, LIMIT - lengths[order].astype(np.int64))
    fill = (1 << LIMIT) - int(spans.sum())
    symbols = np.concatenate([np.repeat(order, spans), np.zeros(fill, np.int64)]).astype(np.uint32)
    sizes = np.concatenate([np.repeat(lengths[order], spans), np.ones(fill, np.uint8)]).astype(np.int64)
    return symbols, sizes


def write_tokens(tokens: DataFrame, path: str) -> None:
    """Write ``tokens`` (of ``tokenise``, stored) below ``path`` in ascending ``doc_id`` order, null first.

    Repeated ids stand in the order of length and content. An empty table gives files without rows.
    """
    spark = tokens.sparkSession
    lengths = code_lengths(global_counts(tokens))
    shared = spark.sparkContext.broadcast(lengths.tobytes())
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.frombuffer(shared.value, np.uint8)
        codes, part = canonical_codes(sizes), TaskContext.get().partitionId()
        doc_ids, lens, blobs, held, first, segment = [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(blobs)
            stream, marks = pack(ids, codes, sizes)
            row = [[part], [segment], [first], [len(ids)], [doc_ids], [lens], [stream], [marks.tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            names = ["part", "segment", "first", "n_ids", "doc_ids", "lengths", "stream", "checkpoints"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for doc, n, blob in zip(batch.column("doc_id").to_pylist(), batch.column("n_tokens").to_pylist(), batch.column("ids"), strict=True):
                doc_ids.append(doc)
                lens.append(n)
                blobs.append(ids_of(blob, n))
                held += n
                if held >= SEGMENT:
                    yield flush()
                    first, segment = first + held, segment + 1
                    doc_ids, lens, blobs, held = [], [], [], 0
        if held:
            yield flush()

    keys = ["doc_id", "n_tokens", "_mark"]
    (
        tokens.withColumn("_mark", F.xxhash64("ids"))
        .repartitionByRange(partitions(spark), *keys)
        .sortWithinPartitions(*keys)
        .drop("_mark")
        .mapInArrow(run, SEGMENT_SCHEMA)
        .write.option("compression", "none")
        .parquet(f"{path}/segments")
    )


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of the files below ``path``.

    ``start`` counts the ids of all documents before it; ``with_ids`` adds ``ids`` (array of int).
    """
    code = spark.read.schema("lengths binary").parquet(f"{path}/code").first()
    shared = spark.sparkContext.broadcast(bytes(code["lengths"]))
    schema = "part int, doc_id long, first long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(np.frombuffer(shared.value, np.uint8))
        for batch in batches:
            for row in range(batch.num_rows):
                value = {name: batch.column(name)[row] for name in batch.schema.names}
                lens = np.asarray(value["lengths"].values, dtype=np.int64)
                marks = np.frombuffer(value["checkpoints"].as_buffer(), "<u8")
                ids = unpack(value["stream"].as_buffer(), marks, value["n_ids"].as_py(), table).astype("<u4")
                ends = np.cumsum(lens)
                view = memoryview(ids.tobytes())
                sums = [zlib.crc32(view[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lens.tolist(), strict=True)]
                out = [
                    pa.array([value["part"].as_py()] * len(lens), pa.int32()),
                    value["doc_ids"].values,
                    pa.array(value["first"].as_py() + ends - lens, pa.int64()),
                    pa.array(lens, pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(out, ["part", "doc_id", "first", "n_tokens", "ids_crc32", "ids"][: len(out)])

    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{path}/segments")
    # One row per range partition of the writer.
    earlier = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    bases = segments.groupBy(F.col("part").alias("_part")).agg(F.sum("n_ids").alias("n")).select(
        "_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    decoded = segments.mapInArrow(run, schema).join(bases, F.col("part") == F.col("_part"))
    columns = ["doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"]
    return decoded.select(*columns, *["ids"] * with_ids)


def encode_and_read(docs: DataFrame, definition: str, end_id: int = END_ID) -> DataFrame:
    """Tokenise, write below the shared folder, and read back: the documents' places and checksums."""
    spark = docs.sparkSession
    path = fresh_path(spark, "token-files")
    write_tokens(stored(tokenise(docs, definition, end_id), "token-ids"), path)
    return read_tokens(spark, path)
