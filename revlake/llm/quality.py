"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded by surface statistics; a gated attention
network learns from document labels which passages tell, and a document's score comes from its
attention-weighted passage representation. Training sees a bounded sample of labelled documents,
scoring all passages of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a passage; the last one of a document is shorter.
PASSAGE = 512
#: Most labelled documents that a model is fitted on; the smallest hashes of their ids are taken.
TRAIN_DOCS = 4000
SLICE_BYTES = 4_000_000

_CLASSES = 9
#: Class of each byte: white space, lower and upper case, digit, comma or full stop, other marks in two
#: groups, control characters, bytes of characters beyond ASCII.
_KIND = np.full(256, 5, np.uint8)
_KIND[:32] = 7
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[ord(","), ord("."), ord("'"), ord("-"), ord(";"), ord(":")]] = 4
_KIND[[ord(c) for c in "#$%&*|@^~<>{}[]_=+\\"]] = 6
_KIND[127:] = 8
FEATURES = _CLASSES + _CLASSES * _CLASSES + 8


def encode_passages(text: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Features of the byte ranges of ``text``: shares of byte classes and of their pairs, word shape, repetition."""
    n, size = len(starts), (stops - starts).astype(np.float32)
    kind = _KIND[text]
    owner = np.repeat(np.arange(n), stops - starts)
    if n and (starts[0] > 0 or len(owner) != len(text) - starts[0]):
        at = np.arange(len(owner)) - np.repeat(np.cumsum(stops - starts) - (stops - starts), stops - starts) + np.repeat(starts, stops - starts)
        text, kind = text[at], kind[at]
    out = np.zeros((n, FEATURES), np.float32)
    safe = np.maximum(size, 1)
    singles = np.bincount(owner * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, _CLASSES)
    inside = owner[1:] == owner[:-1]
    pair = (owner[1:] * _CLASSES + kind[:-1]) * _CLASSES + kind[1:]
    pairs = np.bincount(pair[inside], minlength=n * _CLASSES**2).reshape(n, _CLASSES**2)
    out[:, :_CLASSES] = singles / safe[:, None]
    out[:, _CLASSES : _CLASSES + _CLASSES**2] = np.sqrt(pairs / safe[:, None])
    # Words and how many differ, by a polynomial hash of each word.
    space = kind == 0
    begins = ~space & np.concatenate([[True], space[:-1] | ~inside]) if len(text) else np.zeros(0, bool)
    first = np.flatnonzero(begins)
    words = np.bincount(owner[first], minlength=n).astype(np.float32)
    extra = out[:, _CLASSES + _CLASSES**2 :]
    if len(first):
        weight = np.uint64(0x9E3779B97F4A7C15)
        place = np.arange(len(text), dtype=np.uint64) - np.repeat(first, np.diff(np.append(first, len(text)))).astype(np.uint64) if first[0] == 0 else None
        if place is None:
            lead = np.zeros(first[0], np.uint64)
            place = np.concatenate([lead, np.arange(first[0], len(text), dtype=np.uint64) - np.repeat(first, np.diff(np.append(first, len(text)))).astype(np.uint64)])
        mixed = (text.astype(np.uint64) + np.uint64(257) * place + np.uint64(1)) * weight
        mixed = np.where(space, np.uint64(0), mixed ^ (mixed >> np.uint64(29)))
        hashes = np.add.reduceat(mixed, first)
        key = (owner[first].astype(np.uint64) << np.uint64(32)) | (hashes >> np.uint64(32))
        distinct = np.unique(key)
        different = np.bincount((distinct >> np.uint64(32)).astype(np.int64), minlength=n)
        extra[:, 0] = different / np.maximum(words, 1)
    extra[:, 1] = np.log1p(size) / 8
    extra[:, 2] = (size - singles[:, 0]) / np.maximum(words, 1) / 16
    extra[:, 3] = words / safe
    extra[:, 4] = singles[:, 2] / np.maximum(singles[:, 1] + singles[:, 2], 1)
    extra[:, 5] = (singles[:, 5] + singles[:, 6]) / np.maximum(words, 1)
    extra[:, 6] = singles[:, 6] / np.maximum(words, 1)
    extra[:, 7] = 1
    return out


def cut_passages(sizes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, stop and document of every passage. An empty document has one empty passage."""
    counts = np.maximum(1, -(-sizes // PASSAGE))
    owner = np.repeat(np.arange(len(sizes)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begin[owner] + place * PASSAGE
    return starts, np.minimum(starts + PASSAGE, (begin + sizes)[owner]), owner


def bags(texts: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Features and owners of the passages of slices of ``texts`` (null: empty)."""
    filled = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(filled):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, "right")) - 1)
        base = ends[at]
        starts, stops, owner = cut_passages(np.diff(ends[at : to + 1]), ends[at:to] - base)
        yield slice(at, to), encode_passages(data[base : ends[to]], starts, stops), owner
        at = to


@dataclass(frozen=True)
class GatedAttention:
    """score = sigmoid(c . sum_k a_k h_k + d); a = softmax(w . (tanh(V h) * sigmoid(U h))); h = relu(E x + e)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(0, (x - self.mean) / self.scale @ self.weights["E"] + self.weights["e"])

    def score(self, x: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        return _forward(self.weights, self.hidden(x), owner, n)[0]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _forward(p: dict, h: np.ndarray, owner: np.ndarray, n: int):
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    raw = (t * g) @ p["w"]
    first = np.searchsorted(owner, np.arange(n))
    top = np.maximum.reduceat(raw, first)
    e = np.exp(raw - top[owner])
    a = e / np.add.reduceat(e, first)[owner]
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    return _sigmoid(z @ p["c"] + p["d"]), a, z, t, g, first


def fit(x: np.ndarray, owner: np.ndarray, y: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 60, rate: float = 0.01, seed: int = 7) -> GatedAttention:
    """Adam on the mean log loss with a little weight decay, in batches of 64 documents."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = ((x - mean) / scale).astype(np.float32)
    p = {
        "E": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), "e": np.zeros(hidden),
        "V": rng.normal(0, 0.2, (hidden, gate)), "U": rng.normal(0, 0.2, (hidden, gate)), "w": rng.normal(0, 0.2, gate),
        "c": rng.normal(0, 0.2, hidden), "d": np.zeros(1),
    }
    bounds = np.searchsorted(owner, np.arange(len(y) + 1))
    moments, steps = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), 64):
            docs = order[i : i + 64]
            rows = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in docs])
            own = np.repeat(np.arange(len(docs)), [bounds[d + 1] - bounds[d] for d in docs])
            xb = x[rows]
            pre = xb @ p["E"] + p["e"]
            h = np.maximum(0, pre)
            s, a, z, t, g, first = _forward(p, h, own, len(docs))
            ds = (s - y[docs]) / len(docs)
            dz = ds[:, None] * p["c"]
            da = (dz[own] * h).sum(1)
            draw = a * (da - np.add.reduceat(a * da, first)[own])
            dt, dg = draw[:, None] * p["w"] * g * (1 - t * t), draw[:, None] * p["w"] * t * g * (1 - g)
            dh = (a[:, None] * dz[own] + dt @ p["V"].T + dg @ p["U"].T) * (pre > 0)
            grads = {
                "E": xb.T @ dh, "e": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ draw, "c": z.T @ ds, "d": ds.sum(keepdims=True),
            }
            steps += 1
            for k, grad in grads.items():
                grad = grad + 1e-4 * p[k]
                m, v = moments[k]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                p[k] -= rate * (0.97**epoch) * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
    return GatedAttention(mean, scale, p)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_docs: int = TRAIN_DOCS) -> GatedAttention | None:
    """Fit on at most ``max_docs`` labelled documents, those with the smallest hashes of their ids.

    Passages are encoded by tasks; the driver gets the features of the sampled documents' passages,
    all of them. Without labels of both kinds there is no model (None).
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x, owner in bags(batch.column("text")):
                blobs = []
                for k in range(part.stop - part.start):
                    lo, hi = np.searchsorted(owner, [k, k + 1])
                    blobs.append(x[lo:hi].astype("<f4").tobytes())
                ids = batch.column("doc_id").slice(part.start, part.stop - part.start)
                y = batch.column("y").slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([ids, y, pa.array(blobs, pa.binary())], ["doc_id", "y", "x"])

    # At most max_docs rows of two numbers.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")
    rows = sorted(found.mapInArrow(run, "doc_id long, y int, x binary").collect(), key=lambda r: (r["doc_id"], bytes(r["x"])))
    y = np.array([r["y"] for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        return None
    x = [np.frombuffer(r["x"], "<f4").reshape(-1, FEATURES) for r in rows]
    return fit(np.concatenate(x), np.repeat(np.arange(len(x)), [len(v) for v in x]), y)


def score(docs: DataFrame, model: GatedAttention | None) -> DataFrame:
    """``doc_id, score`` of every row of ``docs`` (``doc_id, text``); null texts score as empty ones.

    Without a model every score is 0.5. Only the text enters the score.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.full(batch.num_rows, 0.5)
            if model is not None:
                for part, x, owner in bags(batch.column("text")):
                    out[part] = model.score(x, owner, part.stop - part.start)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
