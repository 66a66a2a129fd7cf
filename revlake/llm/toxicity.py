"""Toxicity by a subsequence string kernel.

Two words are compared by the triples of letters they share in order, each triple weighted down by
the letters it spans, so gaps and inserted letters cost a little and do not break a match. Landmark
words picked from labelled documents give Nystrom features: a sentence is its best match with each
landmark, mapped by the inverse square root of the landmarks' own kernel. A linear support vector
machine on sentences gives the margin; a document's score is that of its worst sentence.

Words are white-space runs without their marks, so ``i.d.i-o.t`` reads as one word, and neighbouring
single letters are joined, so ``i d i o t`` does too. Case does not count. The beginning of a word is
a letter of its own.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DECAY, SPAN, POWER = 0.7, 6, 3
LANDMARKS = 48
#: Most labelled documents of either kind that a model is fitted on; the smallest hashes of ids are taken.
TRAIN_DOCS = 1500
#: Words with more letters are read as overlapping windows of this length.
WINDOW = 64
SLICE_BYTES, SLICE_CHARS = 3_000_000, 500_000

#: 0 pads; a to z, digits, any other letter, the beginning of a word, Latin letters with accents.
_OTHER, _BEGIN, _ACCENTS, _SYMBOLS = 37, 38, 39, 71
_MARK, _SPACE, _DROP = 253, 254, 255


def _symbol(c: int) -> int:
    char = chr(c)
    if char.isspace():
        return _SPACE
    low = char.lower()
    if len(low) == 1 and 0xDF <= ord(low) <= 0xFF and low.isalpha():
        return min(_ACCENTS + ord(low) - 0xE0 if ord(low) > 0xDF else _SYMBOLS - 1, _SYMBOLS - 1)
    base = unicodedata.normalize("NFKD", char)[0].lower()
    if "a" <= base <= "z":
        return ord(base) - 96
    if "0" <= base <= "9":
        return ord(base) - 21
    if unicodedata.category(char) in ("Cf", "Mn"):
        return _DROP
    return _OTHER if char.isalpha() else _MARK


_TABLE = np.array([_symbol(c) if not 0xD800 <= c < 0xE000 else _MARK for c in range(0x3100)], np.uint8)
_POSITION = np.random.default_rng(11).integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)
_TRIPLES = [(j, k) for j in range(1, SPAN) for k in range(j + 1, SPAN)]
_WEIGHTS = np.array([DECAY ** (k + 1) for _, k in _TRIPLES], np.float32)


def norms(lengths: np.ndarray) -> np.ndarray:
    """Norm of a word of so many letters whose triples all differ."""
    starts = np.maximum(0, lengths[:, None] - np.array([k for _, k in _TRIPLES]))
    return np.sqrt(np.maximum(1e-9, (starts * _WEIGHTS**2).sum(1)))


@dataclass(frozen=True)
class Words:
    """Letters of all words in a row, the words' bounds, and the sentence and text of each word."""

    letters: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    sentence: np.ndarray
    text: np.ndarray


def split_words(texts: list[str]) -> Words:
    """Words of ``texts``. Sentences end at . ! ? before white space, and at line ends."""
    joined = "\n".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    symbols = np.where(points < len(_TABLE), _TABLE[np.minimum(points, len(_TABLE) - 1)], _OTHER).astype(np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text_of = np.repeat(np.arange(len(texts)), sizes + 1)[: len(points)]
    space = symbols == _SPACE
    stop = np.isin(points, (33, 46, 63)) & np.append(space[1:], True) | (points == 10)
    sentence_of = np.cumsum(stop) - stop
    kept = (symbols < _MARK) & (symbols > 0)
    run = np.cumsum(space)[kept]
    letters, text_of, sentence_of = symbols[kept], text_of[kept], sentence_of[kept]
    if not len(letters):
        none = np.zeros(0, np.int64)
        return Words(letters, none, none, none, none)
    begins = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    lengths = np.diff(np.append(begins, len(letters)))
    # Neighbouring single letters of a text make one word.
    single = lengths == 1
    same = np.append(False, (text_of[begins][1:] == text_of[begins][:-1]) & (run[begins][1:] == run[begins][:-1] + 1))
    begins = begins[~(single & np.append(False, single[:-1]) & same)]
    letters = np.insert(letters, begins, _BEGIN)
    owners = text_of[begins], sentence_of[begins]
    begins = begins + np.arange(len(begins))
    lengths = np.diff(np.append(begins, len(letters)))
    if lengths.max() > WINDOW:
        # One more window for each WINDOW - SPAN letters beyond the first window.
        step = WINDOW - SPAN
        counts = np.maximum(1, 1 + -(-(lengths - WINDOW) // step))
        offset = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * step
        begins, whole = np.repeat(begins, counts) + offset, np.repeat(lengths, counts)
        lengths = np.minimum(WINDOW, whole - offset)
        owners = np.repeat(owners[0], counts), np.repeat(owners[1], counts)
    return Words(letters, begins, lengths, owners[1], owners[0])


def distinct_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Index of one word of each spelling, and for every word the number of its spelling."""
    total = np.cumsum(words.lengths)
    place = np.arange(total[-1] if len(total) else 0) - np.repeat(total - words.lengths, words.lengths)
    at = place + np.repeat(words.starts, words.lengths)
    mixed = (words.letters[at].astype(np.uint64) + np.uint64(1)) * _POSITION[place]
    mixed ^= mixed >> np.uint64(31)
    hashes = np.add.reduceat(mixed * np.uint64(0x9E3779B97F4A7C15), total - words.lengths) if len(total) else np.zeros(0, np.uint64)
    _, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return index, inverse


def triple_codes(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all triples of each row of padded words (0: not whole), and the triples' weights."""
    wide, n = letters.astype(np.int32), letters.shape[1]
    codes, weights = [], []
    for number, (j, k) in enumerate(_TRIPLES):
        if k < n:
            a, b, c = wide[:, : n - k], wide[:, j : n - k + j], wide[:, k:]
            codes.append(np.where(c > 0, (a * _SYMBOLS + b) * _SYMBOLS + c, 0))
            weights.append(np.full(n - k, number))
    if not codes:
        return np.zeros((len(letters), 1), np.int32), np.zeros(1, np.int32)
    return np.hstack(codes), np.concatenate(weights)


def self_norms(codes: np.ndarray, kinds: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Norms of words: by length, and by their own triples where some of these repeat."""
    out = norms(lengths)
    order = np.sort(codes, axis=1)
    repeats = np.flatnonzero(((order[:, 1:] == order[:, :-1]) & (order[:, 1:] > 0)).any(1))
    if len(repeats):
        rows = codes[repeats].astype(np.int64) + np.arange(len(repeats))[:, None] * _SYMBOLS**3
        filled = codes[repeats].ravel() > 0
        keys, inverse = np.unique(rows.ravel()[filled], return_inverse=True)
        weight = np.bincount(inverse, np.broadcast_to(_WEIGHTS[kinds], rows.shape).ravel()[filled])
        out[repeats] = np.sqrt(np.bincount(keys // _SYMBOLS**3, weight**2, len(repeats)))
    return out


class Landmarks:
    """Kernel values of words with fixed landmark words."""

    def __init__(self, names: list[str]):
        self.names, self.size = names, len(names)
        words = split_words(names)
        self.row = np.zeros(_SYMBOLS**3, np.int32)
        triples: dict[int, np.ndarray] = {}
        for i in range(self.size):
            first = int(np.flatnonzero(words.text == i)[0])
            start, length = words.starts[first], words.lengths[first : first + 1]
            codes, kinds = triple_codes(words.letters[None, start : start + length[0]])
            norm = self_norms(codes, kinds, length)[0]
            for code, kind in zip(codes[0].tolist(), kinds.tolist(), strict=True):
                if code:
                    triples.setdefault(code, np.zeros(self.size, np.float32))[i] += _WEIGHTS[kind] / norm
        self.table = np.stack([np.zeros(self.size, np.float32), *triples.values()])
        self.row[list(triples)] = np.arange(1, len(triples) + 1)

    def kernel(self, words: Words, index: np.ndarray) -> np.ndarray:
        """Matrix of words (those of ``index``) by landmarks."""
        out = np.zeros((len(index), self.size), np.float32)
        lengths = words.lengths[index]
        for low, high in ((3, 6), (7, 8), (9, 10), (11, 13), (14, 18), (19, 32), (33, WINDOW)):
            rows = np.flatnonzero((lengths >= low) & (lengths <= high))
            for i in range(0, len(rows), 8_000):
                part = rows[i : i + 8_000]
                place = np.arange(high)
                at = np.minimum(words.starts[index[part]][:, None] + place, len(words.letters) - 1)
                codes, kinds = triple_codes(np.where(place < lengths[part][:, None], words.letters[at], 0))
                known = self.row[codes]
                hit = np.flatnonzero(known.ravel())
                if not len(hit):
                    continue
                word, column = np.divmod(hit, codes.shape[1])
                values = self.table[known.ravel()[hit]] * _WEIGHTS[kinds[column]][:, None]
                first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                met = word[first]
                norm = self_norms(codes[met], kinds, lengths[part[met]])
                out[part[met]] = (np.add.reduceat(values, first, axis=0) / norm[:, None]) ** POWER
        return out


@dataclass(frozen=True)
class ToxicityModel:
    landmarks: list[str]
    beta: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, texts: list[str], marks: Landmarks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Margin, sentence number and text of every sentence that has words."""
        pooled, sentence, owner = sentence_features(texts, marks)
        return pooled @ self.beta + self.bias, sentence, owner

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def sentence_features(texts: list[str], marks: Landmarks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best match with each landmark, for every sentence; its number; its text."""
    words = split_words(texts)
    if not len(words.starts):
        return np.zeros((0, marks.size), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    index, inverse = distinct_words(words)
    values = marks.kernel(words, index)
    first = np.flatnonzero(np.append(True, (words.sentence[1:] != words.sentence[:-1]) | (words.text[1:] != words.text[:-1])))
    pooled = np.empty((len(first), marks.size), np.float32)
    bounds = np.append(first, len(words.starts))
    at = 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + 100_000, "right")) - 1)
        pooled[at:to] = np.maximum.reduceat(values[inverse[bounds[at] : bounds[to]]], first[at:to] - bounds[at])
        at = to
    return pooled, words.sentence[first], words.text[first]


def features_in_slices(texts: list[str], marks: Landmarks) -> tuple[np.ndarray, np.ndarray]:
    """Features and texts of all sentences, a slice of texts at a time to bound memory."""
    bounds, size = [0], 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE_CHARS:
            bounds.append(i + 1)
            size = 0
    parts = [(lo, *sentence_features(texts[lo:hi], marks)) for lo, hi in zip(bounds, [*bounds[1:], len(texts)], strict=True) if hi > lo]
    return np.concatenate([p[1] for p in parts]), np.concatenate([p[3] + p[0] for p in parts])


def choose_landmarks(texts: list[str], y: np.ndarray, n: int = LANDMARKS) -> tuple[list[str], np.ndarray]:
    """Words and beginnings of words that most set toxic documents apart, unlike each other; how much each does."""
    def parts(text: str) -> set[str]:
        seen = {"".join(c for c in w if c.isalnum()) for w in text.lower().split()}
        return {p for w in seen if len(w) > 3 for p in (w[:32], w[:4], w[:5])}

    toxic, clean = Counter(), Counter()
    for text in (t for t, label in zip(texts, y, strict=True) if label):
        toxic.update(parts(text))
    toxic = Counter({w: n for w, n in toxic.items() if n > 2})
    for text in (t for t, label in zip(texts, y, strict=True) if not label):
        clean.update(p for p in parts(text) if p in toxic)
    total = np.array([max(1, (y == 1).sum()), max(1, (y == 0).sum())])
    gain = lambda w: toxic[w] / total[0] - 3 * clean[w] / total[1]
    ranked = sorted(toxic, key=lambda w: (-gain(w), -len(w), w))[: 12 * n]
    chosen: list[str] = []
    for word in ranked:
        if len(chosen) == n:
            break
        words = split_words([word])
        if len(words.starts) != 1 or words.lengths[0] < 3:
            continue
        if not chosen or Landmarks(chosen).kernel(words, np.array([0])).max() < 0.4**POWER:
            chosen.append(word)
    chosen = chosen or ["none"]
    return chosen, np.array([gain(w) for w in chosen])


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 1.0) -> tuple[np.ndarray, float]:
    """Primal Newton steps for squared hinge loss; the last column is the bias, which is not penalised."""
    x, sign = np.column_stack([z, np.ones(len(z))]).astype(np.float64), 2.0 * y - 1
    w, ridge = np.zeros(x.shape[1]), np.append(np.ones(z.shape[1]), 1e-6)
    for _ in range(30):
        inside = sign * (x @ w) < 1
        a = x[inside] * weight[inside, None]
        new = np.linalg.solve(np.diag(ridge) + cost * a.T @ x[inside], cost * a.T @ sign[inside])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], float(w[-1])


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    pos, neg = y.sum(), len(y) - y.sum()
    goal = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - goal) * margin).sum(), (p - goal).sum()])
        v = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(v * margin**2).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5 / (np.abs(step).max() + 1e-9))
        a, b = a - step[0], b - step[1]
    return float(max(a, 1e-3)), float(b)


def fit(texts: list[str], y: np.ndarray, n_landmarks: int = LANDMARKS) -> ToxicityModel:
    """Multiple-instance fit: the worst sentence of a toxic document is toxic, no sentence of a clean one is.

    The first choice is by matches with landmarks, weighted by how much these set toxic documents
    apart; three rounds choose again by the margin. A toxic document's other sentences count as toxic
    where the choice is clear, and the worst sentence of every clean document is an example.
    """
    names, gain = choose_landmarks(texts, y, n_landmarks)
    marks = Landmarks(names)
    pooled, owner = features_in_slices(texts, marks)
    own = marks.kernel(split_words(marks.names), np.arange(marks.size)).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    z = pooled @ root
    score = (pooled * np.clip(gain, 0, 1)).max(1)
    clear = pooled[:, gain > 0.02].max(1, initial=0) > 0.5
    w, b = np.zeros(root.shape[1]), 0.0
    for _ in range(4):
        order = np.lexsort((-score, owner))
        worst = order[np.append(True, owner[order][1:] != owner[order][:-1])]
        spread = np.flatnonzero((y[owner] == 0) & (np.arange(len(owner)) % 5 == 0))
        rows = np.unique(np.concatenate([worst, spread, np.flatnonzero(clear & (y[owner] == 1))]))
        label = y[owner[rows]].astype(float)
        share = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum())) * len(rows)
        w, b = _svm(z[rows], label, share)
        score = z @ w + b
        clear = score > 0
    top = np.full(len(texts), b)
    np.maximum.at(top, owner, score)
    slope, shift = _platt(top, y.astype(float))
    return ToxicityModel(marks.names, (root @ w).astype(np.float32), b, slope, shift)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_docs: int = TRAIN_DOCS) -> ToxicityModel | None:
    """Fit on at most ``max_docs`` labelled documents of either kind, those with the smallest hashes of ids.

    The driver gets the texts of these documents. Without labels of both kinds there is no model.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    pick = lambda y: known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    # At most twice max_docs rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(pick(0).unionByName(pick(1))), "doc_id").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"] or ""))
    y = np.array([r["y"] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return None
    return fit([r["text"] or "" for r in rows], y)


def scores_of(column: pa.Array, model: ToxicityModel | None, marks: Landmarks | None) -> np.ndarray:
    """Scores of texts; without a model 0."""
    texts = pc.fill_null(column, "")
    out = np.zeros(len(texts))
    if model:
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right")))
            margin, _, owner = model.margins(texts.slice(at, to - at).to_pylist(), marks)
            top = np.full(to - at, model.bias)
            np.maximum.at(top, owner, margin)
            out[at:to] = model.probability(top)
            at = to
    return out


def score(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``doc_id, score`` of every row of ``docs`` (``doc_id, text``; more is not read), whole texts.

    Texts without words, null ones too, score as a sentence without any match. Without a model every
    score is 0. Only the text enters the score.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Landmarks(model.landmarks) if model else None
        for batch in batches:
            found = scores_of(batch.column("text"), model, marks)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def reject(docs: DataFrame, model: ToxicityModel | None, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose texts score below ``threshold``. Only the texts go through Python."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        marks = Landmarks(model.landmarks) if model else None
        for texts in batches:
            yield pa.array(scores_of(texts, model, marks), pa.float64())

    return docs.where(scored("text") < threshold)
