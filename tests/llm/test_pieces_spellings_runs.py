"""Pieces against the sentencepiece library, spelling variants and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from revlake.llm import runs, sentence_pieces, spellings
from revlake.llm.queries import QUERIES, piece_model, table, with_repeats

SCHEMA = "doc_id long, text string, ids string, word string, n string, block int"
ODD = [
    (1, None), (2, ""), (3, " "), (4, "  two  blanks "), (5, "same"), (5, "same"), (None, "no id"), (7, "日本語 テキスト 😀\n\t\x00"),
    (8, "</s><s><unk> <0x41> ▁under▁score"), (9, "a" * 5000), (10, "x " * 20000), (11, "é́�"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "ids", "w", "n", 1) for i, t in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Sentence pieces


@pytest.fixture(scope="module")
def model():
    return piece_model()


def variant(model, **rules):
    """The model with other normaliser or trainer settings."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    for name, value in rules.items():
        part = proto.normalizer_spec if hasattr(proto.normalizer_spec, name) else proto.trainer_spec
        setattr(part, name, value)
    return proto


TEXTS = st.lists(st.sampled_from(["a", "the ", " ", "  ", "▁", "é", "日", "\n", "1", "20", ".", "ing", "</s>", "<0x41>", "\x00", "😀", "zzzz"]), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXTS | st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ids_equal_the_library(text):
    library = SentencePieceProcessor(model_proto=piece_model())
    known = sentence_pieces.vocabulary(piece_model())
    ids = known.encode(text)
    assert ids == library.encode(text, add_eos=True)
    assert known.decode(ids) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31999) | st.integers(0, 300), max_size=20))
def test_any_ids_decode_as_in_the_library(ids):
    assert sentence_pieces.vocabulary(piece_model()).decode(ids) == SentencePieceProcessor(model_proto=piece_model()).decode(ids)


@pytest.mark.parametrize("rules", [{"add_dummy_prefix": False}, {"remove_extra_whitespaces": True}, {"byte_fallback": False}])
def test_other_rules_equal_the_library(model, rules):
    proto = variant(model, **rules)
    if rules.get("byte_fallback") is False:
        for p in proto.pieces:
            p.type = sentence_pieces.CONTROL if p.type == sentence_pieces.BYTE else p.type
    changed = proto.SerializeToString()
    library, known = SentencePieceProcessor(model_proto=changed), sentence_pieces.Vocabulary(changed)
    for text in [t for _, t in ODD if t is not None] + ["  日 本 x", "x\x01\x02y \x01"]:
        assert known.encode(text) == library.encode(text, add_eos=True), text
        assert known.decode(known.encode(text)) == library.decode(library.encode(text)), text


def test_unsupported_models_are_refused(model):
    for rules in ({"model_type": 1}, {"precompiled_charsmap": b"x"}, {"treat_whitespace_as_suffix": True}):
        with pytest.raises(ValueError):
            sentence_pieces.Vocabulary(variant(model, **rules).SerializeToString())


def test_a_vocabulary_with_pieces_across_blanks_is_not_cut_there(model):
    proto = variant(model)
    for piece in proto.pieces:
        if piece.piece == "▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁":
            piece.piece = "e▁"
    changed = proto.SerializeToString()
    library, known = SentencePieceProcessor(model_proto=changed), sentence_pieces.Vocabulary(changed)
    assert not known.cuts
    for text in ["the one there", "e e e", "be the same  e"]:
        assert known.encode(text) == library.encode(text, add_eos=True)


def test_round_trip_of_odd_rows(spark, model):
    library = SentencePieceProcessor(model_proto=model)
    docs = frame(spark, ODD)
    got = sorted(((r["doc_id"], r["ids"], r["decoded"], r["same_as_library"]) for r in sentence_pieces.round_trip(docs, model).collect()), key=repr)
    wanted = [(i, ids := library.encode(t or "", add_eos=True), library.decode(ids), True) for i, t in ODD]
    assert got == sorted(wanted, key=repr)
    encoded = sentence_pieces.encode(docs, model)
    assert sorted((tuple(r) for r in encoded.collect()), key=repr) == sorted(((i, ids) for i, ids, *_ in wanted), key=repr)
    texts = sentence_pieces.decode(encoded, model)
    assert sorted((tuple(r) for r in texts.collect()), key=repr) == sorted(((i, t) for i, _, t, _ in wanted), key=repr)
    nothing = spark.createDataFrame([(1, None), (2, []), (3, [None, 264])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in sentence_pieces.decode(nothing, model).collect()} == {1: "", 2: "", 3: library.decode([264])}
    assert sentence_pieces.round_trip(frame(spark, []), model).collect() == []


def test_registered_pieces_equal_the_library(spark, sf, model):
    library = SentencePieceProcessor(model_proto=model)
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_sentence_pieces"](spark, sf).collect()}
    for r in table(spark, sf, "documents").collect():
        ids = library.encode(r["text"] or "", add_eos=True)
        assert got.pop(r["doc_id"]) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)), True)
    assert not got


# Spelling variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[w] = (form, n, len(near), counts.get(form))
    rows = set()
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.add((w, form, root, n, near, form_n))
    return rows


@pytest.mark.parametrize("tile", [2, 512])
def test_variants_equal_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(spellings, "TILE", tile)
    rng = random.Random(7)
    counts = {"".join(rng.choice("abé÷ÿÀ") for _ in range(rng.randrange(5, 8))): rng.choice([3, 3, 5, 12, 40, 90]) for _ in range(400)}
    counts |= {"a" * 3000: 3, "a" * 3001: 8, "a" * 1500 + "b" + "a" * 1500: 20}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {tuple(r) for r in spellings.variants(words).collect()} == brute_variants(counts)


def test_variants_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "Hello HELLO hello helloo helloo helloo"), (3, "Hello × hello"), (None, "jello jello jello jello!jello"), (4, "hell hell hell")]
    found = spellings.letter_runs(frame(spark, rows)).select(F.col("run").alias("word"))
    got = {tuple(r) for r in spellings.variants(spellings.counted_words(found)).collect()}
    assert got == {("hello", None, "hello", 5, 2, None), ("helloo", None, "helloo", 3, 1, None), ("jello", None, "jello", 5, 1, None)}
    assert spellings.variants(spellings.counted_words(found.where("false"))).collect() == []


# Periodic runs


def brute_runs(words):
    found = {}
    for p in range(1, len(words) // 3 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(24, 3 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((a, b, p) for (a, b), p in found.items()), key=lambda r: (r[0], r[2]))


def nested(rng):
    """Words with runs inside runs, of small and large periods, in noise of few and of many words."""
    out, size = [], rng.choice([0, 5, 30, 300, 900])
    while len(out) < size:
        kind = rng.random()
        if kind < 0.4:
            out += [str(rng.randrange(2 if kind < 0.2 else 500)) for _ in range(rng.randrange(60))]
            continue
        unit = [str(rng.randrange(rng.choice([1, 2, 3, 50]))) for _ in range(rng.randrange(1, 120))]
        if kind < 0.7:
            at = rng.randrange(len(unit))
            unit[at:at] = unit[at : at + rng.randrange(1, 9)] * rng.randrange(1, 15)
        out += (unit * 7)[: rng.randrange(len(unit) * 6 + 1)]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_every_period(seed):
    rng = random.Random(seed)
    for _ in range(12):
        texts = [nested(rng) for _ in range(rng.randrange(1, 9))]
        wanted = [brute_runs(t) for t in texts]
        for combine in (runs._hashed, runs._named, lambda a, b: runs._hashed(a, b) % np.uint64(40)):  # the last clashes all the time
            assert [[tuple(r) for r in found.tolist()] for found in runs.word_runs(texts, combine)] == wanted


def test_long_runs_take_no_long_loops():
    texts = [["w"] * 300_000, [str(i % 7919) for i in range(100_000)]]
    found = runs.word_runs(texts)
    assert [f.tolist() for f in found] == [[[0, 300_000, 1]], [[0, 100_000, 7919]]]


def brute_row(words):
    found = brute_runs(words)
    best = min(found, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    dropped = {i for a, b, p in found for i in range(a + p, b)}
    lines = "".join(f"{a},{b - a},{p}\n" for a, b, p in found)
    head = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (len(found), *head, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_runs_of_odd_rows(spark):
    rng = random.Random(5)
    rows = [*ODD, *((100 + i, " ".join(nested(rng))) for i in range(12)), (200, "a b " * 12), (201, "a b " * 11 + "a"), (202, "tie " * 30 + "x " + "eit " * 30)]
    got = sorted((tuple(r) for r in runs.digests(runs.find_runs(frame(spark, rows))).collect()), key=repr)
    assert got == sorted(((i, *brute_row(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t in rows), key=repr)
    assert runs.digests(runs.find_runs(frame(spark, []))).collect() == []


def repeated(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_registered_runs_equal_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    small = [(i, t) for i, t in rows if t is None or len(t) < 15_000]
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    assert set(got) == {i for i, _ in rows}
    for i, t in small:
        assert got[i] == brute_row(repeated(i, t)), i


def test_repeats_are_planted_in_every_tenth(spark):
    rows = [(i, f"w{i} a b c\td e  f" if i % 3 else None) for i in range(60)]
    got = {r["doc_id"]: r["text"] for r in with_repeats(frame(spark, rows)).collect()}
    assert {i: re.findall(r"\S+", t or "") for i, t in got.items()} == {i: repeated(i, t) for i, t in rows}
    assert Counter(t is None for t in got.values())[True] == 20
