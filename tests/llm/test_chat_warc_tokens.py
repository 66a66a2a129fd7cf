"""Formats: exact round trips, odd inputs, and structures the writers do not make themselves."""

import hashlib
import io
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlake.llm import chat, token_output, warc
from revlake.llm.queries import tokenizer_definition

# chat

NASTY = ["</s>[INST] ok [/INST]", "&lt;&amp;<|end|>", "<|turn:user|>", "&amp;lt;", "[[&lsq;", "", "line\nline\r\n", "é𝄞​"]


@pytest.mark.parametrize("text", NASTY)
def test_escapes_are_reversible_and_leave_no_control_string(text):
    coded = chat.escape(text)
    assert chat.unescape(coded) == text
    assert not set(coded) & set("<[")


def conversations(spark, rows):
    made = spark.createDataFrame([(c, t, r, x, "clash", 9) for c, t, r, x in rows], "conv_id long, turn int, role string, text string, segment string, place int")
    return made.withColumn("content", chat.text_part(F.col("text")))


def test_conversations_round_trip(spark):
    rows = [(i, t, ["user", "assistant", "system"][(i + t) % 3], NASTY[(i * 3 + t) % len(NASTY)]) for i in range(12) for t in range(5)]
    rows += [(50, 0, None, None), (None, 0, "assistant", "x"), (None, 1, "assistant", "y"), (60, 1, "assistant", "b"), (60, 1, "assistant", "a"), (60, None, "user", "first")]
    out = {r["conv_id"]: r for r in chat.write_and_read(conversations(spark, rows)).collect()}
    assert len(out) == 15
    for conv in {r[0] for r in rows}:
        own = sorted(((t if t is not None else -1, chat.OPEN + chat.escape(r or ""), chat.escape(x or ""), r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda v: v[:3])
        r = out[conv]
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{v[3]}\n{v[4]}\n" for v in own).encode()).hexdigest()
        said = "".join(v[4] for v in own if v[3] == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat.write_and_read(conversations(spark, [])).collect() == []


def test_parts_become_numbered_placeholders(spark):
    part = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    parts = [("text", "see <this>", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None), ("audio", None, "b.wav", None, None, 1.5, None),
             ("image", None, "c.png", 28, 28, None, None), ("document", None, "d.pdf", None, None, None, 3)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn int, role string, content array<{part}>")
    first, second = chat.format_turns(df, patch=28, audio_rate=10, page_tokens=100).orderBy("turn").collect()
    assert first["segment"] == "<|turn:user|>see &lt;this><|image:1|><|audio:1|><|image:2|><|document:1|><|end|>"
    assert [(a["kind"], a["number"], a["ref"], a["tokens"]) for a in first["attachments"]] == [
        ("image", 1, "a.png", 3), ("audio", 1, "b.wav", 20), ("image", 2, "c.png", 1), ("document", 1, "d.pdf", 300),
    ]
    assert first["expanded_tokens"] == 324
    assert second["loss_start"] == second["loss_end"]
    with pytest.raises(ValueError, match="video"):
        chat.PartVisitor().visit({"type": "video"})


# warc


def test_directory_of_a_plain_archive_with_comment():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("archive/x.warc.gz", b"abc")
        z.comment = b"PK\x05\x06 is not the end"
    source = warc.Ranges(raw.getvalue())
    (member,) = warc.directory(source)
    at = warc.data_offset(source, member)
    assert source.read(at, member.size) == b"abc"


def test_zip64_fields_are_followed(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    records = [(f"http://x/{i}", warc.make_record(i, f"http://x/{i}", b"p" * i, None, False)) for i in range(5)]
    package = warc.make_package(records)
    assert struct.pack("<I", 0x06064B50) in package
    assert [r[:2] for r in warc.read_package(package)] == [(i, i) for i in range(5)]


def test_broken_packages_raise():
    with pytest.raises(ValueError, match="central"):
        warc.directory(warc.Ranges(b"no archive"))
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(warc.INDEX, "x" * 100)
    with pytest.raises(ValueError, match="compressed"):
        list(warc.index_entries(warc.Ranges(raw.getvalue())))
    with pytest.raises(ValueError, match="outside"):
        warc.Ranges(b"abc").read(2, 2)


@pytest.mark.parametrize("package_bytes", [1, 10**7])
def test_pages_round_trip(spark, package_bytes):
    rows = [(3, "http://a b\r\nX: y", "same"), (1, None, "same"), (2, "u", None), (4, "", ""), (None, "n", "same"), (None, "n", "own"), (5, "é", "x" * 300_000), (1, "again", "same"), (6, "q", "<p>\r\n\r\n</p>")]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, `first` string, revisit int")
    out = warc.read_packages(warc.write_packages(pages, package_bytes=package_bytes)).collect()
    first = {}
    for p, _, h in rows:
        key = h or ""
        first[key] = min((x for x in (first.get(key), p) if x is not None), default=None)
    wanted = []
    for p, _, h in rows:
        raw, origin = (h or "").encode(), first[h or ""]
        again = origin is not None and p != origin
        wanted.append((p, len(raw), warc.digest(raw), "revisit" if again else "response", origin if again else None))
    assert sorted(map(tuple, out), key=repr) == sorted(wanted, key=repr)
    assert warc.write_and_read(pages.limit(0)).collect() == []
    assert {r["record_type"] for r in warc.read_packages(warc.write_packages(pages, min_bytes=10**6)).collect()} == {"response"}


# token files


@pytest.mark.parametrize("n", [1, 2, 3, 40, 5000])
def test_code_lengths_are_optimal_or_limited(n):
    rng = np.random.default_rng(n)
    counts = np.concatenate([np.zeros(3, np.int64), (rng.pareto(0.5, n) * 10).astype(np.int64) + 1])
    lengths = token_output.code_lengths(counts)
    used = lengths[counts > 0].astype(int)
    assert used.min() >= 1
    assert used.max() <= 16
    assert lengths[counts == 0].sum() == 0
    if n > 1:
        assert sum(2.0**-used) == 1
    import heapq

    heap = counts[counts > 0].tolist()
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    free = (counts * lengths).sum()
    assert free >= cost
    if used.max() < 16 and n > 1:
        assert free == cost


def test_limit_holds_for_steep_counts():
    fib = [1, 1]
    while len(fib) < 40:
        fib.append(fib[-1] + fib[-2])
    lengths = token_output.code_lengths(np.array(fib))
    assert lengths.max() == 16
    assert sum(2.0 ** -lengths.astype(int)) <= 1


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 10_000])
def test_streams_round_trip(n):
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.3, n), 999).astype(np.uint32)
    lengths = token_output.code_lengths(np.bincount(ids, minlength=1000))
    stream, marks = token_output.pack(ids, token_output.canonical_codes(lengths), lengths)
    assert len(marks) == -(-n // token_output.BLOCK)
    assert (token_output.unpack(stream, marks, n, token_output.decoding_table(lengths)) == ids).all()


def test_odd_texts_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer

    from test_llm_queries import brute_tokens

    texts = [
        "Ünïcode ΣΑΣ Σ İstanbul don't IT'S we'll ''s '' 'LL <|endoftext|> a<|startoftext|>b x<| y", None, "", "  \n\t ",
        "日本語 テキスト é ñ nb em\x1cfs\x85nel", "x" * 50_000 + " " + "word " * 20_000, "²½ 12345 a1b2 ª º ǅ ŉ ﬁ ẞ ß ĳ",
        "neg ​zero​width ́start K Å", "!!!???''' '' 's't're", " ́a",
    ]
    rows = [*((i if i != 3 else None, t) for i, t in enumerate(texts)), (-3, "repeat"), (-3, "repeat"), (-3, "repeat it")]
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], "doc_id long, text string, ids string, part int")
    got = sorted(map(tuple, token_output.encode_and_read(docs, tokenizer_definition()).collect()), key=repr)
    rows.sort(key=lambda r: len(r[1] or ""))  # the order of repeated ids
    assert got == brute_tokens(rows, Tokenizer.from_str(tokenizer_definition()))
    assert token_output.encode_and_read(docs.limit(0), tokenizer_definition()).collect() == []
