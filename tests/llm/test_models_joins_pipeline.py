"""Joins against brute force, models on planted cases, and the pipeline stage by stage."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm_queries import brute_components, brute_tokens

import corpus_pipeline
from revlake.llm import decontaminate, jaccard_join, mixing, quality, shingles, toxicity
from revlake.llm.queries import tokenizer_definition

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, cid string, `_key` int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", f"s{(d or 0) % 3}", 1, "clash", 2, "clash") for d, t in rows], SCHEMA)


def near_copies(n=60, seed=3):
    """Texts with shared lines, chains of small edits, copies, and odd rows."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choices(words, k=12))
    rows, base = [], rng.choices(words, k=60)
    for i in range(n):
        kind = i % 4
        if kind == 0:
            base = [*base]
            base[rng.randrange(len(base))] = rng.choice(words)
            text = " ".join(base)
        elif kind == 1:
            text = line + "\n" + " ".join(rng.choices(words, k=rng.randrange(1, 30)))
        elif kind == 2:
            text = rows[rng.randrange(len(rows))][1] if rows else "x"
        else:
            text = " ".join(rng.choices(words[:5], k=rng.randrange(0, 5)))
        rows.append((rng.randrange(1000), text))
    return [*rows, (None, rows[0][1]), (None, None), (2000, None), (2001, " \t"), (2002, "One  TWO"), (2003, "one two"), (5, "same"), (5, "same")]


@pytest.mark.parametrize(("percent", "width", "long", "longer"), [(90, 3, 2, 2), (80, 5, 64, 4096), (60, 1, 1, 1), (60, 1, 1, 9)])
def test_links_equal_all_pairs(spark, percent, width, long, longer):
    rows = near_copies()
    seen = set()
    rows = [r for r in rows if r[0] is None or r == (5, "same") or not (r[0] in seen or seen.add(r[0]))]
    out = jaccard_join.link_components(frame(spark, rows), percent, width, long, longer)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()), key=repr)
    assert got == brute_components(rows, percent, width)


def test_one_row_of_each_component_stays(spark):
    rows = [(d if d is None or d >= 2000 else 10 * i, t) for i, (d, t) in enumerate(near_copies())]
    docs = frame(spark, rows)
    kept = jaccard_join.one_of_each(docs, 80, 2)
    assert kept.columns == docs.columns
    left = kept.collect()
    again = jaccard_join.link_components(spark.createDataFrame(left, docs.schema), 80, 2).where("n_shingles > 0")
    assert again.select("component_id").distinct().count() == again.count()
    assert {r["doc_id"] for r in left} >= {2000, 2001}
    assert jaccard_join.one_of_each(docs.limit(0)).collect() == []


def test_bitmaps_lose_no_link_and_drop_what_is_far(spark):
    rng = np.random.default_rng(8)
    sets = []
    for n in (1, 3, 31, 33, 60, 100, 129, 500, 2000):
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        sets.append(np.unique(base))
        for changed in (1, n // 20, n // 10, n // 4, n // 2, n):
            other = base.copy()
            other[:changed] = rng.integers(0, 2**63, changed, dtype=np.uint64)
            sets.append(np.unique(other[: rng.integers(max(1, 9 * n // 10), n + 1)]))
    bounds = np.append(0, np.cumsum([len(s) for s in sets]))
    words = jaccard_join.bitmaps(np.concatenate(sets), bounds).to_pylist()
    bits = spark.createDataFrame([(i, len(s), w) for i, (s, w) in enumerate(zip(sets, words, strict=True))], "cid long, n long, bits array<long>")
    every = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))]
    for percent in (30, 80, 90):
        left = {tuple(r) for r in jaccard_join.possible(spark.createDataFrame(every, "a long, b long"), bits, percent).collect()}
        common = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a, b in every}
        linked = {(a, b) for (a, b), k in common.items() if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k)}
        assert linked <= left
        even = [(a, b) for a, b in every if max(len(sets[a]), len(sets[b])) <= 2 * min(len(sets[a]), len(sets[b]))]
        strange = [p for p in even if 2 * common[p] < min(percent / 100, 0.8) * len(sets[p[0]]) and len(sets[p[0]]) > 50]
        assert len(strange) > 20
        assert percent < 80 or not left & set(strange)


def test_near_copies_do_not_make_the_square_of_their_number_of_pairs(spark, monkeypatch):
    # Copies of one text of 150 words that differ in two words each link with some of the others, hardly with the hub.
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(150), 3):
            words[at] = f"x{rng.randrange(30)}"
        texts.append(words)
    rows, made, pairs_of = [(i, " ".join(w)) for i, w in enumerate(texts)], [], jaccard_join._pairs

    def counted(lists, keys, places, percent, *carried):
        out = pairs_of(lists, keys, places, percent, *carried)
        made.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "_pairs", counted)
    out = jaccard_join.link_components(frame(spark, rows))
    sets = [{tuple(w[k : k + 3]) for k in range(148)} for w in texts]
    parent = list(range(400))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(400):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {i: root(i) for i in range(400)}
    assert sum(made) < 10_000, made


def test_lists_of_many_pairs_are_not_multiplied_by_other_orders(spark, monkeypatch):
    # Texts that share most of a base, but too little to link: every two meet under all orders.
    rng = random.Random(4)
    base, rows, made, keep = [f"w{i}" for i in range(600)], [], [], jaccard_join.stored
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(600), 50):
            words[at] = f"x{i}-{at}"
        rows.append((i, " ".join(words)))

    def counted(df, label, *partition_by):
        out = keep(df, label, *partition_by)
        if label == "jaccard-lists":
            made.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "stored", counted)
    out = jaccard_join.link_components(frame(spark, rows), 80, 1, 8)
    assert all(r["doc_id"] == r["component_id"] for r in out.collect())
    assert 1000 < sum(made) < 8000, made


def test_a_common_shingle_does_not_make_pairs_within_a_component(spark):
    base = [f"a{i}" for i in range(80)]
    rows = [(i, " ".join([*base[:i], f"edit{i}", *base[i + 1 :]])) for i in range(60)]
    out = jaccard_join.link_components(frame(spark, rows), 80, 1, 4)
    assert {r["component_id"] for r in out.collect()} == {0}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 299)]
    out = dict(map(tuple, jaccard_join.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert all(out[i] == 0 for i in range(21))
    assert all(out[100 + i] == 100 for i in range(30))
    assert out[300] == 299
    assert jaccard_join.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_shingle_hashes_follow_words():
    texts = pa.array(["A b c D", "a B  c\td", "a b", "a  b", None, "", " ", "a", "ab", "b a", "é " * 3, "x" * 9000])
    tokens, bounds = shingles.shingle_sets(texts, 3)
    sets = [frozenset(tokens[bounds[i] : bounds[i + 1]].tolist()) for i in range(len(texts))]
    assert [len(s) for s in sets] == [2, 2, 1, 1, 0, 0, 0, 1, 1, 1, 1, 1]
    assert sets[0] == sets[1]
    assert sets[2] == sets[3]
    assert len(set(sets)) == 8
    sliced, edges = shingles.shingle_sets(texts.slice(1, 3), 3)
    assert frozenset(sliced[edges[0] : edges[1]].tolist()) == sets[1]


def levenshtein_within(pattern, text):
    """Least distance of ``pattern`` to any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        diagonal, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (p != t))
    return min(row)


def test_bit_parallel_distance_equals_dynamic_programming():
    rng = random.Random(2)
    for _ in range(300):
        pattern = "".join(rng.choices("abc ", k=rng.randrange(1, 90)))
        text = "".join(rng.choices("abcd ", k=rng.randrange(0, 120)))
        distance, end = decontaminate.least_distance(pattern, text)
        assert distance == levenshtein_within(pattern, text)
        assert distance == levenshtein_within(pattern[::-1], text[:end][::-1])


def passages(spark):
    rng = random.Random(4)
    syllables = ["an", "the", "ing", "er", "tion", "ou", "st", "ha", "re", "ly", "ed", "nd"]
    text = lambda n: " ".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(n))
    items = [(i, text(rng.randrange(15, 60)).capitalize() + ".") for i in range(25)]
    rows = [(100 + i, text(200)) for i in range(60)]
    for i, item in items:
        host, cut = text(150).split(" "), rng.randrange(150)
        changed = "".join(c if rng.random() > 0.04 else rng.choice("xyz") for c in item)
        rows.append((1000 + i, " ".join([*host[:cut], item.upper() if i % 2 else item.replace(" ", "\n "), *host[cut:]])))
        rows.append((2000 + i, " ".join([*host[:cut], changed, *host[cut:]])))
    rows += [(None, items[0][1]), (1, None), (2, ""), (3, "a"), (4, items[1][1][: len(items[1][1]) // 2])]
    benchmark = spark.createDataFrame([*items, (90, None), (91, " \n"), (92, items[0][1])], "item_id long, text string")
    return frame(spark, rows), benchmark, items


def test_planted_passages_are_found(spark):
    docs, benchmark, items = passages(spark)
    out = decontaminate.matches(docs, benchmark).collect()
    got = {(r["doc_id"], r["item_id"]): r for r in out}
    for i, _ in items:
        assert got[1000 + i, i]["distance"] == 0
    assert sum((2000 + i, i) in got for i, _ in items) >= 24
    assert {(None, 0), (None, 92), (1000, 92)} <= set(got)
    assert all(r["doc_id"] is None or r["doc_id"] >= 1000 for r in out)
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {1, 2, 3, 4, *range(100, 160)} <= ids
    assert not ids & {None, *range(1000, 1025)}
    assert decontaminate.matches(docs.limit(0), benchmark).collect() == []
    assert decontaminate.matches(docs, benchmark.limit(0)).collect() == []


@pytest.mark.parametrize("share", [0.1, 0.15, 0.2])
def test_changed_items_are_found_up_to_the_limit(share):
    rng = random.Random(8)
    syllables = ["an", "the", "ing", "er", "tion", "ou", "st", "ha", "ré", "ly", "ed", "nd"]
    text = lambda n: " ".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(n // 4))[:n].strip()
    for size in (100, 250, 500, 1000):
        items = [(i, text(size)) for i in range(40)]
        docs = []
        for _, item in items:
            letters = list(item)
            for at in rng.sample(range(len(letters)), int(share * len(letters))):
                letters[at] = rng.choice(["x", "y", "", letters[at] + "q"])
            docs.append(f"{text(300)} {''.join(letters)} {text(300)}")
        near = [decontaminate.least_distance(decontaminate.normalise(i), decontaminate.normalise(d))[0] <= 0.2 * len(i) for (_, i), d in zip(items, docs, strict=True)]
        got = {row[:2] for row in decontaminate.best_matches(pa.array(docs), decontaminate.Items(items))}
        assert sum((i, i) in got for i in range(40)) >= 0.9 * sum(near) > 30, (size, share)


def test_items_in_blocks_find_the_same(spark, monkeypatch):
    docs, benchmark, _ = passages(spark)
    whole = sorted(map(tuple, decontaminate.matches(docs, benchmark).collect()), key=repr)
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 2000)
    assert sorted(map(tuple, decontaminate.matches(docs, benchmark).collect()), key=repr) == whole


def insult_model():
    rng = random.Random(5)
    words = ["the", "house", "was", "standing", "over", "river", "people", "walked", "along", "green", "quiet", "morning"]
    clean = [" ".join(rng.choices(words, k=40)) + "." for _ in range(150)]
    bad = ["idiot", "moron", "worthless", "pathetic"]
    toxic = []
    for i in range(80):
        own = rng.choices(words, k=40)
        own[rng.randrange(40)] = bad[i % 4]
        toxic.append(" ".join(own) + ".")
    return toxicity.fit(clean + toxic, np.array([0] * 150 + [1] * 80)), words


def test_insults_with_gaps_and_inserted_letters_are_caught(spark):
    model, words = insult_model()
    plain = " ".join(words * 4)
    rows = {
        1: plain, 2: plain + " idiot " + plain, 3: plain + " I.D.I-O.T! " + plain, 4: plain + " i d i o t " + plain, 5: plain + " worxthless " + plain,
        6: plain + " mo​ron", 7: None, 8: "", 9: "x" * 5000, 10: "x" * 500 + "worthless", 11: "Worthlesss", None: "pathetic",
    }
    docs = frame(spark, list(rows.items()))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    assert {d for d, s in scores.items() if s >= 0.3} == {2, 3, 4, 5, 6, 11, None}
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 7, 8, 9, 10}
    assert toxicity.score(docs.limit(0), model).collect() == []
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}


def test_models_need_both_labels(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, labels) is None
    assert quality.train(docs, labels) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}


def test_quality_finds_the_bad_passage(spark):
    rng = random.Random(6)
    words = "the house was standing over a river and people walked along".split()
    good = lambda n: " ".join(rng.choices(words, k=n)).capitalize() + "."
    rows = [(i, good(rng.randrange(5, 400))) for i in range(200)]
    rows += [(1000 + i, good(rng.randrange(5, 100)) + " " + " | ".join(rng.choices(words, k=120))) for i in range(100)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(d, int(d < 1000)) for d, _ in rows if d % 3], "doc_id long, quality int")
    model = quality.train(docs, labels)
    odd = frame(spark, [*rows, (None, None), (-1, ""), (-2, "é" * 100_000)])
    out = {r["doc_id"]: r["score"] for r in quality.score(odd, model).collect()}
    assert len(out) == len(rows) + 3
    wrong = sum((out[d] >= 0.5) != (d < 1000) for d, _ in rows if d % 3 == 0)
    assert wrong <= 3
    # A score does not depend on what stands in the same batch.
    alone = {r["doc_id"]: r["score"] for r in quality.score(odd.where("doc_id in (0, 1001, -2)").repartition(3), model).collect()}
    assert all(out[d] == pytest.approx(s, abs=1e-6) for d, s in alone.items())


def test_pipeline_stages_do_what_they_say(spark, sf, tmp_path):
    docs = corpus_pipeline.table(spark, sf, "documents")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], sf).write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
    ids = [[r["doc_id"] for r in d.select("doc_id").collect()] for d in seen]
    assert all(d.columns == columns for d in seen[:-1])
    assert all(set(b) <= set(a) for a, b in zip(ids, ids[1:], strict=False))
    insults = r"(?i)\b(idiot|moron|trash|worthless|pathetic|stupid|loser|clown|scum|disgusting)\b"
    labels = corpus_pipeline.table(spark, sf, "labels")
    toxic = docs.where(F.col("text").rlike(insults)).join(labels.where("toxic = 1"), "doc_id").count()
    left = seen[1].where(F.col("text").rlike(insults)).join(labels.where("toxic = 1"), "doc_id").count()
    assert left <= toxic * 0.4
    rows = [tuple(r) for r in seen[1].select("doc_id", "text").collect()]
    assert sorted(ids[2]) == sorted({c if n else d for d, n, c in brute_components(rows, 80, 5)})
    bench = [decontaminate.normalise(r["text"]) for r in corpus_pipeline.table(spark, sf, "benchmark").collect()]
    assert not any(b in decontaminate.normalise(r["text"]) for r in seen[3].collect() for b in bench)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(seen[3]).collect()}
    assert {d: ids[4].count(d) for d in set(ids[4])} == {d: n for d, n in copies.items() if n}
    from tokenizers import Tokenizer

    rows = [tuple(r) for r in seen[4].select("doc_id", "text").collect()]
    assert sorted(map(tuple, seen[5].collect()), key=repr) == brute_tokens(rows, Tokenizer.from_str(tokenizer_definition()))


def test_pipeline_of_nothing_and_of_odd_rows(spark, sf):
    whole = corpus_pipeline.table(spark, sf, "documents").withColumn("_key", F.lit(1)).withColumn("score", F.lit("clash"))
    odd = spark.createDataFrame(
        [(None, None, None, None, None, 1, "c"), (1, "", None, None, 0, 1, "c"), (1, "", None, None, 0, 1, "c"), (7, "word " * 30_000, "en", "src0", 1, 1, "c")],
        whole.schema,
    )
    for docs in (whole.limit(0), odd):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, sf).collect(), whole.schema)
            assert docs.columns == whole.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
