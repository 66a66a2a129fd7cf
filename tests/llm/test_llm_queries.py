"""Registered text queries: against their SQL, or against brute force over whole tables."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from revlake.llm import decontaminate, queries
from revlake.llm.queries import ORACLES, QUERIES, table, tokenizer_definition


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in "documents pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(float(r[i]) if isinstance(r[i], float) else r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cursor.fetchall(), columns)


def test_all_operators_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def brute_tokens(rows, tokenizer):
    start, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_token_files_equal_the_tokenizer(spark, sf):
    got = sorted(map(tuple, QUERIES["op7_token_files"](spark, sf).collect()), key=repr)
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert got == brute_tokens(rows, Tokenizer.from_str(tokenizer_definition()))


def brute_components(rows, percent, width):
    """Components of all pairs, by counting common shingles."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    holders, common = defaultdict(list), Counter()
    for i, grams in enumerate(sets):
        for g in grams:
            holders[g].append(i)
    for own in holders.values():
        common.update(combinations(own, 2))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)] if sets[i] else rows[i][0]) for i in range(len(rows))), key=repr)


def test_jaccard_join_equals_all_pairs(spark, sf):
    got = sorted(map(tuple, QUERIES["op9_jaccard_join"](spark, sf).collect()), key=repr)
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert got == brute_components(rows, 90, 3)


def test_decontamination_equals_a_search_for_every_item(spark, sf):
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in QUERIES["op4_decontaminate"](spark, sf).collect()}
    items = [(r["item_id"], decontaminate.normalise(r["text"])) for r in table(spark, sf, "benchmark").collect()]
    for r in table(spark, sf, "documents").select("doc_id", "text").collect():
        text = decontaminate.normalise(r["text"] or "")
        for item, wanted in items:
            if wanted in text:
                assert got.pop((r["doc_id"], item)) == 0
    # Whatever else was found is near by exact edit distance.
    texts = {r["doc_id"]: decontaminate.normalise(r["text"]) for r in table(spark, sf, "documents").collect()}
    for (doc, item), distance in got.items():
        wanted = dict(items)[item]
        assert 0 < distance <= 0.2 * len(wanted)
        assert decontaminate.least_distance(wanted, texts[doc])[0] <= distance


@pytest.mark.parametrize(("name", "label", "least"), [("op5_toxicity", "toxic", 0.9), ("op6_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    scored = QUERIES[name](spark, sf).where("held_out").join(table(spark, sf, "labels"), "doc_id")
    rows = scored.selectExpr("predicted", f"{label} AS y", "score").collect()
    assert len(rows) > 500
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == r["y"] for r in rows) / len(rows) >= least


def test_models_do_not_see_held_out_labels(spark, sf):
    kept = table(spark, sf, "labels").where(~queries.held_out()).collect()
    assert kept
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 for r in kept)
