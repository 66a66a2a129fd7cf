"""Native operators on small frames: ties, nulls, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

from revlake.llm import dedup, licenses, mixing

SCHEMA = "doc_id long, text string, source string, size string, `key` string, n_chars long, hash int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, s, "x", "y", 1, 2) for d, t, s in rows], SCHEMA)


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while free and left > 1e-9:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if target[s] + share * weight[s] > cap * sizes[s]}
        for s in free:
            target[s] += share * weight[s]
        left = sum(target[s] - cap * sizes[s] for s in over)
        for s in over:
            target[s] = cap * sizes[s]
        free -= over
    return target


@pytest.mark.parametrize("per_bucket", [2, 4096])
def test_mix_meets_every_budget(spark, per_bucket):
    rows = [(i, "w " * (1 + i % 17), f"s{min(i % 40, 6)}") for i in range(300)]
    rows += [(1000, None, None), (1001, "", None), (1002, "one two", None), (1002, "one two", None), (None, "a b c", None), (5000, "", "empty")]
    out = mixing.mix(frame(spark, rows), rows_per_bucket=per_bucket).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    wanted = brute_targets(sizes)
    for source, size in sizes.items():
        own = [r for r in out if r["source"] == source]
        assert {r["source_size"] for r in own} == {size}
        assert own[0]["target"] == pytest.approx(wanted[source])
        assert sum(r["taken"] for r in own) == int(wanted[source] + 0.5)
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)


def test_mix_does_not_depend_on_buckets_or_partitions(spark):
    rows = [(i, "w " * (i % 9), f"s{i % 3 if i % 2 else 0}") for i in range(200)]
    runs = [mixing.mix(frame(spark, rows).repartition(n), rows_per_bucket=b) for n, b in ((1, 4096), (7, 3))]
    first, second = (sorted(map(tuple, r.collect())) for r in runs)
    assert first == second


def test_mix_of_nothing(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    empty = mixing.mix(frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r["taken"], r["target"]) for r in empty] == [(0, 0.0)] * 2


def test_mixed_documents_keep_columns_and_repeat(spark):
    rows = [(i, "w " * 10, "big" if i < 90 else "a") for i in range(100)]
    docs = frame(spark, rows)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    # "a" weighs 5 of 7 but stops at three times its size.
    assert all(counts[i] == 3 for i in range(90, 100))
    assert sum(n for d, n in counts.items() if d < 90) == 70


@pytest.mark.parametrize("bits", [64, 1, 2])
@pytest.mark.parametrize("block", [3, 4, 4096])
def test_exact_groups_equal_brute_force(spark, bits, block):
    rows = [
        (1, "a b c" * 3), (2, "abc abc abc"), (3, "abcabcabd"), (None, None), (5, ""), (5, " "), (6, "x" * 50), (7, "x" * 49 + "y"),
        (7, "x" * 50), (8, "x" * 25 + " " + "x" * 25 + "  "), (9, None), (10, "é" * 9), (11, "é" * 9), (11, "é" * 9), (12, "abcabcab"), (13, "x" * 51),
    ]
    docs = frame(spark, [(d, t, "s") for d, t in rows])
    out = dedup.exact_groups(docs, block=block, print_bits=bits).collect()
    groups = {}
    for d, t in rows:
        groups.setdefault("".join((t or "").split()), []).append((-len(t or ""), d is None, d or 0, d))
    assert len(out) == len(rows)
    wanted = sorted((sorted(v)[0][3], len(v)) for v in groups.values() for _ in v)
    assert sorted((r["keep_id"], r["group_size"]) for r in out) == wanted
    assert sum(r["kept"] for r in out) == len(groups)


def test_exact_groups_of_nothing(spark):
    assert dedup.exact_groups(frame(spark, [])).collect() == []


def test_every_licence_sentence_has_a_trigger():
    import re

    for name, phrase in licenses.SENTENCES:
        assert re.search(licenses.TRIGGER, phrase), (name, phrase)


def test_rules_take_precedence_and_consume(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this. The above copyright notice and this permission notice shall be included in all copies. The software is provided \"as is\", without warranty of any kind."
    rows = [(1, mit), (2, "Foo.\n# Licensed under the\tApache License,\nVersion 2.0. Bar!"), (3, "This licence is odd."), (4, "nothing"), (5, None), (6, ""), (7, mit + " Released under the MIT License.")]
    out = {r["doc_id"]: r for r in licenses.scan(frame(spark, [(d, t, "s") for d, t in rows])).collect()}
    assert sorted(out) == [1, 2, 3, 7]
    assert (out[1]["licenses"], out[1]["n_known"]) == ("MIT", 3)
    assert out[2]["licenses"] == "Apache-2.0"
    assert (out[3]["licenses"], out[3]["n_unknown"]) == ("", 1)
    assert out[7]["licenses"] == "MIT"
    assert licenses.scan(frame(spark, [])).collect() == []


MIT = """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY."""
BSD = """Copyright (c) 2020, A. Person
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{0} Redistributions of source code must retain the above copyright notice, this
  list of conditions and the following disclaimer.

{1} Redistributions in binary form must reproduce the above copyright notice,
  this list of conditions and the following disclaimer in the documentation
  and/or other materials provided with the distribution.
{2}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT DAMAGES."""
BSD_NAME = """
{} Neither the name of the copyright holder nor the names of its
  contributors may be used to endorse or promote products derived from
  this software without specific prior written permission.
"""
ISC = """Copyright (c) 2020, A. Person

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>."""


def test_verbatim_licence_texts(spark):
    grant = GPL[: GPL.index(" as published")]
    texts = [
        ("MIT", MIT), ("BSD-2-Clause", BSD.format("*", "*", "")), ("BSD-2-Clause", BSD.format("1.", "2.", "")),
        ("BSD-3-Clause", BSD.format("*", "*", BSD_NAME.format("*"))), ("BSD-3-Clause", BSD.format("1.", "2.", BSD_NAME.format("3."))),
        ("ISC", ISC), ("ISC", ISC.replace("and/or", "and")), ("Apache-2.0", APACHE), ("GPL-3.0-or-later", GPL), ("GPL-3.0-or-later", GPL[: GPL.index("version.") + 8]),
        ("GPL", grant), ("GPL-3.0", grant + ", version 3"), ("GPL-2.0", grant + " version 2."),
        ("MIT,CC-BY-4.0", "Released under the MIT license\nText licensed under CC BY 4.0\n"),
    ]
    out = {r["doc_id"]: r["licenses"] for r in licenses.scan(frame(spark, [(k, t, "s") for k, (_, t) in enumerate(texts)])).collect()}
    assert [out[k] for k in range(len(texts))] == [name for name, _ in texts]


def test_names_are_unique_and_ordered(spark):
    df = spark.range(1000).select(F.col("id").alias("v"))
    rows = dedup.numbered(df, F.xxhash64("v"), "v").collect()
    assert len({r["name"] for r in rows}) == 1000
    assert min(r["name"] for r in rows) >= 0
