"""Whole jobs beyond the bounds and canonical texts of the tables."""

import numpy as np
from pyspark.sql import functions as F

from tickreport.llm import license_rules, line_crf


def test_one_long_document_leaves_the_others_to_training(spark, monkeypatch):
    good = "The house on the hill was sold, and the family moved to the town by the sea."
    texts = [f"{good} {i}\n{good}" if i % 2 else f"$$ {i} ## || 77 == >> {i}\n@@ 00 || ##" for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    ids = [r[0] for r in docs.selectExpr("doc_id").orderBy(F.xxhash64("doc_id")).collect()]
    long = F.when(F.col("doc_id") == ids[0], F.concat_ws("\n", F.array_repeat("text", 45_000))).otherwise(F.col("text"))
    monkeypatch.setattr(line_crf, "TRAIN_LINES", 1000)
    model = line_crf.train(docs.withColumn("text", long), labels)
    scores, _ = line_crf.score(model, [t.encode() for t in texts])
    assert all((s >= 0.5) == (i % 2 == 1) for i, s in enumerate(scores) if i != ids[0])


def test_training_lines_are_shared_in_chains():
    assert line_crf.shares([5, 70, 9], 84) == [5, 70, 9]
    assert line_crf.shares([5, 1000, 300], 400) == [5, 192, 192]
    assert line_crf.shares([100, 100, 3], 70) == [64, 0, 3]


def test_features_of_tasks_train_like_whole_texts(spark):
    rows = [(i, f"a line {i}\nsome more words of {i}, and\n## {i}" if i % 3 else f"|| {i}\n== 0 0 0") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(40)], "doc_id long, quality int")
    order = [r[0] for r in docs.orderBy(F.xxhash64("doc_id")).select("doc_id").collect()]
    whole = line_crf.fit([rows[i][1].encode() for i in order], [int(i % 3 > 0) for i in order])
    parts = line_crf.train(docs, labels)
    assert np.allclose(whole.weights, parts.weights) and np.allclose(whole.curve, parts.curve)
    half = line_crf.lines_in_parts([t.encode() for _, t in rows])
    halo = np.zeros(len(half.length), bool)
    halo[half.first[1:] - 1] = True
    assert line_crf.fit_lines(half, [int(i % 3 > 0) for i, _ in rows], halo).curve != (0.0, 0.0)


_CLAUSES = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{0}. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

{1}. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

"""
_NAMES = """{2}. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
_USEFUL = """
This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

"""
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
"""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
"""
_GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""
_GPL2 = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.
"""
_LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
_ADVERT = """   3. All advertising materials mentioning features or use of this software
      must display the following acknowledgement:
      This product includes software developed by the Example Group.

"""
#: A text for each of RULES, in their order.
CANONICAL = [
    "MIT License\n\n" + _GRANT + _AS_IS, _GRANT + _AS_IS, _GRANT + "Other words.",
    (_CLAUSES + _ADVERT + _NAMES.replace("{2}", "4")).format(1, 2),
    (_CLAUSES + _NAMES).format(1, 2, 3), _CLAUSES.format("a", "b"),
    _APACHE + "You may obtain a copy of the License at\n\nUnless required by applicable law or agreed to in writing, "
    "software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF "
    "ANY KIND, either express or implied.\n",
    _APACHE, "                                 Apache License\n                           Version 2.0, January 2004\n"
    "                        http://www.apache.org/licenses/\n\n",
    _GPL3 + _USEFUL, _GPL2 + _USEFUL, _GPL3, _GPL2, _LGPL, "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the GNU General Public License, version 2.",
    "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not "
    "distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby "
    "granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Licensed under CC0 1.0.", "This project is licensed under the MIT License.", "The MIT License (MIT)",
    _GPL3.replace("GNU General", "GNU Affero General"), _LGPL.replace("2.1", "3"),
    "Licensed under the GNU Affero General Public License, version 3.",
    "Licensed under the GNU Lesser General Public License, version 3.",
    "Licensed under the BSD 3-Clause License.", "Licensed under the BSD 2-Clause License.", "Licensed under the ISC License.",
    "This is free and unencumbered software released into the public domain.\n",
    "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter "
    "it and redistribute it\nfreely, subject to the following restrictions:\n",
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.\n",
    *[f"SPDX-License-Identifier: {x}" for x in license_rules.SPDX],
]


def test_a_canonical_text_of_every_licence_rule(spark):
    head = "Copyright (c) 2020 Somebody\n\n"
    rows = [(i, head + text) for i, text in enumerate(CANONICAL)]
    rows += [(100 + i, "\n".join(f" * {line}" for line in text.split("\n"))) for i, text in enumerate(CANONICAL)
             if "\n\n" not in text and not text.startswith(" ")]
    rows += [(200, "It was 1. This program is free software. Other words: v. 2.0. 3. End."), (201, "2.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: r for r in license_rules.scan_licenses(docs).select("doc_id", "sequence", "licenses").collect()}
    for i, (licence, run) in enumerate(license_rules.RULES):
        assert got[i]["licenses"] == [licence], (i, got[i])
        assert "".join(f"<{x}>" for x in run) in got[i]["sequence"], (i, got[i])
        assert 100 + i not in got or got[100 + i]["licenses"] == [licence], (i, got[100 + i])
    assert len(CANONICAL) == len(license_rules.RULES)
    assert got[200]["sequence"] == got[201]["sequence"] == "~"


#: Usual texts beside the canonical ones, and what they are.
USUAL = [
    ("MIT License\n\nCopyright (c) 2020 Somebody\n\n" + _GRANT + _AS_IS, ["MIT"]),
    ("The MIT License (MIT)\n\nCopyright (c) 2020 Somebody, Inc. All rights reserved.\n\n" + _GRANT + _AS_IS, ["MIT"]),
    ("Copyright (c) 2019 A\nCopyright (c) 2020 B\n" + _GRANT + _AS_IS, ["MIT"]),
    ((_CLAUSES + _NAMES).format(1, 2, 3).replace("the copyright holder", "Google Inc."), ["BSD-3-Clause"]),
    (_CLAUSES.format(1, 2) + "   3. The name of the author may not be used to endorse or promote products derived\n   from this "
     "software without specific prior written permission.\n", ["BSD-3-Clause"]),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General\nPublic "
     "License version 2 as published by the Free Software Foundation.\n", ["GPL-2.0-only"]),
    ("// SPDX-License-Identifier: Apache-2.0\n#include <x>\n", ["Apache-2.0"]),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */\n\n" + _GPL2, ["GPL-2.0-or-later"] * 2),
    ("Ich gehe mit. MIT\n\nmit\n\nCopyright (c) 2020 Somebody", []),
]


def test_usual_licence_texts_and_their_sql(spark):
    import duckdb
    rows = [(i, text) for i, (text, _) in enumerate(USUAL)] + [(100 + i, t) for i, t in enumerate(CANONICAL)]
    rows += [(300, None), (301, ""), (302, "1. 2.\n\ncopyright notices"), (303, "a\nCopyright 2020 B\nMIT License. x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = license_rules.scan_licenses(docs)
    got = {r[0]: r for r in out.collect()}
    assert {i: got[i]["licenses"] for i in range(len(USUAL))} == {i: x for i, (_, x) in enumerate(USUAL)}
    frame = docs.toPandas()  # read by the SQL below as its table
    con = duckdb.connect()
    con.register("documents", frame)
    same = con.execute(license_rules.ORACLES["op1_license_rules"]).fetchall()
    assert {r[0]: (r[1], r[2], r[3], r[4]) for r in same} == {
        i: (r["n_sentences"], len(r["sentence_ids"]), r["sequence"], ",".join(r["licenses"])) for i, r in got.items()}


def test_every_known_sentence_has_an_anchor():
    held = lambda x: any(a in x for a in license_rules.ANCHORS)
    assert all(held(x) for _, x in license_rules.SENTENCES)
    assert all(held(" ".join(parts).replace("spdx license identifier", "spdx-license")) for _, parts in license_rules.PARTED)


def _pieces():
    import pytest

    from tickreport.llm import piece_sampling
    return piece_sampling, piece_sampling.load(pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model"))


def test_long_runs_are_drawn_from_the_whole_lattice():
    sampling, pieces = _pieces()
    run = np.array([[ord(c) for c in ("abcdefthing你好" * 450)[:5_000]]], np.uint32)
    whole = sampling.filter_words(pieces, run, 1 << 20)
    blocks = sampling.filter_words(pieces, run, 256)
    assert all((a == b).all() if a.dtype.kind != "f" else np.allclose(a, b) for a, b in zip(whole, blocks))
    counts, steps, sizes, _ = whole
    assert counts.shape == (5_000,) and counts.sum() == len(steps)
    # Plain forward sums of all segmentations give the same thresholds.
    import math
    text, find = "abcdefthing你好" * 20, {}
    for i, h in zip(pieces.ids.tolist(), range(len(pieces.ids))):
        find[pieces.bytes[i].decode()] = float(pieces.weights[h])
    forward, got = [0.0] + [-math.inf] * len(text), []
    for end in range(1, len(text) + 1):
        paths = [(s, forward[end - s] + w) for s in range(1, min(end, pieces.longest) + 1)
                 if (w := find.get(text[end - s:end].replace("▁", " "), pieces.byte_weight * len(text[end - 1].encode())
                                   if s == 1 else None)) is not None]
        top = max(w for _, w in paths)
        total = sum(math.exp(w - top) for _, w in paths)
        forward[end] = top + math.log(total)
        got.append([math.exp(w - top) / total for _, w in paths])
    counts, steps, _, _ = sampling.filter_words(pieces, np.array([[ord(c) for c in text]], np.uint32), 100)
    ends = np.split(steps, np.cumsum(counts)[:-1])
    for mine, shares in zip(ends, got):
        assert len(mine) == len(shares) and np.allclose(mine[:-1], np.cumsum(shares)[:-1], atol=1e-5) and mine[-1] == 2


def test_draws_do_not_depend_on_what_was_filtered_before(monkeypatch):
    sampling, pieces = _pieces()
    texts = ["the thing that was " * 50, "other words entirely", "x" * 40_000, ""]
    first = sampling.encode_batch(pieces, texts, np.arange(4))
    monkeypatch.setattr(sampling, "LATTICES", 10)
    again = [sampling.encode_batch(pieces, [t], np.array([i]))[0] for i, t in enumerate(texts)]
    assert all((a == b).all() for a, b in zip(first, again))
    assert [sampling.decode_ids(pieces, x).decode() for x in first] == texts


def test_decoding_in_the_same_step(spark):
    sampling, _ = _pieces()
    import public_tokenizers
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "one two"), (2, None), (None, "\x00 ▁ 你 "), (3, "")], "doc_id long, text string")
    out = sampling.encode(docs, path, decoded="back")
    assert [(r["text"] or "") == r["back"] for r in out.collect()] == [True] * 4
    assert sorted(map(str, out.drop("back").collect())) == sorted(map(str, sampling.encode(docs, path).collect()))


def test_frequent_lines_are_counted_in_documents(spark):
    from tickreport.llm import quality_rules
    own = [" ".join(chr(97 + i) * (k + 1) for k in range(25)) for i in range(20)]  # digits count as one
    rows = [(i, f"same line of many\n{own[0]}", "h") for i in range(12)]           # twelve copies
    rows += [(100, f"once\n{own[1]}", "h")] * 20                                   # one document in twenty rows
    rows += [(200 + i, f"same line of many\n{own[2 + i]}", "other") for i in range(10)]  # ten documents: no more
    rows += [(None, "same line of many", "h"), (300, None, "h"), (301, "", None)]
    df = spark.createDataFrame(rows, "kept long, text string, source string")
    out = quality_rules.quality_rules(df, id_col="kept", min_words=1)
    assert out.columns == ["kept", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                           "_kept", "line_chars", "removed_chars"]
    got = {r[0]: r for r in out.collect()}
    line = len("same line of many")
    assert all(got[i]["removed_chars"] == line + len(own[0]) and not got[i]["_kept"] for i in range(12))
    assert got[100]["removed_chars"] == 0 and got[100]["_kept"] and out.count() == len(rows)
    assert all(got[200 + i]["removed_chars"] == 0 for i in range(10)) and not got[None]["_kept"]


def test_the_gray_order_index_finds_the_links(monkeypatch):
    from tickreport.llm import simhash
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 1 << 63, 4_000, dtype=np.uint64)
    near = fps[:400] ^ (np.uint64(1) << rng.integers(0, 63, 400).astype(np.uint64)) ^ np.uint64(1 << 62)
    fps = np.unique(np.concatenate([fps, near]))
    compared = []
    roots = simhash.linked(fps, 3, compared)
    plain = simhash.Components(len(fps))
    for i in range(len(fps)):
        j = np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 3) + i + 1
        plain.join(np.full(len(j), i), j)
    assert (plain.flat() == roots).all()
    assert sum(compared) < 0.01 * len(fps) ** 2 / 2  # whole groups are pruned


def test_simhash_query_against_brute_force(spark):
    import os

    import pytest

    from tickreport.llm import simhash
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fp = {r["doc_id"]: simhash.simhash((r["text"] or "").encode()) for r in rows}
    least = {i: i for i in fp}
    changed = True
    while changed:  # smallest id reachable
        changed = False
        for i in fp:
            best = min(least[j] for j in fp if (fp[i] ^ fp[j]).bit_count() <= 3)
            changed, least[i] = changed or best < least[i], min(best, least[i])
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.op9_simhash_dedup(spark, sf).collect()}
    assert got == {i: (fp[i], least[i]) for i in fp}


def test_links_do_not_depend_on_the_number_of_indexes(spark):
    from tickreport.llm import simhash
    rng = np.random.default_rng(7)
    fps = rng.integers(0, 1 << 63, 600, dtype=np.uint64).view(np.int64)
    fps = np.unique(np.concatenate([fps, fps[:200] ^ 5, fps[:50] ^ 7]))
    df = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    found = [{tuple(r) for r in simhash.components(simhash.bucket_links(df, 3, max_bucket, per)).collect()}
             for max_bucket, per in ((20_000, 4096), (20_000, 20), (50, 200))]
    assert found[0] == found[1] == found[2] and len(found[0]) > 200


def test_next_documents_in_runs(spark):
    import pyarrow as pa
    from pyspark.sql import types as T

    from tickreport.llm import improbable
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("pair", T.StringType())])
    process = lambda a, b: [pa.array([f"{x}|{y}" for x, y in zip(a, b)])]
    sets = [[(i * 7 % 501, f"t{i}") for i in range(501)], [(5, "a")] * 3, [(None, "n"), (None, None), (3, "x"), (3, "y"), (9, "")],
            [], [(2, "one")], [(i, "same") for i in range(3)] + [(1 << 60, "far")]]
    for rows in sets:
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = improbable.with_next(df, "text", "doc_id", process, schema).collect()
        order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        want = [(i, f"{t}|{order[(k + 1) % len(order)][1]}") for k, (i, t) in enumerate(order)]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    parts = improbable.with_next(spark.createDataFrame(sets[0], "doc_id long, text string"), "text", "doc_id", process, schema) \
        .rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect()
    assert max(parts) < 1.5 * 501 / 8 and min(parts) > 0  # no two runs in a task
