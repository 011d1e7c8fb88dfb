"""Collocations against plain counting; the transducers on their own."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tickreport.llm import collocations as C


def _counts(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                f.update((lang, tuple(words[i:i + m])) for i in range(len(words) - m + 1))
    return f, n


def _plain(rows, least, best):
    f, n = _counts(rows)
    cands = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    gone = set()
    for (lang, p), a in cands.items():
        for m in range(2, len(p)):
            gone |= {(lang, p[i:i + m]) for i in range(len(p) - m + 1) if f[lang, p[i:i + m]] <= a}
    out = {}
    for (lang, p), a in cands.items():
        if (lang, p) not in gone:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
            for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:best])]


def _rows(n, seed=3):
    rnd = random.Random(seed)
    words = ["a", "B", "cé", "d'e", "the", "THE", "x\x01y", "\x1cq", "你"]
    rows = [("".join(rnd.choice(words) + rnd.choice([" ", "  ", " ", "\t", ". ", "\n", ", ", " \x0b"])
                     for _ in range(rnd.randint(0, 60))), rnd.choice(["en", "en", None, "fr", ""])) for _ in range(n)]
    return rows + [(None, "en"), ("", None), ("ha " * 400, "en"), (" . ,\n", "fr"), ("the cé a, the cé a", "fr")] * 2


SCHEMA = "text string, lang string"


@pytest.mark.parametrize("least,slice_,best", [(2, 300, 25), (9, 1 << 20, 2000), (5, 60, 7)])
def test_equals_plain_counting(spark, monkeypatch, least, slice_, best):
    monkeypatch.setattr(C, "SLICE", slice_)
    monkeypatch.setattr(C, "RANGE", 1 << 11)
    rows = _rows(80)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", phrase string, n long").repartition(3)
    got = [tuple(r) for r in C.collocations(df, least=least, best=best).collect()]
    assert sorted(got) == sorted(_plain(rows, least, best)) and got


def test_counts_stay_exact_when_the_bit_table_is_full(spark, monkeypatch):
    monkeypatch.setattr(C.BitTable, "holds", lambda self, hashes: np.ones(len(hashes), bool))
    rows = _rows(20)
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    got = C.phrase_counts(C.transducers(df, least=4)).collect()
    f, _ = _counts(rows)
    assert {(r["lang"], tuple(r["phrase"].split(" "))): r["f"] for r in got} == {k: a for k, a in f.items() if a >= 4}


def test_products_beyond_64_bits(spark):
    row = spark.sql("SELECT (CAST(4000000000000 AS DECIMAL(19,0)) * CAST(9000000000000 AS DECIMAL(19,0)) "
                    "* CAST(1000 AS DECIMAL(4,0))) div (CAST(4000000000001 AS DECIMAL(19,0)) * CAST(5000000000 AS DECIMAL(19,0)))")
    assert row.first()[0] == 1000 * 4000000000000 * 9000000000000 // (4000000000001 * 5000000000)


def test_no_rows(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_union_adds_shards_and_compose_looks_up():
    vocabulary = [b"a", b"b", b"c"]
    hashes = C.word_hashes(vocabulary, "en")
    words, ids, go_on = C.tokens([b"A b c", b"a b B. c", b"\ta  b", b""])
    assert words == vocabulary and ids.tolist() == [0, 1, 2, 0, 1, 1, 2, 0, 1]
    assert go_on.tolist() == [True, True, False, True, True, False, False, True]
    shards = [t for _, t in C.from_windows(vocabulary, hashes, ids, go_on, 1, 3, 2)]
    shards = [C.Transducer.load(t.dump()) for t in shards]
    both = C.union(shards * 2, 1, 4)
    assert {p: w for d in range(len(both.layers)) for p, w in zip(both.phrases(d), both.layers[d][2].tolist())} == \
        {b"a": 6, b"b": 8, b"c": 4, b"a b": 6}
    asked = [b"a", b"a b", b"a b c", b"z", b"b a"]
    assert C.compose(asked, both).tolist() == [6, 6, 0, 0, 0]
    assert C.compose(asked, C.Transducer([], [])).tolist() == [0] * 5


def test_long_texts_are_cut_between_pieces():
    text = b"one two. three, four\nfive six seven; eight"
    for most in (5, 12, 100):
        parts = list(C.cut(text, most))
        assert _pieces(parts) == _pieces([text])


def _pieces(parts):
    words, ids, joined = C.tokens(parts)
    return [(words[i], j) for i, j in zip(ids.tolist(), [*joined.tolist(), False])]
