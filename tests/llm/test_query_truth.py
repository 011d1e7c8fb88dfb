"""Whole registered queries against plain second implementations over sf0.001."""

import collections
import math
import os
import zlib

import numpy as np
import pytest

from tickreport.llm import cutting_stock, packing, simhash

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _texts(order="doc_id"):
    duckdb = pytest.importorskip("duckdb")
    return duckdb.sql(f"select doc_id, coalesce(text, '') from '{SF}/documents.parquet' order by {order}").fetchall()


def _first_fit_decreasing(counts, capacity):
    rooms = []
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            i = next((i for i, room in enumerate(rooms) if room >= n), None)
            if i is None:
                rooms.append(capacity - n)
            else:
                rooms[i] -= n
    return len(rooms)


def _checked(counts, capacity):
    """The number of patterns of ``solve``, which hold every item and never too much."""
    packed = collections.Counter()
    patterns = cutting_stock.solve(dict(counts), capacity)
    for pattern, times in patterns:
        assert times > 0 and sum(n * k for n, k in pattern) <= capacity
        for n, k in pattern:
            packed[n] += k * times
    assert packed == counts
    return sum(times for _, times in patterns)


@pytest.mark.parametrize("low,high", [(230, 520), (300, 700)])
def test_column_generation_beats_first_fit(low, high):
    rng = np.random.default_rng(4)
    counts = collections.Counter(rng.integers(low, high, size=4000).tolist())
    patterns, x, bound = cutting_stock.relaxed(dict(counts), 1024)
    held = collections.Counter()
    for pattern, times in zip(patterns, x):
        assert sum(n * k for n, k in pattern.items()) <= 1024 and times >= 0
        for n, k in pattern.items():
            held[n] += k * times
    assert all(abs(held[n] - c) < 1e-3 for n, c in counts.items())
    assert 0 <= sum(x) - bound + 1e-9 <= max(1e-4 * bound, 0.25) + 1e-6  # proved within the gap
    plain, used = _first_fit_decreasing(counts, 1024), _checked(counts, 1024)
    assert bound - 1e-2 <= used <= plain
    assert used - bound <= max(1, (plain - bound) / 2), (used, bound, plain)


def test_times_hold_the_items_after_many_steps():
    """Lengths of all sizes, some scarce: a long chain of simplex steps must not
    drift below the bound by total length."""
    rng = np.random.default_rng(5)
    for spread in (1.0, 1.6):
        lengths = np.clip(rng.lognormal(5.5, spread, 20_000).astype(int), 1, 1023)
        counts = collections.Counter(lengths.tolist())
        patterns, x, bound = cutting_stock.relaxed(dict(counts), 1024)
        held = collections.Counter()
        for pattern, times in zip(patterns, x):
            assert sum(n * k for n, k in pattern.items()) <= 1024 and times >= 0
            for n, k in pattern.items():
                held[n] += k * times
        assert all(abs(held[n] - c) < 1e-2 for n, c in counts.items())
        assert lengths.sum() / 1024 - 1e-6 <= bound <= sum(x) + 1e-6
        assert sum(x) - bound <= max(1e-4 * bound, 0.25) + 1e-6
        assert _checked(counts, 1024) - bound <= max(3, 3e-4 * bound)


def test_cutting_stock_is_least_on_small_cases():
    def least(items, capacity):
        best = len(items)

        def place(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(items):
                best = len(rooms)
                return
            for j in range(len(rooms)):
                if rooms[j] >= items[i] and rooms[j] not in rooms[:j]:
                    place(i + 1, rooms[:j] + [rooms[j] - items[i]] + rooms[j + 1:])
            place(i + 1, rooms + [capacity - items[i]])

        place(0, [])
        return best

    rng = np.random.default_rng(5)
    for _ in range(60):
        items = sorted(rng.integers(1, 21, size=int(rng.integers(1, 11))).tolist(), reverse=True)
        assert _checked(collections.Counter(items), 20) <= least(items, 20) + 1
    assert cutting_stock.solve({}, 20) == [] and cutting_stock.solve({3: 0}, 20) == []
    assert cutting_stock.solve({20: 7}, 20) == [([(20, 1)], 7)]
    assert _checked(collections.Counter({1: 10 ** 9, 1000: 10 ** 8}), 1024) == 10 ** 8


@needs_tables
def test_packing_query(spark):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    texts = _texts()
    want = {i: np.array(e.ids + [0], "<u4") for (i, _), e in zip(
        texts, tokenizer.encode_batch([t for _, t in texts], add_special_tokens=False))}
    got, filled = collections.defaultdict(list), collections.defaultdict(list)
    for r in packing.op4_packing(spark, SF).collect():
        ids = want[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
        got[r["doc_id"]].append((r["start"], r["length"]))
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got.keys() == want.keys()
    for parts, total in [(p, len(want[i])) for i, p in got.items()] + [(p, None) for p in filled.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == total if total is not None else at <= 1024
    tokens = sum(map(len, want.values()))
    assert len(filled) <= math.ceil(tokens / 1024) + 2  # padding: at most two sequences over the least


@needs_tables
def test_simhash_query(spark):
    import xxhash

    documents = _texts()
    prints = {}
    for i, text in documents:
        lowered = text.translate({c: c + 32 for c in range(65, 91)})
        words = [w for w in lowered.translate({c: 32 for c in range(9, 14)}).split(" ") if w]
        shingles = [" ".join(words[j:j + 3]) for j in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    parent = list(range(len(ids)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(ids)):
        for b in np.flatnonzero(np.bitwise_count(values ^ values[a]) <= 3).tolist():
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op9_simhash_dedup(spark, SF).collect()}
    assert got == {i: (f"{prints[i]:016x}", ids[root(a)]) for a, i in enumerate(ids)}
    assert len({c for _, c in got.values()}) < len(got)
