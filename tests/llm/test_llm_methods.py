"""The methods against brute force, exact round trips or held-out accuracy."""

import collections
import itertools
import math
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tickreport.llm import (cutting_stock, improbable, language_id, license_rules, line_crf, maxent_lm, packing,
                            piece_sampling, quality_rules, simhash)

SF = "/root/testdata/sf0.001"


def _documents():
    duckdb = pytest.importorskip("duckdb")
    return duckdb.sql(f"select doc_id, text, lang from '{SF}/documents.parquet' order by doc_id").fetchall()


def test_license_text(spark):
    text = ("MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this "
            "software and associated documentation files (the \"Software\"), to deal\nin the Software without "
            "restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is furnished "
            "to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice "
            "shall be included in all copies or substantial portions of the Software.\n\n")
    as_is = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
             "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
    rows = [(1, text + as_is), (2, text.replace("MIT License\n\n", "") + "Other words.\n" + as_is), (3, "no licence")]
    got = {r[0]: r for r in license_rules.scan_licenses(
        spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "sequence", "licenses").collect()}
    assert got[1]["licenses"] == ["MIT"] and got[1]["sequence"] == "<MIT_NAME><MIT_GRANT><MIT_NOTICE><AS_IS_MIT>"
    assert got[2]["licenses"] == ["MIT"] and got[2]["sequence"].endswith("<MIT_NOTICE>~<AS_IS_MIT>")
    assert got[3]["licenses"] == []


def test_chain_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    step, sizes = rng.normal(size=(2, 2)), [1, 4, 3]
    first = np.concatenate([[0], np.cumsum(sizes)])
    emission = rng.normal(size=8)
    good, pairs = line_crf.marginals(emission, step, first)
    want, expected = np.zeros(8), np.zeros((2, 2))
    for lo, hi in zip(first, first[1:]):
        total = 0.0
        mass, moves = np.zeros(hi - lo), np.zeros((2, 2))
        for path in itertools.product([0, 1], repeat=int(hi - lo)):
            w = math.exp(sum(emission[lo + i] for i, y in enumerate(path) if y)
                         + sum(step[a, b] for a, b in zip(path, path[1:])))
            total += w
            mass += w * np.array(path)
            for a, b in zip(path, path[1:]):
                moves[a, b] += w
        want[lo:hi], expected = mass / total, expected + moves / total
    assert np.allclose(good, want) and np.allclose(pairs, expected)


def test_line_features_and_held_out_quality():
    duckdb = pytest.importorskip("duckdb")
    rows = duckdb.sql("select doc_id, text, quality from '/root/testdata/sf0.01/documents.parquet' join "
                      "'/root/testdata/sf0.01/labels.parquet' using (doc_id) order by doc_id").fetchall()
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    test = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    model = line_crf.fit([r[1].encode() for r in train], [r[2] for r in train])
    scores, _ = line_crf.score(model, [r[1].encode() for r in test])
    y = np.array([r[2] for r in test])
    pairs = [(a > b) + 0.5 * (a == b) for a in scores[y == 1] for b in scores[y == 0]]
    assert np.mean(pairs) > 0.95
    assert np.mean(scores[y == 1] >= 0.5) > 0.95
    lines = line_crf.lines_of([b"AB ab, ab!\n\nx", b""])
    assert lines.length.tolist() == [10, 0, 1, 0] and lines.first.tolist() == [0, 3, 4]
    assert lines.features[0, 9] == 1.0  # ab, and ab! differ


def test_entropy_scores_by_definition():
    rng = np.random.default_rng(1)
    buf = rng.integers(97, 107, size=140_000).astype(np.uint8)
    got = improbable.entropy_scores(buf)
    for i in [*range(200), *range(130_950, 131_150), len(got) - 1]:
        assert got[i] == improbable._PART[np.bincount(buf[i:i + 64], minlength=256)].sum() // 1000


def test_digests(spark):
    texts = [r[1].encode() for r in _documents()] + [b"", b"short", b"y" * 64, b"z" * 90]
    histogram = np.zeros(improbable.SCORES, np.int64)
    for t in texts:
        histogram += np.bincount(improbable.entropy_scores(np.frombuffer(t, np.uint8)), minlength=improbable.SCORES)
    rank = improbable.rarity(histogram)
    batch = improbable.digests(texts, rank)
    assert [str(d) for d in batch] == [str(improbable.digests([t], rank)[0]) for t in texts]
    assert str(improbable.Digest.parse(str(batch[0]))) == str(batch[0])
    text = max(texts[:150], key=len).decode()
    near = improbable.digests([text.encode(), (text[:len(text) * 3 // 4] + text[::-1][:len(text) // 4]).encode()], rank)
    assert improbable.likeness(*near) > 0.5 and improbable.likeness(near[0], near[0]) == 1.0
    assert improbable.likeness(batch[-4], batch[-3]) == 0.0 and improbable.likeness(batch[-4], batch[-4]) == 1.0

    out = improbable.op3_improbable_digest(spark, SF).collect()
    got = {r["doc_id"]: r for r in out}
    docs = _documents()
    assert len(out) == len(docs)
    for (i, t, _), (_, following, _) in zip(docs, docs[1:] + docs[:1]):
        changed = improbable.edited(t, following).encode()
        import hashlib

        assert got[i]["edited_sha256"] == hashlib.sha256(changed).hexdigest() and got[i]["n_chars"] == len(t)


def test_cutting_stock_holds_every_item():
    rng = np.random.default_rng(2)
    for n in (1, 30, 3000):
        sizes = np.minimum(rng.lognormal(5, 1.2, size=n).astype(int) + 1, 1024)
        counts = collections.Counter(sizes.tolist())
        packed = collections.Counter()
        patterns = cutting_stock.solve(dict(counts), 1024)
        for pattern, times in patterns:
            assert sum(a * k for a, k in pattern) <= 1024
            for a, k in pattern:
                packed[a] += k * int(times)
        assert packed == counts
        used = sum(t for _, t in patterns)
        assert used <= math.ceil(sum(sizes) / 1024) * 1.05 + 2
    value, pattern = cutting_stock.knapsack(np.array([3.0, 4.0, 5.0]), np.array([3, 4, 5]), 9)
    assert value == 9.0 and sum(k * n for n, k in pattern.items()) == 9


def test_word_cache_equals_the_tokenizer():
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    ids = packing.token_ids(path)
    hard = ["", " a  b\n\n c", "x\ty z", "a <|endoftext|> b's don't", "é ü\nß 你好 ", "\n", "it's. a,b ., x.. ª. 1a. Ǆ,"]
    for t in hard + [r[1] for r in _documents()[:40]]:
        assert np.frombuffer(ids(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_words_of_a_batch_are_looked_up_once():
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rng = np.random.default_rng(11)
    some = ["", "the", "The", "there.", "there,", "there###", "it's", "it're", "x1y", "1a.", "a-b", "été", "été.", "été!!",
            "e\u0301a", "straße,%%%", "aσb", "你好", "ª.", "\x00", ".", "...", "Ġa", "\u2003", "a\u00a0b", "a\tb", "\r"]
    odd, plain = some[-4:] + [""], some[1:-4]
    for cache_words in (packing.CACHE_WORDS, 0, 7):
        ids = packing.batch_ids.__wrapped__(path, cache_words)
        for batch in range(12):
            texts = []
            for _ in range(40):
                pick = plain + odd if rng.random() < 0.3 else plain
                words = rng.choice(np.array(pick, object), size=int(rng.integers(0, 9)))
                texts.append("".join(w + " \n"[int(rng.random() < 0.3)] for w in words)[:-1])
            texts += [None, "", "\n", " ", "the\n", "\nthe", " the", "the "]
            after = rng.integers(0, 2 ** 32, len(texts))
            got, ends = ids(pa.array(texts, pa.string()), after)
            want = [e.ids + [a] for e, a in zip(
                tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False), after.tolist())]
            for text, start, end, wanted in zip(texts, [0, *ends[:-1]], ends, want):
                assert got[start:end].tolist() == wanted, text
            assert len(got) == ends[-1]
    asked, known = [], packing.array
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(packing, "array", lambda kind, part: asked.append(part) or known(kind, part))
        ids = packing.batch_ids.__wrapped__(path, 0)  # nothing is kept, so every look-up asks the model
        asked.clear()
        ids(pa.array(["a word and a word"] * 50 + ["a\nword"]), np.zeros(51))
    assert len(asked) <= 5  # a, word, and; word behind a line's start; a at the texts' start


def test_hot_length_is_ranked_in_groups(spark):
    pieces = spark.range(5000).selectExpr("id as doc_id", "0L as start", "if(id % 3 = 0, 700L, 1 + id % 300) as length")
    out = packing.assign_sequences(pieces, ["doc_id"]).collect()
    ends = collections.defaultdict(int)
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert len(out) == 5000 and max(ends.values()) <= 1024


def test_repeated_windows_by_definition(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["a", "b"], size=int(rng.integers(0, 60))))) for i in range(40)]
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.quality_rules(
        spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")).collect()}
    for i, t in rows:
        w = t.split()
        windows = [tuple(w[j:j + 8]) for j in range(len(w) - 7)]
        n = collections.Counter(windows)
        assert got[i] == len({j + k for j, x in enumerate(windows) if n[x] > 1 for k in range(8)})


def test_language_evidence(spark):
    model = language_id.train(spark.read.parquet(f"{SF}/documents.parquet"))
    out = language_id.identify_pages(spark.read.parquet(f"{SF}/pages.parquet"), model).collect()
    assert sum(r["lang"] == r["declared"] for r in out) > 0.95 * len(out)
    # Without text, the host decides against the rest of the table.
    page = "<html{}><body>{}</body></html>"
    german = "der die und das ist nicht mit von auch sich zu dem im den ein eine einer " * 3
    rows = [(i, f"http://h{i % 2}.example.org/", page.format("", german if i % 2 else "the of and to in is that it was for on with as be at by this"))
            for i in range(40)] + [(99, "http://h1.example.org/", page.format("", ""))]
    trained = language_id.fit({"de": [german.encode()], "en": [b"the of and to in is that it was for on with as be at by this"],
                               "es": [b"de la que el en y a los se del"], "fr": [b"de la le et les des en un du une"]})
    got = {r["page_id"]: r["lang"] for r in language_id.identify_pages(
        spark.createDataFrame(rows, "page_id long, url string, html string"), trained).collect()}
    assert got[99] == "de" and got[1] == "de" and got[0] == "en"


def test_language_model_is_a_distribution():
    top = [(b"a", 50), (b"b", 30), (b"", 20), *[(f"w{i}".encode(), 3) for i in range(600)]]
    rest = [(4, 3), (0, 0), (5, 5), (1, 1)]
    total, size = sum(c for _, c in top) + 10, len(top) + 9
    v = maxent_lm.Vocabulary(top, rest, total, size)
    trainer = maxent_lm.Trainer(maxent_lm.Weights.zero())
    trainer.learn(v, [b"a b a b w1 w2 a"] * 20)
    weights = maxent_lm.Weights(*trainer.tables)

    def probability(word, history=b"a b "):
        log = maxent_lm.score_texts(v, weights, [history + word])[3][0]
        return math.exp(log - maxent_lm.score_texts(v, weights, [history])[3][0])

    # P(end | a b) and P(end | a b w) cancel by scoring the words' own step.
    seq, at, _, _ = maxent_lm._sequence(v, [b"a b"])
    rows = maxent_lm.features(seq, at[-1:])
    classes = np.exp(maxent_lm.log_softmax(maxent_lm.logits(weights.tables[0], rows)))[0]
    assert abs(classes.sum() - 1) < 1e-5
    for c in range(len(top) // maxent_lm.WIDTH):
        if c < maxent_lm.FREQUENT // maxent_lm.WIDTH:
            inner = maxent_lm.log_softmax(maxent_lm.logits(
                weights.tables[1], maxent_lm.joined(rows, np.array([c]))) + v.open[[c]])
            assert abs(np.exp(inner).sum() - 1) < 1e-5
    others = collections.defaultdict(float)
    for i in range(maxent_lm.FREQUENT, v.k):
        others[v.cls[i]] += math.exp(v.within[i])
    for g, (n, words) in enumerate(rest):  # known words of the rest and one unseen outcome
        others[v.cls[v.k + g]] += math.exp(v.within[v.k + g]) * (n + 0.5 * words + 0.5)
    assert all(abs(x - 1) < 1e-9 for x in others.values())


def test_language_model_words_and_gradients():
    """Ids of an Arrow array of words, other words of each text, and a step's sums, each by definition."""
    top = [(b"the", 9), (b"", 8), (b"of", 5)]
    v = maxent_lm.Vocabulary(top, [(1, 1)] * maxent_lm.ENDINGS, 26, 7)
    words = [b"the", b"x", b"", b"\xc3\xa9t\xc3\xa9", b"of", b"thereof", b"longer", b"er", b"the"]
    assert v.encode(pa.array(words, pa.binary())).tolist() == [v.ids[w] for w in words]
    none = maxent_lm.Vocabulary([], [(0, 0)] * maxent_lm.ENDINGS, 0, 0)
    weights = maxent_lm.Weights.zero()
    texts = [b"", b"The x x the", b"of er ER x", b" \t "]
    for model, known in ((v, {b"the", b"of"}), (none, set())):
        n, top_, _, _, others = maxent_lm.score_texts(model, weights, texts)
        want = [collections.Counter(w for w in t.lower().split() if w not in known) for t in texts]
        assert [{i["word"]: i["n"] for i in o} for o in others.to_pylist()] == want
        assert n.tolist() == [len(t.split()) + 1 for t in texts]
        assert (n - top_).tolist() == [sum(w.values()) + (model is none) for w in want]
    rng = np.random.default_rng(2)
    rows = rng.integers(0, maxent_lm.ROWS, (300, 5)) ** 3 // maxent_lm.ROWS ** 2  # some rows often
    off = rng.normal(size=(300, maxent_lm.WIDTH)).astype(np.float32)
    trainer = maxent_lm.Trainer(weights)
    trainer._step(1, rows, off)
    grad = np.zeros((maxent_lm.ROWS, maxent_lm.WIDTH))
    np.add.at(grad, rows.T.ravel(), np.tile(off.astype(float), (5, 1)))
    rate = maxent_lm.RATE / np.sqrt(1 + (grad ** 2).sum(axis=1, keepdims=True))
    assert np.allclose(trainer.tables[1], grad * rate, atol=1e-5)
    assert np.array_equal(trainer.used[1], np.bincount(rows.ravel(), minlength=maxent_lm.ROWS))


def test_language_model_step_holds_no_cell_per_weight():
    """A step sums whole rows of the gradient: with an entry per token, feature and class its time
    and memory were most of the training's."""
    rng = np.random.default_rng(4)
    rows = np.ascontiguousarray(rng.integers(1, maxent_lm.ROWS, (5, maxent_lm.BATCH))).T
    off = rng.normal(size=(maxent_lm.BATCH, maxent_lm.N_CLASSES)).astype(np.float32)
    trainer = maxent_lm.Trainer(maxent_lm.Weights.zero())
    tracemalloc.start()
    try:
        trainer._step(0, rows, off, bias=True)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 4 * 4 * off.nbytes


@pytest.mark.parametrize("most", [1, 33, 5000])
def test_language_model_run_sums(most):
    rng = np.random.default_rng(most)
    counts = np.concatenate([rng.integers(1, most + 1, 50), [most, 1]])
    values = rng.normal(size=(70, 3)).astype(np.float32)
    index = rng.integers(0, 70, counts.sum())
    want = [values[i].sum(axis=0, dtype=float) for i in np.split(index, np.cumsum(counts)[:-1])]
    assert np.allclose(maxent_lm.run_sums(values, index, counts), want, rtol=1e-5, atol=1e-3)


def test_language_model_softmax_of_any_logits():
    """Far apart logits, closed members and a target far below the others neither overflow nor vanish."""
    rng = np.random.default_rng(5)
    for spread in (1, 30, 2000):
        x = (rng.normal(size=(200, maxent_lm.WIDTH)) * spread).astype(np.float32)
        target = rng.integers(0, 8, 200)
        x[:, 8:16] = -1e9
        log = maxent_lm.log_softmax(x.astype(float))
        assert np.allclose(maxent_lm.log_likelihood(x.copy(), target), log[np.arange(200), target], rtol=1e-5, atol=1e-4)
        off = -np.exp(log)
        off[np.arange(200), target] += 1
        assert np.allclose(maxent_lm.softmax_off(x.copy(), target), off, atol=1e-4)


def test_language_model_learns(spark):
    out = maxent_lm.op7_maxent_lm(spark, SF).collect()
    docs = {i: t for i, t, _ in _documents()}
    counts = collections.Counter()
    for i, t in docs.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(t.encode().lower().split() + [b""])
    n, v = sum(counts.values()), len(counts)
    for r in out:
        words = docs[r["doc_id"]].encode().lower().split() + [b""]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert abs(base - r["base_score"]) < 1e-6 * abs(base) and r["train_tokens"] == n
        assert r["n_known"] == sum(counts[w] > 0 for w in words) and r["n_tokens"] == len(words)
    held = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def _brute_components(fps, distance):
    n = len(fps)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    root = np.arange(n)
    while True:
        new = np.array([root[near[i]].min() for i in range(n)])
        if (new == root).all():
            return root
        root = new


def _clusters(n, seed):
    rng = np.random.default_rng(seed)
    out = []
    for base in rng.integers(0, 2**63, size=max(1, n // 10), dtype=np.uint64):
        for _ in range(10):
            x = int(base)
            for bit in rng.choice(64, rng.integers(0, 5), replace=False):
                x ^= 1 << int(bit)
            out.append(x)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("n", [5, 60, 400, 1500])
def test_gray_index_links_all(n):
    fps = _clusters(n, n)
    assert (simhash.linked(fps, 3) == _brute_components(fps, 3)).all()


@pytest.mark.parametrize("max_bucket", [6, 20_000])
def test_components_by_brute_force(spark, max_bucket):
    fps = _clusters(300, 9)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r["node"]: r["root"] for r in simhash.components(simhash.bucket_links(df, 3, max_bucket)).collect()}
    root = _brute_components(fps, 3)
    signed = fps.view(np.int64)
    for i, x in enumerate(signed.tolist()):
        members = signed[root == root[i]].tolist()
        assert got.get(x, x) == min(members)


def test_simhash_by_definition():
    import xxhash

    for t in ["A b c d e a b c", "x", "x y", "", " \n", "Ünï Ünï Ünï Ünï"]:
        words = t.encode().lower().split()
        shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        counts = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
        assert simhash.simhash(t.encode()) == sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def test_sampled_pieces():
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    from sentencepiece import SentencePieceProcessor

    model, pieces = SentencePieceProcessor(model_file=path), piece_sampling.load(path)
    hard = ["", "  Hello  wörld\n\tx ▁y 你好𝄞", " ", "\n\n a", "x" * 1000, " ▁▁ ", "a b\x00c"]
    together = piece_sampling.encode_batch(pieces, hard, np.arange(len(hard)))
    for i, (t, ids) in enumerate(zip(hard, together)):
        assert piece_sampling.decode_ids(pieces, ids).decode() == t and model.decode(ids.tolist()) == t
        assert (piece_sampling.encode_batch(pieces, [t], np.array([i]))[0] == ids).all()  # no matter the batch
    n, word = 20_000, "▁thing"
    got = collections.Counter(tuple(x.tolist()) for x in piece_sampling.encode_batch(pieces, ["thing"] * n, np.arange(n)))
    weight, ids = dict(zip(pieces.ids.tolist(), pieces.weights.tolist())), {model.id_to_piece(i): i for i in range(32_000)}
    mass = {}
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, cur = [], word[0]
        for cut, c in zip(cuts, word[1:]):
            parts, cur = (parts + [cur], c) if cut else (parts, cur + c)
        parts.append(cur)
        if all(ids.get(p) in weight for p in parts):
            mass[tuple(ids[p] for p in parts)] = math.exp(sum(weight[ids[p]] for p in parts))
    total = sum(mass.values())
    assert set(got) <= set(mass)
    for k, m in mass.items():
        p = m / total
        assert abs(got[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4
