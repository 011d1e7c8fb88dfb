"""Phrase collocations by weighted acyclic automata.

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those
into words ``[^\\x20\\x09]+``.  Per language, f(phrase) counts all contiguous
occurrences inside pieces.  Phrases of 2 to 5 words with f >= ``least`` are
candidates; the score of a cut into two parts is floor(1000 a n / (l r)), the
lowest cut counts, and a candidate inside a longer one of the same frequency goes.

A *count transducer* is a deterministic acyclic automaton over words, kept in
layers: layer d holds its states of depth d in the order of their phrases, each
with label, parent and weight (the count of the phrase that leads to it).

1. Every task sorts the n-grams of a slice of text and builds a transducer from
   them layer by layer (``from_windows``), cut into *prefix ranges*: a hash of a
   phrase's first words, so that all phrases with those words share a range.
2. Per (language, range), the shards' transducers are united and their weights
   added (``union``); states under ``least`` go, and with them all that continues
   them, for no phrase occurs more often than its prefixes.
3. The parts of all candidates are dealt to the ranges that hold them, sorted into
   an automaton, and composed with the range's transducer (``compose``), which
   gives l and r.

Phrases grow in three passes: words, pairs of frequent words, three to five words
whose pairs are all frequent.  What is frequent reaches the tasks as a bit table of
at most 2 ** ``FILTER_BITS`` bits; a chance hit lets a phrase be counted that need not be,
so the table only saves work and the counts are exact at any size.

The number of ranges follows the bytes of text, so a group's size does not; phrases
of 3 to 5 words are dealt by their first three, and a frequent first word or pair is
spread over all ranges.  Requests for one part are salted.  Whole texts are
read; the working memory follows ``SLICE`` bytes of text or the longest single piece.

Defined results: null texts are empty, a null language is ``und``; repeated rows
count each time; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, saved, slices, table, utf8

LONGEST = 5
SLICE = 8 << 20      # bytes of text in one shard transducer
RANGE = 16 << 20     # bytes of text for each prefix range
FILTER_BITS = 28
SALT = 8

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CUTS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(_UPPER + _CUTS + b"\t", _UPPER.lower() + b"\n" * len(_CUTS) + b" ")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29))


def tokens(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, sorted; word number of every word in order; whether words
    i and i + 1 stand in one piece)."""
    text = np.frombuffer(b"\n".join(texts).translate(_TABLE), np.uint8)
    line = text == 10
    word = (text != 32) & ~line
    edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    piece = np.cumsum(line, dtype=np.int64)[starts]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(text[word])])
    coded = found.dictionary_encode()
    words = coded.dictionary.to_pylist()
    order = sorted(range(len(words)), key=words.__getitem__)
    number = np.empty(len(words), np.int64)
    number[order] = np.arange(len(words))
    return [words[i] for i in order], number[coded.indices.to_numpy(zero_copy_only=False)], piece[1:] == piece[:-1]


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one more word."""
    x = a * _MIX[0] + b
    return (x ^ (x >> _MIX[2])) * _MIX[1]


class Transducer:
    """``words`` (sorted); per layer: ``labels`` (word numbers), ``parents`` (state
    numbers of the layer before) and ``weights``, ordered by phrase."""

    def __init__(self, words: list[bytes], layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.words, self.layers = words, layers

    def keys(self, depth: int) -> np.ndarray:
        """States of a layer as parent * words + label, ascending."""
        labels, parents, _ = self.layers[depth]
        return parents * len(self.words) + labels

    def phrases(self, depth: int) -> list[bytes]:
        """The phrases of depth + 1 words, in the order of their states."""
        at, columns = np.arange(len(self.layers[depth][0])), []
        for d in range(depth, -1, -1):
            labels, parents, _ = self.layers[d]
            columns.append(labels[at].tolist())
            at = parents[at]
        return [b" ".join([self.words[i] for i in row]) for row in zip(*columns[::-1])]

    def dump(self) -> bytes:
        head = struct.pack("<B", len(self.layers)) + b"".join(struct.pack("<I", len(x[0])) for x in self.layers)
        body = b"".join(x[0].astype("<u4").tobytes() + np.bincount(x[1], minlength=n).astype("<u4").tobytes()
                        + x[2].astype("<u8").tobytes()
                        for x, n in zip(self.layers, [1, *(len(x[0]) for x in self.layers)]))
        return zstandard.compress(head + body + b"\n".join(self.words), 1)

    @classmethod
    def load(cls, data: bytes) -> Transducer:
        raw = zstandard.decompress(data)
        sizes = struct.unpack_from(f"<{raw[0]}I", raw, 1)
        at, layers, before = 1 + 4 * len(sizes), [], 1
        for n in sizes:
            labels = np.frombuffer(raw, "<u4", n, at).astype(np.int64)
            fans = np.frombuffer(raw, "<u4", before, at + 4 * n)
            weights = np.frombuffer(raw, "<u8", n, at + 4 * (n + before)).astype(np.int64)
            layers.append((labels, np.repeat(np.arange(before), fans), weights))
            at, before = at + 4 * (n + before) + 8 * n, n
        return cls(raw[at:].split(b"\n") if at < len(raw) else [], layers)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, their summed weights, place of each key among them)."""
    bits = len(keys).bit_length()
    if len(keys) and int(keys.max()).bit_length() + bits < 64:  # key and place in one number sort much faster
        packed = np.sort(keys << bits | np.arange(len(keys)))
        order, ordered = packed & ((1 << bits) - 1), packed >> bits
    else:
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return ordered[first], np.add.reduceat(weights[order], first) if len(first) else weights[:0], place


def from_windows(vocabulary: list[bytes], hashes: np.ndarray, ids: np.ndarray, go_on: np.ndarray, fewest: int,
                 most: int, n_ranges: int) -> Iterator[tuple[int, Transducer]]:
    """(range, transducer) of all windows of ``fewest`` to ``most`` words.

    ``ids`` are word numbers, ``go_on[i]`` says that words i and i + 1 may stand in
    one phrase.  Ranges go by the first ``fewest`` words."""
    n = len(ids)
    inside = np.ones(n, bool)
    for d in range(1, fewest):
        inside[:n - d] &= go_on[d - 1:n - 1]
        inside[max(0, n - d):] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return
    h = hashes[ids[starts]]
    for d in range(1, fewest):
        h = mixed(h, hashes[ids[starts + d]])
    V = len(vocabulary)
    ranges, _, state = _summed((h % np.uint64(n_ranges)).astype(np.int64), np.ones(len(starts), np.int64))
    layers, at = [], starts
    for d in range(most):
        if d >= fewest:
            more = at + d < n
            more[more] &= go_on[at[more] + d - 1]
            at, state = at[more], state[more]
        if not len(at):
            break
        keys, weights, state = _summed(state * V + ids[at + d], np.ones(len(at), np.int64))
        layers.append((keys % V, keys // V, weights))
    # Layers are ordered by range first: cut them into one transducer per range.
    cut = np.arange(len(ranges) + 1)
    parts = [[] for _ in ranges]
    for labels, parents, weights in layers:
        ends = np.searchsorted(parents, cut)
        for r, part in enumerate(parts):
            a, b = ends[r], ends[r + 1]
            if b > a:
                part.append((labels[a:b], parents[a:b] - cut[r], weights[a:b]))
        cut = ends
    for r, part in zip(ranges.tolist(), parts):
        used, places = np.unique(np.concatenate([x[0] for x in part]), return_inverse=True)
        split = np.split(places, np.cumsum([len(x[0]) for x in part])[:-1])
        yield r, Transducer([vocabulary[i] for i in used.tolist()],
                            [(labels, x[1], x[2]) for labels, x in zip(split, part)])


def union(shards: list[Transducer], fewest: int, least: int) -> Transducer:
    """One transducer with the weights of all added; states of ``fewest`` words or
    more with a weight under ``least`` go."""
    words = sorted({w for t in shards for w in t.words})
    number = {w: i for i, w in enumerate(words)}
    renamed = [np.fromiter((number[w] for w in t.words), np.int64, len(t.words)) for t in shards]
    states = [np.zeros(1, np.int64)] * len(shards)  # state of the union for each state of a shard, -1 if dropped
    layers = []
    for d in range(max((len(t.layers) for t in shards), default=0)):
        have = [i for i, t in enumerate(shards) if d < len(t.layers)]
        parents = [states[i][shards[i].layers[d][1]] for i in have]
        keys = np.concatenate([p * len(words) + renamed[i][shards[i].layers[d][0]] for i, p in zip(have, parents)])
        weights = np.concatenate([shards[i].layers[d][2] for i in have])
        alive = np.concatenate(parents) >= 0
        place = np.full(len(keys), -1)
        found, sums, place[alive] = _summed(keys[alive], weights[alive])
        if d + 1 >= fewest:
            kept = sums >= least
            renumber = np.where(kept, np.cumsum(kept) - 1, -1)
            found, sums = found[kept], sums[kept]
            place[alive] = renumber[place[alive]]
        if not len(found):
            break
        layers.append((found % len(words), found // len(words), sums))
        for i, part in zip(have, np.split(place, np.cumsum([len(p) for p in parents])[:-1])):
            states[i] = part
    return Transducer(words if layers else [], layers)


def compose(asked: list[bytes], counts: Transducer) -> np.ndarray:
    """The weight of every asked phrase (0 where the transducer has none).

    The phrases are the paths of an acyclic automaton of their own; both are walked
    together, layer by layer: a pair of states goes on where both have the label."""
    number = {w: i for i, w in enumerate(counts.words)}
    split = [p.split(b" ") for p in asked]
    state, out = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
    size = np.array([len(p) for p in split], np.int64)
    for d, (_, _, weights) in enumerate(counts.layers):
        label = np.fromiter((number.get(p[d], -1) if d < len(p) else -1 for p in split), np.int64, len(split))
        keys, wanted = counts.keys(d), state * len(counts.words) + label
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        state = np.where((state >= 0) & (label >= 0) & (keys[at] == wanted), at, -1)
        ends = (size == d + 1) & (state >= 0)
        out[ends] = weights[state[ends]]
    return out


def range_of(phrases: list[bytes], lang: str, n_ranges: int) -> list[int]:
    """The range that holds a phrase, by its first three words at most."""
    split = [p.split(b" ")[:3] for p in phrases]
    words = sorted({w for p in split for w in p})
    at = {w: i for i, w in enumerate(words)}
    hashes = word_hashes(words, lang)
    out = np.zeros(len(split), np.uint64)
    for n in (1, 2, 3):
        rows = [i for i, p in enumerate(split) if len(p) == n]
        h = hashes[[at[split[i][0]] for i in rows]] if rows else out[:0]
        for d in range(1, n):
            h = mixed(h, hashes[[at[split[i][d]] for i in rows]]) if rows else h
        out[rows] = h % np.uint64(n_ranges)
    return out.astype(np.int64).tolist()


class _Passes:
    """The three passes over the texts and what they leave behind."""

    def __init__(self, texts: DataFrame, least: int, n_ranges: int):
        self.texts, self.least, self.n_ranges = texts, least, n_ranges
        self.spark = texts.sparkSession

    def count(self, fewest: int, most: int, seen: tuple = ()) -> DataFrame:
        """lang, level (fewest), range, total (words, of the first pass), bits
        (places of frequent words or pairs in a bit table), data (transducer)."""
        least, n_ranges = self.least, self.n_ranges

        def shard(lang: str, texts: list[bytes]) -> Iterator[tuple]:
            vocabulary, ids, go_on = tokens(texts)
            hashes = word_hashes(vocabulary, lang)
            if seen and len(ids):
                ok = seen[0].value.holds(hashes)
                go_on &= ok[ids[:-1]] & ok[ids[1:]]
            if len(seen) > 1 and len(ids):
                pairs = np.flatnonzero(go_on)
                go_on[pairs] = seen[1].value.holds(mixed(hashes[ids[pairs]], hashes[ids[pairs + 1]]))
            for r, t in from_windows(vocabulary, hashes, ids, go_on, fewest, most, n_ranges):
                yield lang, r, t.dump()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = {}, 0

            def flush():
                rows = [x for lang, texts in held.items() for x in shard(lang, texts)]
                held.clear()
                return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                                   pa.array([r[1] for r in rows], pa.int64()),
                                                   pa.array([r[2] for r in rows], pa.binary())], ["lang", "range", "data"])

            for batch in batches:
                for b in slices(batch, 1, SLICE // 4):
                    for lang, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                        for part in cut(text, SLICE // 4):
                            held.setdefault(lang, []).append(part)
                            size += len(part)
                            if size >= SLICE:
                                yield flush()
                                size = 0
            yield flush()

        def unite(pdf: pd.DataFrame) -> pd.DataFrame:
            lang, r = pdf["lang"].iloc[0], pdf["range"].iloc[0]
            shards = [Transducer.load(x) for x in pdf["data"]]
            total = sum(int(t.layers[0][2].sum()) for t in shards) if fewest == 1 else 0
            out, bits = union(shards, fewest, least), []
            if fewest < 3 and len(out.layers) >= fewest:
                hashes = word_hashes(out.words, lang)
                labels, parents, _ = out.layers[-1]
                h = hashes[labels] if fewest == 1 else mixed(hashes[out.layers[0][0]][parents], hashes[labels])
                bits = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            return pd.DataFrame({"lang": [lang], "level": [fewest], "range": [r], "total": [total],
                                 "bits": [list(bits)], "data": [out.dump()]})

        shards = self.texts.mapInArrow(run, "lang string, range long, data binary")
        out = shards.groupBy("lang", "range").applyInPandas(
            unite, "lang string, level int, range long, total long, bits array<long>, data binary")
        return saved(out, f"collocations-{fewest}")

    def table(self, counted: DataFrame):
        """The bit table of what a pass found frequent, broadcast: of 16 bits an
        item, and at most 2 ** FILTER_BITS bits in all."""
        items = counted.agg(F.coalesce(F.sum(F.size("bits")), F.lit(0))).first()[0]
        log2 = min(FILTER_BITS, max(16, (16 * items).bit_length()))
        chunk = max(0, log2 - 12)
        at = F.shiftright("bit", FILTER_BITS - log2)
        places = counted.select(F.explode("bits").alias("bit")).select(at.alias("at")).distinct()

        def pack(pdf: pd.DataFrame) -> pd.DataFrame:
            flags = np.zeros(1 << chunk, np.uint8)
            flags[pdf["at"].to_numpy() & ((1 << chunk) - 1)] = 1
            return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "flags": [np.packbits(flags).tobytes()]})

        packed = places.withColumn("chunk", F.shiftright("at", chunk)).groupBy("chunk") \
            .applyInPandas(pack, "chunk long, flags binary")
        bits = np.zeros((1 << log2) // 8, np.uint8)
        for r in packed.toLocalIterator():  # at most 4,096 rows, 2 ** FILTER_BITS bits in all
            size = (1 << chunk) // 8
            bits[r["chunk"] * size:(r["chunk"] + 1) * size] = np.frombuffer(r["flags"], np.uint8)
        return self.spark.sparkContext.broadcast(BitTable(bits, log2))


class BitTable:
    def __init__(self, bits: np.ndarray, log2: int):
        self.bits, self.shift = bits, np.uint64(64 - log2)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 > 0


def cut(text: bytes, most: int) -> Iterator[bytes]:
    """The text in parts of about ``most`` bytes that end between pieces."""
    at = 0
    while len(text) - at > most:
        ends = [end for c in _CUTS if (end := text.rfind(bytes([c]), at, at + most)) >= 0] \
            or [min((end for c in _CUTS if (end := text.find(bytes([c]), at + most)) >= 0), default=len(text))]
        yield text[at:max(ends)]
        at = max(ends) + 1
    yield text[at:]


def transducers(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100) -> DataFrame:
    """The count transducers of all phrases of 1 to 5 words found ``least`` times or
    more: lang, level (1, 2, 3: words, pairs, longer), range, n_ranges, total, data."""
    texts = docs.select(F.coalesce(col(lang_col), F.lit("und")).alias("lang"), col(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = _Passes(texts, least, 8 + size // RANGE)
    words = passes.count(1, 1)
    frequent = passes.table(words)
    pairs = passes.count(2, 2, (frequent,))
    longer = passes.count(3, LONGEST, (frequent, passes.table(pairs)))
    return words.unionByName(pairs).unionByName(longer).withColumn("n_ranges", F.lit(passes.n_ranges)).drop("bits")


def phrase_counts(counted: DataFrame) -> DataFrame:
    """lang, phrase, words, f of everything in ``transducers``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, level, data in zip(pdf["lang"], pdf["level"], pdf["data"]):
                t = Transducer.load(data)
                for d in range(level - 1, len(t.layers)):
                    yield pd.DataFrame({"lang": lang, "phrase": [p.decode() for p in t.phrases(d)], "words": d + 1,
                                        "f": t.layers[d][2]})

    return counted.select("lang", "level", "data").mapInPandas(run, "lang string, phrase string, words int, f long")


def part_counts(counted: DataFrame) -> DataFrame:
    """For every candidate and cut: lang, phrase, a, k, side (0: first k words, 1:
    the rest), part, f (of that part)."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, level, data, n in zip(pdf["lang"], pdf["level"], pdf["data"], pdf["n_ranges"]):
                t = Transducer.load(data)
                for d in range(max(1, level - 1), len(t.layers)):
                    rows = []
                    for phrase, a in zip(t.phrases(d), t.layers[d][2].tolist()):
                        words = phrase.split(b" ")
                        for k in range(1, d + 1):
                            rows += [(phrase, a, k, 0, b" ".join(words[:k])), (phrase, a, k, 1, b" ".join(words[k:]))]
                    parts = [r[4] for r in rows]
                    yield pd.DataFrame({
                        "lang": lang, "level": [min(3, p.count(b" ") + 1) for p in parts],
                        "range": range_of(parts, lang, n), "phrase": [r[0].decode() for r in rows],
                        "a": [r[1] for r in rows], "k": [r[2] for r in rows], "side": [r[3] for r in rows],
                        "part": [p.decode() for p in parts]})

    asked = counted.select("lang", "level", "data", "n_ranges").mapInPandas(
        ask, "lang string, level int, range long, phrase string, a long, k int, side int, part string")
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALT)).cast("int")
    held = counted.select("lang", "level", "range", "data",
                          F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))

    def answer(requests: pd.DataFrame, held_: pd.DataFrame) -> pd.DataFrame:
        out = requests[["lang", "phrase", "a", "k", "side", "part"]]
        f = np.zeros(len(out), np.int64)
        for data in held_["data"]:
            f = f + compose([p.encode() for p in out["part"]], Transducer.load(data))
        return out.assign(f=f)

    by = ["lang", "level", "range", "salt"]
    return asked.withColumn("salt", salt).groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(
        answer, "lang string, phrase string, a long, k int, side int, part string, f long")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100,
                 best: int | None = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``best`` phrases
    (None: all, without rank), by score, a (both descending) and phrase."""
    counted = transducers(docs, text_col, lang_col, least)
    answers = saved(part_counts(counted), "collocation-parts")
    totals = counted.where("level = 1").groupBy("lang").agg(F.sum("total").alias("n"))
    # A phrase inside a longer one of its frequency is also inside one that is a word longer.
    whole = F.size(F.split("phrase", " "))
    next_shorter = ((F.col("side") == 0) & (F.col("k") == whole - 1)) | ((F.col("side") == 1) & (F.col("k") == 1))
    inside = answers.where(next_shorter & (F.col("f") == F.col("a"))).select("lang", F.col("part").alias("phrase")) \
        .distinct()
    found = {(k, s): F.max(F.when((F.col("k") == k) & (F.col("side") == s), F.col("f")))
             for k in range(1, LONGEST) for s in (0, 1)}
    wide = answers.groupBy("lang", "phrase", "a").agg(*[c.alias(f"f{k}{s}") for (k, s), c in found.items()]) \
        .join(inside, ["lang", "phrase"], "left_anti").join(totals, "lang")
    big = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    cuts = [F.expr(f"CASE WHEN f{k}0 IS NOT NULL THEN named_struct('score', ({big('a')} * {big('n')} * "
                   f"CAST(1000 AS DECIMAL(4, 0))) div ({big(f'f{k}0')} * {big(f'f{k}1')}), 'k', {k}, "
                   f"'l', f{k}0, 'r', f{k}1) END") for k in range(1, LONGEST)]
    cut_ = F.array_min(F.filter(F.array(*cuts), lambda x: x.isNotNull()))
    scored = wide.select("lang", "phrase", "a", "n", cut_.alias("cut")).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").cast("long").alias("score"))
    if best is None:
        return scored
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=100, best=2000)


OP12_SQL = r"""
WITH pieces AS (
    SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM (
        SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                        'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
counts AS (SELECT lang, m, phrase, count(*) AS f FROM (
    SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' ')))
           AS phrase FROM split, (VALUES (1), (2), (3), (4), (5)) AS t(m)) GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m >= 2 AND f >= 100),
inside AS (SELECT lang, array_to_string(w[s:e], ' ') AS phrase, max(a) AS most FROM (
    SELECT lang, w, m, a, s, unnest(range(s + 1, m + 1)) AS e FROM (
        SELECT lang, w, m, a, unnest(range(1, m)) AS s FROM candidates)) WHERE e - s + 1 < m GROUP BY ALL),
kept AS (SELECT c.* FROM candidates c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
         WHERE i.most IS NULL OR i.most < c.a),
cuts AS (SELECT c.*, t.n, l.f AS l, r.f AS r,
                (1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS score
         FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) c JOIN totals t ON t.lang = c.lang
         JOIN counts l ON l.lang = c.lang AND l.m = c.k AND l.phrase = array_to_string(c.w[1:c.k], ' ')
         JOIN counts r ON r.lang = c.lang AND r.m = c.m - c.k AND r.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
       a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest QUALIFY rank <= 2000
"""

QUERIES = {"op12_collocations": op12_collocations}
ORACLES = {"op12_collocations": OP12_SQL}
