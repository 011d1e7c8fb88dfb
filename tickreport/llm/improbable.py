"""Document fingerprints: a digest of improbable byte features.

Every window of ``WIDTH`` bytes is a feature with an entropy score.  How often a
score occurs in the corpus gives its rarity rank.  Among ``WIDTH`` consecutive
features the rarest (leftmost on ties) gains a point; features with ``POPULAR``
points or more are selected.  Selected features, in order and without repeats,
fill a chain of Bloom filters of ``FILTER_BITS`` bits, ``PER_FILTER`` features
each with five bits a feature.  Two digests are as alike as the bits that their
best matching filters share, beyond what chance gives.

The score histogram covers all texts and is a grouped sum of 1001 numbers.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, col, slices, table, utf8

WIDTH = 64
POPULAR = 16
#: Texts of fewer bytes need fewer points, in proportion.
SHORT = 1024
FILTER_BITS = 2048
PER_FILTER = 160
SCORES = 1001

_P = np.arange(WIDTH + 1) / WIDTH
#: What a byte value found 0..WIDTH times adds to the entropy, 6 bits being 10**6.
_PART = np.round(-_P * np.log2(np.where(_P > 0, _P, 1)) / np.log2(WIDTH) * 1e6).astype(np.int64)


def entropy_scores(buf: np.ndarray) -> np.ndarray:
    """The score (0..1000) of each window of ``buf`` (uint8), from the counts that
    change as the window moves by a byte."""
    n = len(buf)
    if n < WIDTH:
        return np.zeros(0, np.int64)
    ahead, back = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    block = 1 << 17  # stays in a core's cache
    for lo in range(0, n, block):
        part = buf[lo:min(n, lo + block + WIDTH)]
        a, b = ahead[lo:lo + block], back[lo:lo + block + WIDTH]
        m = len(a)
        for shift in range(1, WIDTH):
            k = min(m, len(part) - shift)
            if k > 0:
                same = part[:k] == part[shift:shift + k]
                a[:k] += same
                b[shift:shift + k] += same
    out, in_ = ahead[:n - WIDTH].astype(np.int64) + 1, back[WIDTH:].astype(np.int64)
    change = _PART[out - 1] - _PART[out] + _PART[in_ + 1] - _PART[in_]
    first = _PART[np.bincount(buf[:WIDTH], minlength=256)].sum()
    return np.clip(np.concatenate([[first], first + np.cumsum(change)]) // 1000, 0, SCORES - 1)


def _layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts end to end, where each begins and ends, and which windows lie in one text."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    inside = np.zeros(len(buf) + 1, np.int32)
    long = (ends - starts) >= WIDTH
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - WIDTH + 1, -1)
    return buf, starts, ends, np.cumsum(inside)[:max(0, len(buf) - WIDTH + 1)] > 0


def score_histogram(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many windows of all texts have each score."""
    schema = T.StructType([T.StructField("score", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches):
        total = np.zeros(SCORES, np.int64)
        for b in batches:
            for part in slices(b, 0, 1 << 20):
                buf, _, _, inside = _layout(utf8(part.column(0)))
                total += np.bincount(entropy_scores(buf)[inside], minlength=SCORES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SCORES, dtype=np.int32)), pa.array(total)], schema.names)

    rows = docs.select(col(text_col).alias("text")).mapInArrow(run, schema).groupBy("score").agg(F.sum("n").alias("n"))
    out = np.zeros(SCORES, np.int64)
    for score, n in rows.collect():  # SCORES rows
        out[score] = n
    return out


def rarity(histogram: np.ndarray) -> np.ndarray:
    """The rank of each score, 0 for the rarest; ties go to the lower score."""
    order = np.lexsort([np.arange(SCORES), histogram])
    rank = np.empty(SCORES, np.int64)
    rank[order] = np.arange(SCORES)
    return rank


class Digest:
    """A chain of filters: their bits as integers, and the features in all."""

    def __init__(self, filters: list[int], features: int):
        self.filters, self.features = filters, features

    def __str__(self) -> str:
        raw = b"".join(f.to_bytes(FILTER_BITS // 8, "little") for f in self.filters)
        return f"{self.features}:{base64.b64encode(raw).decode()}"

    @classmethod
    def parse(cls, text: str) -> "Digest":
        n, _, raw = text.partition(":")
        raw, size = base64.b64decode(raw), FILTER_BITS // 8
        return cls([int.from_bytes(raw[i:i + size], "little") for i in range(0, len(raw), size)], int(n))

    def weights(self) -> list[int]:
        return [min(PER_FILTER, self.features - i * PER_FILTER) for i in range(len(self.filters))]


def likeness(a: Digest, b: Digest) -> float:
    """0 to 1, the same in either order: the mean, by features, over the filters of
    the shorter chain of the best overlap with a filter of the other.  Empty
    digests are alike, and unlike any other."""
    if not a.filters or not b.filters:
        return float(a.filters == b.filters)
    if len(a.filters) == len(b.filters) and a.filters > b.filters or len(a.filters) > len(b.filters):
        a, b = b, a
    total = 0.0
    pops = [f.bit_count() for f in b.filters]
    for f, weight in zip(a.filters, a.weights()):
        n, best = f.bit_count(), 0.0
        for g, m in zip(b.filters, pops):
            chance = n * m / FILTER_BITS
            most = min(n, m) - chance
            if most > 0:
                best = max(best, ((f & g).bit_count() - chance) / most)
        total += weight * best
    return min(1.0, total / a.features)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def digests(texts: list[bytes], rank: np.ndarray) -> list[Digest]:
    """Digests of whole texts.  Texts of less than ``SHORT`` bytes need fewer points
    in proportion, those without ``WIDTH`` features none but rarity; a text shorter
    than a window is one feature (padded); the empty text has none."""
    buf, starts, ends, inside = _layout(texts)
    n = len(inside)
    picked, owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n:
        key = (rank[entropy_scores(buf)].astype(np.uint64) << np.uint64(40)) | np.arange(n, dtype=np.uint64)
        key[~inside] = ~np.uint64(0)
        least = key
        span = 1
        while span < WIDTH and len(least) > span:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        points = np.zeros(n, np.int64)
        if span == WIDTH:
            runs = np.cumsum(np.concatenate([[0], inside]))
            whole = runs[WIDTH:] - runs[:-WIDTH] == WIDTH
            text = np.repeat(np.arange(len(texts)), ends - starts)
            whole &= text[:len(whole)] == text[WIDTH - 1:WIDTH - 1 + len(whole)]
            points = np.bincount((least[whole] & np.uint64((1 << 40) - 1)).astype(np.int64), minlength=n)
        picked = np.flatnonzero(points)
        owner = np.searchsorted(ends, picked, "right")
        need = np.clip((ends - starts) * POPULAR // SHORT, 1, POPULAR)
        popular = points[picked] >= need[owner]
        picked, owner = picked[popular], owner[popular]
    chosen = np.bincount(owner, minlength=len(texts))
    more = []  # texts too short for points have the rarest feature of each eight
    for i in np.flatnonzero((chosen == 0) & (ends - starts >= WIDTH)).tolist():
        own = key[starts[i]:ends[i] - WIDTH + 1]
        more += {starts[i] + j + int(own[j:j + 8].argmin()) for j in range(max(1, len(own) - 7))}
    if more:
        picked = np.sort(np.concatenate([picked, np.array(more, np.int64)]))
        owner = np.searchsorted(ends, picked, "right")
    rows = buf[picked[:, None] + np.arange(WIDTH)] if len(picked) else np.zeros((0, WIDTH), np.uint8)
    short = [i for i in range(len(texts)) if 0 < len(texts[i]) < WIDTH]
    if short:
        padded = np.frombuffer(b"".join(texts[i].ljust(WIDTH, b"\0") for i in short), np.uint8).reshape(-1, WIDTH)
        rows, owner = np.concatenate([rows, padded]), np.concatenate([owner, np.array(short, np.int64)])
        order = np.argsort(owner, kind="stable")
        rows, owner = rows[order], owner[order]
    hashes = np.zeros(len(rows), np.uint64)
    for k, words in enumerate(np.ascontiguousarray(rows).view("<u8").T):
        hashes = (hashes ^ words ^ np.uint64(k)) * _MIX
        hashes ^= hashes >> np.uint64(29)
    out, first = [], np.searchsorted(owner, np.arange(len(texts) + 1))
    bits = ((hashes[:, None] >> (np.uint64(11) * np.arange(5, dtype=np.uint64))) & np.uint64(FILTER_BITS - 1))
    for i in range(len(texts)):
        lo, hi = first[i], first[i + 1]
        _, at = np.unique(hashes[lo:hi], return_index=True)
        own = bits[lo:hi][np.sort(at)].astype(np.int64)
        filters = []
        for j in range(0, len(own), PER_FILTER):
            field = np.zeros(FILTER_BITS, np.uint8)
            field[own[j:j + PER_FILTER].ravel()] = 1
            filters.append(int.from_bytes(np.packbits(field, bitorder="little").tobytes(), "little"))
        out.append(Digest(filters, len(own)))
    return out


def fingerprint(docs: DataFrame, rank: np.ndarray, text_col: str = "text", keep: list[str] | None = None,
                name: str = "fingerprint") -> DataFrame:
    """``keep`` columns (default all) and the digest of the whole text as a string;
    null is empty, equal texts have equal digests, an empty table stays empty."""

    def factory():
        return lambda texts: [pa.array([str(d) for d in digests(utf8(texts), rank)])]

    return append_columns(docs, text_col, [T.StructField(name, T.StringType())], factory, keep, most=1 << 20)


def with_next(docs: DataFrame, text_col: str, id_col: str, process, schema: T.StructType) -> DataFrame:
    """``process(ids, texts, next_texts)`` -> Arrow columns of ``schema``, for each
    document and the next by ascending id (after the last: the first).

    Documents are dealt once, to runs of ids cut at quantiles; a run also gets the
    document after its last.  Ids are numbers; null is the smallest; rows of one
    id are ordered by text.  Runs hold about equally many ids, so of no key many."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    cuts = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    # The number of cuts below the id, by bisection: a row looks at log2(n) of them.
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    run = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: at + F.when(
        F.get(F.lit(cuts), at + step - 1) < F.col("id"), step).otherwise(0)) if cuts else F.lit(0)
    rows = rows.withColumn("run", F.coalesce(F.when(F.col("id").isNull(), 0).otherwise(run), F.lit(0)))
    # One row per run: its first id, null if it has a null id.
    first = rows.groupBy("run").agg(F.min("id").alias("id"), F.max(F.col("id").isNull()).alias("null")).collect()
    first = sorted((r["run"], None if r["null"] else r["id"]) for r in first)
    if first:
        heads, of = {}, {}  # by run: its first id, and the run before it
        for i, (r, x) in enumerate(first):
            heads[r], of[r] = x, first[i - 1][0]
        by_run = lambda d, kind: F.get(F.lit([d.get(r) for r in range(first[-1][0] + 1)]).cast(kind), F.col("run"))
        before = F.when(F.col("id") == by_run(heads, T.ArrayType(rows.schema["id"].dataType)),
                        by_run(of, T.ArrayType(T.IntegerType())))
        if first[0][1] is None:
            before = F.when(F.col("id").isNull(), first[-1][0]).otherwise(before)
        place = lambda r, extra: F.struct(r.cast("int").alias("r"), F.lit(extra).alias("extra"))
        rows = rows.select("id", "text", F.inline(F.when(before.isNotNull(), F.array(
            place(F.col("run"), 0), place(before, 1))).otherwise(F.array(place(F.col("run"), 0)))))
    else:
        rows = rows.select("id", "text", F.col("run").cast("int").alias("r"), F.lit(0).alias("extra"))
    dealt = rows.repartitionById(n, F.col("r")).sortWithinPartitions("r", "extra", "id", "text")  # a run, a task

    def stream(batches):
        held: list[tuple] = []
        kind = None
        for whole in batches:
            kind = whole.column(0).type
            for b in slices(whole, 1, 1 << 20):
                now = held + list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(),
                                      b.column(3).to_pylist()))
                held = now[-1:]
                pairs = [(x, y) for x, y in zip(now, now[1:]) if not x[3] and x[2] == y[2]]
                if pairs:
                    got = process([x[1] for x, _ in pairs], [y[1] for _, y in pairs])
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x, _ in pairs], kind), *got], schema.names)

    return dealt.select("id", "text", "r", "extra").mapInArrow(stream, schema)


def edited(text: str, next_text: str) -> str:
    """``text`` with its last quarter replaced by as much of the next document's start."""
    k = len(text) // 4
    return text[:len(text) - k] + next_text[:k]


def op3_improbable_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rank = rarity(score_histogram(docs))

    def process(texts: list[str], following: list[str]) -> list[pa.Array]:
        changed = [edited(a, b).encode() for a, b in zip(texts, following)]
        own = digests([t.encode() for t in texts] + [t.encode() for t in following[-1:]], rank)
        after = [own[i + 1] if i + 1 < len(texts) and following[i] == texts[i + 1] else None
                 for i in range(len(texts))]
        after[-1] = own[-1]
        missing = [i for i, d in enumerate(after) if d is None]  # where one run ends and another begins
        for i, d in zip(missing, digests([following[i].encode() for i in missing], rank)):
            after[i] = d
        new = digests(changed, rank)
        return [pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in changed]),
                pa.array([str(d) for d in own[:-1]]), pa.array([str(d) for d in new]),
                pa.array([likeness(a, b) for a, b in zip(own, new)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64())]

    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType())])
    return with_next(docs.select(F.col("doc_id").cast("long"), "text"), "text", "doc_id", process, schema)


QUERIES = {"op3_improbable_digest": op3_improbable_digest}
ORACLES: dict[str, str] = {}
