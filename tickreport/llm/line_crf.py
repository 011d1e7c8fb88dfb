"""Quality classifier: a linear-chain conditional random field over lines.

Every line is labelled good or bad from features of its own and of its two
neighbours (shares of character kinds, word lengths, repetition), each cut into
quantile bins.  The chain's forward-backward marginals, weighted by line length,
give a document's share of good text, which a logistic curve maps to the score.

Only documents are labelled, so training starts from the document's label for
all its lines and then lets the model relabel lines of bad documents, at least
one of which stays bad.  Training reads a bounded sample of labelled documents
(``TRAIN_DOCS`` of each class, by hash order, with half of ``TRAIN_LINES`` for
each class; chains are cut every ``TRAIN_CHAIN`` lines, and where a class has too
many lines its longest documents give some of their chains); scoring reads every
whole text.  Tasks make the lines' features, so the driver holds no text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, col, fresh, table, utf8

#: The training sample's bounds: documents of each class, lines in all, lines of a chain.
TRAIN_DOCS = 1500
TRAIN_LINES = 80_000
TRAIN_CHAIN = 64
BINS = 6

_BLANK, _UPPER, _LOWER, _DIGIT, _PUNCT, _SYMBOL, _HIGH = range(7)
_KIND = np.full(256, _SYMBOL, np.uint8)
for _chars, _kind in ((b" \t\n\x0b\x0c\r", _BLANK), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER),
                      (b"abcdefghijklmnopqrstuvwxyz", _LOWER), (b"0123456789", _DIGIT), (b".,;:'\"()-?!", _PUNCT)):
    _KIND[list(_chars)] = _kind
_KIND[128:] = _HIGH
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Lines:
    """Lines of a batch of texts: raw features, byte lengths, and each text's first line."""

    features: np.ndarray
    length: np.ndarray
    first: np.ndarray  # one more than texts


def lines_of(texts: list[bytes]) -> Lines:
    """Raw features of every line; a text without \\n is one line."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(buf == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = ends - starts
    first = np.concatenate([[0], np.cumsum([t.count(b"\n") + 1 for t in texts])]).astype(np.int64)
    n = len(ends)
    kind = _KIND[buf]
    line = np.repeat(np.arange(n), length + 1)
    counts = np.bincount(line * 8 + kind, minlength=8 * n).reshape(n, 8)[:, :7].astype(np.float32)
    counts[:, _BLANK] -= 1  # the \n

    word = kind != _BLANK
    left = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    right = np.flatnonzero(word & ~np.concatenate([word[1:], [False]])) + 1
    # Word and line hashes from prefix sums of a polynomial with an odd base.
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(buf) - 1, _BASE)]))
    prefix = np.concatenate([[np.uint64(0)], np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power)])
    back = np.uint64(pow(int(_BASE), -1, 1 << 64))
    undo = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(buf) - 1, back)]))
    words = (prefix[right] - prefix[left]) * undo[left]
    of = line[left]
    n_words = np.bincount(of, minlength=n).astype(np.float32)
    own = words * _BASE + (of.astype(np.uint64) << np.uint64(40))
    _, at = np.unique(own, return_index=True)
    distinct = np.bincount(of[at], minlength=n).astype(np.float32)
    marked = (kind[right - 1] == _SYMBOL) | (buf[right - 1] == 33)
    single = right - left == 1
    again = np.concatenate([[False], (words[1:] == words[:-1]) & (of[1:] == of[:-1])])
    text = np.repeat(np.arange(len(texts)), np.diff(first)).astype(np.uint64)
    whole = (prefix[ends] - prefix[starts]) * undo[starts] + (text << np.uint64(40))
    _, inverse, times = np.unique(whole, return_inverse=True, return_counts=True)

    size, w = np.maximum(length, 1).astype(np.float32), np.maximum(n_words, 1)
    letters = counts[:, _UPPER] + counts[:, _LOWER] + 1
    features = np.stack([
        np.log1p(length), counts[:, _UPPER] / letters, counts[:, _DIGIT] / size, counts[:, _SYMBOL] / size,
        counts[:, _PUNCT] / size, counts[:, _HIGH] / size, counts[:, _BLANK] / size, size / w,
        np.bincount(of, marked, n) / w, distinct / w, np.bincount(of, single, n) / w, np.log(times[inverse]),
        np.bincount(of, again, n) / w, (n_words - distinct) / np.sqrt(w),
    ], axis=1).astype(np.float32)
    return Lines(features, length, first)


N_FEATURES = 14


def lines_in_parts(texts: list[bytes], most: int = 1 << 20) -> Lines:
    """``lines_of`` for about ``most`` bytes at a time: the same lines in less memory."""
    parts, held, size = [], [], 0
    for t in texts:
        held.append(t)
        size += len(t) + 1
        if size >= most:
            parts.append(lines_of(held))
            held, size = [], 0
    if held:
        parts.append(lines_of(held))
    sizes = np.concatenate([np.diff(p.first) for p in parts])
    return Lines(np.concatenate([p.features for p in parts]), np.concatenate([p.length for p in parts]),
                 np.concatenate([[0], np.cumsum(sizes)]))


def _chain_ends(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = int(first[-1])
    head, tail = np.zeros(n, bool), np.zeros(n, bool)
    head[first[:-1]], tail[first[1:] - 1] = True, True
    return head, tail


def binned(lines: Lines, edges: np.ndarray) -> np.ndarray:
    """(lines, 3 * features) indices into the weights: the line's own bins and its
    neighbours' (a bin of its own stands for no neighbour)."""
    bins = np.stack([np.searchsorted(edges[f], lines.features[:, f], "right") for f in range(N_FEATURES)], axis=1)
    head, tail = _chain_ends(lines.first)
    before, after = np.roll(bins, 1, axis=0), np.roll(bins, -1, axis=0)
    before[head], after[tail] = BINS, BINS
    return np.concatenate([bins, before, after], axis=1) + np.arange(3 * N_FEATURES) * (BINS + 1)


@dataclass
class Model:
    edges: np.ndarray
    weights: np.ndarray  # of the bins, for good against bad
    bias: float
    step: np.ndarray  # 2 x 2 transition scores
    curve: tuple[float, float]  # the document score's slope and offset


def marginals(emission: np.ndarray, step: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and the expected transitions (2 x 2) summed over all chains."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    start, sizes = first[:-1][order], sizes[order]
    n = len(emission)
    scores = np.stack([np.zeros(n), emission], axis=1)
    ahead, back = np.empty((n, 2)), np.zeros((n, 2))
    most = int(sizes[0]) if len(sizes) else 0
    alive = [int(np.searchsorted(-sizes, -t, "left")) for t in range(most + 1)]  # chains longer than t
    for t in range(most):
        at = start[:alive[t]] + t
        if t:
            was = ahead[at - 1]
            ahead[at] = np.logaddexp(was[:, :1] + step[0], was[:, 1:] + step[1])
        else:
            ahead[at] = 0.0
        ahead[at] += scores[at]
    for t in range(most - 2, -1, -1):
        at = start[:alive[t + 1]] + t
        nxt = scores[at + 1] + back[at + 1]
        back[at] = np.stack([np.logaddexp(step[0, 0] + nxt[:, 0], step[0, 1] + nxt[:, 1]),
                             np.logaddexp(step[1, 0] + nxt[:, 0], step[1, 1] + nxt[:, 1])], axis=1)
    both = ahead + back
    total = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - total)
    head, _ = _chain_ends(first)
    at = np.flatnonzero(~head)
    pair = ahead[at - 1][:, :, None] + step + (scores[at] + back[at])[:, None, :] - total[at][:, None, None]
    return good, np.exp(pair).sum(axis=0)


def _fit_chain(index: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = 120,
               rate: float = 0.1, decay: float = 1e-3) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and transitions by gradient ascent (Adam) on the chains' log likelihood."""
    size = 3 * N_FEATURES * (BINS + 1)
    head, _ = _chain_ends(first)
    inner = np.flatnonzero(~head)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[inner - 1].astype(int), label[inner].astype(int)), 1.0)
    theta = np.zeros(size + 5)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    flat, n = index.ravel(), len(index)
    for t in range(1, steps + 1):
        emission = theta[:size][index].sum(axis=1) + theta[size]
        good, pairs = marginals(emission, theta[size + 1:].reshape(2, 2), first)
        off = (label - good) * weight
        grad = np.concatenate([np.bincount(flat, np.repeat(off, index.shape[1]), size), [off.sum()],
                               (seen - pairs).ravel()]) / n - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta[:size], float(theta[size]), theta[size + 1:].reshape(2, 2)


def _document_share(good: np.ndarray, lines: Lines) -> np.ndarray:
    weight = lines.length + 1.0
    return np.add.reduceat(good * weight, lines.first[:-1]) / np.add.reduceat(weight, lines.first[:-1])


def fit(texts: list[bytes], labels: list[int]) -> Model:
    """A model from whole labelled texts.  With one class or none it scores 0.5."""
    return fit_lines(lines_in_parts(texts) if texts else None, labels)


def fit_lines(lines: Lines | None, labels: list[int], halo: np.ndarray | None = None) -> Model:
    """A model from the lines of labelled texts.  Lines in ``halo`` are neighbours
    of a text's chosen chains: they teach nothing themselves."""
    edges = np.zeros((N_FEATURES, BINS - 1), np.float32)
    blank = Model(edges, np.zeros(3 * N_FEATURES * (BINS + 1)), 0.0, np.zeros((2, 2)), (0.0, 0.0))
    if len(set(labels)) < 2:
        return blank
    whole, own = lines, np.ones(len(lines.length), bool) if halo is None else ~halo
    first = np.concatenate([[0], np.cumsum(own)])[whole.first]
    lines = Lines(whole.features[own], whole.length[own], first)
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    for f in range(N_FEATURES):
        values = lines.features[:, f]
        moving = values[values != np.median(values)]  # bins for what differs from the usual value
        edges[f] = np.quantile(moving, quantiles) if len(moving) else values[0]
    index = binned(whole, edges)[own]
    sizes = np.diff(lines.first)
    quality = np.array(labels, float)
    label = np.repeat(quality, sizes)
    text = np.repeat(np.arange(len(labels)), sizes)
    inside = np.arange(len(label)) - np.repeat(lines.first[:-1], sizes)
    chains = np.concatenate([np.flatnonzero(inside % TRAIN_CHAIN == 0), [len(label)]])
    weight = np.minimum(2.0, (lines.length + 1.0) / np.mean(lines.length + 1.0))
    for turn in range(2):
        weights, bias, step = _fit_chain(index, chains, label, weight)
        good, _ = marginals(weights[index].sum(axis=1) + bias, step, lines.first)
        if turn == 0:
            worst = np.full(len(labels), 2.0)
            np.minimum.at(worst, text, good)
            label = np.where(quality[text] == 1, 1.0, ((good > 0.5) & (good > worst[text])).astype(float))
    share = _document_share(good, lines)
    a, b = 0.0, 0.0
    rate = np.clip(share, 1e-6, 1 - 1e-6)
    x = rate - rate.mean()
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-(a * x + b)))
        g, h = p - quality, p * (1 - p) + 1e-9
        hess = np.array([[(h * x * x).sum() + 1e-2, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-2]])
        step_ab = np.linalg.solve(hess, np.array([(g * x).sum() + 1e-2 * a, g.sum() + 1e-2 * b]))
        a, b = a - step_ab[0], b - step_ab[1]
    return Model(edges, weights, bias, step, (float(a), float(b - a * rate.mean())))


def score(model: Model, texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Document scores, and P(good) of each text's lines."""
    if not texts:
        return np.zeros(0), []
    lines = lines_of(texts)
    good, _ = marginals(model.weights[binned(lines, model.edges)].sum(axis=1) + model.bias, model.step, lines.first)
    a, b = model.curve
    return 1 / (1 + np.exp(-(a * _document_share(good, lines) + b))), np.split(good, lines.first[1:-1])


def shares(sizes: list[int], most: int) -> list[int]:
    """Lines to take of each text, ``most`` in all: whole texts, or where they are
    too many, the same number of chains at most from each.  If one chain of each is
    still too much, the texts before the bound give theirs."""
    if sum(sizes) <= most:
        return list(sizes)
    low, high = 1, max(1, max(sizes) // TRAIN_CHAIN)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if sum(min(n, mid * TRAIN_CHAIN) for n in sizes) <= most else (low, mid - 1)
    out, left = [], most
    for n in sizes:
        n = min(n, low * TRAIN_CHAIN)
        out.append(n if n <= left else 0)
        left -= out[-1]
    return out


def _chosen(docs: DataFrame, plan: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(at, features, length, halo) of the planned lines, made in the tasks."""
    schema = T.StructType([T.StructField("at", T.LongType()), T.StructField("features", T.BinaryType()),
                           T.StructField("length", T.BinaryType()), T.StructField("halo", T.BinaryType())])

    def run(batches):
        for b in batches:
            for i, text in enumerate(utf8(b.column(3))):
                at, start, take = (b.column(k)[i].as_py() for k in range(3))
                lines = lines_of([text])
                head, end = max(0, start - 1), min(len(lines.length), start + take + 1)
                inside = np.arange(head, end)
                halo = (inside < start) | (inside >= start + take)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int64()), pa.array([lines.features[head:end].tobytes()], pa.binary()),
                     pa.array([lines.length[head:end].astype(np.int64).tobytes()], pa.binary()),
                     pa.array([halo.tobytes()], pa.binary())], schema.names)

    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).where("text IS NOT NULL")
    picked = texts.join(F.broadcast(plan), (F.col("id") == F.col("p_id")) & (F.xxhash64("text") == F.col("p_hash")))
    return picked.select("p_at", "p_start", "p_take", "text").mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
          label_col: str = "quality", train_docs: int = TRAIN_DOCS, train_lines: int = TRAIN_LINES) -> Model:
    """A model from ``train_docs`` documents of each class at most, taken by the
    hash order of the id, and ``train_lines`` lines in all (half for each class,
    and what one class leaves goes to the other).  Rows with a null id, label or
    text teach nothing; of an id's texts one does."""
    known = labels.where(col(id_col).isNotNull() & col(label_col).isNotNull()) \
        .groupBy(col(id_col).alias("id")).agg(F.min(col(label_col)).alias("y"))
    picks = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(train_docs)
        picks = part if picks is None else picks.unionByName(part)
    sample = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).join(F.broadcast(picks), "id")
    n_lines = (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long")
    rows = sample.where("text IS NOT NULL").groupBy("id") \
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), n_lines.alias("lines"))).alias("s"), F.min("y").alias("y")) \
        .orderBy(F.xxhash64("id"), "id").collect()  # the picked ids' numbers
    ys = [int(r["y"]) for r in rows]
    total = {y: sum(r["s"]["lines"] for r, x in zip(rows, ys) if x == y) for y in (0, 1)}
    take = [0] * len(rows)
    for y in (0, 1):
        mine = [i for i, x in enumerate(ys) if x == y]
        most = max(train_lines // 2, train_lines - total[1 - y])
        for i, n in zip(mine, shares([rows[i]["s"]["lines"] for i in mine], most)):
            take[i] = n
    plan = []
    for i, (r, n) in enumerate(zip(rows, take)):
        if n:
            cuts = (r["s"]["lines"] - n) // TRAIN_CHAIN + 1  # starts of a run of n lines
            plan.append((r["id"], r["s"]["hash"], i, r["s"]["hash"] % cuts * TRAIN_CHAIN, n))
    if len({ys[p[2]] for p in plan}) < 2:
        return fit_lines(None, [])
    schema = T.StructType([T.StructField("p_id", docs.schema[id_col].dataType), T.StructField("p_hash", T.LongType()),
                           *(T.StructField(x, T.LongType()) for x in ("p_at", "p_start", "p_take"))])
    chosen = _chosen(docs, docs.sparkSession.createDataFrame(plan, schema), text_col, id_col)
    got = sorted({r["at"]: r for r in chosen.collect()}.items())  # train_lines lines' numbers and the halo, once an id
    length = [np.frombuffer(r["length"], np.int64) for _, r in got]
    lines = Lines(np.concatenate([np.frombuffer(r["features"], np.float32) for _, r in got]).reshape(-1, N_FEATURES),
                  np.concatenate(length), np.concatenate([[0], np.cumsum([len(n) for n in length])]))
    return fit_lines(lines, [ys[i] for i, _ in got], np.concatenate([np.frombuffer(r["halo"], bool) for _, r in got]))


def quality_scores(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None,
                   name: str = "score") -> DataFrame:
    """``keep`` columns (default all) and the score, 0 to 1.  Null and empty texts
    are one empty line; repeated rows score alike; an empty table stays empty."""

    def factory():
        return lambda texts: [pa.array(score(model, utf8(texts))[0])]

    return append_columns(docs, text_col, [T.StructField(name, T.DoubleType())], factory, keep, most=1 << 20)


def line_labels(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and P(good) of every line, in order (array of double)."""

    def factory():
        return lambda texts: [pa.array([x.tolist() for x in score(model, utf8(texts))[1]], pa.list_(pa.float64()))]

    name = fresh(docs, "line_good")[0]
    return append_columns(docs, text_col, [T.StructField(name, T.ArrayType(T.DoubleType()))], factory, keep,
                          most=1 << 20)


def fold(id_: Column) -> Column:
    """crc32 of the id as text, modulo 3."""
    return F.crc32(id_.cast("string").cast("binary")) % 3


def train_on_labels(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of op2 and of the pipeline: rows of fold 1 are held out."""
    return train(docs, labels.where(fold(F.col("doc_id")) != 1))


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality_scores(docs, train_on_labels(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op2_quality_crf": op2_quality_crf}
ORACLES: dict[str, str] = {}
