"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

Tokens are words and one end per text.  Every known word has a class: the
``FREQUENT`` most frequent words form classes of ``WIDTH``, the others fall into
classes by frequency band and word ending.  P(word | history) is

* P(class | history): a softmax over hashed features of the history (a bias, the
  words one, two and three back, and the pair of the last two), times
* P(word | class, history): a softmax over the same features joined with the
  class for frequent words, and the smoothed relative frequency in its class
  for the others.  A word that training has not seen is one more outcome of the
  last band's class of its ending, so the probabilities sum to 1.

Counts cover all training texts: tasks count words, one grouped sum makes the
vocabulary table.  Training reads every training text once, in ``ROUNDS`` parts:
from the broadcast weights each task takes gradient steps on its texts, and the
changes are averaged row by row (weighted by how often a row was used) as a
shuffle of weight blocks.  The weights' size is fixed by parameters.  Words
outside the ``TOP`` most frequent are looked up by a join with the vocabulary.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, fresh, saved, slices, table, utf8

TOP = 100_000  # words with ids in every task
FREQUENT, WIDTH = 512, 32
BANDS = (8_192, 32_768)  # ranks at which a frequency band ends
ENDINGS = 4
ROWS = 1 << 14  # hashed feature rows of either softmax
BLOCKS = 32  # parts in which weights travel
ROUNDS = 2
BATCH = 8192  # tokens of a gradient step
PART = 2048  # tokens whose logits are held at once
RUN = 32  # rows that are summed place by place
RATE = 0.5
END = b""  # no word is empty

N_CLASSES = FREQUENT // WIDTH + (len(BANDS) + 2) * ENDINGS
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                np.uint64)


def words_of(text: bytes) -> list[bytes]:
    """Words of non-blanks, A-Z lower-cased (both in ASCII terms)."""
    return text.lower().split()


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


class WordIds(dict):
    """Ids of the top words; any other word has the id of its ending."""

    def __init__(self, top: list[tuple[bytes, int]]):
        super().__init__((w, i) for i, (w, _) in enumerate(top))

    def __missing__(self, word: bytes) -> int:
        return len(self) + (ending(word) if word else 0)


class Vocabulary:
    """Ids, classes and in-class probabilities.  Ids 0..K-1 are the top words by
    falling count, K..K+ENDINGS-1 all other words by ending, then the pad."""

    def __init__(self, top: list[tuple[bytes, int]], rest: list[tuple[int, int]], total: int, size: int):
        self.ids = WordIds(top)
        self.words = pa.array([w for w, _ in top], pa.binary())
        k = self.k = len(top)
        self.pad = k + ENDINGS
        self.total, self.size = total, size
        rank = np.arange(k)
        ends = np.array([ending(w) for w, _ in top] + list(range(ENDINGS)), np.int64)
        band = np.concatenate([np.searchsorted(BANDS, rank, "right"), np.full(ENDINGS, len(BANDS) + 1)])
        self.cls = FREQUENT // WIDTH + band * ENDINGS + ends
        self.cls[:min(k, FREQUENT)] = rank[:FREQUENT] // WIDTH
        self.member = np.full(k + ENDINGS, -1)
        self.member[:min(k, FREQUENT)] = rank[:FREQUENT] % WIDTH
        mass = np.array([c + 0.5 for _, c in top] + [n + 0.5 * (v + 1) for n, v in rest])
        in_class = np.bincount(self.cls, mass, N_CLASSES)
        own = mass.copy()
        own[k:] = 1.0  # the other words' own mass comes from the join
        self.within = np.log(own) - np.log(in_class[self.cls])
        self.within[:min(k, FREQUENT)] = 0.0
        denominator = total + 0.5 * (size + 1)
        self.base = np.log10(np.array([c + 0.5 for _, c in top] + [1.0] * ENDINGS) / denominator)
        filled = np.arange(FREQUENT) < k
        self.open = np.where(filled.reshape(-1, WIDTH), 0.0, -1e9).astype(np.float32)

    def encode(self, words: pa.Array) -> np.ndarray:
        found = pc.index_in(words, value_set=self.words)
        ids = found.fill_null(-1).to_numpy().astype(np.int64)
        other = np.flatnonzero(ids < 0)
        if len(other):  # by ending
            ends = pc.binary_slice(words.take(pa.array(other)), -2).dictionary_encode()
            by_end = np.array([self.ids.__missing__(e) for e in ends.dictionary.to_pylist()], np.int64)
            ids[other] = by_end[ends.indices.to_numpy()]
        return ids


def features(seq: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(tokens, 5) hashed rows of the history before each position in ``at``."""
    a, b, c = (seq[at - d].astype(np.uint64) + np.uint64(1) for d in (1, 2, 3))
    keys = np.stack([a * _MIX[0], b * _MIX[1] + np.uint64(7), c * _MIX[2] + np.uint64(13),
                     a * _MIX[3] + b * _MIX[4]])
    keys = (keys ^ (keys >> np.uint64(31))) * _MIX[1]
    out = np.zeros((5, len(at)), np.int64)  # a feature's rows lie together
    out[1:] = ((keys >> np.uint64(40)).astype(np.uint32) % np.uint32(ROWS - 1)) + np.uint32(1)
    return out.T


def joined(rows: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """The rows of the second softmax: feature and class together."""
    key = (rows.T.astype(np.uint64) + np.uint64(1)) * _MIX[2] + (cls.astype(np.uint64) + np.uint64(1)) * _MIX[0]
    return (((key ^ (key >> np.uint64(29))) * _MIX[4] >> np.uint64(40)) % np.uint64(ROWS)).astype(np.int64).T


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def softmax_off(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gradient at the logits ``x`` (overwritten): the target less the softmax."""
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x *= -1.0 / x.sum(axis=1, keepdims=True)
    x[np.arange(len(x)), target] += 1.0
    return x


def log_likelihood(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The log softmax of the targets alone (``x`` is overwritten)."""
    x -= x.max(axis=1, keepdims=True)
    own = x[np.arange(len(x)), target]
    np.exp(x, out=x)
    return own - np.log(x.sum(axis=1))


def run_sums(values: np.ndarray, index: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Row i: the sum (in doubles) of the next ``counts[i]`` (at least 1) of the rows ``values[index]``.

    Runs are cut into pieces of at most ``RUN`` rows.  All pieces' first rows are
    added at once, then all second rows and so on, then the pieces of each run."""
    first, pieces = np.cumsum(counts) - counts, None
    if counts.max(initial=0) > RUN:
        pieces = -(-counts // RUN)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        end = np.repeat(first + counts, pieces)
        first = np.repeat(first, pieces) + nth * RUN
        counts = np.minimum(end - first, RUN)
    by = np.argsort((RUN - counts).astype(np.uint8), kind="stable")  # longest first
    first = first[by]
    longer = len(by) - np.cumsum(np.bincount(counts, minlength=RUN + 1))  # [k]: pieces of over k rows
    out = values.take(index[first], axis=0).astype(float)
    for k in range(1, RUN):
        if not longer[k]:
            break
        out[:longer[k]] += values.take(index[first[:longer[k]] + k], axis=0)
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    return out.take(place, axis=0) if pieces is None else run_sums(out, place, pieces)


def tokens_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all texts, and their count in each text."""
    flat: list[bytes] = []
    ends = []
    for t in texts:
        flat += words_of(t)
        flat.append(END)
        ends.append(len(flat))
    return pa.array(flat, pa.binary()), np.diff(ends, prepend=0)


def _sequence(vocabulary: Vocabulary, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Ids with three pads before each text, the tokens' positions and texts, and the tokens."""
    words, counts = tokens_of(texts)
    ids = vocabulary.encode(words)
    text = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(len(ids)) + 3 * (text + 1)
    seq = np.full(len(ids) + 3 * len(texts), vocabulary.pad)
    seq[at] = ids
    return seq, at, text, words


def logits(weights: np.ndarray, rows: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """The sum of each token's feature rows and of ``start``."""
    out = weights.take(rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        out += weights.take(rows[:, k], axis=0)
    if start is not None:
        out += start
    return out


def keep_freed() -> None:
    """Frees a large array at once: from then on the C library keeps freed memory of
    up to twice its size instead of handing it back after every step, whose pages
    cost more to get again than the step's sums."""
    np.empty(31 << 20, np.uint8)


def in_parts(of: Callable[[slice], np.ndarray], n: int) -> np.ndarray:
    """``of`` every ``PART`` of ``n`` tokens, put together: what it holds stays in the cache."""
    return np.concatenate([of(slice(i, min(i + PART, n))) for i in range(0, n, PART)])


class Weights:
    def __init__(self, classes: np.ndarray, members: np.ndarray):
        self.tables = [classes, members]

    @classmethod
    def zero(cls) -> "Weights":
        return cls(np.zeros((ROWS, N_CLASSES), np.float32), np.zeros((ROWS, WIDTH), np.float32))


class Trainer:
    """Gradient steps from given weights, a rate per row that falls with its use."""

    def __init__(self, start: Weights):
        self.start = start
        self.tables = [t.copy() for t in start.tables]
        self.square = [np.ones(ROWS, np.float32) for _ in self.tables]
        self.used = [np.zeros(ROWS, np.float32) for _ in self.tables]

    def _step(self, which: int, rows: np.ndarray, off: np.ndarray, bias: bool = False) -> None:
        if bias:  # row 0, which every token has
            grad = off.sum(axis=0)
            self.square[which][0] += (grad * grad).sum()
            self.used[which][0] += len(off)
            self.tables[which][0] += grad * (RATE / np.sqrt(self.square[which][0]))
            rows = rows[:, 1:]
        flat = rows.T.ravel()
        times = np.bincount(flat, minlength=ROWS)
        hit = np.flatnonzero(times)
        by_row = np.argsort(flat.astype(np.min_scalar_type(ROWS)), kind="stable")  # a radix sort
        grad = run_sums(off, by_row % len(off), times[hit]).astype(np.float32)
        self.square[which][hit] += np.einsum("ij,ij->i", grad, grad)
        self.used[which][hit] += times[hit]
        grad *= (RATE / np.sqrt(self.square[which][hit]))[:, None]
        self.tables[which][hit] += grad

    def learn(self, vocabulary: Vocabulary, texts: list[bytes]) -> None:
        seq, at, _, _ = _sequence(vocabulary, texts)
        for i in range(0, len(at), BATCH):
            now = at[i:i + BATCH]
            rows, ids = features(seq, now), seq[now]
            cls = vocabulary.cls[ids]
            self._step(0, rows, in_parts(lambda p: softmax_off(logits(self.tables[0], rows[p]), cls[p]), len(now)),
                       bias=True)
            few = np.flatnonzero(vocabulary.member[ids] >= 0)
            if len(few):
                rows, cls, member = joined(rows.T[:, few].T, cls[few]), cls[few], vocabulary.member[ids[few]]
                self._step(1, rows, in_parts(lambda p: softmax_off(
                    logits(self.tables[1], rows[p], vocabulary.open[cls[p]]), member[p]), len(few)))

    def changes(self) -> Iterator[tuple[int, int, bytes, bytes]]:
        size = ROWS // BLOCKS
        for which, (now, was) in enumerate(zip(self.tables, self.start.tables)):
            for b in range(BLOCKS):
                part = slice(b * size, (b + 1) * size)
                if self.used[which][part].any():
                    delta = (now[part] - was[part]).astype(np.float16)
                    yield which, b, delta.tobytes(), self.used[which][part].tobytes()


def score_texts(vocabulary: Vocabulary, weights: Weights, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Per text: tokens, tokens among the top words, their base score, the model's
    natural log probability without the other words' own mass, and those words (a
    list of word and count per text)."""
    seq, at, text, words = _sequence(vocabulary, texts)
    ids = seq[at]
    total = np.zeros(len(at))
    for i in range(0, len(at), PART):
        now, own = at[i:i + PART], ids[i:i + PART]
        rows, cls = features(seq, now), vocabulary.cls[own]
        got = log_likelihood(logits(weights.tables[0], rows), cls) + vocabulary.within[own]
        few = np.flatnonzero(vocabulary.member[own] >= 0)
        if len(few):
            cls = cls[few]
            scores = logits(weights.tables[1], joined(rows.T[:, few].T, cls), vocabulary.open[cls])
            got[few] += log_likelihood(scores, vocabulary.member[own[few]])
        total[i:i + PART] = got
    n, top = len(texts), ids < vocabulary.k
    # Other words, but no end (which only a model without texts doesn't know).
    rare = np.flatnonzero(~top & (pc.binary_length(words).to_numpy() > 0))
    named = words.take(pa.array(rare)).dictionary_encode()
    most = max(1, len(named.dictionary))
    pairs, times = np.unique(text[rare] * most + named.indices.to_numpy(), return_counts=True)
    in_text, code = np.divmod(pairs, most)
    others = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(in_text, np.arange(n + 1)), pa.int32()),
        pa.StructArray.from_arrays([named.dictionary.take(pa.array(code)), pa.array(times, pa.int64())],
                                   names=["word", "n"]))
    return (np.bincount(text, minlength=n), np.bincount(text, top, n), np.bincount(text, vocabulary.base[ids], n),
            np.bincount(text, total, n), others)


def count_words(docs: DataFrame, text_col: str = "text", most: int = 300_000) -> DataFrame:
    """(word binary, c long) over all texts; the end of each text is the empty word.
    A task holds ``most`` different words at once and passes its counts on beyond."""
    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])

    def run(batches):
        counts: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()),
                                              pa.array(list(counts.values()), pa.int64())], schema.names)
            counts.clear()
            return out

        for b in batches:
            for part in slices(b, 0):
                for t in utf8(part.column(0)):
                    counts.update(words_of(t))
                counts[END] += part.num_rows
                if len(counts) > most:
                    yield flush()
        if counts:
            yield flush()

    partial = docs.select(col(text_col).alias("text")).mapInArrow(run, schema)
    return partial.groupBy("word").agg(F.sum("n").alias("c"))


def train_round(docs: DataFrame, vocabulary, weights, text_col: str = "text") -> Weights:
    """New weights after each task's steps on its share of ``docs``; ``vocabulary``
    and ``weights`` are broadcast variables."""
    part = T.StructType([T.StructField("which", T.IntegerType()), T.StructField("block", T.IntegerType()),
                         T.StructField("delta", T.BinaryType()), T.StructField("used", T.BinaryType())])

    def learn(batches):
        trainer = None
        keep_freed()
        for b in batches:
            for piece in slices(b, 0, 1 << 20):
                trainer = trainer or Trainer(weights.value)
                trainer.learn(vocabulary.value, utf8(piece.column(0)))
        if trainer:
            for row in trainer.changes():
                yield pa.RecordBatch.from_pylist([dict(zip(part.names, row))], schema=pa.schema(
                    [("which", pa.int32()), ("block", pa.int32()), ("delta", pa.binary()), ("used", pa.binary())]))

    def merge(batches):
        sums: dict[tuple[int, int], list] = {}  # this task's blocks; BLOCKS of either table at most
        for b in batches:
            for row in b.to_pylist():
                used = np.frombuffer(row["used"], np.float32)
                delta = np.frombuffer(row["delta"], np.float16).reshape(len(used), -1) * used[:, None]
                held = sums.setdefault((row["which"], row["block"]), [0.0, 0.0])
                held[0], held[1] = held[0] + delta, held[1] + used
        for (which, block), (delta, used) in sums.items():
            mean = (delta / np.maximum(used, 1)[:, None]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([which], pa.int32()), pa.array([block], pa.int32()),
                                              pa.array([mean.tobytes()], pa.binary()), pa.array([b""], pa.binary())],
                                             part.names)

    changes = docs.select(col(text_col).alias("text")).mapInArrow(learn, part)
    merged = changes.repartition(2 * BLOCKS, "which", "block").mapInArrow(merge, part)
    out = Weights(*[t.copy() for t in weights.value.tables])
    size = ROWS // BLOCKS
    for row in merged.select("which", "block", "delta").collect():  # the size of the weights, whatever the input's
        t = out.tables[row["which"]]
        t[row["block"] * size:(row["block"] + 1) * size] += np.frombuffer(row["delta"], np.float32).reshape(size, -1)
    return out


def fit(docs: DataFrame, text_col: str = "text", top: int = TOP, rounds: int = ROUNDS):
    """(vocabulary table, Vocabulary and Weights as broadcast variables) from every text of ``docs``."""
    spark = docs.sparkSession
    counts = saved(count_words(docs, text_col), "word-counts")
    end = F.pmod(F.crc32(F.when(F.length("word") > 2, F.substring("word", -2, 2)).otherwise(F.col("word"))),
                 F.lit(ENDINGS)).cast("int")
    groups = {r[0]: (r[1], r[2]) for r in counts.groupBy(end.alias("g")).agg(F.sum("c"), F.count(F.lit(1))).collect()}
    # Only words of at least the power of two that `top` words reach are ranked, so
    # the tasks together send about `top` rows, not `top` each.
    powers = sorted(counts.groupBy(F.floor(F.log2("c")).cast("int").alias("b")).count().collect(), reverse=True)
    floor, seen = 0, 0
    for power, n in powers:
        floor, seen = power, seen + n
        if seen >= top:
            break
    first = counts.where(F.col("c") >= 2 ** floor).orderBy(F.desc("c"), "word").limit(top).toArrow()
    words = list(zip(first.column("word").to_pylist(), first.column("c").to_pylist()))
    rest = [list(groups.get(g, (0, 0))) for g in range(ENDINGS)]
    total, size = sum(n for n, _ in rest), sum(v for _, v in rest)
    for w, c in words:
        g = rest[ending(w)]
        g[0], g[1] = g[0] - c, g[1] - 1
    vocabulary = spark.sparkContext.broadcast(Vocabulary(words, [tuple(g) for g in rest], total, size))
    weights = spark.sparkContext.broadcast(Weights.zero())
    for r in range(rounds):
        share = docs.where(F.pmod(F.xxhash64(col(text_col)), F.lit(rounds)) == r)
        weights = spark.sparkContext.broadcast(train_round(share, vocabulary, weights, text_col))
    return counts, vocabulary, weights


def lm_scores(docs: DataFrame, model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) and n_tokens, n_known, train_tokens (long),
    base_score, score (double; log10 probabilities of the whole text).

    Null and empty texts are their end alone; repeated rows score alike; a model
    without training texts knows no word.  New columns take leading underscores
    where the input has their names."""
    counts, vocabulary, weights = model
    keep = docs.columns if keep is None else keep
    new = fresh(docs.select(*map(col, keep)), "n_tokens", "n_known", "train_tokens", "base_score", "score")
    key, tokens, known, base, ln, others, text = fresh(
        docs, "row_", "tokens_", "known_", "base_", "ln_", "others_", "text_")
    item = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField(tokens, T.LongType()), T.StructField(known, T.LongType()), T.StructField(base, T.DoubleType()),
        T.StructField(ln, T.DoubleType()), T.StructField(others, T.ArrayType(item))])

    def run(batches):
        keep_freed()
        for b in batches:
            for p in slices(b, len(keep), 1 << 20):
                n, top, known_base, log, rest = score_texts(vocabulary.value, weights.value,
                                                            utf8(p.column(len(keep))))
                yield pa.RecordBatch.from_arrays(
                    [p.column(i) for i in range(len(keep))]
                    + [pa.array(n, pa.int64()), pa.array(top.astype(np.int64)), pa.array(known_base), pa.array(log),
                       rest], schema.names)

    rows = docs.select(*map(col, keep), col(text_col).alias(text)).mapInArrow(run, schema)
    rows = saved(rows.withColumn(key, F.monotonically_increasing_id()), "lm-rows")
    asked = rows.select(F.col(key).alias("row"), F.inline(others))
    found = asked.join(counts, "word", "left").select(
        "row", "n", F.coalesce("c", F.lit(0)).alias("c"))
    per_row = found.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("more"))
    out = rows.join(per_row, F.col(key) == F.col("row"), "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        *map(col, keep), F.col(tokens).alias(new[0]),
        (F.col(known) + F.coalesce("more_known", F.lit(0))).alias(new[1]),
        F.lit(vocabulary.value.total).cast("long").alias(new[2]), (F.col(base) + more).alias(new[3]),
        (F.col(ln) / float(np.log(10)) + more).alias(new[4]))


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def op7_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    out = lm_scores(docs, model, keep=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


QUERIES = {"op7_maxent_lm": op7_maxent_lm}
ORACLES: dict[str, str] = {}
