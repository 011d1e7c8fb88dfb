"""SentencePiece encoding by forward filtering and backward sampling, and decoding.

The pieces of a public SentencePiece model span a lattice over the text.  Forward
filtering sums the weights of all segmentations up to each character; backward
sampling then draws the pieces from the end, so each segmentation comes up with
its share of the total.  The draws hang on the row's key, the place in the row
and nothing else: a row is segmented alike in any partition, batch or retry.

Blanks begin words and no piece goes across one (the model's pieces of several
blanks aside, which are not used), so a batch's different words are filtered
once each, words of one length together, and all occurrences are drawn together.
Words of any length are filtered whole: the forward weights go on from block to
block of ``BLOCK`` positions.  Characters without a piece become byte pieces, so
decoding gives back the text, whatever it holds.

Working memory follows ``SLICE`` bytes of text (or one longer row): of each word only
the pieces that lie on its lattice are kept, and words are filtered in groups of
``BLOCK`` positions.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, col, fresh, slices, table, utf8

SLICE = 1 << 20     # bytes of text segmented together
BLOCK = 1 << 15     # positions filtered together
LATTICES = 2 << 20  # pieces of words that a worker keeps
SHARPNESS = 0.7  # exponent of the pieces' probabilities; higher draws fewer pieces
MARK = 0x2581  # stands for a blank in pieces
_LITERAL = 0x110000  # stands for that character itself, beyond all code points
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Pieces:
    """The model's pieces: hashes for lookup, log weights, and their bytes."""

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.lattices = Lattices()
        self.bytes: list[bytes] = []
        self.byte_ids = np.full(256, -1, np.int64)
        hashes, ids, ranks, self.longest = [], [], [], 1
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
                continue
            self.bytes.append(piece.replace("▁", " ").encode())
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or "▁" in piece[1:]:
                continue
            self.longest = max(self.longest, len(piece))
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in piece:
                    h = h * _BASE + np.uint64(ord(c) + 1)
            hashes.append(h)
            ids.append(i)
            ranks.append(max(0.0, -model.get_score(i)))
        if (self.byte_ids < 0).any():
            raise ValueError(f"{path}: a model without byte pieces can't encode every text")
        order = np.argsort(np.array(hashes, np.uint64))
        self.hashes = np.array(hashes, np.uint64)[order]
        self.ids = np.array(ids, np.int64)[order]
        # Merge ranks as Zipf frequencies; byte pieces come after the last.
        weights = -np.log(np.array(ranks)[order] + 3.0)
        self.weights = sharpness * weights
        self.byte_weight = sharpness * (-np.log(max(ranks) + 3.0) - 1.0)

        # Two tables by parts of the hash: most pieces are in the first, those whose
        # place is taken in the second.
        self.first, self.second = np.zeros(1 << 20, np.int32), np.zeros(1 << 20, np.int32)
        place = self._place(self.hashes)
        _, firsts = np.unique(place, return_index=True)
        self.first[place[firsts]] = firsts
        others = np.setdiff1d(np.arange(len(self.hashes)), firsts)
        self.shift = next(s for s in range(20, 44) if len(np.unique(self._other(self.hashes[others], s))) == len(others))
        self.second[self._other(self.hashes[others], self.shift)] = others

    @staticmethod
    def _place(hashes: np.ndarray) -> np.ndarray:
        return hashes * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(44)

    @staticmethod
    def _other(hashes: np.ndarray, shift: int) -> np.ndarray:
        return (hashes * np.uint64(0x94D049BB133111EB) >> np.uint64(shift)) & np.uint64((1 << 20) - 1)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, found) of substring hashes."""
        at = self.first[self._place(hashes)]
        found = self.hashes[at] == hashes
        no = np.flatnonzero(~found)
        again = self.second[self._other(hashes[no], self.shift)]
        hit = self.hashes[again] == hashes[no]
        at[no[hit]] = again[hit]
        found[no[hit]] = True
        return at, found


@functools.lru_cache(maxsize=2)
def load(path: str, sharpness: float = SHARPNESS) -> Pieces:
    return Pieces(path, sharpness)


def _n_bytes(c: np.ndarray) -> np.ndarray:
    return np.where(c == _LITERAL, 3, 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF))


def filter_words(pieces: Pieces, words: np.ndarray, block: int = BLOCK
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of one length as rows of code points -> the pieces on their lattices.

    Returned are, for each word and end position 1..length, how many pieces end there
    (row by row), and of all those pieces in that order, shortest first: the draw
    threshold, the size in characters and the id (negative: -1 - code point)."""
    n, length = words.shape
    k = min(length, pieces.longest)
    forward = np.full((n, length + 1), -np.inf)
    forward[:, 0] = 0.0
    chars = words.astype(np.uint64) + np.uint64(1)
    parts = []
    for a in range(0, length, block):  # ends a + 1 .. b
        b = min(length, a + block)
        low = max(0, a - k + 1)
        logs = np.full((n, b - a, k), -np.inf)
        ids = np.zeros((n, b - a, k), np.int32)
        h = np.zeros((n, b - low), np.uint64)
        for size in range(1, min(k, b - low) + 1):  # substrings from every start at once
            h = h[:, :b - low - size + 1] * _BASE + chars[:, low + size - 1:b]
            skip = max(0, a + 1 - low - size)  # these end before the block
            at, found = pieces.find(h[:, skip:].ravel())
            first = low + skip + size - a - 1
            shape = (n, b - a - first)
            at, found = at.reshape(shape), found.reshape(shape)
            logs[:, first:, size - 1] = np.where(found, pieces.weights[at], -np.inf)
            ids[:, first:, size - 1] = pieces.ids[at]
            if size == 1 and not found.all():
                c = words[:, a:b][~found].astype(np.int64)
                logs[:, :, 0][~found] = pieces.byte_weight * _n_bytes(c)
                ids[:, :, 0][~found] = -1 - c
        for end in range(a + 1, b + 1):
            m = min(k, end)
            paths = logs[:, end - a - 1, :m] + forward[:, end - m:end][:, ::-1]
            top = paths.max(axis=1, keepdims=True)
            upto = np.cumsum(np.exp(paths - top), axis=1)
            total = upto[:, -1:]
            forward[:, end] = (top + np.log(total))[:, 0]
            # The last piece takes the rest.
            logs[:, end - a - 1, :m] = np.where(np.isneginf(paths), -np.inf, np.where(
                upto >= total * (1 - 1e-12), 2.0, upto / total))
            logs[:, end - a - 1, m:] = -np.inf
        kept = ~np.isneginf(logs)
        sizes = np.broadcast_to(np.arange(1, k + 1, dtype=np.uint8), logs.shape)[kept]
        parts.append((kept.sum(axis=2), logs[kept].astype(np.float32), sizes, ids[kept]))
    # A second block means a word that is a group of its own, so the parts follow each other.
    return (np.concatenate([p[0] for p in parts], axis=1).ravel(), *(np.concatenate([p[i] for p in parts]) for i in (1, 2, 3)))


class Lattices:
    """Lattices of words filtered before, by word hash, so that a common word is
    filtered once per worker; emptied when they hold over ``LATTICES`` pieces.  What a
    word's lattice is does not depend on it."""

    def __init__(self):
        self.words, self.base = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begin = np.zeros(1, np.int64)  # first piece of each end position of each word
        self.pieces = (np.zeros(0, np.float32), np.zeros(0, np.uint8), np.zeros(0, np.int32))

    def of(self, words: np.ndarray, lengths: np.ndarray, build) -> tuple[np.ndarray, ...]:
        """For word hashes: the place of each word's end positions in ``begin``;
        ``begin``; thresholds, sizes and ids of all pieces."""
        if len(self.pieces[0]) > LATTICES:
            self.__init__()
        base = np.full(len(words), -1)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            known = self.words[at] == words
            base[known] = self.base[at[known]]
        new = np.flatnonzero(base < 0)
        if len(new):
            counts, parts, done = [], [self.pieces], len(self.begin) - 1
            for length in np.unique(lengths[new]).tolist():
                group = new[lengths[new] == length]
                rows = max(1, BLOCK // length)
                for g in range(0, len(group), rows):
                    own = group[g:g + rows]
                    count, *found = build(own, length)
                    counts.append(count)
                    parts.append(found)
                    base[own] = done + np.arange(len(own)) * length
                    done += len(own) * length
            ends = self.begin[-1] + np.cumsum(np.concatenate(counts))
            self.begin = np.concatenate([self.begin, ends])
            self.pieces = tuple(np.concatenate([p[i] for p in parts]) for i in range(3))
            self.words = np.concatenate([self.words, words[new]])
            self.base = np.concatenate([self.base, base[new]])
            order = np.argsort(self.words)
            self.words, self.base = self.words[order], self.base[order]
        return base, self.begin, *self.pieces


def encode_batch(pieces: Pieces, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
    """Sampled piece ids of each text; ``keys`` seed the draws."""
    parts, sizes = [], []
    for t in texts:
        c = np.frombuffer((" " + t).encode("utf-32-le") if t else b"", np.uint32)
        parts.append(c)
        sizes.append(len(c))
    sizes = np.array(sizes, np.int64)
    chars = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    if not len(chars):
        return [np.zeros(0, np.uint32) for _ in texts]
    row_start = np.cumsum(sizes) - sizes
    chars = np.where(chars == MARK, _LITERAL, chars)
    # Words begin at a blank, at and after a \n, and at each text.
    line = chars == 10
    begins = (chars == 32) | line | np.concatenate([[False], line[:-1]])
    begins[row_start[sizes > 0]] = True
    starts = np.flatnonzero(begins)
    lengths = np.diff(np.append(starts, len(chars)))
    chars = np.where(chars == 32, MARK, chars).astype(np.uint32)
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(chars) - 1, _BASE)]))
    undo = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(chars) - 1, _BACK)]))
    prefix = np.concatenate([[np.uint64(0)], np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * power)])
    hashes = (prefix[starts + lengths] - prefix[starts]) * undo[starts]
    hashes = hashes * _BASE + lengths.astype(np.uint64)
    different, sample, word = np.unique(hashes, return_index=True, return_inverse=True)

    word_length = lengths[sample]
    base, begin, steps, lens, ids = pieces.lattices.of(
        different, word_length, lambda own, length: filter_words(
            pieces, chars[starts[sample[own]][:, None] + np.arange(length)]))

    row = np.searchsorted(np.cumsum(sizes), starts, "right")
    place = (starts - row_start[row]).astype(np.uint64)
    seed = _scramble(keys.astype(np.int64).view(np.uint64)[row] + (place + np.uint64(1)) * _BASE)
    at, left = np.arange(len(starts)), word_length[word]
    drawn: list[tuple[np.ndarray, np.ndarray]] = []
    count = np.zeros(len(starts), np.int64)
    while len(at):
        r = begin[base[word[at]] + left[at] - 1]
        bits = _scramble(seed[at] + (count[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
        u = ((bits >> np.uint64(41)).astype(np.float32) + 1.0) / np.float32(1 << 23)
        later = np.flatnonzero(steps[r] < u)
        while len(later):
            r[later] += 1
            later = later[steps[r[later]] < u[later]]
        drawn.append((at, ids[r]))
        left[at] -= lens[r]
        count[at] += 1
        at = at[left[at] > 0]
    ends = np.cumsum(count)
    out = np.empty(int(ends[-1]), np.int64)
    for step, (at, got) in enumerate(drawn):
        out[ends[at] - 1 - step] = got
    row_of = np.repeat(row, count)
    if (out < 0).any():  # characters as bytes
        odd = np.flatnonzero(out < 0)
        codes = -1 - out[odd]
        times = np.ones(len(out), np.int64)
        times[odd] = _n_bytes(codes)
        shift = np.cumsum(times) - times
        longer = np.repeat(out, times)
        for c in np.unique(codes).tolist():
            raw = pieces.byte_ids[list(chr(MARK if c == _LITERAL else c).encode())]
            where = shift[odd[codes == c]]
            longer[where[:, None] + np.arange(len(raw))] = raw
        out, row_of = longer, np.repeat(row_of, times)
    cuts = np.searchsorted(row_of, np.arange(1, len(texts)))
    return np.split(out.astype(np.uint32), cuts)


def decode_ids(pieces: Pieces, ids: np.ndarray) -> bytes:
    """The text of piece ids, without the blank that encoding puts in front."""
    return b"".join(map(pieces.bytes.__getitem__, ids.tolist()))[1:]


def encode(docs: DataFrame, path: str, text_col: str = "text", key_col: str = "doc_id",
           keep: list[str] | None = None, name: str = "pieces", sharpness: float = SHARPNESS,
           decoded: str | None = None) -> DataFrame:
    """``keep`` columns (default all) and the sampled ids as little-endian unsigned
    32-bit numbers (binary); with ``decoded`` also, under that name, the text that
    those ids decode to, in the same step.  Null and empty texts have none; rows with
    the same key and text are segmented alike; a null key is a key."""
    keep = docs.columns if keep is None else keep
    text, key = fresh(docs, "text_", "key_")
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(name, T.BinaryType())])
    if decoded is not None:
        schema = schema.add(decoded, T.StringType())

    def run(batches):
        pieces = load(path, sharpness)
        n = len(keep)
        for b in batches:
            for p in slices(b, n, SLICE):
                got = encode_batch(pieces, [t.decode() for t in utf8(p.column(n))], p.column(n + 1).to_numpy())
                out = [pa.array([x.astype("<u4").tobytes() for x in got], pa.binary())]
                if decoded is not None:
                    out.append(pa.array([decode_ids(pieces, x) for x in got], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([p.column(i) for i in range(n)] + out, schema.names)

    return docs.select(*map(col, keep), col(text_col).alias(text), F.xxhash64(col(key_col)).alias(key)) \
        .mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, pieces_col: str = "pieces", keep: list[str] | None = None,
           name: str = "decoded") -> DataFrame:
    """``keep`` columns (default all) and the decoded text; null or no ids: ''."""

    def factory():
        pieces = load(path)
        return lambda ids: [pa.array([decode_ids(pieces, np.frombuffer(x, "<u4")).decode("utf-8", "replace")
                                      for x in utf8(ids)])]

    return append_columns(docs, pieces_col, [T.StructField(name, T.StringType())], factory, keep)


def op10_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode(docs, path, decoded="decoded")
    return out.select(
        "doc_id", (F.coalesce(F.octet_length("pieces"), F.lit(0)) / 4).cast("long").alias("n_pieces"),
        F.crc32("pieces").alias("ids_crc32"), F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("lossless"))


QUERIES = {"op10_piece_sampling": op10_piece_sampling}
ORACLES: dict[str, str] = {}
