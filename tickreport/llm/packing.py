"""Packing: documents cut into pieces that fill sequences of fixed length.

Method: every document becomes token ids and one end id; what exceeds the
capacity is cut off in whole sequences, the rest is one piece.  The histogram of
piece lengths (at most ``capacity`` numbers) is the only thing the driver sees:
cutting stock by column generation turns it into patterns, and the k-th piece of
each length, ranked by a grouped order, takes the k-th place of that length.

Ids come from a public ``tokenizers`` file whose path is a parameter.  The distinct
words of a batch are looked up in a bounded cache; a word that is not there goes
through the tokenizer's own pre-tokenizer and model.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, fresh, saved, slices, table, utf8
from .cutting_stock import solve

CAPACITY = 1024
END_ID = 0
#: Words kept by a worker's cache; each takes about 200 bytes.
CACHE_WORDS = 800_000
#: Share of a cache up to which words with marks behind them have entries of their own beside their letters'.
MARKED_SHARE = 0.6

#: White space other than a space and \n: texts with it are not split into words first.
_OTHER_WHITE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0  -     　]")

#: Latin letters (after a line's start, perhaps), with no other letter or combining mark behind them.
_STEM = re.compile("\n?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+(?=[\x21-\x40\x5b-\x60\x7b-\x7e]|\\Z)")

#: GPT-2's printable stand-ins for bytes: printable Latin-1 stands for itself, the others follow from U+0100.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_STAND_IN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


@functools.lru_cache(maxsize=2)  # a worker's later tasks find the words of the earlier ones
def batch_ids(path: str, cache_words: int = CACHE_WORDS) -> Callable[[pa.Array, np.ndarray], tuple]:
    """A function from an array of texts (null: empty) and the ids that follow each of
    them to all ids in one array (unsigned 32-bit) and the end of each text's ids in
    it.  Ids equal the tokenizer's ``encode`` without special tokens.

    The file must hold a byte-level BPE tokenizer without a normaliser and with
    the usual split: before a space that follows a non-blank, around a \\n between
    non-blanks, and between letters and a following full stop or comma.

    Words of a batch are numbered first, so each is looked up once a batch; a word
    at a line's start carries the \\n before it."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if tokenizer.normalizer is not None:
        raise ValueError(f"{path}: a tokenizer with a normaliser can't be fed word by word")
    split, model = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize

    def of_part(part: str) -> bytes:
        return array("I", [t.id for t in model(part)]).tobytes()

    def encode(piece: str) -> bytes:
        return b"".join([of_part(part) for part, _ in split(piece)])

    newline, blank = encode("\n"), " ".translate(_STAND_IN)
    tails = functools.lru_cache(10_000)(encode)
    cache: dict[str, bytes] = {}  # by word; at a line's start with its \n in front

    def missed(word: str) -> bytes:
        head = word[0] == "\n"
        # Letters are one part, whatever but a letter follows them.
        found = _STEM.match(word)
        if not found:
            ids = newline + encode(word[1:]) if head else encode(" " + word)
            if len(cache) < cache_words:
                cache[word] = ids
            return ids
        stem = found[0]
        tail = word[len(stem):]
        ids = cache.get(stem) if tail else None
        if ids is None:
            letters = stem[1:] if head else stem
            if not letters.isascii():
                letters = letters.encode().decode("latin-1").translate(_STAND_IN)
            ids = newline + of_part(letters) if head else of_part(blank + letters)
            if len(cache) < cache_words:
                cache[stem] = ids
        if tail:
            ids += tails(tail)
            if len(cache) < MARKED_SHARE * cache_words:
                cache[word] = ids
        return ids

    def ids(texts: pa.Array, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(texts)
        # A \n in front of every text, taken off again, makes its first word a line's start.
        marked = pc.binary_join_element_wise("", pc.fill_null(texts, ""), "\n")
        parts = pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
        coded = pc.list_flatten(parts).dictionary_encode()
        ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False), dtype=np.int64)
        starts = ends - np.diff(ends, prepend=0)
        at, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        # The first part of a text is the empty one before its \n.
        odd = np.zeros(len(words), bool)
        pool: list[bytes] = list(map(cache.get, words))
        for i in [i for i, known in enumerate(pool) if known is None]:
            # Runs of blanks have rules of their own; texts with them go through as a whole.
            odd[i] = words[i] in ("", "\n") or _OTHER_WHITE.search(words[i]) is not None
            pool[i] = b"" if odd[i] else missed(words[i])
        whole = np.zeros(n, bool)
        if odd.any():
            strange = odd[at]
            strange[starts] = False
            whole = np.logical_or.reduceat(strange, starts) if n else whole
        pool += [encode(texts[i].as_py() or "") for i in np.flatnonzero(whole)]
        sizes = np.fromiter(map(len, pool), np.int64, len(pool)) // 4
        firsts = np.cumsum(sizes) - sizes
        own, begin = sizes[at], firsts[at]
        own[starts] = 0
        heads = starts + 1
        own[heads] -= len(newline) // 4
        begin[heads] += len(newline) // 4
        if whole.any():
            own[np.repeat(whole, ends - starts)] = 0
            k = len(words) + np.arange(int(whole.sum()))
            own[heads[whole]], begin[heads[whole]] = sizes[k], firsts[k]
        # Behind each text what follows it, at the end of the pool.
        following = np.asarray(after, "<u4")
        own = np.insert(own, ends, 1)
        begin = np.insert(begin, ends, sizes.sum() + np.arange(n))
        stops = np.cumsum(own)
        flat = np.concatenate([np.frombuffer(b"".join(pool), "<u4"), following])
        out = flat[np.repeat(begin - (stops - own), own) + np.arange(int(own.sum()))]
        return out, stops[ends + np.arange(n)]

    return ids


def token_ids(path: str) -> Callable[[str], bytes]:
    """``batch_ids`` of one text, as little-endian unsigned 32-bit numbers."""
    ids = batch_ids(path)
    return lambda text: ids(pa.array([text], pa.string()), np.zeros(1, "<u4"))[0][:-1].tobytes()


def token_pieces(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: the id, start and length (long, in the document's ids),
    doc_tokens (long, with the end id) and tokens (binary: little-endian unsigned
    32-bit ids).  A null or empty text is its end id alone; repeated rows are
    documents of their own; ids may be null."""
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("tokens", T.BinaryType())])

    def run(batches):
        ids = batch_ids(path)
        for whole in batches:
            for b in slices(whole, 1):
                got, ends = ids(b.column(1), np.full(b.num_rows, end_id, "<u4"))
                totals = np.diff(ends, prepend=0)
                pieces = -(-totals // capacity)
                rows = np.repeat(np.arange(b.num_rows), pieces)
                starts = (np.arange(len(rows)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
                lengths = np.minimum(totals[rows] - starts, capacity)
                # Pieces lie one behind the other, as the texts' ids do.
                offsets = np.concatenate([[0], np.cumsum(lengths) * 4])
                tokens = pa.Array.from_buffers(pa.binary(), len(rows), [
                    None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(got)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(totals[rows], pa.int64()), tokens], schema.names)

    return docs.select(col(id_col), col(text_col).alias(fresh(docs, "text_")[0])).mapInArrow(run, schema)


def sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Places for counted pieces: (length, first rank, end rank, pieces of that
    length in one sequence, first sequence, offset in the sequence)."""
    taken: dict[int, int] = {}
    out, base = [], 0
    for pattern, times in solve(counts, capacity):
        offset = 0
        for n, k in pattern:
            first = taken.get(n, 0)
            taken[n] = first + k * times
            out.append((n, first, taken[n], k, base, offset))
            offset += n * k
        base += int(times)
    return out


def assign_sequences(pieces: DataFrame, order: list[str], capacity: int = CAPACITY,
                     length_col: str = "length") -> DataFrame:
    """``pieces`` with sequence_id and offset (long) added (with leading
    underscores where taken): no two pieces of a sequence overlap, and its pieces
    lie gapless from 0.  Read several times, so hand in a written table.

    Pieces of one length are ranked in salted groups of bounded size, whose
    offsets come from a table of one row per group, so a length that a third of
    all pieces share is no single task.  Ties in ``order`` (repeated rows) are in
    any order: such pieces are alike."""
    n_col, salt, rank, at, n = fresh(pieces, "length_", "salt_", "rank_", "at_", "n_")
    base = pieces.withColumn(n_col, col(length_col).cast("long"))
    # At most `capacity` rows reach the driver, whatever the input's size.
    counts = {r[0]: r[1] for r in base.groupBy(n_col).count().collect()}
    if any(k is None or not 1 <= k <= capacity for k in counts):
        raise ValueError(f"pieces must be 1 to {capacity} long")
    places = sequences(counts, capacity)
    group = max(300, sum(counts.values()) // 4096)  # rows of a group, so about 4096 groups and one per length
    spark = pieces.sparkSession
    salts = fresh(base, "s_length", "s_salts")
    per_length = spark.createDataFrame([(k, max(1, c // group)) for k, c in sorted(counts.items())],
                                       T.StructType([T.StructField(x, T.LongType()) for x in salts]))
    keyed = base.join(F.broadcast(per_length), F.col(n_col) == F.col(salts[0])) \
        .withColumn(salt, F.pmod(F.xxhash64(*map(col, order)), F.col(salts[1]))).drop(*salts)
    sizes = keyed.groupBy(n_col, salt).agg(F.count(F.lit(1)).alias(n))
    before = sizes.select(n_col, salt, (F.sum(n).over(W.partitionBy(n_col).orderBy(salt)) - F.col(n)).alias(at))
    within = F.row_number().over(W.partitionBy(n_col, salt).orderBy(*map(col, order))) - 1
    ranked = keyed.withColumn(rank, within).join(F.broadcast(before), [n_col, salt]) \
        .withColumn(rank, F.col(rank) + F.col(at))
    names = ["p_length", "p_first", "p_end", "p_times", "p_base", "p_offset"]
    mine = fresh(ranked, *names)
    # One row per pattern and length: bounded by the capacity, not by the data.
    schema = T.StructType([T.StructField(x, T.LongType()) for x in mine])
    slots = F.broadcast(spark.createDataFrame([tuple(map(int, p)) for p in places], schema))
    p_length, p_first, p_end, p_times, p_base, p_offset = map(F.col, mine)
    r = F.col(rank)
    placed = ranked.join(slots, (F.col(n_col) == p_length) & (r >= p_first) & (r < p_end))
    seq, off = fresh(pieces, "sequence_id", "offset")
    k = r - p_first
    return placed.select(
        *map(col, pieces.columns), (p_base + F.floor(k / p_times)).cast("long").alias(seq),
        (p_offset + F.pmod(k, p_times) * p_length).cast("long").alias(off))


def pack_documents(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces with their tokens, sequence_id and offset; an empty table gives none."""
    pieces = saved(token_pieces(docs, path, text_col, id_col, capacity, end_id), "pieces")
    return assign_sequences(pieces, [id_col, "start"], capacity)


def packed_digest(docs: DataFrame, path: str) -> DataFrame:
    """The pieces of ``docs`` in their sequences with a checksum in place of the tokens."""
    pieces = token_pieces(docs, path)
    digest = pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens")
    return assign_sequences(saved(digest, "pieces"), ["doc_id", "start", "ids_crc32"])


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op4_packing": op4_packing}
ORACLES: dict[str, str] = {}
