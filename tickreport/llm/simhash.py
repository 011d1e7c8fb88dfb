"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: 64 bits, one per document, from word shingles.  Linking: the
distinct fingerprints are sorted by Gray rank; runs of them form nodes that hold
the bits all members share, nodes form upper nodes, and a pair of nodes is pruned
as a whole when the differences accumulated on the way down exceed the distance.
Only a spanning set of links leaves an index.  Components are found by alternating
large-star and small-star steps on written tables.

One index holds about ``INDEX`` fingerprints.  Beyond that they are dealt to as many
indexes as their number asks for, by the first bits of k+1 bands: two fingerprints
that differ in k bits share a band, so they meet in an index.  The bands' width
follows the number of fingerprints; it only deals, and the index finds the links.

Copies cost one fingerprint.  An index over the limit is dealt again on the bits
its members don't share, with the same guarantee, until it fits; distinct
fingerprints with 15 open bits are at most 32,768, so this ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, col, fresh, saved, table, utf8

BITS = 64
#: Fingerprints meant for one index, and most that one task indexes; larger buckets
#: are dealt again.
INDEX, MAX_BUCKET = 4096, 20_000
#: Members of a node, and nodes of an upper node.
FANOUT = 2


def simhash(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint: a bit is 1 if set in over half of the shingles' XXH64.
    Shingles are ``shingle`` words (A-Z lower-cased, repeats included) joined by
    a space; fewer words are one shingle, none give 0."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        return h(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    hashes = np.fromiter((h(joined[s:e], seed) for s, e in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())),
                         np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 65536):
        part = hashes[i:i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.left_shift(np.uint64(1), np.arange(BITS, dtype=np.uint64))[2 * ones > n]).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, shingle: int = 3,
                 name: str = "fp") -> DataFrame:
    """``keep`` columns and the fingerprint as a signed long."""

    def factory():
        def run(texts: pa.Array) -> list[pa.Array]:
            got = np.fromiter((simhash(t, shingle) for t in utf8(texts)), np.uint64, len(texts))
            return [pa.array(got.view(np.int64))]

        return run

    return append_columns(docs, text_col, [T.StructField(name, T.LongType())], factory, keep)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The position of each 64-bit pattern in Gray-code order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class Components:
    """Union-find over 0..n-1, smallest member as the root."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist()):
            i, j = self.find(i), self.find(j)
            if i != j:
                self.root[max(i, j)] = min(i, j)

    def flat(self) -> np.ndarray:
        while not np.array_equal(up := self.root[self.root], self.root):
            self.root = up
        return self.root


def _nodes(pattern: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper nodes over runs of FANOUT nodes: a pattern, and the bits that all share."""
    at = np.arange(0, len(pattern), FANOUT)
    first = pattern[at]
    differs = np.bitwise_or.reduceat((pattern ^ np.repeat(first, FANOUT)[:len(pattern)]) | ~mask, at)
    return first, ~differs


def linked(fps: np.ndarray, distance: int, compared: list[int] | None = None) -> np.ndarray:
    """For distinct fingerprints, the index of the component root of each, links
    being ``distance`` or fewer differing bits: one top node against itself and the
    later ones, and down.  ``compared`` collects how many pairs of fingerprints the
    index did not prune."""
    n = len(fps)
    parts = Components(n)
    order = np.argsort(gray_rank(fps), kind="stable")
    levels = [(fps[order], np.full(n, ~np.uint64(0)))]
    while len(levels[-1][0]) > FANOUT:
        levels.append(_nodes(*levels[-1]))
    near = np.bitwise_count(levels[0][0][1:] ^ levels[0][0][:-1]) <= distance
    parts.join(order[:-1][near], order[1:][near])
    top = len(levels) - 1
    for root in range(len(levels[top][0])):
        later = np.arange(root, len(levels[top][0]))
        _descend(levels, top, np.full(len(later), root), later, distance, order, parts, compared)
    return parts.flat()


def _descend(levels, level, a, b, distance, order, parts, compared=None) -> None:
    """Follow the pairs of nodes (a <= b) down; ``gone`` are the bits already
    compared above and ``sum_`` their differences."""
    gone, sum_ = np.zeros(len(a), np.uint64), np.zeros(len(a), np.uint8)
    todo = [(level, a, b, gone, sum_)]
    while todo:
        level, a, b, gone, sum_ = todo.pop()
        if len(a) > 1 << 16:  # bounded working memory
            half = len(a) // 2
            todo += [(level, a[:half], b[:half], gone[:half], sum_[:half]),
                     (level, a[half:], b[half:], gone[half:], sum_[half:])]
            continue
        pattern, mask = levels[level]
        if level == 0 and compared is not None:
            compared.append(int((a != b).sum()))
        both = mask[a] & mask[b] & ~gone
        sum_ = sum_ + np.bitwise_count((pattern[a] ^ pattern[b]) & both)
        keep = sum_ <= distance
        a, b, gone, sum_ = a[keep], b[keep], (gone | both)[keep], sum_[keep]
        if not len(a):
            continue
        if level == 0:
            near = a != b
            roots = parts.flat()
            i, j = order[a[near]], order[b[near]]
            new = roots[i] != roots[j]
            parts.join(i[new], j[new])
            continue
        size = len(levels[level - 1][0])
        i, j = np.divmod(np.arange(FANOUT * FANOUT), FANOUT)
        x, y = (a[:, None] * FANOUT + i).ravel(), (b[:, None] * FANOUT + j).ravel()
        ok = (x < size) & (y < size) & (x <= y)
        if level == 1:  # members that are already connected need no look
            roots = parts.flat()
            ok[ok] = roots[order[x[ok]]] != roots[order[y[ok]]]
        src = np.repeat(np.arange(len(a)), FANOUT * FANOUT)[ok]
        todo.append((level - 1, x[ok], y[ok], gone[src], sum_[src]))


def _bands(open_bits: int, count: int) -> np.ndarray:
    """The open bits cut into ``count`` runs of about equal size."""
    bits = np.flatnonzero([(open_bits >> i) & 1 for i in range(BITS)])
    return np.array([sum(1 << int(b) for b in part) for part in np.array_split(bits, count)], np.uint64)


def _deal(fps: np.ndarray, used: int, distance: int, width: int = BITS) -> Iterator[tuple[int, np.ndarray]]:
    """(shared bits, masked value of each fingerprint) for the first ``width`` bits of
    each band of the bits not in ``used``; one bucket for all if there are none."""
    if not width:
        yield used, fps & np.uint64(used)
        return
    for band in _bands(~used & (1 << BITS) - 1, distance + 1):
        first = [i for i in range(BITS) if int(band) >> i & 1][:width]
        mask = used | sum(1 << i for i in first)
        yield mask, fps & np.uint64(mask)


def bucket_links(fps: DataFrame, distance: int = 3, max_bucket: int = MAX_BUCKET, per_index: int = INDEX) -> DataFrame:
    """Links (fp, to), ``to`` the smaller end, that connect the distinct ``fps``
    (column fp) as all pairs within ``distance`` would."""
    key_type = T.StructType([T.StructField(x, T.LongType()) for x in ("mask", "value", "fp")])
    link_type = T.StructType([T.StructField(x, T.LongType()) for x in ("fp", "to")])
    widths = [max(0, (fps.count() - 1) // per_index).bit_length()]  # then whole bands
    signed = lambda x: np.asarray(x, np.uint64).view(np.int64)

    def dealer(width):
        return lambda batches: deal(batches, width)

    def deal(batches, width):
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            used = b.column("mask").to_numpy().view(np.uint64)
            for u in np.unique(used):
                mine = fp[used == u]
                for mask, value in _deal(mine, int(u), distance, width):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(np.full(len(mine), mask, np.uint64))), pa.array(signed(value)),
                         pa.array(signed(mine))], key_type.names)

    def index(batches):
        def links(mask, value, fp):
            edges = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
            starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(fp)]])
            out_a, out_b = [], []
            for s, e in zip(starts.tolist(), ends.tolist()):
                mine = np.sort(fp[s:e].view(np.int64)).view(np.uint64)
                root = linked(mine, distance)
                far = root != np.arange(e - s)
                out_a.append(mine[far])
                out_b.append(mine[root[far]])
            a, b = np.concatenate(out_a).view(np.int64), np.concatenate(out_b).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))],
                                              link_type.names)

        held: list[np.ndarray] = []
        for b in batches:  # sorted by bucket; the last bucket of a batch may go on in the next
            now = np.stack([b.column(i).to_numpy() for i in range(3)])
            now = np.concatenate([*held, now], axis=1)
            last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            done, held = now[:, ~last], [now[:, last]]
            if done.shape[1]:
                yield links(done[0], done[1], done[2].view(np.uint64))
        if held and held[0].shape[1]:
            yield links(held[0][0], held[0][1], held[0][2].view(np.uint64))

    found = []
    todo = fps.select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("value"), "fp")
    while True:
        width = widths.pop() if widths else BITS
        dealt = saved(todo.select("mask", "fp").mapInArrow(dealer(width), key_type), "buckets")
        large = saved(dealt.groupBy("mask", "value").count().where(F.col("count") > max_bucket)
                      .select("mask", "value"), "large-buckets")
        n_large = large.count()  # a number, not the buckets
        small = dealt.join(large, ["mask", "value"], "left_anti") if n_large else dealt
        found.append(small.repartition("mask", "value").sortWithinPartitions("mask", "value")
                     .mapInArrow(index, link_type))
        if not n_large:
            break
        todo = dealt.join(large, ["mask", "value"], "left_semi")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def components(links: DataFrame, a: str = "fp", b: str = "to") -> DataFrame:
    """(node, root) for every node that ``links`` (longs) name: root is the
    smallest node of its component.  Alternating large-star and small-star steps;
    each step's links are written, and the steps end when nothing changes."""
    edges = saved(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .where("u <> v").distinct(), "links")

    def checksum(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = checksum(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = saved(least.select("u", F.least("u", "m").alias("m")), "least")
        edges = saved(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .where("u <> v").distinct(), "large-star")
        least = saved(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = edges.join(least, "u")
        edges = saved(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionByName(least.select("u", F.col("m").alias("v")))
                      .where("u <> v").distinct(), "small-star")
        now = checksum(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3,
                    distance: int = 3, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(id, fp, component_id): the fingerprint as a signed long, and the smallest
    id that is reachable over links of ``distance`` or fewer differing bits.

    Null, empty and blank texts have fingerprint 0 and are linked like any other.
    Rows are returned as often as they occur; a null id counts as no id in the
    minimum (a component of null ids has a null component_id)."""
    ids = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    prints = saved(fingerprints(ids, "text", ["id"], shingle), "fingerprints")
    least = saved(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    roots = components(bucket_links(least.select("fp"), distance, max_bucket))
    of = least.join(roots, F.col("fp") == F.col("node"), "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    # Only fingerprints with a link need their component's smallest id.
    joined = of.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = saved(of.join(joined, "root").select("fp", "component_id"), "classes")
    out = prints.join(classes, "fp")
    return out.select(F.col("id").alias(id_col), "fp", "component_id")


def hex_of(fp: str | Column) -> Column:
    """16 lower-case hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=3, distance=3)
    return out.select("doc_id", hex_of("fp").alias("fingerprint"), "component_id")


QUERIES = {"op9_simhash_dedup": op9_simhash_dedup}
ORACLES: dict[str, str] = {}
