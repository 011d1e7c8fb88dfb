"""Merkle dataset manifest: a digest tree per source, a tree of the sources'
roots, and for every row the proof that leads from its leaf to the root.

A node is the SHA-256 (lowercase hex) of its children's hex digests.  Every
``arity`` consecutive nodes of a level make one node of the next, the last run
even when it is shorter; a tree ends when one node remains, so a lone leaf is
its own root.

Method: cogrouped subtree exchange.  A *superblock* is arity ** levels
consecutive nodes of one tree.  Going up, each superblock is reduced to its top
node in one group, and the tops are the nodes of the next round, until every
tree has one.  Going down, each node's *path* (its siblings, level by level up
to the root) is its superblock's path behind its own levels: nodes and the outer
paths are cogrouped by superblock, and ``applyInPandas`` rebuilds the local
levels, joins the proofs and folds the leaves in the same step.

A group holds at most arity ** levels digests whatever the source holds, no text
leaves the task that hashes it, and the number of rounds is the logarithm of the
largest source.  Rows are numbered inside their source by a range partitioning
that is written once (``ordered.numbered``).

Defined results: null columns enter the leaf as ``-``; a null id sorts first and
is never tampered with; a null source is a source of its own, the first; rows of
one id are ordered by their leaf; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, saved, table
from .ordered import numbered

ARITY, LEVELS = 3, 6  # superblocks of 729 nodes


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def part_text(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` if null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(part_text, values)), 256)


def levels_of(nodes: list[str], total: int, arity: int, levels: int) -> Iterator[list[str]]:
    """The levels of a superblock from its nodes to its top; ``total`` is the
    number of nodes of the whole tree in this round.  A superblock that is the
    whole tree ends with one node, one of several after ``levels`` levels."""
    whole = total <= arity ** levels
    for _ in range(levels):
        yield nodes
        if whole and len(nodes) == 1:
            return
        nodes = [digest("".join(nodes[i:i + arity])) for i in range(0, len(nodes), arity)]
    yield nodes


def local_paths(rows: list[list[str]], arity: int) -> list[str]:
    """The path of every node of rows[0] below the top.  A path has one part per
    level, joined by ``,``: the digests left of the node, ``|``, those right of it."""
    paths = [""] * len(rows[0])
    for depth, nodes in enumerate(rows[:-1]):
        beside = []
        for i in range(len(nodes)):
            first = i // arity * arity
            beside.append("".join(nodes[first:i]) + "|" + "".join(nodes[i + 1:first + arity]))
        step = arity ** depth
        paths = [joined(p, beside[i // step]) for i, p in enumerate(paths)]
    return paths


def joined(inner: str, outer: str) -> str:
    return f"{inner},{outer}" if inner and outer else inner or outer


def fold(node: str, path: str) -> str:
    """The root that a node and its path lead to."""
    for level in path.split(",") if path else ():
        left, right = level.split("|")
        node = digest(left + node + right)
    return node


def siblings(path: str) -> str:
    """All digests of a path, from the leaf's siblings to the root's children."""
    return path.replace("|", "").replace(",", "")


class _Trees:
    """Rounds of many trees.  Nodes are (tree, leaves, pos, digest); ``leaves`` is
    the tree's number of leaves, from which its size in any round follows."""

    def __init__(self, arity: int, levels: int):
        self.arity, self.levels, self.width = arity, levels, arity ** levels

    def size(self, round_: int) -> Column:
        w = self.width ** round_
        return F.expr(f"(leaves + {w - 1}) div {w}")

    def blocks(self, nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("block", F.expr(f"pos div {self.width}")) \
            .withColumn("place", F.expr(f"pos % {self.width}"))

    def up(self, nodes: DataFrame, most: int) -> list[DataFrame]:
        """The nodes of every round; the last has one node per tree."""
        rounds = [nodes]
        while most > 1:
            r = len(rounds) - 1
            arity, levels = self.arity, self.levels

            def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
                rows = pdf.sort_values("place")
                *_, top = levels_of(rows["digest"].tolist(), int(rows["total"].iloc[0]), arity, levels)
                first = rows[["tree", "leaves", "block"]].head(1)
                return first.rename(columns={"block": "pos"}).assign(digest=top[0])

            open_ = self.blocks(rounds[-1].where(self.size(r) > 1)).withColumn("total", self.size(r))
            tops = open_.select("tree", "leaves", "block", "place", "total", "digest").groupBy("tree", "block") \
                .applyInPandas(reduce, "tree long, leaves long, pos long, digest string")
            rounds.append(saved(tops.unionByName(rounds[-1].where(self.size(r) == 1)), "merkle-nodes"))
            most = -(-most // self.width)
        return rounds

    def down(self, rounds: list[DataFrame], paths: DataFrame, to: int = 0) -> DataFrame:
        """Paths (tree, leaves, pos, path) of the nodes of round ``to`` from those of the last round."""
        arity, levels = self.arity, self.levels

        def exchange(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
            nodes = nodes.sort_values("place")
            rows = list(levels_of(nodes["digest"].tolist(), int(nodes["total"].iloc[0]), arity, levels))
            beyond = outer["path"].iloc[0]
            return nodes[["tree", "leaves", "pos"]].assign(path=[joined(p, beyond) for p in local_paths(rows, arity)])

        for r in range(len(rounds) - 2, to - 1, -1):
            open_ = self.blocks(rounds[r].where(self.size(r) > 1)).withColumn("total", self.size(r))
            outer = paths.where(self.size(r) > 1).select("tree", F.col("pos").alias("block"), "path")
            found = open_.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")) \
                .applyInPandas(exchange, "tree long, leaves long, pos long, path string")
            paths = found.unionByName(paths.where(self.size(r) == 1))
        return paths


def manifest(rows: DataFrame, id_col: str = "doc_id", group_col: str = "source", leaf_col: str = "leaf",
             shown_col: str | None = None, arity: int = ARITY, levels: int = LEVELS,
             with_path: bool = False) -> DataFrame:
    """One row per row of ``rows``: the id, ``leaf``, ``subroot`` (of the row's
    group), ``root``, ``proof_sha256`` (digest of its siblings up to the root),
    ``folded_root`` (what the leaf in ``shown_col`` and those siblings lead to;
    default: the leaf itself) and ``verified`` (folded_root = root); ``path``, the
    proof itself, if asked for."""
    spark = rows.sparkSession
    id_type = rows.schema[id_col].dataType
    picked = rows.select(col(id_col).alias("id"), col(group_col).alias("grp"), col(leaf_col).alias("leaf"),
                         col(shown_col or leaf_col).alias("shown"))
    # Hashed once: the sampling of the ranges must not hash the texts again.
    leaves = numbered(saved(picked, "merkle-leaves"), ["grp", "id", "leaf", "shown"], "merkle-order")
    groups = numbered(leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("leaves"), F.min("pos").alias("first")),
                      ["grp"], "merkle-groups").select("grp", "leaves", "first", F.col("pos").alias("tree"))
    most, n_groups = groups.agg(F.max("leaves"), F.count(F.lit(1))).first()
    # A range of the order holds a bounded share of a hot group, so groups are looked up per range.
    held = leaves.select(F.col("part").alias("p"), F.col("grp").alias("g")).distinct() \
        .join(groups, F.col("g").eqNullSafe(F.col("grp"))).drop("grp")
    placed = leaves.join(held, (F.col("part") == F.col("p")) & F.col("grp").eqNullSafe(F.col("g"))).select(
        "tree", "leaves", (F.col("pos") - F.col("first")).alias("pos"), "leaf", "shown",
        F.col("id").cast("string").alias("id"))

    trees = _Trees(arity, levels)
    ups = trees.up(placed.select("tree", "leaves", "pos", F.col("leaf").alias("digest")), most or 0)
    subroots = ups[-1].select("tree", "leaves", F.col("digest").alias("subroot"))
    tops = trees.up(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(n_groups).cast("long").alias("leaves"),
                                    F.col("tree").alias("pos"), F.col("subroot").alias("digest")), n_groups)
    last = tops[-1].first()
    root = last["digest"] if last else ""
    ends = tops[-1].select("tree", "leaves", "pos", F.lit("").alias("path"))
    outer = trees.down(tops, ends).select(F.col("pos").alias("tree"), "path")
    outer = saved(outer.join(subroots, "tree"), "merkle-subroots")
    ends = outer.select("tree", "leaves", F.lit(0).cast("long").alias("pos"), "path")
    inner = saved(trees.down(ups, ends, 1), "merkle-paths") if len(ups) > 1 else ends
    required = inner.select("tree", F.col("pos").alias("block"), "path").join(outer.select("tree", "subroot"), "tree")

    def finish(nodes: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("place")
        below = list(levels_of(nodes["leaf"].tolist(), int(nodes["leaves"].iloc[0]), arity, levels))
        beyond = outside["path"].iloc[0]
        paths = [joined(p, beyond) for p in local_paths(below, arity)]
        folded = [fold(x, p) for x, p in zip(nodes["shown"], paths)]
        out = nodes[["id", "leaf"]].assign(subroot=outside["subroot"].iloc[0], root=root,
                                           proof_sha256=[digest(siblings(p)) for p in paths], folded_root=folded,
                                           verified=[x == root for x in folded])
        return out.assign(path=paths) if with_path else out

    blocks = trees.blocks(placed).select("tree", "block", "place", "leaves", "id", "leaf", "shown")
    out = blocks.groupBy("tree", "block").cogroup(required.groupBy("tree", "block")).applyInPandas(
        finish, "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                "verified boolean" + ", path string" * with_path)
    return out.select(F.col("id").cast(id_type).alias(id_col), *out.columns[1:])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents as a leaf; texts of ids with an even CRC-32 are
    shown without their \\n characters."""
    docs = table(spark, sf_dir, "documents")
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest(docs.select("doc_id", "source", leaf_digest([F.col(c) for c in names]).alias("leaf"),
                                leaf_digest([*map(F.col, names[:-1]), text]).alias("shown")), shown_col="shown")


#: CRC-32 of the id's decimal text, bit by bit (DuckDB has no function for it).
_CRC = """xor(list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''),
            lambda c: list_transform(range(8), lambda i: (ascii(c)::BIGINT >> i) & 1))),
        lambda x, b: xor(x >> 1, 3988292384 * (xor(x, b) & 1)), 4294967295), 4294967295)"""

OP11_SQL = f"""
WITH RECURSIVE
parts AS (SELECT doc_id, source,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    text FROM documents),
leaves AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(bare) || ':' || bare, '-')) AS bare_leaf
    FROM (SELECT *, replace(text, chr(10), '') AS bare FROM parts)),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, bare_leaf) - 1 AS pos
    FROM leaves),
sources AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree
    FROM leaves GROUP BY source),
below AS (
    SELECT s.tree, 0 AS level, p.pos, s.n, p.leaf AS node FROM placed p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source
    UNION ALL
    SELECT tree, level + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(node, '' ORDER BY pos))
    FROM below WHERE n > 1 GROUP BY tree, level, pos // 3),
subroots AS (SELECT tree, level, node FROM below WHERE n = 1),
above AS (
    SELECT 0 AS level, tree AS pos, (SELECT count(*) FROM subroots) AS n, node FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(node, '' ORDER BY pos))
    FROM above WHERE n > 1 GROUP BY level, pos // 3),
root AS (SELECT node FROM above WHERE n = 1),
beside AS (
    SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
           coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
    FROM below a JOIN below b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL
    UNION ALL
    SELECT NULL, a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), ''),
           coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '')
    FROM above a JOIN above b ON a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL),
steps AS (
    SELECT p.doc_id, p.leaf, p.bare_leaf, s.tree, p.pos, b.level, b.l, b.r
    FROM placed p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source
    JOIN beside b ON b.tree = s.tree AND b.pos = p.pos // (3 ** b.level)::BIGINT
    UNION ALL
    SELECT p.doc_id, p.leaf, p.bare_leaf, s.tree, p.pos, t.level + b.level, b.l, b.r
    FROM placed p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source JOIN subroots t ON t.tree = s.tree
    JOIN beside b ON b.tree IS NULL AND b.pos = s.tree // (3 ** b.level)::BIGINT),
proofs AS (
    SELECT p.doc_id, p.leaf, s.tree, p.pos, CASE WHEN p.shown THEN p.bare_leaf ELSE p.leaf END AS start,
           coalesce(list(t.l ORDER BY t.level) FILTER (t.level IS NOT NULL), []) AS ls,
           coalesce(list(t.r ORDER BY t.level) FILTER (t.level IS NOT NULL), []) AS rs
    FROM (SELECT *, coalesce(crc32_even, false) AS shown FROM (SELECT *, {_CRC} % 2 = 0 AS crc32_even FROM placed)) p
    JOIN sources s ON p.source IS NOT DISTINCT FROM s.source LEFT JOIN steps t ON t.tree = s.tree AND t.pos = p.pos
    GROUP BY ALL),
folds AS (
    SELECT tree, pos, 0 AS level, start AS node, ls, rs FROM proofs
    UNION ALL
    SELECT tree, pos, level + 1, sha256(ls[level + 1] || node || rs[level + 1]), ls, rs FROM folds WHERE level < len(ls))
SELECT p.doc_id, p.leaf, u.node AS subroot, r.node AS root,
       sha256(array_to_string(list_transform(list_zip(p.ls, p.rs), lambda x: x[1] || x[2]), '')) AS proof_sha256,
       f.node AS folded_root, f.node = r.node AS verified
FROM proofs p JOIN subroots u ON u.tree = p.tree JOIN folds f ON f.tree = p.tree AND f.pos = p.pos AND f.level = len(p.ls), root r
"""

QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
ORACLES = {"op11_merkle_manifest": OP11_SQL}
