"""Line dedup: drop lines whose key occurs in many documents.

Method: explode each document's distinct normalised lines as hashes, count the
distinct documents of each hash, keep the hashes at or over the threshold, send
them back to the documents that hold them, and reassemble the other lines by
position.  Lines travel as 128-bit hashes; the texts move once, in the last join.

A line of a third of all documents is no hot task: distinct (hash, document)
rows are formed first, counts are pre-aggregated on the map side, and the way
back is a join whose large partitions adaptive execution splits.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WHITE, append_columns, col, fresh, saved, slices, table, utf8

_STRIP = WHITE.encode()


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return line.strip(_STRIP).lower()  # bytes.lower() maps A-Z alone


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def frequent_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   min_docs: int = 10, min_chars: int = 1) -> tuple[DataFrame, DataFrame]:
    """(keys of each document, keys found in ``min_docs`` documents or more).

    The first table is (id, key), distinct; the second (key, n_docs).  Rows with
    one id are one document; a null id is an id like any other."""

    def factory():
        def keys(texts: pa.Array) -> list[pa.Array]:
            out = []
            for t in utf8(texts):
                found = {k for k in map(line_key, t.split(b"\n")) if k}
                if min_chars > 1:
                    found = {k for k in found if len(k.decode()) >= min_chars}
                out.append(sorted(map(_hash, found)))
            return [pa.array(out, pa.list_(pa.binary()))]

        return keys

    ids, keys = "id", "keys"
    exploded = append_columns(docs.select(col(id_col).alias(ids), col(text_col).alias("text")), "text",
                              [T.StructField(keys, T.ArrayType(T.BinaryType()))], factory, keep=[ids])
    pairs = saved(exploded.select(ids, F.explode(keys).alias("key")), "line-keys")
    counted = pairs.distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"))
    return pairs, saved(counted.where(F.col("n_docs") >= min_docs), "frequent-lines")


def dedup_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with the text replaced by its kept lines, joined by \\n, and the
    columns n_lines (before dropping) and n_dropped added (with leading
    underscores where ``docs`` has such names).

    Null and empty texts are one empty line, which is kept (keys of less than
    ``min_chars`` code points, at least 1, are never dropped).  Repeated rows of
    an id count as one document and each keeps its own lines; an empty table
    gives an empty result."""
    pairs, frequent = frequent_lines(docs, text_col, id_col, min_docs, max(1, min_chars))
    hits = pairs.join(frequent.select("key"), "key").groupBy("id").agg(F.collect_set("key").alias("drop"))
    n_lines, n_dropped, drop, hit_id = fresh(docs, "n_lines", "n_dropped", "drop_", "hit_id")
    hits = hits.select(F.col("id").alias(hit_id), F.col("drop").alias(drop))
    joined = docs.join(hits, col(id_col).eqNullSafe(F.col(hit_id)), "left").drop(hit_id)
    names = docs.columns
    at, schema = names.index(text_col), T.StructType(
        [T.StructField(f.name, f.dataType if f.name != text_col else T.StringType()) for f in docs.schema]
        + [T.StructField(n_lines, T.LongType()), T.StructField(n_dropped, T.LongType())])

    def run(batches):
        for whole in batches:
            for b in slices(whole, at):
                kept, total, gone = [], [], []
                for t, keys in zip(utf8(b.column(at)), b.column(len(names)).to_pylist()):
                    lines = t.split(b"\n")
                    total.append(len(lines))
                    if keys:
                        keys = set(keys)
                        lines = [x for x in lines if not (k := line_key(x)) or _hash(k) not in keys]
                        t = b"\n".join(lines)
                    kept.append(t)
                    gone.append(total[-1] - len(lines))
                cols = [b.column(i) for i in range(len(names))]
                cols[at] = pa.array(kept, pa.binary()).cast(b.column(at).type)
                yield pa.RecordBatch.from_arrays([*cols, pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                                 schema.names)

    return joined.select(*map(col, [*names, drop])).mapInArrow(run, schema)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), " \
       "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, i, lines[i] AS line FROM docs, range(1, 1 + len(lines)) AS r(i)),
keyed AS (SELECT *, {_KEY} AS key FROM lines),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUERIES = {"op8_line_dedup": op8_line_dedup}
ORACLES = {"op8_line_dedup": OP8_SQL}
