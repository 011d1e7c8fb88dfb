"""Helpers shared by the operators: tables, scratch copies, Arrow columns.

Text operators read a text column of any DataFrame.  Common rules: a null text
counts as empty, texts are processed whole, other columns of the input may have
any name (working columns take names that the input does not use), and rows are
never dropped, capped or sampled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir

#: ASCII white space: \x20 and \x09-\x0D.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the session's shared checkpoint folder and read
    back: lineage is cut, and the copy survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that ``df`` does not use (case-insensitively)."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def append_columns(df: DataFrame, text: str | Column, fields: list[T.StructField],
                   factory: Callable[[], Callable[[pa.Array], list[pa.Array]]],
                   keep: list[str] | None = None, most: int = 8 << 20) -> DataFrame:
    """``keep`` columns of ``df`` (default all) plus ``fields`` computed from the
    text column, about ``most`` bytes of text at a time; new names that ``keep`` has
    take leading underscores.  ``factory`` runs once per task and
    returns the function from a batch of texts to the new columns."""
    keep = df.columns if keep is None else keep
    tmp = fresh(df, "text_")[0]
    source = col(text) if isinstance(text, str) else text
    new = fresh(df.select(*map(col, keep)), *(f.name for f in fields))
    fields = [T.StructField(name, f.dataType) for name, f in zip(new, fields)]
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    n, names = len(keep), [*keep, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = factory()
        for b in batches:
            for part in slices(b, n, most):
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(n)] + fn(part.column(n)), names)

    return df.select(*map(col, keep), source.alias(tmp)).mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, at: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes in column ``at``, so
    that working memory follows bytes and not row counts."""
    rows, size = batch.num_rows, batch.column(at).nbytes
    step = max(1, rows if size <= most else rows * most // size)
    for i in range(0, rows, step):
        yield batch.slice(i, step)


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return [x or b"" for x in texts.cast(kind).to_pylist()]
