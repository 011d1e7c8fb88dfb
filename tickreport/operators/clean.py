"""End-of-day correction: keep the latest version of every event, whole.

The landing table may hold several versions of one event (same composite key,
later arrival).  ``latest_version`` keeps, per key, the one record that is last
by the version order, as a whole record (never one column from one version and
another column from another).  It is ``row_number() = 1`` over the version
order, which Spark plans with a partial ``WindowGroupLimit`` before the shuffle:
every map task forwards at most one row per key, so a key with a huge number of
versions never reaches one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import EVENT_KEY, QUOTE, QUOTE_COLUMNS, QUOTE_PAYLOAD, TRADE, TRADE_COLUMNS, TRADE_PAYLOAD


def latest_version(df: DataFrame, key: Sequence[str], payload: Sequence[str],
                   order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the payload of the row with the greatest ``order``.

    ``order`` must be total within a key (add a sequence column as the last
    element), otherwise the pick among equal orders is arbitrary.
    """
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    ranked = df.select(*key, *payload, *[c for c in order if c not in (*key, *payload)])
    return ranked.withColumn("_v", F.row_number().over(w)).where(F.col("_v") == 1).select(*key, *payload)


def select_trades(common: DataFrame) -> DataFrame:
    """Trade rows of the landing table, trade columns only."""
    return common.where(F.col("partition") == TRADE).select(*TRADE_COLUMNS, "ingest_seq")


def select_quotes(common: DataFrame) -> DataFrame:
    """Quote rows of the landing table, quote columns only."""
    return common.where(F.col("partition") == QUOTE).select(*QUOTE_COLUMNS, "ingest_seq")


def clean(df: DataFrame, payload: Sequence[str], key: Sequence[str] = EVENT_KEY,
          order: Sequence[str] = ("arrival_time", "ingest_seq"), columns: Sequence[str] | None = None
          ) -> DataFrame:
    """Latest version per composite event key, in the clean table's column order.
    Order columns missing from ``df`` (e.g. no ``ingest_seq`` on a table that
    did not come from a feed scan) are skipped."""
    extra = [c for c in ("arrival_time",) if c not in payload and c not in key]
    order = [c for c in order if c in df.columns] or ["arrival_time"]
    out = latest_version(df, key, [*extra, *payload], order)
    return out.select(*(columns or out.columns))


def clean_trades(trades: DataFrame) -> DataFrame:
    return clean(trades, TRADE_PAYLOAD, columns=TRADE_COLUMNS)


def clean_quotes(quotes: DataFrame) -> DataFrame:
    return clean(quotes, QUOTE_PAYLOAD, columns=QUOTE_COLUMNS)


def versions_per_key(df: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """Version audit per key: number of versions, distinct version values and
    the first and last of them.  Counts and bounds are partial aggregates, so
    no key's version list is ever materialised in one place."""
    return df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_versions"),
        F.count_distinct(version).alias("n_distinct_versions"),
        F.min(version).alias("first_version"),
        F.max(version).alias("last_version"),
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A3: distinct values of one column, kept as a DataFrame."""
    return df.select(col).distinct()
