"""The corpus pipeline: quality, language, lines, near duplicates, packing.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickreport.llm import language_id, line_crf, line_dedup, packing, simhash
from tickreport.llm.common import col, fresh, saved, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier finds good (score 0.5 or more).  The
    model learns from the rows of ``labels`` that are still among ``docs``."""
    model = line_crf.train_on_labels(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")[0]
    return line_crf.quality_scores(docs, model, name=score).where(F.col(score) >= 0.5).select(*map(col, docs.columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; ``lang`` is the declared language, ``source``
    the host, and there is no address.  A document stays unless no language
    explains it, or the best one is unlikelier than not."""
    model = language_id.train(docs)
    # Working columns under names of their own: `lang` is both declared and found.
    keep = {c: n for c, n in zip(docs.columns, fresh(docs, *(f"doc_{i}" for i in range(len(docs.columns)))))}
    rows = docs.select(*[col(c).alias(n) for c, n in keep.items()]).withColumn("address", F.lit(""))
    out = language_id.identify(rows, model, keep["text"], keep["lang"], keep["source"], "address",
                               list(keep.values()))
    return out.where((F.col("lang") != language_id.UND) & (F.col("confidence") >= 0.5)) \
        .select(*[F.col(n).alias(c) for c, n in keep.items()])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines found in ten documents or more; n_chars
    is counted again where lines went."""
    dropped = fresh(docs, "n_lines", "n_dropped")[1]
    out = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)
    n_chars = F.when(F.col(dropped) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return out.select(*[n_chars.cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else col(c)
                        for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest doc_id.
    A row without a doc_id has no group and stays; of repeated rows one stays."""
    classes = simhash.near_duplicates(docs, shingle=3, distance=3)
    ids = saved(classes.where("doc_id = component_id").select("doc_id").distinct(), "representatives")
    kept = docs.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id IS NULL")).select(*map(col, docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens (as op4)."""
    import public_tokenizers

    return packing.packed_digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("language", language), ("line_dedup", lines), ("near_dedup", near_dedup),
          ("packing", pack)]

#: No SQL: the classifier, the language model and the index have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again in between."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"stage-{name}")
    return docs
