"""Language ID by Bayesian evidence fusion.

Each row's classes are the known languages and ``und`` (no language).  The log
posterior adds four kinds of evidence:

* text: hashed byte-trigram likelihoods, tempered so that a long text counts as
  ``TEXT_WEIGHT`` independent trigrams at most; ``und`` is a uniform model;
* the declared markup language, by how often it is declared for each class;
* the address suffix (top-level domain, with a leading path segment that names a
  language), in the same way;
* the host's prior, smoothed towards its domain's and that towards the global
  one, each from sums of text posteriors, the row's own left out.

All counts are grouped aggregations over every row (a hot host is summed on the
map side first); tables of hosts and suffixes come back through joins whose large
partitions adaptive execution can split.  Only the trigram model is fitted on a
bounded sample: ``TRAIN_DOCS`` whole documents of each language by hash order.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, col, fresh, saved, table, utf8

LANGUAGES = ("de", "en", "es", "fr")
TRAIN_DOCS = 400
BUCKETS = 1 << 16
TEXT_WEIGHT = 60.0
ALPHA = 10.0  # rows' worth of the upper level in a lower level's prior
UND = "und"

_DROP = re.compile(r"(?is)<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*>?")
_DECLARED = r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})"


def page_text(page: str) -> str:
    """The text of a page: scripts, styles, comments and tags become a blank."""
    return html.unescape(_DROP.sub(" ", page))


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all texts, and each text's number of them.  Texts are
    lower-cased (A-Z) with a blank at either end; the empty text has none."""
    padded = [b" " + t.lower() + b" " if t.strip() else b"" for t in texts]
    sizes = np.array([max(0, len(t) - 2) for t in padded], np.int64)
    parts = []
    for t in padded:
        if t:
            b = np.frombuffer(t, np.uint8).astype(np.uint32)
            code = b[:-2] * np.uint32(0x01000193) ^ b[1:-1] * np.uint32(0x85EBCA6B) ^ b[2:] * np.uint32(0xC2B2AE35)
            parts.append((code ^ (code >> np.uint32(15))) & np.uint32(BUCKETS - 1))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32), sizes


def fit(texts: dict[str, list[bytes]]) -> np.ndarray:
    """(BUCKETS, languages + 1) log likelihoods, ``und`` last."""
    out = np.full((BUCKETS, len(texts) + 1), -np.log(BUCKETS), np.float32)
    for i, lang in enumerate(sorted(texts)):
        counts = np.bincount(_grams(texts[lang])[0], minlength=BUCKETS) + 0.05
        out[:, i] = np.log(counts / counts.sum())
    return out


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          languages: tuple[str, ...] = LANGUAGES, train_docs: int = TRAIN_DOCS) -> np.ndarray:
    """The trigram model of ``languages``, from ``train_docs`` different texts of each
    at most.  Hashes are picked first, so only the picked texts reach the driver."""
    texts = {}
    for lang in sorted(languages):
        own = docs.where((F.lower(col(lang_col)) == lang) & col(text_col).isNotNull()) \
            .select(col(text_col).alias("t"), F.xxhash64(col(text_col)).alias("h"))
        picks = own.select("h").distinct().orderBy("h").limit(train_docs)
        rows = own.join(F.broadcast(picks), "h").groupBy("h").agg(F.min("t").alias("t")).collect()
        texts[lang] = [r["t"].encode() for r in rows]
    return fit(texts)


def text_evidence(model: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Tempered log likelihoods (texts, classes); rows without trigrams are 0."""
    codes, sizes = _grams(texts)
    out = np.zeros((len(texts), model.shape[1]))
    some = np.flatnonzero(sizes)
    if len(some):
        starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
        for k in range(model.shape[1]):
            out[some, k] = np.add.reduceat(model[codes, k], starts, dtype=np.float64)
        n = sizes[some][:, None]
        out[some] *= TEXT_WEIGHT / (TEXT_WEIGHT + n)
        out[some] -= out[some].max(axis=1, keepdims=True)
    return out


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def suffix_of(url: Column, languages: tuple[str, ...] = LANGUAGES) -> Column:
    """Top-level domain and, if the path begins with a language, that: 'com/fr'."""
    tld = F.regexp_extract(host_of(url), r"\.([a-z]{2,24})$", 1)
    return F.concat(tld, F.regexp_extract(url, rf"^[^:]+://[^/?#]*(/(?:{'|'.join(languages)}))(?:[/?#]|$)", 1))


def domain_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1)


def identify(rows: DataFrame, model: np.ndarray, text_col: str, declared_col: str, host_col: str, suffix_col: str,
             keep: list[str], languages: tuple[str, ...] = LANGUAGES, alpha: float = ALPHA,
             html_text: bool = False) -> DataFrame:
    """``keep`` columns, text_lang (from the text alone), lang and confidence (its
    posterior).  ``und`` wins where no language explains the text better than
    chance; empty and null texts have no text evidence, and without any evidence
    the global prior decides; a null declared language, host or suffix is the
    value ''.  Ties go to the first class in order, ``und`` last.  Repeated rows
    are evidence each; an empty table stays empty."""
    classes = [*sorted(languages), UND]
    k = len(classes)

    def factory():
        def run(texts: pa.Array) -> list[pa.Array]:
            plain = utf8(texts)
            if html_text:
                plain = [page_text(t.decode()).encode() for t in plain]
            return [pa.array(text_evidence(model, plain).tolist(), pa.list_(pa.float64()))]

        return run

    d, h, s, e = fresh(rows, "declared_", "host_", "suffix_", "evidence_")
    known = F.lower(F.regexp_extract(F.coalesce(col(declared_col), F.lit("")), r"^([A-Za-z]+)", 1))
    base = rows.withColumn(d, F.when(known.isin(*classes[:-1]), known).when(known == "", "").otherwise("other")) \
        .withColumn(h, F.coalesce(col(host_col), F.lit(""))).withColumn(s, F.coalesce(col(suffix_col), F.lit("")))
    base = append_columns(base, text_col, [T.StructField(e, T.ArrayType(T.DoubleType()))], factory,
                          [*keep, d, h, s], most=1 << 20)
    lik = F.transform(F.col(e), lambda x: F.exp(x))
    post = F.transform(lik, lambda x: x / F.aggregate(lik, F.lit(0.0), lambda a, b: a + b))
    p = fresh(base, "own_")[0]
    base = saved(base.withColumn(p, post), "language-evidence")

    def sums(by: Column, name: str) -> DataFrame:
        got = base.groupBy(by.alias(name)).agg(*[F.sum(F.col(p)[i]).alias(f"c{i}") for i in range(k)])
        return saved(got.select(name, F.array(*[f"c{i}" for i in range(k)]).alias(f"{name}_n")), name)

    def joined(left: DataFrame, by: Column, name: str) -> DataFrame:
        return left.join(counts[name], by == counts[name][name]).drop(name)

    keys = {"by_declared": F.col(d), "by_suffix": F.col(s), "by_host": F.col(h), "by_domain": domain_of(F.col(h))}
    counts = {name: sums(by, name) for name, by in keys.items()}
    # The global counts: one row of k numbers.
    world = base.agg(*[F.sum(F.col(p)[i]) for i in range(k)]).first()
    world = [float(x or 0.0) for x in world]
    out = base
    for name, by in keys.items():
        out = joined(out, by, name)
    schema = T.StructType([rows.schema[c] for c in keep] + [
        T.StructField("text_lang", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("confidence", T.DoubleType())])
    n_keep, levels = len(keep), list(keys)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            evidence, own, *counted = (b.column(i).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
                                       for i in range(n_keep, n_keep + 2 + len(levels)))
            logs = fused(evidence, own, dict(zip(levels, counted)), np.array(world), alpha)
            best = logs.max(axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(n_keep)]
                + [pa.array([classes[i] for i in evidence.argmax(axis=1)]),
                   pa.array([classes[i] for i in logs.argmax(axis=1)]),
                   pa.array(1.0 / np.exp(logs - best).sum(axis=1))], schema.names)

    return out.select(*map(col, keep), e, p, *[f"{name}_n" for name in levels]).mapInArrow(run, schema)


def fused(evidence: np.ndarray, own: np.ndarray, counts: dict[str, np.ndarray], world: np.ndarray,
          alpha: float) -> np.ndarray:
    """Log posteriors (rows, classes) up to a constant, from the text's evidence and
    the counts of each row's declared language, suffix, host, domain and of all
    rows, less the row's own share."""
    less = {name: np.maximum(n - own, 0.0) for name, n in counts.items()}
    rest = np.maximum(world - own, 0.0)
    prior = (rest + 1.0) / (rest + 1.0).sum(axis=1, keepdims=True)
    for level in ("by_domain", "by_host"):
        n = less[level]
        prior = (n + alpha * prior) / (n.sum(axis=1, keepdims=True) + alpha)
    out = evidence + np.log(prior)
    for name in ("by_declared", "by_suffix"):  # P(value | class); a class without rows tells nothing
        out = out + np.log((less[name] + 0.5) / (rest + 1.0))
    return out


def identify_pages(pages: DataFrame, model: np.ndarray, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """page_id, host, declared, suffix, text_lang, lang, confidence of web pages (url, html)."""
    rows = pages.select(
        "page_id", "html", host_of(F.col("url")).alias("host"), suffix_of(F.col("url"), languages).alias("suffix"),
        F.regexp_extract("html", _DECLARED, 1).alias("declared"))
    return identify(rows, model, "html", "declared", "host", "suffix", ["page_id", "host", "declared", "suffix"],
                    languages, html_text=True)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = train(table(spark, sf_dir, "documents"))
    return identify_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"), model)


QUERIES = {"op6_language_id": op6_language_id}
ORACLES: dict[str, str] = {}
