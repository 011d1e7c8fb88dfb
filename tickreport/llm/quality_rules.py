"""Quality rules: per-document base counts and cross-document line frequency.

Built from DataFrame functions alone.  Method: normalise and hash the lines of
every document, count the distinct documents of each (host, line), remove lines
above the limit, and reject documents that keep too little of themselves.

Documents are counted, copies included: a line of a thousand copies on one host is
found in a thousand documents.  For the counting, copies of one text on one host
travel as one text with its number of documents (rows of one id and text are one
document), so a group of thousands of copies is reduced on the map side.  Lines are
counted after a grouping by (host, line, text), so a line that a third of all
documents share is never gathered in one task; the way back to the documents is a
join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, fresh, saved, table

_WHITE_RE = r"[\x20\x09-\x0D]+"
_WORD_RE = r"[^\x20\x09-\x0D]"
_SYMBOLS_RE = "[#*$%&|<>]"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of non-blanks (ASCII white space), in order."""
    return F.filter(F.split(text, _WHITE_RE), lambda w: w != "")


def n_repeated(words: Column, width: int) -> Column:
    """How many words lie in a ``width``-word window found twice or more."""
    n = F.size(words) - (width - 1)

    def covered(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(r: Column) -> Column:
            twice = F.filter(r, lambda x, i: F.coalesce(F.get(r, i - 1)["h"] == x["h"], F.lit(False))
                             | F.coalesce(F.get(r, i + 1)["h"] == x["h"], F.lit(False)))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        # Each start covers up to the next start, `width` words at most.
        steps = lambda p: F.transform(p, lambda x, k: F.coalesce(
            F.least(F.get(p, k + 1) - x, F.lit(width)), F.lit(width)))
        total = F.aggregate(_let(_let(ranked, starts), steps), F.lit(0), lambda a, x: a + x)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(total)

    windows = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(words, i, width)))
    return F.when(n < 2, 0).otherwise(_let(windows, covered)).cast("long")


def base_counts(docs: DataFrame, text: Column, keep: list[str], width: int = 8) -> DataFrame:
    """``keep`` columns plus n_words, word_chars, n_symbols, n_dup_lines and
    n_repeat_words (long) of each whole text; a null text has none of them."""
    t, = fresh(docs, "text_")
    lines = lambda c: F.filter(F.split(c, "\n"), lambda x: x.rlike(_WORD_RE))
    row = docs.select(*map(col, keep), F.coalesce(text, F.lit("")).alias(t))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.regexp_replace(t, _SYMBOLS_RE, ""))).cast("long").alias("n_symbols"),
            _let(lines(F.col(t)), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            n_repeated(words, width).alias("n_repeat_words"))

    return row.select(*map(col, keep), F.inline(F.transform(F.array(words_of(F.col(t))), counts)))


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null for null."""
    return F.unhex(F.md5(text))


def line_key(line: Column) -> Column:
    """A line lower-cased, blanks collapsed, digit runs as one 0."""
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(line), _WHITE_RE, " "), "[0-9]+", "0"), F.lit(" "))


def line_verdicts(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_docs: int = 10,
                  min_kept: float = 0.25, id_col: str = "doc_id") -> DataFrame:
    """One row per (host, text hash) that holds a frequent line: host, text_hash,
    line_chars, removed_chars, removed (0-based positions of the lines found in
    more than ``max_docs`` documents of the host) and depleted (less than
    ``min_kept`` of the characters of its non-blank lines stay).

    A null host is the host ''; null, empty and blank texts have no lines and so
    no row; an empty table gives no rows."""
    lines = docs.select(
        F.coalesce(col(host_col), F.lit("")).alias("host"), text_key(col(text_col)).alias("text_hash"),
        F.posexplode(F.split(col(text_col), "\n")).alias("pos", "line"))
    lines = lines.select("host", "text_hash", "pos", line_key(F.col("line")).alias("line")).where("line <> ''")
    own = lines.groupBy("host", F.xxhash64("line").alias("key"), "text_hash").agg(
        F.collect_set("pos").alias("at"), F.max(F.length("line")).cast("long").alias("chars"))
    own = saved(own, "line-rows")
    # Only texts of several documents need their number; a null id is an id.
    copies = docs.where(col(text_col).isNotNull()).select(
        F.coalesce(col(host_col), F.lit("")).alias("host"), text_key(col(text_col)).alias("text_hash"),
        F.struct(col(id_col)).alias("id")).groupBy("host", "text_hash").agg(F.count_distinct("id").alias("n")) \
        .where("n > 1")
    counted = own.select("host", "key", "text_hash").join(copies, ["host", "text_hash"], "left")
    frequent = counted.groupBy("host", "key").agg(F.sum(F.coalesce("n", F.lit(1))).alias("n_docs")) \
        .where(F.col("n_docs") > max_docs)
    marked = own.join(frequent, ["host", "key"], "left")
    chars, hit = F.col("chars") * F.size("at"), F.col("n_docs").isNotNull()
    per_text = marked.groupBy("host", "text_hash").agg(
        F.sum(chars).alias("line_chars"), F.sum(F.when(hit, chars)).alias("removed_chars"),
        F.flatten(F.collect_list(F.when(hit, F.col("at")))).alias("removed")).where("removed_chars > 0")
    return per_text.withColumn("depleted", F.expr("line_chars - removed_chars") < min_kept * F.col("line_chars"))


def remove_lines(docs: DataFrame, verdicts: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``docs`` without the removed lines and without depleted documents."""
    h, x, removed, depleted = fresh(docs, "host_", "text_hash_", "removed_", "depleted_")
    v = verdicts.select(F.col("host").alias(h), F.col("text_hash").alias(x), F.col("removed").alias(removed),
                        F.col("depleted").alias(depleted))
    joined = docs.join(v, (F.coalesce(col(host_col), F.lit("")) == F.col(h))
                       & (text_key(col(text_col)) == F.col(x)), "left")

    def kept(lines: Column) -> Column:
        at = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(removed))
        return F.array_join(F.transform(at, lambda i: F.get(lines, i)), "\n")

    text = F.when(F.col(removed).isNull(), col(text_col)).otherwise(_let(F.split(col(text_col), "\n"), kept))
    out = joined.where(~F.coalesce(F.col(depleted), F.lit(False)))
    return out.select(*[text.alias(c) if c == text_col else col(c) for c in docs.columns])


def quality_rules(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", host_col: str = "source",
                  min_words: int = 20, max_repeat_pct: int = 30, max_docs: int = 10,
                  min_kept: float = 0.25) -> DataFrame:
    """Per row: the id, the base counts, base_failed, kept, line_chars and
    removed_chars (0 where no line is frequent).  Repeated rows each get their row;
    an id column named like one of these gets it under a name with underscores."""
    tmp_host, tmp_hash, tmp_id = "host_", "text_hash_", "id_"
    source = docs.select(col(id_col).alias(tmp_id), F.coalesce(col(host_col), F.lit("")).alias(tmp_host),
                         text_key(col(text_col)).alias(tmp_hash), col(text_col).alias("text"))
    base = base_counts(source, F.col("text"), [tmp_id, tmp_host, tmp_hash])
    verdicts = line_verdicts(docs, text_col, host_col, max_docs, min_kept, id_col)
    out = base.join(verdicts, (F.col(tmp_host) == F.col("host")) & (F.col(tmp_hash) == F.col("text_hash")), "left")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    found = {"n_words": F.col("n_words"), "word_chars": F.col("word_chars"), "n_symbols": F.col("n_symbols"),
             "n_dup_lines": F.col("n_dup_lines"), "n_repeat_words": F.col("n_repeat_words"), "base_failed": failed,
             "kept": ~failed & ~F.coalesce("depleted", F.lit(False)),
             "line_chars": F.coalesce("line_chars", F.lit(0)).cast("long"),
             "removed_chars": F.coalesce("removed_chars", F.lit(0)).cast("long")}
    names = fresh(docs.select(col(id_col)), *found)
    return out.select(F.col(tmp_id).alias(id_col), *[c.alias(n) for n, c in zip(names, found.values())])


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


OP5_SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS k FROM words, range(1, greatest(1, len(w) - 6)) AS r(i)),
twice AS (SELECT doc_id, i FROM windows
          QUALIFY count(*) OVER (PARTITION BY doc_id, k) >= 2),
repeats AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(0, 8) AS r(j) GROUP BY doc_id),
lines AS (SELECT doc_id, host, text, p, string_split(text, chr(10))[p] AS line
          FROM docs, range(1, 1 + len(string_split(text, chr(10)))) AS r(p)),
worded AS (SELECT * FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY doc_id),
keyed AS (SELECT *, trim(regexp_replace(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'),
                                        '[0-9]+', '0', 'g'), ' ') AS key FROM worded),
frequent AS (SELECT host, key FROM keyed GROUP BY host, key HAVING count(DISTINCT (doc_id, text)) > 10),
depleted AS (
  SELECT k.doc_id, sum(length(k.key)) AS line_chars,
         coalesce(sum(length(k.key)) FILTER (f.key IS NOT NULL), 0) AS removed_chars
  FROM keyed k LEFT JOIN frequent f ON k.host = f.host AND k.key = f.key GROUP BY k.doc_id),
base AS (
  SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
         CAST(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(u.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM docs d JOIN words w USING (doc_id) LEFT JOIN dups u USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT j.*, NOT base_failed AND NOT coalesce(p.line_chars - p.removed_chars < 0.25 * p.line_chars, false) AS kept,
       CAST(CASE WHEN p.removed_chars > 0 THEN p.line_chars ELSE 0 END AS BIGINT) AS line_chars,
       CAST(coalesce(p.removed_chars, 0) AS BIGINT) AS removed_chars
FROM judged j LEFT JOIN depleted p USING (doc_id)
"""

QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLES = {"op5_quality_rules": OP5_SQL}
