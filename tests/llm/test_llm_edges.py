"""Every operator on awkward tables: nulls, empty and long texts, repeated rows,
no rows, and extra columns with the operators' own names."""

import pytest
from pyspark.sql import functions as F

from tickreport.llm import (improbable, language_id, license_rules, line_crf, line_dedup, maxent_lm, packing,
                            piece_sampling, quality_rules, simhash)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, n_lines long, "
          "n_dropped long, text_ string, host string, fp long, component_id long, length long, id string")
LONG = " ".join(f"word{i % 977} thing{i % 31}" for i in range(30_000)) + "\n" + "Licensed under CC BY-NC 4.0.\n" * 50


def _row(i, text, lang="en", source="s"):
    return (i, text, lang, source, 1, 9.0, 9, 9, "x", "h", 1, 1, 1, "i")


ROWS = [_row(1, "one two three four"), _row(1, "one two three four"), _row(2, None), _row(3, ""), _row(None, "a b c"),
        _row(None, None, None, None), _row(5, LONG, None), _row(6, " \n\t\n "), _row(7, "Ünï cödé ▁ 你好\n\nx  y", None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def _path(name):
    return pytest.importorskip("public_tokenizers").path(name)


def _unchanged(out, docs):
    assert out.columns[:len(docs.columns)] == docs.columns


def test_licenses(docs, nothing):
    out = license_rules.scan_licenses(docs)
    _unchanged(out, docs)
    got = {r["doc_id"]: r for r in out.where("doc_id is not null").collect()}
    assert got[5]["licenses"] == ["CC-BY-NC-4.0"] * 50 and got[2]["n_sentences"] == got[3]["n_sentences"] == 0
    assert out.count() == len(ROWS) and license_rules.scan_licenses(nothing).count() == 0


def test_quality_model(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, 0), (None, 1), (7, None)], "doc_id long, quality int")
    model = line_crf.train(docs, labels)
    out = line_crf.quality_scores(docs, model)
    _unchanged(out, docs)
    assert out.columns[-1] == "_score" and out.count() == len(ROWS)
    scores = [r[-1] for r in out.collect()]
    assert all(0 <= x <= 1 for x in scores)
    blank = line_crf.train(nothing, labels)
    assert line_crf.quality_scores(nothing, blank, name="q").count() == 0
    assert {r["q"] for r in line_crf.quality_scores(docs, blank, name="q").collect()} == {0.5}
    sizes = [len(r["line_good"]) for r in line_crf.line_labels(docs, model).orderBy("doc_id").collect()]
    assert sorted(sizes) == sorted((r[1] or "").count("\n") + 1 for r in ROWS)


def test_fingerprints(docs, nothing):
    rank = improbable.rarity(improbable.score_histogram(docs))
    out = improbable.fingerprint(docs, rank)
    _unchanged(out, docs)
    got = {(r["doc_id"], r["text"]): r["fingerprint"] for r in out.collect()}
    assert got[(2, None)] == got[(3, "")] == "0:"
    assert out.count() == len(ROWS) and improbable.fingerprint(nothing, rank).count() == 0


def test_packing(docs, nothing):
    path = _path("byte_bpe_50k.json")
    out = packing.pack_documents(docs, path)
    rows = out.collect()
    assert sum(r["length"] for r in rows) == sum(r["doc_tokens"] for r in rows if r["start"] == 0)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(r["start"] == 0 for r in rows) == len(ROWS)
    assert packing.pack_documents(nothing, path).count() == 0


def test_quality_rules(docs, nothing):
    out = quality_rules.quality_rules(docs)
    got = {r["doc_id"]: r for r in out.where("doc_id is not null").collect()}
    assert got[2]["n_words"] == got[3]["n_words"] == got[6]["n_words"] == 0 and got[6]["n_dup_lines"] == 0
    assert got[1]["n_words"] == 4 and got[1]["base_failed"] and not got[1]["kept"]
    assert got[5]["n_dup_lines"] == 49
    assert out.count() == len(ROWS) and quality_rules.quality_rules(nothing).count() == 0
    kept = quality_rules.remove_lines(docs, quality_rules.line_verdicts(docs, max_docs=0, min_kept=0.0))
    assert kept.columns == docs.columns and kept.count() == len(ROWS)


def test_language(docs, nothing):
    model = language_id.train(docs)
    rows = docs.withColumn("suffix", F.lit(None).cast("string"))
    out = language_id.identify(rows, model, "text", "id", "source", "suffix", ["doc_id", "score", "host"])
    assert out.columns == ["doc_id", "score", "host", "text_lang", "lang", "confidence"]
    assert out.count() == len(ROWS) and out.where("confidence is null or confidence > 1.000001").count() == 0
    assert language_id.identify(nothing.withColumn("suffix", F.lit("")), model, "text", "lang", "source", "suffix",
                                ["doc_id"]).count() == 0


def test_language_model(docs, nothing):
    model = maxent_lm.fit(docs, rounds=1)
    out = maxent_lm.lm_scores(docs, model)
    _unchanged(out, docs)
    got = {r["doc_id"]: r for r in out.where("doc_id is not null").collect()}
    assert got[2]["n_tokens"] == got[3]["n_tokens"] == got[6]["n_tokens"] == 1
    assert got[5]["n_tokens"] == got[5]["n_known"] == len(LONG.split()) + 1
    assert out.count() == len(ROWS)
    empty = maxent_lm.fit(nothing)
    row = maxent_lm.lm_scores(docs.where("doc_id = 1"), empty, keep=["doc_id"]).first()
    assert row["n_known"] == 0 and row["train_tokens"] == 0 and row["base_score"] == row["base_score"]


def test_line_dedup(docs, nothing):
    out = line_dedup.dedup_lines(docs, min_docs=2)
    _unchanged(out, docs)
    assert out.columns[-2:] == ["_n_lines", "_n_dropped"]
    got = {r["doc_id"]: r for r in out.where("doc_id is not null").collect()}
    assert got[1]["_n_dropped"] == 0 and got[2]["text"] == "" and got[2]["_n_lines"] == 1  # copies are one document
    assert got[6]["text"] == " \n\t\n " and got[6]["_n_lines"] == 3
    assert out.count() == len(ROWS) and line_dedup.dedup_lines(nothing).count() == 0


def test_simhash(docs, nothing):
    out = simhash.near_duplicates(docs).collect()
    got = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert len(out) == len(ROWS) and got[2]["fp"] == got[3]["fp"] == got[6]["fp"] == 0
    assert {got[i]["component_id"] for i in (2, 3, 6)} == {2}
    assert simhash.near_duplicates(nothing).count() == 0


def test_pieces(docs, nothing):
    path = _path("piece_bpe_32k.model")
    out = piece_sampling.decode(piece_sampling.encode(docs, path), path)
    _unchanged(out, docs)
    assert out.where("decoded <> coalesce(text, '')").count() == 0 and out.count() == len(ROWS)
    assert piece_sampling.encode(nothing, path).count() == 0
