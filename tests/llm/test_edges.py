"""Nulls, empty and long texts, repeated rows, empty tables and extra columns
with clashing names, for every operator."""

import pytest
from pyspark.sql import functions as F

from postscope.llm import (byte_bpe, language_id, line_dedup, ngram_join, pii_disclosure, poisson_mix, quality_fm, quality_rules,
                           secret_scan, spotsigs)
from postscope.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("ids", "node", "key", "label", "root", "n", "sig", "rid", "kind", "range", "order", "rank", "score", "fingerprint", "spans")
LONG = "the quick brown fox jumps over the lazy dog and " * 4000
ROWS = [
    (1, "One plain line of ordinary words that says very little.\nAnd a second line.", "en", "a", 70),
    (1, "One plain line of ordinary words that says very little.\nAnd a second line.", "en", "a", 70),
    (2, None, "en", None, None),
    (3, "", None, "a", 0),
    (None, "A row without an id but with words in it.", "en", "b", 41),
    (None, None, None, None, None),
    (4, " \n\t ", "fr", "b", 4),
    (5, LONG, "en", "b", len(LONG)),
    (6, "9" * 5000, "en", "c", 5000),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (5, 1)], "doc_id long, quality int")


def ids(rows):
    return sorted(r.doc_id is None and -1 or r.doc_id for r in rows)


ALL = sorted(r[0] if r[0] is not None else -1 for r in ROWS)


def test_ngram_join(docs, none):
    rows = ngram_join.join(docs).collect()
    assert ids(rows) == ALL
    by = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert by[3, 0] == 3 and by[4, 0] == 4 and by[2, 0] == 2 and by[None, 0] is None
    assert by[None, 6] is None and by[6, 1] == 6 and by[1, 10] == 1
    assert sorted(r.doc_id or -1 for r in ngram_join.keep_one(docs).collect()) == ALL  # repeated rows are one document
    assert ngram_join.join(none).count() == 0 and ngram_join.keep_one(none).count() == 0


def test_byte_bpe(docs, none):
    rows = byte_bpe.digests(docs, *vocabulary()).collect()
    assert ids(rows) == ALL and {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
    assert byte_bpe.encode(none, *vocabulary(), offsets=True).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.encode(docs, *vocabulary(), keep=("doc_id", "ids"))


def test_secret_scan(docs, none):
    rows = secret_scan.scan(docs).collect()
    assert ids(rows) == ALL and [(r.doc_id, s.kind, s.start, s.end) for r in rows for s in r.found] == [(6, "hex", 0, 5000)]
    assert secret_scan.scan(none).count() == 0


def test_spotsigs(docs, none):
    rows = spotsigs.edited(docs).collect()
    assert ids(rows) == ALL
    assert {r.fingerprint for r in rows if r.n_chars == 0 or r.doc_id == 4} == {""}
    assert spotsigs.edited(none).count() == 0
    assert len(spotsigs.fingerprints(docs).collect()) == len(ROWS)
    lone = spotsigs.edited(docs.where("doc_id = 5")).collect()
    assert len(lone) == 1 and lone[0].near_next == 1.0


def test_poisson_mix(docs, none):
    rows = poisson_mix.copies(docs).collect()
    assert ids(rows) == ALL
    assert len({r["__n"] for r in rows if r.doc_id == 1}) == 1  # repeated rows draw alike
    mixed = poisson_mix.mix(docs, {"a": 1.0, "z": 2.0}, total=50)
    assert {r.source for r in mixed.collect()} == {"a"} and set(docs.columns) <= set(mixed.columns)
    assert poisson_mix.mix(none).count() == 0


def test_language_id(docs, none):
    rows = language_id.identify(docs, F.col("doc_id").isNotNull()).collect()
    assert ids(rows) == ALL
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 6)} == {"und"} and all(0 <= r.score <= 1 for r in rows)
    assert language_id.identify(none, F.lit(True)).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, F.lit(False)).collect()} == {"und"}


def test_line_dedup(docs, none):
    rows = line_dedup.marked(docs).collect()
    assert ids(rows) == ALL
    assert all(not r["__drops"] for r in rows if r.doc_id != 5)  # the repeated row is the same occurrence
    assert line_dedup.dedup(docs).columns == docs.columns and line_dedup.dedup(docs).count() == len(ROWS)
    assert line_dedup.dedup(none).count() == 0


def test_quality_rules(docs, none, labels):
    out = quality_rules.judge(docs, labels)
    rows = out.collect()
    assert ids(rows) == ALL and {r["__q_base_failed"] for r in rows} == {True}
    assert quality_rules.keep_good(none, labels).columns == none.columns
    assert quality_rules.judge(docs, labels.limit(0)).count() == len(ROWS)


def test_quality_fm(docs, none, labels):
    for marks in (labels, labels.limit(0), labels.where("quality = 1")):
        machine = quality_fm.train(docs, marks, F.lit(True))
        rows = quality_fm.score(docs, machine).collect()
        assert ids(rows) == ALL and all(0 <= r.score <= 1 for r in rows)
    assert quality_fm.score(none, quality_fm.train(none, labels, F.lit(True))).count() == 0
    assert {round(r.score, 3) for r in quality_fm.score(docs, quality_fm.train(docs, labels.limit(0), F.lit(True))).collect()} == {0.5}


def test_pii_disclosure(docs, none):
    rows = pii_disclosure.find(docs).collect()
    assert ids(rows) == ALL and not any(r.found for r in rows)
    clean = pii_disclosure.sanitise(docs)
    assert clean.columns == docs.columns and clean.exceptAll(docs).count() == 0
    assert pii_disclosure.find(none).count() == 0
