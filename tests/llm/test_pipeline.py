import base64

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from test_line_dedup import brute as dropped_lines
from test_ngram_join import brute as groups

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, tmp_path):
    """Each stage against a brute-force version of its decision on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = before, docs
        if name != "byte_bpe":
            assert docs.columns == columns
    rows = {n: ([tuple(r) for r in a.select("doc_id", "text").collect()], b) for n, (a, b) in seen.items() if n != "byte_bpe"}

    before, after = rows["quality_rules"]
    kept = {r.doc_id for r in E.queries()["op8_risk_controlled_rules"](spark, SF).where("kept").collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, _ in before if i in kept)

    before, after = rows["line_dedup"]
    drops = dropped_lines(before)
    left = {i: len([x for x in t.split("\n") if x.strip()]) - drops[i] for i, t in before}
    got = {r.doc_id: len([x for x in r.text.split("\n") if x.strip()]) for r in after.collect()}
    assert got == {i: n for i, n in left.items() if n > 0}

    before, after = rows["ngram_jaccard_join"]
    assert sorted(r.doc_id for r in after.collect()) == [i for i, _, least in groups(before) if i == least]

    before, after = rows["poisson_mix"]
    assert {r.doc_id for r in after.collect()} <= {i for i, _ in before}

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in seen["byte_bpe"][0].collect()}
    assert all(list(r.ids) == enc.encode_ordinary(texts[r.doc_id]) for r in docs.collect())


def test_run(spark):
    out = E.queries()["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "ids"] and out.count() > 0 and out.where(F.size("ids") == 0).count() == 0
    names = list(E.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
