import math
import random
import re

from pyspark.sql import functions as F

from postscope.llm import quality_rules as Q
from postscope.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_statistics():
    rng = random.Random(7)
    for _ in range(200):
        text = "".join(rng.choice(["a", "b", "é", " ", " ", "\n", "#", " ", "\x1c", "\t"]) for _ in range(rng.randrange(60)))
        assert Q.statistics(text)[:5] == brute(text)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op8_risk_controlled_rules"](spark, sf).collect():
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_exact_bounds():
    for k, n, delta in ((0, 100, 0.05), (3, 50, 0.01), (10, 1000, 0.001)):
        p = Q.upper_bound(k, n, delta)
        tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(tail - delta) < 1e-6
        assert abs(Q.lower_bound(n - k, n, delta) - (1 - p)) < 1e-12
    assert Q.upper_bound(5, 5, 0.1) == 1.0 and abs(Q.upper_bound(0, 100, 0.05) - (1 - 0.05 ** 0.01)) < 1e-9


def documents(spark, good, bad, lang="en"):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(70)), lang, 1) for i in range(good)]
    rows += [(10**6 + i, " ".join(f"w{rng.randrange(5000)}***" for _ in range(70)), lang, 0) for i in range(bad)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    return df.drop("quality"), df.select("doc_id", "quality")


def test_cutoffs_reject_bad_and_keep_good(spark):
    docs, labels = documents(spark, 1500, 300)
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(1500))


def test_few_labels_reject_nothing(spark):
    docs, labels = documents(spark, 60, 30)
    assert Q.calibrate(docs, labels) == {"en": {}} and Q.keep_good(docs, labels).count() == 90


def test_strata_are_apart(spark):
    docs, labels = documents(spark, 1500, 300)
    other = docs.withColumns({"doc_id": F.col("doc_id") + 10**7, "lang": F.lit("xx")})
    cutoffs = Q.calibrate(docs.union(other), labels)
    assert list(cutoffs) == ["en"] and "symbols_per_word" in cutoffs["en"]
    assert Q.judge(other, labels).where("__q_kept").count() == 1800  # no rule has been proven for that stratum
