import hashlib

from postscope.llm import spotsigs as S
from postscope.llm.queries import QUERIES


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()), reverse=True)
    got = {r.doc_id: r for r in QUERIES["op3_spotsigs_fingerprints"](spark, sf).collect()}
    assert len(got) == len(docs)
    for k, (i, t) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        new = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
        signs, r = S.signatures(t), got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert r.fingerprint == S.fingerprint(signs) and r.edited_fingerprint == S.fingerprint(S.signatures(new))
        a, b, c = ({*map(int, S.parse(x))} for x in (r.fingerprint, r.edited_fingerprint, S.fingerprint(S.signatures(following))))
        for near, other in ((r.near_edited, b), (r.near_next, c)):
            exact = len(a & other) / len(a | other) if a | other else 1.0
            assert abs(near - (exact if exact >= 0.1 else 0.0)) < 1e-12
    near = sum(r.near_edited for r in got.values()) / len(got)
    assert near > 0.35 and sum(r.near_next for r in got.values()) / len(got) < 0.1


def test_length_classes_hold_similar_sets():
    for least in (0.1, 0.5, 0.75):
        for n in range(1, 400):
            for m in range(n, int(n / least) + 1):
                assert abs(S.length_class(n, least) - S.length_class(m, least)) <= 1


def test_signatures():
    assert len(S.signatures("the cat sat")) == 1 and len(S.signatures("The cat, sat!")) == 1
    assert S.signatures("the cat sat").tolist() == S.signatures("THE cat sat.").tolist()
    assert len(S.signatures("cat sat mat hat")) == 2  # no anchor: every word anchors the next two
    assert len(S.signatures("cat sat")) == 1 and len(S.signatures(" \n")) == 0
