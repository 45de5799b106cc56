import random

from postscope.llm import secret_scan as S


def test_base_spans():
    text = 'api_key: "abcdefgh1" PassWord = short AKIAABCDEFGHIJKL AKIASHORT ' + "a1" * 16 + " token=secret=abcdefghi9"
    found = [(S.KINDS[k], text[a:b]) for a, k, b in S.base_spans(text)]
    assert found == [("assign", 'api_key: "abcdefgh1'), ("access", "AKIAABCDEFGHIJKL"), ("hex", "a1" * 16), ("assign", "token=secret=abcdefghi9")]
    assert S.base_spans("paſſword=abcdefgh1") == []  # letters in either case are ASCII letters
    assert S.base_spans("token: token: abcdefghij") == []  # the failing match takes the second word with it


def test_candidates_avoid_base_spans():
    text = "x" * 20 + " 1234567890abcdefgh " + "0123456789abcdef" * 2 + " AB12AB12AB12AB12AB12"
    found = [text[a:b] for a, b in S.candidates(text, S.base_spans(text))]
    assert found == ["1234567890abcdefgh", "AB12AB12AB12AB12AB12"]


def test_automaton_merges_and_ranks():
    rng = random.Random(4)
    keys = ["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16)) for _ in range(300)]
    machine = S.Automaton(keys, 0.05)
    own = min(S._rate(machine, k) for k in keys[:50])
    assert own > S._rate(machine, "thequickbrownfox12345") and own > S._rate(machine, "4111-1111-1111-1111")


def test_format_spans(spark):
    """Keys of a labelled format are found without their prefix pattern; card numbers and words aren't."""
    rng = random.Random(5)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"

    def key(prefix):
        return prefix + "".join(rng.choice(upper) for _ in range(16))

    rows = [(i, f"some words before {key('AKIA')} and after") for i in range(300)]
    rows += [(1000 + i, f"card {rng.randrange(4 * 10**15, 5 * 10**15)} and build_2024_release_{i:05d}_notes here") for i in range(300)]
    rows += [(5000 + i, f"hidden {key('ASIA')} here") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found] for r in S.scan(docs).collect()}
    assert all([k for k, _, _ in found[i]] == ["access"] for i in range(300))
    hits = [found[5000 + i] for i in range(5)]  # a format may lose a few of its strings (Settings.tolerated)
    assert all(h in ([], [("format", 7, 27)]) for h in hits) and sum(map(len, hits)) >= 4
    assert not any(found[1000 + i] for i in range(300))


def test_redact():
    assert S.redact("a token=abcdefgh1 b", [("assign", 2, 17), ("format", 8, 17)]) == "a [SECRET] b"
