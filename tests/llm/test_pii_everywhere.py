"""Disclosing terms count and are marked over whole texts and in all texts (op10_pii_disclosure)."""

from postscope.llm import pii_disclosure as D

FAR = " filler words that say nothing at all" * 10


def spans(text, word):
    out, at = [], text.find(word)
    while at >= 0:
        out.append((at, at + len(word)))
        at = text.find(word, at + 1)
    return out


def test_terms_far_from_the_address_and_without_it(spark):
    rows = [(i, f"Report {'abcdefgh'[i] * 5} from Zebrowski.{FAR} Write to hidden@mail.example.com about {'stuvwxyz'[i] * 6} zebrowski") for i in range(8)]
    rows += [(50, f"ZEBROWSKI, Zebrowski and Zebrowskis here.{FAR} Zebrowski again"), (51, "\U0001F600 Zebrowski éZebrowski")]
    rows += [(100 + i, f"about the report {i} from others write more{FAR}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: sorted((s.start, s.end) for s in r.found if s.kind == D.TERM) for r in D.find(docs).collect()}
    for i, text in rows[:8]:
        assert found[i] == sorted(spans(text, "Zebrowski") + spans(text, "zebrowski"))
    text = rows[8][1]
    assert found[50] == sorted(spans(text, "ZEBROWSKI") + [x for x in spans(text, "Zebrowski") if text[x[1]:x[1] + 1] != "s"])
    assert found[51] == [(2, 11)] and not any(found[100 + i] for i in range(400))
    clean = {r.doc_id: r.text for r in D.sanitise(docs).collect()}
    assert "ebrowski" not in clean[0] and "[TERM] again" in clean[50] and clean[100] == dict(rows)[100]


def test_term_only_far_from_the_address(spark):
    """A name in the header of texts with the address at the end."""
    rows = [(i, f"Zebrowski {'abcdefgh'[i] * 5}{FAR} {'stuvwxyz'[i] * 6} hidden@mail.example.com") for i in range(8)]
    rows += [(100 + i, f"other text {i}{FAR}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [(s.start, s.end) for s in r.found if s.kind == D.TERM] for r in D.find(docs).collect()}
    assert all(found[i] == [(0, 9)] for i in range(8)) and not any(found[100 + i] for i in range(400))


def test_words_of_an_address_are_no_terms(spark):
    rows = [(i, f"{'abcdefgh'[i] * 5} someone@quuxcorp.example.com {'stuvwxyz'[i] * 6}") for i in range(8)]
    rows += [(50, "quuxcorp is a company")] + [(100 + i, f"other text {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {s.kind for r in D.find(docs).collect() for s in r.found} == {"email"}
