import base64
import hashlib
import os
import subprocess
import sys
from functools import lru_cache

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from postscope.llm import byte_bpe
from postscope.llm.queries import QUERIES, vocabulary


@lru_cache
def reference():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_matches_tiktoken(spark):
    sf, enc = "/root/testdata/sf0.001", reference()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op4_byte_bpe"](spark, sf).collect():
        ids = enc.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_special_strings_spaces_and_offsets(spark):
    texts = ["<|endoftext|> it's  we'll\n\n x", "a b \U0001F469‍\U0001F680中文\u0000", "été 1234   ", "ẞ́ z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    enc = reference()
    rows = byte_bpe.encode(docs, *vocabulary(), offsets=True).orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        assert list(r.ids) == enc.encode_ordinary(t)
        pieces = [enc.decode_single_token_bytes(i) for i in r.ids]
        at = 0
        for a, b, piece in zip(r.starts, r.ends, pieces, strict=True):
            covered = t[a:b].encode()
            first = len(t[:a].encode())
            assert first <= at and at + len(piece) <= first + len(covered)  # whole characters around the bytes
            at += len(piece)
    back = byte_bpe.decode(byte_bpe.encode(docs, *vocabulary()), *vocabulary()).orderBy("doc_id").collect()
    assert [r.text for r in back] == texts and [bytes(r.data) for r in back] == [t.encode() for t in texts]


def test_split_characters_decode_to_their_bytes(spark):
    docs = spark.createDataFrame([(1, "\U0001F680")], "doc_id long, text string")
    ids = byte_bpe.encode(docs, *vocabulary())
    first = byte_bpe.decode(ids.withColumn("ids", F.slice("ids", 1, 1)), *vocabulary()).first()
    whole = byte_bpe.decode(ids, *vocabulary()).first()
    assert whole.text == "\U0001F680" and bytes(whole.data).startswith(bytes(first.data)) and "�" in first.text


def test_the_named_rank_table_is_the_vocabulary():
    """The vocabulary file has the ids of ``byte_bpe_50k.tiktoken``, token by token."""
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    codec = byte_bpe.Codec(*vocabulary())
    assert {b: i for i, b in enumerate(codec.bytes) if i in set(ranks.values())} == ranks


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text() | st.text("ab <|endofx>'s\n\t19é中\U0001F680"), max_size=6))
def test_any_text_encodes_as_tiktoken_does(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    codec, enc = byte_bpe.codec(*vocabulary()), reference()
    want = [enc.encode_ordinary(t) for t in texts]
    assert codec.encode(texts) == want
    n, ids, data = codec.digests(texts)
    assert n == [len(w) for w in want]
    assert ids == [hashlib.sha256(" ".join(map(str, w)).encode()).hexdigest() for w in want]
    assert data == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def test_remembered_pieces_are_bounded():
    codec = byte_bpe.Codec(*vocabulary(), limit=10, chars=1000)
    enc = reference()
    for k in range(50):
        text = f"word{k} another{k} " + "x" * (k * 40)
        assert codec.encode([text, ""]) == [enc.encode_ordinary(text), []]
        assert len(codec.pieces) <= 20


def test_encoding_starts_no_threads():
    """A task has one core, and each thread of the library keeps memory of its own."""
    code = """
import os
from postscope.llm import byte_bpe
from postscope.llm.queries import vocabulary
codec = byte_bpe.Codec(*vocabulary())
before = len(os.listdir("/proc/self/task"))
codec.encode([" ".join(f"word{k}" for k in range(9000))])
print(len(os.listdir("/proc/self/task")) - before)
"""
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"} | {"PYTHONPATH": os.pathsep.join(sys.path)}
    assert subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True).stdout.strip() == "0"
