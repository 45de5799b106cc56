"""Byte-level BPE encoding and decoding (the ``tokenizers`` library).

``encode`` turns whole texts into token ids with the character span of every
token; ``decode`` turns ids back into bytes and text by reversing the byte
table. Texts run through the library in Arrow batches; each distinct match of
the splitting pattern goes through it once per task and its ids are reused (the
memory for them is bounded and given back at the end of the task).

Null text reads as empty; empty text has no tokens. Rows are never merged:
repeated rows each get their own result. Extra columns pass through when
listed in ``keep``; results are added under the names given here, so a
listed column may not be called like one of them.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postscope.llm.common import arrow_map, per_task, texts


def byte_alphabet() -> dict[str, int]:
    """Character of the vocabulary file -> byte: printable Latin-1 bytes stand
    for themselves, the others for U+0100 onwards in byte order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Pieces(dict):
    """piece -> its number; pieces met for the first time are listed in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Table:
    """Byte strings one after another, to be joined by their numbers."""

    def __init__(self, rows: Sequence[bytes]):
        self.lengths = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(rows) or b"\0", dtype=np.uint8)

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strings of the numbers joined, and the end of each."""
        return joined(self.data, self.starts[numbers], self.lengths[numbers])


def joined(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``data`` one after another, and the end of each."""
    ends = np.cumsum(lengths)
    at = np.arange(int(ends[-1]) if len(ends) else 0)
    return data[at + np.repeat(starts - ends + lengths, lengths)], ends


class Codec:
    """One vocabulary file: encoder, remembered pieces, token bytes."""

    def __init__(self, path: str, pattern: str, limit: int = 200_000, chars: int = 4_000_000):
        # A task has one core; threads of the library would each keep memory of their own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        # The pieces given to the library are matches of the pattern already.
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.find = regex.compile(pattern).findall
        self.limit, self.chars = limit, chars
        self.forget()
        alphabet = byte_alphabet()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.table = Table(self.bytes)
        self.decimal = Table([b"%d " % i for i in range(len(self.bytes))])
        self.lengths = self.table.lengths

    def forget(self) -> None:
        """Drop the remembered pieces."""
        self.pieces, self.held = Pieces(), 0
        # the ids of piece k are ids[starts[k] : starts[k] + sizes[k]]
        self.ids, self.sizes = np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)

    def encode_flat(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the end of each text."""
        if len(self.pieces) > self.limit or self.held > self.chars:
            self.forget()
        found = [self.find(t) for t in batch]
        of = np.fromiter(map(self.pieces.__getitem__, chain.from_iterable(found)), dtype=np.int64, count=sum(map(len, found)))
        if new := self.pieces.new:
            parts = [new[k : k + 2000] for k in range(0, len(new), 2000)]
            rows = self.tokenizer.encode_batch_fast(parts, is_pretokenized=True, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, dtype=np.int32) for e in rows])
            # a piece has the tokens up to its last byte
            bytes_of = np.fromiter((len(p) if p.isascii() else len(p.encode()) for p in new), dtype=np.int64, count=len(new))
            sizes = np.diff(np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(bytes_of), side="right"), prepend=0)
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
            self.held += sum(map(len, new))
            self.pieces.new = []
        starts = np.cumsum(self.sizes) - self.sizes
        flat, ends = joined(self.ids, starts[of], self.sizes[of])
        last = np.cumsum([len(f) for f in found], dtype=np.int64)
        return flat, np.concatenate([[0], ends])[last]

    def encode(self, batch: list[str]) -> list[list[int]]:
        flat, ends = self.encode_flat(batch)
        return [x.tolist() for x in np.split(flat, ends[:-1])] if batch else []

    def digests(self, batch: list[str]) -> tuple[list[int], list[str], list[str]]:
        """Number of ids, digest of the ids and digest of the bytes that these
        decode to, of each text."""
        flat, ends = self.encode_flat(batch)
        counts = np.diff(ends, prepend=0).tolist()
        out = []
        for table, cut in ((self.decimal, 1), (self.table, 0)):  # the last space of the ids goes
            data, stops = table.joined(flat)
            stops = np.concatenate([[0], stops])[np.concatenate([[0], ends])].tolist()
            whole = data.tobytes()
            out.append([sha256(whole[a : max(b - cut, a)]).hexdigest() for a, b in zip(stops, stops[1:])])
        return counts, *out

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Code-point span of each token; a token that holds part of a split
        character spans the whole character, so neighbours may overlap."""
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        char_of = np.cumsum((data & 0xC0) != 0x80) - 1  # byte -> character
        ends = np.cumsum(self.lengths[np.asarray(ids, dtype=np.int64)])
        starts = ends - self.lengths[np.asarray(ids, dtype=np.int64)]
        return char_of[starts], char_of[ends - 1] + 1

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def with_codec(path: str, pattern: str, fn: Callable[[Codec, pa.RecordBatch], pa.RecordBatch], rows: int = 128):
    """``fn`` over slices of the batches; the codec ends with the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield fn(c, batch.slice(at, rows))

    return per_task(run)


def _lists(rows: Sequence, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.fromiter(chain.from_iterable(rows), dtype=kind.to_pandas_dtype(), count=int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text",
           keep: Sequence[str] = ("doc_id",), offsets: bool = False) -> DataFrame:
    """``keep`` columns plus ``ids`` array<int>; with ``offsets`` also
    ``starts`` and ``ends`` array<int> in code points."""
    own = ["ids", "starts", "ends"][: 3 if offsets else 1]
    if set(own) & set(keep):
        raise ValueError(f"column names taken by the result: {sorted(set(own) & set(keep))}")
    sub = docs.select(*keep, F.col(text).alias("__text"))
    kept = docs.select(*keep).schema
    schema = T.StructType([*kept.fields, *(T.StructField(c, T.ArrayType(T.IntegerType(), False)) for c in own)])
    n = len(kept.fields)

    def run(c: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = texts(batch, "__text")
        flat, ends = c.encode_flat(rows)
        columns = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), type=pa.int32()), pa.array(flat, type=pa.int32()))]
        if offsets:
            spans = [c.spans(t, x) for t, x in zip(rows, np.split(flat, ends[:-1]), strict=True)]
            columns += [_lists([s[k] for s in spans], pa.int32()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([*batch.columns[:n], *columns], names=[*batch.schema.names[:n], *own])

    return sub.mapInArrow(with_codec(path, pattern, run), schema)


def decode(tokens: DataFrame, path: str, pattern: str, keep: Sequence[str] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """``keep`` columns plus ``data`` (the exact bytes; null ids: empty) and
    ``text`` (UTF-8; bytes of characters cut off at either end, which a slice
    of the ids can leave, become U+FFFD)."""
    if {"data", "text"} & set(keep):
        raise ValueError("column names taken by the result: data, text")
    sub = tokens.select(*keep, F.col(ids).alias("__ids"))
    kept = tokens.select(*keep).schema
    schema = T.StructType([*kept.fields, T.StructField("data", T.BinaryType()), T.StructField("text", T.StringType())])
    n = len(kept.fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path, pattern)
        data = [c.decode(x or []) for x in batch.column("__ids").to_pylist()]
        out = [pa.array(data, type=pa.binary()), pa.array([d.decode("utf-8", "replace") for d in data], type=pa.string())]
        return pa.RecordBatch.from_arrays([*batch.columns[:n], *out], names=[*batch.schema.names[:n], "data", "text"])

    return arrow_map(sub, run, schema, rows=128)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256 (of the decimal ids joined by a
    space) and decoded_sha256 (of the bytes that the ids decode to by the
    reversed byte table); ids and bytes don't leave the task."""
    own = ("n_tokens", "ids_sha256", "decoded_sha256")
    if set(own) & set(keep):
        raise ValueError(f"column names taken by the result: {sorted(set(own) & set(keep))}")
    fields = docs.select(*keep).schema.fields
    schema = T.StructType([*fields, T.StructField("n_tokens", T.LongType()), *(T.StructField(c, T.StringType()) for c in own[1:])])

    def run(c: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        n, ids, data = c.digests(texts(batch, "__text"))
        columns = [pa.array(n, type=pa.int64()), pa.array(ids, type=pa.string()), pa.array(data, type=pa.string())]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(fields)], *columns], names=[*batch.schema.names[: len(fields)], *own])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(with_codec(path, pattern, run), schema)
