"""Removal of repeated byte strings by suffix sorting in two stages.

A window is a string of ``Settings.length`` bytes of one document. Each byte
covered by a window that also starts anywhere else, in the same document too,
is removed; windows are judged on the input.

*Cutting.* A window's anchor is the leftmost of its grams (``Settings.gram``
bytes) with the smallest hash, so equal windows have equal anchors at equal
places. Consecutive windows with one anchor form a piece. Only pieces of
equal anchor gram can share a window, and these are grouped over the corpus by
the gram's hash: a group of one piece has no repeat, equal pieces (counted by
partial aggregates) repeat whole, and of the other groups each different piece
goes to the suffix sort once, with its count.

*Sorting.* Within tasks that hold whole groups, the suffixes that are smaller
than their successors are sorted directly by their bytes. All others are
induced: buckets of equal first byte are scanned in ascending order, and in
each the suffixes that are larger than their successors follow the order of
these, which is known by then. Neighbours in the suffix array whose common
prefix has the window's length are repeats.

A group of more than ``Settings.group`` different pieces (a passage that very
many documents embed in texts of their own) is no task: its windows are dealt
anew by the bytes that all windows of a class of ``Settings.classes`` places
around the anchor have in common, and what still shares these by the whole
window. So no group is collected whole, and no window is left out.

Null text reads as empty; texts shorter than a window lose nothing. Rows are
documents, also when ids repeat or are null, so repeated rows of a window's
length are repeats of each other. Bytes, not characters, are compared and
removed; ``dedup``, which returns text, removes whole characters only. Columns
listed in ``keep`` pass through; none may be called like a result column or
start with ``__``. Texts are hashed in blocks, so memory holds a document's
bytes, not a multiple of a long one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postscope.llm.common import _BYTES, Scratch, mix, powers

OWN = ("n_bytes", "spans", "kept")
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]), False)


@dataclass(frozen=True)
class Settings:
    length: int = 200
    gram: int = 48
    group: int = 4096
    classes: int = 16
    block: int = 1 << 20  # bytes hashed at once
    batch: int = 1 << 18  # windows sorted at once (more only where one group has more)

    def __post_init__(self):
        if not 0 < self.gram <= self.length or not 0 < self.classes <= self.length:
            raise ValueError("a window holds at least one gram and one class of places")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# --- cutting ---------------------------------------------------------------


def cut(parts: list[bytes], s: Settings) -> tuple[np.ndarray, ...]:
    """Pieces of the given texts, in order: text number, first window's start in
    the text, number of windows, anchor's start in the text, hash of its gram."""
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(sizes)
    x = np.frombuffer(b"".join(parts), dtype=np.uint8)
    n = len(x) - s.gram + 1
    empty = np.empty(0, dtype=np.int64)
    if len(x) < s.length:
        return empty, empty, empty, empty, empty
    up, down = powers(len(x))
    sums = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[x] * up[: len(x)], out=sums[1:])
    least = mix((sums[s.gram :] - sums[:n]) * down[:n])
    at = np.arange(n, dtype=np.int32)
    # the smallest hash of ever longer stretches of grams, the leftmost of equal ones
    width, span = s.length - s.gram + 1, 1
    while span < width:
        step = min(span, width - span)
        later = least[step:] < least[:-step]
        least = np.where(later, least[step:], least[:-step])
        at = np.where(later, at[step:], at[:-step])
        span += step
    text = np.repeat(np.arange(len(parts)), np.maximum(sizes - s.length + 1, 0))
    firsts = np.cumsum(np.maximum(sizes - s.length + 1, 0)) - np.maximum(sizes - s.length + 1, 0)
    start = np.arange(len(text)) - firsts[text] + (ends - sizes)[text]
    anchor, key = at[start], least[start]
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    shift = (ends - sizes)[text[new]]
    return text[new], start[new] - shift, np.diff(new, append=len(text)), anchor[new] - shift, key[new].view(np.int64)


def blocks(rows: Sequence[bytes], s: Settings) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Row numbers, offsets and bytes of texts, or of overlapping parts of long
    texts, that make up a block each."""
    number, offset, parts, size = [], [], [], 0
    for i, data in enumerate(rows):
        for at in range(0, max(len(data) - s.length + 1, 0), s.block):
            part = data[at : at + s.block + s.length - 1]
            number.append(i)
            offset.append(at)
            parts.append(part)
            size += len(part)
            if size >= s.block:
                yield number, offset, parts
                number, offset, parts, size = [], [], [], 0
    if parts:
        yield number, offset, parts


def pieces(docs: DataFrame, s: Settings) -> DataFrame:
    """key (hash of the anchor gram), piece (hash of its bytes), __row, at, n
    (windows) of every piece of ``docs`` (__row, __data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in batch.column("__data")]
            ids = batch.column("__row").to_numpy(zero_copy_only=False)
            for number, offset, parts in blocks(rows, s):
                text, at, n, _, key = cut(parts, s)
                stop = at + n + (s.length - 1)
                piece = [signed(xxhash.xxh3_64_intdigest(parts[t][a:b])) for t, a, b in zip(text.tolist(), at.tolist(), stop.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(piece, type=pa.int64()), pa.array(ids[np.array(number, dtype=np.int64)[text]]),
                     pa.array(at + np.array(offset, dtype=np.int64)[text]), pa.array(n, type=pa.int32())],
                    names=["key", "piece", "__row", "at", "n"])

    return docs.select("__row", "__data").mapInArrow(run, "key long, piece long, __row long, at long, n int")


def with_bytes(wanted: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """``wanted`` (key, count, hot, __row, at, n) plus ``data``, the piece's bytes.
    A document's pieces, as many as its size allows, travel together."""
    fields = ["key", "count", "hot", "at", "n"]
    lists = wanted.groupBy("__row").agg(F.collect_list(F.struct(*fields)).alias("__wanted"))
    rows = docs.select("__row", "__data").join(lists, "__row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 64):
                batch = whole.slice(k, 64)
                found = batch.column("__wanted")
                of = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy())
                flat = found.flatten()
                at, n = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("at", "n"))
                texts = [x.as_buffer().to_pybytes() for x in batch.column("__data")]
                data = [texts[t][a : a + m + s.length - 1] for t, a, m in zip(of.tolist(), at.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*(flat.field(c) for c in fields), batch.column("__row").take(pa.array(of)), pa.array(data, type=pa.binary())],
                    names=[*fields, "__row", "data"])

    return rows.mapInArrow(run, "key long, count long, hot boolean, at long, n int, __row long, data binary")


# --- sorting ---------------------------------------------------------------


def suffix_order(x: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the ``wanted`` suffixes of ``x`` (bytes + 1; 0 ends a string) by
    their first ``length`` bytes, which all of them must have. Suffixes cut
    short by the end compare as if zeros followed: the wanted ones that they
    induce have their bytes before that."""
    n = len(x)
    place = np.arange(n)
    step = np.diff(x.astype(np.int32), append=0)
    # the sign of the next change decides; a string's last byte is larger than its end
    decides = np.minimum.accumulate(np.where(step != 0, place, n - 1)[::-1])[::-1]
    smaller = (step[decides] > 0) & (x > 0)
    # larger suffixes are induced from their successors, up to a smaller one or the string's end
    stop = np.minimum.accumulate(np.where(smaller | (x == 0), place, n - 1)[::-1])[::-1]
    change = np.zeros(n + 1, dtype=np.int32)
    change[wanted] += 1
    np.subtract.at(change, stop[wanted] + 1, 1)
    needed = np.cumsum(change[:-1]) > 0
    # first stage: direct sort
    small = np.flatnonzero(needed & smaller)
    ends = np.minimum.accumulate(np.where(x == 0, place, n)[::-1])[::-1]
    plain = np.concatenate([np.where(x > 0, x - 1, 0), np.zeros(length)]).astype(np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(plain, length)[small]
    short = ends[small] - small < length
    rows[short] *= np.arange(length) < (ends[small] - small)[short, None]
    small = small[np.argsort(rows.view(f"S{length}").ravel(), kind="stable")]
    # second stage: buckets in ascending order, the larger suffixes of each first
    large = np.flatnonzero(needed & ~smaller & (x > 0))
    after = x[large + 1]
    rank = np.zeros(n + 1, dtype=np.int64)
    counter = 1
    by_byte = np.argsort(x[large], kind="stable")
    edges_l = np.searchsorted(x[large][by_byte], np.arange(258))
    edges_s = np.searchsorted(x[small], np.arange(258))
    for c in np.union1d(x[large], x[small]).tolist():
        mine = by_byte[edges_l[c] : edges_l[c + 1]]
        inner = after[mine] == c
        turn = large[mine[~inner]]
        rest = large[mine[inner]]
        while len(turn):
            turn = turn[np.argsort(rank[turn + 1], kind="stable")]
            rank[turn] = np.arange(counter, counter + len(turn))
            counter += len(turn)
            if not len(rest):
                break
            known = rank[rest + 1] > 0  # the successor came in this bucket's last turn
            turn, rest = rest[known], rest[~known]
        own = small[edges_s[c] : edges_s[c + 1]]
        rank[own] = np.arange(counter, counter + len(own))
        counter += len(own)
    return rank[wanted]


def repeats(data: list[bytes], n: np.ndarray, length: int) -> np.ndarray:
    """For every window (the first ``n`` starts of each string), in order:
    whether an equal one is among the others."""
    if not data:
        return np.empty(0, dtype=bool)
    sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data)) + 1
    x = np.zeros(int(sizes.sum()), dtype=np.uint16)
    inside = np.ones(len(x), dtype=bool)
    inside[np.cumsum(sizes) - 1] = False
    x[inside] = np.frombuffer(b"".join(data), dtype=np.uint8)
    x[inside] += 1
    firsts = np.cumsum(n) - n
    windows = np.arange(int(n.sum())) - np.repeat(firsts, n) + np.repeat(np.cumsum(sizes) - sizes, n)
    order = np.argsort(suffix_order(x, windows, length))
    rows = np.lib.stride_tricks.sliding_window_view(x.astype(np.uint8) - np.uint8(1), length)
    equal = np.zeros(len(order) + 1, dtype=bool)
    for k in range(1, len(order), 1 << 15):  # common prefix of neighbours, as far as a window
        a = rows[windows[order[k - 1 : k - 1 + (1 << 15) + 1]]]
        equal[k : k + len(a) - 1] = (a[1:] == a[:-1]).all(axis=1)
    out = np.empty(len(order), dtype=bool)
    out[order] = equal[:-1] | equal[1:]
    return out


# --- deciding --------------------------------------------------------------


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


SPAN = "__row long, start long, end long"


def sorted_groups(found: DataFrame, s: Settings) -> DataFrame:
    """__row, start, end of the repeats among pieces (key, count, __row, at, n,
    data) of groups of bounded size; pieces that occur once only, as the others
    repeat whole."""

    def decide(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        n = t.column("n").to_numpy().astype(np.int64)
        flags = repeats(t.column("data").to_pylist(), n, s.length)
        ends = np.cumsum(n)
        out = []
        for k in np.flatnonzero((t.column("count").to_numpy() == 1) & (np.add.reduceat(flags, ends - n) > 0)):
            row, at = t.column("__row")[int(k)].as_py(), t.column("at")[int(k)].as_py()
            out += [(row, at + a, at + b - 1 + s.length) for a, b in runs(flags[ends[k] - n[k] : ends[k]])]
        flat = np.array(out, dtype=np.int64).reshape(-1, 3)
        return pa.RecordBatch.from_arrays([pa.array(flat[:, c]) for c in range(3)], names=["__row", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # whole groups, and the last one as far as it came
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy()
            n = batch.column("n").to_numpy()
            new = np.flatnonzero(np.diff(keys, prepend=keys[0] if last is None else last) != 0)
            at = 0
            for k in new.tolist():
                here = int(n[at:k].sum())
                if size + here >= s.batch:
                    yield decide([*held, batch.slice(at, k - at)])
                    held, size, at = [], 0, k
            held.append(batch.slice(at))
            size += int(n[at:].sum())
            last = keys[-1]
        if size:
            yield decide(held)

    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.select("key", "count", "__row", "at", "n", "data").repartition(parts, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, SPAN)


def split_groups(found: DataFrame, s: Settings, scratch: Scratch) -> DataFrame:
    """The same for groups of any size: windows meet by the bytes that all
    windows of their class share, then by all their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                batch = whole.slice(k, 512)
                data, n = batch.column("data").to_pylist(), batch.column("n").to_pylist()
                anchors = {t: p for t, p in zip(*(c.tolist() for c in np.array(cut(data, s))[[0, 3]]))}
                of, at, core, windows = [], [], [], []
                for i, (d, m) in enumerate(zip(data, n)):
                    first = anchors[i] // s.classes  # classes of distances from start to anchor, descending
                    for j in range(first, (anchors[i] - m + 1) // s.classes - 1, -1):
                        lo = max(anchors[i] - s.classes * (j + 1) + 1, 0)
                        hi = min(anchors[i] - s.classes * j, m - 1)
                        shared = anchors[i] - s.classes * j
                        of.append(i)
                        at.append(lo)
                        core.append(signed(xxhash.xxh3_64_intdigest(j.to_bytes(4, "little") + d[shared : shared - s.classes + 1 + s.length])))
                        windows.append([signed(xxhash.xxh3_64_intdigest(d[w : w + s.length])) for w in range(lo, hi + 1)])
                of = pa.array(of, type=pa.int64())
                start = pa.array(np.array(at, dtype=np.int64) + batch.column("at").take(of).to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core, type=pa.int64()), batch.column("__row").take(of), batch.column("count").take(of), start,
                     pa.array(windows, type=pa.list_(pa.int64()))], names=["core", "__row", "count", "start", "windows"])

    rows = scratch.write(found.mapInArrow(run, "core long, __row long, count long, start long, windows array<long>"))
    rows = rows.join(lone(rows, "core"), ["__row", "start"], "left_anti")
    single = rows.select("core", "__row", "count", "start", F.posexplode("windows").alias("place", "window"))
    single = scratch.write(single.select("core", "window", "__row", "count", (F.col("start") + F.col("place")).alias("start")))
    hit = single.where("count = 1").join(lone(single, "core", "window"), ["__row", "start"], "left_anti")
    return hit.select("__row", "start", (F.col("start") + s.length).alias("end"))


def lone(rows: DataFrame, *keys: str) -> DataFrame:
    """__row and start of the rows that stand for one occurrence and share their
    keys with no other. Leaving these out of all rows, by the place, keeps the
    rows of hot keys apart, which a join by the keys would bring together."""
    groups = rows.groupBy(*keys).agg(F.sum("count").alias("total"), F.first("__row").alias("__row"), F.first("start").alias("start"))
    return groups.where("total = 1").select("__row", "start")


def repeated_spans(docs: DataFrame, s: Settings, scratch: Scratch) -> DataFrame:
    """__row, start, end of stretches of ``docs`` (__row, __data) that repeats
    cover; they may overlap."""
    found = scratch.write(pieces(docs, s))
    # complements as keys: both sides of a join are exchanged anew, so that a hot key can be split
    shared = found.groupBy("key").agg(F.count("*").alias("rows"), F.min("piece").alias("a"), F.max("piece").alias("b")).where("rows > 1").select(
        F.bitwise_not("key").alias("not_key"), (F.col("a") != F.col("b")).alias("mixed"))
    found = scratch.write(found.join(shared, F.bitwise_not("key") == F.col("not_key")).drop("not_key"))
    scratch.keep(docs, found)
    whole = (F.col("at") + F.col("n") + (s.length - 1)).alias("end")
    equal = found.where(~F.col("mixed")).select("__row", F.col("at").alias("start"), whole)
    # the three values of a piece's first row come from one row
    each = found.where("mixed").groupBy("key", "piece").agg(F.count("*").alias("count"), *(F.first(c).alias(c) for c in ("__row", "at", "n")))
    each = scratch.write(each)
    # all but those that occur once, by their place: no row of a hot piece meets another
    copies = found.where("mixed").join(each.where("count = 1").select("__row", "at"), ["__row", "at"], "left_anti")
    large = each.groupBy("key").agg(F.count("*").alias("pieces")).where(F.col("pieces") > s.group).select(
        F.bitwise_not("key").alias("not_key"), F.lit(True).alias("large"))
    wanted = each.join(large, F.bitwise_not("key") == F.col("not_key"), "left").select(
        "key", "count", F.coalesce("large", F.lit(False)).alias("hot"), "__row", "at", "n")
    wanted = scratch.write(with_bytes(wanted, docs, s))
    out = equal.unionByName(copies.select("__row", F.col("at").alias("start"), whole))
    out = out.unionByName(sorted_groups(wanted.where(~F.col("hot")), s))
    if not wanted.where("hot").isEmpty():
        out = out.unionByName(split_groups(wanted.where("hot"), s, scratch))
    return out


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The union of stretches, as maximal ones in order."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]]))
    return list(zip(starts[new].tolist(), reach[np.append(new[1:], len(starts)) - 1].tolist()))


def outside(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at = [0, *(x for span in spans for x in span), len(data)]
    return b"".join(data[a:b] for a, b in zip(at[::2], at[1::2]))


def find(docs: DataFrame, text: str | Column = "text", keep: Sequence[str] = ("doc_id",), settings: Settings = Settings()) -> DataFrame:
    """``keep`` columns, n_bytes long, ``spans`` (start, end) of the maximal
    removed stretches in bytes, in order, and ``kept``, the remaining bytes."""
    if taken := [c for c in keep if c in OWN or c.startswith("__")]:
        raise ValueError(f"column names taken by the result: {taken}")
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    data = F.encode(F.col(text) if isinstance(text, str) else text, "utf-8").alias("__data")
    rows = scratch.write(docs.select(*keep, data, F.monotonically_increasing_id().alias("__row")))
    covered = scratch.write(repeated_spans(rows, settings, scratch).groupBy("__row").agg(
        F.collect_list(F.struct("start", "end")).alias("__covered")))  # a document's own stretches
    scratch.keep(rows, covered)
    fields = rows.select(*keep).schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 64):
                batch = whole.slice(k, 64)
                data = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in batch.column("__data")]
                spans = []
                for c in batch.column("__covered"):
                    if c.is_valid:
                        flat = c.values
                        spans.append(merged(*(flat.field(f).to_numpy(zero_copy_only=False) for f in ("start", "end"))))
                    else:
                        spans.append([])
                flat = np.array([x for row in spans for x in row], dtype=np.int64).reshape(-1, 2)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in (0, 1)], fields=[
                    pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)])
                offsets = pa.array(np.cumsum([0, *map(len, spans)]), type=pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(fields)], pa.array(list(map(len, data)), type=pa.int64()), pa.ListArray.from_arrays(offsets, structs),
                     pa.array([outside(d, x) for d, x in zip(data, spans)], type=pa.binary())],
                    names=[*batch.schema.names[: len(fields)], *OWN])

    schema = T.StructType([*fields, T.StructField("n_bytes", T.LongType()), T.StructField("spans", SPANS), T.StructField("kept", T.BinaryType())])
    return rows.join(covered, "__row", "left").select(*keep, "__data", "__covered").mapInArrow(run, schema)


def dedup(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The rows with repeats cut out of ``text``, as far as they hold whole
    characters. ``n_chars``, where present, follows the new text. Texts without
    a repeat stay as they are."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    found = find(docs.select(*(F.col(c).alias(n) for c, n in names.items())), names[text], list(names.values()), settings)
    # a continuation byte can't begin what stays after a span, nor a lead byte end what stays before it
    data = F.encode(F.col(names[text]), "utf-8")

    def starts(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(data, at + 1, F.lit(1))), 16, 10).cast("int")
        return F.coalesce(byte.bitwiseAND(F.lit(0xC0)) != 0x80, F.lit(True))

    def boundary(at: Column, step: int) -> Column:
        place = at
        for k in (3, 2, 1, 0):
            place = F.when(starts(at + step * k), at + step * k).otherwise(place)
        return place

    whole = F.transform("spans", lambda s: F.struct(boundary(s["start"], 1).alias("start"), boundary(s["end"], -1).alias("end")))
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("__whole", lambda s: s["end"]))
    begins = F.concat(F.transform("__whole", lambda s: s["start"]), F.array(F.col("n_bytes")))
    left = F.transform(F.arrays_zip(ends.alias("a"), begins.alias("b")), lambda p: F.substring(data, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")))
    found = found.withColumn("__whole", whole)
    new = F.when(F.size("spans") > 0, F.array_join(F.transform(left, lambda b: F.decode(b, "utf-8")), "")).otherwise(F.col(names[text]))
    found = found.withColumn("__new", new)

    def column(c: str) -> Column:
        if c == text:
            return F.col("__new").alias(c)
        if c == "n_chars":
            return F.when(F.size("spans") > 0, F.length("__new")).otherwise(F.col(names[c])).cast(docs.schema[c].dataType).alias(c)
        return F.col(names[c]).alias(c)

    return found.select(*map(column, docs.columns))


def n_removed(spans: Column) -> Column:
    return F.reduce(spans, F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
