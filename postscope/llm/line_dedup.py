"""Fuzzy line deduplication by MinHash.

Every line with a visible character takes part, stripped of white space at its
ends. Lines link when the Jaccard similarity of their sets of
``Settings.shingle``-character shingles is at least ``percent`` / 100; equal
lines always do. One-permutation MinHash signatures with densified empty bins
are cut into bands; lines that share a band (at the threshold
``1 - (1 - s ** rows) ** bands`` of them, 0.999 with the defaults) are
candidates unless their marks rule that out: bits of the bins (one each, two
for long lines), which wrongly do so for about 1 of 5,000 pairs at the threshold by
either count, and the size and the window parities of short lines, which never
do. Candidates are tested by exact Jaccard and united by distributed
union-find (``clusters``). Of each component one occurrence stays: the first
by (doc_id, null last; row key; line number).

Rows are addressed by a hash of (doc_id, text), so null and repeated ids are
fine; rows that repeat id and text are the same occurrence and keep the same
lines. Null text has no lines and stays null. Lines shorter than a shingle
link with equal lines only. Blank lines stay unless nothing else is left; a
document that loses all its lines goes. ``n_chars``, where present, follows
the new text. Other columns pass through (names with ``__`` in front and used
here are reserved).
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postscope.llm.clusters import alike_pairs, components, links_of
from postscope.llm.common import Scratch, arrow_map, mix, per_task, texts

SPACES = " \t\n\v\f\r"
VISIBLE = r"[^ \t\n\x0B\f\r]"
PLACES = (mix(np.arange(101, 133, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
FACTORS = mix(np.arange(201, 233, dtype=np.uint64)) | np.uint64(1)
EMPTY = np.uint32(0xFFFFFFFF)

# A line's mark: 56 bits, one per bin; a flag (few bins were filled, the bits say little);
# 7 bits of size class (of lines with fewer than ``KNOWN`` windows). A second number has, of
# lines of known size, 64 bits, each whether an odd number of different windows falls on it,
# and of others another bit per bin and 7 bits of size class of the first ``KNOWN`` windows.
BITS = 56
FILLED = 44  #: least filled bins for bits that count
KNOWN = 128
UNKNOWN = 127
STEP = np.log(1.05)  #: width of a size class


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 80
    rows: int = 4
    bands: int = 13


def line_hash(line: str) -> int:
    """What Spark's ``xxhash64`` gives."""
    value = xxhash.xxh64_intdigest(line.encode(), seed=42)
    return value - (1 << 64) if value >> 63 else value


def lines_of(text: str) -> list[tuple[int, str]]:
    """(number, stripped line) of the lines with a visible character."""
    return [(i, s) for i, x in enumerate(text.split("\n")) if (s := x.strip(SPACES))]


def band_keys(lines: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """One row of band keys, and the mark, of every line; lines must have a shingle."""
    keys, marks = keys_and_marks(lines, settings)
    return keys, marks[:, 0]


def keys_and_marks(lines: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """``band_keys`` with both numbers of the mark, as a row; no lines give no rows."""
    if not lines:
        return np.empty((0, settings.bands), dtype=np.int64), np.empty((0, 2), dtype=np.uint64)
    k, bins = settings.shingle, max(settings.rows * settings.bands, BITS)
    chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    n = len(chars) - k + 1
    total = chars[:n] * PLACES[0]
    for j in range(1, k):
        total += chars[j : n + j] * PLACES[j]
    for shift, factor in ((16, 0x21F0AAAD), (15, 0x735A2D97)):  # a 32-bit finaliser
        total ^= total >> np.uint32(shift)
        total *= np.uint32(factor)
    total ^= total >> np.uint32(15)
    # place of each window's line among the bins; windows that leave their line go to a spare row
    row = np.repeat(np.arange(len(lines), dtype=np.int32) * np.int32(bins), sizes)[:n]
    last = np.cumsum(sizes)[:-1]
    for j in range(1, k):
        row[last - j] = len(lines) * bins
    size = np.full(len(lines), UNKNOWN)
    small = np.flatnonzero(sizes - k + 1 < KNOWN)
    if len(small):
        windows = sizes[small] - k + 1
        of = np.repeat(small, windows)
        at = np.arange(len(of)) + np.repeat(np.r_[0, np.cumsum(sizes)][small] - np.cumsum(windows) + windows, windows)
        found = np.sort(of.astype(np.uint64) << np.uint64(32) | total[at])  # np.unique hashes, which takes longer
        different = found[np.r_[True, found[1:] != found[:-1]]]
        counts = np.bincount((different >> np.uint64(32)).astype(np.int64), minlength=len(lines))[small]
        size[small] = np.floor(np.log(counts) / STEP)
        odd = np.bitwise_xor.reduceat(np.uint64(1) << (mix(different & np.uint64(EMPTY)) >> np.uint64(58)), np.cumsum(counts) - counts)
    row += ((total >> np.uint32(16)) * np.uint32(bins) >> np.uint32(16)).view(np.int32)
    least = np.full((len(lines) + 1) * bins, EMPTY)
    np.minimum.at(least, row, total)
    least = least.reshape(-1, bins)[:-1]
    filled = least != EMPTY
    few = filled.sum(axis=1) * BITS < FILLED * bins
    row, column = np.nonzero(~filled)
    attempt = 0
    while len(row):  # an empty bin takes another's value, along a fixed random path
        attempt += 1
        other = (mix(np.arange(bins, dtype=np.uint64) + np.uint64(1000 * attempt)) % np.uint64(bins)).astype(np.int64)[column]
        hit = filled[row, other]
        least[row[hit], column[hit]] = least[row[hit], other[hit]] + np.uint32(attempt)
        row, column = row[~hit], column[~hit]
    values, places = mix(least[:, :BITS].astype(np.uint64)), np.arange(8, 8 + BITS, dtype=np.uint64)
    bits, more = (((values >> np.uint64(at) & np.uint64(1)) << places).sum(axis=1, dtype=np.uint64) for at in (40, 41))
    mark = bits | (few.astype(np.uint64) << np.uint64(7)) | size.astype(np.uint64)
    if len(small):
        more[small] = odd
    if len(large := np.flatnonzero(sizes - k + 1 >= KNOWN)):
        part = np.sort(total[np.r_[0, last][large][:, None] + np.arange(KNOWN)], axis=1)
        more[large] |= np.floor(np.log(1 + (part[:, 1:] != part[:, :-1]).sum(axis=1)) / STEP).astype(np.uint64)
    bands = least[:, : settings.bands * settings.rows].reshape(len(lines), settings.bands, settings.rows)
    keys = np.arange(settings.bands, dtype=np.uint64) + np.zeros((len(lines), 1), dtype=np.uint64)
    for r in range(settings.rows):
        keys = mix(keys + bands[:, :, r])
    return keys.view(np.int64), np.stack([mark, more], axis=1)


def limits(settings: Settings) -> tuple[int, int]:
    """The least number of equal bits and the most size classes between lines
    that may be similar. A bin's bits are equal with probability (1 + s) / 2;
    the number is 3.7 standard deviations below the mean at the threshold."""
    share = (1 + settings.percent / 100) / 2
    return int(BITS * share - 3.7 * np.sqrt(BITS * share * (1 - share))), int(np.log(100 / settings.percent) / STEP) + 1


def alike(settings: Settings) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Whether lines of two arrays of marks may be similar."""
    wanted, apart = limits(settings)

    def test(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = (a & np.uint64(127)).astype(np.int64), (b & np.uint64(127)).astype(np.int64)
        sized = (x == UNKNOWN) | (y == UNKNOWN) | (np.abs(x - y) <= apart)
        equal = BITS - np.bitwise_count((a ^ b) >> np.uint64(8)).astype(np.int64) >= wanted
        return (a == 0) | (b == 0) | sized & (equal | ((a | b) & np.uint64(128) != 0))

    return test


def alike_rows(settings: Settings) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """``alike`` of two arrays of whole marks (``keys_and_marks``). Of lines of
    known size the second numbers differ in no more bits than their sets in
    windows, of which similar lines have no more than ``most`` says; of long
    lines a bin's two bits are both equal with probability (1 + 3 s) / 4, and the
    least number is taken as in ``limits``. A line of known size isn't similar to
    one whose first windows are too many."""
    first, apart, share = alike(settings), limits(settings)[1], settings.percent / 100
    both = (1 + 3 * share) / 4
    wanted = int(BITS * both - 3.7 * np.sqrt(BITS * both * (1 - both)))
    upper = np.exp((np.arange(UNKNOWN) + 1) * STEP)  # of a class of sizes
    most = ((1 - share) / (1 + share) * (upper[:, None] + upper) + 1e-6).astype(np.int64)

    def test(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = first(a[:, 0], b[:, 0])
        at = np.flatnonzero(out & (a[:, 0] != 0) & (b[:, 0] != 0))
        a, b = a[at], b[at]
        x, y = (a[:, 0] & np.uint64(127)).astype(np.int64), (b[:, 0] & np.uint64(127)).astype(np.int64)
        more, some, one = a[:, 1] ^ b[:, 1], x != UNKNOWN, y != UNKNOWN
        differ = np.bitwise_count(more).astype(np.int64) <= most[x % UNKNOWN, y % UNKNOWN]
        equal = BITS - np.bitwise_count(((a[:, 0] ^ b[:, 0]) | more) >> np.uint64(8)).astype(np.int64) >= wanted
        equal |= (a[:, 0] | b[:, 0]) & np.uint64(128) != 0
        beyond = (np.where(some, b[:, 1], a[:, 1]) & np.uint64(127)).astype(np.int64) - np.minimum(x, y)
        out[at] = np.where(some & one, differ, np.where(some | one, beyond <= apart, equal))
        return out

    return test


def alike_pair(settings: Settings) -> Callable[[int, int], bool]:
    """``alike`` of two marks given as numbers."""
    wanted, apart = limits(settings)

    def test(a: int, b: int) -> bool:
        x, y = a & 127, b & 127
        if a == 0 or b == 0:
            return True
        if x != UNKNOWN and y != UNKNOWN and abs(x - y) > apart:
            return False
        return bool((a | b) & 128) or BITS - ((a ^ b) >> 8).bit_count() >= wanted

    return test


def stripped(line):
    """``line`` without white space at its ends. Ends are looked at first, as
    ``btrim`` with characters walks the whole line."""
    line = F.trim(line)
    more = reduce(operator.or_, [end(F.lit(c)) for c in SPACES.replace(" ", "") for end in (line.startswith, line.endswith)])
    return F.when(more, F.btrim(line, F.lit(SPACES))).otherwise(line)


def occurrences(rows: DataFrame) -> DataFrame:
    """doc_id, rid, line, node (the line's hash) of every line."""
    each = rows.select(F.col("__id").alias("doc_id"), F.col("__rid").alias("rid"), F.posexplode(F.split("__text", "\n", -1)).alias("line", "s"))
    return each.select("doc_id", "rid", "line", stripped(F.col("s")).alias("s")).where("s <> ''").select(
        "doc_id", "rid", "line", F.xxhash64("s").alias("node"))


def post(settings: Settings) -> Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """key, node, whole mark for every band of every line, equal lines of a batch once."""

    def run(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lines = list({s for t in texts(batch, "__text") for _, s in lines_of(t) if len(s) >= settings.shingle})
        keys, marks = keys_and_marks(lines, settings)
        nodes = np.fromiter(map(line_hash, lines), dtype=np.int64, count=len(lines))
        return keys.reshape(-1), np.repeat(nodes, settings.bands), np.repeat(marks, settings.bands, axis=0)

    return run


def sketch(nodes: DataFrame, most: int = 29) -> np.ndarray:
    """A table of bits, set at the upper bits of every node: 8 to 16 bits a
    node, 2 ** ``most`` (64 MB) at most."""
    bits = min(max((nodes.count() * 8).bit_length(), 16), most)
    place = F.shiftrightunsigned("node", 64 - bits)
    words = nodes.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(node, {64 - bits}) & 63 as int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def may_hold(bits: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """False where a ``sketch`` shows that it wasn't made with the node."""
    place = nodes.view(np.uint64) >> np.uint64(64 - (len(bits) * 64).bit_length() + 1)
    return bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1) != 0


def candidates(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, line text of the distinct lines that are in ``nodes``. Most others
    stay in their task, by a sketch of the nodes."""
    bits = sketch(nodes)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = list({s for t in texts(batch, "__text") for _, s in lines_of(t)})
        found = np.fromiter(map(line_hash, lines), dtype=np.int64, count=len(lines))
        hit = np.flatnonzero(may_hold(bits, found))
        return pa.RecordBatch.from_arrays([pa.array(found[hit]), pa.array([lines[i] for i in hit.tolist()], type=pa.string())], names=["node", "s"])

    return arrow_map(rows, run, "node long, s string").join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])


def with_keys(found: DataFrame, settings: Settings) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = batch.column("s").to_pylist()
        keys, marks = keys_and_marks(lines, settings)
        offsets = np.arange(len(lines) + 1, dtype=np.int32) * settings.bands
        mark, more = (pa.array(np.ascontiguousarray(marks[:, i]).view(np.int64)) for i in (0, 1))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1))), mark, more],
                                          names=["node", "s", "keys", "mark", "more"])

    return arrow_map(found, run, "node long, s string, keys array<long>, mark long, more long")


def test(settings: Settings) -> Callable[[dict], Callable[[int, int], bool]]:
    """Exact test of candidates; lines whose marks aren't alike are none."""
    near = alike_pair(settings)

    def make(columns: dict):
        lines, k = columns["s"], settings.shingle
        marks = [m & (1 << 64) - 1 for m in columns["mark"]]

        @lru_cache(maxsize=None)
        def grams(i: int) -> frozenset:
            return frozenset(lines[i][j : j + k] for j in range(len(lines[i]) - k + 1))

        def similar(x: int, y: int) -> bool:
            if not near(marks[x], marks[y]):
                return False
            a, b = grams(x), grams(y)
            if 100 * min(len(a), len(b)) < settings.percent * max(len(a), len(b)):
                return False
            both = len(a & b)
            return 100 * both >= settings.percent * (len(a) + len(b) - both)

        return similar

    return make


def windows(lines: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every window of ``k`` characters of the joined lines, and
    whether it stays in its line; the lines have a window each."""
    chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    n = len(chars) - k + 1
    total = chars[:n] * FACTORS[0]
    for j in range(1, k):
        total += chars[j : n + j] * FACTORS[j]
    own = np.ones(n, dtype=bool)
    last = np.cumsum([len(s) for s in lines])[:-1]
    for j in range(1, k):
        own[last - j] = False
    return mix(total), own


def many(settings: Settings) -> Callable[[dict], Callable[[int, np.ndarray], np.ndarray]]:
    """The exact test of one line of a group and several others at once."""

    def make(columns: dict):
        lines = columns["s"]
        total, own = windows(lines, settings.shingle)
        owner = np.repeat(np.arange(len(lines)), [len(s) for s in lines])[: len(total)][own]
        _, gram = np.unique(total[own], return_inverse=True)
        order = np.lexsort((gram, owner))
        owner, gram = owner[order], gram[order]
        new = np.r_[True, (owner[1:] != owner[:-1]) | (gram[1:] != gram[:-1])]
        owner, gram = owner[new], gram[new]
        size = np.bincount(owner, minlength=len(lines))
        sets = np.split(gram, np.cumsum(size)[:-1])
        seen = np.zeros(len(gram), dtype=np.int64)

        def similar(x: int, rest: np.ndarray) -> np.ndarray:
            seen[sets[x]] = 1
            starts = np.cumsum(size[rest]) - size[rest]
            both = np.add.reduceat(seen[np.concatenate([sets[y] for y in rest.tolist()])], starts)
            seen[sets[x]] = 0
            return 100 * both >= settings.percent * (size[x] + size[rest] - both)

        return similar

    return make


def similar(a: list[str], b: list[str], settings: Settings) -> np.ndarray:
    """The exact test of up to 256 pairs (a[i], b[i]) at once; lines must have a shingle."""
    total, own = windows(a + b, settings.shingle)
    sizes = np.fromiter(map(len, a + b), dtype=np.int64, count=2 * len(a))
    # pair, 55 bits of the hash, side: one sort brings the two sides together
    head = np.arange(len(a), dtype=np.uint64) << np.uint64(56)
    found = (total >> np.uint64(8) & ~np.uint64(1) | np.repeat(np.r_[head, head | np.uint64(1)], sizes)[: len(total)])[own]
    found.sort()
    found = found[np.r_[True, found[1:] != found[:-1]]]
    both = np.flatnonzero(found[1:] ^ np.uint64(1) == found[:-1])
    cuts = np.r_[np.searchsorted(found, head), len(found)]
    common = np.diff(np.searchsorted(both, cuts))
    return 100 * common >= settings.percent * (np.diff(cuts) - common)


def tested(pairs: DataFrame, lines: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) of similar lines; ``lines``: node, s."""

    def run(batches):
        for batch in batches:
            ids, texts_ = ([batch.column(c) for c in x] for x in (("a", "b"), ("s", "t")))
            one, other = (t.to_pylist() for t in texts_)
            hit, at, size = np.zeros(batch.num_rows, dtype=bool), 0, 0
            for i in range(batch.num_rows):  # up to 256 pairs, about a million characters at once
                size += len(one[i]) + len(other[i])
                if size >= 1_000_000 or i - at == 255 or i == batch.num_rows - 1:
                    hit[at : i + 1] = similar(one[at : i + 1], other[at : i + 1], settings)
                    at, size = i + 1, 0
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(hit)) for c in ids], names=["a", "b"])

    both = (pairs.join(lines.select(F.col("node").alias("a"), "s"), "a")
            .join(lines.select(F.col("node").alias("b"), F.col("s").alias("t")), "b"))
    return both.select("a", "b", "s", "t").mapInArrow(per_task(run), "a long, b long")


def components_of_lines(scratch: Scratch, rows: DataFrame, settings: Settings) -> DataFrame:
    """(node, root) of lines connected by similar pairs. Pairs that share a
    band with few pairs are tested one by one; the lines of bands with many are
    linked in groups (``clusters.links_of``)."""
    found = scratch.write(alike_pairs(rows, post(settings), alike_rows(settings)))
    pairs = scratch.write(found.where("not whole").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    cluster = scratch.write(components(scratch, found.where("whole").select("a", "b")))
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(cluster.select("node")).distinct()
    lines = scratch.write(candidates(rows, scratch.write(nodes)))
    links = scratch.write(tested(pairs, lines, settings))
    if not cluster.isEmpty():
        items = scratch.write(with_keys(lines.join(cluster.select("node"), "node", "left_semi"), settings))
        links = links.union(links_of(scratch, items, cluster, ["s", "mark", "more"], test(settings), near(settings), many(settings)))
    return components(scratch, links)


def near(settings: Settings) -> Callable[[dict], Callable[[int, np.ndarray], np.ndarray]]:
    """``alike_rows`` of one line and others of a group."""
    alike_ = alike_rows(settings)

    def make(columns: dict):
        marks = np.stack([np.array(columns[c], dtype=np.int64).view(np.uint64) for c in ("mark", "more")], axis=1)
        return lambda x, rest: alike_(np.broadcast_to(marks[x], (len(rest), 2)), marks[rest])

    return make


def marked(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """Every column of ``docs`` plus ``__lines`` (lines with a visible
    character) and ``__drops`` (array of the line numbers to drop)."""
    scratch = Scratch(docs.sparkSession, "line-dedup")
    docs = docs.withColumn("__rid", F.xxhash64(F.col("doc_id").cast("long"), F.col(text)))
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), "__rid", F.col(text).alias("__text"))
    seen = scratch.write(occurrences(rows))
    found = components_of_lines(scratch, rows.select("__text"), settings)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid", "line")
    of_line = seen.groupBy("node").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    # lines that occur once and are like no other are left out at once
    united = scratch.write(of_line.join(found, "node", "left").where("n > 1 or root is not null").select(
        "node", "first", "n", F.coalesce("root", "node").alias("root")))
    kept = united.groupBy("root").agg(F.min("first").alias("keep"), F.sum("n").alias("n")).where("n > 1")
    verdict = united.select("node", F.bitwise_not("root").alias("k")).join(
        kept.select(F.bitwise_not("root").alias("k"), "keep"), "k").select("node", "keep")
    drops = (seen.join(verdict, "node").where(~place.eqNullSafe(F.col("keep")))
             .groupBy("rid").agg(F.collect_set("line").alias("__drops")))
    drops = scratch.write(drops)
    scratch.keep(drops)
    lines = F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda x: x.rlike(VISIBLE)))
    # the texts needn't be sorted for this
    return docs.join(drops.withColumnRenamed("rid", "__rid").hint("shuffle_hash"), "__rid", "left").drop("__rid").withColumns(
        {"__lines": lines, "__drops": F.coalesce("__drops", F.array().cast("array<int>"))})


def without(text, drops):
    """The text less the lines numbered in ``drops``."""
    kept = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(drops, i))
    return F.when(F.size(drops) == 0, text).otherwise(F.array_join(kept, "\n"))


def dedup(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """The documents that keep a line (or had none), with their own columns."""
    out = marked(docs, settings, text).where((F.size("__drops") < F.col("__lines")) | (F.col("__lines") == 0))
    out = out.withColumn(text, without(F.col(text), F.col("__drops")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("__drops") == 0, F.col("n_chars")).otherwise(
            F.char_length(F.col(text)).cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
