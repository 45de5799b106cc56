"""N-gram Jaccard join by prefix filters under several global token orders.

A document's set holds its distinct shingles of ``Settings.words`` lower-cased
words (the whole sequence if it has fewer). Two documents link when the
Jaccard similarity of their sets is at least ``percent`` / 100.

Sets whose similarity reaches the threshold share a token within the first
``n - ceil(t * n) + 1`` tokens under *every* global order. All orders here put
tokens that occur in one set only first; the first order then sorts by rising
document frequency, the others by independent hashes. Candidates come from the
first order (its prefixes are the rarest tokens that any other set has); a
candidate pair must also share a prefix token under each other order before
its intersection is counted exactly.

Plan: one pass gives each row its set's size and signature (equal sets are one
node from here on); a second pass deals the tokens, packed, to ranges of the
token space, where frequencies are counted; tokens of several sets go back to
their set. Most sets end here: they own more tokens than their prefix is long.
The remaining ones are linked by ``clusters.link``.

Tokens in more than about 1/32 of all sets are found beforehand by counts that
each task adds up; at most 64 times the mean set size of them exist, so the
list may go to every task. They come last in the first order and need no
counting, so a shingle that a third of all documents share lands in no single
task.

Signatures are 64-bit hashes, tokens 64-bit hashes that travel in 40 bits and
their range (``_pack``). Null or empty text, or text without
words, has the empty set: size 0, linked with nothing. Null ids are allowed:
such a row takes part, and its component takes the least id of the others.
Repeated rows and ids are fine: similarity is a matter of sets. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postscope.llm.clusters import components, link, stars
from postscope.llm.common import Scratch, mix, per_task, texts, word_hashes

#: Odd multipliers, one per place in a shingle, and seeds of the further orders.
PLACES = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
SEEDS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))
HOT = 64
WIDE = 6  #: bytes of a shared token
LAST = 0xFF  # frequency class of hot tokens, beyond all others


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 75
    flush: int = 1_000_000  #: tokens that a task packs at once


def shingles(text: str, k: int = 5) -> np.ndarray:
    """Distinct shingle hashes, ascending."""
    data = text.encode().lower()  # bytes: A-Z and ASCII white space only
    w = word_hashes(data)
    n = len(w)
    if n < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(data.split()), seed=n)] if n else [], dtype=np.uint64)
    total = w[: n - k + 1] * PLACES[0]
    for j in range(1, k):
        total += w[j : n - k + 1 + j] * PLACES[j]
    return np.unique(mix(total))


def signature(tokens: np.ndarray) -> int | None:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())))) if len(tokens) else None


def prefix(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def members(docs: DataFrame, settings: Settings, text: str = "text") -> DataFrame:
    """Two kinds of rows: (doc_id, n, key: signature), and with ``counted``
    (n: sets, key: token) of tokens in 1/HOT of the sets of one flush."""

    def run(batches):
        seen: set[int] = set()
        parts: list[np.ndarray] = []

        def counted():
            tokens, n = np.unique(np.concatenate(parts), return_counts=True)
            often = n * HOT >= len(parts)
            if len(parts) < HOT:  # too few to tell: those in two sets or more
                often &= n > 1
            k = int(often.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64()), pa.array(n[often].astype(np.int64)), pa.array(tokens[often].view(np.int64)), pa.array([True] * k, type=pa.bool_())],
                names=["doc_id", "n", "key", "counted"])

        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t, settings.words) for t in texts(part, "__text")]
                keys = [signature(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], type=pa.int64()),
                     pa.array(keys, type=pa.int64()), pa.array([False] * len(sets), type=pa.bool_())], names=["doc_id", "n", "key", "counted"])
                for s, key in zip(sets, keys, strict=True):
                    if key is not None and key not in seen:
                        seen.add(key)
                        parts.append(s)
                        size += len(s)
                if size >= settings.flush:
                    yield counted()
                    seen, parts, size = set(), [], 0
        if parts:
            yield counted()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("__text")).mapInArrow(
        per_task(run), "doc_id long, n long, key long, counted boolean")


PACKED = "to int, back boolean, sigs binary, ns binary, counts binary, tokens binary, often binary"
NAMES = ["to", "back", "sigs", "ns", "counts", "tokens", "often"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=k) for i, k in enumerate(kinds)], names=NAMES)


def _pack(tokens: np.ndarray, width: int = 5) -> bytes:
    """The low five (``width``) bytes of each token. With the range that is 40 bits and
    the logarithm of the number of ranges, which grows with the corpus: two
    given sets of a thousand tokens share a false one once in 10 ** 7 pairs
    (50 ranges) or less. Afterwards tokens are mixed with their range and kept
    in ``WIDE`` bytes, where such sets share a false one once in 10 ** 8 pairs."""
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpack(data: bytes, width: int = 5) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _counts(counts: np.ndarray) -> bytes:
    """Two bytes each where they fit, else four."""
    return counts.astype(np.uint16 if counts.max(initial=0) < 1 << 16 else np.uint32).tobytes()


def _read_counts(row: dict) -> np.ndarray:
    width = len(row["counts"]) // max(len(row["sigs"]) // 8, 1)
    return np.frombuffer(row["counts"], dtype=np.uint16 if width == 2 else np.uint32).astype(np.int64)


def dealt(docs: DataFrame, hot: np.ndarray, ranges: int, settings: Settings, text: str = "text") -> DataFrame:
    """Packed rows of each task: the tokens by range, and (``back``) each
    set's size and hot tokens, which only pass through the ranges."""

    def run(batches):
        sets: dict[int, np.ndarray] = {}
        size = 0

        def packed():
            sigs = np.fromiter(sets, dtype=np.int64, count=len(sets))
            ns = np.array([len(s) for s in sets.values()], dtype=np.uint32)
            tokens = np.concatenate(list(sets.values()))
            owner = np.repeat(np.arange(len(sigs)), ns)
            is_hot = np.isin(tokens, hot) if len(hot) else np.zeros(len(tokens), dtype=bool)
            out = []
            to = sigs.view(np.uint64) % np.uint64(ranges)
            hot_counts = np.bincount(owner[is_hot], minlength=len(sigs))
            hot_tokens = np.split(tokens[is_hot], np.cumsum(hot_counts)[:-1])
            for d in np.unique(to).tolist():
                mine = np.flatnonzero(to == d)
                out.append((d, True, sigs[mine].tobytes(), ns[mine].tobytes(), _counts(hot_counts[mine]),
                            _pack(np.concatenate([hot_tokens[i] for i in mine]), WIDE), None))
            tokens, owner = tokens[~is_hot], owner[~is_hot]
            r = ((tokens >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(r, kind="stable")
            tokens, owner, r = tokens[order], owner[order], r[order]
            for d, a, b in _runs(r):
                who = owner[a:b]
                cuts = np.flatnonzero(np.diff(who, prepend=-1))
                out.append((d, False, sigs[who[cuts]].tobytes(), None, _counts(np.diff(cuts, append=b - a)), _pack(tokens[a:b]), None))
            return _rows(out)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for t in texts(batch.slice(at, 256), "__text"):
                    s = shingles(t, settings.words)
                    key = signature(s)
                    if key is not None and key not in sets:
                        sets[key] = s
                        size += len(s)
                        if size >= settings.flush:
                            yield packed()
                            sets, size = {}, 0
        if sets:
            yield packed()

    return docs.select(F.col(text).alias("__text")).mapInArrow(per_task(run), PACKED)


def _class(df: np.ndarray) -> np.ndarray:
    """A frequency in one byte: itself up to 64, then eight classes an octave."""
    return np.where(df <= 64, df, np.minimum(16 + 8 * np.log2(np.maximum(df, 1)), LAST - 1)).astype(np.uint8)


def _runs(sorted_values: np.ndarray):
    """(value, start, end) of each run."""
    if not len(sorted_values):
        return []
    starts = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    return zip(sorted_values[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(sorted_values)], strict=True)


def _held(batches) -> tuple[list[dict], dict[int, list[dict]]]:
    """The rows to pass on, and the others by range."""
    back, by = [], {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["back"]:
                back.append(row)
            else:
                by.setdefault(row["to"], []).append(row)
    return back, by


def counted(packed: DataFrame, ranges: int) -> DataFrame:
    """Per range: document frequencies; tokens of two or more sets go back to
    the bucket of their set."""

    def run(batches):
        back, by = _held(batches)
        for row in back:
            yield _rows([tuple(row[n] for n in NAMES)])
        back.clear()
        for r in list(by):
            rows = by.pop(r)
            sigs = np.concatenate([np.frombuffer(x["sigs"], dtype=np.int64) for x in rows])
            counts = np.concatenate([_read_counts(x) for x in rows])
            tokens = np.concatenate([_unpack(x["tokens"]) for x in rows])
            rows.clear()
            # copies of a set from several tasks count once
            _, first = np.unique(sigs, return_index=True)
            keep = np.zeros(len(sigs), dtype=bool)
            keep[first] = True
            tokens, sigs, counts = tokens[np.repeat(keep, counts)], sigs[keep], counts[keep]
            owner = np.repeat(np.arange(len(sigs)), counts)
            order = np.argsort(tokens, kind="stable")
            new = np.r_[True, tokens[order][1:] != tokens[order][:-1]]
            run_of = np.cumsum(new) - 1
            often = np.bincount(run_of)[run_of]
            df = np.empty(len(tokens), dtype=np.int64)
            df[order] = often
            shared = df > 1
            owner, tokens, df = owner[shared], tokens[shared], _class(df[shared])
            to = (sigs.view(np.uint64) % np.uint64(ranges)).astype(np.int32)
            order = np.lexsort((owner, to[owner]))
            owner, tokens, df = owner[order], tokens[order], df[order]
            out = []
            for d, a, b in _runs(to[owner]):
                who = owner[a:b]
                cuts = np.flatnonzero(np.diff(who, prepend=-1))
                high = np.uint64(r) << np.uint64(40)  # ranges differ: no mix-up among the low bytes of two ranges
                out.append((d, True, sigs[who[cuts]].tobytes(), None, _counts(np.diff(cuts, append=b - a)),
                            _pack(mix(tokens[a:b] ^ mix(np.array([high | np.uint64(1)]))), WIDE), df[a:b].tobytes()))
            if out:
                yield _rows(out)

    return packed.mapInArrow(per_task(run), PACKED)


def survivors(back: DataFrame, settings: Settings) -> DataFrame:
    """Sets whose first prefix holds a shared token: node, n, k (shared tokens
    in a prefix), tokens (all shared ones, in the first order), keys."""
    percent = settings.percent

    def run(batches):
        info, parts = [], []
        for batch in batches:
            for row in batch.to_pylist():
                sigs, counts = np.frombuffer(row["sigs"], dtype=np.int64), _read_counts(row)
                tokens = _unpack(row["tokens"], WIDE)
                if row["ns"] is not None:
                    info.append((sigs, np.frombuffer(row["ns"], dtype=np.uint32)))
                    df = np.full(len(tokens), LAST, dtype=np.uint8)
                else:
                    df = np.frombuffer(row["often"], dtype=np.uint8)
                parts.append((np.repeat(sigs, counts), tokens, df))
        if not info:
            return
        sigs, first = np.unique(np.concatenate([i[0] for i in info]), return_index=True)
        ns = np.concatenate([i[1] for i in info])[first].astype(np.int64)
        owner, tokens, df = (np.concatenate([p[i] for p in parts]) for i in range(3))
        parts.clear()
        owner = np.searchsorted(sigs, owner)
        order = np.lexsort((tokens, df, owner))
        owner, tokens = owner[order], tokens[order]
        fresh = np.r_[True, (owner[1:] != owner[:-1]) | (tokens[1:] != tokens[:-1])]  # hot tokens come once per copy
        owner, tokens = owner[fresh[: len(owner)]], tokens[fresh[: len(owner)]]
        shared = np.bincount(owner, minlength=len(sigs))
        k = prefix(ns, percent) - (ns - shared)
        ends = np.cumsum(shared)
        alive = np.flatnonzero((k > 0) & (shared > 0))
        for at in range(0, len(alive), 512):
            mine = alive[at : at + 512].tolist()
            own = [tokens[ends[i] - shared[i] : ends[i]] for i in mine]
            yield pa.RecordBatch.from_arrays([
                pa.array(sigs[mine]), pa.array(ns[mine]), pa.array(k[mine]), pa.array([_pack(t, WIDE) for t in own], type=pa.binary()),
                pa.array([t[: k[i]].view(np.int64) for t, i in zip(own, mine, strict=True)], type=pa.list_(pa.int64()))],
                names=["node", "n", "k", "tokens", "keys"])

    return back.mapInArrow(per_task(run), "node long, n long, k long, tokens binary, keys array<long>")


def test(percent: int) -> Callable[[dict], Callable[[int, int], bool]]:
    """The exact test of two sets: sizes, prefixes under the further orders,
    intersection."""

    def make(columns: dict):
        ns, ks, raw = columns["n"], columns["k"], columns["tokens"]

        @lru_cache(maxsize=None)
        def whole(i: int) -> frozenset:
            return frozenset(_unpack(raw[i], WIDE).tolist())

        @lru_cache(maxsize=None)
        def first(i: int) -> tuple[frozenset, ...]:
            t = _unpack(raw[i], WIDE)
            return tuple(frozenset(t[np.argsort(mix(t ^ s))[: ks[i]]].tolist()) for s in SEEDS)

        def similar(x: int, y: int) -> bool:
            if 100 * min(ns[x], ns[y]) < percent * max(ns[x], ns[y]):
                return False
            if any(a.isdisjoint(b) for a, b in zip(first(x), first(y), strict=True)):
                return False
            both = len(whole(x) & whole(y))
            return 100 * both >= percent * (ns[x] + ns[y] - both)

        return similar

    return make


def near(percent: int) -> Callable[[dict], Callable[[int, np.ndarray], np.ndarray]]:
    """Sets whose size allows the similarity with one."""

    def make(columns: dict):
        ns = np.array(columns["n"], dtype=np.int64)
        return lambda x, rest: 100 * np.minimum(ns[x], ns[rest]) >= percent * np.maximum(ns[x], ns[rest])

    return make


def join(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id reachable by
    links, the row's own for an empty set) of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = scratch.write(members(docs, settings, text))
    member = rows.where("not counted").select("doc_id", "n", F.col("key").alias("sig"))
    sets = member.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("least"))
    # A token in 1/32 of all sets is in 1/HOT of a flush's sets often enough to
    # reach 1/HOT of all; tokens that do are at most HOT times the mean set size.
    n_sets = sets.count()
    hot = np.sort(np.array([r.key for r in rows.where("counted").groupBy("key").agg(F.sum("n").alias("n"))
                            .where(F.col("n") * HOT >= max(n_sets, HOT * 64)).select("key").collect()], dtype=np.int64).view(np.uint64))
    packed = dealt(docs, hot, ranges, settings, text).repartitionById(ranges, "to")
    back = counted(packed, ranges).repartitionById(ranges, "to")
    items = scratch.write(survivors(back, settings))
    del packed, back  # the dealt tokens' files may go
    postings = items.select(F.explode("keys").alias("key"), "node")
    cluster = scratch.write(components(scratch, stars(postings)))
    found = link(scratch, items, cluster, ["n", "k", "tokens"], test(settings.percent), near(settings.percent))
    rooted = sets.join(found.withColumnRenamed("node", "sig"), "sig", "left").select("sig", F.coalesce("root", "sig").alias("root"), "least")
    rooted = scratch.write(rooted)
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.write(rooted.select("sig", F.bitwise_not("root").alias("k")).join(
        lowest.select(F.bitwise_not("root").alias("k"), "component_id"), "k").select("sig", "component_id"))
    scratch.keep(rows, named)
    return member.join(named, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """One document of each group stays: the one with the least id. Rows that
    repeat its id and text stay as well (they are the same document)."""
    ids = join(docs, settings, text).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return docs.join(ids.withColumnRenamed("doc_id", "__id"), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi").select(*docs.columns)
