"""Connected components, and linking within skew-safe groups of candidates.

``components`` is the alternating large-star / small-star algorithm on edges
of longs. ``link`` joins items that share a candidate key (a prefix token, a
band) and pass an exact pairwise test, and returns their components without
ever making all pairs of a large group:

1. items with a common key become candidate clusters (components over one
   star per key, ``stars``);
2. a cluster is dealt into chunks of about ``CHUNK`` items, each chunk also
   gets about ``LEADERS`` items of the whole cluster; a task links the items
   of one chunk, testing only pairs that share a key and are not connected
   yet;
3. where one cluster has several chunks, two unconnected items of different
   chunks may still pass the test. They meet again by the keys that
   unconnected items share, which are few: once for all such keys with the
   same least item (a family). A family of more than ``CHUNK`` items is dealt
   into blocks, and its items outside its largest component visit every block.

Connectivity is exact: every pair that shares a key is either tested or
already connected.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postscope.llm.common import ROWS, Scratch, mix, per_task

CHUNK = 400
LEADERS = 8
CROWD = 256  #: a key of more nodes is compared by itself, in blocks of ``BLOCK`` pairs
BLOCK = 1 << 18


def forest(edges: DataFrame) -> DataFrame:
    """Each task's edges (a, b) reduced to a star per local component."""

    def run(batches):
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while (up := parent.get(root, root)) != root:
                root = up
            while x != root:
                parent[x], x = root, parent[x]
            return root

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        roots = [find(x) for x in nodes]
        for at in range(0, len(nodes), 50_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[at : at + 50_000], type=pa.int64()), pa.array(roots[at : at + 50_000], type=pa.int64())], names=["a", "b"])

    return edges.select("a", "b").mapInArrow(per_task(run), "a long, b long").where("a <> b")


def _with_least(edges: DataFrame, key: str, of: str) -> DataFrame:
    """Edges (a, b) with m, the least b of the a that equals ``key`` (null: it
    hangs on nothing). The join key is the complement, so both sides are
    exchanged anew and a node with very many neighbours can be split by the
    skew join."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.bitwise_not("a").alias("k"), "m")
    return edges.withColumn("k", F.bitwise_not(key)).join(least, "k", of).drop("k")


def _stars_only(edges: DataFrame) -> bool:
    """Every node hangs on one other node (a, b), and none hangs on a node
    that hangs itself: one star per component."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select(F.col("b").alias("x"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    seen = ends.groupBy("x").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return seen.where("hangs > 1 or (hangs = 1 and holds = 1)").isEmpty()


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge (a, b); the root is the least
    node of its component. Loops, repeated edges and both directions are
    allowed; no edges give no rows."""
    now = scratch.write(forest(edges).distinct())
    del edges  # its shuffle files may go
    while not _stars_only(now):
        # large star: each node hangs on the least node that its own one hangs on; small
        # star: what a node hangs on hangs on the least of them. One written step, as
        # the exchanges of the first are read twice.
        large = _with_least(now, "b", "left").select("a", F.coalesce("m", "b").alias("b"))
        small = _with_least(large, "a", "inner").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*").where("a <> b").distinct()
        now = scratch.write(small)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def local_links(keys: list[np.ndarray], similar: Callable[[int, int], bool], label: np.ndarray, side: np.ndarray | None = None,
                near: Callable[[int, np.ndarray], np.ndarray] | None = None,
                many: Callable[[int, np.ndarray], np.ndarray] | None = None) -> list[tuple[int, int]]:
    """Links (x, y) that connect everything connectable: pairs that share a
    key (and differ in ``side``), have different labels and are similar;
    ``near`` rules out some that aren't, many at once, and ``many``, where
    given, is ``similar`` of one item and several others."""
    label, links = label.copy(), []
    sizes = np.array([len(k) for k in keys])
    if not sizes.sum():
        return links
    ends = np.cumsum(sizes)
    _, key = np.unique(np.concatenate(keys), return_inverse=True)
    order = np.argsort(key, kind="stable")
    owner = np.repeat(np.arange(len(keys)), sizes)[order]
    place = np.empty(len(key), dtype=np.int64)
    place[order] = np.arange(len(key))
    first = np.r_[0, np.cumsum(np.bincount(key))][key]
    for x in range(len(keys)):
        span = slice(ends[x] - sizes[x], ends[x])
        found = [owner[a:b] for a, b in zip(first[span].tolist(), place[span].tolist(), strict=True) if b > a]
        if not found:
            continue
        rest, shared = np.unique(np.concatenate(found), return_counts=True)
        good = label[rest] != label[x]
        if side is not None:
            good &= side[rest] != side[x]
        rest, shared = rest[good], shared[good]
        if near is not None and len(rest):
            good = near(x, rest)
            rest, shared = rest[good], shared[good]
        rest = rest[np.argsort(-shared, kind="stable")]
        step = 8
        while many is not None and len(rest):
            some, rest = rest[:step], rest[step:]
            hit = some[many(x, some)]
            for y in hit.tolist():
                if label[y] != label[x]:
                    links.append((x, y))
                    label[label == label[y]] = label[x]
            if len(hit):
                rest = rest[label[rest] != label[x]]
            step *= 8
        while len(rest):
            y = int(rest[0])
            if similar(x, y):
                links.append((x, y))
                label[label == label[y]] = label[x]
                rest = rest[label[rest] != label[x]]
            else:
                rest = rest[1:]
    return links


def _verify(rows: DataFrame, group: list[str], payload: list[str], make: Callable[[dict], Callable[[int, int], bool]],
            near: Callable[[dict], Callable[[int, np.ndarray], np.ndarray]] | None = None,
            many: Callable[[dict], Callable[[int, np.ndarray], np.ndarray]] | None = None) -> DataFrame:
    """Links (a, b) within each group. ``rows``: the group columns (long),
    node, keys, label, visitor and the payload. A task takes its groups one
    after the other from sorted rows and holds one at a time."""

    def links(part: pa.RecordBatch | pa.Table, out: tuple[list, list]) -> None:
        nodes = part.column("node").to_numpy()
        if len(nodes) < 2:
            return
        visitor = part.column("visitor").to_numpy(zero_copy_only=False)
        keys = [np.asarray(k, dtype=np.int64) for k in part.column("keys").to_pylist()]
        _, label = np.unique(part.column("label").to_numpy(), return_inverse=True)
        columns = {c: part.column(c).to_pylist() for c in payload}
        for x, y in local_links(keys, make(columns), label, visitor if visitor.any() else None, near and near(columns), many and many(columns)):
            out[0].append(nodes[x])
            out[1].append(nodes[y])

    def run(batches):
        held: list[pa.RecordBatch] = []  # of the group that isn't complete yet
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(c).to_numpy() for c in group])
            starts = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1).tolist()]
            out: tuple[list, list] = ([], [])
            for at, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                this = tuple(ids[:, at].tolist())
                if this != last and held:
                    links(pa.concat_batches(held), out)
                    held = []
                last = this
                held.append(batch.slice(at, end - at))
            yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in out], names=["a", "b"])
        if held:
            out = ([], [])
            links(pa.concat_batches(held), out)
            yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in out], names=["a", "b"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*group, "node", "keys", "label", "visitor", *payload).repartition(parts, *group)
    return dealt.sortWithinPartitions(*group, "visitor", "node").mapInArrow(per_task(run), "a long, b long")


def stars(postings: DataFrame, flush: int = 1_000_000) -> DataFrame:
    """Edges (a, b) that connect all nodes with a common key: one star per key.

    ``postings``: key long, node long. Each task first connects what it has
    and sends one node per key, so a key of very many nodes reaches its reducer
    as one row per task (and per ``flush`` postings)."""

    def star(key: np.ndarray, node: np.ndarray):  # in order of the key
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        least = np.minimum.reduceat(node, first)
        centre = np.repeat(least, np.diff(first, append=len(key)))
        spoke = node != centre
        edges = np.ascontiguousarray(np.stack([node[spoke], centre[spoke]], axis=1))
        return key[first], least, np.unique(edges.view("i8,i8")).view(np.int64).reshape(-1, 2)

    def rows(key: np.ndarray, node: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(node)], names=["key", "node"])

    def combine(batches):
        parts, size = [], 0

        def out():
            key, node = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            order = np.argsort(key)
            key, node, edges = star(key[order], node[order])
            yield rows(key, node)
            if len(edges):  # an edge goes on as two nodes of a key of its own
                own = mix(mix(edges[:, 0].view(np.uint64)) + edges[:, 1].view(np.uint64)).view(np.int64)
                yield rows(np.r_[own, own], np.r_[edges[:, 0], edges[:, 1]])

        for batch in batches:
            parts.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= flush:
                yield from out()
                parts, size = [], 0
        if size:
            yield from out()

    def reduce(batches):  # in order of the key
        last = None
        for batch in batches:
            key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(key):
                continue
            if last is not None and last[0] == key[0]:
                key, node = np.r_[last[0], key], np.r_[last[1], node]
            keys, centres, edges = star(key, node)
            last = keys[-1], centres[-1]
            if len(edges):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(edges[:, i])) for i in (0, 1)], names=["a", "b"])

    local = postings.select("key", "node").mapInArrow(per_task(combine), "key long, node long")
    parts = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return local.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(per_task(reduce), "a long, b long")


def _blank(mark: np.ndarray) -> np.ndarray:
    """Whether a mark (a number, or a row of them) is 0."""
    return mark == 0 if mark.ndim == 1 else ~mark.any(axis=1)


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (the least node of each one's component) after edges (a, b) more."""
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        low = np.minimum(x, y)
        root = root.copy()
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        while (root[root] != root).any():
            root = root[root]


def _crowd(mark: np.ndarray, alike: Callable[[np.ndarray, np.ndarray], np.ndarray], share: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(root, whole, a, b) of the nodes of one key: components by alike marks,
    whether a node's one has more than ``share`` alike pairs a node, and the
    pairs of the others. What a whole component has inside isn't compared any
    more, so pairs stay few."""
    n = len(mark)
    root, whole, pairs = np.arange(n), np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)
    a, b, at = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), 0
    while at < n:
        end = min(n, at + max(1, BLOCK // (n - at)))
        rest = np.arange(at, n)
        if whole[at:end].all() and (root[at:end] == root[at]).all():
            rest = rest[root[rest] != root[at]]
        x, y = np.repeat(np.arange(at, end), len(rest)), np.tile(rest, end - at)
        good = (x < y) & ~(whole[x] & (root[x] == root[y]))
        x, y = x[good], y[good]
        hit = alike(mark[x], mark[y])
        x, y, at = x[hit], y[hit], end
        if not len(x):
            continue
        a, b = np.r_[a, x], np.r_[b, y]
        pairs += np.bincount(x, minlength=n)
        root = _joined(root, x, y)
        dense = np.bincount(root, pairs, n) > share * np.bincount(root, minlength=n)
        dense[root[whole]] = True
        whole = dense[root]
        a, b = a[~whole[a]], b[~whole[a]]
    return root, whole, a, b


def _ties(key: np.ndarray, node: np.ndarray, mark: np.ndarray, alike: Callable[[np.ndarray, np.ndarray], np.ndarray],
          share: int, compared: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, whole) for the nodes of each key. Nodes connected by alike marks
    are a group; a group gives all its alike pairs or, if they are more than
    ``share`` a node, or a mark is 0, edges that connect it (whole). A key of
    more than ``compared`` nodes is connected whole. Rows in order of the key."""
    n = len(key)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(first, append=n)
    root, large, dense = np.arange(n), np.repeat(size > compared, size), np.zeros(n, dtype=bool)
    root[large] = np.repeat(first, size)[large]
    at, step, pairs = np.flatnonzero(~large & np.repeat(size <= CROWD, size)), 0, []
    while len(at):
        step += 1
        at = at[at + step < n]
        at = at[key[at + step] == key[at]]
        hit = at[alike(mark[at], mark[at + step])]
        pairs.append((hit, hit + step))
    a, b = (np.concatenate([p[i] for p in pairs]) if pairs else np.empty(0, dtype=np.int64) for i in (0, 1))
    root = _joined(root, a, b)
    for i in np.flatnonzero((size > CROWD) & (size <= compared)).tolist():
        span = slice(first[i], first[i] + size[i])
        own, dense[span], x, y = _crowd(mark[span], alike, share)
        root[span] = own + first[i]
        a, b = np.r_[a, x + first[i]], np.r_[b, y + first[i]]
    whole = np.bincount(root[a], minlength=n) > share * np.bincount(root, minlength=n)  # by root
    whole[root[_blank(mark) | large | dense]] = True
    one = ~whole[root[a]]
    spoke = np.flatnonzero(whole[root] & (root != np.arange(n)))
    return (np.r_[node[a[one]], node[spoke]], np.r_[node[b[one]], node[root[spoke]]],
            np.r_[np.zeros(int(one.sum()), dtype=bool), np.ones(len(spoke), dtype=bool)])


def alike_pairs(rows: DataFrame, post: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]],
                alike: Callable[[np.ndarray, np.ndarray], np.ndarray], share: int = 16, compared: int = 1 << 15, flush: int = 1_000_000, most: int = 1024) -> DataFrame:
    """Candidates (a, b, whole) among nodes with a common key and alike marks.

    ``post`` gives the postings of a batch of ``rows``: key (int64), node
    (int64), mark (uint64, or a row of several). ``alike`` tells which of two arrays of marks may
    belong to similar nodes and must hold where either is 0. Nodes of a key that
    alike marks connect are a group; where it has at most ``share`` alike pairs
    a node, all these pairs are given, so there are no more than ``share`` rows a
    posting. Elsewhere (``whole``) edges are given that connect the group, directly or through others; connecting too
    much is harmless, so hot keys aren't compared: a task sends one node, marked
    0, of a key with more than ``most`` nodes there (per ``flush`` postings),
    and a key of more than ``compared`` nodes is connected whole.
    Postings travel packed by range of the key, with 32 bits of it inside the
    range (two keys that meet are compared as one, which is harmless); a task
    holds its range, and the number of ranges is that of the shuffle partitions."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def combine(batches):
        held, size = [], 0

        def out():
            key, node, mark = (np.concatenate([p[i] for p in held]) for i in range(3))
            order = np.argsort(key)
            key, node, mark = key[order], node[order], mark[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(first, append=len(key))
            hot = np.repeat(sizes > most, sizes)
            if hot.any():
                # repeats of a node don't make a key hot
                k, n, m = _ordered(key[hot], node[hot], mark[hot])
                first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
                sizes = np.diff(first, append=len(k))
                often = np.repeat(sizes > most, sizes)
                heads, centre = first[sizes > most], np.repeat(n[first], sizes)
                spoke = often & (n != centre)
                a, b = n[spoke], centre[spoke]
                own = mix(mix(a.view(np.uint64)) + b.view(np.uint64)).view(np.int64)  # an edge goes on as two nodes of a key of its own
                none = np.zeros((len(heads) + 2 * len(a), *mark.shape[1:]), dtype=np.uint64)
                key = np.r_[key[~hot], k[~often], k[heads], own, own]
                node = np.r_[node[~hot], n[~often], n[heads], a, b]
                mark = np.concatenate([mark[~hot], m[~often], none])
            mixed = mix(key.view(np.uint64))
            key = mixed.astype(np.uint32)
            to = ((mixed >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint16 if parts <= 1 << 16 else np.int32)
            order = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[order], np.arange(parts + 1))
            full = np.flatnonzero(np.diff(cuts))
            columns = [c[order] for c in (key, node, mark)]
            for part in full.tolist():
                at = slice(cuts[part], cuts[part + 1])
                yield pa.RecordBatch.from_arrays([pa.array([part], type=pa.int32()), *(pa.array([c[at].tobytes()], type=pa.binary()) for c in columns)],
                                                 names=["to", "key", "node", "mark"])

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                held.append(post(batch.slice(at, ROWS)))
                size += len(held[-1][0])
                if size >= flush:
                    yield from out()
                    held, size = [], 0
        if size:
            yield from out()

    def reduce(batches):
        held: dict[int, list] = {}
        for batch in batches:
            to = batch.column("to").to_pylist()
            for i, part in enumerate(to):
                held.setdefault(part, []).append([np.frombuffer(batch.column(c)[i].as_py(), dtype=kind) for c, kind in
                                                  (("key", np.uint32), ("node", np.int64), ("mark", np.uint64))])
        for part in list(held):
            found = held.pop(part)
            key, node, mark = (np.concatenate([f[i] for f in found]) for i in range(3))
            mark = mark if len(mark) == len(key) else mark.reshape(len(key), -1)
            found.clear()
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            order = order[np.r_[False, same] | np.r_[same, False]]  # a key met once has no pairs
            key, node, mark = _ordered(key[order], node[order], mark[order])
            cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True]) if len(key) else np.zeros(1, dtype=np.int64)
            at = 0
            while at < len(key):  # whole keys, about 50,000 postings at once
                end = int(cuts[min(np.searchsorted(cuts, at + 50_000), len(cuts) - 1)])
                a, b, whole = _ties(key[at:end], node[at:end], mark[at:end], alike, share, compared)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(whole)], names=["a", "b", "whole"])
                at = end

    local = rows.mapInArrow(per_task(combine), "to int, key binary, node binary, mark binary")
    return local.repartitionById(parts, "to").mapInArrow(per_task(reduce), "a long, b long, whole boolean")


def _ordered(key: np.ndarray, node: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By key and node, each pair once; of its marks 0 goes first."""
    order = np.lexsort((~_blank(mark), node, key))
    key, node, mark = key[order], node[order], mark[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])] if len(key) else np.empty(0, dtype=bool)
    return key[new], node[new], mark[new]


def alike_stars(postings: DataFrame, alike: Callable[[np.ndarray, np.ndarray], np.ndarray], flush: int = 1_000_000, most: int = 64) -> DataFrame:
    """Edges (a, b) that connect all nodes with a common key and alike marks,
    directly or through others; ``postings``: key long, node long, mark long."""

    def post(batch):
        return batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)

    return alike_pairs(postings.select("key", "node", "mark"), post, alike, 0, CHUNK, flush, most).select("a", "b")


def links_of(scratch: Scratch, items: DataFrame, cluster: DataFrame, payload: list[str],
             make: Callable[[dict], Callable[[int, int], bool]], near: Callable[[dict], Callable[[int, np.ndarray], np.ndarray]] | None = None,
             many: Callable[[dict], Callable[[int, np.ndarray], np.ndarray]] | None = None) -> DataFrame:
    """Edges (a, b) that connect items as far as similar pairs that share a key do.

    ``items``: node long (distinct), keys array<long> (distinct), and the
    payload columns; ``cluster``: node and root, the components of
    ``stars`` over the keys. Both should be written tables, as they are read
    repeatedly. ``make(columns)`` returns the exact
    test of two rows of a group, given the payload columns as lists; ``near``
    likewise which of many rows may be similar to one, ``many`` which are.
    """
    cluster = cluster.withColumnRenamed("root", "cluster")
    sizes = cluster.groupBy("cluster").agg(F.count("*").alias("size"))
    chunks = F.ceil(F.col("size") / CHUNK).cast("long")
    member = (cluster.withColumn("k", F.bitwise_not("cluster"))
              .join(sizes.select(F.bitwise_not("cluster").alias("k"), "size"), "k").drop("k")
              .select("node", "cluster", chunks.alias("chunks"),
                      F.pmod(F.xxhash64("node"), chunks).alias("chunk"),
                      # about LEADERS items of a cluster of several chunks are in all of them
                      ((chunks > 1) & (F.pmod(F.xxhash64("node", F.lit(1)), F.greatest(F.floor(F.col("size") / LEADERS), F.lit(1))) == 0)).alias("leader")))
    member = scratch.write(member)
    placed = scratch.write(items.join(member, "node"))
    groups = placed.withColumn("chunk", F.explode(F.when(F.col("leader"), F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).otherwise(F.array("chunk"))))
    rows = groups.select("cluster", "chunk", "node", "keys", F.col("node").alias("label"), F.lit(False).alias("visitor"), *payload)
    links = scratch.write(_verify(rows, ["cluster", "chunk"], payload, make, near, many))
    split = member.where("chunks > 1")
    if split.isEmpty():
        return links

    found = components(scratch, links)
    label = split.join(found, "node", "left").select("node", F.coalesce("root", "node").alias("label"))
    some = placed.where("chunks > 1")  # the items of these clusters only
    seen = some.select("node", "keys").join(label, "node").select("node", "label", F.explode("keys").alias("key"))
    # Keys with items that aren't connected yet, one of those with the same items.
    # Keys with the same least item are a family: most of an item's keys are in few.
    mixed = (seen.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"),
                                     F.min("node").alias("family"), F.bit_xor(F.xxhash64("node")).alias("who"))
             .where("low <> high").groupBy("family", "who", "n", "low", "high").agg(F.min("key").alias("key")).select("key", "family"))
    asked = scratch.write(seen.join(mixed, "key").groupBy("family", "node", "label").agg(F.collect_list("key").alias("keys")))
    by_size = asked.groupBy("family", "label").agg(F.count("*").alias("n"))
    families = by_size.groupBy("family").agg(F.max_by("label", F.struct("n", "label")).alias("largest"), F.sum("n").alias("n"), F.max("n").alias("most"))
    large = scratch.write(families.where(F.col("n") > CHUNK).select(
        "family", "largest", F.ceil(F.col("n") / CHUNK).cast("long").alias("parts"), F.ceil((F.col("n") - F.col("most")) / CHUNK).cast("long").alias("crowds")))
    dealt = asked.join(large, "family", "left")
    none = F.lit(0).cast("long")
    groups = asked.count() // CHUNK + 1
    # small families, about CHUNK rows of them at once
    small = dealt.where("parts is null").select(
        F.pmod(F.xxhash64("family"), F.lit(groups)).alias("group"), F.lit(-1).cast("long").alias("part"), none.alias("crowd"),
        "node", "keys", "label", F.lit(False).alias("visitor"))
    # the others in blocks; what is outside the largest component of its family visits all of them
    dealt = dealt.where("parts is not null").withColumn("group", F.col("family"))
    hosts = dealt.select("group", F.pmod(F.xxhash64("node"), "parts").alias("part"), F.explode(F.sequence(none, F.col("crowds") - 1)).alias("crowd"),
                         "node", "keys", "label", F.lit(False).alias("visitor"))
    guests = dealt.where("label <> largest").select(
        "group", F.explode(F.sequence(none, F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("node", F.lit(1)), "crowds").alias("crowd"),
        "node", "keys", "label", F.lit(True).alias("visitor"))
    rows = small.unionByName(hosts).unionByName(guests).join(some.select("node", *payload), "node")
    more = scratch.write(_verify(rows, ["group", "part", "crowd"], payload, make, near, many))
    return links.union(more)


def link(scratch: Scratch, items: DataFrame, cluster: DataFrame, payload: list[str],
         make: Callable[[dict], Callable[[int, int], bool]], near: Callable[[dict], Callable[[int, np.ndarray], np.ndarray]] | None = None) -> DataFrame:
    """(node, root) of the items that ``links_of`` connects."""
    return components(scratch, links_of(scratch, items, cluster, payload, make, near))
