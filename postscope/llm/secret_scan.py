"""Secret scans by inferred credential formats.

Three fixed patterns label credentials (``assign``, ``access``, ``hex``).
From a bounded sample of the labelled strings of each kind a probabilistic
automaton is inferred: a prefix tree over character classes whose states are
merged while their outgoing frequencies are statistically compatible (the
Hoeffding test of ALERGIA). A background automaton is inferred the same way
from ordinary tokens. Every long token outside the base spans is scored by its
likelihood under each format; it becomes a ``format`` span when it is as
likely per character as nearly all labelled strings of that format and far
likelier there than under the background.

Null text reads as empty. Spans are code points, end exclusive. Repeated rows
are scanned one by one. Without labelled strings of a kind that kind has no
automaton and adds nothing. Sampling keeps the distinct strings with the
smallest hashes (``Settings.sample`` per kind): it fits models only, every
other labelled string counts for a format's likelihood cutoff, and all texts
are scanned whole.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postscope.llm.common import arrow_map, texts

# The base patterns and the least lengths of their matches.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, so the length may stand in the pattern
KINDS = ("assign", "access", "hex")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
ADDED = "format"
FOUND = T.StructType().add("kind", "string").add("start", "long").add("end", "long").add("base", "boolean")


@dataclass(frozen=True)
class Settings:
    sample: int = 400  #: strings per kind (and for the background) that automata are inferred from
    compat: float = 0.05  #: significance of the compatibility test; smaller merges more
    margin: float = 1.0  #: least log-likelihood ratio per character against the background
    tolerated: float = 0.02  #: share of labelled strings that a format's likelihood cutoff may lose
    most: int = 200  #: longest prefix of a labelled string that an automaton learns from; scoring reads whole tokens


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) in order."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out.sort()
    return out


def candidates(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens of 16 or more characters with a digit that touch no base span."""
    reach = list(accumulate((e for _, _, e in spans), max))  # the furthest end so far
    starts = [s for s, _, _ in spans]
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        token = m[0]
        if token.isalpha() or not any(c.isdigit() for c in token):
            continue
        before = bisect_left(starts, b)  # spans that start before the token's end
        if not before or reach[before - 1] <= a:
            yield a, b


def _class_table() -> dict[int, str]:
    """Character classes: digit, hex letter, other letter by case; signs stand for themselves."""
    table = {}
    for c in "0123456789":
        table[ord(c)] = "d"
    for c in "abcdefghijklmnopqrstuvwxyz":
        table[ord(c)] = "h" if c <= "f" else "l"
        table[ord(c.upper())] = "H" if c <= "f" else "L"
    return table


CLASSES = _class_table()
#: Characters of each class: a class's probability is shared among them.
WIDTH = {"d": 10, "h": 6, "l": 20, "H": 6, "L": 20}
END = ""


class Automaton:
    """Probabilistic automaton inferred from strings (ALERGIA)."""

    def __init__(self, strings: list[str], compat: float):
        self.count, self.ends, self.next = [0], [0], [{}]
        for s in sorted(strings):
            self._add(s.translate(CLASSES))
        self.root = self._merge(compat)

    def _add(self, s: str) -> None:
        at = 0
        self.count[0] += 1
        for c in s:
            if c not in self.next[at]:
                self.count.append(0)
                self.ends.append(0)
                self.next.append({})
                self.next[at][c] = [len(self.count) - 1, 0]
            edge = self.next[at][c]
            edge[1] += 1
            at = edge[0]
            self.count[at] += 1
        self.ends[at] += 1

    def _differs(self, a: int, n: int, b: int, m: int) -> bool:
        return n > 0 and m > 0 and abs(a / n - b / m) > self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, p: int, q: int) -> bool:
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            n, m = self.count[p], self.count[q]
            if self._differs(self.ends[p], n, self.ends[q], m):
                return False
            for c in self.next[p].keys() | self.next[q].keys():
                x, y = self.next[p].get(c), self.next[q].get(c)
                if self._differs(x[1] if x else 0, n, y[1] if y else 0, m):
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def _fold(self, p: int, q: int) -> None:
        """Add the tree below ``q`` into ``p``."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            self.count[p] += self.count[q]
            self.ends[p] += self.ends[q]
            for c, (child, n) in self.next[q].items():
                if c in self.next[p]:
                    self.next[p][c][1] += n
                    todo.append((self.next[p][c][0], child))
                else:
                    self.next[p][c] = [child, n]

    def _merge(self, compat: float) -> int:
        self.bound = math.sqrt(0.5 * math.log(2 / compat))
        red = [0]
        while True:
            known = set(red)
            blue = sorted(((-self.count[e[0]], r, c) for r in red for c, e in self.next[r].items() if e[0] not in known))
            if not blue:
                return 0
            _, r, c = blue[0]
            b = self.next[r][c][0]
            for p in red:
                if self._compatible(p, b):
                    self.next[r][c][0] = p
                    self._fold(p, b)
                    break
            else:
                red.append(b)

    def log_likelihood(self, s: str) -> float:
        """Smoothed: an unseen step costs one count among all classes."""
        at, total = self.root, 0.0
        for c in s.translate(CLASSES):
            n, edge = self.count[at], self.next[at].get(c)
            total += math.log(((edge[1] if edge else 0) + 0.05) / ((n + 1) * WIDTH.get(c, 1)))
            at = edge[0] if edge else self.root
        return total + math.log((self.ends[at] + 0.05) / (self.count[at] + 1))


def _rate(a: Automaton, s: str) -> float:
    return a.log_likelihood(s) / (len(s) + 1)


class Grammar:
    """An automaton per kind, and the background; ``formats`` holds a kind's
    automaton and likelihood cutoff once the cutoff is known."""

    def __init__(self, strings: dict[str, list[str]], settings: Settings):
        self.settings, self.formats = settings, {}
        self.machines: dict[str, tuple[Automaton, frozenset]] = {}  # with the strings it learnt from
        cut = {k: [s[: settings.most] for s in v] for k, v in strings.items()}
        self.background = Automaton(cut.get(ADDED, []), settings.compat)
        for kind in KINDS:
            known = cut.get(kind, [])
            if len(known) < 20:  # too few for a frequency test and a cutoff
                continue
            self.machines[kind] = Automaton(known[::2], settings.compat), frozenset(strings[kind][::2])

    def accepts(self, token: str) -> bool:
        rates = [(r, least) for m, least in self.formats.values() if (r := _rate(m, token)) >= least]
        return bool(rates) and max(r for r, _ in rates) - _rate(self.background, token) >= self.settings.margin


def labelled(docs: DataFrame, settings: Settings, text: str = "text") -> dict[str, list[str]]:
    """Kind -> at most ``sample`` distinct strings, those of the smallest
    hashes among all texts; ``format`` holds background tokens. Each task
    sends at most ``sample`` strings per kind."""

    def run(batches):
        kept: dict[str, list[tuple[int, str]]] = defaultdict(list)
        seen: dict[str, set[str]] = defaultdict(set)

        def offer(kind: str, s: str) -> None:
            if s in seen[kind]:
                return
            entry = (-xxhash.xxh3_64_intdigest(s.encode("utf-8")), s)
            if len(kept[kind]) < settings.sample:
                heapq.heappush(kept[kind], entry)
                seen[kind].add(s)
            elif entry > kept[kind][0]:
                seen[kind].discard(heapq.heapreplace(kept[kind], entry)[1])
                seen[kind].add(s)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for t in texts(batch.slice(at, 256), "__text"):
                    spans = base_spans(t)
                    for a, kind, b in spans:
                        s = t[a:b]
                        offer(KINDS[kind], ASSIGN.match(s)[2] if kind == 0 else s)
                    for a, b in candidates(t, spans):
                        offer(ADDED, t[a:b])
        for kind, rows in kept.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(rows)), pa.array([r[1] for r in rows]), pa.array([-r[0] >> 1 for r in rows])],
                names=["kind", "s", "h"])

    found = docs.select(F.col(text).alias("__text")).mapInArrow(run, "kind string, s string, h long")
    # in two steps, so that no task gets what all tasks found of a kind
    some = Window.partitionBy("kind", F.pmod(F.xxhash64("s"), F.lit(64))).orderBy("h", "s")
    order = Window.partitionBy("kind").orderBy("h", "s")
    least = found.distinct().withColumn("n", F.row_number().over(some)).where(F.col("n") <= settings.sample)
    rows = least.withColumn("n", F.row_number().over(order)).where(F.col("n") <= settings.sample).collect()
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.kind, r.n)):
        out[r.kind].append(r.s)
    return out


BUCKET = 10_000  #: buckets of the log-likelihood per character, to a unit


def learn(docs: DataFrame, settings: Settings, text: str = "text") -> Grammar:
    """The grammar, with cutoffs from all distinct labelled strings that its
    automata did not learn from. The driver receives counts per bucket."""
    grammar = Grammar(labelled(docs, settings, text), settings)
    if not grammar.machines:
        return grammar
    held = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        machines, found = held.value.machines, set()
        for t in texts(batch, "__text"):
            for a, k, b in base_spans(t):
                found.add((KINDS[k], ASSIGN.match(t, a)[2] if k == 0 else t[a:b]))
        rows = sorted((k, s) for k, s in found if k in machines and s not in machines[k][1])
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows], type=pa.string()), pa.array([xxhash.xxh3_128_digest(s.encode("utf-8")) for _, s in rows], type=pa.binary()),
             pa.array([_rate(machines[k][0], s) for k, s in rows], type=pa.float64())], names=["kind", "h", "rate"])

    rates = arrow_map(docs.select(F.col(text).alias("__text")), run, "kind string, h binary, rate double")
    one = rates.groupBy("kind", "h").agg(F.min("rate").alias("rate"))
    counts = one.groupBy("kind", F.floor(F.col("rate") * BUCKET).alias("b")).agg(F.count("*").alias("n"), F.min("rate").alias("least")).collect()
    for kind, (machine, _) in grammar.machines.items():
        mine = sorted((r.b, r.n, r.least) for r in counts if r.kind == kind)
        rank = int(settings.tolerated * sum(n for _, n, _ in mine))
        for _, n, least in mine:
            if rank < n:
                grammar.formats[kind] = machine, least
                break
            rank -= n
    return grammar


def scan(docs: DataFrame, settings: Settings = Settings(), text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``found``: array of (kind, start, end, base), in
    order of start, then kind as listed with ``format`` last."""
    held = docs.sparkSession.sparkContext.broadcast(learn(docs, settings, text))
    sub = docs.select(*keep, F.col(text).alias("__text"))
    kept = docs.select(*keep).schema
    n = len(kept.fields)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        grammar, out = held.value, []
        for t in texts(batch, "__text"):
            spans = base_spans(t)
            added = [(a, len(KINDS), b) for a, b in candidates(t, spans) if grammar.accepts(t[a:b])] if grammar.formats else []
            out.append([{"kind": (*KINDS, ADDED)[k], "start": a, "end": b, "base": k < len(KINDS)} for a, k, b in sorted(spans + added)])
        return pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(out, type=pa.list_(span))], names=[*batch.schema.names[:n], "found"])

    return arrow_map(sub, run, kept.add("found", T.ArrayType(FOUND, False)))


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every span (they may overlap) replaced by ``mark``."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join(out) + text[at:]
