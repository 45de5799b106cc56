"""Document fingerprints by SpotSigs.

Every common word (anchor) of a text is followed by a chain of the next
``Settings.chain`` content words; the hashes of these spots form the text's
signature set, its fingerprint. Sets are partitioned by length: class
boundaries grow by ``1 / least``, so two sets of similarity ``least`` or more
lie in the same or in neighbouring classes. Comparison goes by class, then by
the bound ``min(n, m) / max(n, m)``, and counts the intersection last; a
likeness below ``least`` reads as 0.

In a text without a spot every word is the anchor of the words after it; one
too short for that has a single signature of all its words. Null, empty and blank texts have the empty fingerprint (likeness 1 to each other, 0
to all else). Equal texts have equal fingerprints.

``edited`` pairs every document with the next in order of descending id (null
ids last, equal ids by a hash of the text, the last followed by the first):
ids are cut into ranges, each range is sorted by one task, and the first
document of a range is also sent to the range before it. Repeated rows follow
one another; a lone document follows itself. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postscope.llm.common import WordHashes, arrow_map, mix, texts

# Anchors, the common words of four languages.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "als auch auf das dem den der die ein eine für im ist mit nicht sich und von zu "
    "au aux dans de des du en est et il la le les par pas pour que qui sur un une "
    "con del el las lo los para por se su y"
).split()
SIGNS = str.maketrans("", "", ".,;:!?\"'()[]{}#*$%&|<>")


@dataclass(frozen=True)
class Settings:
    chain: int = 2  #: content words after an anchor
    least: float = 0.1  #: likeness below it reads as 0


@lru_cache(maxsize=1)
def hashes() -> tuple[WordHashes, np.ndarray]:
    words = WordHashes()
    return words, np.sort(np.array([words[w.encode()] for w in set(ANCHORS)], dtype=np.uint64))


def signatures(text: str, chain: int = 2) -> np.ndarray:
    """The text's distinct signatures, ascending (uint32)."""
    words = text.lower().translate(SIGNS).encode().split()
    known, anchors = hashes()
    w = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    anchor = anchors[np.minimum(np.searchsorted(anchors, w), len(anchors) - 1)] == w
    content = np.flatnonzero(~anchor)
    at = np.flatnonzero(anchor)
    follow = np.searchsorted(content, at)
    whole = follow + chain <= len(content)
    at, follow = at[whole], follow[whole]
    if not len(at) and len(words) > chain:  # no spot: every word anchors the words after it
        at = follow = np.arange(len(words) - chain)
        content = np.arange(1, len(words))
    if not len(at):
        return (mix(np.array([int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest())], dtype=np.uint64)) >> np.uint64(32)
                ).astype(np.uint32) if len(words) else np.empty(0, dtype=np.uint32)
    spot = w[at]
    for j in range(chain):
        spot = mix(spot ^ (w[content[follow + j]] + np.uint64(j + 1)))
    return np.unique((spot >> np.uint64(32)).astype(np.uint32))


def fingerprint(signs: np.ndarray) -> str:
    return base64.b64encode(signs.astype(">u4").tobytes()).decode()


def parse(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype=">u4").astype(np.uint32)


def length_class(n: int, least: float) -> int:
    """Partition of a set of ``n`` signatures."""
    return int(math.log(n) / -math.log(least) + 1e-9) + 1 if n else 0


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.1) -> float:
    """Pruned Jaccard similarity of two ascending sets."""
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    if abs(length_class(n, least) - length_class(m, least)) > 1 or min(n, m) < least * max(n, m):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    found = both / (n + m - both)
    return found if found >= least else 0.0


def fingerprints(docs: DataFrame, settings: Settings = Settings(), text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, fingerprint and length_class of every row."""
    sub = docs.select(*keep, F.col(text).alias("__text"))
    kept = docs.select(*keep).schema
    n = len(kept.fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        signs = [signatures(t, settings.chain) for t in texts(batch, "__text")]
        columns = [pa.array(list(map(fingerprint, signs)), type=pa.string()), pa.array([length_class(len(s), settings.least) for s in signs], type=pa.int32())]
        return pa.RecordBatch.from_arrays([*batch.columns[:n], *columns], names=[*batch.schema.names[:n], "fingerprint", "length_class"])

    return arrow_map(sub, run, kept.add("fingerprint", "string").add("length_class", "integer"))


def in_order(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text and guest, partitioned by id range and sorted by descending
    id within; the last row of a partition (guest) is the first of the next
    range, that of the last range is the very first. The driver receives one
    bound and one head per range."""
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumns({
        "order": F.bitwise_not("doc_id"), "tie": F.xxhash64("text")})
    cuts = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] if ranges > 1 else []
    bounds = F.array(*map(F.lit, sorted(set(cuts or [])))).cast("array<long>")
    last = len(set(cuts or [])) + 1  # rows without an id
    rows = rows.withColumn("range", F.when(F.col("doc_id").isNull(), last).otherwise(
        F.size(F.filter(bounds, lambda b: b > F.col("doc_id")))))
    heads = rows.groupBy("range").agg(F.min(F.struct("order", "tie")).alias("head")).orderBy("range").collect()
    if not heads:
        return rows.select("doc_id", "text", F.lit(False).alias("guest"))
    # where the head of each range is a guest: the range before, cyclically
    table = spark.createDataFrame(
        [(h.range, h.head.order, h.head.tie, heads[i - 1].range) for i, h in enumerate(heads)], "range int, h_order long, h_tie long, host int")
    joined = rows.join(F.broadcast(table), "range")  # one row per range
    is_head = F.col("order").eqNullSafe(F.col("h_order")) & (F.col("tie") == F.col("h_tie"))
    own, visit = F.struct(F.col("range"), F.lit(False).alias("guest")), F.struct(F.col("host").alias("range"), F.lit(True).alias("guest"))
    placed = joined.select("doc_id", "text", "order", "tie", F.explode(F.when(is_head, F.array(own, visit)).otherwise(F.array(own))).alias("p"))
    return (placed.select("doc_id", "text", "order", "tie", "p.range", "p.guest").repartitionById(last + 1, "range")
            .sortWithinPartitions("guest", F.asc_nulls_last("order"), "tie").select("doc_id", "text", "guest"))


def edited(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next and length_class, where the edited text has its last
    third replaced by the start of the next document."""
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "length_class"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32()]

    def run(batches):
        before, done = None, False

        def result(own, following):
            (i, t, signs), (u, other) = own, following
            cut = len(t) // 3
            new = t[: len(t) - cut] + u[:cut]
            changed = signatures(new, settings.chain)
            return (i, len(t), hashlib.sha256(new.encode()).hexdigest(), fingerprint(signs), fingerprint(changed),
                    likeness(signs, changed, settings.least), likeness(signs, other, settings.least), length_class(len(signs), settings.least))

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for i, t, guest in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                    if done:
                        break
                    signs = signatures(t, settings.chain)
                    if before is not None:
                        out.append(result(before, (t, signs)))
                    before, done = (i, t, signs), guest
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], type=kinds[k]) for k in range(len(kinds))], names=columns)

    return in_order(docs, text).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, length_class int")
