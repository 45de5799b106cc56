"""Personal data and the terms that give it away (DataFrame functions only).

Base spans are found by fixed patterns (e-mail, IP, payment card with a valid
Luhn sum, phone). Every distinct value found is a protected entity. Over the
whole corpus the operator estimates how strongly a term reveals an entity: with
``n(.)`` numbers of rows out of ``N``,

    PMI(t, e) = log2(n(t, e) * N / (n(t) * n(e))),   IC(e) = log2(N / n(e)),

where ``n(t, e)`` counts rows with both, wherever they stand; words of e-mail
addresses are no terms. A term whose PMI reaches ``threshold`` times the
information content of the entity discloses it, if the estimate rests on rows
with at least ``support`` different contexts of the entity (``Settings.window``
characters to either side; copies of one passage are one context). All its
occurrences in all texts become ``term`` spans, with the entity beside it or
not; ``sanitise`` replaces base spans by their kind, generalises disclosing
terms to ``[TERM]`` and removes those that occur in no row without the entity.

Null text reads as empty. Spans are code points, end exclusive. Rows are
addressed by a hash of (doc_id, text): null ids are fine, rows that repeat both
are alike and count once in the estimates. Entities without a term that
reaches the threshold add nothing. Other columns are ignored by ``find``,
whatever their names, and kept by ``sanitise`` (``__rid`` and ``__found`` are
reserved there).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postscope.llm.common import Scratch

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
SPAN = "array<struct<start:bigint,end:bigint,value:string>>"

# The base patterns. A separator inside a run is first replaced
# by U+0001 (same length), so that runs match without nested repeats;
# U+0001 in the text itself reads as U+0002, which no pattern knows either.
# A match that begins with a run begins where the run does (or where the last
# match ended), and gives nothing of it back: long runs are read once.
JOINT = "\x01"
DOT = r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])"
LOCAL = f"[A-Za-z0-9._%+{JOINT}-]"
EMAIL = f"(?:(?<!{LOCAL})|\\G){LOCAL}++@[A-Za-z0-9-]++{JOINT}[A-Za-z0-9{JOINT}-]*+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
GAP = r"(?<=[0-9])[\x20-](?=[0-9])"
CARD = f"[0-9{JOINT}]{{13,}}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"


@dataclass(frozen=True)
class Settings:
    window: int = 100  #: characters of context to either side
    letters: int = 4  #: shortest term
    support: int = 3  #: least number of different contexts
    threshold: float = 0.9  #: part of an entity's information content


def located(text: Column, pattern: str | Column) -> Column:
    """(start, end, value) of the leftmost non-overlapping matches. Positions add
    up within blocks of about the square root of the number of matches, and over
    the blocks, as an array that grows is copied at every step."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found,
                        lambda gap, value: F.struct(F.length(gap).cast("long").alias("gap"), value.alias("value")))
    step = "struct<at:bigint,out:" + SPAN + ">"
    zero = F.lit(0).cast("long")

    def block(rows: Column, at: Column) -> Column:
        return F.aggregate(
            rows, F.struct(at.alias("at"), F.array().cast(SPAN).alias("out")).cast(step),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + F.length(x["value"])).cast("long").alias("at"),
                F.concat(acc["out"], F.array(F.struct(
                    (acc["at"] + x["gap"]).cast("long").alias("start"),
                    (acc["at"] + x["gap"] + F.length(x["value"])).cast("long").alias("end"),
                    x["value"].alias("value"))).cast(SPAN)).alias("out")).cast(step),
            lambda acc: acc["out"])

    def in_blocks(rows: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(rows))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / size).cast("int")), lambda b: F.slice(rows, b * size + 1, size))
        lengths = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda n, x: (n + x["gap"] + F.length(x["value"])).cast("long")))
        starts = F.aggregate(lengths, F.array(zero), lambda out, n: F.concat(out, F.array((F.element_at(out, -1) + n).cast("long"))))
        return F.flatten(F.zip_with(blocks, F.slice(starts, F.lit(1), F.size(lengths)), block))

    # the one element of an array: the matches are found once
    return F.transform(F.array(pieces), lambda rows: F.when(F.size(rows) <= 64, block(rows, zero)).otherwise(in_blocks(rows)))[0]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True where the digits' Luhn sum is divisible by ten."""
    n = F.length(number)

    def weigh(total, i):
        d = F.substring(number, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), weigh) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Kind -> array of (start, end, value) of valid matches; ``text`` not null."""
    none = F.array().cast(SPAN)
    clean = F.translate(text, JOINT, "\x02")
    email = located(F.regexp_replace(clean, DOT, JOINT), EMAIL)
    ip = F.filter(located(text, IP), lambda s: s["value"].rlike(f"^{BYTE}(\\.{BYTE}){{3}}$"))
    card = F.filter(located(F.regexp_replace(clean, GAP, JOINT), CARD),
                    lambda s: F.length(digits(s["value"])).between(13, 19) & luhn(digits(s["value"])))
    phone = F.filter(located(text, PHONE), lambda s: F.length(digits(s["value"])).between(9, 15))
    some = text.rlike("[0-9]")
    return {
        "email": F.when(text.contains("@"), email).otherwise(none),
        "ip": F.when(some & text.rlike(r"[0-9]\.[0-9]"), ip).otherwise(none),
        "card": F.when(some, card).otherwise(none),
        "phone": F.when(text.contains("+"), phone).otherwise(none),
    }


def marked(docs: DataFrame, settings: Settings, text: str) -> DataFrame:
    """rid, doc_id, ``base``: kind (place in KINDS), start, end, value and the
    text before and after, and ``words``: the distinct words outside e-mail
    addresses, of every row."""
    w = settings.window
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), t).alias("rid"), t.alias("t"))
    rows = rows.withColumns({f"s_{k}": v for k, v in base_spans(F.col("t")).items()})

    def context(k: int):
        def one(s):
            # one character more, so that a word cut by the window's edge shows;
            # a space stands for it at the text's edges
            before = F.when(s["start"] > w, F.substring("t", (s["start"] - w).cast("int"), F.lit(w + 1))).otherwise(
                F.concat(F.lit(" "), F.substring("t", F.lit(1), s["start"].cast("int"))))
            after = F.concat(F.substring("t", (s["end"] + 1).cast("int"), F.lit(w + 1)), F.when(F.length("t") - s["end"] <= w, " ").otherwise(""))
            value = F.substring("t", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
            return F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lower(value).alias("value"),
                            before.alias("before"), after.alias("after"))
        return one

    base = F.concat(*(F.transform(f"s_{k}", context(i)) for i, k in enumerate(KINDS)))
    bare = F.regexp_replace(F.regexp_replace(F.translate("t", JOINT, "\x02"), DOT, JOINT), EMAIL, " ")
    bare = F.when(F.col("t").contains("@"), bare).otherwise(F.col("t"))
    words = F.array_distinct(F.regexp_extract_all(bare, F.lit(f"\\p{{L}}{{{settings.letters},}}"), F.lit(0)))
    return rows.select("rid", "doc_id", base.alias("base"), words.alias("words"))


def mentions(rows: DataFrame) -> DataFrame:
    """rid, entity and ctx, a hash of the entity's contexts there, once each."""
    found = rows.where(F.size("base") > 0).select("rid", F.explode("base").alias("b")).select(
        "rid", F.concat_ws(":", "b.kind", "b.value").alias("entity"), F.xxhash64("b.before", "b.after").alias("ctx")).distinct()
    return found.groupBy("rid", "entity").agg(F.bit_xor("ctx").alias("ctx"))


def disclosing(rows: DataFrame, found: DataFrame, entities: DataFrame, settings: Settings) -> DataFrame:
    """entity, term, share (PMI / IC) of the disclosing pairs. ``entities``:
    entity, n_entity (rows) and contexts."""
    n_rows = rows.count()
    folded = F.explode(F.array_distinct(F.transform("words", F.lower))).alias("term")
    # of fewer contexts no pair can have enough
    asked = found.join(entities.where(F.col("contexts") >= settings.support).select("entity"), "entity")
    words = rows.where(F.size("base") > 0).select("rid", "words").dropDuplicates(["rid"])
    pairs = (asked.join(words, "rid").select("entity", "ctx", folded)
             .groupBy("entity", "term", "ctx").agg(F.count("*").alias("n"))
             .groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("support"))
             .where(F.col("support") >= settings.support))
    counted = rows.select(folded).groupBy("term").agg(F.count("*").alias("n_term"))
    pmi = F.log2(F.col("n_both") * F.lit(float(n_rows)) / (F.col("n_term") * F.col("n_entity")))
    information = F.log2(F.lit(float(n_rows)) / F.col("n_entity"))
    return pairs.join(entities, "entity").join(counted, "term").where(information > 0).select(
        "entity", "term", (pmi / information).alias("share"), (F.col("n_term") <= F.col("n_both")).alias("only")).where(
        F.col("share") >= settings.threshold)


def occurrences(docs: DataFrame, rows: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """rid and ``added``: start, end, only of every occurrence of the terms in
    all texts. ``terms``: term, only."""
    t = F.coalesce(F.col(text), F.lit(""))
    # words as written: they are runs of letters, so they stand for themselves in a pattern
    hits = (rows.select("rid", F.explode("words").alias("word")).withColumn("term", F.lower("word")).join(terms, "term")
            .select("rid", "word", "only").distinct().groupBy("rid").agg(F.collect_list(F.struct("word", "only")).alias("hits")))
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(F.col("hits.word"), "|"), F.lit(r")(?!\p{L})"))
    texts = docs.select(F.xxhash64(F.col("doc_id").cast("string"), t).alias("rid"), t.alias("t")).where("t <> ''")
    return (texts.join(hits, "rid").dropDuplicates(["rid"]).withColumn("only", F.map_from_entries("hits"))
            .select("rid", F.transform(located(F.col("t"), pattern), lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.col("only")[s["value"]].alias("only"))).alias("added")))


def find(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """rid, doc_id and ``found`` of every row: (kind, start, end, only) by kind
    as listed with ``term`` last, then start."""
    scratch = Scratch(docs.sparkSession, "pii-disclosure")
    rows = scratch.write(marked(docs, settings, text))
    found = scratch.write(mentions(rows))
    entities = scratch.write(found.groupBy("entity", "ctx").agg(F.count("*").alias("n"))
                             .groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count("*").alias("contexts")))
    pairs = scratch.write(disclosing(rows, found, entities, settings))
    terms = scratch.write(pairs.groupBy("term").agg(F.max("only").alias("only")))
    added = occurrences(docs, rows, terms, text)
    added = scratch.write(added)
    scratch.keep(rows, added)
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(False).alias("only")))
    more = F.transform("added", lambda s: F.struct(F.lit(len(KINDS)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["only"].alias("only")))
    # a term inside a base span adds nothing
    free = F.filter(more, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"])))
    spans = F.array_sort(F.concat(base, F.coalesce(free, F.array().cast("array<struct<kind:int,start:bigint,end:bigint,only:boolean>>"))))
    names = F.array(*map(F.lit, (*KINDS, TERM)))
    return rows.join(added, "rid", "left").select("rid", "doc_id", F.transform(spans, lambda s: F.struct(
        F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["only"].alias("only"))).alias("found"))


def sanitise(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """Every column of ``docs``, with the text sanitised: of spans that overlap
    the first in order of start (then the longest) is replaced."""
    found = find(docs, settings, text).select(F.col("rid").alias("__rid"), F.col("found").alias("__found")).dropDuplicates(["__rid"])
    t = F.coalesce(F.col(text), F.lit(""))
    order = F.array_sort(F.transform("__found", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind"), s["only"].alias("only"))))
    state = "struct<at:bigint,out:string>"

    def step(acc, s):
        mark = F.when((s["kind"] == TERM) & s["only"], "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        grown = F.struct((-s["end"]).cast("long").alias("at"), F.concat(
            acc["out"], F.substring(t, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), mark).alias("out")).cast(state)
        return F.when(s["start"] >= acc["at"], grown).otherwise(acc)

    done = F.aggregate(order, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")).cast(state), step,
                       lambda acc: F.concat(acc["out"], F.substring(t, (acc["at"] + 1).cast("int"), F.length(t))))
    keyed = docs.withColumn("__rid", F.xxhash64(F.col("doc_id").cast("string"), t))
    clean = F.when(F.size("__found") > 0, done).otherwise(F.col(text))
    return keyed.join(found, "__rid", "left").withColumn(text, clean).select(*docs.columns)
