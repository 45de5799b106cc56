"""Data-quality profiles of post data.

Each profile is one or two aggregates over the whole input. Multi-part
answers combine a k-row top list with global figures through scalar
subqueries (``DataFrame.scalar()``), never a global window or a join of all
rows. Shares are rounded to 6 digits so they compare across engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postscope.functions.days import parse_ts, utc_day
from postscope.functions.handles import is_present, normalize_handle
from postscope.functions.text import (
    any_null_in_list, ends_with_ellipsis, is_complex_token, is_retweet_text, mentions_in_text,
    meta_mention_set,
)
from postscope.operators.aggregate import count_by, quantile, ratio, ties_at_cutoff, top_k
from postscope.operators.extract import emoji_tokens


def _n() -> Column:
    return F.count(F.lit(1))


def has_key(path: str, v: str = "v") -> Column:
    """The record has a (non-null) value at ``path``."""
    return F.try_variant_get(F.col(v), path, "variant").isNotNull() & ~F.is_variant_null(
        F.try_variant_get(F.col(v), path, "variant")
    )


def _with_content(records: DataFrame) -> DataFrame:
    """The records with their text as ``content``: the column, or else the text
    value of that key in ``v`` (records read with ``scan_records``)."""
    if "content" in records.columns:
        return records
    value = F.try_variant_get("v", "$.content", "variant")
    return records.withColumn("content", F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get("v", "$.content", "string")))


def truncation_profile(records: DataFrame) -> DataFrame:
    """D1 over (content, v) or (v): truncated flag, extended text present,
    ellipsis endings."""
    records = _with_content(records)
    truncated = F.coalesce(F.try_variant_get("v", "$.truncated", "boolean"), F.lit(False))
    return records.agg(
        _n().alias("n_posts"),
        F.count_if(truncated).alias("n_truncated"),
        ratio(F.count_if(truncated), _n()).alias("truncated_share"),
        F.count_if(has_key("$.extended_tweet")).alias("n_extended"),
        F.count_if(ends_with_ellipsis("content")).alias("n_ellipsis"),
        ratio(F.count_if(ends_with_ellipsis("content")), _n()).alias("ellipsis_share"),
    )


def retweet_profile(records: DataFrame) -> DataFrame:
    """D2 over (content, v) or (v): retweets by metadata and by text."""
    records = _with_content(records)
    meta, text = has_key("$.retweeted_status"), is_retweet_text("content")
    return records.agg(
        _n().alias("n_posts"),
        F.count_if(meta).alias("n_retweet_meta"),
        ratio(F.count_if(meta), _n()).alias("retweet_meta_share"),
        F.count_if(text).alias("n_retweet_text"),
        ratio(F.count_if(text), _n()).alias("retweet_text_share"),
    )


def mention_discrepancy(posts: DataFrame) -> DataFrame:
    """D3: names only in the metadata (hidden) or only in the text (fake);
    case-sensitive; the smallest post id of each kind as example."""
    p = posts.select(
        "id", "content",
        mentions_in_text("content").alias("text_names"),
        meta_mention_set("mentionedUsers").alias("meta_names"),
    )
    hidden = F.size(F.array_except("meta_names", "text_names")) > 0
    fake = F.size(F.array_except("text_names", "meta_names")) > 0
    snippet = F.substring("content", 1, 50)
    return p.agg(
        _n().alias("n_posts"),
        F.count_if(hidden).alias("n_hidden"),
        F.count_if(fake).alias("n_fake"),
        F.min(F.when(hidden, F.col("id"))).alias("hidden_example_id"),
        F.min_by(snippet, F.when(hidden, F.col("id"))).alias("hidden_example"),
        F.min(F.when(fake, F.col("id"))).alias("fake_example_id"),
        F.min_by(snippet, F.when(fake, F.col("id"))).alias("fake_example"),
    )


def posts_per_user(posts: DataFrame, normalize: bool = True) -> DataFrame:
    """Posts per (normalised) author; empty and null names dropped. Names
    are counted as written first, so the Python normaliser sees each distinct
    name once, not every post."""
    raw = count_by(posts.select(F.col("user.username").alias("username")).where(is_present("username")), "username")
    if not normalize:
        return raw
    return raw.select(normalize_handle("username").alias("username"), "n").groupBy("username").agg(F.sum("n").alias("n"))


def handle_collisions(posts: DataFrame) -> DataFrame:
    """Distinct raw names, distinct NFKC+lower names, and the difference."""
    p = posts.select(F.col("user.username").alias("raw")).where(is_present("raw")).distinct()
    p = p.select(normalize_handle(F.col("raw")).alias("norm"))
    return p.groupBy("norm").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_raw"),
        F.count(F.lit(1)).alias("n_normalized"),
    ).withColumn("n_collisions", F.col("n_raw") - F.col("n_normalized"))


def activity_outliers(posts: DataFrame, n: int = 5, q: float = 0.99, factor: float = 10.0) -> DataFrame:
    """The n most active authors with the p99 and maximum of posts per
    author, and an alert when the maximum exceeds ``factor`` x p99."""
    counts = posts_per_user(posts)
    stats = counts.agg(quantile(counts, q).alias("p"), F.max("n").alias("m"))
    p99 = stats.select(F.round("p", 6)).scalar()
    mx = stats.select("m").scalar()
    return top_k(counts, n, "n", ["username"]).select(
        "username", "n",
        p99.alias("p99"),
        mx.alias("max_n"),
        (mx > F.lit(factor) * p99).alias("alert"),
    )


def cutoff_ties(posts: DataFrame, k: int = 10) -> DataFrame:
    """D6/K5/W2 over posts per author."""
    return ties_at_cutoff(posts_per_user(posts), k, "n", "username")


def corrupt_lines(parsed: DataFrame) -> DataFrame:
    """D7 over strictly parsed lines: how many lines were rejected."""
    bad = F.col("reject_reason").isNotNull()
    return parsed.agg(
        _n().alias("n_lines"),
        F.count_if(bad).alias("n_corrupt"),
        ratio(F.count_if(bad), _n()).alias("corrupt_share"),
    )


# Key columns profiled by D8 and the type vocabulary.
KEY_COLUMNS = ["date", "content", "mentionedUsers", "user.username", "user.id"]


def json_type_name(kind: Column) -> Column:
    """type name for the head of a VARIANT's schema (the part before ``<``):
    string, integer, number, boolean, object, array, null; ``missing`` for null."""
    return (
        F.when(kind.isNull(), F.lit("missing"))
        .when(kind == "VOID", F.lit("null"))
        .when(kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("integer"))
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), F.lit("number"))
        .otherwise(F.lower(kind))
    )


def kind_of(v: Column) -> Column:
    """The head of a VARIANT's schema: ``OBJECT``, ``ARRAY``, ``STRING``, ``VOID``, ..."""
    return F.substring_index(F.schema_of_variant(v), "<", 1)


def json_type_of(v: Column) -> Column:
    """type name of a VARIANT value."""
    return json_type_name(kind_of(v))


def key_column_profile(records: DataFrame, columns=KEY_COLUMNS) -> DataFrame:
    """Per key column and value type, the number of records. Each value's
    schema is taken once; the names are given to the groups."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), kind_of(F.try_variant_get("v", f"$.{c}", "variant")).alias("kind")) for c in columns])
    kinds = count_by(records.select(F.inline(cells)), "column", "kind")
    return kinds.groupBy("column", json_type_name(F.col("kind")).alias("type")).agg(F.sum("n").alias("n"))


def identity_consistency(posts: DataFrame) -> DataFrame:
    """Names used by several ids, ids with several names, and
    rows per distinct name (rows include posts without a name)."""
    u = posts.select(F.col("user.id").alias("uid"), F.col("user.username").alias("name"))
    pairs = count_by(u, "uid", "name")
    # count(column) skips the null side of a pair; all figures come from the pairs
    by_name = pairs.groupBy("name").agg(F.sum("n").alias("rows"), F.count("uid").alias("ids"))
    by_id = pairs.where(F.col("uid").isNotNull()).groupBy("uid").agg(F.count("name").alias("names"))
    ids_many = by_id.agg(F.count_if(F.col("names") > 1)).scalar()
    names = by_name.agg(
        F.count_if(F.col("name").isNotNull() & (F.col("ids") > 1)).alias("names_with_many_ids"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"),
        F.count("name").alias("n_distinct_names"),
    )
    return names.select(
        "names_with_many_ids", ids_many.alias("ids_with_many_names"), "n_rows", "n_distinct_names",
        ratio(F.col("n_rows"), F.col("n_distinct_names")).alias("rows_per_name"),
    )


def mention_structure(posts: DataFrame) -> DataFrame:
    """Posts with a mention list, lists holding a null name."""
    return posts.agg(
        _n().alias("n_posts"),
        F.count_if(F.col("mentionedUsers").isNotNull()).alias("n_with_list"),
        F.count_if(F.coalesce(any_null_in_list("mentionedUsers"), F.lit(False))).alias("n_with_null_name"),
    )


def emoji_complexity(posts: DataFrame, definition: str = "grapheme", top: int = 3) -> DataFrame:
    """Total tokens, complex tokens (several codepoints or a ZWJ) and the
    ``top`` complex tokens by count."""
    toks = emoji_tokens(posts, definition).select("emoji", is_complex_token(F.col("emoji")).alias("complex"))
    counts = toks.groupBy("emoji", "complex").agg(_n().alias("n"))
    totals = counts.agg(F.sum("n").alias("t"), F.sum(F.when(F.col("complex"), F.col("n"))).alias("c"))
    return top_k(counts.where("complex").select("emoji", "n"), top, "n", ["emoji"]).select(
        "emoji", "n",
        totals.select(F.col("t").cast("long")).scalar().alias("total_tokens"),
        totals.select(F.col("c").cast("long")).scalar().alias("complex_tokens"),
    )


def time_range(posts: DataFrame, year: int = 2021) -> DataFrame:
    """First and last UTC day, posts outside ``year`` (an
    unparsable date counts as outside)."""
    return posts.select(utc_day(parse_ts("date")).alias("d")).agg(
        F.min("d").alias("first_day"),
        F.max("d").alias("last_day"),
        F.count_if(F.coalesce(F.year("d") != year, F.lit(True))).alias("n_outside_year"),
    )


def integrity_exprs() -> dict[str, Column]:
    """D13 counters, usable in ``agg`` or ``observe``."""
    name = F.col("user.username")
    return {
        "n_posts": _n(),
        "null_ids": F.count_if(F.col("id").isNull()),
        "null_users": F.count_if(F.col("user").isNull()),
        "null_usernames": F.count_if(F.col("user").isNotNull() & name.isNull()),
        "empty_usernames": F.count_if(name == F.lit("")),
        "null_dates": F.count_if(F.col("date").isNull()),
        "bad_dates": F.count_if(F.col("date").isNotNull() & parse_ts("date").isNull()),
        "null_content": F.count_if(F.col("content").isNull()),
    }


def integrity_counters(posts: DataFrame) -> DataFrame:
    """D13 as a one-row DataFrame."""
    return posts.agg(*[c.alias(k) for k, c in integrity_exprs().items()])


def observe_integrity(posts: DataFrame, name: str = "integrity") -> tuple[DataFrame, Observation]:
    """D13 attached to a running query: the counters are filled by the same
    job that computes the answer (no extra pass). Read ``obs.get`` after an
    action on the returned DataFrame."""
    obs = Observation(name)
    exprs = integrity_exprs()
    first, *rest = [c.alias(k) for k, c in exprs.items()]
    return posts.observe(obs, first, *rest), obs


def schema_drift(records: DataFrame, expected=None) -> DataFrame:
    """Per top-level field, the merged observed type of all records
    (``schema_of_variant_agg``) next to the expected one, with a status:
    ``ok`` (same kind), ``mixed`` (records disagree: the merge is VARIANT),
    ``different`` (one other kind) or ``absent`` (no record has a value)."""
    from postscope.schema import POST

    def kind(dtype) -> str:
        name = dtype.simpleString()
        if name.startswith("struct"):
            return "OBJECT"
        if name.startswith("array"):
            return "ARRAY"
        return {"bigint": "BIGINT", "int": "BIGINT", "string": "STRING", "double": "DOUBLE",
                "boolean": "BOOLEAN"}.get(name, name.upper())

    expected = expected or {f.name: f.dataType for f in POST.fields}
    obs = records.agg(
        *[F.schema_of_variant_agg(F.try_variant_get("v", f"$.{k}", "variant")).alias(k) for k in expected]
    )
    rows = F.array(*[
        F.struct(F.lit(k).alias("field"), F.lit(t.simpleString()).alias("expected"),
                 F.lit(kind(t)).alias("_kind"), F.col(k).alias("observed"))
        for k, t in expected.items()
    ])
    o = F.col("observed")
    observed_kind = (
        F.when(o.startswith("OBJECT"), F.lit("OBJECT"))
        .when(o.startswith("ARRAY"), F.lit("ARRAY"))
        .when(o.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("BIGINT"))
        .otherwise(o)
    )
    status = (
        F.when(o.isNull() | (o == "VOID"), F.lit("absent"))
        .when(o == "VARIANT", F.lit("mixed"))
        .when(observed_kind == F.col("_kind"), F.lit("ok"))
        .otherwise(F.lit("different"))
    )
    return obs.select(F.inline(rows)).select("field", "expected", "observed", status.alias("status"))


def _paths_of(dtype, path: str = "$") -> dict[str, str]:
    """Path -> kind of a schema and everything within it, in the words of a
    VARIANT's schema; array elements are at ``path[]``."""
    name = dtype.simpleString()
    if isinstance(dtype, T.StructType):
        out = {path: "OBJECT"}
        for f in dtype.fields:
            out |= _paths_of(f.dataType, f"{path}.{f.name}")
        return out
    if isinstance(dtype, T.ArrayType):
        return {path: "ARRAY"} | _paths_of(dtype.elementType, f"{path}[]")
    return {path: {"int": "BIGINT"}.get(name, name.upper())}


def schema_paths(text: str) -> list[tuple[str, str]]:
    """(path, kind) of the text of a VARIANT's schema, e.g.
    ``OBJECT<a: BIGINT, b: ARRAY<STRING>>``. Names other than words are quoted
    with backticks there."""
    out, at = [], 0

    def name() -> str:
        nonlocal at
        if text[at] != "`":
            end = text.index(":", at)
            found, at = text[at:end], end
            return found
        end = at + 1
        while text[end] != "`" or text[end + 1 : end + 2] == "`":
            end += 1 + (text[end] == "`")
        found, at = text[at + 1 : end].replace("``", "`"), end + 1
        return found

    def value(path: str) -> None:
        nonlocal at
        end = at
        while end < len(text) and text[end] not in "<>," or text[at:end].count("(") > text[at:end].count(")"):
            end += 1
        kind, at = text[at:end], end
        out.append((path, kind))
        if text[at : at + 1] != "<":
            return
        at += 1
        if kind == "ARRAY":
            value(f"{path}[]")
        while text[at] != ">":
            key = name()
            at += 2  # ": "
            value(f"{path}.{key}")
            if text[at] == ",":
                at += 2  # ", "
        at += 1

    value("$")
    return out


def nested_drift(records: DataFrame, by=(), expected=None) -> DataFrame:
    """D14 at any depth: ``path, expected, kinds, n, status`` of every path of the
    records (``v``) or of the expected schema, per group of ``by``.

    ``kinds`` lists the kinds of values met there (JSON null is none), ``n`` the
    records with such a value. ``status`` is ``ok``, ``different`` (one kind,
    another one), ``mixed`` (several kinds), ``absent`` (expected and never met)
    or ``extra`` (met and not expected). Elements of arrays are at ``path[]``;
    within one record's array several kinds show as ``VARIANT``. Records are
    grouped by their whole schema first, so each shape is taken apart once."""
    from postscope.schema import POST

    by = list(by)
    want = _paths_of(expected or POST)
    shapes = records.select(*by, F.schema_of_variant("v").alias("_shape")).groupBy(*by, "_shape").agg(_n().alias("_n"))
    cells = F.udf(schema_paths, "array<struct<path: string, kind: string>>", useArrow=False)
    met = shapes.select(*by, "_n", F.inline(cells("_shape"))).groupBy(*by, "path", "kind").agg(F.sum("_n").alias("n"))
    integers = F.when(F.col("kind").isin("INT", "SMALLINT", "TINYINT"), F.lit("BIGINT")).otherwise(F.regexp_replace("kind", r"\(.*", ""))
    given = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(None).cast("string").alias("kind"), F.lit(0).cast("long").alias("n")) for p in want])
    every = met.where(F.col("kind") != "VOID").select(*by, "path", integers.alias("kind"), "n").unionByName(
        shapes.select(*by).distinct().select(*by, F.inline(given)) if by else records.sparkSession.range(1).select(F.inline(given)))
    found = every.groupBy(*by, "path").agg(F.array_sort(F.collect_set("kind")).alias("kinds"), F.sum("n").alias("n"))  # a handful of kinds
    names = F.create_map(*[F.lit(x) for kv in want.items() for x in kv])
    right = F.try_element_at(names, F.col("path"))
    one = F.get(F.col("kinds"), 0)
    status = (
        F.when(right.isNull(), F.lit("extra")).when(F.size("kinds") == 0, F.lit("absent")).when(F.size("kinds") > 1, F.lit("mixed"))
        .when(one == right, F.lit("ok")).otherwise(F.lit("different")))
    return found.select(*by, "path", right.alias("expected"), F.array_join("kinds", ",").alias("kinds"), "n", status.alias("status"))


def report(posts: DataFrame, records: DataFrame | None = None, year: int = 2021, k: int = 10,
           sample: int | None = None, seed: int = 42) -> dict[str, DataFrame]:
    """All profiles at once, as lazy DataFrames keyed by name (nothing runs
    until a result is used). ``records`` (``content`` + VARIANT ``v``) adds
    the key-presence profiles; ``sample`` profiles a seeded uniform sample of
    that many posts instead of all of them."""
    from postscope.operators.aggregate import reservoir_sample

    if sample:
        posts = reservoir_sample(posts, sample, seed)
        if records is not None:
            records = reservoir_sample(records, sample, seed)
    out = {
        "mention_discrepancy": mention_discrepancy(posts),
        "handle_collisions": handle_collisions(posts),
        "activity_outliers": activity_outliers(posts),
        "cutoff_ties": cutoff_ties(posts, k),
        "identity_consistency": identity_consistency(posts),
        "mention_structure": mention_structure(posts),
        "emoji_complexity": emoji_complexity(posts),
        "time_range": time_range(posts, year),
        "integrity_counters": integrity_counters(posts),
    }
    if records is not None:
        out.update({
            "truncation_profile": truncation_profile(records),
            "retweet_profile": retweet_profile(records),
            "key_column_profile": key_column_profile(records),
            "schema_drift": schema_drift(records),
        })
    return out
