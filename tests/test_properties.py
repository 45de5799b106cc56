"""Property tests: random posts, answers equal to a brute-force model."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from conftest import post
from postscope.plans.questions import top_days_top_user, top_mentioned

# date text -> UTC day (None: no day)
DATES = {
    "2021-03-01T10:00:00+00:00": dt.date(2021, 3, 1),
    "2021-03-01T23:30:00-05:00": dt.date(2021, 3, 2),
    "2021-03-02T02:00:00+05:30": dt.date(2021, 3, 1),
    "2021-03-02T12:00:00Z": dt.date(2021, 3, 2),
    "2021-03-03T08:00:00+00:00": dt.date(2021, 3, 3),
    "2021-03-04T08:00:00+0100": dt.date(2021, 3, 4),
    "2021-03-05": None,
    "garbage": None,
}
NAMES = ["ann", "bob", "Cy", "dee", None]
MENTIONS = ["Ann", "ann", "BOB", "", None, "z"]

posts_st = st.lists(
    st.tuples(st.sampled_from(sorted(DATES)), st.sampled_from(NAMES),
              st.one_of(st.none(), st.lists(st.sampled_from(MENTIONS), max_size=4))),
    max_size=40,
)


def model_q1(rows, k, strict):
    days, pairs = Counter(), Counter()
    for date, name, _ in rows:
        d = DATES[date]
        if d is None or (strict and name is None):
            continue
        days[d] += 1
        if name is not None:
            pairs[(d, name)] += 1
    top = sorted(days, key=lambda d: (-days[d], -d.toordinal()))[:k]
    out = []
    for d in top:
        named = {n: c for (dd, n), c in pairs.items() if dd == d}
        if named:
            best = min(named, key=lambda n: (-named[n], n))
            out.append((sum(named.values()), d, best))
    return [(d, b) for _, d, b in sorted(out, key=lambda x: (-x[0], -x[1].toordinal()))]


def model_q3(rows, k, strict):
    c = Counter()
    for _, _, ms in rows:
        if ms is None:
            continue
        if strict:
            if any(m is None for m in ms):
                continue
            c.update(m.lower() for m in ms)
        else:
            c.update(m.lower() for m in ms if m)
    return sorted(c.items(), key=lambda x: (-x[1], x[0]))[:k]


def _df(posts_df, rows):
    return posts_df([post(d, n, mentions=m if m is not None else "null") for d, n, m in rows])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(posts_st, st.integers(1, 4), st.booleans())
def test_q1_matches_model(posts_df, rows, k, strict):
    df = _df(posts_df, rows)
    want = model_q1(rows, k, strict)
    for plan in ("one_scan", "two_scan"):
        assert [tuple(r) for r in top_days_top_user(df, k, strict=strict, plan=plan).collect()] == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(posts_st, st.integers(1, 4), st.booleans())
def test_q3_matches_model(posts_df, rows, k, strict):
    got = [(r.username, r.n) for r in top_mentioned(_df(posts_df, rows), k, strict=strict).collect()]
    assert got == model_q3(rows, k, strict)


# Q2 against Python's `regex` engine (same \x{...} syntax, \X supported).
import regex as pyre  # noqa: E402

from postscope.functions import emoji as E  # noqa: E402
from postscope.plans.questions import emoji_counts  # noqa: E402
from postscope.sources.adapters import SNIPPETS  # noqa: E402

PIECES = SNIPPETS + ["a", " ", "#", "5", "\u00e9", "\u0928\u092e\u0938\u094d\u0924\u0947", "\u200d", "\ufe0f"]
texts_st = st.lists(st.lists(st.sampled_from(PIECES), max_size=6).map("".join), max_size=12)


def py(pattern):
    r"""The portable pattern in Python syntax: ``\x{1F600}`` -> ``\U0001F600``."""
    return pyre.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: "\\U%08X" % int(m.group(1), 16), pattern)


def model_emoji(texts, definition):
    c = Counter()
    for t in texts:
        for tok in pyre.findall(py(E.pattern(definition)), t):
            if definition == "run" and pyre.fullmatch(py(E.ZWJ) + "+", tok):
                continue
            c[tok] += 1
    return sorted(c.items())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts_st, st.sampled_from(sorted(E.DEFINITIONS)))
def test_q2_matches_python_regex(posts_df, texts, definition):
    df = posts_df([post(content=t) for t in texts])
    got = sorted((r.emoji, r.n) for r in emoji_counts(df, definition).collect())
    assert got == model_emoji(texts, definition)


# Q4 (authors keyed by id, latest name) against a brute-force model.
from postscope.plans.questions import top_days_top_user_by_id  # noqa: E402

# date text -> (UTC day, instant) ; None when it does not parse
TS = {
    "2021-03-01T10:00:00+00:00": (dt.date(2021, 3, 1), dt.datetime(2021, 3, 1, 10)),
    "2021-03-01T23:30:00-05:00": (dt.date(2021, 3, 2), dt.datetime(2021, 3, 2, 4, 30)),
    "2021-03-02T02:00:00+05:30": (dt.date(2021, 3, 1), dt.datetime(2021, 3, 1, 20, 30)),
    "2021-03-02T12:00:00Z": (dt.date(2021, 3, 2), dt.datetime(2021, 3, 2, 12)),
    "2021-03-03T08:00:00+00:00": (dt.date(2021, 3, 3), dt.datetime(2021, 3, 3, 8)),
    "garbage": None,
}
q4_st = st.lists(
    st.tuples(st.sampled_from(sorted(TS)), st.sampled_from([1, 2, 3, None]),
              st.sampled_from(["ann", "bob", "cy", None])),
    max_size=30,
)


def model_q4(rows, k):
    days, pairs, latest = Counter(), Counter(), {}
    for pid, (date, uid, name) in enumerate(rows):
        t = TS[date]
        if uid is not None and name is not None:
            key = (t[1] if t else dt.datetime.min, pid)
            if uid not in latest or key > latest[uid][0]:
                latest[uid] = (key, name)
        if t is None:
            continue
        days[t[0]] += 1
        if uid is not None:
            pairs[(t[0], uid)] += 1
    top = sorted(days, key=lambda d: (-days[d], -d.toordinal()))[:k]
    out = []
    for d in top:
        named = {u: c for (dd, u), c in pairs.items() if dd == d}
        if named:
            best = min(named, key=lambda u: (-named[u], u))
            out.append((d, best, latest[best][1] if best in latest else None))
    return sorted(out, key=lambda r: r[0], reverse=True)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(q4_st, st.integers(1, 3))
def test_q4_matches_model(posts_df, rows, k):
    df = posts_df([post(d, n, uid=u, pid=i) if u is not None else post(d, pid=i)
                   for i, (d, u, n) in enumerate(rows)])
    got = [tuple(r) for r in top_days_top_user_by_id(df, k).collect()]
    assert got == model_q4(rows, k)


# Profiles against brute-force models.
from postscope.plans import profiles as PR  # noqa: E402

prof_st = st.lists(
    st.tuples(st.sampled_from(sorted(TS)), st.sampled_from([1, 2, 3, None]),
              st.sampled_from(["ann", "bob", "", None]),
              st.one_of(st.none(), st.lists(st.sampled_from(["x", None]), max_size=3))),
    max_size=30,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(prof_st)
def test_profiles_match_model(posts_df, rows):
    df = posts_df([
        (post(d, n, uid=u, mentions=m if m is not None else "null") if u is not None
         else post(d, mentions=m if m is not None else "null"))
        for d, u, n, m in rows
    ])
    # identity consistency
    pairs = {(u, n) for _, u, n, _ in rows if u is not None and n is not None}
    names = {n for _, u, n, _ in rows if u is not None and n is not None}
    r = PR.identity_consistency(df).collect()[0]
    assert r.names_with_many_ids == sum(1 for nm in names if len({u for u, x in pairs if x == nm}) > 1)
    assert r.ids_with_many_names == sum(1 for u in {u for u, _ in pairs} if len({x for v, x in pairs if v == u}) > 1)
    assert r.n_rows == len(rows)
    assert r.n_distinct_names == len({n for _, u, n, _ in rows if u is not None and n is not None})
    # time range (year 2021)
    t = PR.time_range(df, 2021).collect()[0]
    parsed = [TS[d][0] for d, *_ in rows if TS[d] is not None]
    assert (t.first_day, t.last_day) == ((min(parsed), max(parsed)) if parsed else (None, None))
    assert t.n_outside_year == sum(1 for d, *_ in rows if TS[d] is None or TS[d][0].year != 2021)
    # mention structure
    m = PR.mention_structure(df).collect()[0]
    assert m.n_with_list == sum(1 for *_, ms in rows if ms is not None)
    assert m.n_with_null_name == sum(1 for *_, ms in rows if ms is not None and None in ms)
    # integrity counters
    c = PR.integrity_counters(df).collect()[0]
    assert c.null_users == sum(1 for _, u, _, _ in rows if u is None)
    assert c.empty_usernames == sum(1 for _, u, n, _ in rows if u is not None and n == "")
    assert c.bad_dates == sum(1 for d, *_ in rows if TS[d] is None)


# NFKC + lower-case names against unicodedata.
import unicodedata  # noqa: E402

NAME_PARTS = ["ann", "ANN", "\uff21nn", "\ufb01", "fi", "Pe\u00f1a", "Pen\u0303a", "\u00c5", "A\u030a", "x"]
names_st = st.lists(st.one_of(st.none(), st.lists(st.sampled_from(NAME_PARTS), min_size=1, max_size=2).map("".join)),
                    max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(names_st)
def test_normalized_handles_match_unicodedata(posts_df, names):
    df = posts_df([post(username=n) if n is not None else post(date="x") for n in names])
    got = sorted((r.username, r.n) for r in PR.posts_per_user(df).collect())
    want = Counter(unicodedata.normalize("NFKC", n).lower() for n in names if n)
    assert got == sorted(want.items())
    h = PR.handle_collisions(df).collect()[0]
    raw = {n for n in names if n}
    assert (h.n_raw, h.n_normalized) == (len(raw), len({unicodedata.normalize("NFKC", n).lower() for n in raw}))
