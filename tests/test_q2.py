import pytest

from conftest import post
from postscope.operators.extract import emoji_tokens
from postscope.plans.questions import top_emojis

FAMILY = "\U0001F468\u200d\U0001F469\u200d\U0001F467\u200d\U0001F466"
TONE = "\U0001F64F\U0001F3FB"
PLANE = "\u2708\ufe0f"
HEARTS = "\u2764\ufe0f\u2764\ufe0f"
FLAG = "\U0001F1EE\U0001F1F3"
LONE_RI = "\U0001F1EE"
NEW = "\U0001FAE0"
INDIC = "\u0915\u094d\u200d\u0937"


def toks(posts_df, text, definition):
    return [r.emoji for r in emoji_tokens(posts_df([post(content=text)]), definition).collect()]


CASES = [
    # text, property, range, simple, run, grapheme (token counts)
    (FAMILY, 4, 1, 4, 1, 1),
    (TONE, 1, 2, 2, 1, 1),
    (HEARTS, 2, 1, 2, 2, 2),
    (FLAG, 1, 1, 0, 0, 1),
    (LONE_RI + " x", 1, 0, 0, 0, 0),
    (NEW, 1, 0, 0, 1, 1),
    (INDIC, 0, 0, 0, 0, 0),
    ("\u00a9 5 #", 1, 0, 0, 0, 1),
    ("plain words", 0, 0, 0, 0, 0),
]


@pytest.mark.parametrize("text,prop,rng,simple,run,graph", CASES)
def test_definitions(posts_df, text, prop, rng, simple, run, graph):
    got = {d: len(toks(posts_df, text, d)) for d in ("property", "range", "simple", "run", "grapheme")}
    assert got == {"property": prop, "range": rng, "simple": simple, "run": run, "grapheme": graph}


def test_variation_selector(posts_df):
    assert toks(posts_df, PLANE, "property") == ["\u2708"]
    assert toks(posts_df, PLANE, "range") == ["\u2708"]
    assert toks(posts_df, PLANE, "grapheme") == [PLANE]


def test_family_whole_in_range(posts_df):
    assert toks(posts_df, FAMILY, "range") == [FAMILY]


def test_happy_path(posts_df):
    df = posts_df([post(content="fly \u2708\ufe0f love \u2764\ufe0f"), post(content="\u2764\ufe0f")])
    r = [(x.emoji, x.n) for x in top_emojis(df, 10, "property").collect()]
    assert r == [("\u2764", 2), ("\u2708", 1)]


def test_tie_smaller_key_first(posts_df):
    df = posts_df([post(content="\U0001F600 \u2708")])
    r = [(x.emoji, x.n) for x in top_emojis(df, 10, "range").collect()]
    assert r == [("\u2708", 1), ("\U0001F600", 1)]


def test_empty_and_null_content(posts_df):
    assert top_emojis(posts_df([]), 10).collect() == []
    assert top_emojis(posts_df([post(date="2021-01-01")]), 10).collect() == []


def test_grapheme_takes_emoji_only(posts_df):
    assert toks(posts_df, "\u2605 \u2710 a\u20e3 \U0001F1EE", "grapheme") == []
    england = "\U0001F3F4\U000E0067\U000E0062\U000E0065\U000E006E\U000E0067\U000E007F"
    assert toks(posts_df, f"{england}7\ufe0f\u20e3", "grapheme") == [england, "7\ufe0f\u20e3"]


def test_emoji_ranges_are_the_unicode_property():
    import regex

    from postscope.functions import emoji as E

    listed = set()
    for item in E.EMOJI_RANGES.split():
        low, _, high = item.partition("-")
        listed |= set(range(int(low, 16), int(high or low, 16) + 1))
    apart = {*map(ord, "0123456789#*"), *range(0x1F1E6, 0x1F200)}
    emoji = regex.compile(r"\p{Emoji}")
    known = {i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and emoji.match(chr(i))} - apart
    assert listed <= known and len(known - listed) <= 20  # a later Unicode version may know some more
