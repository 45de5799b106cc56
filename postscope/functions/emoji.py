"""Emoji definitions as regular expressions.

Every pattern uses ``\\x{...}`` escapes, which Java (Spark) and RE2 (DuckDB)
read the same way. JDK 17 has no emoji properties, so the property-based
definition uses explicit codepoint ranges.

Definitions (all must be applied to the whole text):

* ``property``: a pair of regional indicators; else one Emoji_Presentation or
  Extended_Pictographic character followed by any number of (skin tone, or
  FE0F ZWJ pictograph).
* ``range``: a pair of regional indicators; else a character in
  1F300-1F9FF / 2600-27BF, then any number of (one or more of FE0F, ZWJ,
  skin tone, followed by another such character).
* ``simple``: one codepoint in 2600-27BF, 1F300-1F6FF or 1F900-1F9FF.
* ``run``: a maximal run of skin tones, 2600-27BF, 1F300-1FAFF and ZWJ;
  tokens made only of ZWJ (Indic joiners) are dropped.
* ``grapheme``: whole emoji sequences: a flag (pair of regional indicators), a
  keycap (digit, ``#`` or ``*`` with U+20E3), or emoji characters, each with
  its variation selector, skin tone or tag sequence, joined by ZWJ. Characters
  without the Unicode property Emoji (a black star, a lone regional indicator,
  a letter with U+20E3) are no tokens; U+00A9 and similar unqualified emoji
  are.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values. Union of Unicode Emoji_Presentation and Extended_Pictographic
# (Unicode 14.0), as hexadecimal codepoints and inclusive ranges.
EMOJI_PICTOGRAPHIC_RANGES = """
A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 2388 23CF 23E9-23F3
23F8-23FA 24C2 25AA-25AB 25B6 25C0 25FB-25FE 2600-2605 2607-2612 2614-2685
2690-2705 2708-2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E
2753-2755 2757 2763-2767 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C
2B50 2B55 3030 303D 3297 3299 1F000-1F0FF 1F10D-1F10F 1F12F 1F16C-1F171
1F17E-1F17F 1F18E 1F191-1F19A 1F1AD-1F1FF 1F201-1F20F 1F21A 1F22F 1F232-1F23A
1F23C-1F23F 1F249-1F53D 1F546-1F64F 1F680-1F6FF 1F774-1F77F 1F7D5-1F7FF
1F80C-1F80F 1F848-1F84F 1F85A-1F85F 1F888-1F88F 1F8AE-1F8FF 1F90C-1F93A
1F93C-1F945 1F947-1FAFF 1FC00-1FFFD
"""
# Unicode property Emoji, without digits, ``#``, ``*`` and regional indicators.
EMOJI_RANGES = """
A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3
23F8-23FA 24C2 25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618
261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 2648-2653 265F-2660
2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7
26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA
26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716 271D 2721 2728
2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF
2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF
1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A
1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0
1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570
1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2
1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3
1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2 1F6D5-1F6D7 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC
1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 1F947-1F9FF
1FA70-1FA7C 1FA80-1FA89 1FA8F-1FAC6 1FACE-1FADC 1FADF-1FAE9 1FAF0-1FAF8
"""
TAGS, TAG_END = "E0020-E007E", "E007F"
REGIONAL_INDICATORS = "1F1E6-1F1FF"
SKIN_TONES = "1F3FB-1F3FF"
VARIATION_SELECTOR_16 = "FE0F"
ZERO_WIDTH_JOINER = "200D"
KEYCAP = "20E3"
RANGE_BASE = "1F300-1F9FF 2600-26FF 2700-27BF"
SIMPLE_BASE = "2600-27BF 1F300-1F6FF 1F900-1F9FF"
RUN_MEMBERS = "1F3FB-1F3FF 2600-27BF 1F300-1FAFF 200D"
# ---------------------------------------------------------------------------


def char_class(spec: str, negate: bool = False) -> str:
    """``"2600-27BF 1F300"`` -> ``[\\x{2600}-\\x{27BF}\\x{1F300}]``."""
    parts = []
    for item in spec.split():
        lo, _, hi = item.partition("-")
        parts.append(f"\\x{{{lo}}}" + (f"-\\x{{{hi}}}" if hi else ""))
    return "[" + ("^" if negate else "") + "".join(parts) + "]"


PICTO = char_class(EMOJI_PICTOGRAPHIC_RANGES)
RI = char_class(REGIONAL_INDICATORS)
TONE = char_class(SKIN_TONES)
VS16 = f"\\x{{{VARIATION_SELECTOR_16}}}"
ZWJ = f"\\x{{{ZERO_WIDTH_JOINER}}}"

PROPERTY = f"(?:{RI}{{2}}|{PICTO}(?:{TONE}|{VS16}{ZWJ}{PICTO})*)"
_RANGE_BASE = char_class(RANGE_BASE)
RANGE = (
    f"(?:{RI}{{2}}|{_RANGE_BASE}"
    f"(?:{char_class(VARIATION_SELECTOR_16 + ' ' + ZERO_WIDTH_JOINER + ' ' + SKIN_TONES)}+{_RANGE_BASE})*)"
)
SIMPLE = char_class(SIMPLE_BASE)
RUN = char_class(RUN_MEMBERS) + "+"
_PART = f"{char_class(EMOJI_RANGES)}(?:{VS16}|{TONE})?(?:{char_class(TAGS)}+\\x{{{TAG_END}}})?"
GRAPHEME = f"(?:{RI}{{2}}|[0-9#*]{VS16}?\\x{{{KEYCAP}}}|{_PART}(?:{ZWJ}{_PART})*)"
ONLY_ZWJ = f"^{ZWJ}+$"

DEFINITIONS = {
    "property": PROPERTY,
    "range": RANGE,
    "simple": SIMPLE,
    "run": RUN,
    "grapheme": GRAPHEME,
}


def pattern(definition: str) -> str:
    """The definition as a portable pattern (Java and RE2)."""
    try:
        return DEFINITIONS[definition]
    except KeyError:
        raise ValueError(f"unknown emoji definition {definition!r}; one of {sorted(DEFINITIONS)}") from None


# Every token of every definition holds a non-ASCII codepoint, so a text
# without one has no token.
HAS_NON_ASCII = "[^\\x{00}-\\x{7F}]"
# Guards that let the Java engine reject most start positions with one range
# test instead of walking the whole class. They never change what matches:
# a property token starts at U+00A9 or above; an emoji sequence starts with a
# non-ASCII codepoint, or is an ASCII base followed by one (keycaps).
_GUARDS = {
    "property": "(?=[^\\x{00}-\\x{A8}])",
    "grapheme": "(?=[^\\x{00}-\\x{7F}]|[\\x{00}-\\x{7F}][^\\x{00}-\\x{7F}])",
}


def spark_pattern(definition: str) -> str:
    """``pattern`` with a lookahead guard for Java (RE2 has no lookahead)."""
    return _GUARDS.get(definition, "") + pattern(definition)
