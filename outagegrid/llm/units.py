"""Splitting a text into blank-led units that a byte-level tokenizer's pattern never crosses.

A pattern of the family ``contraction | ?letters | ?digits | ?others | blanks`` starts a new match at every single blank
that stands between two other characters. So a text is cut there, and equal units are tokenized once. Where a blank
touches more white space the pattern looks further, and the text stays one unit.
"""

from __future__ import annotations

import re

# White space by the Unicode property, which differs from what str.isspace() takes.
WHITE = "\t-\r " + "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
TOUCHING = re.compile(f" [{WHITE}]|[{WHITE}] ")
OTHERS = [chr(c) for c in (*range(9, 14), *(ord(c) for c in WHITE if c > "~"))]


def _touching(text: str) -> bool:
    """Whether a blank touches another white space; most texts have none but single blanks, and a search for each kind is quick."""
    return "  " in text or (any(c in text for c in OTHERS) and TOUCHING.search(text) is not None)


def units(text: str) -> tuple[str | None, list[str]]:
    """(first unit, the rest without their leading blank); the first is None where the text starts with a blank."""
    if _touching(text):
        return text, []
    parts = text.split(" ")
    return parts[0] or None, parts[1:]
