"""Text cut at spaces in such a way that byte-level BPE may encode each part alone.

A run of white space gives its last character, when that is a space, to the
word that follows. So a cut in front of a space with a word after it, or in
front of a lone line break, never goes through a match of the split pattern.
Parts repeat often, hence callers remember what a part was encoded to.
"""

from __future__ import annotations

import re

SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # Unicode White_Space
UNEVEN = re.compile(f"[{SPACE}](?:[{SPACE}]|\\Z)")
RARE = re.compile(f"[{SPACE}]".replace(r"\t-\r ", r"\t\x0b-\r"))
DOUBLE = ("  ", " \n", "\n ", "\n\n")
CUT = re.compile(f" (?=[^{SPACE}])")


def cut(text: str) -> tuple[str, list[str]]:
    """The part before the first cut, and those after it without their space.

    A part that begins with a line break has no space in front; ``spelled``
    gives any part after the first one as it stands in the text.
    """
    if uneven(text):
        first, *rest = CUT.split(text)
    else:
        first, *rest = text.replace("\n", " \n").split(" ")
    return first, rest


def uneven(text: str) -> bool:
    """Whether white space stands next to white space, or at the end."""
    if RARE.search(text):
        return UNEVEN.search(text) is not None
    return text[-1:] in (" ", "\n") or any(pair in text for pair in DOUBLE)


def spelled(part: str) -> str:
    return part if part[0] == "\n" else " " + part
