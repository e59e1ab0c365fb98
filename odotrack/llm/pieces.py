"""Pieces of text that a byte-level tokenizer treats on their own."""

from __future__ import annotations

import re

#: One space between two characters that are no white space: a word begins with it,
#: whatever stands before and behind.
SAFE = re.compile(r"(?<=\S) (?=\S)")
_RARE = re.compile("[\t\v\f\r\x1c-\x1f\x85\xa0  -     　]")


def split_safe(text: str) -> list[str]:
    """The text cut before each such space, without these spaces."""
    plain = not ("  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " ")
    if plain and not _RARE.search(text):
        return text.split(" ")  # every space is one
    return SAFE.split(text)
