"""Splitting a text into the pieces whose bytes are merged separately."""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

# Contractions of the public pattern, and the letters of Latin script below U+0250, all of which are \p{L}.
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Anything a plain text doesn't have: here the two regex libraries may hold different views of a character's class.
_ODD = re.compile(f"[^\\t\\n\\x0b\\x0c\\r -~{_LATIN}]")
_PLAIN = re.compile(rf"{_ENDINGS}| ?[{_LATIN}]+| ?[0-9]+| ?[^\s{_LATIN}0-9]+|\s+(?!\S)|\s+")
#: Fixed value: the public pattern the plain form stands for.
PUBLIC = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def splitter(pattern: str = PUBLIC) -> Callable[[str], list[str]]:
    """A function that gives a text's pieces in order; texts of plain characters take a faster path for the public pattern."""
    full = regex.compile(pattern).findall
    if pattern != PUBLIC:
        return full
    return lambda text: full(text) if _ODD.search(text) else _PLAIN.findall(text)
