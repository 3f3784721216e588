"""Cutting a text into pieces that a byte-level tokenizer encodes independently.

A space before a character that isn't white space always begins a new pre-token, so the stretches between such spaces
can be encoded one by one and kept in a bounded store. The stretches joined give the text.
"""

from __future__ import annotations

import re

#: Python's \\s holds all of Unicode's white space (and four control characters more, which only makes a stretch longer).
_JOINED = re.compile(r" (?=\s|\Z)")


def stretches(text: str) -> list[str]:
    """The parts of text; all but the first lack the single space that goes before them."""
    parts = text.split(" ")
    if not _JOINED.search(text):
        return parts
    out = [parts[0]]
    for part in parts[1:]:
        if part and not part[0].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return out


class Kept(dict):
    """A store that calls make(key) for what it lacks. When it is full its entries become the elder ones, of which those
    that are asked for come back; so it holds twice as many at most, and frequent keys stay."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.elder = make, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.elder = dict(self)
            self.clear()
        value = self.elder.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value
