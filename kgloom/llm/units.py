"""Cutting a text where a byte-level BPE always cuts: before a single space between two visible characters.

The public pattern lets a space only lead a token, so no token crosses such a place, and the pieces can be encoded each by
itself and remembered. Texts with a space next to other white space are cut more carefully.
"""

from __future__ import annotations

import re

#: White space other than space and newline; a superset of Unicode's.
RARE = [chr(c) for c in (*range(9, 14), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000) if c != 10]
CUT = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str) -> list[str]:
    """The pieces; each but the first stands after one space, which belongs to it but is left out here."""
    if "  " in text or " \n" in text or "\n " in text or any(c in text for c in RARE):
        return CUT.split(text)
    return text.split(" ")


class Remembered(dict):
    """A bounded memory of pieces. Long pieces aren't kept; when it is full it starts anew."""

    LONGEST, MOST = 64, 200_000

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str):
        value = self.make(piece)
        if len(piece) <= self.LONGEST:
            if len(self) >= self.MOST:
                self.clear()
            self[piece] = value
        return value
