"""Texts as arrays of code points, and the class of each code point."""

from __future__ import annotations

from functools import cache

import numpy as np

OTHER, LOWER, UPPER, DIGIT, SPACE, MARK = range(6)


@cache
def classes() -> np.ndarray:
    """By code point: lower-case or uncased letter, upper-case letter, digit, white space, ASCII mark, or other."""

    def kind(c: str) -> int:
        if c.isalpha():
            return UPPER if c.isupper() else LOWER
        if c.isspace():
            return SPACE
        if c.isdigit():
            return DIGIT
        return MARK if c.isascii() and c.isprintable() else OTHER

    return np.fromiter((kind(chr(i)) for i in range(0x110000)), np.uint8, 0x110000)


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
