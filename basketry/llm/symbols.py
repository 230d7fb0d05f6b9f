"""Characters folded to 32 symbols, for hashed features of bounded size."""

from __future__ import annotations

import unicodedata

import numpy as np

ORDER, BITS = 4, 5
CAPS, DIGIT, MARK, SIGN, FAR = 31, 27, 28, 29, 30


def symbol_table() -> tuple[np.ndarray, np.ndarray]:
    """Code point of the basic plane -> symbol, and whether it is an upper-case letter.

    0: white space; 1 to 26: letters without accents and case (letters of other
    scripts by their code point modulo 26); 27: digits; 28: punctuation; 29: other
    signs; 30: beyond the basic plane.  A capital after a capital becomes 31."""
    table, upper = np.full(0x10000, SIGN, dtype=np.uint8), np.zeros(0x10000, dtype=bool)
    for c in range(0x10000):
        x = chr(c)
        kind = unicodedata.category(x)
        if kind[0] in "LM":
            base = unicodedata.normalize("NFKD", x)[0].lower()
            table[c] = ord(base) - 96 if "a" <= base <= "z" else ord(base[0]) % 26 + 1
            upper[c] = kind == "Lu"
        elif kind[0] == "N":
            table[c] = DIGIT
        elif kind[0] == "Z" or c in (9, 10, 11, 12, 13):
            table[c] = 0
        elif x in ".,;:!?'\"()-":
            table[c] = MARK
    return table, upper


class Symbols:
    """Texts as symbol strings and their 4-gram codes."""

    def __init__(self) -> None:
        self.table, self.upper = symbol_table()

    def codes(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The 4-gram code ending at every symbol (texts begin after spaces), and the text each belongs to."""
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
        starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
        near = np.minimum(points, 0xFFFF)
        symbols, upper = self.table[near], self.upper[near]
        symbols[points > 0xFFFF] = FAR
        shout = upper.copy()
        shout[1:] &= upper[:-1]
        shout[:1] = False
        symbols[shout] = CAPS
        keep = symbols > 0
        keep[1:] |= symbols[:-1] > 0
        text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[keep]
        symbols = symbols[keep]
        at = np.arange(len(symbols)) + (ORDER - 1) * (text + 1)
        padded = np.zeros(len(symbols) + (ORDER - 1) * len(starts), dtype=np.uint32)
        padded[at] = symbols
        code = np.zeros(len(symbols), dtype=np.uint32)
        for back in range(ORDER):
            code |= padded[at - back] << np.uint32(BITS * back)
        return code, text
