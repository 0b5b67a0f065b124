"""Noisy-channel restoration of disguised words (used inside tasks).

A disguised word is a lattice: a digit or sign may stand for a letter, for nothing or for
itself, a run of three or more equal letters for one or two of them, the gap between
letters written apart for nothing or for a word's end. The likeliest path under a
character model of four-grams is the restored text. Words without such places have one
path and stay as they are.
"""

from __future__ import annotations

import math
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np

# Symbols of the character model: 0 a word's end, 1 to 26 the letters a to z (accents
# dropped), 27 any other letter.
SYMBOLS, ORDER = 28, 4
CELLS = SYMBOLS ** ORDER
SMOOTHING = 4.0  # occurrences that the shorter context counts for

# Letters that digits and signs are used for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
# Channel, as log probabilities: a sign stands for one of its letters, is filler, is itself.
LETTER, FILLER, ITSELF = math.log(0.6), math.log(0.2), math.log(0.2)
ONE, TWO = math.log(0.6), math.log(0.4)          # what a run of equal letters stands for
JOINED, APART = math.log(0.7), math.log(0.3)     # letters written apart

APART_LETTERS = re.compile(r"(?<!\S)\S(?:[ \t]+\S){2,}(?!\S)")
_LONG_RUN = re.compile(r"([^\W\d_])\1\1")
_WORD = re.compile(r"[^\W\d_]+")
_EDGE = re.compile(r"^[^\w@$!|+(€£*]+|(\W)\1\1+$|[^\w@$]+$")


def symbol(ch: str) -> int:
    """Symbol of a character (0 for all but letters)."""
    if not ch.isalpha():
        return 0
    base = unicodedata.normalize("NFKD", ch.lower())[0]
    return ord(base) - 96 if "a" <= base <= "z" else 27


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    return np.array([symbol(chr(c)) for c in range(0x10000)], np.uint8)


def gram_cells(text: str) -> np.ndarray:
    """Cell of every four-gram of the text's words; a word begins after three ends and its
    own end is predicted too."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    codes = np.full(len(points), 27, np.uint8)  # letters beyond the first plane are rare
    low = points < 0x10000
    codes[low] = _table()[points[low]]
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint8)
    codes = codes[(codes != 0) | np.concatenate([[True], codes[:-1] != 0])]
    codes = np.repeat(codes, np.where(codes == 0, 3, 1)).astype(np.int32)
    if len(codes) <= 3:
        return np.zeros(0, np.int64)
    a, b, c, d = codes[:-3], codes[1:-2], codes[2:-1], codes[3:]
    cells = ((a * SYMBOLS + b) * SYMBOLS + c) * SYMBOLS + d
    return cells[(c != 0) | (d != 0)].astype(np.int64)


def log_probabilities(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Log probability of each cell's last symbol after its first three, as float32: counts
    smoothed by those of the shorter context, down to equal shares."""
    full = np.bincount(cells, counts, CELLS).reshape((SYMBOLS,) * ORDER)
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for drop in range(ORDER - 1, -1, -1):
        c = full.sum(axis=tuple(range(drop)))
        p = (c + SMOOTHING * p) / (c.sum(axis=-1, keepdims=True) + SMOOTHING)
    return np.log(p).astype("<f4").tobytes()


class Restorer:
    """Restores tokens under one character model (see :func:`log_probabilities`)."""

    def __init__(self, model: bytes):
        self.logp = array("f")
        self.logp.frombytes(model)

    def best(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The likeliest path: Viterbi over the last three symbols. Each step offers strings
        with log probabilities; a blank ends a word. Linear in the steps."""
        logp, states, steps = self.logp, {0: 0.0}, []
        for arcs in [*lattice, [(" ", 0.0)]]:
            after: dict[int, float] = {}
            back: dict[int, tuple[int, str]] = {}
            for context, score in states.items():
                for text, cost in arcs:
                    ctx, s = context, score + cost
                    for ch in text:
                        x = symbol(ch)
                        if x or ctx % SYMBOLS:  # an end after an end says nothing
                            s += logp[ctx * SYMBOLS + x]
                            ctx = (ctx * SYMBOLS + x) % SYMBOLS ** 3 if x else 0
                    if s > after.get(ctx, -math.inf):
                        after[ctx], back[ctx] = s, (context, text)
            states = after
            steps.append(back)
        ctx, out = max(states, key=states.get), []
        for back in reversed(steps):
            ctx, text = back[ctx]
            out.append(text)
        return "".join(reversed(out)).strip()

    def token(self, token: str) -> str:
        """A lower-case token without blanks, restored; the token itself where it has no
        letter, or neither signs inside nor long runs."""
        core = _EDGE.sub("", _EDGE.sub("", token))
        if not any(c.isalpha() for c in core) or (core.isalpha() and not _LONG_RUN.search(core)):
            return token
        return self.best(_lattice(core))

    def words(self, token: str) -> list[str]:
        """The words of a restored token."""
        plain = token.rstrip(".,;:?!\"')]}-").lstrip("\"'[{-")
        if plain.isalpha() and not _LONG_RUN.search(plain):
            return [plain]
        return words_in(self.token(token))

    def apart(self, run: str) -> str:
        """Single characters written apart, restored to words."""
        steps: list[list[tuple[str, float]]] = []
        for x in run.split():
            if steps:
                steps.append([("", JOINED), (" ", APART)])
            steps.append(_arcs(x, 1))
        return self.best(steps)


def _arcs(ch: str, n: int) -> list[tuple[str, float]]:
    """What ``n`` times the character may stand for."""
    if ch.isalpha():
        return [(ch, ONE), (2 * ch, TWO)] if n > 2 else [(n * ch, 0.0)]
    letters = STANDS_FOR.get(ch, "")
    arcs = [("", FILLER), (" ", ITSELF)]
    return arcs + [(x, LETTER - math.log(len(letters))) for x in letters]


def _lattice(core: str) -> list[list[tuple[str, float]]]:
    out, i = [], 0
    while i < len(core):
        j = i + 1
        while j < len(core) and core[j] == core[i]:
            j += 1
        if core[i].isalpha():
            out.append(_arcs(core[i], j - i))
        elif j - i > 2:  # a long run of one sign is filler or itself, or one or two letters
            out.append(_arcs(core[i], 1) + [(2 * x, LETTER + TWO) for x in STANDS_FOR.get(core[i], "")])
        else:
            out.extend([_arcs(core[i], 1)] * (j - i))
        i = j
    return out


def words_in(text: str) -> list[str]:
    """Words of restored text: runs of letters."""
    return _WORD.findall(text)
