"""Prefix-free parsing of texts with numpy: triggers, phrases, substring hashes."""

from __future__ import annotations

import numpy as np

from .textnum import U, _powers, mix

GRAM = 12             # bytes of the rolling hash
SEGMENT = 1 << 18     # starts handled at once; bounds the memory of a task, also for very long texts

# Bases of the two polynomials (odd, so they have inverses modulo 2^64).
_BASES = (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93)
_BYTES = tuple(mix(np.arange(256, dtype=U) + U(seed)) for seed in (5000, 9000))


class Hashes:
    """Hash of any substring of ``data`` in constant time, from prefix sums."""

    def __init__(self, data: np.ndarray, which: int):
        base = _BASES[which]
        with np.errstate(over="ignore"):
            self.total = np.zeros(len(data) + 1, dtype=U)
            np.cumsum(_BYTES[which][data] * _powers(base, len(data)), out=self.total[1:])
        self.inverse = _powers(pow(base, -1, 1 << 64), len(data) + 1)

    def of(self, start, end) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.total[end] - self.total[start]) * self.inverse[start] + (end - start).astype(U))


def trigger_of_start(rolling: np.ndarray, span: int) -> np.ndarray:
    """For each i the place of the smallest value in rolling[i : i + span], the leftmost of
    equals: it depends on the bytes of that stretch alone."""
    n = len(rolling)
    blocks = -(-n // span)
    keyed = np.full(blocks * span, ~U(0), dtype=U)
    # 40 bits of hash, then the place (segments are far shorter than 2^24)
    keyed[:n] = (rolling & ~U((1 << 24) - 1)) | np.arange(n, dtype=U)
    grid = keyed.reshape(blocks, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - span + 1
    low = np.minimum(behind[:count], ahead[span - 1:span - 1 + count])
    return (low & U((1 << 24) - 1)).astype(np.int64)


def parse(data: np.ndarray, offsets: np.ndarray, length: int, span: int):
    """Phrases of the texts data[offsets[k] : offsets[k + 1]] as (text, trigger, first,
    last) arrays of places in ``data``, with the hashes of ``data``.

    Every start of a ``length``-byte string belongs to the trigger found in its first
    ``span`` rolling hashes; the starts first .. last of one trigger are consecutive.
    Texts and the segments they are handled in don't share phrases."""
    h0, h1 = Hashes(data, 0), Hashes(data, 1)
    n = len(data)
    if n < length:
        none = np.empty(0, np.int64)
        return none, none, none, none, h0, h1
    at = np.arange(n - GRAM + 1)
    rolling = h0.of(at, at + GRAM)
    trigger = trigger_of_start(rolling, span)[:n - length + 1]
    start = np.arange(len(trigger))
    text = np.searchsorted(offsets, start, side="right") - 1
    inside = start + length <= offsets[text + 1]
    start, text, trigger = start[inside], text[inside], trigger[inside]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return text[first], trigger[first], start[first], start[last], h0, h1
