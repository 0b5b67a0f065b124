"""Word hashes of many texts at once with numpy."""

from __future__ import annotations

import numpy as np

U = np.uint64
# Odd multipliers of the splitmix64 finaliser.
_M1, _M2, _GOLDEN = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2^64

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of uint64 (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + _GOLDEN
        x = (x ^ (x >> U(30))) * _M1
        x = (x ^ (x >> U(27))) * _M2
        return x ^ (x >> U(31))


_BYTE = mix(np.arange(256, dtype=U) + U(1000))
SEGMENT = 1 << 19  # bytes of text whose words are hashed at once
KEPT = 1 << 21     # longest table of powers that is kept
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if n > KEPT:  # a single word of that length
        return _power_table(base, n)
    if base not in _POWERS or len(_POWERS[base]) < n:  # also for no bytes at all
        _POWERS[base] = _power_table(base, 1 << max(n - 1, 0).bit_length())
    return _POWERS[base][:n]


def _power_table(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=U)
    steps[0] = 1
    return np.cumprod(steps)


def groups(sizes: list[int], limit: int = SEGMENT):
    """Index ranges of consecutive items of about ``limit`` bytes together."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n + 1
    if start < len(sizes):
        yield start, len(sizes)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of its text) for texts whose A-Z are lower-cased.

    A word's hash is a polynomial in its bytes, taken as a difference of prefix sums, so
    the cost does not depend on the number of words. Long texts are cut between words, so
    that the sums' tables stay small."""
    found = [(np.empty(0, U), np.empty(0, np.int64))]
    for low, high in groups([len(t) for t in texts], SEGMENT):
        part = texts[low:high]
        if len(part) > 1 or len(part[0]) < SEGMENT:
            h, who = _word_hashes(part)
            found.append((h, who + low))
        else:
            found.extend((h, np.full(len(h), low, np.int64)) for h in map(_segment_hashes, _segments(part[0])))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _segments(text: bytes):
    """Pieces of a text of at most SEGMENT bytes that end between words; more only for a word
    that is longer."""
    start, n = 0, len(text)
    while start < n:
        end = min(start + SEGMENT - 1, n)
        if end < n:
            gaps = np.flatnonzero(~_IS_WORD[np.frombuffer(text, np.uint8, end - start, start)])
            if len(gaps):
                end = start + int(gaps[-1]) + 1
            else:  # inside a long word: up to its end
                while end < n and _IS_WORD[text[end]]:
                    end += 1
        yield text[start:end]
        start = end


def _segment_hashes(text: bytes) -> np.ndarray:
    return _word_hashes([text])[0]


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    if not len(data):
        return np.empty(0, U), np.empty(0, np.int64)
    inside = _IS_WORD[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]  # the last byte is a newline: runs are closed
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, dtype=U)
        np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=total[1:])
        inverse = _powers(pow(_BASE, -1, 1 << 64), len(data))
        value = (total[ends] - total[starts]) * inverse[starts]
        hashes = mix(value ^ (ends - starts).astype(U))
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(begin, starts, side="right") - 1


def shingles(hashes: np.ndarray, owner: np.ndarray, n: int, width: int = 5
             ) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, owner) for every run of ``width`` words; an owner of fewer words but
    not none has one shingle of all of them. Sorted by owner."""
    count = np.bincount(owner, minlength=n)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    per = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    who = np.repeat(np.arange(n), per)
    at = first[who] + np.arange(len(who)) - np.repeat(np.cumsum(per) - per, per)
    value = np.zeros(len(who), dtype=U)
    with np.errstate(over="ignore"):
        for k in range(width):
            here = k < count[who]
            value[here] += mix(hashes[at[here] + k] + U(k) * _GOLDEN)
    return mix(value), who


def sequence_hash(hashes: np.ndarray, owner: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of each owner's words in order (0 for none)."""
    count = np.bincount(owner, minlength=n)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    place = (np.arange(len(hashes)) - first[owner]).astype(U)
    out = np.zeros(n, dtype=U)
    with np.errstate(over="ignore"):
        term = mix(hashes ^ mix(place + U(seed)))
        total = np.concatenate((np.zeros(1, U), np.cumsum(term)))
    some = count > 0
    out[some] = mix(total[(first + count)[some]] - total[first[some]] + U(seed))
    return out
