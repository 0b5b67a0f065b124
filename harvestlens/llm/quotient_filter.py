"""Counting quotient filters over packed n-grams of word ids (numpy, used inside tasks).

An n-gram's ids are packed into up to three lanes and permuted by xor rounds, each of which
changes one lane by a mix of the others and can be undone: no two n-grams share a permuted
key. The leading bits of the first lane are the quotient; what is left of it and the other
lanes are the remainder, which is stored in full. A filter holds its entries in order of
quotient and remainder: one bit per possible quotient (occupied), one bit per entry (last of
its quotient's run), the remainders in whole bytes, and a counter of one byte with an escape
to eight. Counts and keys come back exactly.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_A, _B, _C = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
ESCAPE = 255


def widths(size: int, bits: int) -> list[int]:
    """Bits of each lane for n-grams of ``size`` ids (2 to 5) of ``bits`` bits (up to 32)."""
    return {2: [bits, bits], 3: [2 * bits, bits], 4: [2 * bits, 2 * bits], 5: [2 * bits, 2 * bits, bits]}[size]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * _B
    x = (x ^ (x >> U(27))) * _C
    return x ^ (x >> U(31))


def _mask(w: int) -> np.uint64:
    return U((1 << w) - 1)


def _rounds(lanes: int):
    """(lane changed, lanes mixed, constant) of each round."""
    if lanes == 2:
        return [(0, (1,), 1), (1, (0,), 2), (0, (1,), 3), (1, (0,), 4), (0, (1,), 5)]
    return [(0, (1, 2), 1), (1, (0, 2), 2), (2, (0, 1), 3), (0, (1, 2), 4), (1, (0, 2), 5), (0, (1, 2), 6)]


def _round(lanes, w, rnd):
    at, others, constant = rnd
    h = np.full(len(lanes[0]), constant, U) * _A
    for o in others:
        h = _mix(h + lanes[o] * _A + U(o + 1))
    lanes[at] = lanes[at] ^ (h & _mask(w[at]))


def permute(ids: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Lanes of the n-grams whose k-th ids are ``ids[k]``."""
    x = [i.astype(U) for i in ids]
    b = U(bits)
    lanes = {2: lambda: [x[0], x[1]], 3: lambda: [x[0] << b | x[1], x[2]],
             4: lambda: [x[0] << b | x[1], x[2] << b | x[3]],
             5: lambda: [x[0] << b | x[1], x[2] << b | x[3], x[4]]}[len(x)]()
    w = widths(len(x), bits)
    for rnd in _rounds(len(lanes)):
        _round(lanes, w, rnd)
    return lanes


def unpermute(lanes: list[np.ndarray], size: int, bits: int) -> list[np.ndarray]:
    """The ids again."""
    lanes, w = list(lanes), widths(size, bits)
    for rnd in reversed(_rounds(len(lanes))):
        _round(lanes, w, rnd)
    out = []
    for lane, width in zip(lanes, w):
        if width == 2 * bits:
            out.append(lane >> U(bits))
        out.append(lane & _mask(bits))
    return out


def slots(lanes: list[np.ndarray], log2_slots: int) -> np.ndarray:
    """A fixed slot below 2^log2_slots for every key (for membership bitmaps)."""
    h = np.zeros(len(lanes[0]), U)
    for lane in lanes:
        h = _mix(h * _A + lane + _C)
    return (h >> U(64 - log2_slots)).astype(np.int64)


def summed(lanes: list[np.ndarray], counts: np.ndarray | None, w: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys in order, with the sums of their counts (None: 1 each)."""
    n = len(lanes[0])
    if n == 0:
        return lanes, np.zeros(0, np.int64)
    if sum(w) <= 64:  # one machine word holds the key: sort that
        key = lanes[0]
        for lane, width in zip(lanes[1:], w[1:]):
            key = key << U(width) | lane
        order = None if counts is None else np.argsort(key, kind="stable")
        key = np.sort(key) if order is None else key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        at, key = np.flatnonzero(new), key[new]
        out = []
        for width in reversed(w):
            out.append(key & _mask(width))
            key = key >> U(width) if width < 64 else key
        out.reverse()
    else:
        order = np.lexsort(lanes[::-1])
        lanes = [lane[order] for lane in lanes]
        new = np.concatenate([[True], np.any([lane[1:] != lane[:-1] for lane in lanes], axis=0)])
        at, out = np.flatnonzero(new), [lane[new] for lane in lanes]
    if counts is None:
        return out, np.diff(np.append(at, n))
    return out, np.add.reduceat(counts[order], at)


def _to_bytes(x: np.ndarray, width: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :(width + 7) // 8].tobytes()


def _from_bytes(data: memoryview, n: int, width: int) -> tuple[np.ndarray, memoryview]:
    k = (width + 7) // 8
    full = np.zeros((n, 8), np.uint8)
    full[:, :k] = np.frombuffer(data[:n * k], np.uint8).reshape(n, k)
    return full.view("<u8").reshape(n).astype(U), data[n * k:]


def encode(lanes: list[np.ndarray], counts: np.ndarray, w: list[int], shard_bits: int) -> bytes:
    """The filter of ordered distinct keys whose first lanes agree in the leading
    ``shard_bits`` bits (those are not stored)."""
    n = len(counts)
    q = min(max(n - 1, 1).bit_length(), w[0] - shard_bits)
    rest = w[0] - shard_bits - q
    first = lanes[0] & _mask(w[0] - shard_bits)
    quotient = (first >> U(rest)).astype(np.int64)
    occupied = np.zeros(1 << q, np.uint8)
    occupied[quotient] = 1
    last = np.append(quotient[1:] != quotient[:-1], True)
    big = counts >= ESCAPE
    return b"".join([
        np.array([n, q, int(big.sum())], "<u4").tobytes(), np.packbits(occupied).tobytes(), np.packbits(last).tobytes(),
        _to_bytes(first & _mask(rest), rest), *[_to_bytes(x, wx) for x, wx in zip(lanes[1:], w[1:])],
        np.where(big, ESCAPE, counts).astype(np.uint8).tobytes(), counts[big].astype("<i8").tobytes()])


def decode(blob: bytes, w: list[int], shard: int, shard_bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys and counts of a filter."""
    data = memoryview(blob)
    n, q, n_big = (int(x) for x in np.frombuffer(data[:12], "<u4"))
    rest, data = w[0] - shard_bits - q, data[12:]
    size = ((1 << q) + 7) // 8
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(data[:size], np.uint8))[:1 << q])
    data, size = data[size:], (n + 7) // 8
    last = np.unpackbits(np.frombuffer(data[:size], np.uint8))[:n]
    quotient = occupied[np.cumsum(last) - last].astype(U)
    low, data = _from_bytes(data[size:], n, rest)
    top = U(shard) << U(w[0] - shard_bits) if shard_bits else U(0)
    lanes = [top | quotient << U(rest) | low]
    for wx in w[1:]:
        lane, data = _from_bytes(data, n, wx)
        lanes.append(lane)
    counts = np.frombuffer(data[:n], np.uint8).astype(np.int64)
    counts[counts == ESCAPE] = np.frombuffer(data[n:n + 8 * n_big], "<i8")
    return lanes, counts


def merged(blobs: list[bytes], w: list[int], shard: int, shard_bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """One shard's filters of many tasks, their counts added."""
    parts = [decode(b, w, shard, shard_bits) for b in blobs]
    lanes = [np.concatenate([p[0][i] for p in parts]) for i in range(len(w))]
    return summed(lanes, np.concatenate([p[1] for p in parts]), w)
