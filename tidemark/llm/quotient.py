"""Counting quotient filters: lossless counters of packed word-id n-grams.

An n-gram of ids is packed into a number of ``2 * half`` bits, which a Feistel network permutes.  The permutation is
invertible and spreads keys evenly, so the top bits deal them out over ranges, the next ones are the quotient and all the
others the remainder: nothing of a key is lost, and sorting by it is sorting by (quotient, remainder).  A filter holds, for
the sorted keys of one range, the run of every quotient in unary, remainders of whole bytes, and counters of variable length
(one bit for a count of one).  Filters of a range are merged by their sorted keys.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.common import BASE, mixed

ROUNDS = 4
WORDS = 3  # n-grams have up to so many ids
U = np.uint64


def half_bits(id_bits: int) -> int:
    """Bits of each half of a packed n-gram; ids need up to 42 bits."""
    if id_bits > 42:
        raise ValueError("ids of more than 42 bits do not fit a packed n-gram")
    return max(1, -(-WORDS * id_bits // 2))


def _mask(bits: int) -> np.uint64:
    return U((1 << bits) - 1)


def packed(x: np.ndarray, y: np.ndarray, z: np.ndarray, id_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Three ids (0: none) as the upper and lower half of one number."""
    half = half_bits(id_bits)
    low = half - id_bits  # bits of the middle id that lie in the lower half
    left = (x << U(id_bits - low)) | (y >> U(low))
    return left, ((y & _mask(low)) << U(id_bits)) | z


def unpacked_ids(left: np.ndarray, right: np.ndarray, id_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = half_bits(id_bits) - id_bits
    y = ((left & _mask(id_bits - low)) << U(low)) | (right >> U(id_bits))
    return left >> U(id_bits - low), y, right & _mask(id_bits)


def permuted(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        for k in range(ROUNDS):
            left, right = right, left ^ (mixed(right + U(k + 1) * BASE) & _mask(half))
    return left, right


def restored(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        for k in reversed(range(ROUNDS)):
            left, right = right ^ (mixed(left + U(k + 1) * BASE) & _mask(half)), left
    return left, right


def folded(left: np.ndarray, right: np.ndarray, count: np.ndarray | None, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in ascending order with the sum of their counts (None: one each)."""
    if 2 * half <= 64:
        key = (left << U(half)) | right
        if count is None:
            key = np.sort(key)
        else:
            order = np.argsort(key, kind="stable")
            key, count = key[order], count[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        left, right = key >> U(half), key & _mask(half)
    else:
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        count = None if count is None else count[order]
        new = np.ones(len(left), bool)
        new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    first = np.flatnonzero(new)
    if count is None:
        total = np.diff(np.append(first, len(left)))
    else:
        total = np.add.reduceat(count, first) if len(first) else np.zeros(0, np.int64)
    return left[first], right[first], total.astype(np.int64)


def _quotient_bits(n: int, rest: int, most: int) -> int:
    """The quotient's bits that make ``n`` keys with ``rest`` bits smallest, with remainders of whole bytes."""
    near = max(n, 1).bit_length() - 1
    choices = [q for q in range(max(0, near - 4), near + 4) if q <= most] or [most]
    return min(choices, key=lambda q: 8 * -(-(rest - q) // 8) + (1 << q) / max(n, 1))


def written(left: np.ndarray, right: np.ndarray, count: np.ndarray, half: int, prefix: int) -> bytes:
    """The filter of distinct sorted permuted keys that agree in their top ``prefix`` bits."""
    n = len(left)
    q = _quotient_bits(n, 2 * half - prefix, half - prefix)
    low = half - prefix - q  # the remainder's bits in the upper half
    quotient = ((left >> U(low)) & _mask(q)).astype(np.int64)
    runs = np.zeros(n + (1 << q), np.uint8)
    runs[quotient + np.arange(n)] = 1
    width = -(-(low + half) // 8)
    upper = left & _mask(low)
    rest = np.stack([right | (upper << U(half)), upper >> U(64 - half)], axis=1).astype("<u8").view(np.uint8).reshape(n, 16)[:, :width]
    many = count > 1
    more = count[many] - 2
    wide = more >= 255
    parts = [np.packbits(runs).tobytes(), rest.tobytes(), np.packbits(many).tobytes(), np.minimum(more, 255).astype(np.uint8).tobytes(),
             more[wide].astype("<i8").tobytes()]
    head = np.array([n, q, int(many.sum()), int(wide.sum())], "<i8")
    return head.tobytes() + b"".join(parts)


def read(raw: bytes, part: int, half: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys and counts that ``written`` got, ``part`` being their top ``prefix`` bits."""
    n, q, n_many, n_wide = np.frombuffer(raw, "<i8", 4).tolist()
    low = half - prefix - q
    width = -(-(low + half) // 8)
    at = 32
    sizes = [(n + (1 << q) + 7) // 8, n * width, (n + 7) // 8, n_many, 8 * n_wide]
    fields = []
    for size in sizes:
        fields.append(np.frombuffer(raw, np.uint8, size, at))
        at += size
    quotient = (np.flatnonzero(np.unpackbits(fields[0], count=n + (1 << q))) - np.arange(n)).astype(np.uint64)
    rest = np.zeros((n, 16), np.uint8)
    rest[:, :width] = fields[1].reshape(n, width)
    rest = rest.view("<u8").reshape(n, 2)
    upper = ((rest[:, 1] << U(64 - half)) | (rest[:, 0] >> U(half))) & _mask(low)
    left = (U(part) << U(half - prefix)) | (quotient << U(low)) | upper
    count = np.ones(n, np.int64)
    more = fields[3].astype(np.int64)
    more[more == 255] = fields[4].view("<i8")
    count[np.flatnonzero(np.unpackbits(fields[2], count=n))] = more + 2
    return left, rest[:, 0] & _mask(half), count
