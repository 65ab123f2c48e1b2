"""Words of whole texts as 64-bit hashes, computed over byte arrays.

Words are maximal runs of bytes other than \\x20 and \\x09-\\x0D, with A-Z lower-cased. A word's hash is a polynomial in
random values of its bytes modulo 2**64, the same wherever the word stands. Two given different words share a hash
with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Texts are taken together up to so many bytes; a longer text is taken in parts that end at white space.
PART = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_VALUE = np.random.Generator(np.random.PCG64(20240601)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_P, _P_INVERSE)):
            steps = np.full(max(n, PART + 4096), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(ascending: np.ndarray) -> bytes:
    """Differences of sorted numbers, first bytes first: their high bytes are zeros, which the shuffle's codec removes."""
    steps = np.diff(ascending, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(raw: pa.Buffer) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _of_bytes(raw: bytes, parts_at: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes' places of the words of ``raw``."""
    b = np.frombuffer(raw, np.uint8)
    edge = np.diff(parts_at[b].view(np.int8), prepend=np.int8(1), append=np.int8(1))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _power_tables(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_VALUE[b] * power[: len(b)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start]), start


def _long(raw: bytes, parts_at: np.ndarray) -> np.ndarray:
    out, at = [], 0
    while at < len(raw):
        end = at + PART
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        out.append(_of_bytes(raw[at:end], parts_at)[0])
        at = end
    return np.concatenate(out)


def word_hashes(texts: Sequence[str | None], letters: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first, hashes, offsets) for runs of texts: text ``first + i`` has the words hashes[offsets[i]:offsets[i + 1]].

    letters: words are runs of letters, digits and bytes above 127 instead, so that punctuation parts them.
    """
    parts_at = _MARKS if letters else _SPACE
    group: list[bytes] = []
    size = first = 0

    def taken() -> tuple[int, np.ndarray, np.ndarray]:
        if len(group) == 1 and size > PART:
            h = _long(group[0], parts_at)
            return first, h, np.array([0, len(h)])
        h, start = _of_bytes(b"\n".join(group), parts_at)
        ends = np.cumsum([len(g) + 1 for g in group])
        return first, h, np.concatenate(([0], np.searchsorted(start, ends)))

    for i, text in enumerate(texts):
        raw = (text or "").encode()
        if group and size + len(raw) > PART:
            yield taken()
            group, size, first = [], 0, i
        group.append(raw)
        size += len(raw) + 1
    if group:
        yield taken()


def sums_between(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i + 1]] for each i; 0 for empty runs."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[offsets[1:]] - total[offsets[:-1]]
