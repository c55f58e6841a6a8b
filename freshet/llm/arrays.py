"""Numpy helpers that run inside tasks: words and letters of many texts at once, as flat arrays."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np

#: Bytes handled at once; one longer word or text is handled alone.
CHUNK = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 (public domain): spreads every bit of a 64-bit hash."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def mix_in_place(h: np.ndarray) -> np.ndarray:
    """``mixed`` over the array itself, with one array beside it instead of eight."""
    beside = np.empty_like(h)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        np.right_shift(h, np.uint64(shift), out=beside)
        np.bitwise_xor(h, beside, out=h)
        np.multiply(h, np.uint64(factor), out=h)
    np.right_shift(h, np.uint64(31), out=beside)
    return np.bitwise_xor(h, beside, out=h)


@functools.lru_cache(maxsize=4)
def _powers(n: int, inverse: bool) -> np.ndarray:
    p = np.full(n + 1, _INVERSE if inverse else _BASE, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    return _powers(1 << max(12, int(n).bit_length()), inverse)[: n + 1]


def slices(texts: list[str], limit: int = CHUNK) -> Iterator[tuple[list[int], list[str]]]:
    """(row numbers, texts) of about ``limit`` characters; long texts are cut at white space, so words stay whole."""
    rows, parts, size = [], [], 0
    for i, t in enumerate(texts):
        at = 0
        while at < len(t):
            end = len(t)
            if end - at > limit:
                gap = re.compile(r"[\x20\x09-\x0D]").search(t, at + limit)
                end = gap.end() if gap else end
            part = t[at:end] if at or end < len(t) else t
            rows.append(i)
            parts.append(part)
            size += len(part)
            at = end
            if size >= limit:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of texts: row of each, 64-bit hash, and its bytes.

    ``lower`` brings A-Z to lower case first. The hash is a polynomial over the bytes, taken from
    running sums, then mixed; it does not depend on where the word stands.
    """

    def __init__(self, texts: list[str], lower: bool = False):
        coded = [t.encode("utf-8", "surrogatepass") for t in texts]
        raw = np.frombuffer(b"\n".join([*coded, b""]), np.uint8)
        self.offsets = np.cumsum([0] + [len(c) + 1 for c in coded])
        if lower:
            raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
        self.raw = raw
        inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.rows = np.searchsorted(self.offsets, self.starts, "right") - 1
        n = len(raw)
        run = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(n)[:n], out=run[1:])
        self.hashes = mixed((run[self.ends] - run[self.starts]) * powers(n, True)[self.starts])

    def text(self, i: int) -> str:
        return self.raw[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "surrogatepass")


def lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in sorted ``keys`` and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted
