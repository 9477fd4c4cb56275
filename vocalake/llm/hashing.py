"""64-bit hashes of the words of many texts at once."""

from __future__ import annotations

import numpy as np
import xxhash

from vocalake.llm.common import SPACES

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.isin(np.arange(256), list(SPACES.encode()))
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_STEP, _LONG = np.uint64(0x9E3779B97F4A7C15), 256


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(batch: list[str], most: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without ASCII white space, A-Z lower-cased), and the number of words of each text; about `most` characters at a time."""
    parts, start, held = [], 0, 0
    for i, x in enumerate(batch):
        held += len(x)
        if held > most or i + 1 == len(batch):
            parts.append(_hashes(batch[start : i + 1]))
            start, held = i + 1, 0
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*parts))


def _edges(text: np.ndarray) -> np.ndarray:
    """Where words start and end, by turns, in bytes that begin and end with white space."""
    space = _IS_SPACE[text]
    return np.flatnonzero(space[1:] != space[:-1]) + 1


def word_number(batch: list[str]) -> int:
    """Number of words of all the texts."""
    return len(_edges(np.frombuffer(f" {' '.join(batch)} ".encode(), np.uint8))) // 2


def _hashes(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Eight bytes of every word at a time; words of more than `_LONG` bytes by themselves."""
    raw = [x.encode() for x in batch]
    low = _LOWER[np.frombuffer(b" " + b" ".join(raw) + b" " * 8, np.uint8)]
    edges = _edges(low)
    starts, n = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray((len(low) - 7,), "<u8", low, strides=(1,))
    h = scrambled((eight[starts] & _MASK[np.minimum(n, 8)]) * _STEP + n.astype(np.uint64))
    more, k = np.flatnonzero((n > 8) & (n <= _LONG)), 8
    while len(more):
        part = eight[starts[more] + k] & _MASK[np.minimum(n[more] - k, 8)]
        h[more] = scrambled(h[more] * _STEP + part)
        k += 8
        more = more[n[more] > k]
    for i in np.flatnonzero(n > _LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(low[starts[i] : starts[i] + n[i]])
    ends = np.cumsum([len(r) + 1 for r in raw])
    return h, np.diff(np.searchsorted(starts, ends, "right"), prepend=0)
