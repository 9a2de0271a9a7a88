"""Words, word hashes and word windows of many texts at once, as flat numpy arrays.

A word is a run of bytes outside 0x20 and 0x09-0x0D. Hashes are 64 bits wide, mixed word by word; windows are
hashed by doubling (2, 4, 8, ... words), so that any window length costs a few vector steps.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of sequence a followed by sequence b, of their hashes."""
    return mixed(a * _A + (b ^ _C))


def bounds(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): the words' byte ranges, and for each text the number of its first word (one more at the end). `blank`: the bytes outside words."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(blank[data], out=inside[1:-1])
    here, cut = inside[1:-1], np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(here & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(here & (~inside[2:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: np.uint64 = np.uint64(0)) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes a step; another seed gives an independent one."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = ends - starts
    out = mixed(left.astype(np.uint64) * _C + seed)
    at, todo = starts, np.arange(len(starts))
    while len(todo):
        lane = eight[at] & _KEEP[np.minimum(left, 8)]
        out[todo] = joined(out[todo], lane)
        more = left > 8
        at, left, todo = at[more] + 8, left[more] - 8, todo[more]
    return out


def windows(words: np.ndarray, length: int) -> np.ndarray:
    """The hash of each run of `length` hashes; element i is the run that starts at i (runs may cross texts)."""
    power, step, have, done = words, 1, None, 0
    while True:
        if length & step:
            if have is None:
                have, done = power, step
            else:
                n = len(words) - done - step + 1
                if n <= 0:
                    return words[:0]
                have = joined(have[:n], power[done : done + n])
                done += step
        if done == length:
            return have[: max(0, len(words) - length + 1)]
        n = len(words) - 2 * step + 1
        if n <= 0:
            return words[:0]
        power = joined(power[:n], power[step : step + n])
        step *= 2


def fits(first: np.ndarray, n_words: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, ok) of each window start: the text that it begins in, and whether the window ends in the same text."""
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    n = max(0, n_words - length + 1)
    return text, np.arange(n) + length <= first[text[:n] + 1]
