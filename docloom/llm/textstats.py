"""Statistics of many whole texts at once: byte classes, words, lines and repeated word windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from docloom.llm.shared import flat_text
from docloom.llm.wordflow import SPACE, bounds, fits, joined, windows, word_hashes

#: Byte classes, by number.
BLANK, NEWLINE, UPPER, LOWER, DIGIT, SYMBOL, BAR, BANG, STOP, PUNCT, LEAD, TAIL = range(12)
CLASS = np.full(256, PUNCT, dtype=np.int64)
CLASS[SPACE] = BLANK
CLASS[0x0A] = NEWLINE
CLASS[0x41:0x5B], CLASS[0x61:0x7B], CLASS[0x30:0x3A] = UPPER, LOWER, DIGIT
CLASS[[ord(c) for c in "#*$%&<>"]] = SYMBOL
CLASS[ord("|")], CLASS[ord("!")] = BAR, BANG
CLASS[[ord(c) for c in ".,;:?"]] = STOP
CLASS[0x80:0xC0], CLASS[0xC0:] = TAIL, LEAD

REPEAT_WINDOW = 8


def duplicate_lines(data: bytes, offsets: list[int]) -> tuple[list[int], list[int]]:
    """(lines with a word, those equal to an earlier line) of each text."""
    lines, dups = [], []
    for a, b in zip(offsets, offsets[1:]):
        own = [x for x in data[a:b].split(b"\n") if x and not x.isspace()]
        lines.append(len(own))
        dups.append(len(own) - len(set(own)))
    return lines, dups


def covered(starts: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of n places lie in a window of `length` from one of the (distinct) starts."""
    change = np.zeros(n + 1, dtype=np.int32)
    change[starts] += 1
    change[starts + length] -= 1
    return np.cumsum(change[:-1]) > 0


def per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(flags, dtype=np.int64)][first])


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts of each text, as int64 arrays."""
    data, offsets = flat_text(column)
    n = len(offsets) - 1
    kinds = np.bincount(np.repeat(np.arange(n) * 12, np.diff(offsets)) + CLASS[data], minlength=12 * n).reshape(n, 12)
    starts, ends, first = bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    text, ok = fits(first, len(words), REPEAT_WINDOW)
    at = np.flatnonzero(ok)
    key = joined(text[at].astype(np.uint64), windows(words, REPEAT_WINDOW)[at])
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(at), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    repeated = covered(at[again], len(words), REPEAT_WINDOW) if len(words) else np.zeros(0, bool)
    echo = np.zeros(len(words), dtype=bool)
    echo[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    size = ends - starts
    tail = CLASS[data[ends - 1]] if len(words) else np.zeros(0, np.int64)
    lines, dups = duplicate_lines(data.tobytes(), offsets.tolist())
    return {
        "n_words": np.diff(first),
        "word_chars": kinds[:, [UPPER, LOWER, DIGIT, SYMBOL, BAR, BANG, STOP, PUNCT, LEAD]].sum(axis=1),
        "n_symbols": kinds[:, SYMBOL] + kinds[:, BAR],
        "n_dup_lines": np.array(dups, np.int64),
        "n_repeat_words": per_text(repeated, first),
        "n_lines": np.array(lines, np.int64),
        "n_upper": kinds[:, UPPER],
        "n_lower": kinds[:, LOWER],
        "n_digits": kinds[:, DIGIT],
        "n_bars": kinds[:, BAR],
        "n_bangs": kinds[:, BANG],
        "n_stops": kinds[:, STOP],
        "n_punct": kinds[:, PUNCT],
        "n_wide": kinds[:, LEAD],
        "n_echo_words": per_text(echo, first),
        "n_short_words": per_text(size <= 3, first),
        "n_long_words": per_text(size > 12, first),
        "n_symbol_ends": per_text((tail == SYMBOL) | (tail == BAR) | (tail == BANG), first),
    }


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_digits", "n_bars", "n_bangs", "n_stops", "n_punct", "n_wide", "n_echo_words", "n_short_words", "n_long_words", "n_symbol_ends"]
