"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def shingle_set(text: str | None) -> frozenset:
    words = WORD.findall(ascii_lower(text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def classes(docs: list[tuple[int, str | None]]) -> dict[int, int]:
    """doc_id -> least id reachable by links."""
    sets = [(i, shingle_set(t)) for i, t in docs]
    root = {i: i for i, _ in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in sets}


def deduplicated(docs: list[tuple[int, str | None]], window: int = 20) -> dict[int, tuple[int, int, str]]:
    """doc_id -> (words, words removed, what is left)."""
    first: dict[tuple, tuple[int, int]] = {}
    words = {i: WORD.findall(t or "") for i, t in docs}
    for i in sorted(words):
        for s in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][s : s + window]), (i, s))
    out = {}
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] != (i, s):
                gone.update(range(s, s + window))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """(words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many = Counter(windows)
    again = {k + d for k, w in enumerate(windows) if many[w] > 1 for d in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)
