"""Texts cut into units that a byte-level pre-tokenizer treats alike wherever they stand.

A unit is a piece between single blanks together with the blank before it. The pattern of byte-level vocabularies
looks behind nothing and never joins a non-blank to what follows a blank, so a unit's tokens don't depend on its
neighbours, unless white space meets the cut: texts with such a place, or with the vocabulary's special string,
are `whole` and take the slower way.
"""

from __future__ import annotations

import re

_MEETS = re.compile(r"\s (?:\s|\Z)")


def is_whole(text: str, specials: list[str]) -> bool:
    return _MEETS.search(text) is not None or any(s in text for s in specials)


def units(text: str) -> list[str]:
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]
