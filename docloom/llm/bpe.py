"""Byte-pair encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array. In a round the rank of each neighbouring pair is found by binary
search over the sorted pair keys, each word's lowest rank by a segmented minimum, and all occurrences of that pair in
the word are merged, leftmost first. Words without a pair left leave the array. A Python worker remembers the ids of
units it has met, so only new words go through the rounds.

Only vocabularies of the byte-level form that this implements are taken: any other file is refused before a row is read.

Edge cases: null texts are empty, empty texts have no ids; bytes that aren't UTF-8 count as U+FFFD; the vocabulary's special strings inside a text get their
own id, as the library does by default; rows are kept as they are, repeated or not; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docloom.llm.pieces import is_whole, units
from docloom.llm.shared import documents, id_and_text, map_chunks

NONE = np.int64(1 << 40)
MEMO = 800_000

#: Fixed pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+".replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(odd)}


def check_form(spec: dict) -> None:
    """Raises ValueError for a tokenizer file that the rounds below would not encode as its library does."""
    pre, model, decoder = spec.get("pre_tokenizer") or {}, spec["model"], spec.get("decoder") or {}
    faults = {
        "a normalizer": spec.get("normalizer"),
        "another pre-tokenizer than ByteLevel with its usual pattern": pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True),
        "another decoder than ByteLevel": decoder.get("type") != "ByteLevel",
        "another model than BPE": model.get("type") != "BPE",
        "options of its model": any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")),
        "special strings that take blanks or whole words": any(x.get(k) for x in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")),
    }
    found = [what for what, there in faults.items() if there]
    if found:
        raise ValueError(f"The tokenizer file has {', '.join(found)}")


class Vocabulary:
    """The tables of a byte-level BPE file: sorted pair keys with ranks and results, and each id's bytes."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check_form(spec)
        ids, letters = spec["model"]["vocab"], byte_letters()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left, right = (np.array([ids[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.result = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        self.of_byte = np.zeros(256, dtype=np.int64)
        for letter, byte in letters.items():
            self.of_byte[byte] = ids[letter]
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes = {i: bytes(letters[c] for c in t) for t, i in ids.items() if t not in self.specials} | {i: t.encode() for t, i in self.specials.items()}
        self.cut = regex.compile(PATTERN).findall

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit integers."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        sym = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(sym), NONE)
        inner = np.flatnonzero(word[:-1] == word[1:]) if len(word) else np.zeros(0, np.int64)
        rank[inner] = self.rank(sym[inner], sym[inner + 1])
        over: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[first, len(sym)])
            lowest = np.repeat(np.minimum.reduceat(rank, first), size)
            live = lowest < NONE
            if not live.all():
                over.append((word[~live], sym[~live]))
                sym, word, rank, lowest = sym[live], word[live], rank[live], lowest[live]
                if not len(sym):
                    break
            hit = rank == lowest
            if (hit[1:] & hit[:-1]).any():  # a run of equal symbols: every other one, from the left
                at = np.arange(len(hit))
                begun = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1] & (word[:-1] == word[1:])], at, 0))
                hit &= (at - begun) % 2 == 0
            where = np.flatnonzero(hit)
            sym[where] = self.result[lowest[where]]
            keep = np.ones(len(sym), dtype=bool)
            keep[where + 1] = False
            moved = np.cumsum(keep) - 1
            sym, word, rank = sym[keep], word[keep], rank[keep]
            stale = np.zeros(len(sym) + 1, dtype=bool)
            stale[moved[where]] = True
            stale[moved[where] - 1] = True  # a first symbol marks the spare place at the end
            changed = np.flatnonzero(stale[:-1])
            rank[changed] = NONE
            changed = changed[changed + 1 < len(sym)]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed] = self.rank(sym[changed], sym[changed + 1])
        if not over:
            return [b"" for _ in words]
        word, sym = (np.concatenate(x) for x in zip(*over, strict=True))
        ids = sym[np.argsort(word, kind="stable")].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
        return [ids[a:b] for a, b in itertools.pairwise([0, *ends])]


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@functools.cache
def memos_of(path: str) -> tuple[dict[str, bytes], dict[str, bytes]]:
    """Ids of the units and of the pre-tokens that this Python worker has met, for one tokenizer."""
    return {}, {}


class Encoder:
    """Ids of texts as little-endian 32-bit integers."""

    def __init__(self, path: str):
        self.vocab, (self.memo, self.words) = vocabulary(path), memos_of(path)

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.words]
        self.words.update(zip(new, self.vocab.encode([w.encode() for w in new]), strict=True))

    def _pretokens(self, text: str) -> list[str | int]:
        """Pre-tokens of a whole text, with the ids of special strings between them."""
        parts: list[str | int] = [text]
        for special, number in self.vocab.specials.items():
            parts = [y for x in parts for y in ([x] if isinstance(x, int) else [z for k, p in enumerate(x.split(special)) for z in ([number, p] if k else [p])])]
        return [y for x in parts for y in ([x] if isinstance(x, int) else self.vocab.cut(x))]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.memo) > MEMO or len(self.words) > MEMO:
            self.memo.clear()
            self.words.clear()
        odd = list(self.vocab.specials)
        parts = [None if is_whole(t, odd) else units(t) for t in texts]
        new = list(set(itertools.chain.from_iterable(p for p in parts if p)).difference(self.memo))
        cuts = [self.vocab.cut(u) for u in new]
        whole = {k: self._pretokens(t) for k, (t, p) in enumerate(zip(texts, parts, strict=True)) if p is None}
        self._learn({w for c in (*cuts, *whole.values()) for w in c if isinstance(w, str)})
        word = self.words.__getitem__
        self.memo.update((u, b"".join(map(word, c))) for u, c in zip(new, cuts, strict=True))
        unit = self.memo.__getitem__
        return [b"".join(x.to_bytes(4, "little") if isinstance(x, int) else word(x) for x in whole[k]) if p is None else b"".join(map(unit, p)) for k, p in enumerate(parts)]


def decode(path: str, ids: bytes) -> str:
    """The text of ids given as little-endian 32-bit integers."""
    return b"".join(map(vocabulary(path).bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


def bpe_round_trip(docs: DataFrame, tokenizer: str, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row; without `with_ids` their SHA-256 digests in place of both."""
    vocabulary(tokenizer)  # refuses other forms here, not in a task
    state: dict = {}

    def run(chunk: pa.RecordBatch) -> dict:
        ids = state.setdefault("encode", Encoder(tokenizer))(chunk.column("text").fill_null("").to_pylist())
        texts = [decode(tokenizer, x) for x in ids]
        out = {"doc_id": chunk.column("doc_id"), "n_tokens": [len(x) // 4 for x in ids]}
        if with_ids:
            return out | {"ids": [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in ids], "decoded": texts}
        sha = lambda x: hashlib.sha256(x).hexdigest()
        return out | {"ids_sha256": [sha(x) for x in ids], "decoded_sha256": [sha(x.encode("utf-8", "replace")) for x in texts]}

    rest = "ids array<int>, decoded string" if with_ids else "ids_sha256 string, decoded_sha256 string"
    return map_chunks(id_and_text(docs, id_col, text_col), run, f"doc_id long, n_tokens long, {rest}")


def op3_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
