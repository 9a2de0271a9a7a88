"""Removal of repeated word passages, found through difference-cover anchors.

A window of WINDOW consecutive words goes if its word sequence starts earlier somewhere: in a document of smaller id,
or earlier in the same document. Words that such windows cover are removed.

Anchors: the residues COVER hold, for every difference modulo PERIOD, two members that differ by it. So for any two
equal windows there is a shift below PERIOD that brings both starts to positions whose residues are in COVER, and the
ANCHOR = WINDOW - PERIOD + 1 words there lie in both. Only these positions are hashed:
1. Anchors of all texts meet by hash in compact blocks; a document gets back those of its anchors that occur elsewhere.
2. The match is extended around them: only windows that hold such an anchor are hashed whole and meet by that hash;
   the earliest occurrence stays, each other one is told to its document.
3. Documents cover the windows they were told of.
In both meetings the occurrences in one chunk of documents are reduced to one beforehand (the rest is told at once). Over
more than CHUNKS_AT_ONCE chunks they are reduced once more, among the chunks of one salt, so that a passage in a third of
all documents costs its key's task one row per salt. Hashes of windows are 128 bits wide, made of two independent hashes
of each word; those of anchors are shorter, as they only select.

Edge cases: null texts have no words; texts shorter than a window lose nothing; rows of one id and one text are one
document, each with its result; rows of one id and different texts are ordered by their windows' starts, ties losing
nothing; null ids come after all others; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.keyblocks import BLOCKS, KEY_BYTES, both, meet, number_of_parts, packed, replies
from docloom.llm.shared import CHUNK_BYTES, annotated, documents, flat_text, free_prefix, map_chunks, names_of, valid, written
from docloom.llm.wordflow import bounds, fits, mixed, windows, word_hashes

WINDOW, PERIOD = 20, 13
#: A perfect difference set modulo 13.
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
_SALT = np.uint64(0x8CB92BA72F3D8DD7)
LAST_ID = np.iinfo(np.int64).max
#: A document in blocks: its id, and a hash of its text to tell rows of one id apart.
RECORD = 12
FOUND = "doc_id long, mark int, found binary"
START_BYTES = 4
REPEATS = 1
#: Bytes of a window's hash, and the second half's salt.
KEY_WIDE = 16
_OTHER = np.uint64(0x2545F4914F6CDD1D)
#: Chunks of texts whose rows of one key meet in one task at once.
CHUNKS_AT_ONCE = 20_000


class Words:
    """The words of a chunk's texts, their hashes and bounds."""

    def __init__(self, column: pa.Array):
        self.data, offsets = flat_text(column)
        self.starts, self.ends, self.first = bounds(self.data, offsets)
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        self.counts = np.diff(self.first)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start in the text, hash) of every run of `length` words."""
        text, ok = fits(self.first, len(self.hashes), length)
        at = np.flatnonzero(ok)
        return text[at], at - self.first[text[at]], windows(self.hashes, length)[at]


def records_of(chunk: pa.RecordBatch) -> np.ndarray:
    ids, marks = (chunk.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "mark"))
    return np.hstack([np.ascontiguousarray(ids.astype("<i8")).view(np.uint8).reshape(-1, 8), np.ascontiguousarray(marks.astype("<i4")).view(np.uint8).reshape(-1, 4)])


def ids_of(records: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(records[:, :8]).view("<i8").ravel()


def ids_and_marks(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids_of(records), np.ascontiguousarray(records[:, 8:]).view("<i4").ravel()


def anchor_keys(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, key) of the anchors at cover positions, in texts that hold a window."""
    text, start, key = w.windows(ANCHOR)
    at = np.flatnonzero(np.isin(start % PERIOD, COVER) & (w.counts[text] >= WINDOW))
    return text[at], start[at], key[at]


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each group's first occurrence, whether each row's key occurs twice or more)."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order] = np.r_[False, same] | np.r_[same, False] if len(order) else False
    return order[np.r_[True, ~same]] if len(order) else order, again


def gathered(blocks: DataFrame, parts: int, width: int) -> DataFrame:
    """One row per document with the distinct values that it was told, `width` bytes each; its own text bounds them."""

    def met(values: np.ndarray, flags: np.ndarray, docs: np.ndarray, records: np.ndarray) -> dict:
        ids, marks = ids_and_marks(records)
        ids, marks = ids[docs], marks[docs]
        order = np.lexsort((values, marks, ids))
        ids, marks, values = ids[order], marks[order], values[order]
        other = (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])
        keep = np.r_[True, other | (values[1:] != values[:-1])]
        ids, marks, values = ids[keep], marks[keep], values[keep]
        start = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])])
        raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
        ends = np.r_[start, len(ids)].tolist()
        return {"doc_id": ids[start], "mark": marks[start], "found": [raw[width * a : width * b] for a, b in zip(ends, ends[1:])]}

    return meet(blocks, parts, RECORD, met, FOUND, key_bytes=width)


def values_of(cell: bytes | None, width: int) -> np.ndarray:
    """The values of a `found`, ascending."""
    own = np.frombuffer(cell or b"", np.uint8).reshape(-1, width)
    eight = np.zeros((len(own), 8), np.uint8)
    eight[:, :width] = own
    return eight.view("<u8").ravel()


def dealt(keys: np.ndarray, records: np.ndarray, parts: int, salts: int) -> np.ndarray:
    """Where a chunk's keys (an integer of each) go: by key alone, or by key and the chunk's salt."""
    if salts > 1:
        keys = mixed(keys ^ mixed(mixed(np.ascontiguousarray(records[:1, :8]).view("<u8").ravel()) % np.uint64(salts)))
    return (keys >> np.uint64(40)) % np.uint64(parts)


def anchored(texts: DataFrame, parts: int, salts: int = 1) -> DataFrame:
    """Step 1: FOUND rows with the keys (their low bytes) of a document's anchors that occur twice."""
    wide = KEY_BYTES if salts == 1 else 8  # a partition dealt by the key alone holds the upper bytes in its number

    def reduced(key: np.ndarray, flags: np.ndarray, docs: np.ndarray, records: np.ndarray, salts: int) -> dict:
        """One row of each key, and replies to the documents of those that occur again."""
        first, again = groups(key)
        first.sort()
        out = packed(key[first], (again[first] | (flags[first] == REPEATS)).astype(np.uint8) * REPEATS, docs[first], records, parts, wide, dealt(key[first], records, parts, salts))
        tell = np.flatnonzero(again & (flags != REPEATS))
        return both(out, replies(key[tell], docs[tell], records, parts, KEY_BYTES))

    def run(chunk: pa.RecordBatch) -> dict | None:
        w, records = Words(chunk.column("text")), records_of(chunk)
        text, _, key = anchor_keys(w)
        return reduced(key, np.zeros(len(key), np.uint8), text, records, salts) if len(key) else None

    def met(keys: np.ndarray, flags: np.ndarray, docs: np.ndarray, records: np.ndarray) -> dict | None:
        _, again = groups(keys)
        tell = np.flatnonzero(again & (flags != REPEATS))
        return replies(keys[tell], docs[tell], records, parts, KEY_BYTES) if len(tell) else None

    blocks = map_chunks(texts, run, BLOCKS)
    if salts > 1:
        blocks = meet(blocks, parts, RECORD, lambda *own: reduced(*own, 1), BLOCKS, key_bytes=wide, forward=True)
    return gathered(meet(blocks, parts, RECORD, met, BLOCKS, key_bytes=wide, forward=True), parts, KEY_BYTES)


def candidates(w: Words, found: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, key) of the windows that hold an anchor told of."""
    text, start, key = anchor_keys(w)
    low = key & np.uint64((1 << (8 * KEY_BYTES)) - 1)
    hit = np.zeros(len(key), bool)
    begin = np.searchsorted(text, np.arange(len(w.counts) + 1)).tolist()
    for k, cell in enumerate(found):
        if cell:
            own, told = low[begin[k] : begin[k + 1]], values_of(cell, KEY_BYTES)
            hit[begin[k] : begin[k + 1]] = told[np.minimum(np.searchsorted(told, own), len(told) - 1)] == own
    text, start = text[hit], start[hit]
    size = len(w.hashes) + 1
    change = np.bincount(w.first[text] + np.maximum(0, start - (WINDOW - ANCHOR)), minlength=size) - np.bincount(w.first[text] + start + 1, minlength=size)
    near = np.cumsum(change[:-1]) > 0
    text, start, key = w.windows(WINDOW)
    at = np.flatnonzero(near[w.first[text] + start])
    other = windows(word_hashes(w.data, w.starts, w.ends, _OTHER), WINDOW)
    wide = np.stack([mixed(key[at] ^ _SALT), other[w.first[text[at]] + start[at]]], axis=1)
    return text[at], start[at], np.ascontiguousarray(wide.astype("<u8")).view(np.uint8).reshape(-1, KEY_WIDE)


def halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two integers of each wide key."""
    two = np.ascontiguousarray(keys).view("<u8").reshape(-1, 2)
    return two[:, 0], two[:, 1]


def later(ids: np.ndarray, starts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which occurrences have an earlier one of the same wide key."""
    a, b = halves(keys)
    order = np.lexsort((starts, ids, b, a))
    ids, starts, a, b = ids[order], starts[order], a[order], b[order]
    head = np.maximum.accumulate(np.where(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])], np.arange(len(a)), 0))
    out = np.zeros(len(keys), bool)
    out[order] = (ids != ids[head]) | (starts != starts[head])
    return out


def repeated(texts: DataFrame, parts: int, salts: int = 1) -> DataFrame:
    """Step 2: FOUND rows with the starts of a document's windows that occur earlier."""

    def reduced(key: np.ndarray, starts: np.ndarray, docs: np.ndarray, records: np.ndarray, salts: int) -> dict:
        """The earliest occurrence of each key, and replies to the documents of the others."""
        late = later(ids_of(records)[docs], starts, key)
        out = packed(key[~late], starts[~late].astype("<u4"), docs[~late], records, parts, key_bytes=KEY_WIDE, part=dealt(halves(key[~late])[0], records, parts, salts))
        return both(out, replies(starts[late], docs[late], records, parts, START_BYTES))

    def run(chunk: pa.RecordBatch) -> dict | None:
        w, records = Words(chunk.column("text")), records_of(chunk)
        text, start, key = candidates(w, chunk.column("found").to_pylist())
        return reduced(key, start, text, records, salts) if len(key) else None

    def met(keys: np.ndarray, starts: np.ndarray, docs: np.ndarray, records: np.ndarray) -> dict | None:
        late = np.flatnonzero(later(ids_of(records)[docs], starts, keys))
        return replies(starts[late], docs[late], records, parts, START_BYTES) if len(late) else None

    blocks = map_chunks(texts, run, BLOCKS)
    if salts > 1:
        blocks = meet(blocks, parts, RECORD, lambda *own: reduced(*own, 1), BLOCKS, kind="<u4", key_bytes=KEY_WIDE, forward=True)
    return gathered(meet(blocks, parts, RECORD, met, BLOCKS, kind="<u4", key_bytes=KEY_WIDE, forward=True), parts, START_BYTES)


def kept_words(w: Words, found: list[bytes | None]) -> tuple[list[int], list[bytes]]:
    """(words removed, what is left joined by one blank) of each text."""
    change = np.zeros(len(w.hashes) + 1, np.int64)
    for k, cell in enumerate(found):
        if cell:
            at = values_of(cell, START_BYTES).astype(np.int64) + w.first[k]
            change[at] += 1
            change[at + WINDOW] -= 1
    gone = np.cumsum(change[:-1]) > 0
    counts = np.diff(np.r_[0, np.cumsum(gone)][w.first]).tolist()
    data = w.data.tobytes()
    words = [data[a:b] for a, b in zip(w.starts[~gone].tolist(), w.ends[~gone].tolist(), strict=True)]
    ends = np.r_[0, np.cumsum(~gone)][w.first].tolist()
    return counts, [b" ".join(words[a:b]) for a, b in zip(ends, ends[1:])]


def keys_of(id_col: str, text_col: str) -> list[Column]:
    """(doc_id, mark, text) by which a document's rows meet."""
    text = F.coalesce(valid(F.col(f"`{text_col}`")), F.lit(""))
    return [F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("doc_id"), F.hash(text).alias("mark"), text.alias("text")]


def late_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int | None = None) -> DataFrame:
    """(doc_id, mark, found): the starts of the windows of each document that occur earlier, written. `salts`: how many share a key's rows before they meet (by the amount of text)."""
    texts = docs.select(*keys_of(id_col, text_col))
    size = int(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    parts, salts = number_of_parts(size // 12), salts or max(1, -(-size // (CHUNK_BYTES * CHUNKS_AT_ONCE)))
    anchors = written(anchored(texts, parts, salts), "anchors")
    return written(repeated(texts.join(anchors, ["doc_id", "mark"]), parts, salts), "late")


def substring_dedup(docs: DataFrame, digest_only: bool = False, id_col: str = "doc_id", text_col: str = "text", salts: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; with `digest_only` kept_sha256 in place of the text left."""
    late = late_windows(docs, id_col, text_col, salts)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("own_id"), *keys_of(id_col, text_col))

    def run(chunk: pa.RecordBatch) -> dict:
        w = Words(chunk.column("text"))
        gone, kept = kept_words(w, chunk.column("found").to_pylist())
        out = {"doc_id": chunk.column("own_id"), "n_words": w.counts, "n_removed": gone}
        return out | ({"kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept]} if digest_only else {"kept": [x.decode() for x in kept]})

    last = "kept_sha256 string" if digest_only else "kept string"
    return map_chunks(rows.join(late, ["doc_id", "mark"], "left"), run, f"doc_id long, n_words long, n_removed long, {last}")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with the words left in place of their text, unchanged where nothing was removed; rows that nothing is left of go."""
    late = late_windows(docs, id_col, text_col)
    at = free_prefix(docs, "late_")
    late = late.select(*[F.col(c).alias(at + c) for c in late.columns])
    number, mark, _ = keys_of(id_col, text_col)
    rows = docs.withColumns({f"{at}number": number, f"{at}key": mark}).join(late, (F.col(f"{at}number") == F.col(f"{at}doc_id")) & (F.col(f"{at}key") == F.col(f"{at}mark")), "left")

    def run(chunk: pa.RecordBatch) -> dict:
        w = Words(chunk.column(chunk.schema.get_field_index(text_col)))
        gone, kept = kept_words(w, chunk.column(chunk.schema.get_field_index(f"{at}found")).to_pylist())
        return {"kept": [x.decode("utf-8", "replace") if n else None for n, x in zip(gone, kept, strict=True)]}

    found, own = annotated(rows, run, "kept string", text_col)
    kept = F.coalesce(F.col(f"{own}kept"), F.col(f"`{text_col}`")).alias(text_col)
    return found.where(f"{own}kept is null or {own}kept <> ''").select(*[kept if c == text_col else column for c, column in zip(docs.columns, names_of(docs), strict=True)])


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir), digest_only=True)


OP8_SQL = r"""
with words as (select cast(doc_id as bigint) as doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
spots as (select doc_id, unnest(range(1, len(w) - 18)) as i, w from words where len(w) >= 20),
sequences as (select doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) as s from spots),
late as (select doc_id, i from (select doc_id, i, row_number() over (partition by s order by doc_id, i) as k from sequences) where k > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as i from late),
lists as (select doc_id, list(i) as g from gone group by doc_id)
select words.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(g), 0) as bigint) as n_removed,
       sha256(case when g is null then array_to_string(w, ' ')
              else array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: not list_contains(g, i)), lambda i: w[i]), ' ') end) as kept_sha256
from words left join lists using (doc_id)
"""
