"""N-gram Jaccard join by universe partition and pigeonhole, and the classes of linked documents.

A document's set is its distinct 5-word shingles. Sets fall into size bands so that a partner lies in the same band or
the next. On a band's level the shingle universe is dealt by hash into m segments; two sets that link differ in at
most H = (sizes' sum) / 9 shingles, so if a set is allowed v_i = 1 (equal subset) or v_i = 2 (equal, or one deletion
apart) in segment i and the v_i add up to H + 1, the partner matches it in some segment. What m is, and whether the
band uses one-deletion neighbourhoods, follows from estimated costs (keys emitted against probes of segments that hold
next to nothing); each set then skips, as far as its slack goes, the segments with the smallest subsets, which are the
ones that many sets share.

Keys meet in compact blocks (`keyblocks`). Groups of equal keys never turn into all pairs:
1. Equal sets are one node from the start.
2. In each group of a key every member is paired with a leader only, first within a chunk of documents, whose leader
   alone travels on; every node keeps the two leaders it shares most keys with. These pairs are verified on the texts' shingles, and verified links give components.
3. Nodes that met any other are keyed again, now with their component. In groups that hold several components each
   member outside the largest is paired with the member of it that it lies nearest to by parity sketches; again links
   join components. A group with very many such pairs is cut into tiles that Spark deals to many tasks.
4. Once more, now all pairs between members of the smaller components and the others, but for those that an exact bound
   excludes: sets differ in at least as many shingles as bits differ between their sketches. The rest is verified.
A pair that links is thus verified, or its ends already share a component.

Edge cases: null and empty texts have 0 shingles and are linked with nothing; texts of fewer words than a shingle are
one sequence; repeated rows share a component; rows of one id with different texts are documents of their own, each in
the component that its text links to; a row with null id gets null; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.components import components
from docloom.llm.keyblocks import BLOCKS, both, fixed, meet, node_numbers, number_of_parts, packed, replies
from docloom.llm.shared import broadcast_if_small, chunks, documents, flat_text, free_prefix, id_and_text, map_chunks, names_of, valid, with_values, written
from docloom.llm.wordflow import LOWER, bounds, fits, joined, mixed, windows, word_hashes

SHINGLE = 5
#: Leaders that a node is verified against at first.
LEADERS = 2
SKETCH_BITS = 512
#: Cost of probing one segment with an all but empty subset, in keys.
PROBE_COST = 50.0
LEAST = 4
_LEVEL, _TWO, _THREE = (np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
_LOW = np.uint64(0xFFFFFFFF)
ONE_DELETION, PROBES = 1, 2
#: A leader told to a member: its node and the keys they share.
TOLD = 20
#: Bytes of a labelled node's record: node, size, root and sketch.
LABELLED = 36 + SKETCH_BITS // 8
#: Pairs compared at a time; pairs of a key's group beyond which it is dealt out in tiles of so many rows.
PAIRS_AT_ONCE, TILE_PAIRS, TILE_REST, TILE_OTHERS = 200_000, 1 << 24, 1 << 12, 1 << 12
#: Bits of the map that tells which nodes met others (16 MB).
BITMAP = 1 << 27
#: Pairs of one leader that a task verifies, about.
MANY = 500


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the distinct shingles of each text, in ascending order, and where each text's begin."""
    data, offsets = flat_text(column)
    data = LOWER[data]
    starts, ends, first = bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    text, ok = fits(first, len(words), size)
    at = np.flatnonzero(ok)
    found, owner = windows(words, size)[at], text[at]
    counts = np.diff(first)
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            own = words[first[short]]
            for k in range(1, n):
                own = joined(own, words[first[short] + k])
            found, owner = np.r_[found, mixed(own + np.uint64(n))], np.r_[owner, short]
    order = np.argsort(found)
    order = order[np.argsort(owner[order].astype(np.uint16 if len(counts) < 1 << 16 else np.int64), kind="stable")]
    found, owner = found[order], owner[order]
    new = np.r_[True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])] if len(found) else np.zeros(0, bool)
    return found[new], np.searchsorted(owner[new], np.arange(len(counts) + 1))


def totals(values: np.ndarray, cell: np.ndarray, cells: int) -> np.ndarray:
    """Sums of 64-bit values by cell, modulo 2^64 (each half is exact in a double up to 2^21 values)."""
    low = np.bincount(cell, (values & _LOW).astype(np.float64), minlength=cells).astype(np.uint64)
    high = np.bincount(cell, (values >> np.uint64(32)).astype(np.float64), minlength=cells).astype(np.uint64)
    return low + (high << np.uint64(32))


def digests(found: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16 bytes that stand for each set, (sets, 16)."""
    n = len(first) - 1

    def sums(values: np.ndarray) -> np.ndarray:
        upto = np.r_[np.uint64(0), np.cumsum(values, dtype=np.uint64)]
        return upto[first[1:]] - upto[first[:-1]]

    two = np.stack([sums(mixed(found)), sums(mixed(found * _TWO + _THREE)) ^ np.diff(first).astype(np.uint64)], axis=1)
    return np.ascontiguousarray(two.astype(">u8")).view(np.uint8).reshape(n, 16)


def sketches(found: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Parity bits of each set: how many shingles, modulo 2, hash to each of SKETCH_BITS places; (sets, bytes)."""
    n = len(first) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    spot = (mixed(found + _THREE) >> np.uint64(40)).astype(np.int64) % SKETCH_BITS
    bits = np.bincount(owner * SKETCH_BITS + spot, minlength=n * SKETCH_BITS).reshape(n, SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8), axis=1)


@functools.cache
def bands() -> np.ndarray:
    """The least size of each band; a band ends where 4/5 of a size would fall below its least one."""
    out = [LEAST]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 5 // 4 + 1)
    return np.array(out, dtype=np.int64)


def differ(size: np.ndarray) -> np.ndarray:
    """The most shingles in which a set of this size can differ from a partner."""
    return (size + size * 5 // 4) // 9


@functools.cache
def level_plan(level: int) -> tuple[int, int]:
    """(segments, depth) of a level with the least estimated cost for a set of middling size."""
    low, high = int(bands()[level]), int(bands()[level + 1]) - 1
    need, size, best = int(differ(np.int64(high))) + 1, (low + high) / 2, None
    for depth in (1, 2):
        for slack in sorted({*range(0, 6), *(need * k // 50 for k in range(1, 16))}):
            m = -(-(need + depth * slack) // depth)
            each = size / m
            bare = m * np.exp(-each) * (1 + each)  # segments with one shingle or none
            cost = m + (size if depth == 2 else 0) + PROBE_COST * max(0.0, bare - (depth * m - need) / depth)
            if best is None or cost < best[0]:
                best = (cost, m, depth)
    return best[1], best[2]


def level_keys(found: np.ndarray, first: np.ndarray, level: np.ndarray, home: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, flags, set) of the sets on the given levels (below 0: none)."""
    sizes = np.diff(first)
    sets = np.flatnonzero(level >= 0)
    if not len(sets):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64)
    plans = np.array([level_plan(int(x)) for x in level[sets]], dtype=np.int64)
    m, depth, size = plans[:, 0], plans[:, 1], sizes[sets]
    at = np.repeat(first[sets] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    own = np.repeat(np.arange(len(sets)), size)
    value = mixed(found[at] + level[sets][own].astype(np.uint64) * _LEVEL)
    base = np.r_[0, np.cumsum(m)]
    cell = base[own] + (((value >> np.uint64(32)) * m[own].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    value = mixed(value * _TWO)
    total, count = totals(value, cell, int(base[-1])), np.bincount(cell, minlength=int(base[-1]))
    owner = np.repeat(np.arange(len(sets)), m)
    salt = joined((np.arange(base[-1]) - base[owner]).astype(np.uint64), level[sets][owner].astype(np.uint64))
    allowed = depth[owner]
    if home:  # skip the smallest subsets as far as the slack goes
        order = np.lexsort((count, owner))
        rank = np.arange(len(owner)) - base[owner]
        slack = depth * m - (differ(size) + 1)
        left = np.maximum(0, slack[owner] - rank * allowed)  # ranks ascend within each owner, as does `order`
        allowed_sorted = np.maximum(0, allowed - left)
        allowed = np.empty_like(allowed_sorted)
        allowed[order] = allowed_sorted
    else:
        allowed = np.zeros_like(allowed)
    keys, flags, which = joined(total, salt), (allowed >= 1) * PROBES, owner
    deep = np.flatnonzero(depth[own] == 2)
    if len(deep):
        c = cell[deep]
        keys = np.r_[keys, joined(total[c] - value[deep], salt[c])]
        flags = np.r_[flags, (allowed[c] == 2) * PROBES + ONE_DELETION]
        which = np.r_[which, own[deep]]
    return keys, flags, sets[which]


def all_keys(found: np.ndarray, first: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each set on its own level and, as what others look for, on the level below."""
    sizes = np.diff(first)
    level = np.searchsorted(bands(), sizes, side="right") - 1
    level[skip | (sizes < LEAST)] = -1
    got = [level_keys(found, first, level, True), level_keys(found, first, level - 1, False)]
    keys, flags, which = (np.concatenate(x) for x in zip(*got, strict=True))
    order = np.argsort(which, kind="stable")
    return keys[order], flags[order], which[order]


def first_of(nodes: np.ndarray) -> np.ndarray:
    """Which rows repeat the node of an earlier row."""
    number, _ = node_numbers(nodes)
    seen = np.ones(len(number), bool)
    seen[np.unique(number, return_index=True)[1]] = False
    return seen


class Groups:
    """Groups of equal keys with two nodes or more, one of them with its whole subset and one that probes."""

    def __init__(self, keys: np.ndarray, flags: np.ndarray, docs: np.ndarray, records: np.ndarray):
        self.number, self.sample = node_numbers(records)
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        order = order[np.r_[False, same] | np.r_[same, False]] if len(order) else order
        node, flag, row = self.number[docs[order]], flags[order], order
        start = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]]) if len(order) else np.zeros(0, np.int64)
        if len(start):
            whole, probing = np.logical_or.reduceat(flag & ONE_DELETION == 0, start), np.logical_or.reduceat(flag & PROBES > 0, start)
            live = whole & probing & (np.minimum.reduceat(node, start) != np.maximum.reduceat(node, start))
            size = np.diff(np.r_[start, len(order)])
            keep = np.repeat(live, size)
            node, flag, row, size = node[keep], flag[keep], row[keep], size[live]
            start = np.cumsum(size) - size
        else:
            size = start
        self.node, self.flag, self.row, self.start, self.size = node, flag, row, start, size

    def __len__(self) -> int:
        return len(self.start)

    def leaders(self) -> np.ndarray:
        """Each group's leader: the first node, whole subsets before others, those that probe before others."""
        n = np.int64(len(self.sample))
        rank = self.node + np.where(self.flag & ONE_DELETION, 2 * n, 0) + np.where(self.flag & PROBES, 0, n)
        return np.minimum.reduceat(rank, self.start) % n

    def told(self, leader: np.ndarray, nodes: np.ndarray, parts: int) -> dict[str, list]:
        """Blocks that tell each member its groups' leaders, and a leader itself."""
        n = np.int64(len(self.sample))
        pair, shared = np.unique(self.node * n + np.repeat(leader, self.size), return_counts=True)
        own = np.ascontiguousarray(nodes[self.sample, :16])
        return replies(np.hstack([own[pair % n], shared.astype("<u4").view(np.uint8).reshape(-1, 4)]), pair // n, own, parts, TOLD)


def combined(keys: np.ndarray, flags: np.ndarray, which: np.ndarray, records: np.ndarray, parts: int) -> dict | None:
    """Key blocks of a chunk in which each group that is complete in itself is told its leader at once and sends only that."""
    g = Groups(keys, flags, which, records)
    keep, flags = np.ones(len(keys), bool), flags.copy()
    if len(g):
        leader = g.leaders()
        keep[g.row] = False
        at = g.row[(g.node == np.repeat(leader, g.size)) & (g.flag & ONE_DELETION == 0)]
        keep[at], flags[at] = True, PROBES  # stands for all members, one of which probes
    out = packed(keys[keep], flags[keep], which[keep], records, parts)
    return both(out, g.told(leader, records, parts)) if len(g) else out


def keyed(texts: DataFrame, parts: int, labelled: bool = False) -> DataFrame:
    """BLOCKS of rows (doc_id, text), or of (node, root, text): a record is the node and its size, then root and sketch."""

    def run(chunk: pa.RecordBatch) -> dict | None:
        found, first = shingles(chunk.column("text"))
        nodes = digests(found, first)
        records = [nodes, np.diff(first).astype("<u4").view(np.uint8).reshape(-1, 4)]
        if labelled:
            records += [np.frombuffer(b"".join(chunk.column("root").to_pylist()), np.uint8).reshape(-1, 16), sketches(found, first)]
        keys, flags, which = all_keys(found, first, first_of(nodes))
        if not len(keys):
            return None
        return (packed if labelled else combined)(keys, flags.astype(np.uint8), which, np.hstack(records), parts)

    return map_chunks(texts, run, BLOCKS)


PAIRS = "a binary, b binary, score long"


def leaders(keys: np.ndarray, flags: np.ndarray, docs: np.ndarray, records: np.ndarray, parts: int) -> dict | None:
    """The groups in a partition: each member is told its leader."""
    g = Groups(keys, flags, docs, records)
    return g.told(g.leaders(), records, parts) if len(g) else None


def best_leaders(told: np.ndarray, flags: np.ndarray, docs: np.ndarray, records: np.ndarray, nearest: bool = False) -> dict:
    """(member, leader, score): of each member the LEADERS leaders it shares most keys with, or itself if it only leads; with `nearest` those of least score."""
    every = np.vstack([records[docs], told[:, :16]])
    number, sample = node_numbers(every)
    n, m = np.int64(len(sample)), len(docs)
    pair, inverse = np.unique(number[:m] * n + number[m:], return_inverse=True)
    given = np.ascontiguousarray(told[:, 16:]).view("<u4").ravel()
    if nearest:
        score = np.full(len(pair), np.iinfo(np.int64).max)
        np.minimum.at(score, inverse, given.astype(np.int64))
    else:
        score = -np.bincount(inverse, given).astype(np.int64)
    a, b = pair // n, pair % n
    score[a == b] = np.iinfo(np.int64).max
    order = np.lexsort((b, score, a))
    a, b, score = a[order], b[order], score[order]
    keep = np.arange(len(a)) - np.searchsorted(a, a) < LEADERS
    nodes = every[sample]
    return {"a": fixed(nodes[a[keep]]), "b": fixed(nodes[b[keep]]), "score": score[keep]}


class Labelled:
    """Labelled nodes, by their records: node, size, root, sketch."""

    def __init__(self, records: np.ndarray):
        self.nodes = np.ascontiguousarray(records[:, :16])
        self.size = np.ascontiguousarray(records[:, 16:20]).view("<u4").ravel().astype(np.int64)
        self.root, _ = node_numbers(records[:, 20:36])
        self.sketch = np.ascontiguousarray(records[:, 36:]).view("<u8")

    def far(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.sketch[p] ^ self.sketch[q]).sum(axis=1, dtype=np.int64)

    def near(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether pairs may link: nine times the shingles in which they differ at least is not above the sum of their sizes."""
        return 9 * np.maximum(self.far(p, q), np.abs(self.size[p] - self.size[q])) <= self.size[p] + self.size[q]

    def pairs(self, rest: np.ndarray, whole_rest: np.ndarray, others: np.ndarray, whole_others: np.ndarray, begin: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs that may link, in pieces: row k of `rest` with the `count[k]` rows of `others` from `begin[k]` on. A pair needs another root, and one of both with its whole subset."""
        upto = np.cumsum(count)
        for a in range(0, int(upto[-1]) if len(upto) else 0, PAIRS_AT_ONCE):
            place = np.arange(a, min(a + PAIRS_AT_ONCE, int(upto[-1])))
            k = np.searchsorted(upto, place, side="right")
            j = begin[k] + place - (upto[k] - count[k])
            p, q = rest[k], others[j]
            ok = (self.root[p] != self.root[q]) & (whole_rest[k] | whole_others[j])
            p, q = p[ok], q[ok]
            ok = self.near(p, q)
            yield p[ok], q[ok]


class Parted:
    """A partition's groups of labelled nodes that hold several components, as rows in order of the groups."""

    def __init__(self, keys: np.ndarray, flags: np.ndarray, docs: np.ndarray, records: np.ndarray):
        g = Groups(keys, flags, docs, records)
        self.of = Labelled(records[g.sample])
        n = np.int64(len(g.sample))
        code = np.repeat(np.arange(len(g)), g.size) * n + g.node
        order = np.argsort(code, kind="stable")
        code, whole = code[order], (g.flag & ONE_DELETION == 0)[order]
        start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
        group, node = np.divmod(code[start], n) if len(code) else (start, start)
        whole = np.logical_or.reduceat(whole, start) if len(code) else np.zeros(0, bool)
        names, counts = np.unique(group * n + self.of.root[node], return_counts=True)
        owner, name = np.divmod(names, n) if len(names) else (names, names)
        largest = np.zeros(len(g), np.int64)
        order = np.lexsort((-name, counts, owner))
        largest[owner[order]] = name[order]  # the last of each group: the largest, the first of several
        live = np.bincount(owner, minlength=len(g)) > 1
        keep = live[group] if len(group) else np.zeros(0, bool)
        self.group, self.node, self.whole = group[keep], node[keep], whole[keep]
        self.main = self.of.root[self.node] == largest[self.group]

    def work(self, others_of_all: bool, tile_pairs: int) -> tuple[list[np.ndarray], list[tuple[np.ndarray, ...]]]:
        """(arguments of `Labelled.pairs` for the groups to compare here, (rest, whole, partners, whole) of those so large that they are dealt out)."""
        partner = np.ones(len(self.node), bool) if others_of_all else self.main
        rest, others = np.flatnonzero(~self.main), np.flatnonzero(partner)
        begin, end = (np.searchsorted(self.group[others], self.group[rest], side=x) for x in ("left", "right"))
        load = np.bincount(self.group[rest], end - begin) if len(rest) else np.zeros(0)
        large = load[self.group[rest]] > tile_pairs if len(rest) else np.zeros(0, bool)
        tiles = []
        for k in np.unique(self.group[rest[large]]).tolist():
            x, y = rest[self.group[rest] == k], others[self.group[others] == k]
            tiles += [tuple(t[c] for c in (x[i : i + TILE_REST], y[j : j + TILE_OTHERS]) for t in (self.node, self.whole)) for i in range(0, len(x), TILE_REST) for j in range(0, len(y), TILE_OTHERS)]
        here = rest[~large]
        return [self.node[here], self.whole[here], self.node[others], self.whole[others], begin[~large], (end - begin)[~large]], tiles


def told_nearest(of: Labelled, pairs: Iterator[tuple[np.ndarray, np.ndarray]], parts: int) -> dict | None:
    """Each node is told the partner that its sketch lies nearest to."""
    n = len(of.nodes)
    best = np.full(n, np.iinfo(np.int64).max)
    for p, q in pairs:
        np.minimum.at(best, p, of.far(p, q) * n + q)
    a = np.flatnonzero(best < np.iinfo(np.int64).max)
    if not len(a):
        return None
    far, b = np.divmod(best[a], n)
    return replies(np.hstack([of.nodes[b], far.astype("<u4").view(np.uint8).reshape(-1, 4)]), a, of.nodes, parts, TOLD)


def told_all(of: Labelled, pairs: Iterator[tuple[np.ndarray, np.ndarray]], parts: int) -> dict | None:
    """Of each pair, one is told the other."""
    n = np.int64(len(of.nodes) + 1)
    out = [np.unique(np.minimum(p, q) * n + np.maximum(p, q)) for p, q in pairs if len(p)]
    if not out:
        return None
    code = np.unique(np.concatenate(out))
    return replies(of.nodes[code % n], code // n, of.nodes, parts, 16)


def compared(labelled: DataFrame, parts: int, others_of_all: bool, tell: Callable[..., dict | None], tile_pairs: int = TILE_PAIRS) -> DataFrame:
    """BLOCKS of what `tell` tells of the pairs that may link: members of a key's group outside its largest component, with those in it, or with all of other components.

    A group whose pairs are many becomes tiles, each a row of the shuffle: `part` below 0, the two sides' records in place
    of keys and records, whether they are whole in place of flags and counts. So one key's work is dealt to many tasks.
    """

    def run(keys: np.ndarray, flags: np.ndarray, docs: np.ndarray, records: np.ndarray) -> dict | None:
        w = Parted(keys, flags, docs, records)
        here, tiles = w.work(others_of_all, tile_pairs)
        found = tell(w.of, w.of.pairs(*here), parts)
        if not tiles:
            return found
        own = records[node_numbers(records)[1]]
        rows = {"part": [], "keys": [], "flags": [], "counts": [], "records": []}
        for k, (x, whole_x, y, whole_y) in enumerate(tiles):
            for c, v in zip(rows, (-1 - k, own[x].tobytes(), whole_x.tobytes(), whole_y.tobytes(), own[y].tobytes()), strict=True):
                rows[c].append(v)
        return rows if found is None else both(found, rows)

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            local = pc.greater_equal(batch.column("part"), 0)
            yield batch.filter(local)
            for row in batch.filter(pc.invert(local)).to_pylist():
                x, y = (np.frombuffer(row[c], np.uint8).reshape(-1, LABELLED) for c in ("keys", "records"))
                whole_x, whole_y = (np.frombuffer(row[c], bool) for c in ("flags", "counts"))
                of = Labelled(np.vstack([x, y]))
                out = tell(of, of.pairs(np.arange(len(x)), whole_x, np.arange(len(x), len(x) + len(y)), whole_y, np.zeros(len(x), np.int64), np.full(len(x), len(y))), parts)
                if out is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in batch.schema], schema=batch.schema)

    met = meet(labelled, parts, LABELLED, run, BLOCKS)
    dealt = met.repartition(F.when(F.col("part") < 0, F.xxhash64("part", "counts", F.length("records"))).otherwise(F.col("part")))
    return dealt.mapInArrow(tile, BLOCKS)


def distinct_pairs(told: np.ndarray, flags: np.ndarray, docs: np.ndarray, records: np.ndarray) -> dict:
    """Each pair once."""
    every = np.vstack([records[docs], told])
    number, sample = node_numbers(every)
    n, nodes = np.int64(len(sample)), every[sample]
    pair = np.unique(number[: len(docs)] * n + number[len(docs) :])
    return {"a": fixed(nodes[pair // n]), "b": fixed(nodes[pair % n]), "score": np.zeros(len(pair), np.int64)}


def common_counts(x: np.ndarray, y: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many of x each set (y, first) holds; both ascending and distinct."""
    at = np.minimum(np.searchsorted(x, y), max(len(x) - 1, 0))
    hit = x[at] == y if len(x) else np.zeros(len(y), bool)
    return np.diff(np.r_[0, np.cumsum(hit)][first])


def linked(pairs: DataFrame, texts: DataFrame, many: int = MANY) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets have an intersection of at least 80 % of their union.

    A row holds one text. The texts of a's that name the same b meet b's text in one partition, b's first, so that its
    shingles are found once. A b that many name is dealt to several salts, its text once for each.
    """
    one = pairs.select("a", "b").distinct()
    often = written(one.groupBy("b").agg(F.count("*").alias("n")).where(F.col("n") > many), "often")
    one = one.join(broadcast_if_small(often), "b", "left")
    salt = F.coalesce(F.pmod(F.xxhash64("a"), F.floor(F.col("n") / many) + 1), F.lit(0)).cast("long")
    one = written(one.select("a", "b", salt.alias("salt")), "pairs")
    sides = [one.select("b", "salt", "a"), one.select("b", "salt", F.lit(None).cast("binary").alias("a")).distinct()]
    text = likely_of(texts.select("node", "text"), one.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    # merged at every size, so that a small run shows what a large one does
    rows = sides[0].hint("merge").join(text, sides[0]["a"] == text["node"]).unionByName(sides[1].hint("merge").join(text, sides[1]["b"] == text["node"])).select("b", "salt", "a", "text")
    rows = rows.repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())
    target = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, np.uint64)
        for chunk in chunks(batches):
            found, first = shingles(chunk.column("text"))
            heads = set(np.flatnonzero(chunk.column("a").is_null().to_numpy(zero_copy_only=False)).tolist())
            cuts = sorted({0, *heads, chunk.num_rows})
            ok = []
            for i, j in zip(cuts, cuts[1:]):
                if i in heads:
                    own = found[first[i] : first[i + 1]]
                    i += 1
                if i < j:
                    sizes = np.diff(first[i : j + 1])
                    common = common_counts(own, found[first[i] : first[j]], first[i : j + 1] - first[i])
                    ok += (i + np.flatnonzero(100 * common >= 80 * (len(own) + sizes - common))).tolist()
            if ok:
                yield pa.RecordBatch.from_arrays([chunk.column(c).take(pa.array(ok)) for c in ("a", "b")], schema=target)

    return rows.mapInArrow(run, "a binary, b binary")


def text_mark(text_col: str = "text") -> Column:
    """A hash of the text by which rows of one id are told apart."""
    return F.xxhash64(F.coalesce(valid(F.col(f"`{text_col}`")), F.lit("")))


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, n_shingles, node): equal sets have equal nodes; no shingles, no node."""

    def run(chunk: pa.RecordBatch) -> dict:
        found, first = shingles(chunk.column("text"))
        size = np.diff(first)
        nodes = [x if n else None for x, n in zip(fixed(digests(found, first)).to_pylist(), size.tolist(), strict=True)]
        return {"doc_id": chunk.column("doc_id"), "mark": chunk.column("mark"), "n_shingles": size, "node": nodes}

    return map_chunks(docs.withColumn("mark", text_mark()), run, "doc_id long, mark long, n_shingles long, node binary")


def likely_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows (node, ...) but for most of those whose node is none of `nodes`: a bitmap of these nodes' hashes, whose size is fixed, keeps them out of a shuffle; a join must decide."""
    place = F.pmod(F.xxhash64("node"), F.lit(BITMAP))
    bits = nodes.select(place.alias("p")).groupBy(F.expr("bitmap_bucket_number(p)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits"))
    bits = F.broadcast(written(bits, "bits"))  # at most BITMAP bits
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.expr("bitmap_bit_position(p)") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, F.pmod(F.expr("bitmap_bit_position(p)"), F.lit(8)).cast("int")).bitwiseAND(F.lit(1))
    return rows.withColumn("p", place).join(bits, F.expr("bitmap_bucket_number(p)") == F.col("bucket")).where(bit == 1).select(*rows.columns)


def texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text): one text for each of the (distinct) nodes."""

    def run(chunk: pa.RecordBatch) -> dict | None:
        found, first = shingles(chunk.column("text"))
        own = digests(found, first)
        keep = np.flatnonzero((np.diff(first) >= LEAST) & ~first_of(own))
        return {"node": fixed(own[keep]), "text": chunk.column("text").take(pa.array(keep))} if len(keep) else None

    rows = likely_of(map_chunks(docs.select("text"), run, "node binary, text string"), nodes)
    return rows.join(nodes, "node").groupBy("node").agg(F.first("text").alias("text"))  # a semi join would be moved below the bitmap's


def row_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile_pairs: int = TILE_PAIRS, many: int = MANY) -> DataFrame:
    """(doc_id, mark, n_shingles, node, root) of every row: linked sets share a root; no words, neither node nor root. `tile_pairs` and `many` say when a hot key's work is dealt out."""
    rows = id_and_text(docs, id_col, text_col)
    sets = written(shingle_sets(rows), "sets")
    parts = number_of_parts(int((sets.agg(F.sum("n_shingles")).first()[0] or 0) * 6 // 10))

    told = meet(keyed(rows, parts), parts, 20, functools.partial(leaders, parts=parts), BLOCKS, forward=True)
    stars = written(meet(told, parts, 16, best_leaders, PAIRS, key_bytes=TOLD), "stars")
    texts = written(texts_of(rows, stars.select(F.col("a").alias("node")).distinct()), "met")
    links = written(linked(stars.where("a <> b"), texts, many), "star-links")

    few = number_of_parts(int((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 10))

    def labelled() -> DataFrame:
        own = texts.join(components(links).hint("merge"), "node", "left").select("node", F.coalesce("root", "node").alias("root"), "text")
        return keyed(own, few, labelled=True)

    told = compared(labelled(), few, False, told_nearest, tile_pairs)
    near = meet(told, few, 16, functools.partial(best_leaders, nearest=True), PAIRS, key_bytes=TOLD)
    links = links.unionByName(written(linked(near, texts, many), "near-links"))
    told = compared(labelled(), few, True, told_all, tile_pairs)
    rest = written(meet(told, few, 16, distinct_pairs, PAIRS, key_bytes=16), "across")
    links = links.unionByName(linked(rest, texts, many))

    roots = written(components(links), "roots")
    return with_values(sets, roots, "node", "root").withColumn("root", F.coalesce("root", "node"))


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the least id that links reach."""
    rows = written(row_classes(docs, id_col, text_col), "row-classes")
    least = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = with_values(rows, least, "root", "component_id")
    return found.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, as it is: that of the least id (a null id counts as the largest), and of the least hash of its text among rows of that id.

    Rows without a word stay, as they resemble nothing. Of rows of the same id and text that stay, one is left.
    """
    rows = written(row_classes(docs, id_col, text_col).where("root is not null"), "row-classes")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    best = rows.groupBy("root").agg(F.min(place).alias("best")).select(F.col("root"), "best.doc_id", "best.mark")
    best = written(best, "class-leaders")
    at = free_prefix(docs, "class_")
    same = lambda other: F.col(f"{at}id").eqNullSafe(other[f"{at}id_"]) & (F.col(f"{at}mark") == other[f"{at}mark_"])
    named = lambda found: found.select(F.col("doc_id").alias(f"{at}id_"), F.col("mark").alias(f"{at}mark_"))
    gone = named(rows.join(best.withColumnRenamed("root", "best_root"), rows["doc_id"].eqNullSafe(best["doc_id"]) & (rows["mark"] == best["mark"]), "left_anti").select("doc_id", "mark").distinct())
    keyed_docs = docs.withColumns({f"{at}id": F.col(f"`{id_col}`").cast("long"), f"{at}mark": text_mark(text_col)})
    left = keyed_docs.join(gone, same(gone), "left_anti")
    often = rows.groupBy("doc_id", "mark").agg(F.count("*").alias("n")).where("n > 1")
    often = written(named(often.join(best, often["doc_id"].eqNullSafe(best["doc_id"]) & (often["mark"] == best["mark"]), "left_semi")), "repeated-leaders")
    if not often.isEmpty():
        once = left.join(often, same(often), "left_semi").dropDuplicates([f"{at}id", f"{at}mark"])
        left = left.join(often, same(often), "left_anti").unionByName(once)
    return left.select(*names_of(docs))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir))


OP4_SQL = r"""
with recursive words as (select cast(doc_id as bigint) as doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from words),
items as (select doc_id, unnest(s) as shingle, len(s) as n from sets),
pairs as (select a.doc_id as x, b.doc_id as y, any_value(a.n) as n, any_value(b.n) as m, count(*) as common
          from items a join items b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
links as (select x, y from pairs where 100 * common >= 80 * (n + m - common)),
reach(x, y) as (select x, y from links union select r.x, l.y from reach r join links l on r.y = l.x)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, least(s.doc_id, coalesce(min(r.y), s.doc_id)) as component_id
from sets s left join reach r on r.x = s.doc_id group by s.doc_id, s.s
"""
