"""Benchmark decontamination by size-partitioned MinHash containment search.

A benchmark item is contained in a document if at least ``THRESHOLD`` of its
different five-word shingles occur in the document. Items are partitioned by
their number of shingles. An item's sketch is its least shingle hashes, one more
than it may miss: a document that contains the item shares at least one of them,
so no containment is lost, however long the document is. In each partition only
hashes up to the largest of its sketches are looked up. Candidates are verified
by exact containment of the shingles' words. An item of fewer than five words is
one shingle of its own width, and documents are searched for each such width.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, slices, utf8

SHINGLE = 5
THRESHOLD = 0.8
BLOCK_SHINGLES = 500_000
SLICE = 1 << 20
#: A longer text is hashed in windows of this many bytes, which share the words between them.
LONG = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2 ** 64 and of its inverse, as many as the longest slice needs."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            inverse = np.uint64(pow(int(_BASE), -1, 2**64))
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse)], dtype=np.uint64)
        return self.up, self.down


_powers = Powers()


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each run of ``words`` words and the number of its text.

    ``data`` holds texts between ``offsets``. Words are runs of bytes other than
    space, tab, newline, vertical tab, form feed and carriage return, with A-Z
    in lower case.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _powers.to(n)
    low = _LOWER[data]
    white = _WHITE[low]
    opens = ~white
    opens[1:] &= white[:-1]
    edge = offsets[:-1][offsets[:-1] < n]
    opens[edge] = ~white[edge]
    starts = np.flatnonzero(opens)
    closes = ~white
    closes[:-1] &= white[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    closes[last] = ~white[last]
    stops = np.flatnonzero(closes) + 1
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    word = _mix((sums[stops] - sums[starts]) * down[starts])
    if len(word) < words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    m = len(word) - words + 1
    total = np.zeros(m, np.uint64)
    for j in range(words):
        total = total * np.uint64(0xD6E8FEB86659FD93) + word[j : j + m]
    whole = owner[:m] == owner[words - 1 :]
    return _mix(total)[whole], owner[:m][whole]


def bare_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(text: str | None, words: int = SHINGLE) -> list[bytes]:
    """Different shingles of a text, in order; a shorter text is one."""
    w = bare_words(text)
    if len(w) < words:
        return [b" ".join(w)] if w else []
    return list(dict.fromkeys(b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)))


@dataclass
class Partition:
    """Items of one width and similar size: sorted sketch hashes, the item of each, and the largest hash."""

    width: int
    hashes: np.ndarray
    items: np.ndarray
    largest: np.uint64


@dataclass
class Index:
    """Items with their shingles, and their sketches by size."""

    ids: list
    parts: list[list[bytes]]
    partitions: list[Partition]


def build(items: list[tuple[int, str]], words: int = SHINGLE, threshold: float = THRESHOLD) -> Index:
    """Index items that have a word."""
    found = [(i, s) for i, t in items if (s := shingles(t, words))]
    by_size: dict[tuple[int, int], list[tuple[np.ndarray, int]]] = {}
    for k, (_, s) in enumerate(found):
        text, wide = b"\n".join(s), s[0].count(b" ") + 1
        sizes = np.cumsum([0] + [len(x) + 1 for x in s])
        sizes[-1] -= 1
        hashes, _ = shingle_hashes(np.frombuffer(text, np.uint8), sizes, wide)
        allowed = len(s) - needed(len(s), threshold)
        by_size.setdefault((wide, len(s).bit_length()), []).append((np.sort(hashes)[: allowed + 1], k))
    partitions = []
    for (wide, _), sketches in sorted(by_size.items(), key=lambda x: x[0]):
        hashes = np.concatenate([h for h, _ in sketches])
        owner = np.repeat([k for _, k in sketches], [len(h) for h, _ in sketches])
        order = np.argsort(hashes, kind="stable")
        partitions.append(Partition(wide, hashes[order], owner[order], hashes.max()))
    return Index([i for i, _ in found], [s for _, s in found], partitions)


def needed(n: int, threshold: float = THRESHOLD) -> int:
    """How many of ``n`` shingles make a containment."""
    return max(1, math.ceil(n * threshold - 1e-9))


def _windows(data: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """A long text in windows that end between words and begin ``words`` words before the last one's end."""
    at = back = 0
    while at < len(data):
        stop = min(len(data), at + LONG)
        while stop < len(data) and not _WHITE[data[stop]]:
            space = np.flatnonzero(_WHITE[data[stop : stop + 4096]])
            stop = stop + int(space[0]) if len(space) else min(len(data), stop + 4096)
        yield data[back:stop]
        at = back = stop
        for _ in range(words - 1):
            while back and _WHITE[data[back - 1]]:
                back -= 1
            while back and not _WHITE[data[back - 1]]:
                back -= 1


def _met(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Pairs of text and item numbers that share a hash of the item's sketch."""
    pairs, last, hashes, owner = [], 0, None, None
    for p in index.partitions:
        if p.width != last:
            last = p.width
            hashes, owner = shingle_hashes(data, offsets, last)
        few = np.flatnonzero(hashes <= p.largest)
        h = hashes[few]
        at = np.searchsorted(p.hashes, h, side="left")
        hit = np.flatnonzero(p.hashes[np.minimum(at, len(p.hashes) - 1)] == h)
        at, doc = at[hit], owner[few[hit]]
        while len(at):
            pairs.append(np.unique(np.stack([doc, p.items[at]]), axis=1))
            same = at + 1 < len(p.hashes)
            same[same] = p.hashes[at[same] + 1] == p.hashes[at[same]]
            at, doc = at[same] + 1, doc[same]
    return pairs


def search(index: Index, data: memoryview, offsets: np.ndarray, words: int = SHINGLE, threshold: float = THRESHOLD) -> Iterator[tuple[int, int, int]]:
    """(text number, item number, shingles shared) for each containment."""
    flat = np.frombuffer(data, np.uint8)
    if len(offsets) == 2 and len(flat) > LONG:
        pairs = [x for w in _windows(flat, words) for x in _met(index, w, np.array([0, len(w)]))]
    else:
        pairs = _met(index, flat, offsets)
    if not pairs:
        return
    now, tried = -1, 0
    for d, k in np.unique(np.concatenate(pairs, axis=1), axis=1).T.tolist():
        if d != now:
            now, tried, text = d, 0, bytes(data[offsets[d] : offsets[d + 1]]).lower().split()
            joined, sets = b" " + b" ".join(text) + b" ", {}
        wanted, tried = index.parts[k], tried + 1
        wide = wanted[0].count(b" ") + 1
        # a few items are sought one shingle after the other, for more the text's shingles are kept
        if tried < 3:
            shared = sum(b" " + s + b" " in joined for s in wanted)
        else:
            if wide not in sets:
                sets[wide] = {b" ".join(text[i : i + wide]) for i in range(len(text) - wide + 1)}
            shared = len(sets[wide].intersection(wanted))
        if shared >= needed(len(wanted), threshold):
            yield d, k, shared


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of about ``most`` words, so that a block's index has a bounded size."""
    held, n = [], 0
    for r in items.filter("item_id is not null and text is not null").select("item_id", "text").distinct().toLocalIterator():
        size = len(bare_words(r["text"]))
        if held and n + size > most:
            yield held
            held, n = [], 0
        held.append((r["item_id"], r["text"]))
        n += size
    if held:
        yield held


SCHEMA = "doc_id long, item_id long, n_shared long, n_shingles long, containment double"


def contained_items(docs: DataFrame, items: DataFrame, words: int = SHINGLE, threshold: float = THRESHOLD, block: int = BLOCK_SHINGLES) -> DataFrame:
    """``doc_id, item_id, n_shared, n_shingles, containment`` for each item of ``items`` that a document contains.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``. All documents
    are held against all items; a set of items that is larger than ``block`` words
    is searched in blocks of that size, so what each task holds is bounded. Null
    and empty texts contain nothing, and nothing contains items without a word; an
    item of fewer than ``words`` words is one shingle. Rows of one ``item_id`` with different texts are items of
    their own; equal rows count once. Repeated documents give repeated results;
    other columns are ignored; an empty table on either side gives no rows.
    """
    texts, out = docs.select(F.col("doc_id").cast("long"), "text"), None
    for held in _blocks(items, block):
        index = build(held, words, threshold)

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                data, offsets = utf8(b.column(1))
                for i, j in slices(offsets, SLICE):
                    part = data[offsets[i] : offsets[j]]
                    found = list(search(index, part, offsets[i : j + 1] - offsets[i], words, threshold))
                    if found:
                        d, k, shared = map(list, zip(*found, strict=True))
                        sizes = [len(index.parts[x]) for x in k]
                        rows = [
                            b.column(0)[i:j].take(pa.array(d)),
                            pa.array([index.ids[x] for x in k], pa.int64()),
                            pa.array(shared, pa.int64()),
                            pa.array(sizes, pa.int64()),
                            pa.array([x / y for x, y in zip(shared, sizes, strict=True)]),
                        ]
                        yield pa.RecordBatch.from_arrays(rows, names=["doc_id", "item_id", "n_shared", "n_shingles", "containment"])

        found = texts.transform(mapped, run, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], SCHEMA) if out is None else out


def without_items(docs: DataFrame, items: DataFrame, words: int = SHINGLE, threshold: float = THRESHOLD, block: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of ``docs``, with all columns, that contain no item; blocks of items are searched one after the other."""
    names, at = docs.columns, docs.columns.index("text")
    # names by number, since a name may hold a dot
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])
    for held in _blocks(items, block):
        index = build(held, words, threshold)

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                data, offsets = utf8(b.column(at))
                clean = np.ones(b.num_rows, bool)
                for i, j in slices(offsets, SLICE):
                    part = data[offsets[i] : offsets[j]]
                    for d, _, _ in search(index, part, offsets[i : j + 1] - offsets[i], words, threshold):
                        clean[i + d] = False
                yield b.filter(pa.array(clean))

        docs = docs.transform(mapped, run, docs.schema)
    return docs.toDF(*names)


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

ORACLE_SQL = f"""
WITH i AS (SELECT row_number() OVER () AS k, item_id, {_WORDS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL)),
iw AS (SELECT *, least(len(w), {SHINGLE}) AS wide FROM i WHERE len(w) > 0),
s AS (SELECT DISTINCT k, item_id, wide, unnest(list_transform(range(1, len(w) - wide + 2), lambda i: array_to_string(w[i : i + wide - 1], ' '))) AS s FROM iw),
n AS (SELECT k, count(*) AS n_shingles FROM s GROUP BY k),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
dw AS (SELECT r, doc_id, w, wide FROM d, (SELECT DISTINCT wide FROM iw) q WHERE len(w) >= wide),
ds AS (SELECT DISTINCT r, doc_id, wide, unnest(list_transform(range(1, len(w) - wide + 2), lambda i: array_to_string(w[i : i + wide - 1], ' '))) AS s FROM dw),
hit AS (SELECT r, doc_id, k, item_id, count(*) AS n_shared FROM ds JOIN s USING (wide, s) GROUP BY ALL)
SELECT doc_id, item_id::BIGINT AS item_id, n_shared::BIGINT AS n_shared, n_shingles::BIGINT AS n_shingles, n_shared::DOUBLE / n_shingles AS containment
FROM hit JOIN n USING (k) WHERE n_shared >= ceil(n_shingles * {THRESHOLD}::DOUBLE - 1e-9)
"""
