"""Removal of repeated byte strings with suffix arrays built by induced sorting.

Every string of ``LENGTH`` bytes has an anchor: the leftmost of its
``ANCHOR``-byte substrings with the least hash. Equal strings have equal anchors
at the same place, so strings that repeat meet if text is dealt out by anchors.
Around each anchor a segment covers the strings that it is the anchor of; segments
whose anchor occurs once are done. Equal segments, known by 64 bits of the anchor
and 64 of the segment, are counted and kept once. The others are laid out in
shards, in which the anchor, common to its group, is one symbol; a suffix array
of the shard and its permuted common prefixes tell which strings of ``LENGTH``
bytes start elsewhere too. A group of too many different segments is split by
what its strings have in common beside the anchor: strings with the anchor at
about the same place share bytes on either side of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, mapped, slices, stage_table, utf8, width

LENGTH = 400
ANCHOR = 200
SHARD = 1 << 17
GROUP_MAX = 1024
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 24) - 1)


# ---------------------------------------------------------------- suffix arrays


def suffix_array(s: list[int], sigma: int) -> list[int]:
    """Starts of the suffixes of ``s`` in order, by induced sorting; symbols are under ``sigma``.

    Suffixes are classified by whether they are less than the next one; leftmost
    smaller substrings are sorted by induction, named, and, where names repeat,
    ordered by the suffix array of their names; all suffixes are induced from them.
    """
    n = len(s)
    if n < 2:
        return list(range(n))
    a = np.array(s, np.int64)
    step = np.sign(np.diff(a))
    nearest = np.where(step != 0, np.arange(n - 1), n - 1)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    small = np.zeros(n, bool)
    small[:-1] = np.r_[step, -1][nearest] > 0
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    counts = np.bincount(a, minlength=sigma)
    ends = np.cumsum(counts)
    heads, tails, kind = (ends - counts).tolist(), ends.tolist(), small.tobytes()

    def induce(sorted_lms: list[int]) -> list[int]:
        sa, at = [-1] * n, tails.copy()
        for j in reversed(sorted_lms):
            c = s[j]
            at[c] -= 1
            sa[at[c]] = j
        at = heads.copy()
        c = s[n - 1]
        sa[at[c]] = n - 1
        at[c] += 1
        for i in range(n):
            j = sa[i] - 1
            if j >= 0 and not kind[j]:
                c = s[j]
                p = at[c]
                sa[p] = j
                at[c] = p + 1
        at = tails.copy()
        for i in range(n - 1, -1, -1):
            j = sa[i] - 1
            if j >= 0 and kind[j]:
                c = s[j]
                p = at[c] - 1
                sa[p] = j
                at[c] = p
        return sa

    if not len(lms):
        return induce([])
    first = np.array(induce(lms.tolist()), np.int64)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = first[is_lms[first]]
    stop = np.zeros(n, np.int64)
    stop[lms] = np.r_[lms[1:], n - 1] + 1
    size = stop[order] - order
    new = np.ones(len(order), np.int64)
    before, at = order[:-1].tolist(), order[1:].tolist()
    same = np.flatnonzero((size[1:] == size[:-1]) & (stop[order[1:]] < n) & (stop[order[:-1]] < n) & (a[order[1:]] == a[order[:-1]]))
    for k, m in zip(same.tolist(), size[same].tolist(), strict=True):
        p, q = before[k], at[k]
        if s[p : p + m] == s[q : q + m]:
            new[k + 1] = 0
    names = np.cumsum(new) - 1
    if names[-1] + 1 < len(order):
        name = np.zeros(n, np.int64)
        name[order] = names
        inner = suffix_array(name[lms].tolist(), int(names[-1]) + 1)
        order = lms[np.array(inner, np.int64)]
    return induce(order.tolist())


def permuted_prefixes(s: list[int], sa: list[int]) -> tuple[list[int], list[int]]:
    """For each suffix, in the order of the text: the suffix before it in ``sa`` (-1 for none), and how many symbols both share."""
    n = len(s)
    before = np.full(n, -1, np.int64)
    order = np.array(sa, np.int64)
    before[order[1:]] = order[:-1]
    phi, shared, length = before.tolist(), [0] * n, 0
    for i in range(n):
        j = phi[i]
        if j < 0:
            length = 0
            continue
        most = n - (i if i > j else j)
        while length < most and s[i + length] == s[j + length]:
            length += 1
        shared[i] = length
        if length:
            length -= 1
    return phi, shared


# ---------------------------------------------------------------- anchors


class _Powers:
    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            inverse = np.uint64(pow(int(_BASE), -1, 2**64))
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse)], dtype=np.uint64)
        return self.up, self.down


_powers = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def anchors(data: np.ndarray, length: int = LENGTH, size: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors of one text, and the first string and number of strings of each.

    Texts are cut at 16 MB with an overlap, so that places fit the hash's low bits.
    """
    n = len(data)
    most = 1 << 24
    if n > most:
        parts = [(at, anchors(data[at : at + most], length, size)) for at in range(0, n - length + 1, most - length + 1)]
        return tuple(np.concatenate([x[k] + (at if k < 2 else 0) for at, x in parts]) for k in range(3))
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    up, down = _powers.to(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    grams = _mix((sums[size:] - sums[:-size]) * down[: n - size + 1])
    key = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    wide, m = length - size + 1, n - length + 1
    # sliding minimum: from the left and from the right within blocks as wide as the window
    blocks = np.concatenate([key, np.full(-len(key) % wide, 2**64 - 1, np.uint64)]).reshape(-1, wide)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[:m], left[wide - 1 : wide - 1 + m])
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    place = (least[first] & _PLACE).astype(np.int64)
    return place, first, np.diff(np.r_[first, m])


KEYS = "_doc string, _row long"
SEGMENT = f"{KEYS}, anchor long, segment long, starts array<long>, strings int, place int"


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with columns that tell rows apart, also where ids repeat or are null."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_doc"), F.xxhash64("doc_id", text).alias("_row"))


def _digest(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw)


def segments(docs: DataFrame, length: int = LENGTH, size: int = ANCHOR) -> DataFrame:
    """A row for each anchor of each text, with the hashes of both: where the segment starts, how many strings it has, and the anchor's place in it.

    A segment that a text repeats is one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(2))
            flat = np.frombuffer(data, np.uint8)
            for i, j in slices(offsets, 1 << 22):
                rows, found, starts = [], [], []
                for r in range(i, j):
                    lo, hi = int(offsets[r]), int(offsets[r + 1])
                    if hi - lo < length:
                        continue
                    place, first, n = anchors(flat[lo:hi], length, size)
                    raw = bytes(data[lo:hi])
                    mine = np.array([_digest(raw[a : a + size]) for a in place.tolist()], np.uint64)
                    seg = np.array([_digest(raw[a:z]) for a, z in zip(first.tolist(), (first + n + length - 1).tolist(), strict=True)], np.uint64)
                    order = np.lexsort((first, seg, mine))
                    mine, seg = mine[order], seg[order]
                    head = np.flatnonzero(np.r_[True, (mine[1:] != mine[:-1]) | (seg[1:] != seg[:-1])])
                    one = order[head]
                    found.append((mine[head].view(np.int64), seg[head].view(np.int64), np.diff(np.r_[head, len(order)]), n[one].astype(np.int32), (place - first)[one].astype(np.int32)))
                    starts.append(first[order])
                    rows.append(np.full(len(head), r))
                if rows:
                    at = pa.array(np.concatenate(rows))
                    anchor, segment, times, strings, place = (np.concatenate(x) for x in zip(*found, strict=True))
                    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(times)].astype(np.int32)), pa.array(np.concatenate(starts)))
                    columns = [pa.array(anchor), pa.array(segment), lists, pa.array(strings), pa.array(place)]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), *columns], names=["_doc", "_row", "anchor", "segment", "starts", "strings", "place"])

    return docs.filter(F.octet_length("text") >= length).select("_doc", "_row", "text").transform(mapped, run, SEGMENT)


# ---------------------------------------------------------------- shards


def repeated_in_shard(groups: list[list[tuple[bytes, int, int]]], length: int = LENGTH, size: int = ANCHOR) -> list[list[np.ndarray]]:
    """For groups of different segments (bytes, strings, place of the anchor): which strings of each occur in another one.

    The suffix array is over all groups; a group's anchor is a symbol of its own
    that counts for ``size`` bytes, so strings of different groups never match,
    and a string that runs out of its segment meets the separator, symbol 0.
    """
    symbols: list[int] = []
    starts: list[list[int]] = []
    for g, group in enumerate(groups):
        starts.append([])
        for raw, _, place in group:
            starts[-1].append(len(symbols))
            shifted = (np.frombuffer(raw, np.uint8).astype(np.int64) + 1).tolist()
            symbols += shifted[:place]
            symbols.append(257 + g)
            symbols += shifted[place + size :]
            symbols.append(0)
    sa = suffix_array(symbols, 257 + len(groups))
    phi, shared = permuted_prefixes(symbols, sa)
    # a string is anchored: with its anchor it has length - size + 1 symbols
    need = length - size + 1
    common = np.array(shared)
    hit = common >= need
    other = np.array(phi)[hit]
    hit[other] = True
    return [[hit[at : at + n] for at, (_, n, _) in zip(begin, group, strict=True)] for begin, group in zip(starts, groups, strict=True)]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of true values."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return edge[::2], edge[1::2] - edge[::2]


FETCHED = "anchor long, _doc string, _row long, start long, strings int, place int, times long, raw binary"
RANGES = f"{KEYS}, start long, strings long"


def _shards(length: int, size: int, shard: int):
    """A mapInArrow function over fetched segments sorted by anchor: ranges of repeated strings."""

    def solve(groups: list[list[tuple]]) -> pa.RecordBatch | None:
        out = []
        found = repeated_in_shard([[(raw, n, place) for *_, n, place, _, raw in g] for g in groups], length, size)
        for g, flags in zip(groups, found, strict=True):
            for (doc, row, start, _, _, times, _), f in zip(g, flags, strict=True):
                if times == 1:
                    out += [(doc, row, start + a, n) for a, n in zip(*(x.tolist() for x in _runs(f)), strict=True)]
        if not out:
            return None
        kinds = pa.schema([("_doc", pa.string()), ("_row", pa.int64()), ("start", pa.int64()), ("strings", pa.int64())])
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, weight, now = [], 0, None
        for b in batches:
            for anchor, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                # the bytes decide, the hash only brings them together
                mine = (anchor, row[-1][row[4] : row[4] + size])
                if now is None or anchor != now[0]:
                    if weight >= shard:
                        if (out := solve(groups)) is not None:
                            yield out
                        groups, weight = [], 0
                    groups.append([])
                elif mine != now:
                    groups.append([])
                now = mine
                groups[-1].append(tuple(row))
                weight += len(row[-1]) - size + 2
        if groups and (out := solve(groups)) is not None:
            yield out

    return run


def _fetch(length: int, size: int):
    """A mapInArrow function that cuts wanted segments out of texts."""
    kinds = pa.schema([("anchor", pa.int64()), ("_doc", pa.string()), ("_row", pa.int64()), ("start", pa.int64()), ("strings", pa.int32()), ("place", pa.int32()), ("times", pa.int64()), ("raw", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                out = []
                for doc, row, text, wanted in zip(*(c.to_pylist() for c in b.slice(k, 256).columns), strict=True):
                    raw = text.encode()
                    for w in wanted:
                        a = w["start"]
                        out.append((w["anchor"], doc, row, a, w["strings"], w["place"], w["times"], raw[a : a + w["strings"] + length - 1]))
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)

    return run


def _parted(length: int, size: int, wide: int):
    """A mapInArrow function that splits segments by the anchor's place in their strings, ``wide`` places to a part.

    The parts of a group are groups of their own: the key is the old one, the
    part, and the bytes on both sides of the anchor that all strings of the part
    have.
    """
    kinds = pa.schema([("anchor", pa.int64()), ("_doc", pa.string()), ("_row", pa.int64()), ("start", pa.int64()), ("strings", pa.int32()), ("place", pa.int32()), ("times", pa.int64()), ("raw", pa.binary()), ("segment", pa.int64())])
    free = length - size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                out = []
                for anchor, doc, row, start, n, place, times, raw in zip(*(c.to_pylist() for c in b.slice(k, 1024).columns), strict=True):
                    for part in range((place - n + 1) // wide, place // wide + 1):
                        lo, hi = part * wide, min(part * wide + wide - 1, free)
                        a, z = max(0, place - hi), min(n - 1, place - lo)
                        near = raw[place - lo : place + size + free - hi]
                        key = _digest(b"%d %d %d " % (anchor, wide, part) + near)
                        own = raw[a : z + length]
                        out.append((_signed(key), doc, row, start + a, z - a + 1, place - a, times, own, _signed(_digest(own))))
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)

    return run


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _split(fetched: DataFrame, variants: DataFrame, length: int, size: int, group_max: int) -> tuple[DataFrame, DataFrame | None]:
    """Fetched segments in groups of at most ``group_max``, and ranges of strings found to repeat on the way.

    Crowded groups are split into parts, each at most half as wide as before.
    Equal parts are counted and kept once. A part of one place has all its
    strings' bytes in its key, so the splitting ends.
    """
    columns, found, wide = [c.split()[0] for c in FETCHED.split(", ")], None, length - size + 1
    whole = None
    while wide > 1:
        crowded = stage_table(variants.filter(F.col("variants") > group_max).select("anchor"), "crowded")
        if crowded.isEmpty():
            break
        wide = -(-wide // 2)
        calm = fetched.join(crowded, "anchor", "left_anti").select(*columns)
        whole = calm if whole is None else whole.unionByName(calm)
        parts = fetched.join(crowded, "anchor", "left_semi").select(*columns)
        parts = stage_table(parts.transform(mapped, _parted(length, size, wide), f"{FETCHED}, segment long"), "parts")
        sums = stage_table(parts.groupBy("anchor", "segment").agg(F.sum("times").alias("all"), F.min(F.struct("_doc", "_row", "start")).alias("one")), "sums")
        # a segment that was met more than once has been reported with all its strings
        again = parts.filter("times = 1").join(sums.filter("all > 1").select("anchor", "segment"), ["anchor", "segment"], "left_semi")
        again = again.select("_doc", "_row", "start", F.col("strings").cast("long").alias("strings"))
        found = again if found is None else found.unionByName(again)
        variants = stage_table(sums.groupBy("anchor").agg(F.count("*").alias("variants")).filter("variants > 1"), "variants")
        kept = sums.join(variants.select("anchor"), "anchor").select("anchor", "segment", F.col("all").alias("times"), "one.*")
        kept = parts.drop("times").join(kept, ["anchor", "segment", "_doc", "_row", "start"])
        fetched = stage_table(kept.select(*columns), "fetched")
    return fetched.select(*columns) if whole is None else whole.unionByName(fetched.select(*columns)), found


def repeated_strings(keyed: DataFrame, length: int = LENGTH, size: int = ANCHOR, shard: int = SHARD, group_max: int = GROUP_MAX) -> DataFrame:
    """``_doc, _row, start, strings``: ranges of starts of ``length``-byte strings that also start elsewhere.

    ``keyed`` has ``_doc, _row, text``.
    """
    every = stage_table(segments(keyed, length, size), "segments")
    # written, so that the join deals out both sides anew and a hot anchor's rows can be split
    again = stage_table(every.groupBy("anchor").agg(F.sum(F.size("starts")).alias("n")).filter("n > 1").select("anchor"), "again")
    met = stage_table(every.join(again, "anchor", "left_semi"), "met")
    drop_table(every)
    one = F.struct("_doc", "_row", F.col("starts")[0].alias("start"), "strings", "place")
    kinds = met.groupBy("anchor", "segment").agg(F.sum(F.size("starts")).alias("times"), F.min(one).alias("one"))
    kinds = stage_table(kinds, "kinds")
    copies = met.join(kinds.filter("times > 1").select("anchor", "segment"), ["anchor", "segment"], "left_semi")
    copies = copies.select("_doc", "_row", F.explode("starts").alias("start"), F.col("strings").cast("long").alias("strings"))
    variants = stage_table(kinds.groupBy("anchor").agg(F.count("*").alias("variants")).filter("variants > 1"), "variants")
    wanted = kinds.join(variants.select("anchor"), "anchor").select("anchor", "times", "one.*")
    lists = wanted.groupBy("_doc", "_row").agg(F.collect_list(F.struct("anchor", "start", "strings", "place", "times")).alias("wanted"))
    fetched = lists.join(keyed.select("_doc", "_row", "text"), ["_doc", "_row"])
    fetched = stage_table(fetched.select("_doc", "_row", "text", "wanted").transform(mapped, _fetch(length, size), FETCHED), "fetched")
    parts = width(fetched)
    fetched, found = _split(fetched, variants, length, size, group_max)
    dealt = fetched.repartition(parts, "anchor").sortWithinPartitions("anchor", F.substring("raw", F.col("place") + 1, F.lit(size)))
    out = copies.unionByName(dealt.transform(mapped, _shards(length, size, shard), RANGES))
    return out if found is None else out.unionByName(found)


def covered(ranges: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs of bytes that strings starting in (start, number) ranges cover."""
    out: list[list[int]] = []
    for start, n in sorted(ranges):
        stop = start + n - 1 + length
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, z) for a, z in out]


def without_repeats(docs: DataFrame, length: int = LENGTH, size: int = ANCHOR, shard: int = SHARD, group_max: int = GROUP_MAX) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for each row of ``docs`` (``doc_id, text``).

    Each byte goes that is covered by a string of ``length`` bytes that also starts
    anywhere else, in the same text or another; strings are judged on the input
    and never reach over texts. ``spans`` are the maximal runs of bytes that go,
    as (start, stop), ``kept`` is what stays. A null text counts as empty; texts
    shorter than ``length`` bytes stay whole. Rows that repeat are copies of each
    other, so their strings go from all of them. Other columns are ignored; an
    empty table gives none.
    """
    keyed = _keyed(docs)
    ranges = repeated_strings(keyed, length, size, shard, group_max)
    lists = ranges.groupBy("_doc", "_row").agg(F.collect_set(F.struct("start", "strings")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary())])
        for b in batches:
            for k in range(0, b.num_rows, 512):
                out = []
                for doc_id, text, found in zip(*(c.to_pylist() for c in b.slice(k, 512).columns), strict=True):
                    raw = text.encode()
                    spans = covered([(r["start"], r["strings"]) for r in found or ()], length)
                    at, kept = 0, []
                    for a, z in spans:
                        kept.append(raw[at:a])
                        at = z
                    out.append((doc_id, len(raw), [{"start": a, "stop": z} for a, z in spans], b"".join(kept) + raw[at:]))
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)

    joined = keyed.join(lists, ["_doc", "_row"], "left").select("doc_id", "text", "ranges")
    return joined.transform(mapped, run, "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")


def digests(kept: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of ``without_repeats``."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["stop"] - s["start"])
    return kept.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
