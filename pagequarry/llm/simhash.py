"""SimHash near-duplicates, found with pivot distance tables.

Each fingerprint gets its Hamming distances to ``PIVOTS`` fixed reference
fingerprints. By the triangle inequality two fingerprints within ``radius`` bits
have distances to any reference that differ by ``radius`` at most, so a pair is
discarded by its maximum coordinate difference before it is verified.

Which pairs meet at all depends on the radius. ``near_duplicates`` links
fingerprints within three bits; there the pigeonhole principle loses none: of
six bit blocks, three changed bits leave three blocks alone, so a pair shares
one of the 20 cells made of three blocks each. ``similar_texts`` links texts by
the similarity of their shingles. At 0.8 about ten of 64 bits change, which
leaves too few blocks alone, so there each text also has ``SAMPLES``
fingerprints of a few shingles each, the least under as many hashes. A pair of
this similarity of 26 shingles or more shares one of them with a probability of
over 0.998. For shorter texts, where a sample holds much of the text, prefixes
lose none: of ``n`` shingles all but the least 0.8 ``n`` may be missing from the
other text, so one of the others, by any fixed order, is common to both and is
also among the others there. Texts that shared fingerprints or shingles join,
directly or over others, are a family; its members come together once, whole, and
the pairs that the tables and the distance of the whole fingerprints leave are
verified by all their shingles. Short texts go without the tables, since a
shingle of few moves many bits.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, mapped, stage_table, width
from .components import connected_components

SHINGLE = 3
SEED = 42
RADIUS = 3
PIVOTS = 16
CELL_MAX = 4096
TEXT_SHINGLE = 5
SIMILARITY = 0.8
SAMPLES, SAMPLE = 20, 5
#: Pairs of which one text has at most so many shingles share a shingle of their prefixes and skip the tables.
SHORT = 25
#: Bits in which fingerprints of texts at ``SIMILARITY`` may differ: three standard deviations over the mean.
WIDE_RADIUS = 18
#: A family of more members or bytes than this is dealt out in blocks; ``HUBS`` of its members go to all of them.
BLOCK_TEXTS, BLOCK_BYTES, HUBS = 1024, 8 << 20, 16
#: Family members that are broadcast, so that only their texts move; beyond it both sides are dealt out.
BROADCAST_KEYS = 1_000_000
_RANDOM = np.random.default_rng(SEED).integers(0, 2**64, (2, SAMPLES), np.uint64)


def _mix(x: int) -> int:
    """A step of splitmix64."""
    x = (x + 0x9E3779B97F4A7C15) & (2**64 - 1)
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
    return x ^ (x >> 31)


def references(n: int = PIVOTS) -> list[int]:
    """``n`` fixed reference fingerprints."""
    return [_mix(i) for i in range(n)]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of one text; 0 if it has no word."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        digests = xxhash.xxh64_digest(joined, SEED)
    else:
        sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
        ends = np.cumsum(sizes)
        starts, stops = (ends - sizes)[: len(found) - words + 1].tolist(), (ends - 1)[words - 1 :].tolist()
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)])
    bits = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(bits), 4096):
        ones += np.unpackbits(bits[i : i + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(bits)).tobytes(), "big")


def text_shingles(text: str | None, words: int = TEXT_SHINGLE) -> tuple[int, np.ndarray]:
    """A hash of all words of a text, and the different hashes of its shingles; a shorter text is one shingle."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(found)
    key = xxhash.xxh64_intdigest(joined)
    if len(found) <= words:
        return key, np.array([key], ">u8")
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts, stops = np.r_[0, ends[:-words]].tolist(), (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    return key, np.unique(np.frombuffer(b"".join([digest(joined[a:b]) for a, b in zip(starts, stops, strict=True)]), ">u8"))


def _majority(hashes: np.ndarray) -> np.ndarray:
    """The bits that over half of the hashes have; big-endian hashes stand along the last axis but one of their bytes."""
    ones = np.zeros((*hashes.shape[:-2], 64), np.int64)
    for i in range(0, hashes.shape[-2], 4096):
        ones += np.unpackbits(hashes[..., i : i + 4096, :], axis=-1).sum(axis=-2, dtype=np.int64)
    return np.packbits(2 * ones > hashes.shape[-2], axis=-1)


def sampled_fingerprints(found: np.ndarray) -> tuple[int, np.ndarray]:
    """The SimHash of a text's shingles, and those of ``SAMPLES`` samples of its ``SAMPLE`` least ones."""
    raw, least, kept = found.view(np.uint8).reshape(-1, 8), None, None
    native = found.astype(np.uint64)
    for i in range(0, len(found), 1 << 15):
        part = native[i : i + (1 << 15)]
        mixed = (part ^ _RANDOM[0][:, None]) * (_RANDOM[1][:, None] | np.uint64(1))
        at = np.broadcast_to(np.arange(i, i + len(part)), mixed.shape)
        if least is not None:
            mixed, at = np.concatenate([least, mixed], 1), np.concatenate([kept, at], 1)
        if mixed.shape[1] > SAMPLE:
            order = np.argpartition(mixed, SAMPLE - 1, axis=1)[:, :SAMPLE]
            mixed, at = np.take_along_axis(mixed, order, 1), np.take_along_axis(at, order, 1)
        least, kept = mixed, at
    whole = int.from_bytes(_majority(raw).tobytes(), "big")
    return whole, np.frombuffer(_majority(raw[kept]).tobytes(), ">u8").astype(np.uint64)


def prefix(found: np.ndarray, similarity: float = SIMILARITY, short: int = SHORT) -> np.ndarray:
    """The least hashes of a short text's shingles, of which a similar text of ``short`` shingles or fewer has one in its prefix.

    Texts that a short one can be similar to count as short, too.
    """
    n = len(found)
    if n * similarity > short + 1e-9:
        return found[:0].astype(np.uint64)
    return found[: n - math.ceil(similarity * n - 1e-9) + 1].astype(np.uint64)


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``: the SimHash of each whole text as a signed long.

    A null text counts as empty; texts without a word get 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_signed(fingerprint(t.as_py(), words)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").transform(mapped, run, "doc_id long, fp long")


def _masks(bits: list[int], blocks: int, kept: int) -> list[int]:
    """Masks of all choices of ``kept`` of ``blocks`` blocks of the given bits."""
    parts = [sum(1 << int(b) for b in part) for part in np.array_split(np.array(bits), blocks)]
    return [sum(c) for c in itertools.combinations(parts, kept)]


def _in_cells(nodes: DataFrame, radius: int) -> DataFrame:
    """Rows ``cell, part`` for each fingerprint and mask; ``part`` is the mask's number."""
    masks = F.array(*[F.lit(_signed(m)) for m in _masks(list(range(64)), 2 * radius, radius)])
    out = nodes.select("*", F.posexplode(masks).alias("part", "mask"))
    return out.withColumn("cell", F.xxhash64("part", F.col("fp").bitwiseAND(F.col("mask")))).drop("mask")


def _split(rows: DataFrame, radius: int) -> DataFrame:
    """Split cells once more, by the bits that the first mask leaves out.

    What then stays free in a cell is a quarter of the bits, so no cell can
    exceed 2 ** 17 different fingerprints, however many rows there are.
    """
    first = _masks(list(range(64)), 2 * radius, radius)
    second = [[_signed(m) for m in _masks([b for b in range(64) if not f >> b & 1], 2 * radius, radius)] for f in first]
    table = F.array(*[F.array(*[F.lit(m) for m in ms]) for ms in second])
    out = rows.select("*", F.posexplode(table[F.col("part")]).alias("sub", "mask"))
    return out.withColumn("cell", F.xxhash64("cell", "sub", F.col("fp").bitwiseAND(F.col("mask")))).drop("sub", "mask")


def _table(fp: Column, pivots: list[int]) -> list[Column]:
    """The distance table, eight distances to a long."""
    out = []
    for k in range(0, len(pivots), 8):
        packed = F.lit(0).cast("long")
        for i, p in enumerate(pivots[k : k + 8]):
            packed = packed.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))).cast("long"), 8 * i))
        out.append(packed.alias(f"pivots{k // 8}"))
    return out


def _verified(table: np.ndarray, fps: np.ndarray, i: np.ndarray, j: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs (i, j) are linked: first by coordinates, a column at a time, then exactly."""
    left = np.arange(len(i))
    for c in range(table.shape[1]):
        gap = table[i[left], c] - table[j[left], c]
        left = left[np.abs(gap) <= radius]
        if not len(left):
            break
    return left[np.bitwise_count(fps[i[left]] ^ fps[j[left]]) <= radius]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of each one's component, by label spreading."""
    label = np.arange(n)
    while len(i):
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], least)
        np.minimum.at(label, label[j], least)
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            break
    return label


def _cell_links(ids: np.ndarray, fps: np.ndarray, table: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each linked set in one cell of any size: at most as many as members."""
    n, label = len(ids), np.arange(len(ids))
    order = np.argsort(table[:, 0], kind="stable")
    ids, fps, table = ids[order], fps[order], table[order]
    stop = np.searchsorted(table[:, 0], table[:, 0] + radius, side="right")
    step = max(1, 2_000_000 // n)
    for a in range(0, n, step):
        z = min(n, a + step)
        rows = np.arange(a, z)
        count = stop[a:z] - rows - 1
        i = np.repeat(rows, count)
        j = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + i + 1
        same = label[i] != label[j]
        i, j = i[same], j[same]
        ok = _verified(table, fps, i, j, radius)
        if len(ok):
            i, j = np.concatenate([i[ok], np.arange(n)]), np.concatenate([j[ok], label])
            label = _forest(n, i, j)
    got = np.flatnonzero(label != np.arange(n))
    return ids[got], ids[label[got]]


def link_sorted_cells(radius: int = RADIUS):
    """A mapInArrow function over rows sorted by cell: (cell, id, fp, pivots...) to links (u, v).

    Cells that fall into one batch are held against each other together, by size;
    a cell is at most as large as the second split allows, so memory is bounded.
    """

    def whole(part: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cell, ids, fps, *tables = part
        start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        size = np.diff(np.r_[start, len(cell)])
        table = np.stack(tables, 1).astype("<i8").view(np.int8).reshape(len(cell), -1).astype(np.int16)
        fps, us, vs = fps.view(np.uint64), [], []
        for m in np.unique(size[size > 1]).tolist():
            at = start[size == m]
            if m > 16:
                for s in at.tolist():
                    u, v = _cell_links(ids[s : s + m], fps[s : s + m], table[s : s + m], radius)
                    us.append(u), vs.append(v)
                continue
            a, b = np.triu_indices(m, 1)
            for k in range(0, len(at), 100_000):
                i, j = (at[k : k + 100_000, None] + a).ravel(), (at[k : k + 100_000, None] + b).ravel()
                ok = _verified(table, fps, i, j, radius)
                us.append(ids[i[ok]]), vs.append(ids[j[ok]])
        if us:
            u, v = np.concatenate(us), np.concatenate(vs)
            pair = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for b in batches:
            part = [b.column(c).to_numpy(zero_copy_only=False) for c in range(b.num_columns)]
            if not len(part[0]):
                continue
            last = int(np.searchsorted(part[0], part[0][-1], side="left"))
            if held and held[-1][0][-1] != part[0][0] or last:
                held.append([x[:last] for x in part])
                full = [np.concatenate(x) for x in zip(*held, strict=True)]
                yield from whole(full) if len(full[0]) else ()
                held = [[x[last:] for x in part]]
            else:
                held.append(part)
        if held:
            yield from whole([np.concatenate(x) for x in zip(*held, strict=True)])

    return run


def fingerprint_links(classes: DataFrame, radius: int = RADIUS, pivots: int = PIVOTS, cell_max: int = CELL_MAX) -> DataFrame:
    """Links ``u, v`` that join all fingerprints within ``radius`` bits of each other.

    ``classes`` has one row ``rep, fp`` for each different fingerprint. Within a
    cell a spanning forest is returned, so links stay linear in the fingerprints
    while every pair within the radius ends in one component.
    """
    nodes = classes.select(F.col("rep").alias("id"), "fp", *_table(F.col("fp"), references(pivots)))
    cells = _in_cells(nodes, radius)
    crowded = stage_table(cells.groupBy("cell").count().filter(F.col("count") > cell_max).select("cell"), "cells")
    if not crowded.isEmpty():
        deep = _split(cells.join(crowded, "cell", "left_semi"), radius)
        cells = cells.join(crowded, "cell", "left_anti").unionByName(deep)
    order = ["cell", "id", "fp", *[c for c in nodes.columns if c.startswith("pivots")]]
    n = width(classes, 60.0)
    dealt = cells.select(*order).repartition(n, "cell").sortWithinPartitions("cell")
    return dealt.transform(mapped, link_sorted_cells(radius), "u long, v long")


def near_duplicates(docs: DataFrame, words: int = SHINGLE, radius: int = RADIUS, pivots: int = PIVOTS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs`` (``doc_id, text``).

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` is the least
    ``doc_id`` that links of at most ``radius`` bits reach. Null, empty and blank
    texts have fingerprint zero and are linked like others. Equal fingerprints
    are one node, so copies never meet each other. Other columns are ignored; a
    repeated row gives a repeated result; an empty table gives none. Rows without
    ``doc_id`` keep a fingerprint and have a null component unless their
    fingerprint also belongs to a row with one.
    """
    fps = stage_table(fingerprints(docs, words), "fingerprints")
    classes = stage_table(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    links = fingerprint_links(classes.filter("rep is not null"), radius, pivots)
    found = connected_components(links)
    label = classes.join(found, classes["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(label, "fp", "left").select("doc_id", hexed.alias("fingerprint"), "component_id")


# ---------------------------------------------------------------- by similarity of shingles


def _signatures(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """``doc_id, text, print, key, fp, samples``: hashes of the text and of its words, the SimHash, the samples', and then the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, fps, samples = [], [], []
            for t in b.column(1):
                key, found = text_shingles(t.as_py(), words)
                whole, parts = sampled_fingerprints(found)
                keys.append(_signed(key)), fps.append(_signed(whole))
                samples.append(np.concatenate([parts, prefix(found, similarity)]).view(np.int64))
            flat = pa.array(np.concatenate(samples) if samples else np.zeros(0, np.int64))
            ends = np.cumsum([0, *map(len, samples)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.int64()), pa.array(fps, pa.int64()), lists], names=["doc_id", "text", "print", "key", "fp", "samples"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", text_print(F.col("text")).alias("print"))
    return rows.transform(mapped, run, "doc_id long, text string, print long, key long, fp long, samples array<long>")


def text_print(text: Column) -> Column:
    """What tells the texts of rows of one id apart; a null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _block_links(keys: np.ndarray, fps: np.ndarray, table: np.ndarray, sets: list[np.ndarray], label: np.ndarray, apart: np.ndarray, home: np.ndarray, radius: int, similarity: float) -> tuple[list[int], list[int]]:
    """Links that join the similar texts of a block, fewer than texts: each one apart is held against those at home.

    ``label`` names groups that are joined already. A pair is discarded by the
    tables, then by the distance of its fingerprints, then by its common shingles.
    """
    sizes = np.array([len(x) for x in sets])
    starts = np.cumsum(sizes) - sizes
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    mine, label, us, vs = np.zeros(int(ids.max()) + 1, np.int32), label.copy(), [], []
    for a in np.flatnonzero(apart).tolist():
        rest = np.flatnonzero(home & (label != label[a]) & (np.minimum(sizes, sizes[a]) >= similarity * np.maximum(sizes, sizes[a]) - 1e-9))
        if len(rest):
            near = np.minimum(sizes[rest], sizes[a]) <= SHORT
            near[_verified(table, fps, np.full(len(rest), a), rest, radius)] = True
            rest = rest[near]
        if not len(rest):
            continue
        own = ids[starts[a] : starts[a] + sizes[a]]
        mine[own] = 1
        if 8 * len(rest) < len(sets):
            common = np.array([mine[ids[starts[j] : starts[j] + sizes[j]]].sum() for j in rest.tolist()])
        else:
            common = np.add.reduceat(mine[ids], starts)[rest]
        mine[own] = 0
        for j in rest[common >= similarity * (sizes[a] + sizes[rest] - common) - 1e-9].tolist():
            if label[j] != label[a]:
                us.append(int(keys[a])), vs.append(int(keys[j]))
                label[label == label[j]] = label[a]
    return us, vs


def _families(words: int, radius: int, similarity: float):
    """A mapInArrow function over rows sorted by family and block: (family, block, key, group, apart, home, fp, text, pivots...) to links."""

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        # equal rows of one document come next to each other
        rows = [r for k, r in enumerate(rows) if not k or r[2] != rows[k - 1][2]]
        if len(rows) < 2:
            return None
        _, _, keys, group, apart, home, fps, texts, *tables = zip(*rows, strict=True)
        table = np.array(tables, "<i8").T.copy().view(np.int8).reshape(len(keys), -1).astype(np.int16)
        sets = [text_shingles(x, words)[1] for x in texts]
        _, label = np.unique(np.array(group, np.int64), return_inverse=True)
        u, v = _block_links(np.array(keys, np.int64), np.array(fps, np.int64).view(np.uint64), table, sets, label, np.array(apart), np.array(home), radius, similarity)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"]) if u else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            for k in range(0, b.num_rows, 512):
                for r in zip(*(c.to_pylist() for c in b.slice(k, 512).columns), strict=True):
                    if held and r[:2] != held[-1][:2]:
                        if (out := solve(held)) is not None:
                            yield out
                        held = []
                    held.append(r)
        if held and (out := solve(held)) is not None:
            yield out

    return run


def _gathered(rows: DataFrame, members: DataFrame, pivots: int) -> DataFrame:
    """The texts of ``members`` (``key, rep, family, block, group, apart, home``), sorted by family and block."""
    if members.count() <= BROADCAST_KEYS:
        members = F.broadcast(members)
    texts = rows.withColumnRenamed("doc_id", "rep").join(members, ["key", "rep"])
    kept = texts.select("family", "block", "key", "group", "apart", "home", "fp", "text", *_table(F.col("fp"), references(pivots)))
    return kept.repartition(width(rows), "family", "block").sortWithinPartitions("family", "block", "key")


def _similar_groups(rows: DataFrame, nodes: DataFrame, words: int, similarity: float, radius: int, pivots: int, block_texts: int) -> DataFrame:
    """``key, group`` for each text that is similar to another one; ``group`` is a key of it."""
    spark = rows.sparkSession
    cells = nodes.select("key", F.posexplode("samples").alias("part", "sample"))
    # shingles of a prefix are of one kind wherever they stand
    cells = cells.select(F.xxhash64(F.least("part", F.lit(SAMPLES)), "sample").alias("cell"), "key")
    # written, so that the join deals out both sides anew and a hot cell's rows can be split
    leads = stage_table(cells.groupBy("cell").agg(F.min("key").alias("lead"), F.count("*").alias("n")).filter("n > 1").drop("n"), "leads")
    met = cells.join(leads, "cell").filter("key > lead").select(F.col("lead").alias("u"), F.col("key").alias("v")).distinct()
    family = connected_components(met).toDF("key", "family")
    members = stage_table(family.join(nodes.select("key", "rep", "bytes"), "key"), "members")
    drop_table(leads)
    sizes = members.groupBy("family").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("n") / block_texts, F.col("bytes") / BLOCK_BYTES)).cast("int")
    large = stage_table(sizes.select("family", blocks.alias("blocks")).filter("blocks > 1"), "large")
    plan = "u long, v long"
    small = members.join(large, "family", "left_anti").select("key", "rep", "family", F.lit(0).alias("block"), F.col("key").alias("group"), F.lit(True).alias("apart"), F.lit(True).alias("home"))
    links = stage_table(_gathered(rows, small, pivots).transform(mapped, _families(words, radius, similarity), plan), "links")
    if large.isEmpty():
        return connected_components(links).toDF("key", "group")
    dealt = stage_table(members.join(large, "family").withColumn("own", F.pmod(F.xxhash64("key"), "blocks").cast("int")), "dealt")
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    # hubs join the groups of blocks that belong together
    hubs = F.row_number().over(Window.partitionBy("family", "own").orderBy("key")) == 1
    hub = dealt.filter(F.col("own") < HUBS).withColumn("hub", hubs).filter("hub").select("key", F.lit(True).alias("hub"))
    placed = dealt.join(hub, "key", "left").withColumn("block", F.explode(F.when(F.col("hub"), everywhere).otherwise(F.array("own"))))
    first = placed.select("key", "rep", "family", "block", F.col("key").alias("group"), F.lit(True).alias("apart"), F.lit(True).alias("home"))
    links = links.unionByName(_gathered(rows, stage_table(first, "first"), pivots).transform(mapped, _families(words, radius, similarity), plan))
    groups = stage_table(connected_components(links).toDF("key", "group"), "groups")
    named = stage_table(dealt.join(groups, "key", "left").withColumn("group", F.coalesce("group", "key")), "named")
    counts = named.groupBy("family", "group").agg(F.count("*").alias("n"))
    tops = counts.groupBy("family").agg(F.max(F.struct("n", "group")).alias("top"), F.count("*").alias("groups")).filter("groups > 1")
    rest = named.join(tops.select("family", F.col("top.group").alias("top")), "family").withColumn("apart", F.col("group") != F.col("top"))
    rest = rest.withColumn("block", F.explode(F.when(F.col("apart"), everywhere).otherwise(F.array("own")))).withColumn("home", F.col("block") == F.col("own"))
    rest = stage_table(rest.select("key", "rep", "family", "block", "group", "apart", "home"), "rest")
    more = stage_table(_gathered(rows, rest, pivots).transform(mapped, _families(words, radius, similarity), plan), "links")
    # groups are stars of links, and the new links join them
    return connected_components(more.unionByName(groups.toDF("u", "v"))).toDF("key", "group")


def similar_texts(docs: DataFrame, words: int = TEXT_SHINGLE, similarity: float = SIMILARITY, radius: int = WIDE_RADIUS, pivots: int = PIVOTS, block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """``doc_id, print, component_id, component_print`` for each row of ``docs`` (``doc_id, text``) with an id.

    Texts are linked if at least ``similarity`` of all their different shingles
    are common to both; ``component_id`` is the least ``doc_id`` that links
    reach. Rows of one id may have different texts; these are told apart by
    ``print``, a hash of the text, and of such rows the one of least
    ``component_print`` comes first. Words are those of ``fingerprint``; texts with the same words are one
    node, and null, empty and blank texts are such. All pairs of a family are
    held against each other unless links have joined them already. A family of
    more than ``block_texts`` texts is dealt out in blocks: each is solved by
    itself together with a few texts that go to all blocks, and what the largest
    group then leaves out is held against all blocks. Repeated rows give repeated
    results, rows without an id none; other columns are ignored; an empty table
    gives none.
    """
    rows = stage_table(_signatures(docs.filter("doc_id is not null"), words, similarity), "signatures")
    one = F.min(F.struct("doc_id", "print", F.octet_length("text").alias("bytes"))).alias("one")
    nodes = rows.groupBy("key").agg(one, F.first("samples").alias("samples"))
    nodes = nodes.select("key", "samples", F.col("one.doc_id").alias("rep"), F.col("one.print").alias("rep_print"), F.coalesce("one.bytes", F.lit(0)).alias("bytes"))
    nodes = stage_table(nodes, "nodes")
    groups = _similar_groups(rows, nodes, words, similarity, radius, pivots, block_texts)
    labels = nodes.select("key", "rep", "rep_print").join(groups, "key", "left").select("key", F.struct("rep", "rep_print").alias("rep"), F.coalesce("group", "key").alias("group"))
    labels = stage_table(labels, "labels")
    least = labels.groupBy("group").agg(F.min("rep").alias("least"))
    found = labels.join(least, "group").select("key", F.col("least.rep").alias("component_id"), F.col("least.rep_print").alias("component_print"))
    return rows.select("doc_id", "print", "key").join(found, "key").select("doc_id", "print", "component_id", "component_print")
