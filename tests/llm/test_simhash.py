from __future__ import annotations

import collections
import itertools
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagequarry.llm import simhash
from pagequarry.llm.components import connected_components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for k in range(64):
            ones[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(shingles))


def components(ids, linked):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(label[a], label[b])
            for x in (a, b):
                if label[x] != m:
                    label[x], changed = m, True
    return label


TEXTS = [None, "", " \t\n", "One", "one", "ONE two", "É x", "a b c", "a b c a b c a b c", "line\x0bone\x0ctwo\rthree", "x y z w", "é" * 50]


def test_fingerprint_follows_the_definition(rnd):
    for t in [*TEXTS, *(" ".join(rnd.choice("Ab cde f gh iJ".split()) for _ in range(rnd.randint(1, 60))) for _ in range(50))]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_native_hash_is_the_seeded_one(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("cell_max", [4096, 3])
def test_links_equal_brute_force(spark, rnd, cell_max):
    centres = [rnd.getrandbits(64) for _ in range(5)]
    fps = {rnd.choice(centres) ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 4))) for _ in range(250)}
    fps |= {rnd.getrandbits(64) for _ in range(50)} | {0, 2**64 - 1}
    fps = sorted(fps)
    df = spark.createDataFrame([(i, f - 2**64 if f >= 2**63 else f) for i, f in enumerate(fps)], "rep long, fp long")
    links = simhash.fingerprint_links(df, cell_max=cell_max)
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    want = components(range(len(fps)), pairs)
    assert [got.get(i, i) for i in range(len(fps))] == [want[i] for i in range(len(fps))]


def test_documents(docs):
    long = "w " * 30_000
    rows = docs([*TEXTS, long, long, "a b c"]).withColumn("fp", F.lit(1)).withColumn("component", F.lit(2))
    got = {r["doc_id"]: r for r in simhash.near_duplicates(rows).collect()}
    fps = {i: plain_fingerprint(r) for i, r in enumerate([*TEXTS, long, long, "a b c"])}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: format(f, "016x") for i, f in fps.items()}
    want = components(fps, [(i, j) for i in fps for j in fps if (fps[i] ^ fps[j]).bit_count() <= 3])
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert got[1]["component_id"] == 0 and got[2]["component_id"] == 0


def test_rows_that_repeat_and_rows_without_id(spark):
    df = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "q r s t u v")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.near_duplicates(df).collect())
    assert got == [("5", "5"), ("5", "5"), ("None", "5"), ("None", "None")]


def test_empty_table(docs, spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_on_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "u long, v long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_coordinate_difference_never_drops_a_link(rnd):
    pivots = np.array(simhash.references(), np.uint64)
    for _ in range(200):
        a = rnd.getrandbits(64)
        b = a ^ sum(1 << k for k in rnd.sample(range(64), 3))
        gap = np.bitwise_count(pivots ^ np.uint64(a)).astype(int) - np.bitwise_count(pivots ^ np.uint64(b)).astype(int)
        assert np.abs(gap).max() <= 3


def plain_shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([" ".join(words)])


def plain_groups(texts):
    sets = {i: plain_shingles(t) for i, t in texts.items()}
    holders = collections.defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    met = {p for h in holders.values() for p in itertools.combinations(sorted(h), 2)}
    near = [(a, b) for a, b in met if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    return near, components(texts, near)


def test_similar_texts_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    near, want = plain_groups({r["doc_id"]: r["text"] for r in docs.collect()})
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_texts(docs).collect()}
    assert near and sum(got[a] == got[b] for a, b in near) >= 0.98 * len(near)
    assert all(want[i] == want[c] for i, c in got.items())


@pytest.mark.parametrize("block_texts", [1024, 17])
def test_large_groups_of_similar_texts(spark, rnd, block_texts):
    # two bases that share most shingles, though not enough, and many near copies of either
    base = [f"w{rnd.randint(0, 9000)}" for _ in range(100)]
    half = [*base[:72], *[f"x{k}" for k in range(28)]]
    texts = {}
    for i in range(120):
        words = list(base if i % 2 else half)
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(100)] = f"y{rnd.randint(0, 10**6)}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    near, want = plain_groups(texts)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_texts(docs, block_texts=block_texts).collect()}
    assert sum(got[a] == got[b] for a, b in near) >= 0.98 * len(near)
    assert all(want[i] == want[c] for i, c in got.items())


def test_block_links_are_those_of_brute_force(rnd):
    sets = []
    for _ in range(60):
        base = rnd.choice([range(0, 40), range(30, 70), range(100, 130)])
        sets.append(np.unique(np.array([x if rnd.random() > 0.08 else rnd.randrange(1000, 9999) for x in base], ">u8")))
    n, none = len(sets), np.zeros((len(sets), 2), np.int16)
    group = np.array([rnd.randrange(8) if rnd.random() < 0.3 else 100 + k for k in range(n)])
    apart, home = np.array([rnd.random() < 0.6 for _ in range(n)]), np.array([rnd.random() < 0.7 for _ in range(n)])
    u, v = simhash._block_links(np.arange(n), np.zeros(n, np.uint64), none, sets, group, apart, home, 3, 0.8)
    near = lambda a, b: len(set(sets[a].tolist()) & set(sets[b].tolist())) >= 0.8 * len(set(sets[a].tolist()) | set(sets[b].tolist()))
    same = [(i, j) for i in range(n) for j in range(i) if group[i] == group[j]]
    pairs = [(a, b) for a in range(n) for b in range(n) if apart[a] and home[b] and a != b and near(a, b)]
    assert u and len(u) < n and all(near(a, b) for a, b in zip(u, v, strict=True))
    assert components(range(n), same + list(zip(u, v, strict=True))) == components(range(n), same + pairs)


def test_similar_texts_of_odd_tables(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c d e"), (6, "a b c d e"), (None, "a b"), (9, "z " * 30_000), (8, "z z " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as component", "3 as samples")
    got = sorted((r["doc_id"], r["component_id"]) for r in simhash.similar_texts(df).collect())
    assert got == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (6, 6), (8, 8), (9, 8)]
    assert simhash.similar_texts(df.limit(0)).count() == 0


def test_no_pair_of_short_texts_is_lost(spark, rnd):
    texts, pairs = {}, collections.defaultdict(list)
    for n in range(1, 45):
        for _ in range(12):
            a = [f"v{rnd.randrange(10**7)}" for _ in range(n + 4)]
            changed = list(a)
            changed[rnd.choice([0, -1])] = "other"
            middle = [*a[: n // 2], "other", *a[n // 2 + 1 :]]
            for b in (a[:-1], a[1:], a[1:-1], [*a, "more"], ["more", *a], changed, middle, a[: -max(1, n // 5)], [w.upper() for w in a]):
                b = [*b, *[f"u{rnd.randrange(10**7)}" for _ in range(rnd.choice([0, 0, 1]))]]
                if len(plain_shingles(" ".join(a)) & plain_shingles(" ".join(b))) >= 0.8 * len(plain_shingles(" ".join(a)) | plain_shingles(" ".join(b))) - 1e-9:
                    i = len(texts)
                    # a number of its own keeps pairs apart from each other
                    texts[i], texts[i + 1] = " ".join(a), " ".join(b)
                    pairs[n].append((i, i + 1))
                    a = [f"v{rnd.randrange(10**7)}" for _ in range(n + 4)]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_texts(docs).collect()}
    found = {n: [got[a] == got[b] for a, b in p] for n, p in pairs.items()}
    assert sum(map(len, found.values())) > 400 and 4 in found and 5 in found
    assert all(all(f) for n, f in found.items() if n <= 25)
    late = [x for n, f in found.items() if n > 25 for x in f]
    assert sum(late) >= 0.99 * len(late)


def test_rows_of_one_id_are_told_apart_by_their_texts(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "d e f"), (2, "g h i"), (3, "g h  i")], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"], r["print"] == r["component_print"]) for r in simhash.similar_texts(df).collect()}
    assert got == {(1, 1, True), (2, 2, True), (3, 2, False)}
