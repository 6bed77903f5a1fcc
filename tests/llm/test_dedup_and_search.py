from __future__ import annotations

import collections
import hashlib

import numpy as np
import pytest

from pagequarry.llm import decontaminate as dc
from pagequarry.llm import line_dedup as ld
from pagequarry.llm import suffix_dedup as sd


# ---------------------------------------------------------------- lines


def plain_lines(rows, min_sites):
    sites = collections.defaultdict(set)
    for text, site in rows:
        for line in (text or "").split("\n") if text is not None else []:
            if line.strip(" \t\r"):
                sites[line.strip(" \t\r")].add(site or "")
    out = []
    for text, _ in rows:
        if text is None:
            out.append((None, 0, 0))
            continue
        parts = text.split("\n")
        gone = {k for k, x in enumerate(parts) if len(sites.get(x.strip(" \t\r"), ())) >= min_sites and x.strip(" \t\r")}
        if not any(x.strip(" \t\r") for k, x in enumerate(parts) if k not in gone):
            gone = set()
        out.append(("\n".join(x for k, x in enumerate(parts) if k not in gone), len(parts), len(gone)))
    return out


@pytest.mark.parametrize("min_sites", [1, 2, 4])
def test_lines_equal_brute_force(docs, rnd, min_sites):
    pool = ["All rights reserved.", " All rights reserved.\r", "", "  ", "share é", "menu"] + [f"line {i} with words of its own" for i in range(40)]
    rows = [("\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 8))), f"s{rnd.randint(0, 5)}") for _ in range(80)]
    rows += [(None, "s0"), ("", "s1"), ("menu", None), ("x\n" * 20_000, "s2"), ("menu\na long line that is no boilerplate at all", "s3")] * 2
    df = docs([(i, t, "en", s, 0) for i, (t, s) in enumerate(rows)])
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in ld.without_shared_lines(df, min_sites).collect()}
    assert got == dict(enumerate(plain_lines(rows, min_sites)))


def test_copies_are_left_whole_and_odd_tables_pass(docs):
    df = docs([(i % 3, "same line one\nsame line two", "en", f"s{i}", 0) for i in range(12)])
    clashing = df.selectExpr("*", "1 as _row", "2 as _doc", "3 as _drop", "4 as `a.b`").withColumnRenamed("lang", "n_removed")
    got = ld.without_shared_lines(clashing, 3).collect()
    assert {(r["_row"], r["_doc"], r["_drop"], r["a.b"]) for r in got} == {(1, 2, 3, 4)}
    assert {r["text"] for r in got} == {"same line one\nsame line two"} and {r["n_removed"] for r in got} == {0}
    assert ld.without_shared_lines(df.limit(0)).count() == 0


def test_carriers_lose_shared_lines_however_long(docs):
    passage = "a passage that many sites carry " * 40
    rows = [(i, f"own {i}\n{passage}", "en", f"s{i}", 0) for i in range(12)] + [(20, passage, "en", "s1", 0)]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in ld.without_shared_lines(docs(rows)).collect()}
    assert got == {i: (f"own {i}", 1) for i in range(12)} | {20: (passage, 0)}


def test_main_path_has_no_python(docs):
    plan = ld.without_shared_lines(docs(["a\nb"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---------------------------------------------------------------- benchmark items


def plain_contained(texts, items, threshold=0.8):
    def shingles(t, n):
        w = (t or "").encode().lower().split()
        return {b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}

    out = []
    for d, t in enumerate(texts):
        for k, item in items:
            n = min(5, len(item.split()))
            if not n:
                continue
            s, q = shingles(t, n), shingles(item, n)
            if q and len(q & s) >= dc.needed(len(q), threshold):
                out.append((d, k, len(q & s), len(q)))
    return sorted(out)


@pytest.mark.parametrize("block", [500_000, 30])
def test_containment_equals_brute_force(docs, spark, rnd, block):
    words = [f"w{i}" for i in range(60)] + ["É", "naïve."]
    say = lambda n: [rnd.choice(words) for _ in range(n)]
    items = [(k, " ".join(say(rnd.choice([3, 5, 8, 20, 50])))) for k in range(20)]
    items += [(99, items[3][1]), (3, items[3][1]), (50, None), (51, " "), (52, "É"), (53, "w1 w1"), (54, "w7 W8 w9"), (None, "a b c d e f")]
    texts = [None, "", "one two", "w1 " * 30_000]
    for _ in range(60):
        body = say(rnd.randint(0, 400))
        part = items[rnd.randrange(20)][1].split()
        for k in range(len(part)):
            if rnd.random() < 0.03:
                part[k] = "edited"
        at = rnd.randint(0, len(body))
        texts.append(rnd.choice([" ", "\n", " \t"]).join([*body[:at], *map(str.upper, part), *body[at:]]))
    texts += [texts[5], texts[5]]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["n_shared"], r["n_shingles"]) for r in dc.contained_items(docs(texts), table, block=block).collect())
    named = sorted({(k, t) for k, t in items if k is not None and t is not None})
    want = plain_contained(texts, named)
    assert got == want and want
    clean = {r["doc_id"] for r in dc.without_items(docs(texts), table, block=block).collect()}
    assert clean == set(range(len(texts))) - {d for d, *_ in want}


def test_long_texts_are_searched_in_windows(docs, spark, rnd, monkeypatch):
    words = [f"w{i}" for i in range(500)]
    item = " ".join(rnd.choices(words, k=12))
    texts = [" ".join([*rnd.choices(words, k=n), item, *rnd.choices(words, k=300)]) for n in range(0, 120, 7)]
    table = spark.createDataFrame([(1, item), (2, item.rsplit(" ", 9)[0]), (3, "nowhere")], "item_id long, text string")
    want = sorted(map(tuple, dc.contained_items(docs(texts), table).collect()))
    index = dc.build([(1, item), (2, item.rsplit(" ", 9)[0]), (3, "nowhere")])
    for size in (64, 100, 257):
        monkeypatch.setattr(dc, "LONG", size)
        got = [(d, index.ids[k], n) for d, t in enumerate(texts) for _, k, n in dc.search(index, memoryview(t.encode()), np.array([0, len(t)]))]
        assert sorted(got) == [r[:3] for r in want] and got


def test_no_items_or_no_documents(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert dc.contained_items(docs(["a b c d e f"]), none).count() == 0
    assert dc.contained_items(docs(["x"]).limit(0), some).count() == 0
    assert dc.without_items(docs(["a b c d e f"]), none).count() == 1


def test_shingle_hashes_depend_on_words_only():
    def hashes(t):
        b = np.frombuffer(t.encode(), np.uint8)
        return dc.shingle_hashes(b, np.array([0, len(b)]))[0].tolist()

    assert hashes("a b c d e f") == hashes("  A\tb\nC d\x0be  F ")
    assert hashes("a b c d e")[0] == hashes("zz a b c d e")[1]
    assert len(hashes("a b c d")) == 0


# ---------------------------------------------------------------- repeated strings


def plain_repeats(texts, n):
    seen = collections.Counter(b[i : i + n] for b in texts for i in range(len(b) - n + 1))
    out = []
    for b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = [True] * n
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def test_suffix_arrays_and_common_prefixes(rnd):
    for _ in range(200):
        s = [rnd.randint(0, rnd.choice([1, 3, 20])) for _ in range(rnd.randint(0, 60))]
        sa = sd.suffix_array(s, 21)
        assert sa == sorted(range(len(s)), key=lambda i: s[i:])
        phi, shared = sd.permuted_prefixes(s, sa)
        for a, b in zip(sa, sa[1:], strict=False):
            k = 0
            while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
                k += 1
            assert (phi[b], shared[b]) == (a, k)


@pytest.mark.parametrize("group_max", [4096, 2])
def test_repeats_equal_brute_force(docs, rnd, group_max):
    base = ["".join(rnd.choice("abcdefgh .") for _ in range(300)) for _ in range(6)]
    texts = [None, "", "é" * 30, "ab" * 80, "ab" * 21, "x" * 39, "x" * 40, "x" * 41]
    for _ in range(50):
        x = rnd.choice(base)
        k = rnd.random()
        if k < 0.3:
            x = "".join(rnd.choice(base)[a : a + rnd.randint(10, 200)] for a in [rnd.randint(0, 200) for _ in range(4)])
        elif k < 0.7:
            y = list(x)
            for _ in range(rnd.randint(1, 4)):
                y[rnd.randrange(len(y))] = rnd.choice("xyzé")
            x = "".join(y)
        texts.append(x)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in sd.digests(sd.without_repeats(docs(texts), 40, 20, 500, group_max)).collect()}
    assert got == dict(enumerate(plain_repeats([(t or "").encode() for t in texts], 40)))


def test_full_length_and_odd_tables(spark, rnd):
    part = "".join(rnd.choice("abcdefghij ") for _ in range(450))
    rows = [(1, "p" + part + "q"), (2, part), (None, "zz" + part[:399]), (3, "own text"), (3, "own text"), (4, "r" * 70_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as spans", "2 as _row")
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in sd.digests(sd.without_repeats(df)).collect())
    assert got == sorted([("1", 450), ("2", 450), ("None", 0), ("3", 0), ("3", 0), ("4", 70_000)])
    assert sd.without_repeats(df.limit(0)).count() == 0


def test_rows_that_repeat_lose_their_strings(spark):
    df = spark.createDataFrame([(3, "y" + "xyz" * 200), (3, "y" + "xyz" * 200)], "doc_id long, text string")
    assert [r["n_removed"] for r in sd.digests(sd.without_repeats(df)).collect()] == [601, 601]
