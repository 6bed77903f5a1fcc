from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.llm import merkle, spelling
from pagequarry.llm.common import crc32_sql

# ---------------------------------------------------------------- manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(nodes, arity):
    """The root and for each node the siblings before and after it on each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at, strict=True):
            a = i - i % arity
            path.append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + arity])))
        nodes, at = [digest(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)], [i // arity for i in at]
    return nodes[0], paths


def plain_manifest(rows, arity=2):
    """From rows of doc_id, source, lang, n_chars, text."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [plain_tree([m[2] for m in sorted(groups[g], key=lambda m: m[:3])], arity) for g in order]
    root, upper = plain_tree([t[0] for t in trees], arity)
    out = []
    for g, (subroot, paths), above in zip(order, trees, upper, strict=True):
        for (_, _, leaf, r), path in zip(sorted(groups[g], key=lambda m: m[:3]), paths, strict=True):
            path, h = path + above, leaf
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                h = plain_leaf((*r[:3], r[3] + 1, r[4]))
            for before, after in path:
                h = digest(before, h, after)
            out.append((r[0], leaf, subroot, root, digest(*[b + a for b, a in path]), h, h == root))
    return sorted(out, key=repr)


def documents(spark, rows):
    return spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")


def proofs(df, **options):
    return sorted((tuple(r) for r in merkle.digests(merkle.manifest(df, tampered=merkle.tampered_counts(), **options)).collect()), key=repr)


@pytest.mark.parametrize("arity,levels", [(2, 10), (2, 2), (3, 1)])
def test_manifest_equals_a_plain_version(spark, rnd, arity, levels):
    rows = [(i, f"s{i % 4}", rnd.choice(["en", "en", "en", "de", "", None]), i % 50, "é" * (i % 7)) for i in rnd.sample(range(10_000), 120)]
    rows += [(20_000, None, "lone", None, None), (None, "s", "en", 3, "no id"), (None, "s", "en", 3, "no id"), (7, "s", "en", 2**63 - 1, "x" * 200_000)]
    rows += [(33, "s", "de", 1, "the same row")] * 9 + [(33, "s", "de", 1, "another text of the same id")]
    got = proofs(documents(spark, rows), arity=arity, levels=levels)
    assert got == plain_manifest(rows, arity)
    assert {r[6] for r in got} == {True, False}


def test_small_and_odd_tables(spark):
    assert proofs(documents(spark, [(1, "s", "en", 1, "x")]).limit(0)) == []
    for n in (1, 2, 3, 4, 5, 8, 9):
        rows = [(i, "s", "en", i, f"text {i}") for i in range(n)]
        assert proofs(documents(spark, rows), levels=2) == plain_manifest(rows)
    rows = [(i, "s", None, None, None) for i in range(3)]
    clashing = documents(spark, rows).selectExpr("*", "1 as grp", "2 as node", "3 as pos", "4 as leaf", "5 as `a.b`")
    assert proofs(clashing) == plain_manifest(rows)


def test_any_changed_field_is_noticed(spark):
    rows = [(i, "s", "en", 4, "text") for i in range(20)]
    df = documents(spark, rows)
    got = merkle.manifest(df, tampered={"text": F.when(F.col("doc_id") == 3, "Text").otherwise(F.col("text"))}).filter("not verified").collect()
    assert [r["doc_id"] for r in got] == [3]
    assert merkle.manifest(df).filter("not verified").count() == 0


# ---------------------------------------------------------------- spelling variants


def plain_words(rows, min_chars, min_count, noise):
    counts = Counter()
    for i, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
            elif run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                counts[run if h % noise else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
                run = ""
    return {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(rows, min_chars=6, min_count=5, ratio=5, noise=199):
    words, form = plain_words(rows, min_chars, min_count, noise), {}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= ratio * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_variants_equal_brute_force(spark, rnd):
    letters = "abcé×÷ÿ"
    pool = ["".join(rnd.choice(letters) for _ in range(rnd.randint(4, 9))) for _ in range(40)] + ["aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "Straße"]
    for w in list(pool):
        k = rnd.randrange(len(w))
        pool += [w[:k] + rnd.choice(letters) + w[k:], w[:k] + rnd.choice(letters) + w[k + 1 :], w[:k] + w[k + 1 :]]
    weights = [rnd.choice([1, 1, 8, 60]) for _ in pool]
    rows = [(i, rnd.choice([" ", "_", "ā", "1", "\n"]).join(rnd.choices(pool, weights, k=400)).upper() if i % 3 == 0 else " ".join(rnd.choices(pool, weights, k=400))) for i in range(30)]
    rows += [(None, None), (None, ""), (5, "Straße " * 90_000), (5, "Straße STRAßE")] + [(9, "ab")] * 3
    for min_count, noise in ((5, 199), (1, 7)):
        got = spelling.variants(texts(spark, rows), min_count=min_count, noise=noise).collect()
        assert {tuple(r) for r in got} == plain_variants(rows, min_count=min_count, noise=noise) and len(got) == len({r["word"] for r in got})


def test_every_edit_of_a_word_is_met(rnd):
    ranks = np.array([rnd.randrange(5000) for _ in range(1 << 16)], np.int32)
    for _ in range(300):
        w = bytes(rnd.choice(b"abcd\xe9") for _ in range(rnd.randint(5, 12)))
        k, c = rnd.randrange(len(w)), bytes([rnd.choice(b"abcd\xe9")])
        for x in (w[:k] + c + w[k:], w[:k] + c + w[k + 1 :], w + c):
            short, _ = spelling.join_keys(w, ranks)
            same, longer = spelling.join_keys(x, ranks)
            assert short & (same if len(x) == len(w) else longer), (w, x)


def test_long_texts_are_read_in_parts_that_end_between_words(monkeypatch, rnd):
    monkeypatch.setattr(spelling, "PART", 16)
    text = " ".join("x" * rnd.randint(1, 60) for _ in range(200))
    assert spelling.document_words(None, text, 10**9) == Counter(w.encode() for w in text.split())


def test_tables_without_words(spark):
    assert spelling.variants(texts(spark, [(1, "short"), (2, None)])).count() == 0
    assert spelling.variants(texts(spark, [(1, "x")]).limit(0)).count() == 0
    clashing = texts(spark, [(1, "letters " * 6)]).selectExpr("*", "1 as word", "2 as n", "3 as key", "4 as form")
    assert [tuple(r) for r in spelling.variants(clashing).collect()] == [("letters", None, "letters", 6, 0, None)]
    with pytest.raises(ValueError):
        spelling.variants(texts(spark, [(1, "x")]), min_chars=3)


def test_chains_of_forms_end_at_the_root(spark):
    text = " ".join(["abcdefgh"] * 1000 + ["abcdefg"] * 150 + ["abcdef"] * 25 + ["bbcdef"] * 5)
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.variants(texts(spark, [(1, text)]), noise=10**9).collect()}
    assert got == {"abcdefgh": (None, "abcdefgh"), "abcdefg": ("abcdefgh", "abcdefgh"), "abcdef": ("abcdefg", "abcdefgh"), "bbcdef": ("abcdef", "abcdefgh")}


def test_the_checksum_of_the_sql(rnd):
    import duckdb

    for n in (0, 1, 5, 40):
        data = [rnd.randrange(256) for _ in range(n)]
        got = duckdb.execute(f"SELECT {crc32_sql('x')} FROM (SELECT {data}::BIGINT[] AS x)").fetchone()[0]
        assert got == zlib.crc32(bytes(data))
