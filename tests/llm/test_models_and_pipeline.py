from __future__ import annotations

import zlib

import numpy as np
import pytest

from pagequarry.llm import langid, lm_score
from pagequarry.llm.common import shared_dir

SF = "/root/testdata/sf0.001"


def test_network_gradients_learn_two_scripts():
    texts = ["abab abba baab " * 9, "xyzz yxyz zzyx " * 9] * 40
    net = langid.train(texts, ["a", "x"] * 40, epochs=3)
    windows = np.zeros((2, langid.WINDOW), np.uint8)
    for i, t in enumerate(texts[:2]):
        b = np.frombuffer(t.encode()[: langid.WINDOW], np.uint8)
        windows[i, : len(b)] = b
    p = net.probabilities(windows)
    assert p.argmax(axis=1).tolist() == [0, 1] and np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_training_is_reproducible():
    texts, labels = ["der die das und " * 9, "the and of to in " * 9] * 20, ["de", "en"] * 20
    a, b = langid.train(texts, labels, epochs=1), langid.train(texts, labels, epochs=1)
    assert (a.kernel == b.kernel).all() and (a.embed == b.embed).all()


def plain_prediction(net, text):
    """A document's language and score, one window, position and filter at a time."""
    raw, total = text.encode(), np.zeros(len(net.langs))
    e, wide = net.embed.shape[1], net.widest
    for a in range(0, len(raw), langid.WINDOW):
        window = list(raw[a : a + langid.WINDOW])
        padded = window + [0] * (langid.WINDOW - len(window) + wide - 1)
        hidden = []
        for f in range(net.kernel.shape[1]):
            best = max(sum(float(net.embed[padded[i + j]] @ net.kernel[j * e : (j + 1) * e, f]) for j in range(wide)) for i in range(langid.WINDOW))
            hidden.append(max(0.0, best + float(net.bias[f])))
        z = np.array(hidden) @ net.out + net.out_bias
        p = np.exp(z - z.max())
        total += p / p.sum() * len(window)
    return net.langs[int(total.argmax())], total.max() / len(raw)


def test_predictions_equal_brute_force(docs):
    net = langid.train(["der die das und " * 9, "the and of to in " * 9, "le la de et à " * 9] * 20, ["de", "en", "fr"] * 20, epochs=1)
    texts = ["a", "the end of it", "und das war die Frage, à la carte " * 9, "é" * 129]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.annotate(docs(texts), net).collect()}
    for i, t in enumerate(texts):
        lang, score = plain_prediction(net, t)
        assert got[i][0] == lang and abs(got[i][1] - score) < 1e-4


def test_many_labels_and_undecided_texts(spark):
    rows = [(i, f"text number {i} of its own", f"l{i}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts, labels = langid.sample(docs, n_docs=100)
    assert len(set(labels)) < 250 and len(texts) == len(labels)
    # nothing to learn from: what has a letter stays
    bare = spark.createDataFrame([(1, "abc", None), (2, "12", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in langid.with_language(bare).collect()] == [1]
    two = spark.createDataFrame([(i, ("the and of " if i % 2 else "der die das ") * 9, "en" if i % 2 else "de") for i in range(80)], "doc_id long, text string, lang string")
    assert langid.with_language(two, margin=0.5).count() == 80 and langid.with_language(two, margin=2.1).count() == 0


@pytest.fixture(scope="module")
def identified(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs.toPandas(), langid.identify(docs).toPandas()


def test_held_out_accuracy(identified):
    docs, found = identified
    both = docs.merge(found, on="doc_id")
    assert (both.held_out == both.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert both.score.between(0, 1).all()


def test_only_text_is_an_input(identified, spark):
    docs, found = identified
    train = docs[docs.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 != 2)]
    held = docs[~docs.doc_id.isin(train.doc_id)].assign(lang="xx", source="other")
    import pandas as pd

    again = langid.identify(spark.createDataFrame(pd.concat([train, held]))).toPandas()
    same = found.merge(again, on="doc_id")
    assert (same.lang_pred_x == same.lang_pred_y).all() and np.allclose(same.score_x, same.score_y)


def test_texts_without_letters_and_odd_tables(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([None, "", " \n", "123 !?", "½²", "é", "日本語", "the and of " * 4000])]
    df = spark.createDataFrame([*rows, (None, "word", None, None, None), (7, "the and of " * 4000, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(df).collect()]
    assert len(got) == 10
    assert all(p == "und" and s == 0 for i, p, s in got if i is not None and i < 5)
    assert all(p == "en" for i, p, _ in got if i is None or i >= 5)
    bare = df.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in langid.identify(bare).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0
    kept = langid.with_language(df.withColumnRenamed("source", "score"))
    assert kept.count() == 5


# ---------------------------------------------------------------- language model


def plain_scores(rows, good):
    """Losses of each row under bigram models of the other rows, from plain counts."""
    import collections
    import math
    import re

    texts = [(i, re.findall(r"\w+", (t or "").lower())) for i, t in rows]
    kinds = max(1, len({w for _, t in texts for w in t}))
    steps = [list(zip([None, *t], t, strict=False)) for _, t in texts]
    total = [sum(len(s) for (i, _), s in zip(texts, steps, strict=True) if every or i in good) for every in (0, 1)]
    scale = total[0] / total[1] if all(total) else 1.0
    out = []
    for k, (i, _) in enumerate(texts):
        losses = []
        for every in (0, 1):
            others = [s for j, ((d, _), s) in enumerate(zip(texts, steps, strict=True)) if j != k and (every or d in good)]
            pair = collections.Counter(x for s in others for x in s)
            first, second = (collections.Counter(x[c] for s in others for x in s) for c in (0, 1))
            by, n = scale if every else 1.0, sum(map(len, others))
            bits = [-math.log2((by * pair[a, b] + 8 * (by * second[b] + 0.5) / (by * n + 0.5 * kinds)) / (by * first[a] + 8)) for a, b in steps[k]]
            losses.append(sum(bits) / len(bits) if bits else None)
        out.append(tuple(losses))
    return out


def test_scores_equal_brute_force(spark, rnd, monkeypatch):
    words = "alpha Beta gamma delta épsilon zeta eta".split()
    rows = [(i, " ".join(rnd.choices(words, weights=[1 + (i % 2) * k for k in range(7)], k=rnd.randint(1, 40)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "?!"), (63, "beta " * 5_000), (5, rows[5][1]), (64, "rarea once"), (None, "rareb alpha")]
    good = {i for i in range(60) if i % 2}
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as score", "1 as quality").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in good] + [(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    want = sorted((str(i), len(lm_score.words(t)), a, b) if a else (str(i), 0, 0.0, 0.0) for (i, t), (a, b) in zip(rows, plain_scores(rows, good), strict=True))
    for chunk in (lm_score.CHUNK, 300):
        monkeypatch.setattr(lm_score, "CHUNK", chunk)
        found = lm_score.score_documents(docs, labels).collect()
        assert all((r["score"] is None) == (r["n_tokens"] == 0) for r in found)
        got = sorted((str(r["doc_id"]), r["n_tokens"], r["loss_target"] or 0.0, r["loss_background"] or 0.0) for r in found)
        for x, y in zip(got, want, strict=True):
            assert x[:2] == y[:2] and abs(x[2] - y[2]) < 1e-9 and abs(x[3] - y[3]) < 1e-9


def test_scores_hold_when_the_background_grows(spark, rnd):
    words = [f"w{k}" for k in range(60)]
    say = lambda skew: " ".join(rnd.choices(words, weights=[1 + skew * (k % 5) for k in range(60)], k=200))
    good = [(i, say(4)) for i in range(20)]
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    asked = [(100, say(4)), (101, say(0)), (102, say(1))]
    score = lambda n: {r["doc_id"]: r["score"] for r in lm_score.score_documents(spark.createDataFrame(good + asked + [(1000 + i, say(0)) for i in range(n)], "doc_id long, text string"), labels).collect()}
    few, many = score(60), score(600)
    assert few[100] < few[102] < few[101] and many[100] < many[102] < many[101]
    assert max(abs(few[i] - many[i]) for i in (100, 101, 102)) < 0.25 * abs(few[100] - few[101])


def test_models_are_distributions(rnd):
    pair = np.array([rnd.choice([0, 0, 1, 2.5, 9]) for _ in range(6)])
    second = pair + np.array([rnd.randint(0, 5) for _ in range(6)])
    p = 2.0 ** -lm_score.bits(pair, pair.sum(), second, second.sum(), 6)
    assert abs(p.sum() - 1) < 1e-9


def test_target_documents_score_lower(spark, rnd):
    rows = [(i, " ".join(rnd.choices(["good", "fine", "x"], [5, 4, 1], k=50) if i % 2 else rnd.choices(["bad", "junk", "x"], [5, 4, 1], k=50))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in lm_score.score_documents(docs, labels).collect()}
    assert max(got[i] for i in range(41, 80, 2)) < min(got[i] for i in range(40, 80, 2))


def test_no_target_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert lm_score.score_documents(docs, labels).count() == 1
    assert lm_score.score_documents(docs.limit(0), labels).count() == 0


# ---------------------------------------------------------------- pipeline


def test_shared_folder_is_the_session_s(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stages_keep_and_drop_what_they_should(spark, tmp_path, rnd):
    import corpus_pipeline as cp

    words = [f"w{rnd.randint(0, 400)}x" for _ in range(3000)]
    say = lambda k, n: " ".join(words[(k * 37 + j) % 3000] for j in range(n))
    item = say(77, 30)
    rows = [(i, say(i * 3, 60) + "\nAll rights reserved.", "en", f"s{i % 12}", 0) for i in range(40)]
    rows += [(100, rows[5][1], "en", "s0", 0), (101, rows[5][1].replace(" w", "  w"), "en", "s1", 0), (102, "!!! 123", "en", "s1", 0), (103, None, "en", "s1", 0)]
    rows += [(104, say(9000, 100) + " " + item + " " + say(500, 100), "en", "s2", 0), (7, rows[7][1], "en", "s7", 0), (None, say(8000, 50), "en", None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(cp.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs.collect()
        assert name == "sentencepiece" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    first = [r["doc_id"] for r in seen["language_id"]]
    assert not {102, 103} & set(first) and len(first) == len(rows) - 2
    assert all("All rights" not in r["text"] for r in seen["line_dedup"] if r["doc_id"] is not None and r["doc_id"] < 40)
    assert all(r["n_chars"] == len(r["text"]) for r in seen["line_dedup"])
    third = [r["doc_id"] for r in seen["simhash_near_dedup"]]
    assert not {100, 101} & set(third) and third.count(7) == 1 and 5 in third and None in third
    assert 104 in third and 104 not in [r["doc_id"] for r in seen["decontamination"]]
    assert len(seen["sentencepiece"]) == len(seen["decontamination"]) and all(r["exact"] for r in seen["sentencepiece"])


def test_near_copies_go(spark, rnd):
    import corpus_pipeline as cp

    rows = []
    for i in range(0, 40, 2):
        text = [f"w{rnd.randint(0, 5000)}" for _ in range(60)]
        changed = [*text[:30], "other", *text[31:]]  # 51 of 61 shingles in common
        rows += [(i, " ".join(text), "en", "s", 0), (i + 1, " ".join(changed), "en", "s", 0)]
    half = rows[0][1].split()
    rows += [(50, " ".join([*half[:30], *[f"x{k}" for k in range(30)]]), "en", "s", 0)]
    rows += [(100 + k, f"u{k} " + rows[2][1], "en", "s", 0) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in cp.near_duplicates(spark, docs, "").collect()) == [*range(0, 40, 2), 50]


def test_rows_of_one_id_and_other_columns_stay(spark, tmp_path):
    import corpus_pipeline as cp

    text = {x: " ".join(f"{x}{k}" for k in range(30)) for x in "abc"}
    near = " ".join([*text["a"].split()[:-1], "other"])
    for given, want in (
        ([(1, "a"), (1, "b"), (2, "c"), (3, "c"), (3, "near")], {(1, "a"), (1, "b"), (2, "c")}),
        ([(1, "a"), (2, "b"), (2, "a"), (2, "b")], {(1, "a"), (2, "b")}),
    ):
        full = text | {"near": near}
        rows = [(i, full[x], "en", f"s{k}", 0, k, "p") for k, (i, x) in enumerate(given)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_lines int, print string")
        got = cp.near_duplicates(spark, docs, "").collect()
        assert sorted((r["doc_id"], r["text"]) for r in got) == sorted((i, full[x]) for i, x in want)
    # columns that operators use themselves pass through all stages
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_removed long, score int, lang_pred string").withColumn("a.b", cp.F.lit(1))
    spark.createDataFrame([(1, "no such item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in cp.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        assert {(r["n_removed"], r["score"], r["lang_pred"], r["a.b"]) for r in after.collect()} <= {(0, k, "p", 1) for k in range(9)}
        docs = after


def test_pipeline_of_empty_table(spark, tmp_path):
    import corpus_pipeline as cp

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)
