from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pagequarry.llm import huffman_ids as hf
from pagequarry.llm import sentencepiece_viterbi as sv

BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None,
    "",
    " ",
    "Hello, WORLD. It's 3.5 o'clock <|ENDOFTEXT|> x<|endoftext|>y",
    "É é H̱ K̊ ǅ İstanbul ΣΑΣ x y z \x1c q\x85r ÀÉ ŉ ß ẞ ſ",
    "a.,b ., .. don't DON'T l'été ½ ² Ⅷ",
    "日本語 ，。 🙂🙂\n\n\n  ==== \t\t x",
    "  a  b\n c\t▁d ",
    "aaaaaaaaaaaaaaaa",
    "word " * 5000,
    "word*** word'*** word-'s _x_ x_ w<|endoftext|>! w|> été--… été.' a'.",
    "same text",
    "same text",
]


def test_word_tokens_equal_the_library(rnd):
    library, words = Tokenizer.from_file(BPE), hf.WordTokens(BPE, "<u2")
    made = ["".join(rnd.choice("abcXYZéß .,'!-*_|<>\n\t12") for _ in range(rnd.randint(0, 50))) for _ in range(300)]
    for t in [x or "" for x in [*TEXTS, *made]]:
        assert np.frombuffer(words.encode([t.encode()])[0], "<u2").tolist() == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("most", [4, 8, 16])
def test_code_lengths_are_limited_and_whole(rnd, most):
    counts = np.array([int(2 ** rnd.uniform(0, 20)) for _ in range(16)] + [0, 0])
    lengths = hf.code_lengths(counts, most)
    assert lengths.max() <= most and (lengths[counts == 0] == 0).all()
    assert sum(2.0 ** -int(n) for n in lengths[lengths > 0]) == 1


def test_code_lengths_are_optimal_where_the_limit_does_not_bind(rnd):
    import heapq

    counts = [rnd.randint(1, 1000) for _ in range(40)]
    heap = list(counts)
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    lengths = hf.code_lengths(np.array(counts), 30)
    assert int((lengths.astype(int) * np.array(counts)).sum()) == cost


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 9, 1000])
def test_blocks_round_trip(rnd, n):
    ids = np.array([min(int(rnd.expovariate(0.1)), 300) for _ in range(n)], np.uint16)
    lengths = hf.code_lengths(np.bincount(ids, minlength=301), 12)
    bits, starts = hf.encode_ids(ids, lengths, hf.canonical(lengths)[0], block=8)
    assert hf.decode_blocks(bits, starts, n, lengths, block=8).tolist() == ids.tolist()


def test_long_runs_of_blocks_round_trip(rnd):
    ids = np.array([min(int(rnd.expovariate(0.1)), 300) for _ in range(600_000)], np.uint16)
    lengths = hf.code_lengths(np.bincount(ids, minlength=301), 12)
    bits, starts = hf.encode_ids(ids, lengths, hf.canonical(lengths)[0])
    assert (hf.decode_blocks(bits, starts, len(ids), lengths) == ids).all()


def test_file_ranges(tmp_path, rnd):
    ids = np.array([rnd.randrange(50) for _ in range(500)], np.uint16)
    lengths = hf.code_lengths(np.bincount(ids, minlength=50))
    path = f"file://{tmp_path}/x.pqh"
    hf.write_file(path, np.array([3, 9]), np.array([200, 300]), ids, lengths, hf.canonical(lengths)[0], block=16)
    f = hf.IdFile(path)
    for a, z in [(0, 500), (0, 1), (15, 17), (16, 32), (499, 500), (250, 250), (33, 421)]:
        assert f.ids(a, z).tolist() == ids[a:z].tolist()
    with pytest.raises(ValueError):
        (tmp_path / "y").write_bytes(b"no")
        hf.IdFile(f"file://{tmp_path}/y")


def test_stored_ids_equal_the_library(docs):
    library, start, want = Tokenizer.from_file(BPE), 0, []
    for i, t in enumerate(TEXTS):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = hf.digests(hf.stored_ids(docs(TEXTS).sample(1.0).repartition(3), BPE, block=32))
    assert sorted(map(tuple, got.collect())) == want


def test_stored_ids_of_odd_tables(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (1, "a"), (None, "c")], "doc_id long, text string")
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in hf.digests(hf.stored_ids(df.selectExpr("*", "7 as ids", "8 as start"), BPE)).collect())
    assert got == [(0, None, 2), (2, 1, 2), (4, 1, 2), (6, 2, 2)]
    assert hf.stored_ids(df.limit(0), BPE).count() == 0


def test_pieces_equal_the_library(rnd):
    library, codec = sentencepiece.SentencePieceProcessor(model_file=PIECES), sv.Codec(PIECES)
    made = ["".join(rnd.choice("abcehinorst  .,=-_/\n") for _ in range(rnd.randint(1, 60))) for _ in range(400)]
    made += ["".join(rnd.choice("aaab ") for _ in range(rnd.randint(1, 60))) for _ in range(200)]
    texts = [x or "" for x in [*TEXTS, *made]]
    for t, ids in zip(texts, codec.encode(texts), strict=True):
        found = np.frombuffer(ids, "<i4")
        assert found.tolist() == library.encode(t)
        assert codec.decode(found) == library.decode(library.encode(t)) == t.replace("▁", " ")


def test_memory_of_words_is_bounded_and_changes_nothing(rnd, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [" ".join("".join(rnd.choice("abcehinorst") for _ in range(rnd.randint(1, 12))) for _ in range(3000)), "nospaces" * 9000, "", "  x   y " * 500]
    monkeypatch.setattr(sv, "PART", 64)
    codec = sv.Codec(PIECES, room=20_000)
    codec.viterbi = sv.Viterbi(codec.model, pairs=50)
    for t, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(t)
        assert codec.held <= 20_000 and len(codec.viterbi.after) <= 50


def test_unigram_models_take_the_best_path(rnd):
    pieces = ["<unk>", "a", "b", "ab", "ba", "aba", "abab", "bb"]
    scores = [0.0, -2.0, -2.5, -3.0, -3.2, -4.1, -6.5, -3.0]
    model = sv.Model(pieces, scores, [sv.UNKNOWN] + [sv.NORMAL] * 7, False, 0, True, False, "identity")
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9))) for _ in range(100)}

    def best(w):
        if not w:
            return 0.0
        return max(scores[i] + best(w[len(p) :]) for i, p in enumerate(pieces) if i and w.startswith(p))

    for w, path in sv.Viterbi(model).encode_words(sorted(words)).items():
        assert "".join(pieces[i] for i in path) == w
        assert abs(sum(scores[i] for i in path) - best(w)) < 1e-9


def test_round_trip_and_decode(docs, spark):
    df = docs(TEXTS)
    got = {r["doc_id"]: r for r in sv.round_trip(df, PIECES).collect()}
    assert all(r["exact"] for r in got.values()) and got[0]["n_tokens"] == got[1]["n_tokens"] == 0
    back = {r["doc_id"]: r["text"] for r in sv.decode(sv.encode(df, PIECES), PIECES).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(TEXTS)}
    clashing = df.selectExpr("*", "1 as n_tokens", "2 as exact", "3 as ids")
    assert sorted(map(tuple, sv.round_trip(clashing, PIECES).collect())) == sorted(map(tuple, got.values()))
    assert sv.round_trip(df.limit(0), PIECES).count() == 0
