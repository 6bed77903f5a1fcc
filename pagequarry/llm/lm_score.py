"""Cross-entropy difference of documents under two matched bigram models.

The target model counts documents labelled as good, the background model all
documents. Both share one vocabulary, every word of the corpus, and one
smoothing; background counts are scaled to the target's number of tokens, so
neither is smoother for its size, and a corpus of more documents of the same kind
gives the same losses. A document is scored by models of all other documents: its
own counts are taken out first. The score is the mean over its tokens of the
target's loss less the background's, in bits: the lower, the more it is like the
target.

Words are known by 64-bit hashes, and no table of them or of their bigrams is
ever in one place. Tasks write documents in chunks of ``CHUNK`` words. A chunk
asks for each of its different bigrams and words once, however often it holds
them, and tells its counts; requests are dealt out by hash into buckets, which
sum what the chunks hold and answer in the order of the request. So a frequent
word or bigram costs a row in each chunk at most, and a bucket about ``BUCKET``
words of input.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, stage_table, width

#: Tokens that a context is given from single words before its own count.
PRIOR = 8.0
WORDS_HELD = 200_000
CHUNK = 650_000
BUCKET = 600_000
BROADCAST_IDS = 1_000_000
START = 1
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class _Keys(dict):
    """The hash of each word met."""

    def __missing__(self, word: str) -> int:
        self[word] = key = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return key


def _pack(*arrays: np.ndarray) -> bytes:
    small = [a.astype(np.min_scalar_type(int(a.max()))) if len(a) and a.dtype.kind in "iu" and a.min() >= 0 else a for a in arrays]
    data = pickle.dumps(small, 5)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> list[np.ndarray]:
    return pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True))


def _chunks(docs: DataFrame) -> DataFrame:
    """``chunk, n, n_target, data`` from ``doc_id, text, target``: documents in chunks of about ``CHUNK`` words.

    ``data`` has ids and which of them are null, targets, numbers of words, the
    chunk's different keys in order, and the place of each word among these.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, rows, seen = _Keys(), [], 0, 0
        task = TaskContext.get().partitionId() << 32

        def out() -> pa.RecordBatch:
            ids, good, tokens = zip(*held, strict=True)
            sizes, good = np.array([len(t) for t in tokens]), np.array(good, bool)
            mine, place = np.unique(np.concatenate(tokens), return_inverse=True)
            data = _pack(np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids]), good, sizes, mine, place)
            held.clear()
            return pa.RecordBatch.from_pydict({"chunk": [task + rows], "n": [int(sizes.sum())], "n_target": [int(sizes[good].sum())], "data": [data]})

        for b in batches:
            for i, t, good in zip(*b.columns, strict=True):
                found = words(t.as_py())
                held.append((i.as_py(), good.as_py(), np.fromiter(map(keys.__getitem__, found), np.uint64, len(found))))
                seen += len(found)
                if len(keys) > WORDS_HELD:
                    keys.clear()
                if seen >= CHUNK or len(held) >= CHUNK:
                    yield out()
                    rows, seen = rows + 1, 0
        if held:
            yield out()

    return docs.select(F.col("doc_id").cast("long"), "text", "target").transform(mapped, run, "chunk long, n long, n_target long, data binary")


class _Chunk:
    """A chunk's documents and different bigrams: previous and current place among its keys, the last of which is the start."""

    def __init__(self, data: bytes):
        self.ids, self.null, self.good, sizes, keys, place = _unpack(data)
        self.sizes, self.place = sizes.astype(np.int64), place.astype(np.int64)
        self.keys = np.append(keys.astype(np.uint64), np.uint64(START))
        self.before = np.empty_like(self.place)
        self.before[1:] = self.place[:-1]
        self.first = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        self.before[self.first] = len(keys)
        pairs, self.pair = np.unique(self.before * len(self.keys) + self.place, return_inverse=True)
        self.a, self.b = pairs // len(self.keys), pairs % len(self.keys)
        self.target = np.repeat(self.good, self.sizes)

    def counts(self) -> list[np.ndarray]:
        """How often target documents and all documents of the chunk hold each bigram."""
        return [np.bincount(x, minlength=len(self.a)) for x in (self.pair[self.target], self.pair)]

    def word_counts(self) -> list[np.ndarray]:
        """How often target documents and all documents hold each key as the second and as the first word of a bigram."""
        n, t = len(self.keys), self.target
        return [np.bincount(x, minlength=n) for x in (self.place[t], self.place, self.before[t], self.before)]

    def bigram_keys(self) -> np.ndarray:
        return self.keys[self.a] * _PRIME + self.keys[self.b]

    def own(self, what: np.ndarray) -> np.ndarray:
        """For each token: how often its document holds ``what`` is there."""
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        _, at, n = np.unique(owner * (int(what.max()) + 1) + what, return_inverse=True, return_counts=True)
        return n[at]


def _asked(chunk: int, keys: np.ndarray, values: list[np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    """Requests of a chunk: a row for each bucket that has one of its keys."""
    bucket = keys % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    got, start = np.unique(bucket[order], return_index=True)
    parts = [order[i:j] for i, j in zip(start, [*start[1:], len(order)], strict=True)]
    data = [_pack(keys[p], *[v[p] for v in values]) for p in parts]
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), chunk)), pa.array(got.astype(np.int64)), pa.array(data, pa.binary())], names=["chunk", "bucket", "data"])


def _told(keys: np.ndarray, answers: list[bytes], buckets: int) -> list[np.ndarray]:
    """The answers to ``_asked``, in the order of ``keys``."""
    order = np.argsort(keys % np.uint64(buckets), kind="stable")
    out = []
    for parts in zip(*map(_unpack, answers), strict=True):
        told = np.concatenate(parts)
        out.append(np.empty_like(told))
        out[-1][order] = told
    return out


def _sums(requests: DataFrame, parts: int) -> DataFrame:
    """``chunk, bucket, fresh, data``: for each request the sums over all chunks of its keys' values.

    A key is new in the first of its requests, so that some task can count each
    once: this comes last in ``data``, and ``fresh`` is the number of such keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []

        def out(bucket: int) -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*[_unpack(d) for _, d in held], strict=True)]
            ends = np.cumsum([len(_unpack(d)[0]) for _, d in held])
            keys, first, place = np.unique(columns[0], return_index=True, return_inverse=True)
            fresh = np.zeros(len(place), bool)
            fresh[first] = True
            sums = [np.bincount(place, weights=c, minlength=len(keys)).astype(np.int64)[place] for c in columns[1:]]
            parts = [slice(i, j) for i, j in zip([0, *ends[:-1]], ends, strict=True)]
            data = [_pack(*[s[p] for s in sums], fresh[p]) for p in parts]
            n = [int(fresh[p].sum()) for p in parts]
            row = pa.RecordBatch.from_pydict({"chunk": [c for c, _ in held], "bucket": [bucket] * len(held), "fresh": n, "data": data})
            held.clear()
            return row

        last = None
        for b in batches:
            for chunk, bucket, data in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if held and bucket != last:
                    yield out(last)
                last = bucket
                held.append((chunk, data))
        if held:
            yield out(last)

    dealt = requests.repartition(parts, "bucket").sortWithinPartitions("bucket", "chunk")
    return dealt.transform(mapped, run, "chunk long, bucket long, fresh long, data binary")


def _requests(chunks: DataFrame, buckets: int, words: bool) -> DataFrame:
    """What the chunks ask and tell of their words or of their bigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, data in zip(*b.columns, strict=True):
                c = _Chunk(data.as_py())
                if words:
                    yield from _asked(chunk.as_py(), c.keys, c.word_counts(), buckets)
                else:
                    yield from _asked(chunk.as_py(), c.bigram_keys(), c.counts(), buckets)

    return chunks.select("chunk", "data").transform(mapped, run, "chunk long, bucket long, data binary")


def _with_answers(chunks: DataFrame, *answers: DataFrame) -> DataFrame:
    """``chunk, kind, data``, sorted: each chunk (kind 0), then its answers of each kind by bucket."""
    rows = chunks.select("chunk", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("bucket"), "data")
    for kind, told in enumerate(answers, 1):
        rows = rows.unionByName(told.select("chunk", F.lit(kind).alias("kind"), "bucket", "data"))
    dealt = rows.repartition(width(chunks, 4.0), "chunk").sortWithinPartitions("chunk", "kind", "bucket")
    return dealt.select("chunk", "kind", "data")


def _gathered(batches: Iterator[pa.RecordBatch], kinds: int) -> Iterator[tuple[int, _Chunk, list[list[bytes]]]]:
    last, parts = None, [[] for _ in range(kinds + 1)]
    for b in batches:
        for chunk, kind, data in zip(*b.columns, strict=True):
            chunk = chunk.as_py()
            if last is not None and chunk != last:
                yield last, _Chunk(parts[0][0]), parts[1:]
                parts = [[] for _ in range(kinds + 1)]
            last = chunk
            parts[kind.as_py()].append(data.as_py())
    if last is not None:
        yield last, _Chunk(parts[0][0]), parts[1:]


def bits(pair: np.ndarray, first: np.ndarray, second: np.ndarray, n: np.ndarray, kinds: int, prior: float = PRIOR) -> np.ndarray:
    """Bits of tokens from counts of their bigram, of its first word as such, of its second word, and of all tokens.

    The bigram's share is smoothed by ``prior`` tokens spread like single words,
    and these by half a token for each of ``kinds`` words.
    """
    single = (second + 0.5) / (n + 0.5 * kinds)
    return -np.log2((pair + prior * single) / (first + prior))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, loss_target, loss_background, score`` for each row of ``docs`` (``doc_id, text``).

    The target are the documents whose ``doc_id`` has quality 1 in ``labels``
    (``doc_id, quality``); repeated or null labels change nothing. Vocabulary and
    counts are those of all rows, whole texts, and every word counts; a row is
    scored by what all other rows hold. A text without a word, empty or null, has
    no tokens and null losses. Without any target document the target's model
    knows no word better than another. Repeated rows count repeatedly and give
    repeated results; other columns are ignored; an empty table gives none.
    """
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("_good")).distinct()
    # ids are broadcast up to a size that is counted first; beyond it both sides are dealt out
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = rows.join(good, F.col("doc_id") == F.col("_good"), "left").select("doc_id", "text", F.col("_good").isNotNull().alias("target"))
    chunks = stage_table(_chunks(marked), "words")
    total = chunks.agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target")).first()
    n_all, n_target = total["n"] or 0, total["n_target"] or 0
    scale = n_target / n_all if n_target and n_all else 1.0
    buckets = max(16, n_all // BUCKET)
    # written, so that what was asked can go before the answers move
    pairs = stage_table(_sums(_requests(chunks, buckets, False), width(chunks, 3.0)), "pairs")
    singles = stage_table(_sums(_requests(chunks, buckets, True), width(chunks, 2.0)), "singles")
    # the start is among the keys
    kinds = max(1, (singles.agg(F.sum("fresh")).first()[0] or 1) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, c, (pair_told, word_told) in _gathered(batches, 2):
            means, some = np.zeros((2, len(c.sizes))), c.sizes > 0
            if some.any():
                of_pair = _told(c.bigram_keys(), pair_told, buckets)[:2]
                as_second, as_second_all, as_first, as_first_all = _told(c.keys, word_told, buckets)[:4]
                own = [c.own(x) for x in (c.pair, c.before, c.place)]
                size = np.repeat(c.sizes, c.sizes)
                for k, (pair, first, second, n, mine, by) in enumerate(
                    ((of_pair[0], as_first, as_second, n_target, c.target, 1.0), (of_pair[1], as_first_all, as_second_all, n_all, np.True_, scale))
                ):
                    counts = (pair[c.pair] - own[0] * mine, first[c.before] - own[1] * mine, second[c.place] - own[2] * mine, n - size * mine)
                    means[k, some] = np.add.reduceat(bits(*(x * by for x in counts), kinds), c.first) / c.sizes[some]
            parts = [pa.array(x, pa.float64(), mask=~some) for x in (means[0], means[1], means[0] - means[1])]
            ids = pa.array(c.ids.astype(np.int64), pa.int64(), mask=c.null)
            yield pa.RecordBatch.from_arrays([ids, pa.array(c.sizes, pa.int64()), *parts], names=["doc_id", "n_tokens", "loss_target", "loss_background", "score"])

    schema = "doc_id long, n_tokens long, loss_target double, loss_background double, score double"
    return _with_answers(chunks, pairs, singles).transform(mapped, run, schema)
