"""Language identification with a byte convolutional network written in numpy.

Bytes are embedded, filters of several widths run over fixed-length windows,
the maximum over the positions of a window is kept for each filter, and softmax
gives a probability for each language. A document's probabilities are the mean
over the windows of its whole text, weighted by their bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mapped, slices, utf8

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 8
EMBED = 8
TRAIN_DOCS = 4000
TRAIN_WINDOWS = 2
UNKNOWN = "und"
BROADCAST_LANGS = 10_000
MARGIN = 1.1
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text)))


@dataclass
class ByteNet:
    """Weights: ``embed`` (256, e), ``kernel`` (widest * e, filters), ``bias``, ``out`` (filters, classes), ``out_bias``."""

    langs: list[str]
    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @property
    def widest(self) -> int:
        return len(self.kernel) // self.embed.shape[1]

    def _maxima(self, windows: np.ndarray, where: bool = False):
        """The largest response of each filter in each window, and its position if asked for."""
        n, length = windows.shape
        e, w = self.embed.shape[1], self.widest
        padded = np.zeros((n, length + w - 1), np.uint8)
        padded[:, :length] = windows
        x = self.embed[padded]
        step = x.strides
        patches = np.lib.stride_tricks.as_strided(x, (n, length, w * e), (step[0], step[1], step[2]), writeable=False)
        got = (patches.reshape(n * length, w * e) @ self.kernel).reshape(n, length, -1)
        if not where:
            return got.max(axis=1)
        at = got.argmax(axis=1)
        return np.take_along_axis(got, at[:, None], 1)[:, 0], at, x

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.langs)), np.float32)
        for i in range(0, len(windows), 32):
            hidden = np.maximum(self._maxima(windows[i : i + 32]) + self.bias, 0)
            z = hidden @ self.out + self.out_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out[i : i + 32] = z / z.sum(axis=1, keepdims=True)
        return out


def _mask(widths: tuple[int, ...], filters: int, e: int) -> np.ndarray:
    """Ones where a filter of its width has weights."""
    mask = np.zeros((max(widths), e, len(widths) * filters), np.float32)
    for i, w in enumerate(widths):
        mask[:w, :, i * filters : (i + 1) * filters] = 1
    return mask.reshape(max(widths) * e, -1)


def train(texts: list[str], labels: list[str], epochs: int = 6, batch: int = 64, rate: float = 0.004, seed: int = 1) -> ByteNet:
    """Fit a network on windows of text by Adam; the same input gives the same weights.

    Windows are also cut to random lengths, so that short texts are learned.
    Languages weigh the same however many windows they have.
    """
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    y = np.array([langs.index(x) for x in labels], int)
    data = np.zeros((len(texts), WINDOW), np.uint8)
    for i, t in enumerate(texts):
        b = np.frombuffer(t.encode("utf-8", "replace")[:WINDOW], np.uint8)
        data[i, : len(b)] = b
    weight = (len(y) / np.maximum(np.bincount(y, minlength=len(langs)), 1) / max(len(langs), 1))[y].astype(np.float32)
    mask = _mask(WIDTHS, FILTERS, EMBED)
    nf = mask.shape[1]
    draw = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
    p = {"embed": draw(256, EMBED, by=0.5), "kernel": draw(*mask.shape, by=0.3) * mask, "bias": np.zeros(nf, np.float32), "out": draw(nf, len(langs), by=0.2), "out_bias": np.zeros(len(langs), np.float32)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for a in range(0, len(y), batch):
            rows = order[a : a + batch]
            x = data[rows].copy()
            keep = np.where(rng.random(len(rows)) < 0.4, rng.integers(8, WINDOW, len(rows)), WINDOW)
            x[np.arange(WINDOW) >= keep[:, None]] = 0
            net = ByteNet(langs, **p)
            best, at, emb = net._maxima(x, where=True)
            pre = best + p["bias"]
            hid = np.maximum(pre, 0)
            z = hid @ p["out"] + p["out_bias"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            dz = z / z.sum(axis=1, keepdims=True)
            dz[np.arange(len(rows)), y[rows]] -= 1
            dz *= weight[rows, None] / len(rows)
            g = {"out": hid.T @ dz, "out_bias": dz.sum(axis=0)}
            dh = (dz @ p["out"].T) * (pre > 0)
            g["bias"] = dh.sum(axis=0)
            spot = at[:, :, None] + np.arange(net.widest)
            patch = emb[np.arange(len(rows))[:, None, None], spot].reshape(len(rows), nf, -1)
            g["kernel"] = np.einsum("nf,nfk->kf", dh, patch) * mask
            flow = (dh[:, :, None] * p["kernel"].T[None]).reshape(-1, EMBED)
            padded = np.pad(x, ((0, 0), (0, net.widest - 1)))
            g["embed"] = np.zeros_like(p["embed"])
            np.add.at(g["embed"], padded[np.arange(len(rows))[:, None, None], spot].ravel(), flow)
            t += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = (p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return ByteNet(langs, **p)


def sample(docs: DataFrame, n_docs: int = TRAIN_DOCS, windows: int = TRAIN_WINDOWS) -> tuple[list[str], list[str]]:
    """Windows and labels to learn from, of about ``n_docs`` documents at most.

    Documents are drawn by a hash of their id at a rate for each language, so the
    sample stays bounded whatever the size of ``docs`` and the number of languages;
    if these are more than ``n_docs``, not each of them is drawn. Only rows with
    text, a language and an id are.
    """
    usable = docs.filter("text is not null and lang is not null and doc_id is not null and length(text) > 0")
    counts = usable.groupBy("lang").agg(F.count("*").alias("_n"))
    langs = counts.count()
    if not langs:
        return [], []
    rate = F.least(F.lit(1.0), F.lit(n_docs / langs) / F.col("_n"))
    rates = counts.select("lang", (rate * 2**32).cast("long").alias("_rate"))
    drawn = usable.join(F.broadcast(rates) if langs <= BROADCAST_LANGS else rates, "lang")
    drawn = drawn.filter(F.xxhash64("doc_id", F.lit("draw")).bitwiseAND(F.lit(2**32 - 1)) < F.col("_rate"))
    free = F.greatest(F.length("text") - WINDOW + 1, F.lit(1))
    cuts = F.array(*[F.substring("text", F.pmod(F.xxhash64("doc_id", F.lit(i)), free).cast("int") + 1, F.lit(WINDOW)) for i in range(windows)])
    rows = drawn.select("doc_id", "lang", F.explode(cuts).alias("cut")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["lang"], r["cut"]))
    return [r["cut"] for r in rows], [r["lang"] for r in rows]


def annotate(docs: DataFrame, net: ByteNet) -> DataFrame:
    """``docs`` with all its columns and ``lang_pred, score``, predicted from ``text`` alone.

    Columns of those two names are replaced.
    """
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = columns.index("text")
    # names by number, since a name may hold a dot
    own = docs.select(*[F.col(f"`{c}`") for c in columns]).toDF(*[f"c{i}" for i in range(len(columns))])
    names = [*own.columns, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at)
            ok = np.array([has_letter(t.as_py()) for t in texts], bool)
            data, offsets = utf8(texts)
            langs, scores = np.full(len(ok), UNKNOWN, object), np.zeros(len(ok))
            if net.langs:
                for i, j in slices(offsets, 1 << 21):
                    _score(net, data, offsets[i : j + 1], ok[i:j], langs[i:j], scores[i:j])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores)], names=names)

    schema = T.StructType([*own.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return own.transform(mapped, run, schema).toDF(*columns, "lang_pred", "score")


def _score(net: ByteNet, data: memoryview, offsets: np.ndarray, ok: np.ndarray, langs: np.ndarray, scores: np.ndarray) -> None:
    """Fill in ``langs`` and ``scores`` of the texts between the offsets."""
    sizes = np.where(ok, np.diff(offsets), 0)
    count = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), count)
    if not len(owner):
        return
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[owner] + nth * WINDOW
    weight = np.minimum(offsets[owner + 1] - start, WINDOW)
    flat = np.frombuffer(data, np.uint8)
    total = np.zeros((len(sizes), len(net.langs)))
    for k in range(0, len(owner), 4096):
        s, w = start[k : k + 4096], weight[k : k + 4096]
        at = s[:, None] + np.arange(WINDOW)
        inside = np.arange(WINDOW) < w[:, None]
        windows = np.where(inside, flat[np.minimum(at, len(flat) - 1)], 0).astype(np.uint8)
        np.add.at(total, owner[k : k + 4096], net.probabilities(windows) * w[:, None])
    best = total.argmax(axis=1)
    rows = np.flatnonzero(sizes > 0)
    langs[rows] = np.array(net.langs, object)[best[rows]]
    scores[rows] = np.clip(total[rows, best[rows]] / sizes[rows], 0, 1)


def held_out() -> Column:
    """Whether a row's id as text has a CRC-32 that leaves 2 on division by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fitted(docs: DataFrame) -> ByteNet:
    """The network that a bounded sample of the rows not held out teaches."""
    return train(*sample(docs.select("doc_id", "text", "lang").filter(~held_out())))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of ``docs`` (``doc_id, text, lang``).

    Rows whose ``crc32`` of the id as text leaves 2 on division by 4 are held out:
    nothing is learned from them. A null text, or one without any letter, is
    ``und`` with score 0; so is everything if no row can be learned from. A row
    without an id is not held out and not learned from. Repeated rows give
    repeated results; other columns are ignored; an empty table gives none.
    """
    found = annotate(docs.select(F.col("doc_id").cast("long"), "text"), fitted(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs``, with all columns, that are text in some language.

    Rows without a letter go, and those that the network cannot tell: whose score
    is less than ``margin`` times an even share of all languages. If there was
    nothing to learn from, or one language only, all rows with a letter stay.
    """
    net = fitted(docs)
    if len(net.langs) < 2:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    sure = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= margin / len(net.langs))
    if not {"lang_pred", "score"} & set(docs.columns):
        return annotate(docs, net).filter(sure).drop("lang_pred", "score")
    # columns of those names are kept apart
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    return annotate(rows, net).filter(sure).select("_row.*")
