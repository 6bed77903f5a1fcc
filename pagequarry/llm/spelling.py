"""Groups of words that are spelling variants of each other.

Two words are near if one inserted, deleted or replaced character makes one of
the other. Such an edit destroys two bigrams of a word at most, so of the three
that are rarest in the vocabulary one is left, and is among the rarest of the
other word too: only these are joined. A bigram that is left lies on one side of
the edit, which limits its position: what is on its other side is the same in
both words, and so is one half of the side of the edit. Rows of the join are known
by all three, so that a frequent bigram brings only words together that agree in
these; ``levenshtein`` verifies them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_sql, drop_table, mapped, stage_table

NOISE = 199
MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
RAREST = 3
#: Different words that a task holds before it tells their counts.
WORDS_HELD = 400_000
#: A text is read in parts of about this many bytes, which end between words.
PART = 1 << 20
# words are single bytes (Latin-1): A-Z become a-z, other characters than letters blanks
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")


def _parts(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PART:
        found = _BREAK.search(text, at + PART)
        if not found:
            break
        yield text[at : found.start()]
        at = found.end()
    yield text[at:]


def document_words(doc_id: int | None, text: str | None, noise: int = NOISE) -> Counter:
    """How often a text has each word, as Latin-1 bytes.

    The checksum of id and word picks one of ``noise`` occurrences, which lose the
    character that the checksum points at; a missing id counts as empty.
    """
    out, start = Counter(), zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for part in _parts(text or ""):
        for word, n in Counter(part.encode("latin-1", "replace").translate(_TABLE).split()).items():
            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
            if h % noise == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            out[word] += n
    return out


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, noise: int = NOISE) -> DataFrame:
    """``word, n`` for each word of ``docs`` (``doc_id, text``) with enough characters and occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            counts = pa.array(list(held.values()), pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([words, counts], names=["word", "n"])

        for b in batches:
            for i, t in zip(*b.columns, strict=True):
                for word, n in document_words(i.as_py(), t.as_py(), noise).items():
                    if len(word) >= min_chars:
                        held[word] += n
                if len(held) > WORDS_HELD:
                    yield out()
        if held:
            yield out()

    found = docs.select(F.col("doc_id").cast("long"), "text").transform(mapped, run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def bigram_ranks(words: DataFrame) -> np.ndarray:
    """The place of each bigram, from the rarest, in a table of 65,536: two Latin-1 characters, so the driver gets no more rows.

    A bigram counts once for each position in each different word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, np.int64)
        for b in batches:
            for w in b.column(0).to_pylist():
                x = np.frombuffer(w.encode("latin-1"), np.uint8).astype(np.int64)
                np.add.at(counts, x[:-1] << 8 | x[1:], 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bigram", "n"])

    rows = words.select("word").transform(mapped, run, "bigram long, n long").groupBy("bigram").agg(F.sum("n").alias("n")).collect()
    order = sorted((r["n"], r["bigram"]) for r in rows)
    ranks = np.zeros(1 << 16, np.int32)
    ranks[[b for _, b in order]] = np.arange(len(order))
    return ranks


def rarest(word: bytes, ranks: np.ndarray, most: int = RAREST) -> list[int]:
    """Positions of a word's rarest bigrams, and of others that equal the last of them."""
    x = np.frombuffer(word, np.uint8).astype(np.int64)
    rank = ranks[x[:-1] << 8 | x[1:]]
    last = np.sort(rank)[: most][-1]
    return np.flatnonzero(rank <= last).tolist()


def _halves(side: bytes) -> tuple[list[bytes], list[bytes]]:
    """What a side of a word has in common with one that is edited once.

    The first list is for sides of the same length or one more, the second for
    sides that are one shorter; each names the length of the shorter side, which
    half is the same, and that half.
    """
    m = len(side)
    h = m // 2
    same = [b"%d<" % m + side[:h], b"%d>" % m + side[h:]]
    if not m:
        return same[:1], []
    h = (m - 1) // 2
    return same, [b"%d<" % (m - 1) + side[:h], b"%d>" % (m - 1) + side[h + 1 :]] if m > 1 else [b"0<"]


def join_keys(word: bytes, ranks: np.ndarray) -> tuple[set[int], set[int]]:
    """Hashes that a word shares with each near one: those of the second set of a word are met in the first of a shorter one."""
    short, long = set(), set()
    for p in rarest(word, ranks):
        left, gram, right = word[:p], word[p : p + 2], word[p + 2 :]
        for mark, kept, side in ((b"R", left, right), (b"L", right, left)):
            head = mark + gram + b"%d:" % len(kept) + kept
            for out, halves in zip((short, long), _halves(side), strict=True):
                out.update(xxhash.xxh64_intdigest(head + x) - (1 << 63) for x in halves)
    return short, long


def _keyed(words: DataFrame) -> DataFrame:
    """``word, n, key, longer`` for each word and key."""
    ranks = bigram_ranks(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part, at, keys, longer = b.slice(k, 500), [], [], []
                for i, w in enumerate(part.column(0).to_pylist()):
                    for flag, found in zip((False, True), join_keys(w.encode("latin-1"), ranks), strict=True):
                        at += [i] * len(found)
                        keys += found
                        longer += [flag] * len(found)
                rows = part.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(keys, pa.int64()), pa.array(longer)], names=["word", "n", "key", "longer"])

    return words.select("word", "n").transform(mapped, run, "word string, n long, key long, longer boolean")


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: all ordered pairs of near words of ``words`` (``word, n``; at least four Latin-1 characters)."""
    keyed = stage_table(_keyed(words), "keys")
    # a key that one word has brings nothing together
    met = keyed.groupBy("key").agg(F.count("*").alias("_m"), F.count_if(~F.col("longer")).alias("_s")).filter("_m > 1 and _s > 0").select("key")
    met = stage_table(met, "met")
    keyed = stage_table(keyed.join(met, "key", "left_semi"), "meeting")
    short = keyed.filter(~F.col("longer")).select("key", F.col("word").alias("word"), "n")
    other = keyed.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"), "longer")
    close = F.col("longer") | (F.col("word") < F.col("near"))
    size = F.length("near") == F.length("word") + F.when(F.col("longer"), 1).otherwise(0)
    pairs = short.join(other, "key").filter(close & size & (F.levenshtein("word", "near", 1) == 1))
    pairs = pairs.groupBy("word", "near").agg(F.first("n").alias("n"), F.first("near_n").alias("near_n"))
    pairs = stage_table(pairs.select("word", "n", "near", "near_n"), "near")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def followed(forms: DataFrame) -> DataFrame:
    """``word, root``: where the forms of ``word, form`` lead to; each round doubles the way."""
    now = stage_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = stage_table(now.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        drop_table(now)
        now = after.drop("moved")
        if after.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO, noise: int = NOISE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of ``docs`` (``doc_id, text``).

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, with A-Z
    in lower case, of at least ``min_chars`` characters and ``min_count``
    occurrences. ``form`` is the near word of largest ``n``, the first in order of
    code points among equals, if it occurs ``ratio`` times as often or more;
    ``root`` is where forms lead to, the word itself if it has none. Null and empty
    texts have no words, a null ``doc_id`` counts as empty, repeated rows count
    repeatedly, other columns are ignored, and an empty table gives none.
    """
    if min_chars < RAREST + 1:
        raise ValueError(f"words of fewer than {RAREST + 1} characters have fewer than {RAREST} bigrams")
    words = stage_table(vocabulary(docs, min_chars, min_count, noise), "words")
    near = near_words(words)
    # the largest count, and then the least word
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("_best")
    groups = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    found = words.join(groups, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("_best.word").alias("form"), (-F.col("_best.n")).alias("form_n"))
    known = F.col("form_n") >= ratio * F.col("n")
    found = stage_table(found.select("word", "n", "n_near", F.when(known, F.col("form")).alias("form"), F.when(known, F.col("form_n")).alias("form_n")), "forms")
    roots = followed(found.filter("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CODES = "flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END))"
ORACLE_SQL = f"""
WITH RECURSIVE
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS m FROM runs GROUP BY ALL),
hashed AS (SELECT run, m, {crc32_sql(_CODES)} AS h FROM counted),
noisy AS (SELECT CASE WHEN h % {NOISE} = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, m FROM hashed),
words AS (SELECT word, sum(m)::BIGINT AS n FROM noisy WHERE length(word) >= {MIN_CHARS} GROUP BY word HAVING sum(m) >= {MIN_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words),
cut AS (SELECT word, n, k, word[1:k - 1] || word[k + 1:] AS rest FROM places),
pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= {RATIO} * w.n THEN near END AS form, CASE WHEN near_n >= {RATIO} * w.n THEN near_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
),
ways AS (
    SELECT word, word AS place, 0 AS steps FROM forms
    UNION ALL
    SELECT w.word, f.form, steps + 1 FROM ways w JOIN forms f ON w.place = f.word WHERE f.form IS NOT NULL
),
roots AS (SELECT word, arg_max(place, steps) AS root FROM ways GROUP BY word)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM forms JOIN roots USING (word)
"""
