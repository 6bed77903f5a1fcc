"""SentencePiece encoding and decoding with a Viterbi search shared by common prefixes.

A text is cut into marked words (its spaces become marks in front of words). The
distinct marked words of a batch are sorted, which puts words with a common
prefix next to each other as in a trie; the search goes down this trie depth
first, so the forward scores of a shared prefix are computed once.

In a unigram model every piece may follow any other and the best total score
wins. In a BPE model a piece may follow another only if the merges, run on the
two pieces' text, give just these two pieces; then each prefix has one way in,
and the path equals the library's merges.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, slices, utf8

MARK = "▁"
#: Bytes of words that one Python worker may remember between texts, and pairs of pieces (about 130 bytes each).
CACHE_BYTES = 176 << 20
CACHE_PAIRS = 400_000
#: Characters of a text that are cut into marked words at a time.
PART = 1 << 19
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        shift += 7
        if b < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        elif key & 7 == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif key & 7 == 5:
            value, at = data[at : at + 4], at + 4
        elif key & 7 == 1:
            value, at = data[at : at + 8], at + 8
        else:
            raise ValueError("not a SentencePiece model")
        yield key >> 3, value


@dataclass
class Model:
    """Pieces of a model file and how it treats text."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    bpe: bool
    unk: int
    prefix: bool
    squeeze: bool
    normalizer: str
    ids: dict[str, int] = field(init=False)

    def __post_init__(self):
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k in (NORMAL, USER)}
        # the longest piece that ends in two characters
        self.reach: dict[str, int] = {}
        for p in self.ids:
            self.reach[p[-2:]] = max(self.reach.get(p[-2:], 1), len(p))
        if any(k == USER for k in self.kinds):
            # pieces given by a user are cut out before anything else
            self.user = sorted((p for p, k in zip(self.pieces, self.kinds, strict=True) if k == USER), key=len, reverse=True)
        else:
            self.user = []
        self.joins = {c for p in self.ids if len(p) > 1 for c in p}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("pieces reach over words")
        self.bytes = {self.pieces[i]: i for i, k in enumerate(self.kinds) if k == BYTE}

    @staticmethod
    def load(path: str) -> Model:
        with open(path, "rb") as f:
            data = f.read()
        pieces, scores, kinds = [], [], []
        spec = {"bpe": False, "unk": 0, "prefix": True, "squeeze": True, "normalizer": "nmt_nfkc"}
        for number, value in _fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        piece = v.decode()
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                pieces.append(piece), scores.append(score), kinds.append(kind)
            elif number == 2:
                for n, v in _fields(value):
                    if n == 3:
                        spec["bpe"] = v == 2
            elif number == 3:
                for n, v in _fields(value):
                    if n == 1:
                        spec["normalizer"] = v.decode()
                    elif n == 3:
                        spec["prefix"] = bool(v)
                    elif n == 4:
                        spec["squeeze"] = bool(v)
        spec["unk"] = kinds.index(UNKNOWN)
        if spec["normalizer"] != "identity":
            raise ValueError(f"normalization {spec['normalizer']} is not supported, only identity")
        return Model(pieces, scores, kinds, **spec)


class Viterbi:
    """Encodes marked words; keeps what it has learned of pairs of pieces, ``pairs`` at most."""

    def __init__(self, model: Model, pairs: int = CACHE_PAIRS):
        self.model, self.pairs = model, pairs
        self.size = len(model.pieces)
        self.sizes = [len(p) for p in model.pieces]
        self.after: dict[int, bool] = {}
        self.least = min((s for s, k in zip(model.scores, model.kinds, strict=True) if k == NORMAL), default=0.0) - 10

    def merged(self, text: str) -> list[str]:
        """The BPE merges on a short text: best score first, then leftmost."""
        parts, ids, scores = list(text), self.model.ids, self.model.scores
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                p = ids.get(parts[i] + parts[i + 1])
                if p is not None and (best is None or scores[p] > best):
                    best, where = scores[p], i
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def _follows(self, a: int, b: int) -> bool:
        """Whether piece ``b`` may stand after piece ``a``; -1 is the start of a word."""
        pieces = self.model.pieces
        if a < 0:
            found = self.merged(pieces[b]) == [pieces[b]]
        else:
            found = self.merged(pieces[a] + pieces[b]) == [pieces[a], pieces[b]]
        if len(self.after) >= self.pairs:
            self.after.clear()
        self.after[a * self.size + b] = found
        return found

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Pieces of each word, whose characters must all be pieces."""
        ids, scores, reach, bpe = self.model.ids, self.model.scores, self.model.reach, self.model.bpe
        inf, get, sizes = np.inf, ids.get, self.sizes
        after, follows, size = self.after.get, self._follows, self.size
        # forward state of the current word: the best last piece of each prefix, and its score
        last, score, out, before = [-1], [0.0], {}, ""
        for word in sorted(set(words)):
            n, shared = len(word), 0
            most = min(n, len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], score[shared + 1 :]
            for end in range(shared + 1, n + 1):
                best, top = -1, -inf
                low = end - reach.get(word[end - 2 : end] if end > 1 else word[0], 1)
                if low < 0:
                    low = 0
                if bpe:
                    # at most one piece fits, and it is short more often than long
                    for start in range(end - 1, low - 1, -1):
                        a = last[start]
                        if a < 0 and start:
                            continue
                        piece = get(word[start:end])
                        if piece is None:
                            continue
                        ok = after(a * size + piece)
                        if ok or ok is None and follows(a, piece):
                            best = piece
                            break
                else:
                    for start in range(low, end):
                        piece = get(word[start:end])
                        if piece is not None and score[start] + scores[piece] > top:
                            best, top = piece, score[start] + scores[piece]
                last.append(best)
                if not bpe:
                    score.append(top)
            at, path = n, []
            while at:
                piece = last[at]
                path.append(piece)
                at -= sizes[piece]
            out[word] = path[::-1]
            before = word
        return out


class Codec:
    """Encodes and decodes texts; remembers the ids of marked words, in ``room`` bytes at most.

    Words not met since half the room was filled are forgotten when it is again.
    """

    def __init__(self, path: str, room: int = CACHE_BYTES):
        self.model, self.room, self.held = Model.load(path), room, 0
        self.seen: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.viterbi = Viterbi(self.model)
        self._unit = re.compile(f"{MARK}+[^{MARK}\\n\\t]*|[\\n\\t]|[^{MARK}\\n\\t]+" if not {"\n", "\t"} & self.model.joins else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self._cut = re.compile(f"[^{MARK}](?={MARK})")
        self._user = re.compile("|".join(map(re.escape, self.model.user))) if self.model.user else None
        known = "".join(map(re.escape, sorted(p for p in self.model.ids if len(p) == 1)))
        # characters that are no pieces, and what a user gave
        self._odd = re.compile("|".join([*map(re.escape, self.model.user), f"[^{known}]" if known else "."]), re.DOTALL)
        self._bytes = [self._raw(i) for i in range(len(self.model.pieces))]

    def _raw(self, i: int) -> bytes:
        kind, piece = self.model.kinds[i], self.model.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return piece.replace(MARK, " ").encode()

    def _parts(self, text: str) -> Iterator[list[str]]:
        """The marked words of a text, in lists; a long text is cut between two of them every ``PART`` characters."""
        if self.model.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return
        text = text.replace(" ", MARK)
        text, at = MARK + text if self.model.prefix else text, 0
        while at < len(text):
            cut = self._cut.search(text, at + PART)
            stop = cut.end() if cut else len(text)
            yield self._unit.findall(text[at:stop])
            at = stop

    def _spelled(self, c: str) -> list[int]:
        """A character that is no piece, by its bytes or as unknown."""
        table = self.model.bytes
        return [table[f"<0x{b:02X}>"] for b in c.encode()] if table else [self.model.unk]

    def _learned(self, units: set[str]) -> dict[str, bytes]:
        odd = [u for u in units if self._odd.search(u)]
        parts = {u: self._pieces(u) for u in odd}
        plain = units.difference(odd)
        known = self.viterbi.encode_words([*plain, *(p for x in parts.values() for p in x if isinstance(p, str))])
        out = {u: array("i", known[u]).tobytes() for u in plain}
        unknown = [self.model.unk]
        for unit in odd:
            got, lost = [], False
            for p in parts[unit]:
                new = known[p] if isinstance(p, str) else p
                if new != unknown or not lost:
                    got += new
                lost = new == unknown
            out[unit] = array("i", got).tobytes()
        return out

    def _pieces(self, unit: str) -> list:
        """Text between what a user's pieces and characters that are no pieces take out, and the ids of these."""
        out, at = [], 0
        for m in self._user.finditer(unit) if self._user else ():
            out += self._split(unit[at : m.start()]) + [[self.model.ids[m[0]]]]
            at = m.end()
        return out + self._split(unit[at:])

    def _split(self, text: str) -> list:
        """Runs of characters that are pieces as text, others as ids."""
        ids, out, at = self.model.ids, [], 0
        for i, c in enumerate(text):
            if c not in ids:
                out += [text[at:i]] * (at < i) + [self._spelled(c)]
                at = i + 1
        return out + [text[at:]] * (at < len(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian int32."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        n = 0

        def flush() -> None:
            missing: set[str] = set()
            for _, u in held:
                missing.update(u)
            missing.difference_update(self.seen)
            known = {u: self.before[u] for u in missing if u in self.before}
            known |= self._learned(missing.difference(known))
            self.seen |= known
            for k, u in held:
                out[k].append(b"".join(map(self.seen.__getitem__, u)))
            held.clear()
            # a dictionary entry, the headers of both objects, and two bytes a character
            self.held += sum(190 + 2 * len(u) + len(x) for u, x in known.items())
            if self.held > self.room // 2:
                self.before, self.seen, self.held = self.seen if self.held <= self.room else {}, {}, 0

        for k, text in enumerate(texts):
            for units in self._parts(text):
                held.append((k, units))
                n += len(units)
                if n > PART // 4:
                    flush()
                    n = 0
        flush()
        return [b"".join(x) for x in out]

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; without the space that the mark in front stands for."""
        raw = b"".join(map(self._bytes.__getitem__, ids.tolist()))
        if self.model.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a model file, one in each Python process."""
    return _codecs.get(path) or _codecs.setdefault(path, Codec(path))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` (little-endian int32) of each whole text of ``docs`` (``doc_id, text``).

    A null or empty text has no ids. Other columns are ignored; repeated rows give
    repeated results; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, offsets = utf8(b.column(1))
            for i, j in slices(offsets, 1 << 20):
                texts = [t or "" for t in b.column(1)[i:j].to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], pa.array(codec(path).encode(texts), pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").transform(mapped, run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [codec(path).decode(np.frombuffer(x or b"", "<i4")) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").transform(mapped, run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode each whole text, decode its ids, and return digests of both.

    ``doc_id, n_tokens, ids_crc32`` (unsigned, of the ids as little-endian int32),
    ``decoded_sha256`` and ``exact``: whether the decoded text is the text, with
    marks in it read as spaces. Null and empty texts have no ids, decode to an
    empty text and are exact.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import zlib

        for b in batches:
            _, offsets = utf8(b.column(1))
            for i, j in slices(offsets, 1 << 20):
                texts = [t or "" for t in b.column(1)[i:j].to_pylist()]
                c = codec(path)
                ids = c.encode(texts)
                back = [c.decode(np.frombuffer(x, "<i4")) for x in ids]
                rows = [
                    b.column(0)[i:j],
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]),
                    pa.array([a == t or a == t.replace(MARK, " ") for a, t in zip(back, texts, strict=True)]),
                ]
                yield pa.RecordBatch.from_arrays(rows, names=["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "exact"])

    return docs.select(F.col("doc_id").cast("long"), "text").transform(mapped, run, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, exact boolean")
