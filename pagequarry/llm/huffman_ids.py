"""Token ids in files of canonical, length-limited Huffman codes.

Ids are counted over all documents, code lengths come from package-merge with a
limit, and codes are canonical, so that a file needs the lengths only. A file is
cut into blocks of equally many ids; the bit offset of each block is stored, so
blocks are decoded independently, by a table that maps the next bits to an id
and its length. Files hold whole documents in ascending order of ``doc_id``.

File layout, little-endian: the magic, then the sections ``lengths`` (zlib, a
byte for each id of the vocabulary), ``docs`` (doc_id, number of ids and whether
there is a doc_id, int64 each), ``checkpoints`` (bit offset of each block, int64), ``bits`` (big-endian
bit string), then a footer: JSON with each section's place and the numbers, its
size as uint32, and the magic again.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, mapped, slices, stage_path, stage_table, utf8, width

MAGIC = b"PQHIDS2\n"
MAX_LENGTH = 16
BLOCK = 2048
FILE_IDS = 4_000_000
END_ID = 1
CACHE_WORDS = 400_000


# ---------------------------------------------------------------- codes


def code_lengths(counts: np.ndarray, most: int = MAX_LENGTH) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits by package-merge; 0 for ids that don't occur.

    The limit is raised where ``2 ** most`` codes are too few.
    """
    counts = np.asarray(counts, np.int64)
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        out[used] = 1
        return out
    most = max(most, (n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order]
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(most):
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < n)
        both = both[rank]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    bits, k = np.zeros(n, np.uint8), 2 * n - 2
    for leaf in reversed(levels):
        chosen = int(leaf[:k].sum())
        bits[:chosen] += 1
        k = 2 * (k - chosen)
    out[order] = bits
    return out


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes by id, and the ids in the order of their codes."""
    lengths = lengths.astype(np.int64)
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    top = int(lengths.max(initial=0))
    share = np.left_shift(np.int64(1), top - lengths[ids])
    codes = np.zeros(len(lengths), np.uint64)
    codes[ids] = ((np.cumsum(share) - share) >> (top - lengths[ids])).astype(np.uint64)
    return codes, ids


def encode_ids(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, block: int = BLOCK) -> tuple[bytes, np.ndarray]:
    """The bit string of ``ids`` and the bit offset of each block of ``block`` ids."""
    total = int(lengths[ids].sum(dtype=np.int64))
    words, offsets, base = np.zeros(total // 64 + 2, np.uint64), [], 0
    piece = max(1, (1 << 18) // block) * block
    for k in range(0, len(ids), piece):
        part = ids[k : k + piece]
        size = lengths[part].astype(np.int64)
        ends = np.cumsum(size) + base
        at = ends - size
        base = int(ends[-1])
        code, room, word = codes[part], 64 - (at & 63) - size, at >> 6
        high = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        words[word[first]] |= np.bitwise_or.reduceat(high, first)
        over = np.flatnonzero(room < 0)
        words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
        offsets.append(at[::block])
    starts = np.concatenate(offsets) if offsets else np.zeros(0, np.int64)
    return words.astype(">u8").tobytes()[: (total + 7) // 8], starts


def decode_blocks(bits: bytes, starts: np.ndarray, n_ids: int, lengths: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The ``n_ids`` ids of consecutive blocks, all blocks a step at a time by table."""
    if not n_ids:
        return np.zeros(0, np.uint32)
    top = int(lengths.max())
    _, order = canonical(lengths)
    sizes = lengths[order].astype(np.int64)
    table = np.zeros(1 << top, np.uint32)
    step = np.ones(1 << top, np.uint8)
    filled = np.repeat(order, np.left_shift(1, top - sizes))
    table[: len(filled)] = filled
    step[: len(filled)] = lengths[table[: len(filled)]]
    raw = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    last, keep = 8 * len(bits), np.uint32((1 << top) - 1)
    at = np.array(starts, np.int64)
    out = np.empty((block, len(at)), np.uint32)
    for k in range(min(block, n_ids)):
        got = (window[at >> 3] >> (32 - top - (at & 7)).astype(np.uint32)) & keep
        out[k] = table[got]
        at += step[got]
        np.minimum(at, last, out=at)
    return out[: min(block, n_ids)].T.ravel()[:n_ids] if n_ids >= block else out[:n_ids, 0]


# ---------------------------------------------------------------- files


def write_file(path: str, doc_ids: np.ndarray, n_tokens: np.ndarray, ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, block: int = BLOCK, named: np.ndarray | None = None) -> int:
    """Write one file, under another name until it is whole; returns its bytes. ``named`` tells documents with an id."""
    bits, starts = encode_ids(ids, lengths, codes, block)
    sections = {
        "lengths": zlib.compress(lengths.tobytes()),
        "docs": np.stack([doc_ids, n_tokens, np.ones(len(doc_ids)) if named is None else named]).astype("<i8").tobytes(),
        "checkpoints": starts.astype("<i8").tobytes(),
        "bits": bits,
    }
    places, at = {}, len(MAGIC)
    for name, data in sections.items():
        places[name] = [at, len(data)]
        at += len(data)
    foot = json.dumps({"sections": places, "docs": len(doc_ids), "ids": len(ids), "block": block, "vocabulary": len(lengths)}).encode()
    files, place = pafs.FileSystem.from_uri(path)
    with files.open_output_stream(f"{place}.part") as f:
        f.write(MAGIC)
        for data in sections.values():
            f.write(data)
        f.write(foot + len(foot).to_bytes(4, "little") + MAGIC)
    files.move(f"{place}.part", place)
    return at + len(foot) + 4 + len(MAGIC)


class IdFile:
    """Reads a file of ids by ranges."""

    def __init__(self, path: str):
        files, place = pafs.FileSystem.from_uri(path)
        self._file = files.open_input_file(place)
        end = self._file.size()
        tail = self._range(max(0, end - 65536), min(65536, end))
        if tail[-len(MAGIC) :] != MAGIC:
            raise ValueError(f"{path} is no whole file of ids")
        size = int.from_bytes(tail[-len(MAGIC) - 4 : -len(MAGIC)], "little")
        self.about = json.loads(tail[-len(MAGIC) - 4 - size : -len(MAGIC) - 4])
        self.lengths = np.frombuffer(zlib.decompress(self._section("lengths")), np.uint8)
        self.doc_ids, self.n_tokens, self.named = np.frombuffer(self._section("docs"), "<i8").reshape(3, -1)
        self.checkpoints = np.frombuffer(self._section("checkpoints"), "<i8")

    def _range(self, start: int, size: int) -> bytes:
        self._file.seek(start)
        return self._file.read(size)

    def _section(self, name: str) -> bytes:
        return self._range(*self.about["sections"][name])

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids from ``start`` to ``stop``; only the blocks that hold them are read."""
        block, stop = self.about["block"], self.about["ids"] if stop is None else stop
        if stop <= start:
            return np.zeros(0, np.uint32)
        a, z = start // block, -(-stop // block)
        at, size = self.about["sections"]["bits"]
        first = int(self.checkpoints[a]) // 8
        last = -(-int(self.checkpoints[z]) // 8) if z < len(self.checkpoints) else size
        n = min(self.about["ids"], z * block) - a * block
        got = decode_blocks(self._range(at + first, last - first), self.checkpoints[a:z] - 8 * first, n, self.lengths, block)
        return got[start - a * block : stop - a * block]

    def close(self) -> None:
        self._file.close()


# ---------------------------------------------------------------- tokens


def _byte_chars() -> dict[int, int]:
    """The characters that stand for bytes at the byte level: printable ones for themselves, the others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in own)}


_BYTE_CHARS = _byte_chars()
# ASCII marks but the apostrophe, which can start a piece of its own with letters
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c != 39)
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


class WordTokens:
    """Ids of whole texts by the tokenizers library, remembered by chunk between white space.

    The tokenizer drops white space and never joins what it parts, so the ids of
    a text are those of its chunks in turn. A chunk is looked up in lower case
    where case can't matter: without marks that compose and without the spelling
    of a special token. Chunks are kept in two generations of about ``words`` each:
    those not met since the last change are forgotten at the next one.
    """

    _composes = re.compile("[^\x00-˿]")

    def __init__(self, path: str, dtype: str, words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype, self.words, self.seen, self.before = dtype, words, {}, {}
        spec = json.loads(self.tokenizer.to_str())
        self.specials = [t["content"].lower().encode() for t in spec["added_tokens"]]
        steps = [p["type"] for p in spec["pre_tokenizer"].get("pretokenizers", [])]
        kinds = [n["type"] for n in spec["normalizer"].get("normalizers", [])]
        if steps != ["Split", "ByteLevel"] or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("only tokenizers that drop white space and lower-case are remembered by chunk")

    def _lowered(self, raw: bytes) -> bytes:
        """The text in lower case, unless case may matter in it."""
        low = raw.lower()
        plain = (raw.isascii() or not self._composes.search(raw.decode())) and not any(s in low for s in self.specials)
        return low if plain else raw

    def _plain(self, chunk: bytes) -> str | None:
        """What the tokenizer's normalizer and byte level make of a chunk of Latin letters; None if it is anything else."""
        if chunk.isalpha():
            return chunk.decode() if chunk.islower() else None
        if chunk.isascii() or not (found := _LATIN.fullmatch(chunk.decode())):
            return None
        return found[0].lower().encode().decode("latin-1").translate(_BYTE_CHARS)

    def _learn(self, missing: set[bytes]) -> dict[bytes, bytes]:
        two = self.dtype == "<u2" and sys.byteorder == "little"
        pack = (lambda ids: array("H", ids).tobytes()) if two else (lambda ids: np.array(ids, self.dtype).tobytes())
        model, out, rest, marks = self.tokenizer.model, {}, [], {}
        seen, before = self.seen.get, self.before.get
        for chunk in missing:
            core = chunk.rstrip(_MARKS)
            if not core or (plain := self._plain(core)) is None:
                rest.append(chunk)
                continue
            ids = out.get(core) or seen(core) or before(core)
            if ids is None:
                ids = out[core] = pack([t.id for t in model.tokenize(plain)])
            if len(core) < len(chunk):
                end = chunk[len(core) :]
                if end not in marks:
                    marks[end] = pack(self.tokenizer.encode(end.decode(), add_special_tokens=False).ids)
                out[chunk] = ids + marks[end]
        for chunk, found in zip(rest, self.tokenizer.encode_batch([c.decode() for c in rest], add_special_tokens=False), strict=True):
            out[chunk] = pack(found.ids)
        return out

    def encode(self, texts: list[bytes], end: bytes = b"") -> list[bytes]:
        """Packed ids of each text, given in UTF-8."""
        lists = pc.ascii_split_whitespace(pa.array([self._lowered(t) for t in texts], pa.binary()).cast(pa.string()))
        coded = lists.flatten().dictionary_encode()
        different = coded.dictionary.cast(pa.binary()).to_pylist()
        missing = set(different).difference(self.seen)
        again = missing & self.before.keys()
        learned = self._learn(missing - again - {b""})
        self.seen.update(zip(again, map(self.before.__getitem__, again), strict=True))
        self.seen |= learned
        # white space at the ends of a text leaves an empty chunk there
        ids = pa.array([self.seen[c] if c else b"" for c in different], pa.large_binary()).take(coded.indices)
        places = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1]
        data = bytes(ids.buffers()[2] or b"")
        stops = places[np.cumsum(lists.value_lengths().to_numpy())].tolist()
        out = [data[a:z] + end for a, z in zip([0, *stops[:-1]], stops, strict=True)]
        if len(self.seen) > self.words:
            self.before, self.seen = self.seen, {}
        return out


_tokens: dict[tuple[str, str], WordTokens] = {}


def token_ids(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, ids``: each whole text's ids and ``end_id``, as little-endian integers of two bytes if the vocabulary fits, else four."""
    dtype = id_type(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokens.get((path, dtype)) or _tokens.setdefault((path, dtype), WordTokens(path, dtype))
        end = np.array([end_id], dtype).tobytes()
        for b in batches:
            data, offsets = utf8(b.column(1))
            for i, j in slices(offsets, 4 << 20):
                texts = [bytes(data[a:z]) for a, z in zip(offsets[i:j].tolist(), offsets[i + 1 : j + 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], pa.array(words.encode(texts, end), pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").transform(mapped, run, "doc_id long, ids binary")


def vocabulary(path: str) -> int:
    """Number of ids of a tokenizer file, special ones and the largest id included."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return max(t.get_vocab(with_added_tokens=True).values()) + 1


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def id_counts(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in all documents; at most a row for each id of the vocabulary reaches the driver."""
    dtype = id_type(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            data, _ = _binary(b.column(0))
            total += np.bincount(np.frombuffer(data, dtype), minlength=size)
        got = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(got, pa.int32()), pa.array(total[got])], names=["id", "n"])

    rows = tokens.select("ids").transform(mapped, run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[rows["id"].to_numpy(int)] = rows["n"].to_numpy(np.int64)
    return out


def _binary(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    view = memoryview(column.buffers()[2] or b"")
    return view[int(offsets[0]) : int(offsets[-1])], offsets - offsets[0]


def write_ids(tokens: DataFrame, lengths: np.ndarray, folder: str, block: int = BLOCK, file_ids: int = FILE_IDS) -> DataFrame:
    """Write files in ascending order of ``doc_id``; returns ``part, seq, path, n_docs, n_ids, n_bytes`` of each.

    Parts are ranges of ids in order, and files of a part follow by ``seq``. A file
    name holds the task attempt; only files that this table names count, so an
    attempt that was lost leaves nothing that is read.
    """
    dtype = id_type(len(lengths))
    codes, _ = canonical(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        files, place = pafs.FileSystem.from_uri(folder)
        files.create_dir(place, recursive=True)

        def out() -> pa.RecordBatch:
            nonlocal seq
            doc_ids, named, sizes, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            path = f"{folder}/ids-{task.partitionId():06d}-{seq:06d}-{task.taskAttemptId()}.pqh"
            n_bytes = write_file(path, doc_ids, sizes, ids, lengths, codes, block, named)
            row = {"part": [task.partitionId()], "seq": [seq], "path": [path], "n_docs": [len(doc_ids)], "n_ids": [len(ids)], "n_bytes": [n_bytes]}
            held.clear()
            seq += 1
            return pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))

        for b in batches:
            data, offsets = _binary(b.column(1))
            for i, j in slices(offsets, file_ids * np.dtype(dtype).itemsize):
                ids = np.frombuffer(data[offsets[i] : offsets[j]], dtype)
                sizes = np.diff(offsets[i : j + 1]) // np.dtype(dtype).itemsize
                mine = b.column(0)[i:j]
                held.append((mine.fill_null(0).to_numpy(zero_copy_only=False), mine.is_valid().to_numpy(zero_copy_only=False), sizes, ids.copy()))
                if sum(len(x[3]) for x in held) >= file_ids:
                    yield out()
        if held:
            yield out()

    n = width(tokens)
    dealt = tokens.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "ids")
    return dealt.transform(mapped, run, "part int, seq int, path string, n_docs long, n_ids long, n_bytes long")


def read_ids(files: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` (little-endian uint32) of each document in the files that ``files`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                f = IdFile(path)
                ends = np.cumsum(f.n_tokens)
                starts = ends - f.n_tokens
                for i, j in slices(np.r_[0, ends], FILE_IDS // 4):
                    lo, hi = int(starts[i]), int(ends[j - 1])
                    data = f.ids(lo, hi).astype("<u4").tobytes()
                    rows = [data[4 * (a - lo) : 4 * (z - lo)] for a, z in zip(starts[i:j].tolist(), ends[i:j].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids[i:j], mask=f.named[i:j] == 0), pa.array(starts[i:j] + base), pa.array(rows, pa.binary())], names=["doc_id", "start", "ids"])
                f.close()

    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    based = files.join(parts, "part").select("path", (F.col("base") + F.coalesce(F.sum("n_ids").over(before), F.lit(0))).alias("base"))
    return based.repartition(width(files, 1000.0), "path").transform(mapped, run, "doc_id long, start long, ids binary")


def stored_ids(docs: DataFrame, path: str, end_id: int = END_ID, most: int = MAX_LENGTH, block: int = BLOCK) -> DataFrame:
    """Tokenize ``docs`` (``doc_id, text``), write the ids to files and read them back: ``doc_id, start, ids``.

    A null or empty text has the end id only. Documents follow each other by
    ``doc_id``, those of one id by their ids; rows without an id come first.
    Other columns are ignored; an empty table writes no file and gives no rows.
    """
    spark = docs.sparkSession
    tokens = stage_table(token_ids(docs, path, end_id), "tokens")
    counts = id_counts(tokens, vocabulary(path))
    files = stage_table(write_ids(tokens, code_lengths(counts, most), stage_path(spark, "ids"), block), "id-files")
    drop_table(tokens)
    return read_ids(files)


def digests(stored: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of documents read back."""
    return stored.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
