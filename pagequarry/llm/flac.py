"""FLAC media columns: mono streams written and read in numpy, many frames at a time.

The encoder chooses for each frame between a constant, fixed predictors and a
linear predictor, and codes residuals in Rice partitions. Each frame is a seek
point, so a reader can fetch PCM blocks by sample offset, and the frames of many
streams are decoded together, one sample of every frame at a step. Frame headers
(CRC-8), frames (CRC-16) and streams (MD5) are verified.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, slices, utf8

RATE = 8000
BLOCK = 1152
UNIT = 192
ORDER = 8
PRECISION = 12
PARTITIONS = 2  # order: 4 partitions a frame
FIXED = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]]


# ---------------------------------------------------------------- checksums


def _crc_table(bits: int, poly: int) -> np.ndarray:
    out = np.zeros(256, np.uint32)
    for i in range(256):
        c = i << (bits - 8)
        for _ in range(8):
            c = (c << 1 ^ poly if c >> (bits - 1) else c << 1) & ((1 << bits) - 1)
        out[i] = c
    return out


_CRC8 = _crc_table(8, 0x07).tolist()
_CRC16 = _crc_table(16, 0x8005)
_places: list[np.ndarray] = [_CRC16.astype(np.uint16)]


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = _CRC8[c ^ b]
    return c


def _by_place(n: int) -> np.ndarray:
    """The CRC-16 of each byte value with i zero bytes after it, for i < n."""
    while len(_places) < n:
        last = _places[-1].astype(np.uint32)
        _places.append(((last << 8 & 0xFFFF) ^ _CRC16[last >> 8]).astype(np.uint16))
    return np.stack(_places[:n])


def crc16(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The CRC-16 of each range of bytes: a checksum is the sum of what each byte gives at its place."""
    out = np.zeros(len(starts), np.uint16)
    size = stops - starts
    table = _by_place(int(size.max(initial=1)))
    for i in range(0, len(starts), 512):
        n = int(size[i : i + 512].max())
        back = np.arange(n)
        at = stops[i : i + 512, None] - 1 - back
        inside = back < size[i : i + 512, None]
        got = np.where(inside, data[np.maximum(at, 0)], 0)
        out[i : i + 512] = np.bitwise_xor.reduce(table[back, got], axis=1)
    return out


# ---------------------------------------------------------------- bits


def pack_bits(values: np.ndarray, sizes: np.ndarray) -> bytes:
    """Values of up to 57 bits each, one after the other, most significant bit first."""
    sizes = sizes.astype(np.int64)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 64 + 2, np.uint64)
    at = ends - sizes
    room = 64 - (at & 63) - sizes
    high = np.where(room >= 0, values << np.clip(room, 0, 63).astype(np.uint64), values >> np.maximum(-room, 0).astype(np.uint64))
    word = at >> 6
    if len(at):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        words[word[first]] = np.bitwise_or.reduceat(high, first)
        over = np.flatnonzero(room < 0)
        words[word[over] + 1] |= values[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[: (total + 7) // 8]


def _utf8_number(x: int) -> bytes:
    """A frame number as FLAC writes it."""
    if x < 0x80:
        return bytes([x])
    n = 2
    while x >> (5 * n + 1) and n < 7:
        n += 1
    out = [0x80 | x >> (6 * i) & 0x3F for i in range(n - 1)]
    lead = (0xFF << (8 - n)) & 0xFF
    return bytes([lead | x >> (6 * (n - 1)), *reversed(out)])


# ---------------------------------------------------------------- encoder


def _levinson(auto: np.ndarray, order: int) -> np.ndarray:
    """Predictor coefficients (rows, order) for rows of autocorrelations."""
    n = len(auto)
    error = auto[:, 0] * (1 + 1e-9) + 1e-9
    a = np.zeros((n, order))
    for i in range(order):
        r = auto[:, i + 1] - (a[:, :i] * auto[:, i:0:-1]).sum(axis=1)
        k = np.clip(r / error, -0.99999, 0.99999)
        a[:, :i] -= k[:, None] * a[:, :i][:, ::-1].copy()
        a[:, i] = k
        error = np.maximum(error * (1 - k * k), 1e-9)
    return a


def _zigzag(r: np.ndarray) -> np.ndarray:
    return (r << 1) ^ (r >> 31)


def encode_frames(x: np.ndarray, n: np.ndarray, numbers: list[int], block: int = BLOCK) -> tuple[bytes, np.ndarray]:
    """Code frames of 8-bit samples; ``x`` is (frames, block) and row i has ``n[i]`` samples.

    Returns the frames one after the other, and where each ends.
    """
    f, inside = len(x), np.arange(block) < n[:, None]
    x = np.where(inside, x, 0).astype(np.int32)
    same = (np.where(inside, x, x[:, :1]) == x[:, :1]).all(axis=1)
    # fixed predictors by the sum of absolute residuals
    best = np.abs(x[:, ORDER:]).sum(axis=1, dtype=np.int64)
    residual, order, kind = x.copy(), np.zeros(f, int), np.full(f, 8)
    diff = x
    for o in range(1, 5):
        diff = np.diff(diff, axis=1, prepend=0)
        d = np.where(inside, diff, 0)
        cost = np.abs(d[:, ORDER:]).sum(axis=1, dtype=np.int64)
        better = cost < best
        best[better], order[better], kind[better] = cost[better], o, 8 + o
        residual[better] = d[better]
    # a linear predictor with quantized coefficients
    auto = np.stack([(x[:, lag:] * x[:, : block - lag]).sum(axis=1, dtype=np.int64) for lag in range(ORDER + 1)], axis=1)
    coef = _levinson(auto.astype(float), ORDER)
    top = np.abs(coef).max(axis=1)
    shift = np.clip(PRECISION - 2 - np.frexp(np.maximum(top, 1e-6))[1], 0, 15)
    limit = (1 << (PRECISION - 1)) - 1
    coef = np.clip(np.rint(coef * (1 << shift)[:, None]), -limit, limit).astype(np.int32)
    predicted = np.zeros_like(x)
    for j in range(ORDER):
        predicted[:, j + 1 :] += coef[:, j : j + 1] * x[:, : block - j - 1]
    d = np.where(inside, x - (predicted >> shift[:, None].astype(np.int32)), 0)
    better = np.abs(d[:, ORDER:]).sum(axis=1, dtype=np.int64) + 32 * ORDER < best
    order[better], kind[better] = ORDER, 32 + ORDER - 1
    residual[better] = d[better]
    # Rice parameters by partition
    z = np.where(inside & (np.arange(block) >= order[:, None]), _zigzag(residual), 0)
    parts = 1 << PARTITIONS
    length = n >> PARTITIONS
    part = np.minimum(np.arange(block) // np.maximum(length, 1)[:, None], parts - 1)
    cell = part + parts * np.arange(f)[:, None]
    total = np.bincount(cell.ravel(), weights=z.ravel(), minlength=f * parts)
    most = np.zeros(f * parts, np.int64)
    edges = (np.arange(parts) * length[:, None] + block * np.arange(f)[:, None]).ravel()
    most[:] = np.maximum.reduceat(z.ravel(), edges)
    mean = total / np.maximum(np.repeat(length, parts), 1)
    k = np.maximum(np.frexp(np.maximum(mean * 0.7, 0.5))[1], 0)
    k = np.clip(np.maximum(k, np.frexp(np.maximum(most, 1).astype(float))[1] - 5), 0, 14)
    rice = k[cell].astype(np.int64)
    # values and sizes: header, warm-up, coefficients, method, residuals
    lead = 1 + ORDER + 1 + ORDER + 1
    value, size = np.zeros((f, 12 + lead + block + 2), np.uint64), np.zeros((f, 12 + lead + block + 2), np.uint8)
    for i in range(f):
        plain = n[i] == block and block == 1152
        head = bytes([0xFF, 0xF8, 0x30 if plain else 0x70, 0x02]) + _utf8_number(numbers[i])
        head += b"" if plain else int(n[i] - 1).to_bytes(2, "big")
        head += bytes([crc8(head)])
        value[i, : len(head)] = list(head)
        size[i, : len(head)] = 8
    value[:, 12] = np.where(same, 0, kind << 1)
    size[:, 12] = 8
    warm = np.arange(ORDER) < np.where(same, 1, order)[:, None]
    value[:, 13 : 13 + ORDER] = np.where(warm, x[:, :ORDER] & 0xFF, 0)
    size[:, 13 : 13 + ORDER] = 8 * warm
    linear, at = (kind >= 32) & ~same, 13 + ORDER
    value[:, at] = np.where(linear, (PRECISION - 1) << 5 | shift, 0)
    size[:, at] = 9 * linear
    value[:, at + 1 : at + 1 + ORDER] = np.where(linear[:, None], coef & ((1 << PRECISION) - 1), 0)
    size[:, at + 1 : at + 1 + ORDER] = PRECISION * linear[:, None]
    at += 1 + ORDER
    value[:, at] = np.where(same, 0, PARTITIONS)
    size[:, at] = np.where(same, 0, 6)
    at += 1
    coded = inside & (np.arange(block) >= order[:, None]) & ~same[:, None]
    v = (np.int64(1) << rice) | (z & ((np.int64(1) << rice) - 1))
    s = np.where(coded, (z >> rice) + 1 + rice, 0)
    opens = np.where(np.arange(parts) == 0, order[:, None], np.arange(parts) * length[:, None])
    rows = np.arange(f)[:, None]
    v[rows, opens] |= k.reshape(f, parts) << s[rows, opens]
    s[rows, opens] += 4
    s[same] = 0
    value[:, at : at + block], size[:, at : at + block] = v, s
    at += block
    used = size.sum(axis=1, dtype=np.int64)
    size[:, at] = -used % 8
    size[:, at + 1] = 16
    value[size == 0] = 0
    keep = size.ravel() > 0
    data = bytearray(pack_bits(value.ravel()[keep], size.ravel()[keep]))
    ends = np.cumsum((used + 7) // 8 + 2)
    raw = np.frombuffer(data, np.uint8)
    check = crc16(raw, np.r_[0, ends[:-1]], ends - 2)
    raw[ends - 2], raw[ends - 1] = check >> 8, check & 0xFF
    return bytes(data), ends


def encode(payloads: list[bytes], block: int = BLOCK) -> list[bytes]:
    """Each payload of unsigned 8-bit samples as a FLAC stream; all but the last frame have ``block`` samples.

    Samples are stored signed, 128 less. Payloads have multiples of 16 samples,
    16 at least, as the format asks of blocks.
    """
    owner, first = [], []
    for i, p in enumerate(payloads):
        for k in range(0, len(p), block):
            owner.append(i), first.append(k)
    frames: list[list[bytes]] = [[] for _ in payloads]
    sizes: list[list[int]] = [[] for _ in payloads]
    for a in range(0, len(owner), 512):
        own, at = owner[a : a + 512], first[a : a + 512]
        x, n = np.zeros((len(own), block), np.int32), np.zeros(len(own), np.int64)
        for r, (i, k) in enumerate(zip(own, at, strict=True)):
            got = np.frombuffer(payloads[i], np.uint8)[k : k + block]
            n[r] = len(got)
            x[r, : len(got)] = got.astype(np.int32) - 128
        data, ends = encode_frames(x, n, [k // block for k in at], block)
        begin = 0
        for i, m, e in zip(own, n.tolist(), ends.tolist(), strict=True):
            frames[i].append(data[begin:e])
            sizes[i].append(m)
            begin = e
    return [_stream(p, f, s, block) for p, f, s in zip(payloads, frames, sizes, strict=True)]


def _stream(payload: bytes, frames: list[bytes], samples: list[int], block: int) -> bytes:
    lengths = list(map(len, frames))
    signed = (np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()
    info = struct.pack(">HH", block, block) + min(lengths, default=0).to_bytes(3, "big") + max(lengths, default=0).to_bytes(3, "big")
    info += (RATE << 44 | 0 << 41 | 7 << 36 | len(payload)).to_bytes(8, "big") + hashlib.md5(signed).digest()
    points, at, offset = [], 0, 0
    for n, size in zip(samples, lengths, strict=True):
        points.append(struct.pack(">QQH", at, offset, n))
        at, offset = at + n, offset + size
    table = b"".join(points)
    return b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(table).to_bytes(3, "big") + table + b"".join(frames)


# ---------------------------------------------------------------- decoder


@dataclass
class Stream:
    """What a stream's metadata say. ``points``: first sample, byte offset after ``start`` and samples of frames."""

    block: int
    rate: int
    channels: int
    bits: int
    samples: int
    md5: bytes
    start: int
    points: list[tuple[int, int, int]]


def metadata(media: bytes) -> Stream:
    if media[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, found, points = 4, None, []
    while True:
        kind, size = media[at], int.from_bytes(media[at + 1 : at + 4], "big")
        body = media[at + 4 : at + 4 + size]
        if kind & 127 == 0:
            packed = int.from_bytes(body[10:18], "big")
            found = (int.from_bytes(body[2:4], "big"), packed >> 44, (packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1, packed & (1 << 36) - 1, body[18:34])
        elif kind & 127 == 3:
            points = [p for p in struct.iter_unpack(">QQH", body) if p[0] != 2**64 - 1]
        at += 4 + size
        if kind & 128:
            break
    if found is None:
        raise ValueError("a FLAC stream has no STREAMINFO")
    return Stream(*found, at, points)


class _Bits:
    def __init__(self, data: bytes):
        self.value, self.left = int.from_bytes(data, "big"), 8 * len(data)

    def take(self, n: int) -> int:
        self.left -= n
        return self.value >> self.left & (1 << n) - 1

    def signed(self, n: int) -> int:
        x = self.take(n)
        return x - (1 << n) if n and x >> (n - 1) else x


def _frame_head(data: bytes, at: int, info: Stream) -> tuple[int, int]:
    """Samples of the frame at ``at``, and where its subframe starts."""
    if data[at] != 0xFF or data[at + 1] & 0xFE != 0xF8:
        raise ValueError("no frame where one should start")
    code, rate = data[at + 2] >> 4, data[at + 2] & 15
    if data[at + 3] >> 4:
        raise ValueError("only mono streams are read")
    lead = data[at + 4]
    p = at + 5 + (max(0, 7 - (lead ^ 0xFF).bit_length()) if lead >= 0x80 else 0)
    if code == 1:
        n = 192
    elif 2 <= code <= 5:
        n = 576 << (code - 2)
    elif code == 6:
        n, p = data[p] + 1, p + 1
    elif code == 7:
        n, p = int.from_bytes(data[p : p + 2], "big") + 1, p + 2
    else:
        n = 256 << (code - 8)
    p += {12: 1, 13: 2, 14: 2}.get(rate, 0)
    if crc8(data[at:p]) != data[p]:
        raise ValueError("a frame header's CRC-8 is wrong")
    return n, p + 1


_CLZ = np.array([16 - int(i).bit_length() for i in range(1 << 16)], np.int64)


def decode_frames(data: bytes, starts: list[int], infos: list[Stream], ends: list[int] | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Decode frames of any streams together: the samples of each, and where each ends.

    ``ends`` gives the ends if they are known; the footer is checked against them.
    """
    f = len(starts)
    n, at, order, shift, kinds, bits = (np.zeros(f, np.int64) for _ in range(6))
    coef, warm, porder, method, wasted = np.zeros((32, f), np.int64), np.zeros((32, f), np.int64), np.zeros(f, np.int64), np.full(f, 4), np.zeros(f, np.int64)
    verbatim: dict[int, np.ndarray] = {}
    for i, (start, info) in enumerate(zip(starts, infos, strict=True)):
        n[i], p = _frame_head(data, start, info)
        b = _Bits(data[p : p + 200])
        total = b.left
        b.take(1)
        kind, bps = b.take(6), info.bits
        if b.take(1):
            wasted[i] = 1
            while not b.take(1):
                wasted[i] += 1
            bps -= int(wasted[i])
        kinds[i], bits[i] = kind, bps
        if kind == 0:
            warm[0, i] = b.signed(bps)
        elif kind == 1:
            p0 = 8 * p + total - b.left
            verbatim[i] = np.array([_Bits(data[(p0 + bps * s) // 8 : (p0 + bps * s) // 8 + 8]).value >> (64 - (p0 + bps * s) % 8 - bps) & (1 << bps) - 1 for s in range(int(n[i]))], np.int64)
            verbatim[i] -= (verbatim[i] >> (bps - 1)) << bps
            at[i] = p0 + bps * n[i]
            continue
        elif 8 <= kind <= 12:
            order[i] = kind - 8
            for j in range(kind - 8):
                warm[j, i] = b.signed(bps)
            coef[: kind - 8, i] = FIXED[kind - 8]
        elif kind >= 32:
            order[i] = kind - 31
            for j in range(kind - 31):
                warm[j, i] = b.signed(bps)
            precision = b.take(4) + 1
            shift[i] = b.signed(5)
            for j in range(kind - 31):
                coef[j, i] = b.signed(precision)
        else:
            raise ValueError("a reserved kind of subframe")
        if kind:
            method[i] = 4 + b.take(2)
            porder[i] = b.take(4)
        at[i] = 8 * p + total - b.left
    coded = np.flatnonzero(kinds >= 8)
    out = _residuals(data, at, n, order, porder, method, coded)
    _restore(out, n, order, shift, coef, warm, coded)
    samples = []
    for i in range(f):
        if kinds[i] == 0:
            got = np.full(int(n[i]), warm[0, i])
        elif kinds[i] == 1:
            got = verbatim[i]
        else:
            got = out[: int(n[i]), i]
        samples.append(got << wasted[i])
    stops = (at + 7) // 8 + 2
    if ends is not None and (stops != np.array(ends)).any():
        raise ValueError("a frame does not end where the next one starts")
    raw = np.frombuffer(data, np.uint8)
    found = crc16(raw, np.array(starts, np.int64), stops - 2)
    if (found != raw[stops - 2].astype(np.uint16) << 8 | raw[stops - 1]).any():
        raise ValueError("a frame's CRC-16 is wrong")
    return samples, stops


def _residuals(data: bytes, at: np.ndarray, n: np.ndarray, order: np.ndarray, porder: np.ndarray, method: np.ndarray, coded: np.ndarray) -> np.ndarray:
    """Rice residuals (samples, frames), a sample of every frame at a step; moves ``at``."""
    out = np.zeros((int(n.max(initial=0)), len(n)), np.int64)
    if not len(coded):
        return out
    raw = np.frombuffer(data + bytes(16), np.uint8)
    window = np.zeros(len(raw) - 8, np.uint64)
    for j in range(8):
        window |= raw[j : j + len(window)].astype(np.uint64) << np.uint64(56 - 8 * j)

    def peek(p: np.ndarray) -> np.ndarray:
        return window[np.minimum(p >> 3, len(window) - 1)] << (p & 7).astype(np.uint64)

    p, size = at[coded].copy(), n[coded]
    part = np.maximum(size >> porder[coded], 1)
    begin, rice, raws = order[coded], np.zeros(len(coded), np.int64), np.zeros(len(coded), np.int64) - 1
    width = method[coded]
    live = np.arange(len(coded))
    ready = int(begin.max())
    finish = int(size.min())
    for t in range(int(size.max())):
        if t >= finish:
            live = np.flatnonzero(size > t)
        new = live[(t % part[live] == 0) | (t == begin[live])] if t == 0 or t <= ready or (t % part[live] == 0).any() else None
        if new is not None and len(new):
            new = new[(t >= begin[new]) & ((t > begin[new]) & (t % part[new] == 0) | (t == begin[new]))]
            if len(new):
                rice[new] = (peek(p[new]) >> (64 - width[new]).astype(np.uint64)).astype(np.int64)
                p[new] += width[new]
                escape = rice[new] == (1 << width[new]) - 1
                raws[new] = -1
                if escape.any():
                    e = new[escape]
                    raws[e] = (peek(p[e]) >> np.uint64(59)).astype(np.int64)
                    p[e] += 5
        on = live if t >= ready else live[t >= begin[live]]
        if not len(on):
            continue
        whole = len(on) == len(p)
        q0, k = (p, rice) if whole else (p[on], rice[on])
        w = peek(q0)
        q = _CLZ[(w >> np.uint64(48)).astype(np.int64)]
        long = np.flatnonzero(q == 16)
        if len(long):
            more, open_ = np.full(len(long), 16), np.arange(len(long))
            while len(open_):
                here = q0[long[open_]] + more[open_]
                zeros = _CLZ[(peek(here) >> np.uint64(48)).astype(np.int64)]
                more[open_] += zeros
                open_ = open_[(zeros == 16) & (here >> 3 < len(window))]
            q = q.copy()
            q[long] = more
            w = w.copy()
            w[long] = peek(q0[long] + q[long])
            first = q.copy()
            first[long] = 0
        else:
            first = q
        tail = (w << (first + 1).astype(np.uint64)) >> np.uint64(1) >> (63 - k).astype(np.uint64)
        value = q << k | tail.astype(np.int64)
        step = q + 1 + k
        plain = raws if whole else raws[on]
        if (plain >= 0).any():
            e = np.flatnonzero(plain >= 0)
            size_e = plain[e]
            got = np.where(size_e > 0, (peek(q0[e]) >> np.uint64(1) >> np.clip(63 - size_e, 0, 63).astype(np.uint64)).astype(np.int64), 0)
            got -= np.where(size_e > 0, (got >> np.maximum(size_e - 1, 0)) << size_e, 0)
            value[e] = np.where(got >= 0, got << 1, ~(got << 1))
            step[e] = size_e
        if whole:
            p += step
        else:
            p[on] += step
        out[t, coded[on]] = (value >> 1) ^ -(value & 1)
    at[coded] = p
    return out


def _restore(out: np.ndarray, n: np.ndarray, order: np.ndarray, shift: np.ndarray, coef: np.ndarray, warm: np.ndarray, coded: np.ndarray) -> None:
    """Turn residuals into samples in place, frames of one order together."""
    for o in np.unique(order[coded]).tolist():
        rows = coded[order[coded] == o]
        if o == 0:
            continue
        x = out[:, rows]
        x[:o] = warm[:o, rows]
        c, s = coef[:o, rows][::-1].copy(), shift[rows]
        for t in range(o, len(x)):
            x[t] += (c * x[t - o : t]).sum(axis=0) >> s
        out[:, rows] = x


def decode(medias: list[bytes]) -> list[bytes]:
    """The payload of each 8-bit stream as unsigned samples, checked against its MD5.

    Frames are found by seek points; a stream whose points leave out frames is
    read frame after frame.
    """
    infos = [metadata(m) for m in medias]
    if any(i.bits != 8 for i in infos):
        raise ValueError("only 8-bit streams are unsigned payloads")
    parts: list[list[np.ndarray]] = [[] for _ in medias]
    data, starts, owner, ends, base = [], [], [], [], 0

    def flush() -> None:
        nonlocal base
        joined = b"".join(data)
        for got, i in zip(decode_frames(joined, starts, [infos[i] for i in owner], ends)[0], owner, strict=True):
            parts[i].append(got.astype(np.int8))
        data.clear(), starts.clear(), owner.clear(), ends.clear()
        base = 0

    for i, (m, info) in enumerate(zip(medias, infos, strict=True)):
        if sum(p[2] for p in info.points) != info.samples:
            at = info.start
            while at < len(m) and sum(map(len, parts[i])) < info.samples:
                got, stop = decode_frames(m, [at], [info])
                parts[i].append(got[0].astype(np.int8))
                at = int(stop[0])
            continue
        data.append(m[info.start :])
        offsets = [p[1] for p in info.points] + [len(m) - info.start]
        for a, z in zip(offsets, offsets[1:], strict=False):
            starts.append(base + a), ends.append(base + z), owner.append(i)
        base += len(m) - info.start
        if len(starts) >= 4096:
            flush()
    if starts:
        flush()
    out = []
    for p, info in zip(parts, infos, strict=True):
        signed = np.concatenate(p).tobytes() if p else b""
        if hashlib.md5(signed).digest() != info.md5:
            raise ValueError("a stream's MD5 is wrong")
        out.append((np.frombuffer(signed, np.uint8) ^ 0x80).tobytes())
    return out


def read_pcm(media: bytes, start: int, stop: int) -> np.ndarray:
    """Signed samples from ``start`` to ``stop``; only the frames that hold them are decoded."""
    info = metadata(media)
    wanted = [k for k, (first, _, n) in enumerate(info.points) if first < stop and first + n > start]
    if not wanted:
        return np.zeros(0, np.int64)
    got, _ = decode_frames(media, [info.start + info.points[k][1] for k in wanted], [info] * len(wanted))
    first = info.points[wanted[0]][0]
    return np.concatenate(got)[start - first : stop - first]


# ---------------------------------------------------------------- columns


def padded(text: bytes, unit: int = UNIT) -> bytes:
    return text + b" " * (-len(text) % unit if text else unit)


def store(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, media``: each whole text's UTF-8 bytes, padded with spaces to a positive multiple of 192, as FLAC.

    A null text counts as empty. Other columns are ignored; repeated rows give
    repeated results; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(1))
            for i, j in slices(offsets, 1 << 22):
                texts = [bytes(data[a:z]) for a, z in zip(offsets[i:j].tolist(), offsets[i + 1 : j + 1].tolist(), strict=True)]
                media = encode([padded(t) for t in texts])
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], pa.array(list(map(len, texts)), pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), "text").transform(mapped, run, "doc_id long, n_bytes long, media binary")


def feature(payload: bytes) -> str:
    """Integer features of the decoded samples as text."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    crossings = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"samples={len(x)};min={x.min(initial=0)};max={x.max(initial=0)};sum={x.sum()};energy={(x * x).sum()};crossings={crossings}"


def pcm_blocks(stored: DataFrame) -> DataFrame:
    """``doc_id, first_sample, pcm`` for each frame of each stream of ``stored`` (``doc_id, media``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_id, media in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                info, payload = metadata(media), decode([media])[0]
                firsts = [p[0] for p in info.points]
                blocks = [payload[p[0] : p[0] + p[2]] for p in info.points]
                yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(firsts), pa.int64()), pa.array(firsts, pa.int64()), pa.array(blocks, pa.binary())], names=["doc_id", "first_sample", "pcm"])

    return stored.filter("media is not null").select("doc_id", "media").transform(mapped, run, "doc_id long, first_sample long, pcm binary")


def digests(stored: DataFrame) -> DataFrame:
    """Read the streams of ``stored`` back and describe what was read; ``block_samples`` are the first samples of blocks, by the seek points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(2).cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            for i, j in slices(offsets, 1 << 22):
                media = b.column(2)[i:j].to_pylist()
                payloads = decode(media)
                rows = [
                    b.column(0)[i:j],
                    b.column(1)[i:j],
                    pa.array(list(map(len, payloads)), pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in payloads]),
                    pa.array([zlib.crc32(p[-16:]) for p in payloads], pa.int64()),
                    pa.array(list(map(len, media)), pa.int64()),
                    pa.array([hashlib.sha256(m).hexdigest() for m in media]),
                    pa.array(list(map(feature, payloads))),
                    pa.array([[first for first, _, _ in metadata(m).points] for m in media], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(rows, names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "block_samples"])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, block_samples array<long>"
    return stored.transform(mapped, run, schema)
