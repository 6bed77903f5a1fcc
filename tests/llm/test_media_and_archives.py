from __future__ import annotations

import base64
import hashlib
import io
import zipfile
import zlib

import numpy as np
import pytest

from pagequarry.llm import flac, warc_zip
from pagequarry.llm.common import stage_table

RNG = np.random.default_rng(5)
PAYLOADS = [
    b" " * 192,
    bytes(192),
    RNG.integers(0, 256, 1152, dtype=np.uint8).tobytes(),
    RNG.integers(0, 256, 1152 * 3 + 192, dtype=np.uint8).tobytes(),
    b"a" * 191 + b"\xff",
    b"ab" * 96 * 7,
    bytes([0] * 1000 + [255] * 152),
    (np.sin(np.arange(2304) / 9) * 100 + 128).astype(np.uint8).tobytes(),
    b"The quick brown fox. " * 4000 + b" " * 96,
]


def test_streams_round_trip():
    assert flac.decode(flac.encode(PAYLOADS)) == PAYLOADS


def test_ranges_of_samples():
    media = flac.encode(PAYLOADS)
    for p, m in zip(PAYLOADS, media, strict=True):
        want = np.frombuffer(p, np.uint8).astype(int) - 128
        for a, z in [(0, 1), (100, 192), (1100, 1200), (0, len(p))]:
            assert flac.read_pcm(m, a, min(z, len(p))).tolist() == want[a:z].tolist()


def test_streams_without_seek_points_are_read_in_turn():
    m = flac.encode([PAYLOADS[3]])[0]
    info = flac.metadata(m)
    bare = m[:4] + b"\x80" + m[5:42] + m[info.start :]
    assert not flac.metadata(bare).points and flac.decode([bare]) == [PAYLOADS[3]]


def test_damage_is_found():
    m = bytearray(flac.encode([PAYLOADS[8]])[0])
    start = flac.metadata(bytes(m)).start
    for at in (start + 2, start + 300, len(m) - 1):
        bad = bytearray(m)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            flac.decode([bytes(bad)])


def test_checksums():
    def plain(data, bits, poly):
        c = 0
        for b in data:
            c ^= b << (bits - 8)
            for _ in range(8):
                c = (c << 1 ^ poly if c >> (bits - 1) else c << 1) & ((1 << bits) - 1)
        return c

    data = RNG.integers(0, 256, 5000, dtype=np.uint8)
    assert flac.crc8(data[:9].tobytes()) == plain(data[:9].tolist(), 8, 7)
    starts, stops = np.array([0, 10, 700]), np.array([9, 10, 4321])
    assert flac.crc16(data, starts, stops).tolist() == [plain(data[a:z].tolist(), 16, 0x8005) for a, z in zip(starts, stops, strict=True)]


def test_long_unary_codes():
    """Residuals far above their Rice parameter, as other encoders may write them."""
    value = np.array([1], np.uint64)
    bits = flac.pack_bits(np.concatenate([np.zeros(1, np.uint64), value, value]), np.array([40, 1, 1]))
    at = np.array([0])
    out = flac._residuals(b"\0" + bits, at + 4, np.array([1]), np.array([0]), np.array([0]), np.array([4]), np.array([0]))
    assert out[0, 0] == (40 >> 1)


def test_documents_as_media(docs):
    texts = [None, "", "x", "é" * 500, "word " * 20_000, "same", "same"]
    got = {r["doc_id"]: r for r in flac.digests(flac.store(docs(texts))).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b" " * (-len(raw) % 192 if raw else 192)
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), len(payload))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-16:])
    assert got[5]["media_sha256"] == got[6]["media_sha256"] and got[0]["media_sha256"] == got[1]["media_sha256"]
    blocks = flac.pcm_blocks(flac.store(docs(texts))).filter("doc_id = 4").orderBy("first_sample").collect()
    assert b"".join(r["pcm"] for r in blocks).rstrip() == texts[4].encode().rstrip()
    assert flac.digests(flac.store(docs(texts).limit(0))).count() == 0


@pytest.mark.parametrize("zip64", [False, True])
def test_archives_are_what_others_read(tmp_path, zip64):
    members = [("a/b.txt", b"hello"), ("c", b""), ("é", b"x" * 100_000)]
    data = b"".join(warc_zip.zip_stored(members, zip64))
    (tmp_path / "z").write_bytes(data)
    found = warc_zip.ZipArchive(f"file://{tmp_path}/z")
    assert [(n, found.member(n)) for n in found.entries] == members
    other = zipfile.ZipFile(io.BytesIO(data))
    assert other.testzip() is None and [(n, other.read(n)) for n in other.namelist()] == members


def test_archives_of_others(tmp_path):
    with zipfile.ZipFile(tmp_path / "z", "w") as z:
        z.comment = b"PK\5\6 not the end"
        z.writestr("stored", b"value")
        z.writestr("packed", b"value" * 99, zipfile.ZIP_DEFLATED)
    found = warc_zip.ZipArchive(f"file://{tmp_path}/z")
    assert found.member("stored") == b"value"
    with pytest.raises(ValueError):
        found.place("packed")
    (tmp_path / "n").write_bytes(b"nothing here, but long enough to be looked at")
    with pytest.raises(ValueError):
        warc_zip.ZipArchive(f"file://{tmp_path}/n")


def test_archived_pages(spark):
    big = "<p>" + "x" * 300_000
    rows = [(1, "http://a/ b\r\nX: y", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (5, "q", "y"), (None, "z", "x"), (5, "q", "y"), (6, "w", big), (7, "w", "é\r\n\r\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as refers_to")
    got = sorted(((str(r["page_id"]), r["record_type"], str(r["refers_to"]), r["payload_bytes"], r["payload_digest"]) for r in warc_zip.archived(df).collect()))

    def want(i, html, kind, refers):
        raw = (html or "").encode()
        return str(i), kind, str(refers), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode()

    assert got == sorted(
        [want(1, "x", "revisit", 2), want(2, "x", "response", None), want(3, None, "revisit", 4), want(4, "", "response", None), want(5, "y", "response", None), want(None, "x", "revisit", 2), want(5, "y", "response", None), want(6, big, "response", None), want(7, "é\r\n\r\n", "response", None)]
    )
    small = {r["page_id"]: r["record_type"] for r in warc_zip.archived(df, 1).collect() if r["page_id"] in (3, 4)}
    assert small == {3: "response", 4: "response"}
    assert warc_zip.archived(df.limit(0)).count() == 0


def test_ranges_split_at_records(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://s/{i}", f"page {i} " * 50) for i in range(40)], "page_id long, url string, html string")
    archives = stage_table(warc_zip.write_archives(warc_zip.with_revisits(pages), f"file://{tmp_path}/a", archive_bytes=700, zip64=True), "archives")
    assert archives.count() > 3
    ranges = warc_zip.locate(archives, 300)
    assert ranges.count() > archives.count()
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in warc_zip.read_records(ranges, 4).collect()} == {i: f"page {i} " * 50 for i in range(40)}
