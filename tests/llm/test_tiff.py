"""TIFF pages: round trips, foreign layouts written by hand, broken files, edge rows."""

import hashlib
import os
import random
import struct
import zlib

import numpy as np
import pytest

from logharbor.llm import tiff
from logharbor.llm.queries import QUERIES

TEXTS = ["", "a", "x" * 192, "y" * 193, "é" * 5000, "aaaa" * 40000, os.urandom(4000).hex()]


@pytest.mark.parametrize("layout", tiff.LAYOUTS)
def test_round_trip(layout):
    for text in TEXTS:
        _, payload = tiff.padded(text)
        for page_rows in (7, 100, tiff.PAGE_ROWS):
            pages = list(tiff.read_pages(tiff.write_tiff(payload, *layout, page_rows=page_rows)))
            assert [p["page"] for p in pages] == list(range(len(pages)))
            assert {p["status"] for p in pages} == {"ok"}
            assert b"".join(p["pixels"] for p in pages) == payload
            assert sum(p["height"] for p in pages) * tiff.ROW_BYTES == len(payload)


def test_codes_round_trip():
    rng = random.Random(1)
    for n in (0, 1, 2, 127, 128, 129, 255, 256, 257, 3000, 70000):
        for data in (os.urandom(n), bytes(n), bytes(rng.choices(b"ab", k=n))):
            assert tiff.lzw_decode(tiff.lzw_encode(data)) == data
            assert tiff.packbits_decode(tiff.packbits_encode(data)) == data


def by_hand(order, fields, blobs):
    """A one-page file: ``fields`` of (tag, kind, values), values "blobs" and "sizes" filled in."""
    body = (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0)
    places = []
    for blob in blobs:
        places.append(len(body))
        body += blob
    directory, late = b"", b""
    entries = sorted((t, k, places if v == "blobs" else [len(b) for b in blobs] if v == "sizes" else v) for t, k, v in fields)
    start = len(body)
    after = start + 2 + 12 * len(entries) + 4
    for tag, kind, values in entries:
        packed = struct.pack(f"{order}{len(values)}{'H' if kind == 3 else 'I'}", *values)
        if len(packed) > 4:
            packed, late = struct.pack(order + "I", after + len(late)), late + packed
        directory += struct.pack(order + "HHI", tag, kind, len(values)) + packed.ljust(4, b"\0")
    body += struct.pack(order + "H", len(entries)) + directory + struct.pack(order + "I", 0) + late
    return body[:4] + struct.pack(order + "I", start) + body[8:]


@pytest.mark.parametrize("order", ["<", ">"])
def test_sixteen_bit_planar_with_predictor(order):
    image = np.random.default_rng(2).integers(0, 65536, (5, 7, 2)).astype(np.uint16)
    planes = [np.diff(image[:, :, s], axis=1, prepend=np.zeros((5, 1), np.uint16)).astype(order + "u2") for s in range(2)]
    blobs = [zlib.compress(p[a:b].tobytes()) for p in planes for a, b in ((0, 3), (3, 5))]
    fields = [(256, 4, [7]), (257, 4, [5]), (258, 3, [16, 16]), (259, 3, [8]), (273, 4, "blobs"), (277, 3, [2]), (278, 4, [3]),
              (279, 4, "sizes"), (284, 3, [2]), (317, 3, [2])]
    page, = tiff.read_pages(by_hand(order, fields, blobs))
    assert page["status"] == "ok" and page["pixels"] == image.astype("<u2").tobytes()


def test_edge_tiles_are_cut():
    image = np.arange(20 * 18, dtype=np.uint32).astype(np.uint8).reshape(20, 18)
    blobs = []
    for top in (0, 16):
        for left in (0, 16):
            tile = np.zeros((16, 16), np.uint8)
            part = image[top:top + 16, left:left + 16]
            tile[:part.shape[0], :part.shape[1]] = part
            blobs.append(tile.tobytes())
    fields = [(256, 4, [18]), (257, 4, [20]), (258, 3, [8]), (259, 3, [1]), (322, 4, [16]), (323, 4, [16]), (324, 4, "blobs"), (325, 4, "sizes")]
    page, = tiff.read_pages(by_hand("<", fields, blobs))
    assert page["pixels"] == image.tobytes() and page["tiled"]


def test_broken_files_give_error_rows():
    whole = tiff.write_tiff(tiff.padded("abc" * 9000)[1], tiff.LZW, 1, page_rows=50)
    assert len(list(tiff.read_pages(whole))) > 2
    for end in range(0, len(whole), 97):
        pages = list(tiff.read_pages(whole[:end]))
        assert pages[-1]["status"] in ("error", "empty")
    loop = bytearray(tiff.write_tiff(tiff.padded("abc")[1]))
    loop[-4:] = loop[4:8]
    assert list(tiff.read_pages(bytes(loop)))[-1]["error"] == "directories form a loop"


def test_rows(spark):
    media = bytearray(tiff.write_tiff(tiff.padded("abc" * 9000)[1], page_rows=50))
    df = spark.createDataFrame([(1, bytes(media), 5), (1, bytes(media), 5), (2, None, 6), (3, b"junk", 7), (None, b"", 8)], "doc_id bigint, media binary, page int")
    rows = tiff.tiff_pages(df).collect()
    assert sum(r.doc_id == 1 and r.status == "ok" for r in rows) == 2 * len(list(tiff.read_pages(bytes(media))))
    assert {(r.doc_id, r.status) for r in rows if r.doc_id != 1} == {(2, "empty"), (3, "error"), (None, "empty")}
    assert tiff.tiff_pages(df.limit(0)).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    seen = {}
    for r in QUERIES["op1_tiff_media"](spark, sf_dir).collect():
        data = texts[r.doc_id].encode()
        payload = data + b" " * (max(1, -(-len(data) // 192)) * 192 - len(data))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(data), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-16:])
        assert seen.setdefault(payload, (r.media_sha256, r.feature, r.media_bytes)) == (r.media_sha256, r.feature, r.media_bytes)
    assert len(seen) == len(set(texts.values()))
