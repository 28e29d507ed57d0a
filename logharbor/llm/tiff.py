"""TIFF media columns: image directories walked, strips and tiles decoded, one row per page.

``tiff_pages`` reads a binary column and returns a row per image directory with its samples as
they are shown (predictors undone, tiles put together, padding cut off). Compressions: none,
PackBits, LZW, deflate; predictors: none, horizontal (8 and 16 bit); chunky and planar samples of
8 or 16 bits; both byte orders. ``with_tiff`` stores bytes as such a file.

Defined results: a null or empty media value gives one row with status ``empty``; a broken file or
an unsupported feature gives a row with status ``error`` and the reason, after the pages read so
far; directory loops end the walk with an error. Repeated rows give repeated pages.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Fixed values of the format: compression codes and tag numbers.
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR, PREDICTOR = 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325
FIELD_TYPES = {1: ("B", 1), 3: ("H", 2), 4: ("I", 4)}       # byte, short, long
CLEAR, END = 256, 257

PIXEL_WIDTH, PIXEL_SAMPLES = 64, 3
ROW_BYTES = PIXEL_WIDTH * PIXEL_SAMPLES      # 192
PAGE_ROWS = 512                              # rows of a stored page: 96 KiB
STRIP_ROWS, TILE_ROWS = 64, 64
LAYOUTS = [(c, p, t) for t in (False, True) for c, p in ((PACKBITS, 1), (LZW, 1), (DEFLATE, 2))]
MAX_PIXELS = 1 << 31                         # a directory that claims more is an error, not an allocation

PAGE = pa.struct([
    ("page", pa.int32()), ("status", pa.string()), ("error", pa.string()), ("width", pa.int32()), ("height", pa.int32()),
    ("samples", pa.int32()), ("bits", pa.int32()), ("compression", pa.int32()), ("predictor", pa.int32()),
    ("tiled", pa.bool_()), ("pixels", pa.binary()),
])
PAGE_DDL = ("struct<page int, status string, error string, width int, height int, samples int, bits int, "
            "compression int, predictor int, tiled boolean, pixels binary>")


class TiffError(ValueError):
    pass


# --- compressions ------------------------------------------------------------------------------


def packbits_decode(data: bytes) -> bytes:
    out, at, end = [], 0, len(data)
    while at < end:
        n = data[at]
        if n < 128:
            out.append(data[at + 1:at + 2 + n])
            at += n + 2
        elif n > 128:
            out.append(data[at + 1:at + 2] * (257 - n))
            at += 2
        else:
            at += 1
    return b"".join(out)


_RUN = re.compile(rb"(.)\1{2,127}", re.DOTALL)


def packbits_encode(row: bytes) -> bytes:
    out, at = [], 0
    for m in _RUN.finditer(row):
        out += _literals(row[at:m.start()])
        out.append(bytes((257 - (m.end() - m.start()), m.group()[0])))
        at = m.end()
    return b"".join([*out, *_literals(row[at:])])


def _literals(data: bytes) -> list[bytes]:
    return [bytes((len(data[i:i + 128]) - 1,)) + data[i:i + 128] for i in range(0, len(data), 128)]


def lzw_encode(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant bit first, widths changing one code early."""
    runs: list[tuple[int, list[int]]] = []      # (bits, codes)
    codes = [CLEAR]
    runs.append((9, codes))
    table: dict[int, int] = {}
    free, width, prefix = 258, 9, -1
    for byte in data:
        if prefix < 0:
            prefix = byte
            continue
        key = prefix << 8 | byte
        code = table.get(key)
        if code is not None:
            prefix = code
            continue
        codes.append(prefix)
        table[key] = free
        free += 1
        if free == 1 << width:
            width += 1
            codes = []
            runs.append((width, codes))
        if free == 4095:
            codes.append(CLEAR)
            table = {}
            free, width, codes = 258, 9, []
            runs.append((9, codes))
        prefix = byte
    if prefix >= 0:
        codes.append(prefix)
        free += 1
        if free == 1 << width:
            width += 1
            codes = []
            runs.append((width, codes))
    codes.append(END)
    bits = [(np.array(c, np.int64)[:, None] >> np.arange(w - 1, -1, -1) & 1).ravel() for w, c in runs if c]
    return np.packbits(np.concatenate(bits).astype(np.uint8)).tobytes()


def lzw_decode(data: bytes) -> bytes:
    raw = np.frombuffer(data + bytes(4), np.uint8).astype(np.int64)
    total = 8 * len(data)
    first = [bytes((i,)) for i in range(256)] + [b"", b""]
    out: list[bytes] = []
    at = 0
    while at + 9 <= total:
        table, last = list(first), None
        ended = False
        for width, most in ((9, 254), (10, 512), (11, 1024), (12, 1 << 30)):
            count = min(most, (total - at) // width, 8192)
            if count <= 0:
                return b"".join(out)
            bit = at + width * np.arange(count)
            byte = bit >> 3
            words = raw[byte] << 16 | raw[byte + 1] << 8 | raw[byte + 2]
            used = 0
            for code in ((words >> (24 - width - (bit & 7))) & ((1 << width) - 1)).tolist():
                used += 1
                if code == CLEAR:
                    at += used * width
                    ended = True
                    break
                if code == END:
                    return b"".join(out)
                if last is None:
                    if code > 255:
                        raise TiffError("LZW: bad first code")
                    entry = table[code]
                elif code < len(table):
                    entry = table[code]
                    table.append(last + entry[:1])
                elif code == len(table):
                    entry = last + last[:1]
                    table.append(entry)
                else:
                    raise TiffError("LZW: code beyond the table")
                out.append(entry)
                last = entry
                if len(table) > 4097:
                    raise TiffError("LZW: table overflow")
            if ended:
                break
            at += used * width
        if not ended:
            break
    return b"".join(out)


def decompress(data: bytes, compression: int, size: int) -> bytes:
    if compression == NONE:
        out = data
    elif compression == PACKBITS:
        out = packbits_decode(data)
    elif compression == LZW:
        out = lzw_decode(data)
    elif compression in (DEFLATE, OLD_DEFLATE):
        try:
            out = zlib.decompressobj().decompress(data, size)
        except zlib.error as e:
            raise TiffError(f"deflate: {e}") from e
    else:
        raise TiffError(f"compression {compression}")
    if len(out) < size:
        raise TiffError("too few samples")
    return out[:size]


def compress(data: bytes, compression: int, row_bytes: int) -> bytes:
    if compression == PACKBITS:
        return b"".join(packbits_encode(data[i:i + row_bytes]) for i in range(0, len(data), row_bytes))
    if compression == LZW:
        return lzw_encode(data)
    if compression == DEFLATE:
        return zlib.compress(data, 6)
    return data


# --- reading -----------------------------------------------------------------------------------


def read_pages(data: bytes | None) -> Iterator[dict]:
    """A dictionary per page, in the order of the directories."""
    if not data:
        yield {"page": 0, "status": "empty"}
        return
    page = 0
    try:
        order = {b"II": "<", b"MM": ">"}.get(data[:2])
        if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
            raise TiffError("no TIFF header")
        at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
        if at == 0:
            raise TiffError("no directory")
        while at:
            if at in seen:
                raise TiffError("directories form a loop")
            seen.add(at)
            tags, at = _directory(data, at, order)
            yield _page(data, tags, order) | {"page": page, "status": "ok"}
            page += 1
    except (TiffError, struct.error, IndexError, MemoryError) as e:
        yield {"page": page, "status": "error", "error": str(e) or type(e).__name__}


def _directory(data: bytes, at: int, order: str) -> tuple[dict[int, list[int]], int]:
    entries = struct.unpack_from(order + "H", data, at)[0]
    tags = {}
    for k in range(entries):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
        if kind not in FIELD_TYPES:
            continue
        code, size = FIELD_TYPES[kind]
        where = at + 10 + 12 * k
        if count * size > 4:
            where = struct.unpack_from(order + "I", data, where)[0]
        if where + count * size > len(data):
            raise TiffError(f"tag {tag} lies outside the file")
        tags[tag] = list(struct.unpack_from(f"{order}{count}{code}", data, where))
    return tags, struct.unpack_from(order + "I", data, at + 2 + 12 * entries)[0]


def _page(data: bytes, tags: dict[int, list[int]], order: str) -> dict:
    def one(tag: int, default: int | None = None) -> int:
        if tag in tags and tags[tag]:
            return tags[tag][0]
        if default is None:
            raise TiffError(f"tag {tag} is missing")
        return default

    width, height, samples = one(WIDTH), one(HEIGHT), one(SAMPLES, 1)
    bits = set(tags.get(BITS, [1]))
    compression, predictor, planar = one(COMPRESSION, 1), one(PREDICTOR, 1), one(PLANAR, 1)
    if bits not in ({8}, {16}):
        raise TiffError(f"{sorted(bits)} bits a sample")
    if predictor not in (1, 2) or planar not in (1, 2):
        raise TiffError(f"predictor {predictor}, planar configuration {planar}")
    if not 0 < width * height * samples <= MAX_PIXELS:
        raise TiffError(f"{width} x {height} x {samples} samples")
    depth = bits.pop()
    kind = np.dtype(np.uint8) if depth == 8 else np.dtype(order + "u2")
    tiled = TILE_OFFSETS in tags
    if tiled:
        box_width, box_height = one(TILE_WIDTH), one(TILE_HEIGHT)
        offsets, counts = tags[TILE_OFFSETS], tags.get(TILE_COUNTS, [])
    else:
        box_width, box_height = width, min(one(ROWS_PER_STRIP, height), height)
        offsets, counts = tags.get(STRIP_OFFSETS, []), tags.get(STRIP_COUNTS, [])
    if box_width < 1 or box_height < 1 or len(offsets) != len(counts):
        raise TiffError("strips or tiles without size")
    across, down = -(-width // box_width), -(-height // box_height)
    planes, per_pixel = (samples, 1) if planar == 2 else (1, samples)
    if len(offsets) < across * down * planes:
        raise TiffError("too few strips or tiles")
    image = np.zeros((height, width, samples), kind.newbyteorder("="))
    for k in range(across * down * planes):
        plane, place = divmod(k, across * down)
        top, left = place // across * box_height, place % across * box_width
        rows = box_height if tiled else min(box_height, height - top)
        packed = data[offsets[k]:offsets[k] + counts[k]]
        size = rows * box_width * per_pixel * kind.itemsize
        box = np.frombuffer(decompress(packed, compression, size), kind).reshape(rows, box_width, per_pixel)
        if predictor == 2:
            box = np.cumsum(box, axis=1, dtype=kind.newbyteorder("="))
        part = box[:height - top, :width - left]
        into = slice(plane, plane + 1) if planar == 2 else slice(None)
        image[top:top + part.shape[0], left:left + part.shape[1], into] = part
    return {"width": width, "height": height, "samples": samples, "bits": depth, "compression": compression,
            "predictor": predictor, "tiled": tiled, "pixels": image.astype("<u2" if depth == 16 else np.uint8).tobytes()}


# --- writing -----------------------------------------------------------------------------------


def write_tiff(payload: bytes, compression: int = DEFLATE, predictor: int = 2, tiled: bool = False,
               page_rows: int = PAGE_ROWS) -> bytes:
    """``payload``, a multiple of 192 bytes, as RGB pages of 64 pixels a row."""
    if not payload or len(payload) % ROW_BYTES:
        raise ValueError("the payload has to be a positive multiple of a row")
    body, directories = bytearray(b"II*\0\0\0\0\0"), []
    box_rows = TILE_ROWS if tiled else STRIP_ROWS
    for start in range(0, len(payload), page_rows * ROW_BYTES):
        page = payload[start:start + page_rows * ROW_BYTES]
        offsets, counts = [], []
        for at in range(0, len(page), box_rows * ROW_BYTES):
            box = page[at:at + box_rows * ROW_BYTES]
            if tiled:
                box = box.ljust(box_rows * ROW_BYTES, b"\0")
            if predictor == 2:
                pixels = np.frombuffer(box, np.uint8).reshape(-1, PIXEL_WIDTH, PIXEL_SAMPLES)
                box = np.diff(pixels, axis=1, prepend=np.zeros_like(pixels[:, :1])).tobytes()
            packed = compress(box, compression, ROW_BYTES)
            offsets.append(len(body))
            counts.append(len(packed))
            body += packed
        directories.append((len(page) // ROW_BYTES, offsets, counts))
    link = 4
    for rows, offsets, counts in directories:
        fields = [(WIDTH, 4, [PIXEL_WIDTH]), (HEIGHT, 4, [rows]), (BITS, 3, [8] * PIXEL_SAMPLES), (COMPRESSION, 3, [compression]),
                  (PHOTOMETRIC, 3, [2]), (SAMPLES, 3, [PIXEL_SAMPLES]), (PLANAR, 3, [1]), (PREDICTOR, 3, [predictor])]
        if tiled:
            fields += [(TILE_WIDTH, 4, [PIXEL_WIDTH]), (TILE_HEIGHT, 4, [box_rows]), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, counts)]
        else:
            fields += [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, [box_rows]), (STRIP_COUNTS, 4, counts)]
        body += b"\0" * (len(body) % 2)
        entries = bytearray()
        for tag, kind, values in sorted(fields):
            code, size = FIELD_TYPES[kind]
            packed = struct.pack(f"<{len(values)}{code}", *values)
            if len(packed) > 4:
                where, packed = len(body), packed
                body += packed + b"\0" * (len(packed) % 2)
                packed = struct.pack("<I", where)
            entries += struct.pack("<HHI", tag, kind, len(values)) + packed.ljust(4, b"\0")
        struct.pack_into("<I", body, link, len(body))
        body += struct.pack("<H", len(fields)) + entries
        link = len(body)
        body += b"\0\0\0\0"
    return bytes(body)


def padded(text: str | None) -> tuple[int, bytes]:
    """Length of the UTF-8 text and the text filled with spaces to whole pixel rows, one at least."""
    data = (text or "").encode()
    return len(data), data.ljust(max(1, -(-len(data) // ROW_BYTES)) * ROW_BYTES, b" ")


# --- on tables ---------------------------------------------------------------------------------


def with_tiff(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``media``: each text stored as a TIFF file.

    Compression and layout follow from the payload's CRC, so equal texts give equal files.
    """
    kind = dict(df.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, media = [], []
            for text in batch.column(1):
                size, payload = padded(text.as_py())
                compression, predictor, tiled = LAYOUTS[zlib.crc32(payload) % len(LAYOUTS)]
                sizes.append(size)
                media.append(write_tiff(payload, compression, predictor, tiled))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())],
                                             names=["doc_id", "n_bytes", "media"])

    return small_batches(df.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))).mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, media binary")


def with_pages(df: DataFrame, media_column: str = "media") -> DataFrame:
    """``df`` with ``pages``, the array of its pages; a column of that name is replaced."""
    df = df.drop("pages") if media_column != "pages" else df
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(read_pages(m.as_py())) for m in batch.column(names.index(media_column))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(PAGE))], names=[*names, "pages"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return small_batches(df).mapInArrow(run, f"{fields}, pages array<{PAGE_DDL}>")


def tiff_pages(df: DataFrame, media_column: str = "media") -> DataFrame:
    """One row per page: the other columns of ``df`` and ``page, status, error, ... pixels``."""
    own = set(PAGE.field(i).name for i in range(PAGE.num_fields))
    rest = [c for c in df.columns if c != media_column and c not in own]
    return with_pages(df.select(*rest, media_column), media_column).select(*rest, F.explode("pages").alias("_page")).select(*rest, "_page.*")
