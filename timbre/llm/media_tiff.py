"""Media columns: TIFF images, written as grey 8-bit samples and read back by page.

The reader walks the chain of image directories of either byte order, decodes
strips or tiles that are raw, PackBits, LZW or deflate, undoes the horizontal
predictor, and returns one row per page. The writer makes such files.

Edge cases: a null text is an empty one; an empty text is stored as 64 zero
bytes; very long texts become several pages; a null ``doc_id``, repeated rows,
an empty table and other columns need nothing special. A broken file raises
``ValueError`` from :func:`read_pages`; :func:`decode_pages` gives it one row
with the error and null samples.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from timbre.llm.common import narrow

WIDTH = 64
#: Rows of one page, so that a page holds 256 KiB at most.
PAGE_ROWS = 4096
#: Rows of one strip (16 KiB).
STRIP_ROWS = 256

# Fixed values of the format: tags, field types with their sizes, compressions.
IMAGE_WIDTH, IMAGE_LENGTH, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 273, 277, 278, 279
PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS = 317, 322, 323, 324, 325
TYPE_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
RAW, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
LZW_CLEAR, LZW_END = 256, 257


def packbits_encode(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        run = 1
        while run < 128 and i + run < n and data[i + run] == data[i]:
            run += 1
        if run > 1:
            out += bytes((257 - run, data[i]))
            i += run
            continue
        j = i + 1
        while j < n and j - i < 128 and not (j + 1 < n and data[j] == data[j + 1]):
            j += 1
        out.append(j - i - 1)
        out += data[i:j]
        i = j
    return bytes(out)


def packbits_decode(data: bytes, size: int) -> bytes:
    out, i = bytearray(), 0
    while len(out) < size and i < len(data):
        n = data[i]
        i += 1
        if n < 128:
            out += data[i : i + n + 1]
            i += n + 1
        elif n > 128:
            out += data[i : i + 1] * (257 - n)
            i += 1
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bit first, widened when entry 511 is added, as the format asks."""
    acc = bits = 0
    out, width = bytearray(), 9
    table: dict[bytes, int] = {}

    def put(code: int) -> None:
        nonlocal acc, bits
        acc, bits = acc << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(acc >> bits & 255)
        acc &= (1 << bits) - 1

    put(LZW_CLEAR)
    table, word = {bytes((i,)): i for i in range(256)}, b""
    code = 258
    for i in range(len(data)):
        longer = word + data[i : i + 1]
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer] = code
        code += 1
        if code in (512, 1024, 2048):
            width += 1
        elif code == 4095:
            put(LZW_CLEAR)
            table, width, code = {bytes((i,)): i for i in range(256)}, 9, 258
        word = data[i : i + 1]
    if word:
        put(table[word])
        if code + 1 in (512, 1024, 2048):
            width += 1
    put(LZW_END)
    if bits:
        out.append(acc << (8 - bits) & 255)
    return bytes(out)


def lzw_decode(data: bytes, size: int) -> bytes:
    out = bytearray()
    acc = bits = at = 0
    width, table, last = 9, [], b""
    while len(out) < size:
        while bits < width:
            if at >= len(data):
                raise ValueError("an LZW strip ends early")
            acc, bits, at = acc << 8 | data[at], bits + 8, at + 1
        bits -= width
        code = acc >> bits
        acc &= (1 << bits) - 1
        if code == LZW_END:
            break
        if code == LZW_CLEAR:
            width, table, last = 9, [bytes((i,)) for i in range(256)] + [b"", b""], b""
            continue
        if code < len(table):
            word = table[code]
        elif last and code == len(table):
            word = last + last[:1]
        else:
            raise ValueError("an LZW strip holds an unknown code")
        out += word
        if last:
            table.append(last + word[:1])
        last = word
        if len(table) + 1 in (512, 1024, 2048):
            width = (len(table) + 1).bit_length()
    return bytes(out)


def encoded(block: bytes, compression: int) -> bytes:
    if compression == RAW:
        return block
    if compression == PACKBITS:
        return packbits_encode(block)
    if compression == LZW:
        return lzw_encode(block)
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.compress(block, 1)
    raise ValueError(f"compression {compression} isn't known")


def decoded(block: bytes, compression: int, size: int) -> bytes:
    if compression == RAW:
        out = block
    elif compression == PACKBITS:
        out = packbits_decode(block, size)
    elif compression == LZW:
        out = lzw_decode(block, size)
    elif compression in (DEFLATE, OLD_DEFLATE):
        out = zlib.decompressobj().decompress(block, size)  # no more than the page needs
    else:
        raise ValueError(f"compression {compression} isn't known")
    if len(out) < size:
        raise ValueError("a strip or tile ends early")
    return out[:size]


def write_tiff(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, tile: int = 0, order: str = "<", strip_rows: int = STRIP_ROWS) -> bytes:
    """A file of grey 8-bit pages, in strips or, with ``tile``, in square tiles."""
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, 0))
    link = 4
    for page in pages:
        rows, width = page.shape
        if tile:
            down, across = -(-rows // tile), -(-width // tile)
            whole = np.zeros((down * tile, across * tile), np.uint8)
            whole[:rows, :width] = page
            blocks = [whole[y * tile : (y + 1) * tile, x * tile : (x + 1) * tile] for y in range(down) for x in range(across)]
        else:
            blocks = [page[y : y + strip_rows] for y in range(0, rows, strip_rows)]
        offsets, counts = [], []
        for block in blocks:
            if predictor == 2:
                block = np.diff(block, axis=1, prepend=np.zeros((block.shape[0], 1), np.uint8))
            data = encoded(block.tobytes(), compression)
            offsets.append(len(out))
            counts.append(len(data))
            out += data
        tags = [(IMAGE_WIDTH, 4, [width]), (IMAGE_LENGTH, 4, [rows]), (BITS, 3, [8]), (COMPRESSION, 3, [compression]), (PHOTOMETRIC, 3, [1]), (SAMPLES, 3, [1])]
        if tile:
            tags += [(TILE_WIDTH, 4, [tile]), (TILE_LENGTH, 4, [tile]), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, counts)]
        else:
            tags += [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, [strip_rows]), (STRIP_COUNTS, 4, counts)]
        if predictor != 1:
            tags.append((PREDICTOR, 3, [predictor]))
        entries = b""
        for tag, kind, values in sorted(tags):
            data = struct.pack(f"{order}{len(values)}{'H' if kind == 3 else 'I'}", *values)
            if len(data) > 4:
                out += b"\0" * (len(out) % 2)
                data, place = struct.pack(f"{order}I", len(out)), data
                out += place
            entries += struct.pack(f"{order}HHI", tag, kind, len(values)) + data.ljust(4, b"\0")
        out += b"\0" * (len(out) % 2)
        struct.pack_into(f"{order}I", out, link, len(out))
        out += struct.pack(f"{order}H", len(tags)) + entries
        link = len(out)
        out += bytes(4)
    return bytes(out)


def directories(data: bytes) -> Iterator[tuple[str, dict[int, list[int]]]]:
    """Byte order and integer tags of each image directory, along the chain."""
    order = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
    if order is None or len(data) < 8 or struct.unpack_from(f"{order}H", data, 2)[0] != 42:
        raise ValueError("this isn't a TIFF file")
    at, seen = struct.unpack_from(f"{order}I", data, 4)[0], set()
    while at:
        if at in seen or at + 2 > len(data):
            raise ValueError("the chain of directories is broken")
        seen.add(at)
        n, tags = struct.unpack_from(f"{order}H", data, at)[0], {}
        if at + 6 + 12 * n > len(data):
            raise ValueError("a directory ends early")
        for i in range(n):
            entry = at + 2 + 12 * i
            tag, kind, count = struct.unpack_from(f"{order}HHI", data, entry)
            size = TYPE_SIZES.get(kind, 1) * count
            place = entry + 8 if size <= 4 else struct.unpack_from(f"{order}I", data, entry + 8)[0]
            if place + size > len(data):
                raise ValueError("a tag's values lie outside the file")
            if kind in (1, 3, 4):
                tags[tag] = list(struct.unpack_from(f"{order}{count}{'?BxHI'[kind]}", data, place))
        yield order, tags
        at = struct.unpack_from(f"{order}I", data, at + 2 + 12 * n)[0]


def read_page(data: bytes, tags: dict[int, list[int]], order: str) -> np.ndarray:
    """Samples of one page: rows by columns, or by samples too if a pixel has several."""
    try:
        return _read_page(data, tags, order)
    except (KeyError, IndexError, struct.error, zlib.error, OverflowError) as e:
        raise ValueError(f"a page's directory or data is broken: {e!r}") from e


def _read_page(data: bytes, tags: dict[int, list[int]], order: str) -> np.ndarray:
    width, rows = tags[IMAGE_WIDTH][0], tags[IMAGE_LENGTH][0]
    if not width or not rows:
        raise ValueError("a page has no samples")
    compression, predictor = tags.get(COMPRESSION, [RAW])[0], tags.get(PREDICTOR, [1])[0]
    samples, bits = tags.get(SAMPLES, [1])[0], tags.get(BITS, [8])[0]
    if bits not in (8, 16):
        raise ValueError(f"samples of {bits} bits aren't known")
    kind = np.dtype(np.uint8 if bits == 8 else f"{order}u2")
    tiled = TILE_OFFSETS in tags
    across, down = (tags[TILE_WIDTH][0], tags[TILE_LENGTH][0]) if tiled else (width, min(rows, tags.get(ROWS_PER_STRIP, [rows])[0]))
    places = zip(tags[TILE_OFFSETS if tiled else STRIP_OFFSETS], tags[TILE_COUNTS if tiled else STRIP_COUNTS])
    if not 0 < across <= 1 << 20 or not 0 < down <= 1 << 31 or not samples:
        raise ValueError("a strip or tile has no samples, or too many")
    columns = -(-width // across)
    places = list(places)
    if len(places) < columns * -(-rows // down):
        raise ValueError("strips or tiles are missing")
    # deflate, the densest of the codes, makes 1,032 bytes of one; a page that claims more can't be in the file
    if rows * width * samples * kind.itemsize > 1032 * max(1, len(data)) or across * down * samples * kind.itemsize > 1032 * max(1, len(data)) + (1 << 20):
        raise ValueError("a page is larger than its file can hold")
    page = np.zeros((rows, width, samples), kind)
    for k, (at, n) in enumerate(places):
        y, x = k // columns * down, k % columns * across
        high = down if tiled else min(down, rows - y)
        block = np.frombuffer(decoded(data[at : at + n], compression, high * across * samples * kind.itemsize), kind).reshape(high, across, samples)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=kind.newbyteorder("="))
        elif predictor != 1:
            raise ValueError(f"predictor {predictor} isn't known")
        part = page[y : y + high, x : x + across]
        part[...] = block[: part.shape[0], : part.shape[1]]
    return page[:, :, 0] if samples == 1 else page


def read_pages(data: bytes) -> list[np.ndarray]:
    return [read_page(data, tags, order) for order, tags in directories(data)]


def padded(raw: bytes) -> bytes:
    """``raw`` and zeros up to a positive multiple of the page width."""
    return raw + bytes(-len(raw) % WIDTH if raw else WIDTH)


def stored(payload: bytes) -> bytes:
    """The payload as a file of pages, its samples deflated behind a row predictor."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    return write_tiff([image[y : y + PAGE_ROWS] for y in range(0, len(image), PAGE_ROWS)], DEFLATE, 2)


def feature_of(pages: list[np.ndarray]) -> str:
    """Pages, rows, sum, range, distinct levels and the sum of row steps: integers only."""
    levels = sum(np.bincount(p.reshape(-1), minlength=256) for p in pages)
    used = np.flatnonzero(levels)
    steps = sum(int(np.abs(np.diff(p.astype(np.int16), axis=1)).sum()) for p in pages)
    return f"pages={len(pages)};rows={sum(p.shape[0] for p in pages)};sum={int((levels * np.arange(256)).sum())};min={used[0]};max={used[-1]};levels={len(used)};steps={steps}"


MEDIA_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in MEDIA_SCHEMA.split(", ")]
    kinds = [pa.string() if x.endswith("string") else pa.int64() for x in MEDIA_SCHEMA.split(", ")]
    for batch in batches:
        rows = []
        for text in batch.column(1):
            raw = (text.as_py() or "").encode()
            media = stored(padded(raw))
            pages = read_pages(media)
            back = b"".join(p.tobytes() for p in pages)
            rows.append((len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(pages)))
        columns = list(zip(*rows)) or [()] * 7
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds[1:]))], names=names)


def media_features(docs: DataFrame) -> DataFrame:
    """One row per document: its text stored as TIFF, read back, and what was read."""
    return narrow(docs, doc_id="doc_id", text="text").mapInArrow(media_batches, MEDIA_SCHEMA)


PAGE_SCHEMA = "media_id long, page int, height int, width int, samples binary, error string"


def page_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("media_id", pa.int64()), ("page", pa.int32()), ("height", pa.int32()), ("width", pa.int32()), ("samples", pa.binary()), ("error", pa.string())])
    for batch in batches:
        for media_id, media in zip(batch.column(0).to_pylist(), batch.column(1)):
            try:
                rows = [(media_id, i, p.shape[0], p.shape[1], p.tobytes(), None) for i, p in enumerate(read_pages(media.as_py() or b""))]
            except (ValueError, MemoryError) as e:
                rows = [(media_id, None, None, None, None, str(e) or "a page doesn't fit the memory")]
            columns = list(zip(*rows)) or [()] * len(schema)  # a file may have no page
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def decode_pages(media: DataFrame, media_id: str = "media_id", content: str = "content") -> DataFrame:
    """One row per page of each TIFF file in the binary column ``content``."""
    return narrow(media, media_id=media_id, content=content).mapInArrow(page_batches, PAGE_SCHEMA)
