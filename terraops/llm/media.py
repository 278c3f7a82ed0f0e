"""Texts as lossless 8-bit grey PNG images in binary columns, and cosine-transform hashes of what is read back.

The bytes of a text, padded with zeros to a positive multiple of 64, are the samples of an image 64 wide.
Each row has the one of five filters that leaves the least. Chunks carry their checksums, which the reader tests; the
filters are undone with numpy.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraops.llm.common import slices, texts_of, written

WIDTH, LEVEL = 64, 6
#: Characters or bytes that a task filters at once; a longer text is a portion of its own.
AT_ONCE = 500_000
#: Fixed: the signature of PNG files.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
SIDE, KEEP = 32, 8
_COSINES = np.cos(np.pi / SIDE * (np.arange(SIDE) + 0.5)[None, :] * np.arange(KEEP)[:, None])


def padded(text: bytes) -> bytes:
    return text + bytes(-len(text) % WIDTH or (0 if text else WIDTH))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def _neighbours(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The samples to the left, above and above to the left of each; zero outside an image, whose first rows are first."""
    above = np.zeros_like(rows)
    above[1:] = rows[:-1]
    above[first] = 0
    left, corner = np.zeros_like(rows), np.zeros_like(rows)
    left[:, 1:], corner[:, 1:] = rows[:, :-1], above[:, :-1]
    return left, above, corner


def _nearest(left: np.ndarray, above: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """Of the three samples the one nearest to left + above - corner; ties go to the earlier one."""
    a, b = np.abs(above - corner), np.abs(left - corner)
    c = np.abs(left + above - 2 * corner)
    return np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))


def filtered(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows of images, one image after another, each led by its filter: of the five the one of the least sum of sizes.

    A size is that of the difference as a signed byte; this is the usual choice for rows of grey samples.
    """
    wide = rows.astype(np.int16)
    left, above, corner = _neighbours(wide, first)
    out = np.empty((len(rows), rows.shape[1] + 1), np.uint8)
    best = None
    for kind, guess in enumerate((0, left, above, (left + above) // 2, _nearest(left, above, corner))):
        line = (wide - guess).astype(np.uint8)
        size = np.abs(line.view(np.int8).astype(np.int16)).sum(1, dtype=np.int64)
        less = np.ones(len(rows), bool) if best is None else size < best
        out[less, 0], out[less, 1:] = kind, line[less]
        best = size if best is None else np.minimum(best, size)
    return out


def write_pngs(payloads: list[bytes]) -> list[bytes]:
    """An image of each payload's bytes, its rows filtered one by one."""
    if not payloads:
        return []
    heights = np.array([len(p) // WIDTH for p in payloads])
    ends = np.cumsum(heights)
    lines = filtered(np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, WIDTH), ends - heights)
    out = []
    for n, end in zip(heights.tolist(), ends.tolist(), strict=True):
        head = struct.pack(">IIBBBBB", WIDTH, n, 8, 0, 0, 0, 0)
        out.append(SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines[end - n : end].tobytes(), LEVEL)) + _chunk(b"IEND", b""))
    return out


def write_png(payload: bytes) -> bytes:
    return write_pngs([payload])[0]


def unfilter(lines: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """Samples of 8-bit grey rows of equal width, each led by its filter; first are the first rows of the images.

    Rows without a filter, or one that looks to the left alone, are undone at once. The others wait for the row
    above: they are undone along diagonals, every sample of all images whose neighbours are known in one step.
    """
    kinds, rows = lines[:, 0], lines[:, 1:]
    if len(kinds) and kinds.max() > 4:
        raise ValueError(f"filter {kinds.max()} is unknown")
    n, width = rows.shape
    starts = np.zeros(n, bool)
    starts[[0] if first is None else first] = True
    out = np.zeros((n + 1, width + 1), np.int16)  # the last row and the first column stay zero
    out[:-1, 1:] = rows
    side = kinds == 1
    out[:-1, 1:][side] = np.cumsum(rows[side], 1, dtype=np.uint8)
    late = np.flatnonzero(kinds > 1)
    if not len(late):
        return out[:-1, 1:].astype(np.uint8)
    ready = np.where((kinds <= 1) | starts, np.arange(n), -1)
    depth = (np.arange(n) - np.maximum.accumulate(ready))[late]  # rows that have to be undone before
    order = np.argsort(depth, kind="stable")
    late, depth = late[order], depth[order]
    above, kind = np.where(starts[late], n, late - 1), kinds[late]
    for step in range(int(depth[-1]) + width):
        lo, hi = np.searchsorted(depth, [step - width + 1, step + 1])
        if lo == hi:
            continue
        r, u, k, c = late[lo:hi], above[lo:hi], kind[lo:hi], step - depth[lo:hi]
        left, up, corner = out[r, c], out[u, c + 1], out[u, c]
        guess = np.where(k == 2, up, np.where(k == 3, (left + up) // 2, _nearest(left, up, corner)))
        out[r, c + 1] = (out[r, c + 1] + guess) & 255
    return out[:-1, 1:].astype(np.uint8)


def png_lines(data: bytes) -> np.ndarray:
    """The filtered rows of an 8-bit grey image; ValueError if a chunk's checksum or length or the image is wrong."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, size, body, ended = 8, None, [], False
    while at < len(data) and not ended:
        if len(data) < at + 12:
            raise ValueError("the file ends within a chunk")
        (n,) = struct.unpack_from(">I", data, at)
        kind, chunk = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if len(data) < at + 12 + n or struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(chunk, zlib.crc32(kind)):
            raise ValueError(f"chunk {kind!r} is damaged")
        if kind == b"IHDR" and n == 13:
            size = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"IDAT":
            body.append(chunk)
        elif kind == b"IEND":
            ended = True
        elif not kind[0] & 32:
            raise ValueError(f"chunk {kind!r} is unknown")
        at += 12 + n
    if size is None or not ended or size[2:] != (8, 0, 0, 0, 0) or not size[0] or not size[1]:
        raise ValueError("8-bit grey without interlace is asked for")
    try:
        lines = zlib.decompress(b"".join(body))
    except zlib.error as error:
        raise ValueError(str(error)) from error
    if len(lines) != size[1] * (size[0] + 1):
        raise ValueError("the image has too few or too many samples")
    lines = np.frombuffer(lines, np.uint8).reshape(size[1], size[0] + 1)
    if lines[:, 0].max() > 4:
        raise ValueError(f"filter {lines[:, 0].max()} is unknown")
    return lines


def read_pngs(images: list[bytes]) -> list[np.ndarray | ValueError]:
    """The samples of each image, or what is wrong with it; images of one width are undone together."""
    out: list = [None] * len(images)
    by_width: dict[int, list[tuple[int, np.ndarray]]] = {}
    for k, data in enumerate(images):
        try:
            lines = png_lines(data)
            by_width.setdefault(lines.shape[1], []).append((k, lines))
        except ValueError as error:
            out[k] = error
    for same in by_width.values():
        ends = np.cumsum([len(lines) for _, lines in same])
        firsts = np.append(0, ends[:-1])
        samples = unfilter(np.concatenate([lines for _, lines in same]), firsts)
        for (k, _), a, b in zip(same, firsts, ends, strict=True):
            out[k] = samples[a:b]
    return out


def read_png(data: bytes) -> np.ndarray:
    """Samples of an 8-bit grey image; ValueError if it is damaged."""
    (found,) = read_pngs([data])
    if isinstance(found, ValueError):
        raise found
    return found


def cosine_hash(samples: np.ndarray) -> str:
    """16 hex digits: which of 63 low frequencies of the image, reduced to 32 x 32, lie above their median."""
    height, width = samples.shape
    sums = np.zeros((height, SIDE), np.float64)
    sums += samples.reshape(height, SIDE, width // SIDE).mean(2)
    edges = np.arange(SIDE) * height // SIDE
    small = np.add.reduceat(sums, edges, 0)  # an edge that is met twice gives that row alone
    small /= np.maximum(np.diff(np.append(edges, height)), 1)[:, None]
    low = np.round(_COSINES @ small @ _COSINES.T, 6).ravel()
    bits = low > np.median(low[1:])
    bits[0] = False
    return np.packbits(bits).tobytes().hex()


def media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each whole text (null: empty) as a PNG in a binary column."""

    @F.pandas_udf("binary")
    def store(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts, out = batch.tolist(), []
            for a, b in slices(texts, AT_ONCE):
                out += write_pngs([padded(text.encode()) for text in texts[a:b]])
            yield pd.Series(out, dtype=object)

    return texts_of(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), store("text").alias("media"))


def media_features(images: DataFrame) -> DataFrame:
    """images without their media, but with payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, error.

    All are computed from the samples that are read back. Equal images give equal values; a null image gives
    nulls; a damaged one gives what is wrong with it in error and nulls for all that needs its samples.
    """

    @F.pandas_udf("payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, images = [], batch.tolist()
            for a, b in slices([x or b"" for x in images], AT_ONCE):
                known = [x for x in images[a:b] if x is not None]
                found = iter(zip(known, read_pngs(known), strict=True))
                rows += [_row(*next(found)) if x is not None else (None,) * 7 for x in images[a:b]]
            out = pd.DataFrame(rows, columns=["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "error"])
            yield out.astype({c: "Int64" for c in ("payload_bytes", "tail_crc32", "media_bytes")})

    rest = [c for c in images.columns if c != "media"]
    return images.withColumn("read", read("media")).select(*rest, "read.*")


def _row(data: bytes, samples: np.ndarray | ValueError) -> tuple:
    own = (len(data), hashlib.sha256(data).hexdigest())
    if isinstance(samples, ValueError):
        return (None, None, None, *own, None, str(samples))
    payload = samples.tobytes()
    return (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), *own, cosine_hash(samples), None)


def text_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, error) of each row.

    The images are stored as a table with a binary column and read back from it. A null text counts as empty: 64
    zero bytes. Repeated rows give repeated results, a null doc_id is kept, other columns are ignored; an empty
    table gives no rows.
    """
    return media_features(written(media(docs), "media"))
