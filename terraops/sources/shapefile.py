"""Shapefiles of points, lines and polygons with their attribute tables.

A layer is read from the bytes of its .shp and .dbf files, which Spark's binaryFile source brings from any file
system, and decoded by slices of records; it is written as rows of file images, one or more sets of files for each partition.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraops import schemas

POINT, LINE, POLYGON = 1, 3, 5
KINDS = {"point": POINT, "line": LINE, "polygon": POLYGON}
#: Fixed: the text of a .prj file for EPSG:4326.
WGS84 = 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137,298.257223563]],PRIMEM["Greenwich",0],UNIT["Degree",0.017453292519943295]]'


def read_ordinates(data: bytes) -> list[tuple[list[list[float]] | None, list[list[float]] | None]]:
    """The z and m of each record's vertices, part by part; None where its shape has none."""
    out, at = [], 100
    while at + 12 <= len(data):
        (size,) = struct.unpack_from(">i", data, at + 4)
        (kind,) = struct.unpack_from("<i", data, at + 8)
        body, base, end = at + 12, kind % 10, at + 8 + 2 * size
        starts, first = [0, 1], body + 16  # of a point's vertex, and where its further ordinates begin
        if base == 8:
            (n,) = struct.unpack_from("<i", data, body + 32)
            starts, first = [*range(n + 1)], body + 36 + 16 * n
        elif base in (LINE, POLYGON):
            parts, n = struct.unpack_from("<2i", data, body + 32)
            starts, first = [*struct.unpack_from(f"<{parts}i", data, body + 40), n], body + 40 + 4 * parts + 16 * n
        found = []
        for _ in range(2 if 10 < kind < 20 else 1 if 20 < kind < 30 else 0):  # z shapes have z and may have m, m shapes m alone
            first += 16 if base != POINT else 0  # the range of values
            if first + 8 * starts[-1] > end:
                break
            values = np.frombuffer(data, "<f8", starts[-1], first).tolist()
            found.append([values[a:b] for a, b in zip(starts, starts[1:], strict=False)])
            first += 8 * starts[-1]
        out.append(((found + [None, None])[0], (found + [None, None])[1]) if kind < 20 else (None, (found + [None])[0]))
        at = end
    return out


def read_shapes(data: bytes) -> list[list[list[tuple[float, float]]]]:
    """Parts of each record, in order; a null shape has none. For z and m see read_ordinates."""
    out, at = [], 100
    while at + 12 <= len(data):
        (size,) = struct.unpack_from(">i", data, at + 4)
        (kind,) = struct.unpack_from("<i", data, at + 8)
        body, base = at + 12, kind % 10
        if kind == 0:
            out.append([])
        elif base == POINT:
            out.append([[struct.unpack_from("<2d", data, body)]])
        elif base == 8:
            (n,) = struct.unpack_from("<i", data, body + 32)
            out.append([[tuple(p)] for p in np.frombuffer(data, "<f8", 2 * n, body + 36).reshape(-1, 2).tolist()])
        elif base in (LINE, POLYGON):
            parts, n = struct.unpack_from("<2i", data, body + 32)
            starts = [*struct.unpack_from(f"<{parts}i", data, body + 40), n]
            points = [tuple(p) for p in np.frombuffer(data, "<f8", 2 * n, body + 40 + 4 * parts).reshape(-1, 2).tolist()]
            out.append([points[a:b] for a, b in zip(starts, starts[1:], strict=False)])
        else:
            raise ValueError(f"shape type {kind} is unknown")
        at += 8 + 2 * size
    return out


def read_attributes(data: bytes) -> tuple[list[str], list[list[str | None]]]:
    """Field names and the rows' texts; blank is null. Deleted rows are kept, so rows match shapes."""
    n, head, width = struct.unpack_from("<IHH", data, 4)
    names, sizes, at = [], [], 32
    while data[at] != 0x0D:
        names.append(data[at : at + 11].split(b"\0")[0].decode("latin-1"))
        sizes.append(data[at + 16])
        at += 32
    rows = []
    for k in range(n):
        at, row = head + k * width + 1, []
        for size in sizes:
            row.append(data[at : at + size].decode("utf-8", "replace").rstrip(" \0") or None)
            at += size
        rows.append(row)
    return names, rows


#: Records of a layer that one task decodes at a time.
RECORDS = 4_096


def _shape_slices(data: bytes, records: int) -> Iterator[bytes]:
    at = begin = 100
    n = 0
    while at + 12 <= len(data):
        at += 8 + 2 * struct.unpack_from(">i", data, at + 4)[0]
        n += 1
        if n == records:
            yield data[:100] + data[begin:at]
            begin, n = at, 0
    if n:
        yield data[:100] + data[begin:at]


def _attribute_slices(data: bytes, records: int) -> Iterator[bytes]:
    n, head, width = struct.unpack_from("<IHH", data, 4)
    for k in range(0, n, records):
        some = min(records, n - k)
        yield data[:4] + struct.pack("<I", some) + data[8:head] + data[head + k * width : head + (k + some) * width]


def layer(spark: SparkSession, path: str, ordinates: bool = False) -> DataFrame:
    """(layer, index, parts, attributes map<string,string>) of each record of the shapefiles at path; see decoded."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{shp,dbf}").option("recursiveFileLookup", True).load(path)
    return decoded(files.select(F.regexp_extract("path", r"^(.*)\.[^.]*$", 1).alias("layer"), F.regexp_extract("path", r"([^.]*)$", 1).alias("kind"), "content"), ordinates)


def decoded(files: DataFrame, ordinates: bool = False, records: int = RECORDS) -> DataFrame:
    """(layer, index, parts, attributes) of the records of rows (layer, kind shp or dbf, content).

    A file is one row, as Spark reads it; it is cut into slices of so many records without decoding them, and slices of
    shapes meet those of their attributes as a group, so the decoding of one layer is dealt over tasks. files are read
    once: what comes in another order each time, as rows of a shuffle do, would give shapes the attributes of others.
    With ordinates there are columns z and m, array<array<double>> beside parts, null where a shape has none. A record
    without a row of attributes has an empty map.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, kind, content in zip(batch.layer, batch.kind, batch.content, strict=True):
                slices = _shape_slices if kind == "shp" else _attribute_slices
                for k, part in enumerate(slices(content, records)):
                    yield pd.DataFrame({"layer": [name], "slice": [k], "kind": [kind], "part": [part]})

    def read(key: tuple[str, int], slices: pd.DataFrame) -> pd.DataFrame:
        (name, k), found = key, dict(zip(slices.kind, slices.part, strict=True))
        shapes = read_shapes(found["shp"]) if "shp" in found else []
        names, texts = read_attributes(found["dbf"]) if "dbf" in found else ([], [])
        rows = [dict(zip(names, row, strict=True)) for row in texts[: len(shapes)]] + [{}] * (len(shapes) - len(texts))
        out = {"layer": name, "index": range(k * records, k * records + len(shapes)), "parts": [[[{"x": x, "y": y} for x, y in part] for part in parts] for parts in shapes], "attributes": rows}
        if ordinates:
            values = read_ordinates(found["shp"]) if "shp" in found else []
            out["z"], out["m"] = ([v[c] for v in values] for c in (0, 1))
        return pd.DataFrame(out, dtype=object)  # columns without rows would be of floats

    cuts = files.where("kind in ('shp', 'dbf')").select("layer", "kind", "content").mapInPandas(cut, "layer string, slice int, kind string, part binary")
    more = ", z array<array<double>>, m array<array<double>>" * ordinates
    return cuts.groupBy("layer", "slice").applyInPandas(read, f"layer string, index int, parts {schemas.PARTS}, attributes map<string,string>{more}")


def vertices(shapes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, part, index, x, y) of each vertex of rows with parts."""
    rows = shapes.select(*keys, F.posexplode("parts").alias("part", "points"))
    return rows.select(*keys, "part", F.posexplode("points").alias("index", "p")).select(*keys, "part", "index", "p.x", "p.y")


def points(shapes: DataFrame) -> DataFrame:
    """shapes with x and y in place of parts; of several points the last counts."""
    last = F.try_element_at(F.flatten("parts"), F.lit(-1))
    return shapes.withColumn("x", last.x).withColumn("y", last.y).drop("parts")


def _box(points: np.ndarray) -> bytes:
    return struct.pack("<4d", *points.min(0), *points.max(0))


def _header(words: int, kind: int, points: np.ndarray) -> bytes:
    return struct.pack(">i20xi", 9994, words) + struct.pack("<2i", 1000, kind) + (_box(points) if len(points) else bytes(32)) + bytes(32)


def write_shapes(kind: int, shapes: list[list[np.ndarray]]) -> tuple[bytes, bytes]:
    """The bytes of a .shp and its .shx."""
    records, index, at = [], [], 50
    for k, parts in enumerate(shapes):
        every = np.concatenate(parts) if parts else np.empty((0, 2))
        if not len(every):
            body = struct.pack("<i", 0)
        elif kind == POINT:
            body = struct.pack("<i2d", kind, *every[-1])
        else:
            starts = np.cumsum([0, *map(len, parts)])[:-1]
            body = struct.pack("<i", kind) + _box(every) + struct.pack(f"<2i{len(parts)}i", len(parts), len(every), *starts) + every.astype("<f8").tobytes()
        records.append(struct.pack(">2i", k + 1, len(body) // 2) + body)
        index.append(struct.pack(">2i", at, len(body) // 2))
        at += len(records[-1]) // 2
    every = np.concatenate([p for parts in shapes for p in parts]) if any(map(len, shapes)) else np.empty((0, 2))
    return _header(at, kind, every) + b"".join(records), _header(50 + 4 * len(shapes), kind, every) + b"".join(index)


def write_attributes(frame: pd.DataFrame) -> bytes:
    """The bytes of a .dbf: whole numbers, decimals and texts of at most 254 bytes.

    Names have ten bytes and texts 254: longer ones are cut at a character; names that are then alike are an error.
    """
    fields, columns = b"", []
    whole = lambda text, n: text.encode()[:n].decode("utf-8", "ignore").encode()
    if len({whole(name, 10) for name in frame.columns}) < len(frame.columns):
        raise ValueError(f"names are alike in their first ten bytes: {list(frame.columns)}")
    for name in frame.columns:
        column = frame[name]
        kind, digits = ("N", 0) if pd.api.types.is_integer_dtype(column) else ("N", 8) if pd.api.types.is_float_dtype(column) else ("C", 0)
        cells = [b"" if pd.isna(v) else whole(f"{v:.8f}" if digits else str(v), 254) for v in column]
        width = max([1, *map(len, cells)])
        fields += struct.pack("<11sc4xBB14x", whole(name, 10), kind.encode(), width, digits)
        columns.append([c.rjust(width) if kind == "N" else c.ljust(width) for c in cells])
    width = 1 + sum(len(c[0]) if c else 1 for c in columns)
    head = struct.pack("<4BIHH20x", 3, 100, 1, 1, len(frame), 33 + 32 * len(columns), width)
    return head + fields + b"\r" + b"".join(b" " + b"".join(row) for row in zip(*columns, strict=True)) + b"\x1a"


#: Most records, and vertices unless one record has more, of a set of files that is written.
FILE_RECORDS, FILE_VERTICES = 1 << 16, 1 << 20


def encoded(df: DataFrame, kind: str, parts: str = "parts", name: str = "part", records: int = FILE_RECORDS, vertices: int = FILE_VERTICES) -> DataFrame:
    """(layer, kind, content): shp, shx, dbf and prj files of df's rows, whose other columns are attributes.

    A partition is written as one set of files, or as several, each of at most so many records and vertices; a task
    holds one set.
    """
    fields = [c for c in df.columns if c != parts]

    def files(shapes: list[list[np.ndarray]], frames: list[pd.DataFrame], k: int) -> pd.DataFrame:
        shp, shx = write_shapes(KINDS[kind], shapes)
        made = {"shp": shp, "shx": shx, "dbf": write_attributes(pd.concat(frames, ignore_index=True)), "prj": WGS84.encode()}
        layer = f"{name}-{TaskContext.get().partitionId():05d}" + f"-{k:05d}" * (k > 0)
        return pd.DataFrame({"layer": layer, "kind": list(made), "content": list(made.values())})

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes, frames, held, k = [], [], 0, 0
        for batch in batches:
            begin = 0
            for at, value in enumerate(batch[parts]):
                shape = [np.array([(p["x"], p["y"]) for p in part], float).reshape(-1, 2) for part in (value if value is not None else [])]
                n = sum(map(len, shape))
                if shapes and (len(shapes) == records or held + n > vertices):
                    yield files(shapes, [*frames, batch[fields].iloc[begin:at]], k)
                    shapes, frames, held, k, begin = [], [], 0, k + 1, at
                shapes.append(shape)
                held += n
            frames.append(batch[fields].iloc[begin:])
        if shapes:
            yield files(shapes, frames, k)

    return df.mapInPandas(write, "layer string, kind string, content binary")


def save(files: DataFrame, folder: str) -> None:
    """Writes rows (layer, kind, content) as files of a folder that all executors mount; each appears by a rename."""
    import os

    os.makedirs(folder, exist_ok=True)

    def put(rows) -> None:
        attempt = TaskContext.get().taskAttemptId()
        for row in rows:
            path = f"{folder}/{row['layer']}.{row['kind']}"
            with open(f"{path}.{attempt}", "wb") as file:
                file.write(row["content"])
            os.replace(f"{path}.{attempt}", path)

    files.foreachPartition(put)
