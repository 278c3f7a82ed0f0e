"""Members of zip archives."""

from __future__ import annotations

import io
import lzma
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEMBERS = "archive string, member string, content binary, error string"


def archives(spark: SparkSession, root: str) -> DataFrame:
    """(archive, content) of every .zip below root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(root)
    return files.selectExpr("path as archive", "content")


#: What reading a damaged archive can raise, depending on the byte that is wrong.
DAMAGE = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, OSError, ValueError, NotImplementedError, RuntimeError, struct.error, LookupError, OverflowError)


#: Most bytes of a member: a cell of Spark holds no more than twice this, and a small archive may inflate to any size.
MOST = 1 << 30
#: Bytes of small members that are handed on together; a larger one goes alone.
TOGETHER = 1 << 20


def members(zips: DataFrame, most: int = MOST) -> DataFrame:
    """(archive, member, content, error): one row per file in each archive.

    A member that cannot be read, or whose checksum is wrong, has its error in place of the content; an archive that
    cannot be opened gives one row with its error and no member. Each member is read once and handed on, so a
    task holds one archive and one member, or small ones of TOGETHER bytes; one that inflates to more than most bytes, whatever its header says, is an error.
    """

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for name, data in zip(*batch.columns, strict=True):  # out of Arrow one at a time
                for row in _expanded(data.as_py() or b"", most):
                    size = len(row["content"] or b"")
                    if rows and held + size > TOGETHER:
                        yield _record_batch(rows)
                        rows, held = [], 0
                    rows.append({"archive": name.as_py()} | row)
                    held += size + 1_024  # and what a row has besides
            if rows:
                yield _record_batch(rows)

    kinds = zips.select(F.col("archive").cast("string"), F.col("content").cast("binary"))
    return kinds.mapInArrow(expand, MEMBERS)


def _record_batch(rows: list[dict]) -> pa.RecordBatch:
    """rows, which it empties, as Arrow."""
    kinds = {"archive": pa.string(), "member": pa.string(), "content": pa.binary(), "error": pa.string()}
    columns = {c: pa.array([r[c] for r in rows], kind) for c, kind in kinds.items()}
    rows.clear()
    return pa.record_batch(columns)


def _expanded(data: bytes, most: int) -> Iterator[dict]:
    try:
        file = zipfile.ZipFile(io.BytesIO(data))
        listed = [info for info in file.infolist() if not info.is_dir()]
    except DAMAGE as error:
        yield {"member": None, "content": None, "error": f"{type(error).__name__}: {error}"}
        return
    for info in listed:
        row = {"member": info.filename.encode("utf-8", "replace").decode(), "content": None, "error": None}
        try:
            with file.open(info) as member:
                content = member.read(most + 1)  # to its end, where the checksum is tested, or a byte too far
            if len(content) > most:
                raise ValueError(f"more than {most} bytes")
            row["content"] = content
        except DAMAGE as error:
            row["error"] = f"{type(error).__name__}: {error}"
        yield row
