"""Zip archives of manifest documents, from any store Spark can read.

An archive becomes one header row (`entry_index` null) and one row per entry. A header row says
whether the archive could be read; an unreadable one has no entry rows at all.

Spark lists and opens the files. The task that reads an archive walks its entries from the front, as they were written, so an
archive that has lost its directory at the end still gives them. It is opened once, and taken whole or not at all.

Archives above WHOLE bytes would make rows too large; where Arrow can open them too, their content is in no row. A task reads
the directory and names ranges of entries, the ranges are spread over tasks, and each reads its own bytes only.

Spark lists a folder in the driver's memory and plans a few files a task. So a folder of more than MANY files is listed by tasks where
Arrow can do it, and its archives, like those of a bounded list of local files, are opened by path, many in a task.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.session import exists, fresh_path
from landfall.sources.listing import OPENED_BY_PATH, filesystem, has_more_than, listable, listed_files, local_files
from landfall.sources.tables import written

ARCHIVE_ROW = (
    "zip_file_name string, zip_ok boolean, entry_index bigint, json_file_name string, "
    "occurrence bigint, content string"
)
_COLUMNS = pa.schema(
    [
        ("zip_file_name", pa.string()), ("zip_ok", pa.bool_()), ("entry_index", pa.int64()),
        ("json_file_name", pa.string()), ("occurrence", pa.int64()), ("content", pa.string()),
    ]
)
_RANGE_ROW = "zip_file_name string, path string, range_no bigint, ranges bigint, first_entry bigint, past_entry bigint, zip_ok boolean"
_RANGE_COLUMNS = ["zip_file_name", "path", "range_no", "ranges", "first_entry", "past_entry", "zip_ok"]
# Unpacked bytes of the entries that are handed on at once, and packed bytes of an archive that comes as a row.
PIECE, WHOLE = 16 * 1024 * 1024, 128 * 1024 * 1024
CHUNK = 64 * 1024
# Files of a folder that Spark may list, and the bytes that opening one by its path counts for.
MANY, OPENING = 10_000, 16 * 1024
# Fixed values of the format: what an entry and the record after it begin with, and the most bytes a cell can hold.
ENTRY_SIGNATURE, RECORD_SIGNATURE = b"PK\x03\x04", b"PK\x07\x08"
CELL = 2**31 - 1


class Damaged(Exception):
    """The archive cannot be read."""


def open_file(path: str) -> BinaryIO:
    files, inside = filesystem(path)
    return files.open_input_file(inside)


def _name() -> Column:
    """The file's name; the metadata give it as part of an URI."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _scan(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """zip_file_name, path, length, by_path (too long for a row, to be opened by its path) and content of each file.

    All but path and content are metadata: what is filtered by them is dropped before it is opened. A file that
    is gone or cannot be read gives no row.
    """
    options = {"recursiveFileLookup": "true", "ignoreMissingFiles": "true", "ignoreCorruptFiles": "true"}
    files = spark.read.format("binaryFile").options(**options).load(paths)
    by_path = (F.col("_metadata.file_size") > WHOLE) & F.col("_metadata.file_path").rlike(OPENED_BY_PATH)
    return files.select(
        _name().alias("zip_file_name"), "path", F.col("_metadata.file_size").alias("length"), by_path.alias("by_path"), "content"
    )


def archive_files(spark: SparkSession, path: str, after: str | None = None) -> DataFrame:
    """zip_file_name, path, length, by_path, content of each file of a folder. `after` keeps later names only. Content is read where it is used.

    All files of a folder of more than MANY that Arrow can list are by_path, and there is no content.
    """
    def later(files: DataFrame) -> DataFrame:
        return files if after is None else files.filter(F.col("zip_file_name") > after)

    root = listable(spark, path)
    if root is None or not has_more_than(spark, root, MANY):
        return later(_scan(spark, path))
    return written(later(listed_files(spark, root)), fresh_path(spark, "listing")).withColumn("by_path", F.lit(True))


def archives_at(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The same of the files of a bounded list; those that are gone are left out. Local files are by_path, without content."""
    if paths:
        files = local_files(spark, paths)
        if files is not None:
            return files.withColumn("by_path", F.lit(True))
        try:
            return _scan(spark, [_no_pattern(path) for path in paths])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        left = [path for path in paths if exists(spark, path)]
        if left:
            return _scan(spark, [_no_pattern(path) for path in left])
    return spark.createDataFrame([], "zip_file_name string, path string, length long, by_path boolean, content binary")


def _no_pattern(path: str) -> str:
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def archive_stream(spark: SparkSession, path: str, files_per_batch: int, **options) -> DataFrame:
    """Every file once, as names, paths and lengths. Options go to the file source: with many old files, `cleanSource` or
    `maxFileAge` keeps the listing of each batch short."""
    return (
        spark.readStream.format("binaryFile")
        .options(**options)
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select(_name().alias("zip_file_name"), "path", "length")
    )


# --- from the front ---------------------------------------------------------------------------------

def _exactly(file: BinaryIO, n: int) -> bytes:
    data = file.read(n)
    if len(data) < n:
        raise Damaged("it ends inside an entry")
    return data


def _inflated(file: BinaryIO, packed: int | None) -> tuple[bytes, int]:
    """Content of a deflated entry, and the bytes it took; with `packed` unknown it ends where the deflated data do."""
    start, inflater, parts, size = file.tell(), zlib.decompressobj(-zlib.MAX_WBITS), [], 0
    while not inflater.eof:
        room = CHUNK if packed is None else min(CHUNK, packed - (file.tell() - start))
        chunk = file.read(room) if room > 0 else b""
        if not chunk:
            raise Damaged("it ends inside an entry")
        parts.append(inflater.decompress(chunk))
        size += len(parts[-1])
        if size > CELL:
            raise Damaged("an entry is longer than a cell can be")
    end = file.tell() - len(inflater.unused_data)
    file.seek(end)
    return b"".join(parts), end - start


def _record_matches(file: BinaryIO, found: tuple[int, int, int]) -> bool:
    """Goes past the record after an entry that says what was found: with or without its signature, with short or long sizes."""
    start = file.tell()
    data = file.read(24)
    for signature in (RECORD_SIGNATURE, b""):
        for numbers in ("<III", "<IQQ"):
            past = len(signature) + struct.calcsize(numbers)
            if data.startswith(signature) and len(data) >= past and struct.unpack_from(numbers, data, len(signature)) == found:
                file.seek(start + past)
                return True
    return False


def _long_sizes(extra: bytes, size: int, packed: int) -> tuple[int, int]:
    """Sizes that do not fit 32 bits stand in the extra field 1, in this order."""
    at, most = 0, 0xFFFFFFFF
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = [value for (value,) in struct.iter_unpack("<Q", extra[at + 4 : at + 4 + length // 8 * 8])]
            size = values.pop(0) if size == most and values else size
            packed = values.pop(0) if packed == most and values else packed
        at += 4 + length
    return size, packed


def walk(file: BinaryIO) -> Iterator[tuple[str, bytes]]:
    """Names and contents of the entries from the front of an archive, up to what is no entry: the directory, or the end.

    Content that does not begin like an archive has none. An entry that is cut off, encrypted, packed in another way
    than by deflation, or differs from its sizes or checksum makes the archive `Damaged`.
    """
    while True:
        header = file.read(30)
        if not header.startswith(ENTRY_SIGNATURE):
            return
        if len(header) < 30:
            raise Damaged("it ends inside an entry")
        flags, method, crc, packed, size, name_length, extra_length = struct.unpack("<6xHH4xIIIHH", header)
        name = _exactly(file, name_length).decode("utf-8")
        size, packed = _long_sizes(_exactly(file, extra_length), size, packed)
        recorded_after = bool(flags & 8)
        if flags & 1 or method not in (0, 8) or (method == 0 and recorded_after):
            raise Damaged("an entry is packed in a way that is not known")
        if method == 8:
            content, used = _inflated(file, None if recorded_after else packed)
        elif packed > CELL:
            raise Damaged("an entry is longer than a cell can be")
        else:
            content, used = _exactly(file, packed), packed
        found = (zlib.crc32(content), used, len(content))
        if not (_record_matches(file, found) if recorded_after else found == (crc, packed, size)):
            raise Damaged("an entry differs from its checksum")
        yield name, content


def _batch(rows: list[tuple], columns: pa.Schema = _COLUMNS) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(columns)], schema=columns)


def _header(name: str, ok: bool) -> tuple:
    return name, ok, None, None, None, None


def _pieces(name: str, file: BinaryIO) -> Iterator[list[tuple]]:
    """Rows of the entries, about PIECE unpacked bytes at a time."""
    rows, held, seen = [], 0, {}
    for at, (entry, content) in enumerate(walk(file)):
        seen[entry] = seen.get(entry, 0) + 1
        rows.append((name, True, at, entry, seen[entry], content.decode("utf-8", "replace")))
        held += len(content)
        if held > PIECE:
            yield rows
            rows, held = [], 0
    yield rows


def _readable(pieces: Iterator[list[tuple]]) -> tuple[bool, list[tuple] | None]:
    """Whether all can be read, and the rows if they are no more than a piece. Running out of memory is not the archive's fault."""
    first, more = None, False
    try:
        for rows in pieces:
            first, more = (rows, False) if first is None else (None, True)
            if more:
                for _ in pieces:
                    pass
    except MemoryError:
        raise
    except Exception:
        return False, None
    return True, None if more else first


# --- by ranges of entries ---------------------------------------------------------------------------

def _opened(file: BinaryIO) -> tuple[zipfile.ZipFile | None, list[zipfile.ZipInfo]]:
    """The archive and its entries in order; nothing for content that does not begin like one."""
    start = file.read(len(ENTRY_SIGNATURE))
    file.seek(0)
    if start != ENTRY_SIGNATURE:
        return None, []
    archive = zipfile.ZipFile(file, metadata_encoding="utf-8")
    infos = sorted(archive.infolist(), key=lambda info: info.header_offset)
    if any(info.file_size > CELL for info in infos):
        raise Damaged("an entry is longer than a cell can be")
    return archive, infos


def _cut(infos: list[zipfile.ZipInfo]) -> list[tuple[int, int]]:
    """Ranges of entries of about PIECE unpacked bytes, one entry at least."""
    ranges, first, held = [], 0, 0
    for at, info in enumerate(infos):
        if held and held + info.file_size > PIECE:
            ranges.append((first, at))
            first, held = at, 0
        held += info.file_size
    return [*ranges, (first, len(infos))]


def _rows(name: str, archive: zipfile.ZipFile | None, infos: list[zipfile.ZipInfo], first: int, past: int) -> list[tuple]:
    """Rows of the entries of a range; reading one checks its sum."""
    seen: dict[str, int] = {}
    for info in infos[:first]:
        seen[info.filename] = seen.get(info.filename, 0) + 1
    out = []
    for at in range(first, past):
        info = infos[at]
        seen[info.filename] = seen.get(info.filename, 0) + 1
        out.append((name, True, at, info.filename, seen[info.filename], archive.read(info).decode("utf-8", "replace")))
    return out


def _list_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of entries; an archive without its directory is one range, of which only the front is known."""
    types = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.bool_()]
    for batch in batches:
        rows = []
        for name, path in zip(batch.column("zip_file_name").to_pylist(), batch.column("path").to_pylist()):
            try:
                with open_file(path) as file:
                    try:
                        found = _cut(_opened(file)[1])
                    except (zipfile.BadZipFile, Damaged):
                        found = [(0, -1)]
                rows += [(name, path, number, len(found), first, past, True) for number, (first, past) in enumerate(found)]
            except MemoryError:
                raise
            except Exception:
                rows.append((name, path, 0, 1, 0, 0, False))
        yield _batch(rows, pa.schema(list(zip(_RANGE_COLUMNS, types))))


def _range_pieces(row: dict) -> Iterator[list[tuple]]:
    if not row["zip_ok"]:
        raise Damaged("it cannot be opened")
    with open_file(row["path"]) as file:
        if row["past_entry"] < 0:
            yield from _pieces(row["zip_file_name"], file)
        else:
            yield _rows(row["zip_file_name"], *_opened(file), row["first_entry"], row["past_entry"])


def _check_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        broken = [row["path"] for row in batch.to_pylist() if not _readable(_range_pieces(row))[0]]
        yield pa.RecordBatch.from_arrays([pa.array(broken, pa.string())], ["broken"])


def _bytes_at(path: str) -> pa.Buffer | None:
    """Content of a file; None if it cannot be opened."""
    try:
        with open_file(path) as file:
            return file.read_buffer()
    except MemoryError:
        raise
    except Exception:
        return None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives whose bytes are in the rows, archives opened by path, and ranges of long ones. What unpacks to more than a piece is
    checked whole before a row is handed on."""
    rows, held = [], 0
    for batch in batches:
        names, contents = batch.column("zip_file_name").to_pylist(), batch.column("content")
        ranges = batch.drop_columns(["content"]).to_pylist()
        for at, name in enumerate(names):
            if ranges[at]["range_no"] is not None:
                yield _batch(rows)
                rows, held = [], 0
                if ranges[at]["range_no"] == 0:
                    yield _batch([_header(name, not ranges[at]["broken"])])
                if not ranges[at]["broken"]:
                    yield from map(_batch, _range_pieces(ranges[at]))
                continue
            content = contents[at].as_buffer() if ranges[at]["path"] is None else _bytes_at(ranges[at]["path"])
            ok, found = (False, None) if content is None else _readable(_pieces(name, pa.BufferReader(content)))
            rows.append(_header(name, ok))
            rows += found or []
            held += sum(len(row[5]) for row in found or [])
            if held > PIECE or (ok and found is None):
                yield _batch(rows)
                rows, held = [], 0
            if ok and found is None:
                yield from map(_batch, _pieces(name, pa.BufferReader(content)))
    yield _batch(rows)


def _checked_ranges(files: DataFrame) -> DataFrame:
    """All ranges of an archive are checked before one is handed on, since one may fail while others are done."""
    spread = files.select("zip_file_name", "path").mapInArrow(_list_ranges, _RANGE_ROW).repartition("path", "range_no")
    broken = spread.mapInArrow(_check_ranges, "broken string").distinct()
    return spread.join(broken, F.col("path") == F.col("broken"), "left").withColumn("content", F.lit(None).cast("binary"))


def _spread(files: DataFrame) -> DataFrame:
    """Files dealt to tasks by their lengths, many small ones to each."""
    size = files.agg(F.coalesce(F.sum(F.col("length") + OPENING), F.lit(0))).first()[0]
    a_task = files.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return files.select("zip_file_name", "path").repartition(max(1, -(-size // a_task)), "path")


def archive_rows(files: DataFrame) -> DataFrame:
    """Header and entry rows of `files`: zip_file_name with content, or with a path that Arrow can open, or what `archive_files` gives."""
    if "by_path" not in files.columns:
        parts = [files.select("zip_file_name", "content") if "content" in files.columns else _checked_ranges(files)]
    elif "content" in files.columns:
        parts = [files.filter(~F.col("by_path")).select("zip_file_name", "content"), _checked_ranges(files.filter("by_path"))]
    else:
        parts = [_spread(files.filter(F.col("length") <= WHOLE)), _checked_ranges(files.filter(F.col("length") > WHOLE))]
    every = files.sparkSession.createDataFrame([], _RANGE_ROW + ", broken string, content binary")
    for part in parts:
        every = every.unionByName(part, allowMissingColumns=True)
    return every.mapInArrow(_read, ARCHIVE_ROW)


def unreadable_headers(archives: DataFrame) -> DataFrame:
    return archives.select("zip_file_name", F.lit(False).alias("zip_ok"))
