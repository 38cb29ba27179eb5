"""Zip archives of JSON records as a splittable source.

An archive is first listed (its central directory only, once) and cut into runs of members of about
``chunk_bytes`` compressed bytes; a run carries where its members lie, and is then read by its own
task, with random access and without the directory. So one archive that holds a large share of the
data is still read by many tasks, and its directory by one.
"""

from __future__ import annotations

import bz2
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHUNK_BYTES = 64 << 20
RUN_MEMBERS = 20_000  # of a run at most, as a run carries a row for each
BATCH_CHARS = 8 << 20
MEMBER_SCHEMA = "source_zip string, path string, ord long, file_name string, raw string, error string"


# Spark's names for file systems that Arrow knows by another, and those it knows as they are.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gcs", "s3": "s3", "hdfs": "hdfs",
           "viewfs": "viewfs", "abfs": "abfs", "abfss": "abfss"}


def arrow_uri(path: str) -> str:
    """The path under Arrow's name of its scheme; an unknown scheme is an error, not a reject."""
    scheme, colon, rest = path.partition(":")
    if scheme not in SCHEMES:
        raise ValueError(f"no random access to {scheme}: paths: {path}")
    return SCHEMES[scheme] + colon + rest


def _open(path: str):
    """Random-access file on whatever file system the path names."""
    from pyarrow import fs

    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(parsed.path) if parsed.scheme else path)
    system, inner = fs.FileSystem.from_uri(arrow_uri(path))
    return system.open_input_file(inner)


def _members(handle) -> list[zipfile.ZipInfo]:
    from pyarrow.lib import ArrowInvalid

    try:
        with zipfile.ZipFile(handle) as archive:
            return archive.infolist()
    except ArrowInvalid as problem:  # a seek before the start of a file too short to be an archive
        raise zipfile.BadZipFile(str(problem)) from problem


def _base_name(path: str) -> str:
    return unquote(path.rstrip("/").rsplit("/", 1)[-1])


RUN_SCHEMA = (
    "path string, lo long, error string, members array<struct<ord: long, file_name: string, "
    "offset: long, packed: long, size: long, method: int, crc: long>>"
)


def _runs(chunk_bytes: int):
    schema = to_arrow_schema(StructType.fromDDL(RUN_SCHEMA))

    def list_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    with _open(path) as handle:
                        infos = _members(handle)
                except zipfile.BadZipFile as problem:  # a broken archive becomes one reject row
                    row = {"path": path, "lo": -1, "error": repr(problem)[:500], "members": []}
                    yield pa.RecordBatch.from_pylist([row], schema)
                    continue
                run, size = [], 0
                for n, info in enumerate(infos):
                    size += info.compress_size
                    if info.filename.endswith(".json"):
                        encrypted = -1 if info.flag_bits & 1 else info.compress_type
                        run.append(
                            {
                                "ord": n, "file_name": info.filename, "offset": info.header_offset,
                                "packed": info.compress_size, "size": info.file_size, "method": encrypted,
                                "crc": info.CRC,
                            }
                        )
                    if run and (size >= chunk_bytes or len(run) >= RUN_MEMBERS or n == len(infos) - 1):
                        row = {"path": path, "lo": run[0]["ord"], "error": None, "members": run}
                        yield pa.RecordBatch.from_pylist([row], schema)
                        run, size = [], 0

    return list_runs


def _read_member(handle, member: dict) -> bytes:
    """A member's bytes by its place in the archive; its own header tells where they begin."""
    handle.seek(member["offset"])
    header = handle.read(30)
    if len(header) < 30 or header[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no header of a member where the directory puts one")
    names = int.from_bytes(header[26:28], "little") + int.from_bytes(header[28:30], "little")
    handle.seek(member["offset"] + 30 + names)
    packed = handle.read(member["packed"])
    if member["method"] == zipfile.ZIP_STORED:
        raw = packed
    elif member["method"] == zipfile.ZIP_DEFLATED:
        raw = zlib.decompress(packed, -15)
    elif member["method"] == zipfile.ZIP_BZIP2:
        raw = bz2.decompress(packed)
    else:
        raise NotImplementedError(f"compression or encryption of kind {member['method']}")
    if zlib.crc32(raw) != member["crc"] or len(raw) != member["size"]:
        raise zipfile.BadZipFile(f"bad checksum of {member['file_name']}")
    return raw


def _read_runs():
    schema = to_arrow_schema(StructType.fromDDL(MEMBER_SCHEMA))

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_path, handle = None, None
        for batch in batches:
            for run in batch.to_pylist():
                name, rows, held = _base_name(run["path"]), [], 0
                if run["lo"] < 0:
                    rows.append((name, run["path"], -1, None, None, run["error"]))
                elif run["path"] != held_path:
                    if handle is not None:
                        handle.close()
                    handle, held_path = _open(run["path"]), run["path"]
                for member in run["members"]:
                    raw = error = None
                    try:
                        # bytes that are not UTF-8 are dropped, as the lenient second parse does
                        raw = _read_member(handle, member).decode("utf-8", "ignore")
                        held += len(raw)
                    except Exception as problem:
                        error = repr(problem)[:500]
                    rows.append((name, run["path"], member["ord"], member["file_name"], raw, error))
                    if held >= BATCH_CHARS:
                        yield made(rows)
                        rows, held = [], 0
                if rows:
                    yield made(rows)
        if handle is not None:
            handle.close()

    return read


def scan_zip_json(spark: SparkSession, glob: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Every ``.json`` member of every archive: ``(source_zip, path, ord, file_name, raw, error)``.

    ``ord`` is the member's place in its archive. Base names may repeat, so
    ``(source_zip, path, ord)`` is the key. A member that cannot be read, or an archive that is no zip
    file, gives a row with ``error`` set and no ``raw``; a path that cannot be opened is an error.
    """
    archives = spark.read.format("binaryFile").load(glob).select("path", "length")
    total = archives.agg(F.sum("length")).first()[0] or 0  # from the file listing
    tasks = max(spark.sparkContext.defaultParallelism, total // chunk_bytes + 1)
    runs = archives.select("path").mapInArrow(_runs(chunk_bytes), RUN_SCHEMA)
    return runs.repartition(int(tasks), "path", "lo").mapInArrow(_read_runs(), MEMBER_SCHEMA)
