"""Trip files: CSV, archives of CSV, and the layout that is not read, as one data source.

The driver lists names and sizes, nothing else. A task reads each of its files' own header, so files of any layout are one scan and
one job however many they are; a file whose header lacks ``ride_id`` gives no rows. Small files share a task; a CSV larger than
``RANGE`` is read by several, from line to line. An archive is unpacked as it streams by, and stands in only where no CSV of its name
is. What a task holds is a block of ``BLOCK`` bytes. Rows with another number of fields than their header are not read.
"""

from __future__ import annotations

import csv as plain_csv
import io
import json
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import csv, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

TRIPS = T.StructType([
    *(T.StructField(c, T.StringType()) for c in ("ride_id", "rideable_type")),
    *(T.StructField(c, T.TimestampNTZType()) for c in ("started_at", "ended_at")),
    *(T.StructField(c, T.StringType()) for c in ("start_station_name", "start_station_id", "end_station_name", "end_station_id")),
    *(T.StructField(c, T.DoubleType()) for c in ("start_lat", "start_lng", "end_lat", "end_lng")),
    T.StructField("member_casual", T.StringType()),
])

#: Bytes of a CSV that a task reads, and of a block of it.
RANGE, BLOCK = 128 << 20, 1 << 20
#: Files that share a task, at the most.
TOGETHER = 500


def list_files(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int]]:
    """Name and size of each .csv and .zip that the patterns or folders hold; archives with a CSV of their name are left out."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found: dict[str, int] = {}
    for pattern in [path] if isinstance(path, str) else path:
        place = jvm.org.apache.hadoop.fs.Path(pattern)
        system = place.getFileSystem(conf)
        for status in system.globStatus(place) or []:
            for one in system.listStatus(status.getPath()) if status.isDirectory() else [status]:
                name = one.getPath().toString()
                if one.isFile() and name.lower().endswith((".csv", ".zip")):
                    found[name] = one.getLen()
    stem = lambda name: name.rsplit("/", 1)[1].rsplit(".", 1)[0]
    plain = {stem(n) for n in found if n.lower().endswith(".csv")}
    return sorted((n, size) for n, size in found.items() if n.lower().endswith(".csv") or stem(n) not in plain)


@dataclass
class Part(InputPartition):
    """Files, or ranges of files, that a task reads: name, first byte, byte after the last."""

    ranges: list[tuple[str, int, int]]


def parts(files: list[tuple[str, int]], size: int = RANGE) -> list[Part]:
    """Ranges of about ``size`` bytes; archives are whole."""
    out: list[Part] = []
    held, room = [], size
    for name, length in files:
        if name.lower().endswith(".csv") and length > size:
            out += [Part([(name, a, min(length, a + size))]) for a in range(0, length, size)]
            continue
        if held and (length > room or len(held) == TOGETHER):
            out.append(Part(held))
            held, room = [], size
        held.append((name, 0, length))
        room -= length
    return [*out, *([Part(held)] if held else [])]


def open_file(name: str) -> pa.NativeFile:
    where = urlparse(name)
    if where.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(where.path))
    system, path = fs.FileSystem.from_uri(name)
    return system.open_input_file(path)


class _Lines(io.RawIOBase):
    """The lines of a file that begin at one of the bytes start to end - 1, as a stream of their own."""

    def __init__(self, file: pa.NativeFile, start: int, end: int):
        self.file, self.at, self.end = file, start, end
        self.ended = start >= end
        file.seek(start)

    def readable(self) -> bool:
        return True

    def readinto(self, into: memoryview) -> int:
        if self.ended:
            return 0
        got = self.file.read(len(into))
        last = self.at + len(got) - self.end  # bytes past the end
        if last >= 0 and got:
            cut = got.find(b"\n", len(got) - last - 1)  # a line that begins before the end goes on to its own
            if cut >= 0:
                got, self.ended = got[: cut + 1], True
        self.at += len(got)
        self.ended |= not got
        into[: len(got)] = got
        return len(got)


def _header(line: bytes) -> list[str]:
    return [c.strip() for c in next(plain_csv.reader([line.decode("utf-8-sig", "replace")]), [])]


def _rows(stream: io.BufferedReader, names: list[str]) -> Iterator[pa.RecordBatch]:
    if "ride_id" not in names or not stream.peek(1):
        return
    own = [f.name for f in TRIPS]
    convert = csv.ConvertOptions(column_types=dict.fromkeys(own, pa.string()), include_columns=own, include_missing_columns=True, strings_can_be_null=True)
    reader = csv.open_csv(stream, csv.ReadOptions(column_names=names, block_size=BLOCK), csv.ParseOptions(invalid_row_handler=lambda row: "skip"), convert)
    yield from reader


def read_range(name: str, start: int, end: int) -> Iterator[pa.RecordBatch]:
    """The rows of a file's range, all columns as text."""
    with open_file(name) as file:
        if name.lower().endswith(".zip"):
            with zipfile.ZipFile(file) as archive:
                inner = next((n for n in archive.namelist() if n.endswith(".csv") and not n.startswith("__MACOSX")), None)
                if inner is not None:
                    with archive.open(inner) as member:
                        stream = io.BufferedReader(member, BLOCK)
                        yield from _rows(stream, _header(stream.readline()))
            return
        head = io.BufferedReader(_Lines(file, 0, 1)).readline()
        start = max(start, len(head))
        if start > len(head):  # the line that is under way belongs to the range before
            file.seek(start - 1)
            start += len(io.BufferedReader(_Lines(file, start - 1, start)).readline()) - 1
        yield from _rows(io.BufferedReader(_Lines(file, start, end), BLOCK), _header(head))


class TripReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files

    def partitions(self) -> list[Part]:
        return parts(self.files)

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        for name, start, end in partition.ranges:
            yield from read_range(name, start, end)


class TripFiles(DataSource):
    """Option ``files``: names and sizes, as JSON."""

    @classmethod
    def name(cls) -> str:
        return "trip_files"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType()) for f in TRIPS])

    def reader(self, schema: T.StructType) -> TripReader:
        return TripReader([tuple(f) for f in json.loads(self.options["files"])])


def read_trips(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The trips of all files; what a file lacks, or what doesn't read as its type, is null."""
    files = list_files(spark, path)
    if not files:
        return spark.createDataFrame([], TRIPS)
    spark.dataSource.register(TripFiles)
    raw = spark.read.format(TripFiles.name()).option("files", json.dumps(files)).load()
    return raw.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in TRIPS))
