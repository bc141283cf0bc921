"""Registers as Spark data sources: dBASE tables and point shapes, each file read by several tasks.

    register(spark)
    spark.read.format("dbf").option("encoding", "latin-1").load("/data/*.dbf")
    spark.read.format("dbf").schema("NAME string, CAP double").load(path)   # only these columns are decoded
    spark.read.format("points").option("records", 100000).load("/data/dams.shp")

Both formats have records of one length, so a task seeks to its range of
records and reads no more. The paths have to be on a file system that the
driver and all executors mount.
"""

from __future__ import annotations

import glob
import struct
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

#: Records of a partition, unless the option ``records`` says otherwise.
RECORDS = 50_000
TYPES = {"C": StringType(), "D": StringType(), "N": DoubleType(), "F": DoubleType(), "I": LongType(), "L": StringType()}
POINT_KINDS = (0, 1, 11, 21)


class Records(InputPartition):
    """Records ``first`` to ``last`` (exclusive) of one file."""

    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


def files_of(path: str) -> list[str]:
    found = sorted(glob.glob(path.removeprefix("file://")))
    if not found:
        raise FileNotFoundError(path)
    return found


def dbf_header(path: str) -> tuple[int, int, int, list[tuple[str, str, int, int]]]:
    """Number of records, where they start, their length, and (name, type, place in the record, width) of each column."""
    with open(path, "rb") as file:
        count, start, length = struct.unpack_from("<IHH", file.read(32), 4)
        columns, place = [], 1
        while (entry := file.read(32))[:1] not in (b"\r", b""):
            columns.append((entry[:11].split(b"\0")[0].decode("ascii"), chr(entry[11]), place, entry[16]))
            place += entry[16]
    return count, start, length, columns


def ranges(path: str, count: int, size: int) -> list[Records]:
    return [Records(path, first, min(first + size, count)) for first in range(0, count, size)]


class DbfReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.size, self.encoding = schema, options["path"], int(options.get("records", RECORDS)), options.get("encoding", "latin-1")

    def partitions(self) -> list[Records]:
        return [p for path in files_of(self.path) for p in ranges(path, dbf_header(path)[0], self.size)]

    def read(self, partition: Records) -> Iterator[tuple]:
        """Records that are not marked as deleted; blank fields and numbers that do not parse are null, and so are columns that a file lacks."""
        _, start, length, columns = dbf_header(partition.path)
        at = {name: (place, place + width) for name, _, place, width in columns}
        wanted = [(at.get(f.name), f.dataType.typeName()) for f in self.schema.fields]
        with open(partition.path, "rb") as file:
            file.seek(start + partition.first * length)
            for _ in range(partition.first, partition.last):
                row = file.read(length)
                if len(row) == length and row[:1] != b"*":
                    yield tuple(self.value(row[place[0] : place[1]], kind) if place else None for place, kind in wanted)

    def value(self, raw: bytes, kind: str) -> object:
        text = raw.decode(self.encoding, "replace").strip(" \0")
        if kind == "string" or not text:
            return text or None
        try:
            return float(text) if kind == "double" else int(text)
        except ValueError:
            return None


class DbfSource(DataSource):
    """dBASE III tables with equal columns; without a schema the first file's, numbers as doubles."""

    @classmethod
    def name(cls) -> str:
        return "dbf"

    def schema(self) -> StructType:
        return StructType([StructField(name, TYPES.get(kind, StringType())) for name, kind, _, _ in dbf_header(files_of(self.options["path"])[0])[3]])

    def reader(self, schema: StructType) -> DbfReader:
        return DbfReader(schema, dict(self.options))


class PointReader(DataSourceReader):
    """Records of point shapes have 28, 36 or 44 bytes by kind; a file with null shapes among them is read in one part."""

    def __init__(self, schema: StructType, options: dict):
        self.names, self.path, self.size = schema.names, options["path"], int(options.get("records", RECORDS))

    def partitions(self) -> list[Records]:
        out = []
        for path in files_of(self.path):
            with open(path, "rb") as file:
                head = file.read(100)
                kind, words = struct.unpack_from("<i", head, 32)[0], struct.unpack_from(">i", head, 24)[0]
                if kind not in POINT_KINDS:
                    raise ValueError(f"shape type {kind} is no point")
                length, body = self.length(kind), 2 * words - 100
            out += ranges(path, body // length, self.size) if body % length == 0 and self.even(path, length, body) else [Records(path, 0, -1)]
        return out

    @staticmethod
    def length(kind: int) -> int:
        return 8 + 4 + {0: 0, 1: 16, 11: 32, 21: 24}[kind]

    @staticmethod
    def even(path: str, length: int, body: int) -> bool:
        """Whether the last record is where equal lengths put it, with the number it should have."""
        if body < length:
            return False
        with open(path, "rb") as file:
            file.seek(100 + body - length)
            number, words = struct.unpack(">ii", file.read(8))
        return number == body // length and 2 * words + 8 == length

    def read(self, partition: Records) -> Iterator[tuple]:
        with open(partition.path, "rb") as file:
            kind = struct.unpack_from("<i", file.read(100), 32)[0]
            record = partition.first
            file.seek(100 + record * self.length(kind))
            while (partition.last < 0 or record < partition.last) and len(head := file.read(8)) == 8:
                body = file.read(2 * struct.unpack(">ii", head)[1])
                shape = struct.unpack_from("<i", body)[0]
                if shape not in POINT_KINDS:
                    raise ValueError(f"shape type {shape} is no point")
                x, y = struct.unpack_from("<dd", body, 4) if shape else (None, None)
                facts = {"path": partition.path, "record": record, "x": x, "y": y}
                yield tuple(facts[name] for name in self.names)
                record += 1


class PointSource(DataSource):
    """Point shape files: path, record (from 0), x and y; null shapes have null coordinates."""

    @classmethod
    def name(cls) -> str:
        return "points"

    def schema(self) -> str:
        return "path string, record long, x double, y double"

    def reader(self, schema: StructType) -> PointReader:
        return PointReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the formats ``dbf`` and ``points`` known to a session."""
    from fluvion.session import ship

    ship(spark)
    for source in (DbfSource, PointSource):
        spark.dataSource.register(source)
