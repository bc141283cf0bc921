"""Readers of small binary registers: dBASE tables, point shapes, spreadsheets. Files are dealt over tasks, one file per row."""

from __future__ import annotations

import io
import re
import struct
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.session import ship

RECORD = "path string, record long, fields map<string,string>"


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    ship(spark)
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")


def dbf_records(content: bytes, encoding: str = "latin-1") -> Iterator[dict[str, str | None]]:
    """Records of a dBASE III table that are not marked as deleted; blank fields are None."""
    count, start, length = struct.unpack_from("<IHH", content, 4)
    fields, at = [], 32
    while content[at] != 0x0D:
        fields.append((content[at : at + 11].split(b"\0")[0].decode("ascii"), content[at + 16]))
        at += 32
    for i in range(count):
        row = content[start + i * length : start + (i + 1) * length]
        if len(row) < length or row[:1] == b"*":
            continue
        place, out = 1, {}
        for name, width in fields:
            out[name] = row[place : place + width].decode(encoding, "replace").strip(" \0") or None
            place += width
        yield out


def shp_points(content: bytes) -> Iterator[tuple[float, float]]:
    """x and y of each record of a point shape file; null shapes are (nan, nan)."""
    at = 100
    while at + 8 <= len(content):
        (words,) = struct.unpack_from(">I", content, at + 4)
        (kind,) = struct.unpack_from("<i", content, at + 8)
        if kind not in (0, 1, 11, 21):
            raise ValueError(f"shape type {kind} is no point")
        yield struct.unpack_from("<dd", content, at + 12) if kind else (float("nan"), float("nan"))
        at += 8 + 2 * words


def xlsx_rows(content: bytes, header_keys: tuple[str, ...]) -> Iterator[dict[str, str | None]]:
    """Rows of the first sheet below the first row that holds all header keys, as column name to text."""
    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = book.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{space}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{space}si")]
        sheet = sorted(n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))[0]
        header: dict[str, str] | None = None
        for row in ElementTree.fromstring(book.read(sheet)).iter(f"{space}row"):
            cells = {}
            for c in row.iter(f"{space}c"):
                value = c.find(f"{space}v")
                inline = c.find(f"{space}is")
                text = shared[int(value.text)] if c.get("t") == "s" and value is not None else value.text if value is not None else "".join(t.text or "" for t in inline.iter(f"{space}t")) if inline is not None else None
                cells[re.sub("[0-9]", "", c.get("r"))] = text
            if header is None:
                if set(header_keys) <= set(cells.values()):
                    header = {k: v for k, v in cells.items() if v}
            else:
                yield {name: cells.get(k) for k, name in header.items()}


def _records(spark: SparkSession, path: str, glob: str, parse) -> DataFrame:
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                rows = list(parse(bytes(content)))
                yield pd.DataFrame({"path": [name] * len(rows), "record": range(len(rows)), "fields": rows})

    return _files(spark, path, glob).mapInPandas(read, RECORD)


def read_dbf(spark: SparkSession, path: str, encoding: str = "latin-1") -> DataFrame:
    """``(path, record, fields)`` of all dBASE tables below a folder."""
    return _records(spark, path, "*.dbf", lambda content: dbf_records(content, encoding))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """``(path, record, x, y)`` of all point shape files below a folder."""
    rows = _records(spark, path, "*.shp", lambda content: ({"x": repr(x), "y": repr(y)} for x, y in shp_points(content)))
    return rows.select("path", "record", F.col("fields.x").cast("double").alias("x"), F.col("fields.y").cast("double").alias("y"))


def read_xlsx(spark: SparkSession, path: str, header_keys: tuple[str, ...]) -> DataFrame:
    """``(path, record, fields)`` of the first sheets of all spreadsheets below a folder."""
    return _records(spark, path, "*.xlsx", lambda content: xlsx_rows(content, header_keys))
