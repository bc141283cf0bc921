"""Readers and writers of text: gauge files, listings, record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def read_gauges(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Stations and daily values of gauge text files: ``# name: value`` headers, then ``date;time;value``; values below 0 are missing.

    Stations: path, station, lat, lon, area_km2. Values: path, day, q.
    """
    lines = spark.read.option("encoding", "latin-1").text(path).select(F.input_file_name().alias("path"), F.col("value").alias("line"))
    head = lines.where(F.col("line").startswith("#"))
    fields = {"station": "GRDC-No", "lat": "Latitude", "lon": "Longitude", "area_km2": r"Catchment area"}
    wide = head.groupBy("path").agg(*[F.max(F.when(F.col("line").contains(v), F.trim(F.regexp_extract("line", ":(.*)$", 1)))).alias(k) for k, v in fields.items()])
    stations = wide.select("path", "station", *[F.expr(f"try_cast({c} as double)").alias(c) for c in ("lat", "lon", "area_km2")])
    parts = F.split("line", ";")
    day, q = F.try_to_date(parts[0], "yyyy-MM-dd"), F.expr("try_cast(trim(split(line, ';')[2]) as double)")
    values = lines.where(~F.col("line").startswith("#")).select("path", day.alias("day"), F.when(q >= 0, q).alias("q")).where("day is not null")
    return stations, values


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """``(path, kind, size, mtime, name, link)`` of tab-separated file listings; lines with other numbers of fields are left out."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).select(F.input_file_name().alias("path"), parts.alias("p")).where(F.size("p") == 5)
    return rows.select("path", F.col("p")[0].alias("kind"), F.expr("try_cast(p[1] as bigint)").alias("size"), F.expr("try_cast(p[2] as double)").alias("mtime"), F.col("p")[3].alias("name"), F.nullif(F.col("p")[4], F.lit("")).alias("link"))


def real_sizes(listing: DataFrame) -> DataFrame:
    """The listing with a link's size replaced by that of the file it names; a link to nothing keeps a null size."""
    files = listing.where("kind = 'f'").groupBy(F.col("name").alias("link")).agg(F.max("size").alias("_size"))
    return listing.join(files, "link", "left").select(*[c for c in listing.columns if c != "size"], F.when(F.col("kind") == "l", F.col("_size")).otherwise(F.col("size")).alias("size"))


def carry_marker(df: DataFrame, keys: list[str], order: str, marker: str, out: str) -> DataFrame:
    """The last marker that is not null at or before each row, within its key."""
    return df.withColumn(out, F.last(marker, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order)))


def write_new(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write a Parquet product; an existing one is never overwritten (Spark commits whole tasks, then the job)."""
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_delimited(spark: SparkSession, path: str, sep: str = ",", comment: str = "#", encoding: str = "UTF-8") -> DataFrame:
    """A delimited text table with a header, all columns as text, names trimmed and without a byte-order mark; comment lines and empty fields (null) are left out."""
    rows = spark.read.option("header", True).option("sep", sep).option("comment", comment).option("encoding", encoding).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    return rows.toDF(*[c.lstrip("﻿").strip() for c in rows.columns])


def read_columns(spark: SparkSession, path: str, names: list[str], comment: str = "#") -> DataFrame:
    """A table whose columns are parted by white space, under the names given, all as numbers; lines with another number of columns are left out."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(~F.trim("value").startswith(comment)).select(parts.alias("p")).where(F.size("p") == len(names))
    return rows.select(*[F.col("p")[i].try_cast("double").alias(n) for i, n in enumerate(names)])


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """``(path, run, year, directory)`` of run manifests (JSON): a plain run has all its years in one directory, a chunked one those of each chunk."""
    schema = "run string, directory string, start int, end int, chunks array<struct<directory: string, start: int, end: int>>"
    runs = spark.read.schema(schema).option("multiLine", True).json(path).select(F.input_file_name().alias("path"), "*")
    whole = F.array(F.struct("directory", "start", "end"))
    spans = runs.select("path", "run", F.explode(F.when(F.size("chunks") > 0, F.col("chunks")).otherwise(whole)).alias("s")).where("s.start <= s.end")
    return spans.select("path", "run", F.explode(F.sequence("s.start", "s.end")).alias("year"), "s.directory")


def write_report(df: DataFrame, path: str, order: list[str]) -> None:
    """A sorted CSV report with a header, as a folder of parts in order; an existing one is never overwritten."""
    df.orderBy(*order).write.mode("errorifexists").option("header", True).csv(path)


def markdown_table(df: DataFrame, order: list[str], most: int = 1000) -> str:
    """A report as a markdown table. Reports are short: more than ``most`` rows are an error."""
    rows = df.orderBy(*order).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([line(df.columns), "|" + "---|" * len(df.columns), *map(line, rows)])
