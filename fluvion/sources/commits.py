"""A product that several jobs extend at once: numbered manifests, each put only if its number is free.

    product = Extended(spark, "/data/unit", keys=["year"])
    product.extend(df, note={"code": "a1"})
    product.read()

A job writes its rows to a folder of their own, then puts the next manifest,
which lists all folders so far. If another job has taken that number, the newer
manifest is read and the keys are checked again before the next try: what both
added is kept, and rows of keys that are already there are refused. A job that
is lost leaves a folder that no manifest names, and changes nothing.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession


class Conflict(Exception):
    """The product already holds some of the keys."""


def put_if_absent(spark: SparkSession, path: str, content: str) -> bool:
    """Put a small file whole, or return False if there is one of that name; of several writers at once one succeeds.

    On a mounted file system by a hard link, elsewhere by a rename that the
    store refuses where the name is taken.
    """
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    system.mkdirs(target.getParent())
    out = system.create(part, False)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    try:
        if system.getScheme() == "file":
            try:
                os.link(part.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        if system.exists(target):
            return False
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(part, target, options)
        except Exception:
            if system.exists(target):
                return False
            raise
        return True
    finally:
        system.delete(part, False)


def get(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, or None if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_record(spark: SparkSession, path: str, record: dict) -> bool:
    """A JSON record with sorted keys; an existing one is never replaced."""
    return put_if_absent(spark, path, json.dumps(record, sort_keys=True, indent=1, ensure_ascii=False) + "\n")


class Extended:
    """A product below ``path``; no two extensions hold rows with the same values of ``keys``."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    def manifest(self, number: int) -> dict | None:
        text = get(self.spark, f"{self.path}/_manifests/{number:08d}.json")
        return None if text is None else json.loads(text)

    def latest(self) -> tuple[int, dict]:
        """Number and content of the newest manifest; 0 and an empty one for a new product."""
        listed = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifests")
        system = listed.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in system.listStatus(listed)] if system.exists(listed) else []
        number = max([int(n[:8]) for n in names if n.endswith(".json")], default=0)
        return number, self.manifest(number) or {"parts": [], "notes": []}

    def read(self, number: int | None = None) -> DataFrame:
        """The rows as of a manifest, the newest unless one is named."""
        held = self.latest()[1] if number is None else self.manifest(number)
        if not held or not held["parts"]:
            raise FileNotFoundError(f"{self.path} has no rows")
        return self.spark.read.parquet(*[f"{self.path}/{p}" for p in held["parts"]])

    def clash(self, added: DataFrame, parts: list[str]) -> list[tuple]:
        """Some of the keys of ``added`` that the parts hold."""
        if not parts:
            return []
        held = self.spark.read.parquet(*[f"{self.path}/{p}" for p in parts]).select(*self.keys)
        return [tuple(r) for r in added.select(*self.keys).distinct().join(held.distinct(), self.keys, "left_semi").limit(5).collect()]

    def extend(self, df: DataFrame, note: dict | None = None, tries: int = 100) -> int:
        """Add rows; returns the manifest's number. Only parts that came since the last look are compared again."""
        part = f"part-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(f"{self.path}/{part}")
        added, seen = self.spark.read.schema(df.schema).parquet(f"{self.path}/{part}"), set()
        for _ in range(tries):
            number, held = self.latest()
            clash = self.clash(added, [p for p in held["parts"] if p not in seen])
            if clash:
                raise Conflict(f"{self.path} already holds {clash}")
            seen.update(held["parts"])
            record = {"parts": [*held["parts"], part], "notes": [*held["notes"], note or {}]}
            if put_record(self.spark, f"{self.path}/_manifests/{number + 1:08d}.json", record):
                return number + 1
        raise RuntimeError(f"{tries} other extensions came first")
