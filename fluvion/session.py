"""Session and shared-storage helpers used by every operator."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, whose
    executor is the driver itself, may go without: then a folder of our own is
    made and recorded.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        path = getattr(shared_dir, "_local", None)
        if path is None:
            path = shared_dir._local = "file://" + tempfile.mkdtemp(prefix="spark-fluvion-")
    return path.rstrip("/")


#: Folders below the application's own that tables are written to just now, the innermost last.
_scopes: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


def own_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return "/".join([shared_dir(spark), "fluvion", spark.sparkContext.applicationId, *_scopes.get()])


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The rows that ``make`` gives, as a written table. Tables that were written on the way are deleted when it is whole.

    Only what is returned may be read afterwards: nothing that ``make`` has
    kept elsewhere.
    """
    path, mark = f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}", _scopes.set((*_scopes.get(), f"scope-{uuid.uuid4().hex}"))
    try:
        df = make()
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, own_dir(spark))
        _scopes.reset(mark)


def clear(spark: SparkSession) -> None:
    """Delete this application's intermediate tables. Results that were not yet written elsewhere cannot be read afterwards."""
    _delete(spark, own_dir(spark))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    This cuts the lineage: a lost executor makes Spark reread files that any
    other executor can reach, and later steps do not recompute earlier ones.
    """
    path = f"{own_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join by shuffle. Rounds that broadcast their tables, however small each is, add up on the driver."""
    return df.hint("merge")


def cached(spark: SparkSession, key: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table of a content key: read where an earlier call has written it whole, else made and written.

    The key has to name everything that the table depends on. Each writer has a
    folder of its own and then puts a pointer to it, if there is none: of two
    at once the first counts for both, and one that is cut off leaves none.
    """
    from fluvion.sources.commits import get, put_if_absent

    path = f"{shared_dir(spark)}/fluvion-cache/{hashlib.sha256(key.encode()).hexdigest()}"
    folder = get(spark, f"{path}/current")
    if folder is None:
        folder = uuid.uuid4().hex
        make().write.option("compression", "zstd").parquet(f"{path}/{folder}")
        if not put_if_absent(spark, f"{path}/current", folder):
            folder = get(spark, f"{path}/current")
    return spark.read.parquet(f"{path}/{folder}")


class Rounds:
    """Rows that an iterative operator finishes round by round: each round is a written part of one table, which is read once at the end."""

    def __init__(self, spark: SparkSession, name: str):
        self.path, self.spark, self.schema, self.n = f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}", spark, None, 0

    def add(self, df: DataFrame) -> DataFrame:
        """Write one more part; returns the part as written."""
        self.schema, path = self.schema or df.schema, f"{self.path}/part{self.n}"
        df.select(*self.schema.names).write.option("compression", "zstd").parquet(path)
        self.n += 1
        return self.spark.read.schema(self.schema).parquet(path)

    def rows(self) -> DataFrame:
        """All parts, in one scan."""
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/part{k}" for k in range(self.n)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch for Python tasks where the session has Spark's own default: texts are long, and each worker holds a batch several times over.
BATCH_ROWS = 2000


def tidy(function: Callable) -> Callable:
    """A function over batches whose worker gives freed memory back to the system at the end of each task; idle workers stay small beside later stages."""

    def run(batches: Iterator) -> Iterator:
        yield from function(batches)
        gc.collect()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):
            pass  # another C library

    return run


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context, so Python tasks can import it; their batches are kept small."""
    context = spark.sparkContext
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))
    if ship.__dict__.get("context") == context.applicationId:
        return
    root = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="spark-fluvion-")) / "fluvion.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))
    ship.context = context.applicationId
