"""Shared scratch tables for the corpus operators.

Lineage is cut by writing a Parquet table under the folder named in
``spark.checkpoint.dir`` and reading it back: every executor sees that folder,
so a lost executor costs a re-read and nothing else.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _fallback_root() -> str:
    return tempfile.mkdtemp(prefix="spark-corpus-")


#: Lists that new folder names are added to, innermost last; each thread has its own.
_collectors: ContextVar[tuple[list[str], ...]] = ContextVar("collectors", default=())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``; a temporary folder where that is unset and all runs on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _fallback_root()
    path = f"{root.rstrip('/')}/corpus/{label}-{uuid.uuid4().hex}"
    if _collectors.get():
        _collectors.get()[-1].append(path)
    return path


@contextmanager
def collected_paths() -> Iterator[list[str]]:
    """The scratch folders handed out inside the block."""
    paths: list[str] = []
    before = _collectors.set((*_collectors.get(), paths))
    try:
        yield paths
    finally:
        _collectors.reset(before)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables; only those whose readers have all been written elsewhere."""
    for name in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting that holds inside the block only."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_table(df: DataFrame, path: str, compression: str = "zstd", **options: str) -> None:
    """Write ``df`` as Parquet; the shuffle files of the write go as soon as it has ended."""
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.options(compression=compression, **options).parquet(path)


def materialise(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to a scratch table and return the table, so that later plans start from it."""
    path = scratch_path(df.sparkSession, label)
    write_table(df, path, compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, rows: int = 1000, size: int = 64 << 20) -> None:
    """Let at most ``rows`` rows and about ``size`` bytes travel to a Python worker at once: whole texts of the default
    10,000 rows take both sides' memory.

    Results are lazy and take the setting when they run, so it is lowered for the session and stays; it is never raised.
    """
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = str(spark.conf.get(name)).rstrip("bB")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
