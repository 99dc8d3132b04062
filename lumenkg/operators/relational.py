"""Ordered building blocks. Order is always an explicit column, never the physical one."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key; ``keys`` may be expressions."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).filter("_rn = 1").drop("_rn")


def top_per(df: DataFrame, keys: list, order: list, k: int, name: str | None = None) -> DataFrame:
    """The first ``k`` rows of each key, with their rank in ``name`` if given."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    out = df.withColumn(name or "_rn", rank).filter(F.col(name or "_rn") <= k)
    return out if name else out.drop("_rn")


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with the place from 1 of every row in the whole order. Each task counts its own range of a sort over all tasks;
    only the tasks' totals, a row each, are summed in one place."""
    stored = cut(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    stored = stored.withColumn("_part", F.shiftright("_at", 33))
    parts = stored.groupBy("_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = parts.select("_part", (before - F.col("_first") + 1).alias("_shift"))
    return stored.join(shifts, "_part").withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def pairs_of(df: DataFrame, key: str, ord_col: str, columns: list[str]) -> DataFrame:
    """Unordered pairs within a key, the earlier row as a, the later as b; the key makes it a hash or merge join."""
    a = df.select(key, *[F.col(c).alias(f"a_{c}") for c in (ord_col, *columns)])
    b = df.select(key, *[F.col(c).alias(f"b_{c}") for c in (ord_col, *columns)])
    return a.join(b, key).filter(F.col(f"a_{ord_col}") < F.col(f"b_{ord_col}"))


def unordered_key(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("pair_lo"), F.greatest(a, b).alias("pair_hi")]


def joined_text(text: Column, order: Column, separator: str) -> Column:
    """Aggregate: texts in order, put together with a separator."""
    listed = F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    return F.array_join(F.transform(listed, lambda x: x["t"]), separator)


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-tables-")


def cut(df: DataFrame) -> DataFrame:
    """``df`` stored as a table in the folder of ``spark.checkpoint.dir``, so that later plans start from its rows and read
    only the columns they need.

    A local session without one gets a temporary folder; on a cluster it must be set.
    """
    spark = df.sparkSession
    root, master = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.master", "local")
    if not root:
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _local_folder()
    path = f"{root.rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
