"""File sources: image folders, JSON documents, stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenkg.operators.relational import top_per

#: Image file endings and the folders images are looked for in, best first.
IMAGE_ENDINGS = (".jpg", ".jpeg", ".png", ".webp")
#: Fixed value: the ending of documents that are copies for comparison and aren't read.
SHADOW_SUFFIX = "_randomwalk_shadow.json"
IMAGE_PATTERN = "*.{jpg,jpeg,png,webp}"


def stem(path: Column) -> Column:
    """File name without folder and ending."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), "\\.[^.]*$", "")


def folder(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def image_paths(spark: SparkSession, root: str, recursive: bool = True, limit: int = 0) -> DataFrame:
    """(img_id, path) of image files in path order, the first ``limit`` if it is positive; file contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", IMAGE_PATTERN).option("recursiveFileLookup", str(recursive).lower()).load(root)
    paths = files.select("path").distinct().select(stem(F.col("path")).alias("img_id"), "path").orderBy("path")
    return paths.limit(limit) if limit > 0 else paths


def first_image_paths(spark: SparkSession, roots: list[str], limit: int = 0) -> tuple[DataFrame, str] | None:
    """Image paths of the first of ``roots`` that exists and holds images, and that root; None if none does."""
    for root in filter(None, roots):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            continue
        found = image_paths(spark, root, limit=limit)
        if not found.isEmpty():
            return found, root
    return None


def sampled_image_paths(spark: SparkSession, root: str, k: int = 3) -> DataFrame:
    """The first ``k`` image paths of each folder."""
    return top_per(image_paths(spark, root).withColumn("folder", folder(F.col("path"))), ["folder"], ["path"], k)


def image_sizes(spark: SparkSession, root: str) -> DataFrame:
    """(img_id, path, width, height) of images that Spark decodes."""
    images = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").load(root)
    return images.select(stem(F.col("image.origin")).alias("img_id"), F.col("image.origin").alias("path"), F.col("image.width").alias("width"), F.col("image.height").alias("height"))


def bounded_size(w: Column, h: Column, longest: int = 2048) -> Column:
    """struct(width, height) scaled down so that the long edge is at most ``longest``."""
    top = F.greatest(w, h)
    part = lambda x: F.when(top > longest, (x * F.lit(longest) / top).cast("int")).otherwise(x.cast("int"))
    return F.struct(part(w).alias("width"), part(h).alias("height"))


def json_documents(spark: SparkSession, root: str, schema: str, skip_suffix: str | None = None) -> DataFrame:
    """One row per JSON file with its path; files that aren't JSON are skipped."""
    rows = spark.read.schema(f"{schema}, _bad string").option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").json(root)
    rows = rows.withColumn("path", F.col("_metadata.file_path")).filter(F.col("_bad").isNull()).drop("_bad")
    return rows.filter(~F.col("path").endswith(skip_suffix)) if skip_suffix else rows


def response_files(spark: SparkSession, root: str) -> DataFrame:
    """(api, key, body, status, path) of files ``<api>/<key>.json``, by Spark's own reader, from any store it opens."""
    read = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").load(root)
    body = F.decode("content", "UTF-8")
    status = F.when(F.try_parse_json(body).isNotNull(), "ok").otherwise("json_parse_failed")
    return read.select(folder(F.col("path")).alias("api"), stem(F.col("path")).alias("key"), body.alias("body"), status.alias("status"), "path")


def locate_images(ids: DataFrame, paths: DataFrame, folders: list[str]) -> DataFrame:
    """Path of each image id: the first folder of ``folders``, then the first ending, that has it."""
    rank = lambda c, values: F.array_position(F.array(*map(F.lit, values)), c)
    ending = F.regexp_extract(F.lower("path"), "(\\.[^.]*)$", 1)
    ranked = paths.withColumns({"d": rank(folder(F.col("path")), folders), "e": rank(ending, IMAGE_ENDINGS)}).filter("d > 0 and e > 0")
    best = ranked.groupBy("img_id").agg(F.min_by("path", F.struct("d", "e")).alias("path"))
    return ids.join(best, "img_id", "left")


def unfinished(ids: DataFrame, done: DataFrame) -> DataFrame:
    """Ids without a stored result."""
    return ids.join(done.select("img_id").distinct(), "img_id", "left_anti")


def good_images(scores: DataFrame, dimensions: list[str], total: int = 18, each: int = 3) -> DataFrame:
    """Images whose quality scores add up to ``total`` with at least ``each`` in every dimension."""
    added = sum((F.col(d) for d in dimensions[1:]), F.col(dimensions[0]))
    return scores.filter((added >= total) & (F.least(*dimensions) >= each))
