"""Sinks. Spark's commit protocol makes each write appear whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenkg.operators import entities as en
from lumenkg.operators.questions import CATEGORIES, question_stats


def _folder(spark: SparkSession, path: str):
    """(file system, Hadoop path) of a folder, wherever it lies."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def generations(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the generations that a document store holds, none before its first write."""
    files, at = _folder(spark, root)
    if not files.exists(at):
        return []
    return sorted(int(f.getPath().getName()[4:]) for f in files.listStatus(at) if f.getPath().getName().startswith("gen="))


def write_documents(documents: DataFrame, root: str, version: int = 0, buckets: int = 64) -> None:
    """Per-image documents as JSON lines in ``buckets`` folders by image, appended to the newest generation.

    A document of a later ``version`` replaces that of its image: readers see the latest one only (``latest_documents``).
    One writer at a time; a write appears whole or not at all.
    """
    gen = max(generations(documents.sparkSession, root), default=0)
    bucket = F.pmod(F.xxhash64("img_id"), F.lit(buckets)).alias("bucket")
    documents.select("*", F.lit(version).cast("long").alias("version"), bucket).write.mode("append").partitionBy("bucket").json(f"{root}/gen={gen}")


def latest_documents(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame | None:
    """The latest version of every document under ``root``, with its own columns; None before the first write.

    ``schema`` names the columns wanted, so that no file is read for its schema.
    """
    if not generations(spark, root):
        return None
    reader = spark.read.schema(f"{schema}, version long, gen int, bucket int") if schema else spark.read
    rank = F.row_number().over(Window.partitionBy("img_id").orderBy(F.desc("version"), F.desc("gen")))
    return reader.json(root).withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "version", "gen", "bucket")


def compact_documents(spark: SparkSession, root: str, buckets: int = 64) -> None:
    """Write the latest versions as a new generation, one file per bucket, and drop the generations before it.

    A run that ends in between leaves both; readers then see the same documents, and the next run drops what is left.
    """
    old = generations(spark, root)
    if not old or spark.read.schema("img_id string").json(root).isEmpty():
        return
    rows = spark.read.json(root)
    rank = F.row_number().over(Window.partitionBy("img_id").orderBy(F.desc("version"), F.desc("gen")))
    newest = rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "gen", "bucket")
    bucket = F.pmod(F.xxhash64("img_id"), F.lit(buckets)).alias("bucket")
    newest.select("*", bucket).repartition("bucket").write.partitionBy("bucket").json(f"{root}/gen={old[-1] + 1}")
    for gen in old:
        files, at = _folder(spark, f"{root}/gen={gen}")
        files.delete(at, True)


def entity_documents(images: DataFrame, entities: DataFrame, triples: DataFrame, anchors: DataFrame, kept: DataFrame) -> DataFrame:
    """One nested row per image: its entities, anchors (``high_conf``) and triples in order, and how its boxes lie."""
    listed = lambda df, name, ord_="ord": df.groupBy("img_id").agg(F.array_sort(F.collect_list(F.struct(ord_, *[c for c in df.columns if c not in ("img_id", ord_)]))).alias(name))
    areas = listed(en.box_areas(kept).join(kept.select("img_id", "id", "idx"), ["img_id", "id"]), "areas", "idx")
    layout = listed(en.layout_relations(kept), "layout", "a_id")
    boxes = areas.join(layout, "img_id", "left").join(en.area_extremes(kept), "img_id").select("img_id", F.struct("areas", "layout", "largest", "smallest").alias("local_artifacts"))
    out = images
    for part in (listed(entities, "entities"), listed(anchors.select("img_id", "rank", "id", "name", "etype", "bbox", "location", "confidence"), "high_conf", "rank"), listed(triples, "triples"), boxes):
        out = out.join(part, "img_id", "left")
    return out


QUESTION = "struct<question_id:string,category:string,question:string,answer:string,tools:array<string>,reasoning:string>"
QUESTION_DOCUMENT = f"img_id string, img_path string, questions array<{QUESTION}>"


def question_documents(records: DataFrame) -> DataFrame:
    """One nested row per image with its path and questions."""
    parts = F.array_sort(F.collect_list(F.struct("question_id", "category", "question", "answer", "tools", "reasoning"))).alias("questions")
    return records.groupBy(F.col("image_id").alias("img_id"), F.col("image_path").alias("img_path")).agg(parts)


def records_of(documents: DataFrame) -> DataFrame:
    """The final records of question documents."""
    rows = documents.select("img_id", "img_path", F.explode("questions").alias("q"))
    return rows.select(F.concat("img_id", F.lit("_"), "q.question_id").alias("id"), F.col("img_id").alias("image_id"), F.col("img_path").alias("image_path"), "q.category", "q.question_id", "q.question", "q.answer", "q.tools", "q.reasoning")


def write_questions(records: DataFrame, root: str) -> None:
    """Final records by category, their union in category order, and the statistics."""
    records.write.mode("overwrite").partitionBy("category").json(f"{root}/by_category")
    rank = F.array_position(F.array(*map(F.lit, CATEGORIES)), F.col("category"))
    records.withColumn("_rank", rank).sort("_rank", "image_id", "question_id").drop("_rank").write.mode("overwrite").json(f"{root}/all_questions")
    question_stats(records.withColumnRenamed("image_id", "img_id")).write.mode("overwrite").json(f"{root}/question_stats")


def bench_summary(results: DataFrame) -> DataFrame:
    """One row over ``results(folder, img_id, status, n_questions)``."""
    good = F.col("status") == "ok"
    questions = F.coalesce(F.sum(F.when(good, F.col("n_questions"))), F.lit(0)).alias("total_questions")
    return results.agg(F.count(F.lit(1)).alias("total_images"), F.count_if(good).alias("success"), F.count_if(~good).alias("failed"), F.count_distinct("folder").alias("folders"), questions)


def sorted_results(results: DataFrame) -> DataFrame:
    """Result rows in order of folder and image."""
    return results.orderBy("folder", "img_id")


def write_summary(results: DataFrame, root: str, wall_time_sec: float) -> None:
    """``results`` in order as JSON lines under ``results``, and one row of totals with the wall time under ``totals``."""
    sorted_results(results).write.mode("overwrite").json(f"{root}/results")
    bench_summary(results).withColumn("wall_time_sec", F.lit(round(wall_time_sec, 1))).write.mode("overwrite").json(f"{root}/totals")
