"""What became of each image in each stage: a ledger of outcomes, and what it decides.

A stage that ends adds one row per image it took, told from its rejects by anti joins: ``ok``; ``skip`` for images that
have too little to go on, which more tries don't change; ``error`` for images whose calls failed or gave no usable answer;
``waiting`` for images with requests that nobody has called. The ledger is only ever added to, so it also tells how often
an image was tried.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEDGER = "img_id string, stage string, status string, reason string, n_entities bigint, n_triples bigint, n_questions bigint, run bigint, seconds double"
COUNTS = ("n_entities", "n_triples", "n_questions")


def outcome(images: DataFrame, stage: str, status: str, reason: Column | str = "", **counts: Column) -> DataFrame:
    """Ledger rows of ``images(img_id, ...)``, one per image; counts that aren't given stay null."""
    reason = F.lit(reason) if isinstance(reason, str) else reason
    numbers = [F.coalesce(counts.get(c, F.lit(None)), F.lit(None)).cast("bigint").alias(c) for c in COUNTS]
    rows = images.select("img_id", F.lit(stage).alias("stage"), F.lit(status).alias("status"), reason.alias("reason"), *numbers)
    return rows.dropDuplicates(["img_id"])


def lost(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of ``before`` whose image isn't in ``after``."""
    return before.join(after.select("img_id").distinct(), "img_id", "left_anti")


def first_reason(parts: list[DataFrame]) -> DataFrame:
    """Outcomes put together; an image takes the first part that names it."""
    marked = [p.withColumn("_part", F.lit(k)) for k, p in enumerate(parts)]
    both = reduce(DataFrame.unionByName, marked)
    rank = F.row_number().over(Window.partitionBy("img_id").orderBy("_part"))
    return both.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_part")


def failed_calls(responses: DataFrame, api: str) -> DataFrame:
    """(img_id, reason) of images whose call of a model failed or gave no usable answer, by the last try."""
    bad = responses.filter((F.col("api") == api) & (F.col("status") != "ok"))
    good = responses.filter((F.col("api") == api) & (F.col("status") == "ok")).select("key")
    return bad.join(good, "key", "left_anti").groupBy(F.col("key").alias("img_id")).agg(F.max("status").alias("reason"))


def enrich_outcomes(images: DataFrame, responses: DataFrame, answers: DataFrame, detected: DataFrame, kept: DataFrame, documents: DataFrame, waiting: DataFrame | None) -> DataFrame:
    """One row per image of ``images``: how far the first job came with it.

    ``answers`` are parsed detections, ``detected`` all kept entities, ``kept`` those of images with enough of them.
    """
    unasked = lost(images, responses.filter("api = 'detect'").select(F.col("key").alias("img_id")))
    none = lost(images, answers)
    errors = none.join(failed_calls(responses, "detect"), "img_id", "left").withColumn("reason", F.coalesce("reason", F.lit("json_parse_failed")))
    few = lost(answers.join(images.select("img_id"), "img_id", "left_semi"), kept)
    n = few.select("img_id").join(detected.groupBy("img_id").agg(F.count(F.lit(1)).alias("n")), "img_id", "left")
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    done = outcome(documents, "enrich", "ok", n_entities=size("entities"), n_triples=size("triples"))
    blind = images.filter("width is null or height is null") if "width" in images.columns else images.limit(0)
    parts = [
        outcome(blind, "enrich", "error", "unreadable image"),
        outcome(unasked, "enrich", "waiting", "not called"),
        outcome(errors, "enrich", "error", F.concat(F.lit("detect: "), "reason")),
        outcome(n, "enrich", "skip", "too few entities", n_entities=F.coalesce("n", F.lit(0))),
    ]
    if waiting is not None:
        parts.append(outcome(waiting.join(images.select("img_id"), "img_id", "left_semi"), "enrich", "waiting", "requests not called"))
    return first_reason([*parts, done])


def question_outcomes(documents: DataFrame, responses: DataFrame, questions: DataFrame) -> DataFrame:
    """One row per document: whether questions were made of it."""
    made = questions.groupBy("img_id").agg(F.count(F.lit(1)).alias("n"))
    without = lost(documents.select("img_id").distinct(), made)
    asked = responses.filter("api = 'questions'").select(F.col("key").alias("img_id"))
    errors = without.join(failed_calls(responses, "questions"), "img_id")
    return first_reason([
        outcome(made.join(documents.select("img_id").distinct(), "img_id", "left_semi"), "questions", "ok", n_questions=F.col("n")),
        outcome(lost(without, asked), "questions", "waiting", "not called"),
        outcome(errors, "questions", "error", F.concat(F.lit("questions: "), "reason")),
        outcome(without, "questions", "error", "no questions generated", n_questions=F.lit(0)),
    ])


def latest(ledger: DataFrame) -> DataFrame:
    """The last row of each image and stage."""
    rank = F.row_number().over(Window.partitionBy("img_id", "stage").orderBy(F.desc("run")))
    return ledger.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def unfinished(images: DataFrame, ledger: DataFrame, stage: str = "enrich", tries: int = 3) -> DataFrame:
    """Images that the stage still has to take: never done, not skipped, and failed fewer than ``tries`` times.

    Waiting doesn't count as a try.
    """
    own = ledger.filter(F.col("stage") == stage)
    settled = own.groupBy("img_id").agg(F.max(F.col("status").isin("ok", "skip").cast("int")).alias("done"), F.count_if(F.col("status") == "error").alias("failed"))
    return images.join(settled.filter((F.col("done") == 1) | (F.col("failed") >= tries)), "img_id", "left_anti")


def image_results(ledger: DataFrame) -> DataFrame:
    """(img_id, status, error, n_entities, n_triples, n_questions, step1_sec, step2_sec): the last outcome of each image.

    An image is ``ok`` if both stages are; else the stage that stopped it says why.
    """
    now = latest(ledger)
    side = lambda stage, n: now.filter(F.col("stage") == stage).select("img_id", *[F.col(c).alias(f"{c}_{n}") for c in ("status", "reason", *COUNTS, "seconds")])
    both = side("enrich", 1).join(side("questions", 2), "img_id", "full")
    one = F.col("status_1") != "ok"
    status = F.when(one, F.concat(F.lit("step1_"), "status_1")).when(F.col("status_2").isNull(), "step2_waiting").when(F.col("status_2") != "ok", F.concat(F.lit("step2_"), "status_2")).otherwise("ok")
    error = F.when(one, F.concat(F.lit("step1: "), "reason_1")).when(F.col("status_2") != "ok", F.concat(F.lit("step2: "), "reason_2"))
    return both.select("img_id", status.alias("status"), error.alias("error"), F.col("n_entities_1").alias("n_entities"), F.col("n_triples_1").alias("n_triples"), F.col("n_questions_2").alias("n_questions"), F.col("seconds_1").alias("step1_sec"), F.col("seconds_2").alias("step2_sec"))


def status_counts(ledger: DataFrame) -> DataFrame:
    """(stage, status, reason, images): how many images each outcome has now."""
    return latest(ledger).groupBy("stage", "status", "reason").agg(F.count(F.lit(1)).alias("images"))
