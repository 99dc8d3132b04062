"""Questions: parsing model answers, classification, numbering, final records and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenkg.functions import rules
from lumenkg.functions.strings import extract_json_array

ANSWER = "array<struct<question string, answer string, short_answer string, tools array<string>, direction string, evidence array<string>, reasoning string>>"
CATEGORIES = ("retrieval", "code", "hybrid")
DIFFICULTIES = ("easy", "medium", "hard")


def parsed_questions(responses: DataFrame) -> DataFrame:
    """Rows of ``responses(img_id, raw)`` as questions in order; answers that don't parse give none."""
    text = extract_json_array(F.col("raw"))
    wrapped = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    rows = responses.select("img_id", F.posexplode(F.from_json(wrapped, ANSWER)).alias("ord", "q"))
    return rows.select("img_id", "ord", "q.*").filter(F.coalesce(F.col("question"), F.lit("")) != "")


def plainly_worded(questions: DataFrame, text_col: str = "question") -> DataFrame:
    """Questions that don't speak in the graph's own words; a null text is kept."""
    return questions.filter(~F.coalesce(rules.contains_any(F.col(text_col), rules.GRAPH_WORDING), F.lit(False)))


def classified(questions: DataFrame) -> DataFrame:
    tools = F.coalesce("tools", F.expr("cast(array() as array<string>)"))
    return questions.withColumn("tools", tools).withColumns(
        {"category": rules.question_category(F.col("tools")), "difficulty": rules.question_difficulty(F.col("tools")), "n_steps": F.size("tools")}
    )


def numbered(questions: DataFrame) -> DataFrame:
    """Ids like code_easy_01; the number counts the questions of a category in an image."""
    place = F.row_number().over(Window.partitionBy("img_id", "category").orderBy("ord"))
    return questions.withColumn("question_id", F.format_string("%s_%s_%02d", F.col("category"), F.col("difficulty"), place))


def final_records(questions: DataFrame, image_path) -> DataFrame:
    return questions.select(
        F.concat("img_id", F.lit("_"), "question_id").alias("id"), F.col("img_id").alias("image_id"), image_path.alias("image_path"),
        "category", "question_id", "question", "answer", "tools", "reasoning",
    )


def question_stats(questions: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("category") == c).alias(c) for c in CATEGORIES]
    return questions.agg(F.count(F.lit(1)).alias("total_questions"), *counts, F.count_distinct("img_id").alias("images_with_questions"))


def image_metrics(questions: DataFrame) -> DataFrame:
    """Questions of each image by category and difficulty."""
    by = [F.count_if(F.col("category") == c).alias(f"n_{c}") for c in CATEGORIES] + [F.count_if(F.col("difficulty") == d).alias(f"n_{d}") for d in DIFFICULTIES]
    return questions.groupBy("img_id").agg(F.count(F.lit(1)).alias("n_questions"), *by)


def run_summary(metrics: DataFrame) -> DataFrame:
    """One row over ``run_metrics(status, n_questions, step1_sec, step2_sec)``: images, failures, questions and mean times."""
    good = F.col("status") == "ok"
    mean = lambda c: F.sum(F.when(good, F.col(c))) / F.greatest(F.count_if(good), F.lit(1))
    return metrics.agg(
        F.count(F.lit(1)).alias("images"), F.count_if(good).alias("succeeded"), F.count_if(~good).alias("failed"),
        F.coalesce(F.sum(F.when(good, F.col("n_questions"))), F.lit(0)).alias("questions"),
        F.coalesce(mean("step1_sec"), F.lit(0.0)).alias("mean_step1"), F.coalesce(mean("step2_sec"), F.lit(0.0)).alias("mean_step2"),
    )


def breakdown(questions: DataFrame) -> DataFrame:
    """Counts over all combinations of category and difficulty, totals included."""
    return questions.cube("category", "difficulty").agg(F.count(F.lit(1)).alias("n"))
