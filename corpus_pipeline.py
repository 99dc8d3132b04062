"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``.

Defined results, in every stage: columns beyond those of ``documents`` pass
through (the last stage ignores them); an empty table gives an empty result. A
null or blank text fails the quality rules. A null id is kept by the first
three stages, has no passages in the fourth, and is packed as null. Rows that
repeat are judged each for itself, one of them stays in the third stage.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenkg.llm import best_fit_packing, compact_windows, language_id, quality_rules, simhash
from lumenkg.llm.queries import pack_digest
from lumenkg.llm.workspace import collected_paths, discard, read_table, scratch_path, write_table


#: Scratch tables of the calls of each stage whose result no later stage has read, by place in a run. A run has its own;
#: stages called one by one share their thread's.
_held: ContextVar[dict[int, list[list[str]]] | None] = ContextVar("held", default=None)


def _stage(place: int) -> Callable:
    """A stage reads the stored result of the stage before it, whose scratch tables then go.

    That holds where one result of that stage waits to be read. Where several do, a call can't tell which of them it reads,
    so all keep their tables until the run ends, or the checkpoint folder is cleaned.
    """

    def wrap(work: Callable) -> Callable:
        @wraps(work)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            if _held.get() is None:
                _held.set({})
            held = _held.get()
            if len(held.get(place - 1, [])) == 1:
                discard(spark, held.pop(place - 1)[0])
            with collected_paths() as paths:
                out = work(spark, docs, sf_dir)
            held.setdefault(place, []).append(paths)
            return out

        return run_stage

    return wrap


@_stage(0)
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level quality rules keep."""
    return quality_rules.keep_good(docs)


@_stage(1)
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the network learns from the labels of its own input."""
    return language_id.keep_identified(docs)


@_stage(2)
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return simhash.keep_one_of_each(docs)


@_stage(3)
def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds."""
    out = compact_windows.drop_repeated_passages(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


@_stage(4)
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece with its place in the packed sequences."""
    return pack_digest(best_fit_packing.cut_pieces(docs))


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("best_fit_packing", packing_stage),
]

#: No SQL: the second stage predicts with a trained network. See tests/llm/test_pipeline.py for the brute-force comparison.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; only the last one's table stays."""
    docs, root, kept = read_table(spark, sf_dir, "documents"), scratch_path(spark, "run"), None
    own = _held.set({})
    try:
        for name, stage in STAGES:
            path = f"{root}/{name}"
            write_table(stage(spark, docs, sf_dir), path)
            docs = spark.read.parquet(path)
            if kept:
                discard(spark, [kept])
            kept = path
        for paths in _held.get().pop(len(STAGES) - 1, []):
            discard(spark, paths)
    finally:
        _held.reset(own)
    return docs
