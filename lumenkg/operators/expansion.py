"""Bounded graph expansion: at most two rounds over images with too few triples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenkg.operators.triples import merged, tail_counts


def active_images(triples: DataFrame, target: int = 30) -> DataFrame:
    """Images with fewer than ``target`` triples."""
    return triples.groupBy("img_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < target).select("img_id")


def expand(
    triples: DataFrame,
    entities: DataFrame,
    discover: Callable[[DataFrame, int], DataFrame],
    save: Callable[[DataFrame, str], DataFrame],
    rounds: int = 2,
    target: int = 30,
    searched: DataFrame | None = None,
) -> DataFrame:
    """Search the most frequent new tails of active images and merge what ``discover(tails, round)`` finds.

    ``save`` writes a table where all executors can read it and returns it, so
    that every round starts from stored rows. The first round leaves out tails
    that are entities of the image, every round those searched before, the names
    of ``searched(img_id, name)`` included.
    """
    for k in range(rounds):
        live = triples.join(active_images(triples, target), "img_id", "left_semi")
        known = entities.select("img_id", "name") if k == 0 else None
        if searched is not None:
            known = searched if known is None else known.unionByName(searched)
        tails = save(tail_counts(live, known), f"tails-{k}")
        if tails.isEmpty():
            break
        names = tails.select("img_id", F.col("tail").alias("name"))
        searched = names if searched is None else searched.unionByName(names)
        triples = save(merged(triples, discover(tails, k)), f"triples-{k}")
    return triples
