"""The engine from SQL: views over the operators and table functions that take an image.

``install`` names the tables of a session, and makes each operator's result a temporary view that is computed when it is
read. Functions narrow a view to one image; Spark pushes the image into the tables below where the operator allows it.

    install(spark, detections=..., entities=..., triples=...)
    spark.sql("select * from graph_stats_of('img_00001')")
    spark.sql("select img_id, count(*) from kept_entities group by img_id")
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenkg.functions import rules
from lumenkg.functions import strings as s
from lumenkg.operators import entities as en
from lumenkg.operators import graph as gr
from lumenkg.operators import triples as tr


def _trimmed(triples: DataFrame) -> DataFrame:
    return tr.sanitised(triples.withColumns({"head": s.trimmed(F.col("head")), "tail": s.trimmed(F.col("tail"))}))


def views(detections: DataFrame, entities: DataFrame, triples: DataFrame) -> dict[str, DataFrame]:
    """Name and rows of every view: the entities of ``detections``, and the cleaned triples and graph of ``entities``."""
    kept = en.kept_entities(detections)
    clean = _trimmed(triples)
    normal = tr.normalised(clean, entities)
    resolved = gr.resolved_triples(entities, normal)
    retrieved = gr.retrieve_edges(resolved)
    by_region = gr.region_edges(entities, retrieved)
    return {
        "kept_entities": kept, "located_entities": en.located(kept), "entity_views": en.views(kept), "layout": en.layout_relations(kept), "spatial_triples": en.spatial_triples(kept),
        "core_anchors": en.core_anchors(kept), "expansion_seeds": en.expansion_seeds(kept), "cleaned_triples": clean, "normalised_triples": normal,
        "graph_nodes": gr.nodes(entities, resolved), "graph_edges": gr.edges(entities, retrieved), "graph_stats": gr.stats(entities, resolved), "region_scores": gr.region_scores(entities, retrieved),
        "comparable_times": gr.comparable_pairs(by_region, "TIME"), "comparable_quantities": gr.value_differences(gr.comparable_pairs(by_region, "QUANTITY")),
        "rankable_times": gr.rankable_groups(by_region, "TIME"), "alias_candidates": tr.alias_candidates(entities, clean), "top_tails": tr.tail_counts(clean, entities),
    }


#: Scalar rules as SQL functions of (relation, kind).
_RULES: dict[str, Callable] = {"value_bucket": rules.value_bucket, "relation_text": lambda r, k: rules.natural_text(s.slug(r), k), "question_value": lambda r, k: rules.question_value(s.slug(r), k)}


def install(spark: SparkSession, detections: DataFrame, entities: DataFrame, triples: DataFrame) -> list[str]:
    """Create the views and a table function ``<view>_of(image)`` for each; returns the names of the views."""
    made = views(detections, entities, triples)
    for name, rows in made.items():
        rows.createOrReplaceTempView(name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(f"create or replace temporary function {name}_of(image string) returns table ({columns}) return select * from {name} where img_id = image")
    return list(made)


def relation_rules(spark: SparkSession, relations: DataFrame) -> None:
    """View ``relation_rules``: the rules of each distinct (relation, kind) of ``relations``, to be joined from SQL."""
    pair = relations.select("relation", "kind").distinct()
    told = {name: rule(F.col("relation"), F.col("kind")) for name, rule in _RULES.items()}
    pair.withColumns({**told, "profile": rules.relation_profile(F.col("relation"), F.col("kind"))}).createOrReplaceTempView("relation_rules")
