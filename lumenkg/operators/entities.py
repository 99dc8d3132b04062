"""Entities of an image: from raw detections to kept, located, related and promoted ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenkg.functions import geometry as g
from lumenkg.functions import rules
from lumenkg.functions.strings import name_key, numeric_labels, trimmed, value_in
from lumenkg.operators.relational import first_wins, pairs_of, top_per


#: The order of an image's detections. Where ``ord`` repeats, what was detected decides, never the order rows arrive in.
_ORDER = ("ord", "name", "etype", "w", "h", "rx1", "ry1", "rx2", "ry2", "confidence", "level")


def kept_entities(raw: DataFrame, max_share: float = 0.8) -> DataFrame:
    """Detections(img_id, ord, name, etype, w, h, rx1..ry2) with pixel boxes: names of two characters or more, first of
    each name, boxes of at most ``max_share`` of the image, numbered E1.. in order."""
    order = [c for c in _ORDER if c in raw.columns]
    named = raw.withColumn("name", trimmed(F.col("name"))).filter(F.length("name") >= 2)
    unique = first_wins(named, ["img_id", name_key(F.col("name"))], order)
    boxed = unique.withColumn("bbox", g.pixel_box(*[F.col(c) for c in ("rx1", "ry1", "rx2", "ry2", "w", "h")]))
    kept = boxed.filter(g.area_share(F.col("bbox"), F.col("w"), F.col("h")) <= max_share)
    idx = F.row_number().over(Window.partitionBy("img_id").orderBy(*order))
    return kept.withColumn("idx", idx).withColumn("id", F.concat(F.lit("E"), F.col("idx"))).drop("rx1", "ry1", "rx2", "ry2")


def enough_entities(kept: DataFrame, least: int = 3) -> DataFrame:
    """Images with fewer entities are left out."""
    n = F.count(F.lit(1)).over(Window.partitionBy("img_id"))
    return kept.withColumn("_n", n).filter(F.col("_n") >= least).drop("_n")


def located(kept: DataFrame) -> DataFrame:
    return kept.withColumn("location", g.location_text(F.col("bbox"), F.col("w"), F.col("h")))


def boxes_flagged(kept: DataFrame) -> DataFrame:
    """``kept`` with ``sound_box``: whether the box has a width and a height within the picture. A detection beyond the edge
    keeps its box, of no or negative width, as it was read."""
    b = F.col("bbox")
    return kept.withColumn("sound_box", (b["x1"] >= 0) & (b["y1"] >= 0) & (b["x2"] > b["x1"]) & (b["y2"] > b["y1"]) & (b["x2"] <= F.col("w")) & (b["y2"] <= F.col("h")))


def views(kept: DataFrame) -> DataFrame:
    """One row per entity and crop view."""
    one = kept.select("img_id", "id", F.explode(g.crop_views(F.col("bbox"), F.col("w"), F.col("h"))).alias("v"))
    return one.select("img_id", "id", "v.*")


def with_values(kept: DataFrame) -> DataFrame:
    return kept.withColumns({"value": value_in(F.col("name")), "numbers": numeric_labels(F.col("name"))})


def box_areas(kept: DataFrame) -> DataFrame:
    b = F.col("bbox")
    share = g.rounded(g.area_share(b, F.col("w"), F.col("h")), 4)
    return kept.select("img_id", "id", "name", g.area(b).alias("area"), share.alias("relative_area"), g.width(b).alias("width"), g.height(b).alias("height"))


def _offsets(kept: DataFrame, columns: list[str]) -> DataFrame:
    centred = kept.withColumns({"cx": g.centre_x(F.col("bbox")), "cy": g.centre_y(F.col("bbox"))})
    pairs = pairs_of(centred, "img_id", "idx", [*columns, "cx", "cy"])
    return pairs.withColumns({"dx": F.col("b_cx") - F.col("a_cx"), "dy": F.col("b_cy") - F.col("a_cy")})


def layout_relations(kept: DataFrame) -> DataFrame:
    """Direction and distance of every two entities of an image."""
    dx, dy = F.col("dx"), F.col("dy")
    return _offsets(kept, ["id"]).select(
        "img_id", "a_id", "b_id", g.layout_direction(dx, dy).alias("direction"), g.rounded(F.sqrt(dx * dx + dy * dy), 1).alias("distance")
    )


def compass_relations(kept: DataFrame) -> DataFrame:
    """Where the first of two entities lies seen from the second, in eight directions."""
    turned = g.compass_direction(-F.col("dx"), -F.col("dy"))
    return _offsets(kept, ["id", "name"]).select("img_id", "a_id", "b_id", F.concat("b_name", F.lit("的"), turned).alias("direction"))


def spatial_triples(kept: DataFrame) -> DataFrame:
    relation = g.spatial_relation(F.col("dx"), F.col("dy"))
    return _offsets(kept, ["name"]).select("img_id", "a_idx", "b_idx", F.col("a_name").alias("head"), relation.alias("relation"), F.col("b_name").alias("tail"))


def area_extremes(kept: DataFrame) -> DataFrame:
    """Largest entity (the first of equals) and smallest (the last of equals) of every image."""
    key = F.struct(g.area(F.col("bbox")), -F.col("idx"))
    return kept.groupBy("img_id").agg(F.max_by("id", key).alias("largest"), F.min_by("id", key).alias("smallest"))


def image_domains(kept: DataFrame) -> DataFrame:
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "name"))), lambda x: x["name"]), " ")
    return kept.groupBy("img_id").agg(names.alias("names")).select("img_id", rules.domain_of(F.col("names")).alias("domain"))


def _is_core():
    return (F.col("confidence") >= 0.8) | (F.lower("level") == "high")


def core_anchors(scored: DataFrame, fallback: int = 5) -> DataFrame:
    """Confident entities, first of each name by confidence; images without any give their first ``fallback``."""
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("img_id").orderBy(F.desc("confidence"), "idx")))
    unique = first_wins(ranked.filter(_is_core()), ["img_id", name_key(F.col("name"))], ["rank"])
    without = ranked.join(unique.select("img_id").distinct(), "img_id", "left_anti")
    return unique.unionByName(top_per(without, ["img_id"], ["idx"], fallback))


def expansion_seeds(scored: DataFrame, fallback: int = 5) -> DataFrame:
    """First of each name by confidence, without generic objects; images of generic objects alone give their first
    ``fallback`` entities."""
    generic = (F.col("etype") == "object") & name_key(F.col("name")).isin(*rules.GENERIC_OBJECTS)
    w = Window.partitionBy("img_id")
    ranked = scored.withColumns({"rank": F.row_number().over(w.orderBy(F.desc("confidence"), "idx")), "_generic": generic})
    ranked = ranked.withColumns({"_none": F.min(F.col("_generic").cast("int")).over(w) == 1, "_place": F.row_number().over(w.orderBy("idx"))})
    unique = first_wins(ranked.filter(~F.col("_generic")), ["img_id", name_key(F.col("name"))], ["rank"])
    return unique.unionByName(ranked.filter(F.col("_none") & (F.col("_place") <= fallback))).drop("_generic", "_none", "_place")


def brand_dense_top(seeds: DataFrame, k: int = 12) -> DataFrame:
    """Images with over ``k`` seeds, or ``k`` of which over 70 % are brands or texts, keep the ``k`` best by area, type and confidence."""
    w = Window.partitionBy("img_id")
    n, dense = F.count(F.lit(1)).over(w), F.avg(F.col("etype").isin("brand", "text").cast("double")).over(w)
    score = g.area(F.col("bbox")) * F.when(F.col("etype").isin(*rules.PICTURED_TYPES), 1.5).otherwise(1.0) * F.col("confidence")
    marked = seeds.withColumns({"n": n, "dense": dense, "score": score})
    cut = (F.col("n") > k) | ((F.col("n") >= k) & (F.col("dense") > 0.7))
    place = F.row_number().over(w.orderBy(F.desc("score"), "idx"))
    return marked.withColumn("place", place).filter(~cut | (F.col("place") <= k)).drop("n", "dense")


def capped_pairs(scored: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` pairs of an image in order of (searched type, confidence)."""
    order = [F.desc(F.col("etype").isin(*rules.SEARCHED_TYPES).cast("int")), F.desc("confidence"), "idx"]
    few = top_per(scored, ["img_id"], order, k + 1, "rank")  # k pairs in order need no more than k + 1 entities
    return top_per(pairs_of(few, "img_id", "rank", ["name"]), ["img_id"], ["a_rank", "b_rank"], k)


def promoted(seeds: DataFrame) -> DataFrame:
    """Seeds that get the full search budget: found by the detection itself (or without a source), or of high confidence."""
    return seeds.filter(F.coalesce("source", F.lit("")).isin("vlm_only", "") | (F.coalesce("level", F.lit("")) == "high"))


def search_routes(kept: DataFrame) -> DataFrame:
    """(img_id, id, name, route): pictured types are searched by image, all others on the web."""
    named = kept.withColumn("name", trimmed(F.col("name"))).filter(F.length("name") >= 2)
    return named.select("img_id", "id", "name", F.when(F.col("etype").isin(*rules.PICTURED_TYPES), "image").otherwise("web").alias("route"))


def reverse_search_views(kept: DataFrame) -> DataFrame:
    """The view each pictured entity is searched by: padded by a fifth, else tight."""
    wanted = F.array(F.lit("pad20"), F.lit("tight"))
    some = views(kept.filter(F.col("etype").isin(*rules.PICTURED_TYPES))).withColumn("choice", F.array_position(wanted, F.col("view"))).filter("choice > 0")
    return first_wins(some, ["img_id", "id"], ["choice"]).drop("choice")


def job_totals(entities: DataFrame, triples: DataFrame, searches: DataFrame) -> DataFrame:
    """One row: images, entities, triples and search requests of a run."""
    zero = lambda *names: [F.lit(0).cast("bigint").alias(n) for n in names]
    count = F.count(F.lit(1))
    parts = entities.agg(count.alias("entities"), F.count_distinct("img_id").alias("images")).select("images", "entities", *zero("triples", "searches"))
    parts = parts.unionByName(triples.agg(count.alias("triples")).select("triples", *zero("images", "entities", "searches")))
    parts = parts.unionByName(searches.agg(count.alias("searches")).select("searches", *zero("images", "entities", "triples")))
    return parts.agg(*[F.sum(c).alias(c) for c in ("images", "entities", "triples", "searches")])
