"""The heterogeneous graph of an image (image, regions, entities, facts) and the queries on it."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenkg.functions import rules
from lumenkg.functions.strings import canonical, slug, trimmed
from lumenkg.operators.relational import cut, first_wins, top_per

#: Labels of the graph's text.
NAMES_LABEL, FACTS_LABEL, FACTS_END, SPACE_LABEL, ABOUT_LABEL = "【图中实体】", "\n【知识三元组】（共 ", " 条）", "\n【空间细节】\n", "\n图片描述: "
KIND_LABEL, AT_LABEL, BOX_LABEL, CENTRE_LABEL, SIZE_LABEL, AREA_LABEL, AREA_END = "  类型=", "  位置=", "  bbox=", ": 中心=(", ") 尺寸=", " 面积=", "px²"

def _complete(triples: DataFrame) -> DataFrame:
    named = triples.withColumns({c: trimmed(F.coalesce(F.col(c), F.lit(""))) for c in ("head", "tail", "relation")})
    return named.filter((F.col("head") != "") & (F.col("tail") != "") & (F.col("relation") != ""))


def regions(entities: DataFrame) -> DataFrame:
    """(img_id, ord, region, entity, name, etype, confidence, location): one region per named entity of the image."""
    named = entities.withColumn("name", trimmed(F.col("name"))).filter(F.col("name") != "")
    return named.select(
        "img_id", "ord", F.concat(F.lit("region:"), "id").alias("region"), F.concat(F.lit("entity:"), F.lower("name")).alias("entity"),
        "name", "etype", "confidence", "location",
    )


def with_rules(rows: DataFrame, keys: list[str], **told: Column) -> DataFrame:
    """``rows`` with columns that depend on ``keys`` alone, worked out once per distinct key and joined back.

    The rules are long case expressions over strings, and relations are few next to triples. ``rows`` is read twice, so it
    should be a table. Null keys count as a key.
    """
    once = rows.select(*keys).distinct().select(*[F.col(k).alias(f"_{k}") for k in keys], *[c.alias(n) for n, c in told.items()])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(once, same).drop(*[f"_{k}" for k in keys])


def resolved_triples(entities: DataFrame, triples: DataFrame) -> DataFrame:
    """Complete triples with the entity node of their head: the entity of that name, else the last one of the same canonical
    name, else a synthetic one; and with their fact node, slug and profile. The triples are stored first: they are read for
    their distinct relations as well."""
    own = regions(entities)
    exact = own.select("img_id", "entity").distinct().withColumn("found", F.lit(True))
    folded = own.groupBy("img_id", canonical(F.col("name")).alias("canon")).agg(F.max_by("entity", "ord").alias("folded"))
    profile = rules.relation_profile(F.col("relation"), F.col("tail_type"))
    facts = with_rules(cut(_complete(triples)), ["relation", "tail_type"], profile=profile)
    facts = facts.withColumns({"entity": F.concat(F.lit("entity:"), F.lower("head")), "canon": canonical(F.col("head")), "slug": slug(F.col("relation"))})
    facts = facts.join(exact, ["img_id", "entity"], "left").join(folded, ["img_id", "canon"], "left")
    key = F.when(F.col("found"), F.col("entity")).otherwise(F.coalesce("folded", F.concat(F.lit("entity:"), "canon")))
    fact = F.concat(F.lit("fact:"), F.lower("head"), F.lit(":"), "slug", F.lit(":"), F.lower("tail"))
    out = facts.withColumns({"synthetic": F.col("found").isNull() & F.col("folded").isNull(), "entity": key, "fact_key": fact})
    return out.drop("found", "folded", "canon")


def retrieve_edges(resolved: DataFrame) -> DataFrame:
    """Edges entity -> fact worth asking about; of repeats the last one's attributes hold, at the place of the first."""
    good = resolved.filter(_askable())
    last = F.row_number().over(Window.partitionBy("img_id", "entity", "fact_key").orderBy(F.desc("ord")))
    first_ord = F.min("ord").over(Window.partitionBy("img_id", "entity", "fact_key"))
    one = good.withColumns({"_last": last, "first_ord": first_ord}).filter("_last = 1")
    return one.select(
        "img_id", "entity", "fact_key", "head", "relation", "slug", "tail", "tail_type", "normalized_value",
        F.col("profile.askability").alias("askability"), F.col("profile.lexicalizability").alias("lexicalizability"), F.col("first_ord").alias("ord"),
    )


def nodes(entities: DataFrame, resolved: DataFrame) -> DataFrame:
    """(img_id, key, ntype); attributes of repeats come from the first."""
    own = regions(entities)
    image = own.select("img_id", F.lit("__full_image__").alias("key"), F.lit("full_image").alias("ntype"))
    places = own.select("img_id", F.col("region").alias("key"), F.lit("region").alias("ntype"))
    names = own.select("img_id", F.col("entity").alias("key"), F.lit("entity").alias("ntype"))
    bridges = resolved.select("img_id", F.col("entity").alias("key"), F.lit("entity").alias("ntype"))
    facts = resolved.select("img_id", F.col("fact_key").alias("key"), F.lit("fact").alias("ntype"))
    return image.unionByName(places).unionByName(names).unionByName(bridges).unionByName(facts).distinct()


def edges(entities: DataFrame, retrieved: DataFrame) -> DataFrame:
    """(img_id, src, dst, etype)."""
    own = regions(entities)
    observe = own.select("img_id", F.lit("__full_image__").alias("src"), F.col("region").alias("dst"), F.lit("observe").alias("etype"))
    resolve = own.select("img_id", F.col("region").alias("src"), F.col("entity").alias("dst"), F.lit("resolve").alias("etype"))
    retrieve = retrieved.select("img_id", F.col("entity").alias("src"), F.col("fact_key").alias("dst"), F.lit("retrieve").alias("etype"))
    return observe.unionByName(resolve).unionByName(retrieve).distinct()


def _askable() -> Column:
    return ~F.col("slug").isin(*rules.LOW_VALUE_RELATIONS) & (F.col("profile.askability") > 0)


def stats(entities: DataFrame, resolved: DataFrame) -> DataFrame:
    """Node and edge counts of every image; kinds that don't occur count 0.

    Each triple is read once: it gives its entity, its fact and, if it is worth asking about, the edge between them.
    """
    item = lambda kind, *key: F.struct(F.lit(kind).alias("kind"), F.array(*key).alias("key"))
    whole = F.lit("__full_image__")
    own = [item("n_full_image", whole), item("n_region", "region"), item("n_entity", "entity"), item("e_observe", "region"), item("e_resolve", "region", "entity")]
    told = [item("n_entity", "entity"), item("n_fact", "fact_key"), F.when(_askable(), item("e_retrieve", "entity", "fact_key"))]
    rows = regions(entities).select("img_id", F.explode(F.array(*own)).alias("x")).unionByName(resolved.select("img_id", F.explode(F.array(*told)).alias("x")))
    kinds = ("n_full_image", "n_region", "n_entity", "n_fact", "e_observe", "e_resolve", "e_retrieve")
    one = rows.filter(F.col("x").isNotNull()).select("img_id", "x.kind", "x.key").distinct()
    return one.groupBy("img_id").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])


def ranked_edges(retrieved: DataFrame) -> DataFrame:
    """Edges of an entity by askability, ties in order."""
    w = Window.partitionBy("img_id", "entity").orderBy(F.desc("askability"), "ord")
    return retrieved.withColumn("place", F.row_number().over(w))


def region_edges(entities: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Ranked edges of the entity behind every region."""
    own = regions(entities).select("img_id", "entity", "region", F.col("ord").alias("region_ord"), "etype", "confidence", "location")
    return own.join(ranked_edges(retrieved), ["img_id", "entity"])


def comparable_pairs(by_region: DataFrame, kind: str) -> DataFrame:
    """Pairs of edges of two regions, of one tail type and compatible relations.

    Relations are compatible if they are equal, of one bucket, or share a word, the first of these that holds; so edges meet
    on each of the three, and a pair counts only where it meets on its first. The edges are stored first, as both sides read
    them.
    """
    some = by_region.filter((F.col("tail_type") == kind) & (F.col("relation") != ""))
    bucket = rules.value_bucket(F.col("relation"), F.lit(kind))
    some = cut(some.withColumns({"bucket": F.when(~bucket.endswith("other"), bucket), "words": F.array_sort(rules.relation_tokens(F.col("relation")))}))
    key = lambda rank, c: F.struct(F.lit(rank).alias("rank"), c.alias("value"))
    keys = F.concat(F.array(key(1, F.col("relation")), key(2, F.col("bucket"))), F.transform("words", lambda w: key(3, w)))
    keyed = some.withColumn("key", F.explode(F.filter(keys, lambda k: k["value"].isNotNull())))
    columns = ["region", "region_ord", "fact_key", "relation", "normalized_value", "place", "bucket", "words"]
    side = lambda s: keyed.select("img_id", "key.rank", "key.value", *[F.col(c).alias(f"{s}_{c}") for c in columns])
    pairs = side("a").join(side("b"), ["img_id", "rank", "value"]).filter("a_region_ord < b_region_ord")
    other = F.col("a_relation") != F.col("b_relation")
    apart = F.coalesce(F.col("a_bucket") != F.col("b_bucket"), F.lit(True))
    first_word = F.get(F.array_intersect("a_words", "b_words"), F.lit(0))
    here = F.when(F.col("rank") == 1, True).when(F.col("rank") == 2, other).otherwise(other & apart & (F.col("value") == first_word))
    score = F.when(F.col("rank") == 1, 1.0).when(F.col("rank") == 2, 0.6).otherwise(0.3)
    label = F.when(F.col("rank") == 1, F.col("a_relation")).otherwise(F.lit("time_attribute" if kind == "TIME" else "quantity_attribute"))
    return pairs.filter(here).withColumns({"score": score, "bucket": label}).drop("rank", "value", "a_bucket", "b_bucket", "a_words", "b_words")


def value_differences(pairs: DataFrame) -> DataFrame:
    """Comparable pairs of two numbers with their difference."""
    a, b = F.col("a_normalized_value.num"), F.col("b_normalized_value.num")
    return pairs.filter(a.isNotNull() & b.isNotNull()).withColumn("difference", a - b)


def rankable_groups(by_region: DataFrame, kind: str, min_size: int = 3) -> DataFrame:
    """Best edge of each region per relation bucket, in buckets that ``min_size`` regions share."""
    some = by_region.filter(F.col("tail_type") == kind).withColumn("bucket", rules.value_bucket(F.col("relation"), F.lit(kind)))
    some = some.filter(~F.col("bucket").endswith("other"))
    best = first_wins(some, ["img_id", "bucket", "region"], [F.desc("askability"), "place"])
    n = F.count(F.lit(1)).over(Window.partitionBy("img_id", "bucket"))
    return best.withColumn("n_regions", n).filter(F.col("n_regions") >= min_size)


def shared_facts(retrieved: DataFrame, by_value: bool = False) -> DataFrame:
    """Pairs of entities of an image with an edge to the same fact; ``by_value`` compares relation and tail instead of the
    fact's key, which holds its head."""
    key = F.concat("slug", F.lit(":"), F.lower("tail")) if by_value else F.col("fact_key")
    some = retrieved.select("img_id", "entity", key.alias("target")).distinct()
    a, b = some.withColumnRenamed("entity", "a_entity"), some.withColumnRenamed("entity", "b_entity")
    return a.join(b, ["img_id", "target"]).filter("a_entity < b_entity")


def mergeable_relations(retrieved: DataFrame) -> DataFrame:
    """Pairs of different relations of an image that mean the same, which is those of one bucket; equal ones are one row."""
    some = retrieved.select("img_id", "slug").distinct().withColumn("bucket", rules.set_merge_bucket(F.col("slug")))
    some = some.filter(F.col("bucket").isNotNull())
    a, b = some.withColumnRenamed("slug", "a_slug"), some.withColumnRenamed("slug", "b_slug")
    return a.join(b, ["img_id", "bucket"]).filter("a_slug < b_slug")


def region_scores(entities: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Score and visual descriptor of every region."""
    per = retrieved.groupBy("img_id", "entity").agg(F.count(F.lit(1)).alias("degree"), F.array_sort(F.collect_set("slug")).alias("slugs"))
    both = regions(entities).join(per, ["img_id", "entity"], "left")
    degree = F.coalesce("degree", F.lit(0).cast("bigint"))
    none = F.expr("cast(array() as array<string>)")
    score = rules.region_score(F.col("confidence"), degree, F.col("etype"), F.col("location"))
    look = rules.visual_descriptor(F.col("etype"), F.coalesce("slugs", none), F.col("location"))
    return both.select("img_id", "region", degree.alias("degree"), score.alias("score"), look.alias("descriptor"))


def k_hops(edge: DataFrame, start: DataFrame, hops: int) -> DataFrame:
    """(img_id, origin, key, hop): nodes within ``hops`` steps of the ``start(img_id, key)`` nodes, at their least distance."""
    reached = start.select("img_id", F.col("key").alias("origin"), "key", F.lit(0).alias("hop"))
    front, step = reached, cut(edge).select("img_id", F.col("src").alias("key"), F.col("dst").alias("next"))
    for k in range(1, hops + 1):
        front = front.join(step, ["img_id", "key"]).select("img_id", "origin", F.col("next").alias("key"), F.lit(k).alias("hop")).distinct()
        front = front.join(reached, ["img_id", "origin", "key"], "left_anti")
        reached = reached.unionByName(front)
    return reached


def context_text(entities: DataFrame, triples: DataFrame, descriptions: DataFrame) -> DataFrame:
    """The graph of every image as text: entities, triples by head in order of appearance, spatial details, description."""
    b = "bbox"
    box = F.concat(F.lit("["), F.concat_ws(", ", *[F.col(f"{b}.{k}").cast("string") for k in ("x1", "y1", "x2", "y2")]), F.lit("]"))
    w, h = F.col(f"{b}.x2") - F.col(f"{b}.x1"), F.col(f"{b}.y2") - F.col(f"{b}.y1")
    cx, cy = F.floor((F.col(f"{b}.x1") + F.col(f"{b}.x2")) / 2), F.floor((F.col(f"{b}.y1") + F.col(f"{b}.y2")) / 2)
    one = F.concat(F.lit("  - "), "name", F.lit(KIND_LABEL), "etype", F.lit(AT_LABEL), "location", F.lit(BOX_LABEL), box)
    detail = F.concat(F.lit("  "), "name", F.lit(CENTRE_LABEL), cx, F.lit(","), cy, F.lit(SIZE_LABEL), w, F.lit("×"), h, F.lit(AREA_LABEL), w * h, F.lit(AREA_END))
    lines = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o1", "o2", c))), lambda x: x["line"]), "\n")
    listed = entities.select("img_id", F.col("ord").alias("o1"), F.lit(0).alias("o2"), one.alias("line"), detail.alias("detail"))
    part_e = listed.groupBy("img_id").agg(lines("line").alias("names"), lines(F.col("detail").alias("line")).alias("details"), F.count(F.lit(1)).alias("n_e"))
    nv = F.col("normalized_value")
    zero = F.coalesce(nv["num"] == 0, F.lit(False))
    value = F.when((nv["raw"] == "") | zero, "").otherwise(F.concat(F.lit(" ("), nv["raw"], F.lit(" "), F.coalesce("unit", F.lit("")), F.lit(")")))
    line = F.concat(F.lit("  "), "head", F.lit(" —["), "relation", F.lit("]→ "), "tail", F.lit(" ["), "tail_type", F.lit("]"), value)
    first = F.min("ord").over(Window.partitionBy("img_id", "head"))
    facts = triples.select("img_id", first.alias("o1"), F.col("ord").alias("o2"), line.alias("line"))
    part_t = facts.groupBy("img_id").agg(lines("line").alias("facts"), F.count(F.lit(1)).alias("n_t"))
    both = part_e.join(part_t, "img_id", "left").join(descriptions, "img_id", "left")
    head_t = F.concat(F.lit(FACTS_LABEL), F.coalesce("n_t", F.lit(0)).cast("string"), F.lit(FACTS_END))
    space = F.when(F.col("n_e") >= 2, F.concat(F.lit(SPACE_LABEL), "details"))
    about = F.concat(F.lit(ABOUT_LABEL), F.substring(F.coalesce("description", F.lit("")), 1, 300))
    return both.select("img_id", F.concat_ws("\n", F.lit(NAMES_LABEL), "names", head_t, "facts", space, about).alias("context"))
