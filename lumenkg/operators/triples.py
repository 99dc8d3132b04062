"""Triples: cleaning, name normalisation, aliases, merging and the spatial fallback."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenkg.functions.strings import name_key, scalar_value, tail_type, trimmed, unit
from lumenkg.operators.relational import first_wins, top_per, unordered_key


def _lower_key() -> list:
    return [F.col("img_id"), F.lower("head"), F.lower("relation"), F.lower("tail")]


def sanitised(raw: DataFrame) -> DataFrame:
    """Triples with a known tail type, a typed scalar and a trimmed unit."""
    value = scalar_value(F.col("normalized_value"))
    return raw.withColumns({"tail_type": tail_type(F.col("tail_type")), "normalized_value": value, "unit": unit(F.col("unit"))})


def normalised(triples: DataFrame, entities: DataFrame) -> DataFrame:
    """Heads and tails become the longest entity name (three characters or more) of their image that contains them or is
    contained in them, of equally long ones the first, by order and then by text; a blank end is contained in any name. Then
    self loops, blank ends and repeats go."""
    names = entities.select("img_id", F.col("ord").alias("name_ord"), trimmed(F.col("name")).alias("canon")).filter(F.length("canon") >= 3)
    ends = triples.select("img_id", F.explode(F.array(trimmed(F.col("head")), trimmed(F.col("tail")))).alias("given")).distinct()
    met = ends.join(names, "img_id")
    met = met.filter(F.lower("given").contains(F.lower("canon")) | F.lower("canon").contains(F.lower("given")))
    best = met.groupBy("img_id", "given").agg(F.min_by("canon", F.struct(-F.length("canon"), "name_ord", "canon")).alias("canon"))
    out = triples
    for end in ("head", "tail"):
        side = best.select("img_id", F.col("given").alias("_given"), F.col("canon").alias("_canon"))
        out = out.withColumn("_end", trimmed(F.col(end))).join(side.withColumnRenamed("img_id", "_img"), (F.col("img_id") == F.col("_img")) & (F.col("_end") == F.col("_given")), "left")
        out = out.withColumn(end, F.coalesce("_canon", "_end")).drop("_img", "_given", "_canon", "_end")
    sound = (F.col("head") != "") & (F.col("tail") != "") & (F.lower("head") != F.lower("tail"))
    return first_wins(out.filter(sound), _lower_key(), ["ord"])


def valid_aliases(groups: DataFrame, candidates: DataFrame) -> DataFrame:
    """(img_id, alias, canonical): both names are candidates and differ; the last group that names an alias decides."""
    names = candidates.select("img_id", "name").distinct()
    groups = groups.withColumns({c: trimmed(F.col(c)) for c in ("alias", "canonical")}).filter("alias <> '' and canonical <> ''")
    known = groups.filter(F.col("alias") != F.col("canonical"))
    known = known.join(names.withColumnRenamed("name", "alias"), ["img_id", "alias"], "left_semi")
    known = known.join(names.withColumnRenamed("name", "canonical"), ["img_id", "canonical"], "left_semi")
    return known.groupBy("img_id", "alias").agg(F.max_by("canonical", F.struct("group_ord", "canonical")).alias("canonical"))


def closed_aliases(aliases: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``aliases(img_id, alias, canonical)`` with chains followed to their end: A to B and B to C gives A to C.

    Names that lead into a cycle go to the least name of it in code-point order, which itself is no alias any more. Each round
    doubles the reach of all names at once, so an image with n aliases takes log2(n) rounds; ``cut`` stores a round's rows.
    """
    most = aliases.groupBy("img_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    # ``seen`` is the least name met on the way; within a cycle, a way longer than it meets them all
    reach = aliases.select("img_id", "alias", F.col("canonical").alias("end"), F.col("canonical").alias("seen"))
    for _ in range(max(most, 1).bit_length()):
        reach = cut(reach)
        ahead = reach.select("img_id", F.col("alias").alias("end"), F.col("end").alias("_end"), F.col("seen").alias("_seen"))
        reach = reach.join(ahead, ["img_id", "end"], "left").select("img_id", "alias", F.coalesce("_end", "end").alias("end"), F.least("seen", "_seen").alias("seen"))
    reach = cut(reach)
    turning = reach.select("img_id", F.col("alias").alias("end"), F.col("seen").alias("_least"))  # ends that are aliases lie in a cycle
    told = reach.join(turning, ["img_id", "end"], "left").select("img_id", "alias", F.coalesce("_least", "end").alias("canonical"))
    return told.filter("alias <> canonical")


def aliased(triples: DataFrame, aliases: DataFrame) -> DataFrame:
    """Trimmed heads and tails replaced once by their canonical name; blank ends, self loops and repeats go."""
    out = triples.withColumns({c: trimmed(F.col(c)) for c in ("head", "tail")})
    for end in ("head", "tail"):
        side = aliases.select("img_id", F.col("alias").alias(end), F.col("canonical").alias(f"_{end}"))
        out = out.join(side, ["img_id", end], "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")
    sound = (F.col("head") != "") & (F.col("tail") != "") & (F.lower("head") != F.lower("tail"))
    return first_wins(out.filter(sound), _lower_key(), ["ord"])


def entities_without_aliases(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    return entities.join(aliases.select("img_id", F.col("alias").alias("name")), ["img_id", "name"], "left_anti")


def alias_candidates(entities: DataFrame, triples: DataFrame) -> DataFrame:
    """Distinct names of an image that could be aliases: 2 to 80 characters, not a mere number."""
    ends = triples.select("img_id", F.explode(F.array("head", "tail")).alias("name"))
    names = entities.select("img_id", "name").unionByName(ends).select("img_id", trimmed(F.col("name")).alias("name")).distinct()
    digits = F.translate("name", ",.% ", "")
    return names.filter(F.length("name").between(2, 80) & ~digits.rlike("^[0-9]+$"))


def merged(existing: DataFrame, new: DataFrame, strip: bool = False) -> DataFrame:
    """``existing`` plus the new triples whose key it doesn't hold, the first of each, in their order behind the last
    existing one of their image; so no order number is used twice in an image.

    ``strip`` compares trimmed names and drops blank ends and self loops first.
    """
    if strip:
        new = new.withColumns({c: trimmed(F.col(c)) for c in ("head", "relation", "tail")})
        new = new.filter((F.col("head") != "") & (F.col("tail") != "") & (F.lower("head") != F.lower("tail")))
    lower = lambda df: df.select("img_id", *[F.lower(c).alias(f"_{c}") for c in ("head", "relation", "tail")])
    fresh = first_wins(new, _lower_key(), ["ord"])
    fresh = fresh.withColumns({f"_{c}": F.lower(c) for c in ("head", "relation", "tail")})
    fresh = fresh.join(lower(existing), ["img_id", "_head", "_relation", "_tail"], "left_anti").select(*new.columns)
    last = existing.groupBy("img_id").agg((F.max("ord") + 1).alias("_last"))
    nth = F.row_number().over(Window.partitionBy("img_id").orderBy("ord", F.lower("head"), F.lower("relation"), F.lower("tail"))) - 1
    placed = fresh.withColumn("_nth", nth).join(last, "img_id", "left").withColumn("ord", F.coalesce("_last", F.lit(0)).cast("long") + F.col("_nth"))
    return existing.unionByName(placed.select(*new.columns), allowMissingColumns=True)


def tail_counts(triples: DataFrame, known_names: DataFrame | None = None, k: int = 6) -> DataFrame:
    """The ``k`` most frequent tails of an image (three characters or more), ties by first appearance, without known names."""
    tails = triples.withColumn("tail", trimmed(F.col("tail"))).filter(F.length("tail") >= 3)
    if known_names is not None:
        known = known_names.select("img_id", name_key(F.col("name")).alias("_key"))
        tails = tails.withColumn("_key", F.lower("tail")).join(known, ["img_id", "_key"], "left_anti")
    counted = tails.groupBy("img_id", "tail").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))
    return top_per(counted, ["img_id"], [F.desc("n"), "first_ord"], k, "rank")


def tail_context(top: DataFrame, triples: DataFrame, k: int = 3) -> DataFrame:
    """The first ``k`` triples behind each selected tail, as text."""
    named = triples.withColumn("tail", trimmed(F.col("tail")))
    behind = top_per(named.join(top.select("img_id", "tail"), ["img_id", "tail"], "left_semi"), ["img_id", "tail"], ["ord"], k, "nth")
    line = F.concat("head", F.lit(" "), "relation", F.lit(" "), "tail")
    listed = F.array_sort(F.collect_list(F.struct("nth", line.alias("t"))))
    return behind.groupBy("img_id", "tail").agg(F.array_join(F.transform(listed, lambda x: x["t"]), "; ").alias("context"))


def connected_pairs(triples: DataFrame) -> DataFrame:
    a, b = name_key(F.col("head")), name_key(F.col("tail"))
    return triples.select("img_id", *unordered_key(a, b)).distinct()


def unconnected_pairs(entities: DataFrame, triples: DataFrame) -> DataFrame:
    """Pairs of entities of an image that no triple joins in either direction."""
    e = entities.withColumn("key", name_key(F.col("name")))
    a = e.select("img_id", F.col("ord").alias("a_ord"), F.col("key").alias("a_key"), F.col("name").alias("a_name"))
    b = e.select("img_id", F.col("ord").alias("b_ord"), F.col("key").alias("b_key"), F.col("name").alias("b_name"))
    pairs = a.join(b, "img_id").filter("a_ord < b_ord")
    pairs = pairs.select("*", *unordered_key(F.col("a_key"), F.col("b_key")))
    return pairs.join(connected_pairs(triples), ["img_id", "pair_lo", "pair_hi"], "left_anti")


def spatial_fallback(spatial: DataFrame, triples: DataFrame) -> DataFrame:
    """Spatial triples of pairs that no triple joins, the first of each pair and of each key."""
    a, b = name_key(F.col("head")), name_key(F.col("tail"))
    keyed = spatial.select("*", *unordered_key(a, b))
    loose = keyed.join(connected_pairs(triples), ["img_id", "pair_lo", "pair_hi"], "left_anti")
    one = first_wins(loose, ["img_id", "pair_lo", "pair_hi"], ["a_idx", "b_idx"])
    return one.select("img_id", "a_idx", "b_idx", "head", "relation", "tail", F.lit("spatial").alias("source"))


def triples_by_head(triples: DataFrame) -> DataFrame:
    """Triples of each head in order; heads by first appearance."""
    step = F.struct("ord", "relation", "tail")
    grouped = triples.groupBy("img_id", "head").agg(F.min("ord").alias("first_ord"), F.array_sort(F.collect_list(step)).alias("items"))
    place = F.row_number().over(Window.partitionBy("img_id").orderBy("first_ord"))
    return grouped.withColumn("place", place)


def tail_queries(tails: DataFrame) -> DataFrame:
    """(img_id, tail, pos, query, origin) of ``tails(img_id, tail, rewritten, skip)``: the exact name, then the model's query
    unless it is the same but for case; skipped and blank ones go."""
    live = tails.filter(~F.coalesce("skip", F.lit(False))).withColumn("name", trimmed(F.coalesce("tail", F.lit(""))))
    row = lambda q, origin: F.struct(q.alias("query"), F.lit(origin).alias("origin"))
    both = F.array(row(F.col("name"), "text_exact"), row(F.coalesce("rewritten", F.lit("")), "text_rewrite"))
    fresh = F.filter(both, lambda x: (x["query"] != "") & ((x["origin"] == "text_exact") | (F.lower(x["query"]) != F.lower("name"))))
    return live.select("img_id", "tail", F.posexplode(fresh).alias("pos", "x")).select("img_id", "tail", "pos", "x.*")


def known_names_text(triples: DataFrame) -> DataFrame:
    """(img_id, names): all distinct heads and tails of an image in order, as one text."""
    ends = triples.select("img_id", F.explode(F.array("head", "tail")).alias("name"))
    return ends.groupBy("img_id").agg(F.array_join(F.array_sort(F.collect_set("name")), ", ").alias("names"))
