"""Named queries of the knowledge-graph engine and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenkg.functions import rules
from lumenkg.functions import strings as s
from lumenkg.operators import chains as ch
from lumenkg.operators import entities as en
from lumenkg.operators import evidence as ev
from lumenkg.operators import graph as gr
from lumenkg.operators import lookup
from lumenkg.operators import outcomes as oc
from lumenkg.operators import questions as qu
from lumenkg.operators import triples as tr
from lumenkg.operators.expansion import expand
from lumenkg.operators.relational import cut, numbered, top_per
from lumenkg.plans import jobs
from lumenkg.plans.fixtures import view
from lumenkg.plans.oracles import ORACLES
from lumenkg.sources import files, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    return en.kept_entities(view(spark, sf, "geo_raw"))


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    raw = view(spark, sf, "kg_triples_raw")
    return tr.sanitised(raw.withColumns({"head": s.trimmed(F.col("head")), "tail": s.trimmed(F.col("tail"))}))


def _normal(spark: SparkSession, sf: str) -> DataFrame:
    return tr.normalised(_clean(spark, sf), view(spark, sf, "kg_ent"))


def _flat(triples: DataFrame) -> DataFrame:
    nv = [F.col(f"normalized_value.{c}").alias(f"nv_{c}") for c in ("raw", "num", "kind")]
    return triples.select("img_id", "ord", "head", "relation", "tail", "tail_type", *nv, "unit")


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    return gr.resolved_triples(view(spark, sf, "kg_ent"), _normal(spark, sf))


def _by_region(spark: SparkSession, sf: str) -> DataFrame:
    return gr.region_edges(view(spark, sf, "kg_ent"), gr.retrieve_edges(_resolved(spark, sf)))


def _aliases(spark: SparkSession, sf: str) -> DataFrame:
    return tr.valid_aliases(view(spark, sf, "alias_groups"), tr.alias_candidates(view(spark, sf, "kg_ent"), _clean(spark, sf)))


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "tool_rows")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "tool"))), lambda x: x["tool"])
    return qu.classified(rows.groupBy("img_id").agg(listed.alias("tools"))).withColumn("day", F.split_part("img_id", F.lit("_"), F.lit(2)))


def _numbered(spark: SparkSession, sf: str) -> DataFrame:
    rows = _questions(spark, sf).withColumns({"user": F.col("img_id"), "ord": F.col("img_id")}).withColumn("img_id", F.col("day"))
    return qu.numbered(rows)


@query
def entities_kept(spark, sf):
    return _kept(spark, sf).select("img_id", "ord", "id", "name", "etype", "bbox.*")


@query
def entity_location(spark, sf):
    return en.located(_kept(spark, sf)).select("img_id", "id", "location")


@query
def entity_values(spark, sf):
    tail = F.when(F.col("rx1") % 3 == 0, "kg").when(F.col("rx1") % 3 == 1, " GHz").otherwise("x")
    name = F.concat("name", F.lit(" "), "rx1", tail, F.lit(" $"), "ry1", F.lit(".5"))
    return en.with_values(view(spark, sf, "geo_raw").withColumn("name", name)).select("img_id", "ord", "value", "numbers")


@query
def entity_views(spark, sf):
    return en.views(_kept(spark, sf))


@query
def bbox_areas(spark, sf):
    return en.box_areas(_kept(spark, sf))


@query
def layout_relations(spark, sf):
    return en.layout_relations(_kept(spark, sf))


@query
def direction_8way(spark, sf):
    return en.compass_relations(_kept(spark, sf))


@query
def area_extremum(spark, sf):
    return en.area_extremes(_kept(spark, sf))


@query
def spatial_triples(spark, sf):
    return en.spatial_triples(_kept(spark, sf))


@query
def domain_guess(spark, sf):
    return en.image_domains(_kept(spark, sf))


@query
def core_anchors(spark, sf):
    return en.core_anchors(_kept(spark, sf)).select("img_id", "id", "name", "confidence")


@query
def expansion_seeds(spark, sf):
    """Every third image holds generic objects alone."""
    raw = view(spark, sf, "geo_raw")
    plain = F.array(*map(F.lit, ("car", "Tree", " sky ", "Wall", "door", "sign", "floor", "person")))[F.col("ord")]
    generic = F.substring("img_id", 5, 9).cast("long") % 3 == 0
    raw = raw.withColumns({"name": F.when(generic, plain).otherwise(F.col("name")), "etype": F.when(generic, "object").otherwise(F.col("etype"))})
    return en.expansion_seeds(en.kept_entities(raw)).select("img_id", "id", "name", "rank")


def _marked(seeds: DataFrame) -> DataFrame:
    """Seeds with a source and a level, as the gate of the search budget reads them."""
    source = F.when(F.col("idx") % 3 == 0, "proposal").when(F.col("idx") % 3 == 1, "vlm_only").otherwise("")
    return seeds.withColumns({"source": source, "level": F.lower("level")})


@query
def tier1_brand_dense(spark, sf):
    """Images of forty entities, behind the gate."""
    seeds = en.expansion_seeds(en.kept_entities(view(spark, sf, "geo_wide")))
    return en.brand_dense_top(en.promoted(_marked(seeds))).select("img_id", "id", "score", "place")


@query
def pairs_capped(spark, sf):
    return en.capped_pairs(_kept(spark, sf)).select("img_id", "a_rank", "b_rank", "a_name", "b_name")


@query
def triples_sanitized(spark, sf):
    return _flat(_clean(spark, sf))


@query
def triples_normalized(spark, sf):
    return _flat(_normal(spark, sf))


@query
def alias_candidates(spark, sf):
    return tr.alias_candidates(view(spark, sf, "kg_ent"), _clean(spark, sf))


@query
def triples_aliased(spark, sf):
    return _flat(tr.aliased(_clean(spark, sf), _aliases(spark, sf)))


@query
def entities_after_alias(spark, sf):
    return tr.entities_without_aliases(view(spark, sf, "kg_ent"), _aliases(spark, sf)).select("img_id", "ord", "name")


_TRIPLE = ("img_id", "ord", "head", "relation", "tail")


@query
def expand_merge(spark, sf):
    old = _normal(spark, sf).filter("ord % 10 <= 4").select(*_TRIPLE)
    return tr.merged(old, _clean(spark, sf).filter("ord % 10 >= 3").select(*_TRIPLE))


@query
def cross_merge(spark, sf):
    old = _normal(spark, sf).filter("ord % 10 <= 4").select(*_TRIPLE)
    new = _clean(spark, sf).filter("ord % 10 >= 3").withColumn("relation", F.upper("relation")).select(*_TRIPLE)
    return tr.merged(old, new, strip=True)


@query
def tail_topk(spark, sf):
    return tr.tail_counts(_clean(spark, sf), view(spark, sf, "kg_ent")).select("img_id", "tail", "n", "rank")


@query
def tail_context(spark, sf):
    clean = _clean(spark, sf)
    return tr.tail_context(tr.tail_counts(clean), clean)


@query
def unconnected_pairs(spark, sf):
    return tr.unconnected_pairs(view(spark, sf, "kg_ent"), _normal(spark, sf)).select("img_id", "a_name", "b_name")


@query
def spatial_fallback(spark, sf):
    spatial = en.spatial_triples(_kept(spark, sf))
    return tr.spatial_fallback(spatial, spatial.filter("(a_idx + b_idx) % 3 = 0"))


@query
def triples_by_head(spark, sf):
    return tr.triples_by_head(_clean(spark, sf)).select("img_id", "head", F.size("items").cast("bigint").alias("n"), "place")


@query
def plainly_worded(spark, sf):
    """Questions put together from the rules' own phrases; every third asks in the graph's words."""
    rel, kind = s.slug(F.col("relation")), F.col("kind")
    rows = gr.with_rules(view(spark, sf, "rel_rows").select("event_id", "relation", "kind"), ["relation", "kind"], clause=rules.follow_clause(rel, kind))
    asked = F.when(F.col("event_id") % 3 == 0, F.concat("clause", F.array(*map(F.lit, rules.GRAPH_WORDING))[(F.col("event_id") % 6).cast("int")])).otherwise(F.col("clause"))
    return qu.plainly_worded(rows.select("event_id", asked.alias("question")))


@query
def relation_profile(spark, sf):
    rows = view(spark, sf, "rel_rows").select("event_id", "relation", "kind")
    return gr.with_rules(rows, ["relation", "kind"], p=rules.relation_profile(F.col("relation"), F.col("kind"))).select("event_id", "p.*")


@query
def relation_texts(spark, sf):
    rel, kind = s.slug(F.col("relation")), F.col("kind")
    told = {
        "natural_text": rules.natural_text(rel, kind), "follow_clause": rules.follow_clause(rel, kind), "answer_prompt": rules.answer_prompt(kind),
        "selection_phrase": rules.selection_phrase(rel, kind), "question_value": rules.question_value(rel, kind),
    }
    return gr.with_rules(view(spark, sf, "rel_rows").select("event_id", "relation", "kind"), ["relation", "kind"], **told).drop("relation", "kind")


@query
def value_bucket(spark, sf):
    return view(spark, sf, "rel_rows").select("event_id", rules.value_bucket(F.col("relation"), F.col("kind")).alias("bucket"))


@query
def answer_scores(spark, sf):
    a, k = F.col("answer"), F.col("kind")
    return view(spark, sf, "answer_rows").select("event_id", rules.answer_specificity(a, k).alias("specificity"), rules.answer_penalty(a, k).alias("penalty"))


@query
def graph_nodes(spark, sf):
    return gr.nodes(view(spark, sf, "kg_ent"), _resolved(spark, sf))


@query
def graph_edges(spark, sf):
    return gr.edges(view(spark, sf, "kg_ent"), gr.retrieve_edges(_resolved(spark, sf)))


@query
def graph_stats(spark, sf):
    return gr.stats(view(spark, sf, "kg_ent"), _resolved(spark, sf))


@query
def retrieve_edges_ranked(spark, sf):
    ranked = gr.ranked_edges(gr.retrieve_edges(_resolved(spark, sf)))
    return ranked.select("img_id", "entity", "fact_key", "place", "askability", "lexicalizability")


@query
def comparable_pairs(spark, sf):
    return gr.comparable_pairs(_by_region(spark, sf), "TIME").select("img_id", "a_region", "b_region", "a_fact_key", "b_fact_key", "score", "bucket")


@query
def comparable_quantities(spark, sf):
    pairs = gr.value_differences(gr.comparable_pairs(_by_region(spark, sf), "QUANTITY"))
    return pairs.select("img_id", "a_region", "b_region", "difference", "score")


@query
def rankable_groups(spark, sf):
    return gr.rankable_groups(_by_region(spark, sf), "TIME").select("img_id", "bucket", "region", "fact_key", "n_regions")


@query
def shared_fact_strict(spark, sf):
    return gr.shared_facts(gr.retrieve_edges(_resolved(spark, sf)))


@query
def shared_fact_by_value(spark, sf):
    return gr.shared_facts(gr.retrieve_edges(_resolved(spark, sf)), by_value=True)


@query
def set_merge_compat(spark, sf):
    rows = view(spark, sf, "rel_rows").select(F.floor(F.col("event_id") / 100).alias("img_id"), s.slug(F.col("relation")).alias("slug"))
    return gr.mergeable_relations(rows).withColumnRenamed("img_id", "grp")


@query
def region_scores(spark, sf):
    return gr.region_scores(view(spark, sf, "kg_ent"), gr.retrieve_edges(_resolved(spark, sf)))


@query
def k_hop_facts(spark, sf):
    start = view(spark, sf, "kg_ent").select("img_id", F.lit("__full_image__").alias("key")).distinct()
    return gr.k_hops(graph_edges(spark, sf), start, 3).select("img_id", "key", "hop")


@query
def graph_context_text(spark, sf):
    named = view(spark, sf, "kg_ent").withColumn("bbox", F.struct("x1", "y1", "x2", "y2"))
    about = named.select("img_id", F.concat(F.lit("picture "), "img_id").alias("description")).distinct()
    return gr.context_text(named, _clean(spark, sf), about)


@query
def skip_domains(spark, sf):
    return ev.readable(view(spark, sf, "page_rows")).select("page_id", "url")


@query
def url_netloc(spark, sf):
    return view(spark, sf, "page_rows").select("page_id", s.url_site(F.col("url")).alias("site"), s.title_head(F.col("title")).alias("head"))


@query
def deep_read_urls(spark, sf):
    rows = view(spark, sf, "page_rows")
    found = rows.select("topic", "page_id", F.col("page_id").alias("pos"), "url", F.col("html").alias("content"))
    return ev.deep_reads(found, None, ["topic"]).select("topic", "page_id", "nth", "page_text")


@query
def both_mentioned(spark, sf):
    word = lambda k: F.split_part("text", F.lit(" "), F.lit(k))
    names = view(spark, sf, "benchmark").select("item_id", word(3).alias("entity_a"), word(5).alias("entity_b"))
    return ev.mentions(view(spark, sf, "documents").select("doc_id", "text"), names)


@query
def visit_queue(spark, sf):
    kind = F.element_at(F.array(*map(F.lit, ("image", "web", "discovery", "lens"))), (F.col("page_id") % 4 + 1).cast("int"))
    rows = view(spark, sf, "page_rows").select(F.col("topic").alias("img_id"), kind.alias("origin"), (F.col("page_id") % 4).alias("origin_rank"), (F.col("page_id") % 5).alias("id"), F.col("page_id").alias("ord"), "url")
    return ev.visit_queue(rows).select(F.col("img_id").alias("topic"), F.col("ord").alias("page_id"), "origin", "place")


@query
def resolution_merge(spark, sf):
    rows = view(spark, sf, "page_rows").select(F.col("topic").alias("img_id"), F.lit("E1").alias("id"), F.col("page_id").alias("pos"), "url", "title", F.col("html").alias("content"))
    some = rows.select("img_id", "id").distinct()
    merged = ev.merged_resolution(some, rows.select("img_id", "id", "pos", "title"), rows)
    text = F.array_join(F.transform("pages", lambda p: F.concat_ws(" | ", p["url"], p["title"], p["preview"])), "\n")
    return merged.select(F.col("img_id").alias("topic"), "titles", F.size("pages").cast("bigint").alias("n_pages"), text.alias("pages"))


@query
def lens_flatten(spark, sf):
    raw = view(spark, sf, "page_rows").select(F.col("topic").alias("key"), F.col("page_id").alias("pos"), "title", "url")
    return ev.lens_titles(raw).select(F.col("key").alias("topic"), "title", "nth")


@query
def search_rows_flat(spark, sf):
    p = F.col("page_id")
    panel = F.when(p % 3 == 0, F.struct(F.concat(F.lit("panel "), p).alias("title"), F.lit("about").alias("description"), F.create_map(F.lit("k"), F.lit("v")).alias("attributes")))
    box = F.when(p % 2 == 0, F.struct(F.array(F.lit("yes"), F.lit("no")).alias("answer")))
    hit = F.struct(F.lit("t").alias("title"), F.col("url").alias("link"), F.lit("s").alias("snippet"))
    body = F.to_json(F.struct(panel.alias("knowledgeGraph"), box.alias("answerBox"), F.array(hit).alias("organic")))
    rows = ev.search_rows(view(spark, sf, "pages").select(p.alias("key"), body.alias("body")))
    return rows.select(F.col("key").alias("page_id"), "pos", "kind", "url", "content")


@query
def props_json(spark, sf):
    rows = view(spark, sf, "json_blobs").select("event_id", s.extract_json(F.col("raw")).alias("json"))
    return rows.filter(F.col("json").isNotNull())


@query
def question_classify(spark, sf):
    return _questions(spark, sf).select("img_id", F.size("tools").cast("bigint").alias("n_tools"), "category", "difficulty")


@query
def question_ids(spark, sf):
    return _numbered(spark, sf).select(F.col("user").alias("img_id"), "day", "question_id")


@query
def final_records(spark, sf):
    empty = F.lit(None).cast("string")
    rows = _numbered(spark, sf).withColumns({"question": empty, "answer": empty, "reasoning": empty})
    path = F.concat(F.lit("images/"), "img_id", F.lit(".jpg"))
    return qu.final_records(rows, path).select("id", "image_id", "image_path", "category", "question_id")


@query
def question_stats(spark, sf):
    return qu.question_stats(_questions(spark, sf).withColumn("img_id", F.col("day")))


@query
def image_metrics(spark, sf):
    return qu.image_metrics(_questions(spark, sf).withColumn("img_id", F.col("day")))


@query
def question_cube(spark, sf):
    return qu.breakdown(_questions(spark, sf))


@query
def run_summary(spark, sf):
    return qu.run_summary(view(spark, sf, "run_rows"))


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    key = s.cache_key("jina", url=F.col("url"), max_chars=F.lit(2000))
    return view(spark, sf, "pages").select("page_id", F.lit("jina").alias("api"), key.alias("key"), F.col("url").alias("payload"))


@query
def cache_key(spark, sf):
    return _requests(spark, sf).select("page_id", "key")


@query
def cache_misses(spark, sf):
    asked = _requests(spark, sf)
    stored = asked.filter("page_id % 2 = 0").select("api", "key", F.lit("ok").alias("status"))
    return lookup.misses(asked, stored).select("key", "payload")


@query
def sampled_per_group(spark, sf):
    rows = view(spark, sf, "pages").withColumn("topic", F.floor(F.col("page_id") / 25))
    return top_per(rows, ["topic"], ["url", "page_id"], 3).select("topic", "url")


@query
def pair_plan_queries(spark, sf):
    pairs = en.spatial_triples(_kept(spark, sf)).withColumnsRenamed({"head": "a_name", "tail": "b_name"})
    turn = (F.col("a_idx") + F.col("b_idx")) % 4
    listed = F.when(turn == 1, F.array(F.concat(F.lit("first "), "a_name"), F.lit("  "), F.concat(F.lit("second "), "b_name"))).otherwise(F.array(F.lit(" ")))
    old = pairs.select("img_id", F.col("b_name").alias("entity_a"), F.col("a_name").alias("entity_b"), F.lit(1).alias("ord"), F.lit(True).alias("skip"), F.array(F.lit("old")).alias("queries"))
    new = pairs.select("img_id", F.col("a_name").alias("entity_a"), F.col("b_name").alias("entity_b"), F.lit(2).alias("ord"), (turn == 2).alias("skip"), listed.alias("queries"))
    return ev.pair_queries(pairs, old.unionByName(new)).select("img_id", "a_name", "b_name", "pos", "query")


@query
def discovered_names(spark, sf):
    raw = view(spark, sf, "geo_raw").withColumn("pos", F.col("ord"))
    given = F.when(F.col("ord") % 3 == 0, F.concat(F.lit(" 《new "), "name", F.lit("》 "))).when(F.col("ord") % 3 == 1, F.col("name")).otherwise("x")
    cleaned = raw.select("img_id", "pos", given.alias("name"))
    return ev.discovered_names(raw.select("img_id", "pos"), cleaned, _kept(spark, sf)).select("img_id", "pos", "name", "id")


@query
def promoted_seeds(spark, sf):
    return en.promoted(_marked(en.expansion_seeds(_kept(spark, sf)))).select("img_id", "id", "name")


@query
def search_routes(spark, sf):
    return en.search_routes(_kept(spark, sf))


@query
def reverse_search_views(spark, sf):
    return en.reverse_search_views(_kept(spark, sf))


@query
def image_search_rows(spark, sf):
    p, none = F.col("page_id"), F.lit(None).cast("string")
    hit = lambda title, image, link, source: F.struct(title.alias("title"), image.alias("imageUrl"), link.alias("link"), source.alias("source"))
    first = hit(F.concat(F.lit("picture "), p), F.col("url"), F.when(p % 2 == 0, F.col("url")), F.lit("site"))
    images = F.when(p % 3 == 0, F.array(first, hit(none, none, F.lit("second"), none))).otherwise(F.array(first))
    rows = ev.image_rows(view(spark, sf, "pages").select(p.alias("key"), F.to_json(F.struct(images.alias("images"))).alias("body")))
    return rows.withColumnRenamed("key", "page_id")


@query
def tail_queries(spark, sf):
    turn = F.col("ord") % 4
    text = F.when(turn == 0, F.upper("tail")).when(turn == 1, F.concat("tail", F.lit(" history"))).when(turn == 2, "").otherwise("other")
    raw = view(spark, sf, "kg_triples_raw").select(F.struct("img_id", "ord").alias("img_id"), "tail", text.alias("rewritten"), (F.col("ord") % 7 == 0).alias("skip"))
    return tr.tail_queries(raw).select("img_id.*", "tail", "pos", "query", "origin")


@query
def known_names_text(spark, sf):
    return tr.known_names_text(_clean(spark, sf))


@query
def job_totals(spark, sf):
    return en.job_totals(view(spark, sf, "geo_raw"), view(spark, sf, "kg_triples_raw"), view(spark, sf, "pages"))


@query
def visit_queue_faithful(spark, sf):
    """Topics of 200 pages, so that the caps act; entities of up to twelve pages."""
    p = F.col("page_id") % 10
    kind = F.when(p < 4, "image").when(p < 8, "web").when(p == 8, "discovery").otherwise("lens")
    rank = F.when(p < 4, 0).when(p < 8, 1).when(p == 8, 2).otherwise(3)
    topic = F.floor(F.col("page_id") / 200)
    rows = view(spark, sf, "page_rows").select(topic.alias("img_id"), kind.alias("origin"), rank.alias("origin_rank"), F.floor(F.col("page_id") % 200 / 12).alias("id"), F.col("page_id").alias("ord"), "url")
    return ev.visit_queue(rows, faithful=True).select(F.col("img_id").alias("topic"), F.col("ord").alias("page_id"), "origin", "place")


@query
def aliases_closed(spark, sf):
    return tr.closed_aliases(view(spark, sf, "alias_links"), cut)


@query
def enrich_outcomes(spark, sf):
    number = F.substring("img_id", 5, 9).cast("long")
    images = view(spark, sf, "geo_raw").select("img_id").distinct().withColumn("width", F.when(number % 13 != 4, 1)).withColumn("height", F.lit(1))
    called = images.filter(number % 7 != 0)
    responses = called.select(F.lit("detect").alias("api"), F.col("img_id").alias("key"), F.when(number % 7 == 1, "TimeoutError").when(number % 11 == 5, "json_parse_failed").otherwise("ok").alias("status"))
    answers = responses.filter("status = 'ok'").select(F.col("key").alias("img_id"))
    detected = _kept(spark, sf)
    kept = en.enough_entities(detected, 7)
    documents = kept.join(answers, "img_id", "left_semi").groupBy("img_id").agg(F.collect_list("id").alias("entities"), F.collect_list("name").alias("triples"))
    waiting = kept.filter(number % 7 == 2).select("img_id").distinct()
    return oc.enrich_outcomes(images, responses, answers, detected, kept, documents, waiting).select("img_id", "stage", "status", "reason", "n_entities")


@query
def unfinished_images(spark, sf):
    images = view(spark, sf, "customer").select(F.concat(F.lit("img_"), "c_custkey").alias("img_id"))
    return oc.unfinished(images, view(spark, sf, "tries"))


@query
def image_results(spark, sf):
    return oc.image_results(view(spark, sf, "tries"))


@query
def outcome_counts(spark, sf):
    return oc.status_counts(view(spark, sf, "tries"))


def _bench(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "step1_error").otherwise("ok")
    return view(spark, sf, "orders").select(F.col("o_orderpriority").alias("folder"), F.col("o_orderkey").alias("img_id"), "o_custkey", status.alias("status"), (F.col("o_orderkey") % 10).alias("n_questions"))


@query
def bench_summary(spark, sf):
    return sinks.bench_summary(_bench(spark, sf))


@query
def bench_rows(spark, sf):
    """The first three images of each folder and customer, in the order that the summary lists them."""
    some = sinks.sorted_results(top_per(_bench(spark, sf), ["folder", "o_custkey"], ["img_id"], 3))
    return numbered(some.select("folder", "img_id", "status"), ["folder", "img_id"], "place")


@query
def attempt_trace(spark, sf):
    n = F.col("event_id") % 3
    told = F.when(F.col("event_id") % 2 == 0, "json_parse_failed").otherwise("call_error")
    step = lambda k: F.struct(k.cast("int").alias("attempt"), F.when(k <= n, told).otherwise("ok").alias("status"), F.when((k <= n) & (F.col("event_id") % 2 == 1), F.concat(F.lit("E"), k)).alias("error"), F.lit(None).cast("string").alias("preview"))
    rows = view(spark, sf, "events").select(F.lit("detect").alias("api"), F.col("event_id").alias("key"), F.transform(F.sequence(F.lit(1).cast("long"), n + 1), step).alias("trace"))
    return lookup.attempts(rows).select(F.col("key").alias("event_id"), "attempt", "status", "error")


@query
def good_images(spark, sf):
    rows = view(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("img_id"), (F.col("l_partkey") % 6).alias("a"), (F.col("l_suppkey") % 6).alias("b"), (F.col("l_linenumber") % 6).alias("c"), (F.col("l_quantity").cast("long") % 6).alias("d"))
    return files.good_images(rows, ["a", "b", "c", "d"], total=14)


@query
def sound_boxes(spark, sf):
    """Every seventh detection is moved to the right edge and beyond."""
    raw = view(spark, sf, "geo_raw")
    far = (F.col("rx1") + F.col("ord")) % 7 == 0
    raw = raw.withColumns({"rx1": F.when(far, F.col("rx1") % 50 + 980).otherwise(F.col("rx1")), "rx2": F.when(far, F.col("rx2") % 50 + 1000).otherwise(F.col("rx2"))})
    return en.boxes_flagged(en.kept_entities(raw)).select("img_id", "ord", "sound_box")


@query
def bounded_sizes(spark, sf):
    return view(spark, sf, "geo_raw").select("img_id", "ord", files.bounded_size(F.col("w") * 3, F.col("h") * 3).alias("s")).select("img_id", "ord", "s.*")


@query
def parsed_questions(spark, sf):
    e = F.col("event_id")
    asked = F.to_json(F.array(F.struct(F.concat(F.lit("What of "), e, F.lit("?")).alias("question"), F.col("event_type").alias("answer"), F.array(F.lit("ocr")).alias("tools")), F.struct(F.lit("").alias("question"), F.lit("x").alias("answer"), F.array().cast("array<string>").alias("tools"))))
    listed = F.regexp_replace(asked, "\\]$", ',{"question": "And?"}]')
    one = F.to_json(F.struct(F.concat(F.lit("What of "), e, F.lit("?")).alias("question"), F.col("event_type").alias("answer")))
    raw = F.when(e % 4 == 0, F.concat(F.lit("Here you are: "), listed)).when(e % 4 == 1, one).when(e % 4 == 2, F.concat(F.lit("```json\n"), listed, F.lit("\n```"))).otherwise("[none")
    return qu.parsed_questions(view(spark, sf, "events").select(e.alias("img_id"), raw.alias("raw"))).select("img_id", "ord", "question", "answer")


@query
def images_with_enough(spark, sf):
    return en.enough_entities(_kept(spark, sf), 7).select("img_id", "id", "name")


@query
def entity_lines(spark, sf):
    turn = F.col("idx") % 3
    titles = F.when(turn == 0, F.array(F.lit("one"), F.lit("two"), F.lit("three"))).when(turn == 1, F.array(F.lit("one"))).otherwise(F.array().cast("array<string>"))
    page = F.array(F.struct(F.lit("u").alias("url"), F.lit("t").alias("title"), F.lit("see").alias("preview")))
    pages = F.when(turn == 0, page).otherwise(F.array().cast("array<struct<url:string,title:string,preview:string>>"))
    return ch.entity_lines(_kept(spark, sf).withColumns({"location": F.lit("here"), "titles": titles, "pages": pages}))


@query
def answered_triples(spark, sf):
    """Triples as a model answers them, an image at a time; some answers don't parse."""
    rows = view(spark, sf, "kg_triples_raw")
    one = F.struct("ord", "head", "relation", "tail", "tail_type", "normalized_value", "unit")
    body = F.concat(F.lit("Sure! "), F.to_json(F.struct(F.array_sort(F.collect_list(one)).alias("triples"))))
    told = rows.groupBy("img_id").agg(body.alias("body"))
    told = told.withColumn("body", F.when(F.substring("img_id", 5, 9).cast("long") % 4 == 3, F.substring("body", 1, 40)).otherwise(F.col("body")))
    answers = cut(told.select("img_id", F.from_json(s.extract_json(F.col("body")), ch.TRIPLES).alias("r"))).filter(F.col("r").isNotNull())  # else each later filter parses anew
    clean = ch.found_triples(answers).withColumns({"head": s.trimmed(F.col("head")), "tail": s.trimmed(F.col("tail"))})
    return clean.select("img_id", "ord", "head", "relation", "tail", "tail_type", F.col("normalized_value.raw").alias("nv_raw"), "unit")


@query
def detected_boxes(spark, sf):
    """Detections as a model answers them; every fifth has a box of three numbers."""
    rows = view(spark, sf, "geo_raw")
    box = F.when(F.col("ord") % 5 == 2, F.array("rx1", "ry1", "rx2")).otherwise(F.array("rx1", "ry1", "rx2", "ry2"))
    one = F.struct("ord", "name", F.col("etype").alias("type"), box.alias("bbox"))
    listed = F.array_sort(F.collect_list(one))
    told = rows.groupBy("img_id").agg(listed.alias("entities"), F.first("w").alias("width"), F.first("h").alias("height"))
    answers = told.select("img_id", F.from_json(F.to_json(F.struct("entities")), jobs.DETECTION).alias("r"))
    found = jobs.detections(told.select("img_id", "width", "height"), answers)
    boxes = [F.col(c).cast("long").alias(c) for c in ("rx1", "ry1", "rx2", "ry2")]
    given = told.select("img_id", F.col("entities.ord").alias("given"))  # an answer has places; an image's numbers may begin anywhere and repeat
    return found.join(given, "img_id").select("img_id", F.get("given", F.col("ord")).alias("ord"), "name", "etype", *boxes)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    kept = _kept(spark, sf)
    anchors = en.located(en.core_anchors(kept))
    spatial = en.spatial_triples(kept).withColumn("ord", F.col("a_idx") * 100 + F.col("b_idx")).select("img_id", "ord", "head", "relation", "tail")
    entities = kept.select("img_id", "ord", "id", "name")
    return sinks.entity_documents(kept.select("img_id").distinct(), entities, spatial, anchors, kept)


@query
def entity_documents(spark, sf):
    """The nested document of each image, told by its parts."""
    first = lambda c, name: F.get(c, F.lit(0))[name]
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    boxes = F.col("local_artifacts")
    return _documents(spark, sf).select(
        "img_id", size("entities").alias("n_entities"), size("high_conf").alias("n_anchors"), size("triples").alias("n_triples"), first("entities", "name").alias("first_name"),
        first("high_conf", "id").alias("first_anchor"), first("triples", "tail").alias("first_tail"), boxes["largest"].alias("largest"), boxes["smallest"].alias("smallest"), size(boxes["layout"]).alias("n_layout"),
    )


def _records(spark: SparkSession, sf: str) -> DataFrame:
    rows = _numbered(spark, sf).withColumns({"question": F.col("user"), "answer": F.lit("a"), "reasoning": F.lit(None).cast("string")})
    return qu.final_records(rows, F.concat(F.lit("images/"), "img_id", F.lit(".jpg")))


@query
def question_documents(spark, sf):
    """The question document of each image, told by its path and ids in order."""
    ids = F.array_join(F.transform("questions", lambda q: q["question_id"]), ",")
    return sinks.question_documents(_records(spark, sf)).select("img_id", "img_path", F.size("questions").cast("bigint").alias("n"), ids.alias("ids"))


@query
def records_of_documents(spark, sf):
    """The final records read back from the question documents."""
    return sinks.records_of(sinks.question_documents(_records(spark, sf))).select("id", "image_id", "image_path", "category", "question_id", "question", "answer")


@query
def expansion_rounds(spark, sf):
    """Two rounds of expansion: each searched tail gives a next one and one that is known already."""
    clean = _clean(spark, sf).select(*_TRIPLE)

    def discover(tails: DataFrame, k: int) -> DataFrame:
        step = lambda place, relation, tail: F.struct(place.alias("ord"), F.lit(relation).alias("relation"), tail.alias("tail"))
        found = F.array(step(F.col("rank") * 2, "leads_to", F.concat("tail", F.lit(" next"))), step(F.col("rank") * 2 + 1, "LEADS_TO", F.upper(F.concat("tail", F.lit(" next")))))
        return tails.select("img_id", F.col("tail").alias("head"), F.explode(found).alias("x")).select("img_id", F.col("x.ord").cast("long").alias("ord"), "head", "x.relation", "x.tail")

    return expand(clean, view(spark, sf, "kg_ent"), discover, lambda df, label: cut(df), target=52)


__all__ = ["ORACLES", "QUERIES"]
