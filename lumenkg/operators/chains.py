"""The chains of whole images on stored responses: resolution, cross-entity search and expansion.

Every call is a request keyed by what is asked. ``Asked`` joins requests to the
stored responses and keeps them, so that a run tells what is still to be called.
What a model is asked is the evidence alone; its instructions belong to the client.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenkg.functions.strings import cache_key, extract_json, title_head, trimmed
from lumenkg.operators import entities as en
from lumenkg.operators import evidence as ev
from lumenkg.operators import triples as tr
from lumenkg.operators.lookup import misses
from lumenkg.operators.relational import joined_text, top_per

TRIPLES = "struct<triples array<struct<head string, relation string, tail string, tail_type string, normalized_value string, unit string, fact string, source_snippet string>>>"
PAIR_PLANS = "struct<search_plans array<struct<entity_a string, entity_b string, skip boolean, queries array<struct<query string, purpose string>>>>>"
TAIL_PLANS = "struct<queries array<struct<entity string, query string, skip boolean>>>"
LENS = "struct<organic array<struct<title string, link string, source string>>, knowledgeGraph struct<title string>>"
NAMES = "struct<canonical_names array<string>>"
#: Labels of the texts that models read.
PANEL_LABEL, ANSWER_LABEL, READ_LABEL = "  [知识面板] ", "  [精选摘要] ", "\n  [深度读取: "
TYPE_LABEL, PLACE_LABEL, SEEN_LABEL, PAGE_LABEL = " (类型=", ", 位置=", " [图搜验证: ", " [来源页: "
QUERY_LABEL, PURPOSE_LABEL, TAIL_SOURCE_LABEL = '\n搜索词: "', '" (目的: resolution 来源页, provenance: resolution)\n', '"  来源: '
Save = Callable[[DataFrame, str], DataFrame]


class Asked:
    """Answers requests from ``responses`` and keeps them."""

    def __init__(self, responses: DataFrame):
        self.responses = responses
        self.requests: list[DataFrame] = []
        self.searches: list[DataFrame] = []

    def bodies(self, rows: DataFrame, api: str, key: Column, payload: Column) -> DataFrame:
        """``rows(img_id, ...)`` with the ``body`` of their response; rows without a usable one go."""
        self.requests.append(rows.select("img_id", F.lit(api).alias("api"), key.alias("key"), payload.alias("payload")))
        stored = self.responses.filter((F.col("api") == api) & (F.col("status") == "ok")).select(F.col("key").alias("_key"), "body")
        return rows.withColumn("_key", key).join(stored, "_key").drop("_key")

    def answers(self, evidence: DataFrame, api: str, schema: str) -> DataFrame:
        """(img_id, r): the parsed answer of a model to each row of ``evidence(img_id, payload)``."""
        rows = self.bodies(evidence.select("img_id", "payload"), api, F.col("img_id"), F.col("payload"))
        return rows.select("img_id", F.from_json(extract_json(F.col("body")), schema).alias("r")).filter(F.col("r").isNotNull())

    def all_requests(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.requests)

    def note(self, stage: str, queries: DataFrame, results: DataFrame, reads: DataFrame) -> None:
        """Keep the searches of a stage: ``queries(img_id, place, query, provenance)`` with their results and pages."""
        hit = F.struct("pos", "kind", "title", "url", F.coalesce("snippet", "content").alias("snippet"))
        page = F.struct("pos", "title", "url", "page_text")
        listed = lambda df, x, name: df.groupBy("img_id", "place").agg(F.array_sort(F.collect_list(x)).alias(name))
        both = queries.select("img_id", "place", "query", "provenance").join(listed(results, hit, "results"), ["img_id", "place"], "left")
        self.searches.append(both.join(listed(reads, page, "pages"), ["img_id", "place"], "left").withColumn("stage", F.lit(f"{len(self.searches)}-{stage}")))

    def search_results(self) -> DataFrame:
        """(img_id, search_results): all kept searches of an image, stage by stage."""
        one = F.struct("stage", "place", "query", "provenance", "results", "pages")
        return reduce(DataFrame.unionByName, self.searches).groupBy("img_id").agg(F.array_sort(F.collect_list(one)).alias("search_results"))

    def missing(self) -> DataFrame:
        """One row (api, key, payload) per request without a usable response."""
        return misses(self.all_requests(), self.responses)

    def waiting(self) -> DataFrame:
        """Images with a request that was never called; a failed call isn't waited for."""
        return self.all_requests().join(self.responses.select("api", "key"), ["api", "key"], "left_anti").select("img_id").distinct()


def found_triples(answers: DataFrame) -> DataFrame:
    """Cleaned triples of parsed answers, in order."""
    rows = answers.select("img_id", F.posexplode("r.triples").alias("ord", "t"))
    return tr.sanitised(rows.select("img_id", F.col("ord").cast("long").alias("ord"), "t.*"))


def searched(asked: Asked, queries: DataFrame, k: int = 5) -> DataFrame:
    """Rows (img_id, place, pos, kind, title, url, snippet, content) of a web search for each of ``queries(img_id, place, query)``."""
    key = cache_key("serper_web", q=F.col("query"), n=F.lit(k))
    rows = asked.bodies(queries.select("img_id", "place", "query"), "serper_web", key, F.col("query"))
    found = ev.search_rows(rows.select(F.struct("img_id", "place").alias("key"), "body"), k)
    return found.select("key.*", "pos", "kind", "title", "url", "snippet", "content")


def page_bodies(asked: Asked, rows: DataFrame, limit: int = 2000) -> DataFrame:
    """(url, content) of the pages of ``rows(img_id, url)``, each once."""
    key = cache_key("jina", url=F.col("url"), max_chars=F.lit(limit))
    read = asked.bodies(rows.select("img_id", "url").distinct(), "jina", key, F.col("url"))
    return read.select("url", F.substring("body", 1, limit).alias("content")).dropDuplicates(["url"])


def deep_read(asked: Asked, rows: DataFrame, k: int, limit: int = 2000) -> DataFrame:
    """The first ``k`` readable results of each search of ``rows(img_id, place, pos, kind, url, ...)`` with their page."""
    few = top_per(ev.readable(rows.filter("kind = 'result'")), ["img_id", "place"], ["pos"], k)
    return ev.deep_reads(few, page_bodies(asked, few, limit), ["img_id", "place"], k, limit)


def evidence_text(heads: DataFrame, results: DataFrame, reads: DataFrame, page_chars: int) -> DataFrame:
    """(img_id, payload): the heads(img_id, place, text) of an image in order, each with its results and pages."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    line = F.when(F.col("kind") == "knowledge_graph", F.concat(F.lit(PANEL_LABEL), blank("content"), F.lit("\n")))
    line = line.when(F.col("kind") == "answer", F.concat(F.lit(ANSWER_LABEL), blank("content"), F.lit("\n")))
    line = line.otherwise(F.concat(F.lit("  ["), blank("title"), F.lit("] "), F.substring(blank("snippet"), 1, 300), F.lit("\n")))
    page = F.concat(F.lit(READ_LABEL), blank("title"), F.lit("]\n  "), F.substring("page_text", 1, page_chars), F.lit("\n"))
    rows = heads.select("img_id", "place", F.lit(0).alias("part"), F.lit(0).alias("pos"), "text")
    rows = rows.unionByName(results.select("img_id", "place", F.lit(1).alias("part"), "pos", line.alias("text")))
    rows = rows.unionByName(reads.select("img_id", "place", F.lit(2).alias("part"), "pos", page.alias("text")))
    return rows.groupBy("img_id").agg(joined_text(F.col("text"), F.struct("place", "part", "pos"), "").alias("payload"))


def entity_lines(entities: DataFrame) -> DataFrame:
    """(img_id, lines): the entities of an image in order with type and place, and the first titles and page if there are any."""
    line = F.concat(F.lit("- "), "id", F.lit(": "), "name", F.lit(TYPE_LABEL), "etype", F.lit(PLACE_LABEL), F.coalesce("location", F.lit("")), F.lit(")"))
    if "titles" in entities.columns:
        line = F.concat(line, F.when(F.size("titles") > 0, F.concat(F.lit(SEEN_LABEL), F.array_join(F.slice("titles", 1, 2), ", "), F.lit("]"))).otherwise(""))
        line = F.concat(line, F.when(F.size("pages") > 0, F.concat(F.lit(PAGE_LABEL), F.substring(F.get("pages", F.lit(0))["preview"], 1, 100), F.lit("]"))).otherwise(""))
    return entities.groupBy("img_id").agg(joined_text(line, F.col("ord"), "\n").alias("lines"))


def with_lines(entities: DataFrame, evidence: DataFrame) -> DataFrame:
    """``evidence`` behind the entity lines of its image."""
    both = evidence.join(entity_lines(entities), "img_id")
    return both.select("img_id", F.concat("lines", F.lit("\n"), "payload").alias("payload"))


#: Provenance of a view's names, least length of a description that is searched, and text limits.
SEEN, DESCRIBED, LEAST_DESCRIPTION, DESCRIPTION_CHARS, DESCRIBED_NAME_CHARS = "lens_reverse", "vlm_describe_workaround", 10, 100, 50


def described_views(views: DataFrame, kept: DataFrame, asked: Asked, save: Save) -> tuple[DataFrame, DataFrame]:
    """The second route of ``views(img_id, id, crop)`` that no view search answered: a model describes the view, and an
    image search for the description names it.

    Gives (img_id, id, visual_desc, candidates) and (img_id, id, nth, name, url): up to three titles of an entity, and the
    first two results as new names, unless they are its own or too short.
    """
    told = asked.bodies(views, "describe", F.col("crop"), F.col("crop")).select("img_id", "id", trimmed(F.col("body")).alias("visual_desc"))
    told = save(told, "described")
    searched = told.filter(F.length("visual_desc") > LEAST_DESCRIPTION).withColumn("q", F.substring("visual_desc", 1, DESCRIPTION_CHARS))
    found = asked.bodies(searched, "serper_img", cache_key("serper_img", q=F.col("q"), n=F.lit(3)), F.col("q"))
    rows = save(ev.image_rows(found.select(F.struct("img_id", "id").alias("key"), "body"), 3).select("key.*", "pos", "title", F.col("source_url").alias("url")), "described_results")
    titles = rows.groupBy("img_id", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "title"))), lambda x: x["title"]).alias("candidates"))
    own = kept.select("img_id", "id", F.lower("name").alias("own"))
    named = rows.filter("pos < 2").filter(F.length("title") > 3).join(own, ["img_id", "id"]).filter(F.lower("title") != F.col("own"))
    name = title_head(F.col("title"), DESCRIBED_NAME_CHARS)
    return told.join(titles, ["img_id", "id"], "left"), named.select("img_id", "id", F.col("pos").alias("nth"), name.alias("name"), "url")


def resolution(kept: DataFrame, asked: Asked, save: Save, view_search: bool | None = None, faithful: bool = False, crop_keys: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Entities with the titles, snippets, lens titles and pages that searches give, and the new names that they hold.

    Pictured entities are searched by image and by their view, others on the web; pages of both are read as ``visit_queue``
    says, and a model cleans the titles of the views. Without ``view_search`` a model describes the views instead; None
    means: views are searched if any response of such a search is stored. ``crop_keys`` gives the key (img_id, id, crop) of
    each view, what it shows for one; without it views are asked by the names of their image, entity and box.
    """
    if view_search is None:
        view_search = not asked.responses.filter("api = 'serper_lens'").isEmpty()
    routes, idx = en.search_routes(kept), kept.select("img_id", "id", "idx")
    key = F.struct("img_id", "id").alias("key")
    ask = lambda route, api: asked.bodies(routes.filter(F.col("route") == route), api, cache_key(api, q=F.col("name"), n=F.lit(5)), F.col("name")).select(key, "body")
    pictures = save(ev.image_rows(ask("image", "serper_img")).select("key.*", "pos", "title", F.col("source_url").alias("url")), "pictures")
    web = save(ev.search_rows(ask("web", "serper_web")).select("key.*", "pos", "kind", "title", "url", F.coalesce("snippet", "content").alias("snippet")), "web")

    views = en.reverse_search_views(kept)
    named_views = views.select("img_id", "id", F.concat_ws("/", "img_id", "id", "view").alias("crop"))
    views = save(crop_keys(views).select("img_id", "id", "crop"), "crop_keys") if crop_keys else named_views
    seen, described = (views, views.limit(0)) if view_search else (views.limit(0), views)
    lens = asked.bodies(seen, "serper_lens", F.col("crop"), F.col("crop")).select("img_id", "id", F.from_json("body", LENS).alias("r"))
    told, named = described_views(described, kept, asked, save)
    lens = save(lens.filter(F.col("r").isNotNull()), "lens")
    raw = lens.select(key, F.posexplode(F.slice("r.organic", 1, 20)).alias("pos", "x")).select("key", "pos", trimmed(F.col("x.title")).alias("title"), F.coalesce(F.nullif("x.link", F.lit("")), "x.source").alias("url"))
    titles = ev.lens_titles(raw).select("key.*", "nth", "title")
    pages = ev.lens_pages(raw).filter("nth <= 5").select("key.*", F.col("nth").alias("pos"), "title", "url")

    panel = lens.select("img_id", "id", F.lit(99).alias("nth"), F.substring(trimmed(F.col("r.knowledgeGraph.title")), 1, 60).alias("name"))
    heads = titles.filter("nth <= 5").select("img_id", "id", "nth", title_head(F.col("title")).alias("name"), F.lower("title").alias("low"))
    shown = named.select("img_id", "id", "nth", "name").withColumn("low", F.lower("name"))
    fresh = heads.unionByName(panel.withColumn("low", F.lower("name"))).unionByName(shown).filter("name <> ''").join(kept.select("img_id", "id", "idx", F.lower("name").alias("own")), ["img_id", "id"])
    place = F.row_number().over(Window.partitionBy("img_id").orderBy("idx", "nth")) - 1
    fresh = save(fresh.filter("low <> own").select("img_id", F.col("id").alias("source_entity_id"), place.alias("pos"), "name"), "found_names")
    listed = fresh.groupBy("img_id").agg(joined_text(F.concat((F.col("pos") + 1).cast("string"), F.lit(". "), "name"), F.col("pos"), "\n").alias("payload"))
    clean = asked.answers(listed, "canonical_names", NAMES).select("img_id", F.posexplode("r.canonical_names").alias("pos", "name"))
    discovered = save(ev.discovered_names(fresh.drop("name"), clean.filter("name is not null"), kept), "discoveries")

    origin = lambda rows, name, rank: rows.join(idx, ["img_id", "id"]).select("img_id", F.lit(name).alias("origin"), F.lit(rank).alias("origin_rank"), "id", F.struct("idx", "pos").alias("ord"), "url", "title")
    found = named.select("img_id", "id", F.col("nth").alias("pos"), "url", F.col("name").alias("title"))
    queue = origin(pictures, "image", 0).unionByName(origin(web.filter("kind = 'result'"), "web", 1)).unionByName(origin(found, "discovery", 2)).unionByName(origin(pages, "lens", 3))
    queue = save(ev.visit_queue(queue.filter("url <> ''"), faithful=faithful), "visits")
    read = queue.join(page_bodies(asked, queue), "url").filter("content <> ''").select("img_id", "id", F.col("place").alias("pos"), "url", "title", "content")

    snippets = top_per(web.filter("snippet <> ''"), ["img_id", "id"], ["pos"], 5, "nth").groupBy("img_id", "id").agg(F.array_sort(F.collect_list(F.struct("nth", "title", "snippet", "url"))).alias("snippets"))
    titled = titles.groupBy("img_id", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "title"))), lambda x: x["title"]).alias("lens_titles"))
    counts = lens.select("img_id", "id", F.coalesce(F.size("r.organic"), F.lit(0)).alias("lens_matches"), F.col("r.knowledgeGraph.title").alias("lens_panel"))
    merged = ev.merged_resolution(kept, pictures, read)
    for extra in (snippets, titled, counts, told):
        merged = merged.join(extra, ["img_id", "id"], "left")
    provenance = F.when(F.col("lens_matches").isNotNull(), SEEN).when(F.col("visual_desc").isNotNull(), DESCRIBED)
    return save(merged.withColumn("view_provenance", provenance), "resolved"), discovered


def main_evidence(seeds: DataFrame) -> DataFrame:
    """(img_id, payload) of what resolution found about the ``seeds(img_id, id, name, ord, titles, snippets, lens_titles, pages)``."""
    head = F.concat(F.lit("\n### "), "name", F.lit(" ("), "id", F.lit(")\n"))
    asked = F.concat(F.lit(QUERY_LABEL), "name", F.lit(PURPOSE_LABEL))
    none = F.lit(None).cast("string")
    row = lambda title, snippet: F.struct(title.alias("title"), snippet.alias("snippet"))
    same = lambda c: F.coalesce(F.transform(F.slice(c, 1, 5), lambda t: row(t, t)), F.array().cast("array<struct<title:string,snippet:string>>"))
    web = F.coalesce(F.transform(F.slice("snippets", 1, 5), lambda s: row(s["title"], s["snippet"])), F.array().cast("array<struct<title:string,snippet:string>>"))
    some = seeds.withColumns({"place": F.col("ord"), "results": F.concat(same("titles"), same("lens_titles"), web)})
    any_ = (F.size("results") > 0) | (F.size(F.coalesce("pages", F.array().cast("array<struct<url:string,title:string,preview:string>>"))) > 0)
    heads = some.select("img_id", "place", F.when(any_, F.concat(head, asked)).otherwise(head).alias("text"))
    results = some.select("img_id", "place", F.posexplode("results").alias("pos", "x")).select("img_id", "place", "pos", F.lit("result").alias("kind"), "x.title", "x.snippet", none.alias("content"))
    reads = some.select("img_id", "place", F.posexplode(F.slice("pages", 1, 3)).alias("pos", "x")).select("img_id", "place", "pos", "x.title", F.col("x.preview").alias("page_text"))
    return with_lines(seeds, evidence_text(heads, results, reads, 1500))


def cross_entity(tier1: DataFrame, descriptions: DataFrame, asked: Asked, save: Save) -> DataFrame:
    """Cleaned triples that bridge entities of an image: the planned pairs are searched, and pages are read where the
    results name both."""
    pairs = save(en.capped_pairs(tier1), "pairs")
    listed = pairs.groupBy("img_id").agg(joined_text(F.concat("a_name", F.lit(" ↔ "), "b_name"), F.struct("a_rank", "b_rank"), "\n").alias("payload"))
    about = listed.join(descriptions, "img_id", "left").select("img_id", F.concat_ws("\n", "description", "payload").alias("payload"))
    plans = asked.answers(with_lines(tier1, about), "cross_plan", PAIR_PLANS).select("img_id", F.posexplode("r.search_plans").alias("ord", "p"))
    plans = plans.select("img_id", "ord", "p.entity_a", "p.entity_b", "p.skip", F.transform("p.queries", lambda q: F.coalesce(q["query"], F.lit(""))).alias("queries"))
    place = F.row_number().over(Window.partitionBy("img_id").orderBy("a_name", "b_name", "pos"))
    queries = save(ev.pair_queries(pairs, plans).withColumn("place", place), "pair_queries")
    results = save(searched(asked, queries), "pair_results")
    text = joined_text(F.concat_ws(" ", "snippet", "title"), F.col("pos"), " ").alias("text")
    names = queries.select("img_id", "place", F.col("a_name").alias("entity_a"), F.col("b_name").alias("entity_b"))
    both = ev.both_mentioned(results.groupBy("img_id", "place").agg(text).join(names, ["img_id", "place"]))
    reads = save(deep_read(asked, results.join(both.select("img_id", "place"), ["img_id", "place"], "left_semi"), 2), "pair_reads")
    asked.note("cross_entity", queries.withColumn("provenance", F.lit("cross_entity")), results, reads)
    head = F.concat(F.lit("\n### "), "a_name", F.lit(" ↔ "), "b_name", F.lit(QUERY_LABEL), "query", F.lit('"\n'))
    evidence = save(evidence_text(queries.select("img_id", "place", head.alias("text")), results, reads, 1500), "pair_evidence")
    return found_triples(asked.answers(with_lines(tier1, evidence), "cross_triples", TRIPLES)).withColumn("source", F.lit("cross_entity"))


def tail_search(asked: Asked, save: Save, entities: DataFrame, triples: Callable[[], DataFrame]) -> Callable[[DataFrame, int], DataFrame]:
    """What ``expand`` calls in each round: tails are planned, searched and read, and a model finds their triples.

    ``triples()`` gives the triples as they are when a round begins.
    """

    def discover(tails: DataFrame, k: int) -> DataFrame:
        now = triples()
        behind = tr.tail_context(tails, now).withColumn("line", F.concat(F.lit('- "'), "tail", F.lit(TAIL_SOURCE_LABEL), "context"))
        listed = behind.join(tails.select("img_id", "tail", "rank"), ["img_id", "tail"]).groupBy("img_id").agg(joined_text(F.col("line"), F.col("rank"), "\n").alias("payload"))
        plans = asked.answers(listed, f"expand_plan_{k + 1}", TAIL_PLANS).select("img_id", F.posexplode("r.queries").alias("nth", "q"))
        planned = plans.select(F.struct("img_id", "nth").alias("img_id"), F.col("q.entity").alias("tail"), F.col("q.query").alias("rewritten"), "q.skip")
        place = F.row_number().over(Window.partitionBy("img_id").orderBy("nth", "pos"))
        queries = save(tr.tail_queries(planned).select("img_id.*", "tail", "pos", "query", "origin").withColumn("place", place), f"tail_queries-{k}")
        results = save(searched(asked, queries), f"tail_results-{k}")
        head = F.concat(F.lit("\n### "), "tail", F.lit(QUERY_LABEL), "query", F.lit('" (provenance: '), "origin", F.lit(")\n"))
        reads = save(deep_read(asked, results, 5), f"tail_reads-{k}")
        asked.note(f"expansion_{k + 1}", queries.withColumnRenamed("origin", "provenance"), results, reads)
        evidence = save(evidence_text(queries.select("img_id", "place", head.alias("text")), results, reads, 1000), f"tail_evidence-{k}")
        known = evidence.join(tr.known_names_text(now), "img_id").select("img_id", F.concat("payload", F.lit("\n"), "names").alias("payload"))
        few = top_per(entities, ["img_id"], ["ord"], 8)
        return found_triples(asked.answers(with_lines(few, known), f"expand_triples_{k + 1}", TRIPLES)).withColumn("source", F.lit(None).cast("string"))

    return discover


