"""Search, page and reverse-image responses as rows, and what is done with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenkg.functions import rules
from lumenkg.functions.strings import trimmed, url_site
from lumenkg.operators.relational import first_wins, top_per

SEARCH = (
    "struct<knowledgeGraph struct<title string, description string, attributes map<string,string>>, "
    "answerBox struct<answer array<string>>, organic array<struct<title string, link string, snippet string>>>"
)


def search_rows(responses: DataFrame, k: int = 5, limit: int = 500) -> DataFrame:
    """``responses(key, body)`` as rows (key, pos, kind, title, url, snippet, content): the knowledge panel, the answer, then ``k`` results."""
    r = responses.withColumn("r", F.from_json("body", SEARCH))
    empty = F.lit(None).cast("string")

    def row(kind: str, title=empty, url=empty, snippet=empty, content=empty) -> Column:
        return F.struct(F.lit(kind).alias("kind"), title.alias("title"), url.alias("url"), snippet.alias("snippet"), content.alias("content"))

    none = F.array().cast("array<struct<kind:string,title:string,url:string,snippet:string,content:string>>")
    panel = F.col("r.knowledgeGraph")
    facts = F.transform(F.map_entries(panel["attributes"]), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    about = F.array_join(F.filter(F.concat(F.array(panel["title"], panel["description"]), F.coalesce(facts, F.array().cast("array<string>"))), lambda x: x != ""), " | ")
    answer = F.substring(F.array_join(F.col("r.answerBox.answer"), " "), 1, limit)
    organic = F.transform(F.slice("r.organic", 1, k), lambda o: row("result", o["title"], o["link"], F.substring(o["snippet"], 1, limit)))
    all_rows = F.concat(
        F.when(panel.isNotNull(), F.array(row("knowledge_graph", content=about))).otherwise(none),
        F.when(F.col("r.answerBox").isNotNull(), F.array(row("answer", content=answer))).otherwise(none),
        F.coalesce(organic, none),
    )
    return r.select("key", F.posexplode(all_rows).alias("pos", "x")).select("key", "pos", "x.*")


def readable(rows: DataFrame, url_col: str = "url") -> DataFrame:
    """Rows with a URL outside the skipped sites."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    return rows.filter((url != "") & ~rules.contains_any(url, rules.SKIPPED_SITES))


def deep_reads(rows: DataFrame, pages: DataFrame | None, keys: list[str], k: int = 2, limit: int = 2000) -> DataFrame:
    """The first ``k`` readable URLs of each key with the text of their page; empty pages go, the order stays.

    Without ``pages(url, content)``, rows carry the ``content`` that was read for them, which may differ between rows of a URL.
    """
    few = top_per(readable(rows), keys, ["pos"], k, "nth")
    text = F.substring("content", 1, limit).alias("page_text")
    read = few.withColumn("page_text", text).drop("content") if pages is None else few.join(pages.select("url", text), "url")
    return read.filter(F.coalesce(F.col("page_text"), F.lit("")) != "")


def both_mentioned(evidence: DataFrame, a: str = "entity_a", b: str = "entity_b", text: str = "text") -> DataFrame:
    """Rows whose text holds both names, without regard to case; cheap enough to go before any page is read."""
    low = F.lower(text)
    return evidence.filter(low.contains(F.lower(a)) & low.contains(F.lower(b)))


def mentions(docs: DataFrame, names: DataFrame) -> DataFrame:
    """(doc_id, item_id) of documents whose text holds both ``entity_a`` and ``entity_b`` of ``names(item_id, ...)``, without
    regard to case, for names of one word.

    A text holds a word if one of its words does, so the distinct words are cut into pieces of the names' lengths, of
    which there are few, and meet the names by equality. Names of one or two characters are in most words and are looked
    for in the text itself. What a document holds is gathered once, and its pairs are counted where it lies.
    """
    pairs = names.groupBy(F.lower("entity_a").alias("a"), F.lower("entity_b").alias("b")).agg(F.collect_list("item_id").alias("items")).filter("a <> '' and b <> ''")
    sides = pairs.select("a", "b", F.explode(F.array(F.struct(F.lit(1).alias("side"), F.col("a").alias("name")), F.struct(F.lit(2).alias("side"), F.col("b").alias("name")))).alias("x")).select("a", "b", "x.*")
    wanted = sides.select("name").distinct()
    lengths = sorted(r["n"] for r in wanted.select(F.length("name").alias("n")).distinct().collect() if r["n"] > 2)
    short = [r["name"] for r in wanted.filter(F.length("name") <= 2).collect()]
    low = F.lower("text")
    words = docs.select("doc_id", F.explode(F.array_distinct(F.split(low, " +"))).alias("word"))
    vocabulary = docs.select(F.explode(F.split(low, " +")).alias("word")).distinct()
    sized = vocabulary.select("word", F.explode(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>")).alias("n"))
    cut = sized.filter(F.length("word") >= F.col("n")).withColumn("at", F.explode(F.sequence(F.lit(1), F.length("word") - F.col("n") + 1)))
    held = cut.select("word", F.substr("word", F.col("at"), F.col("n")).alias("name")).join(wanted, "name").distinct()
    found = words.join(held, "word").select("doc_id", F.array("name").alias("names"))
    if short:  # within a lambda over one text, as the optimizer would else lower it anew for each name
        inside = F.transform(F.array(low), lambda t: F.filter(F.array(*map(F.lit, short)), lambda n: t.contains(n)))[0]
        found = found.unionByName(docs.filter("text is not null").select("doc_id", inside.alias("names")))
    each = found.groupBy("doc_id").agg(F.explode(F.array_distinct(F.flatten(F.collect_list("names")))).alias("name"))
    both = each.join(sides, "name").groupBy("doc_id", "a", "b").agg(F.bit_or("side").alias("sides")).filter("sides = 3")
    return both.join(pairs, ["a", "b"]).select("doc_id", F.explode("items").alias("item_id"))


IMAGES = "struct<images array<struct<title string, imageUrl string, link string, source string>>>"


def image_rows(responses: DataFrame, k: int = 5) -> DataFrame:
    """``responses(key, body)`` of an image search as rows (key, pos, title, image_url, source_url, source_domain), ``k`` each."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    rows = responses.withColumn("r", F.from_json("body", IMAGES)).select("key", F.posexplode(F.slice("r.images", 1, k)).alias("pos", "x"))
    return rows.select("key", "pos", blank(F.col("x.title")).alias("title"), blank(F.col("x.imageUrl")).alias("image_url"), blank(F.col("x.link")).alias("source_url"), blank(F.col("x.source")).alias("source_domain"))


def lens_titles(raw: DataFrame, k: int = 20) -> DataFrame:
    """First ``k`` titles of three characters or more of ``raw(key, pos, title, url)``, without regard to case."""
    long = raw.filter(F.length(trimmed(F.col("title"))) >= 3)
    return top_per(first_wins(long, ["key", F.lower(trimmed(F.col("title")))], ["pos"]), ["key"], ["pos"], k, "nth")


def lens_pages(raw: DataFrame, k: int = 15) -> DataFrame:
    """First ``k`` distinct URLs with their sites."""
    some = raw.filter(F.coalesce(F.col("url"), F.lit("")) != "")
    return top_per(first_wins(some, ["key", "url"], ["pos"]), ["key"], ["pos"], k, "nth").withColumn("site", url_site(F.col("url")))


def discovered_names(titles: DataFrame, cleaned: DataFrame, entities: DataFrame) -> DataFrame:
    """Names a model found in titles (same place in both lists): stripped of quotes, 2 to 60 characters, new to the image,
    first of each, numbered DE1.."""
    pairs = titles.join(cleaned, ["img_id", "pos"]).withColumn("name", F.btrim(trimmed(F.col("name")), F.lit("《》\"'")))
    fresh = pairs.filter(F.length("name").between(2, 60)).withColumn("key", F.lower("name"))
    known = entities.select("img_id", F.lower(trimmed(F.col("name"))).alias("key"))
    one = first_wins(fresh.join(known, ["img_id", "key"], "left_anti"), ["img_id", "key"], ["pos", "name"])
    place = F.row_number().over(Window.partitionBy("img_id").orderBy("pos", "name"))  # two lists may share their places
    return one.withColumn("id", F.concat(F.lit("DE"), place)).drop("key")


def visit_queue(candidates: DataFrame, caps: dict[str, int] | None = None, total: int = 30, per_entity: int = 2, faithful: bool = False) -> DataFrame:
    """URLs to read from ``candidates(img_id, origin, origin_rank, id, ord, url)``: of image and web searches the first
    ``per_entity`` of each entity, so many of each origin, ``total`` of an image.

    ``faithful`` takes caps as the original does: once an image has 20 (image searches) or ``total`` URLs, each further
    entity still adds its first; discoveries and reverse searches come on top.
    """
    caps = caps or {"image": 20, "web": 30, "discovery": 5, "lens": 8}
    limit = F.create_map(*[x for k, v in caps.items() for x in (F.lit(k), F.lit(v))])
    searched = F.col("origin").isin("image", "web")
    own = F.row_number().over(Window.partitionBy("img_id", "origin", "id").orderBy("ord"))
    candidates = candidates.withColumn("own", own).filter((F.col("own") <= per_entity) | ~searched)
    by = Window.partitionBy("img_id", "origin").orderBy("ord")
    if not faithful:
        few = candidates.withColumn("nth", F.row_number().over(by)).filter(F.col("nth") <= limit[F.col("origin")])
        return top_per(few.drop("own"), ["img_id"], ["origin_rank", "nth"], total, "place")
    # entities come in the order of their first URL; those before one count with all their rows, so the first past a cap
    # is told exactly, and behind it every entity adds one
    start = F.min("ord").over(Window.partitionBy("img_id", "origin", "id"))
    rows = candidates.withColumn("_start", start).withColumn("_before", F.count(F.lit(1)).over(Window.partitionBy("img_id", "origin").orderBy("_start").rangeBetween(Window.unboundedPreceding, Window.currentRow)) - F.count(F.lit(1)).over(Window.partitionBy("img_id", "origin", "id")))
    pictures = rows.filter("origin = 'image'").filter((F.col("own") == 1) | (F.col("_before") + F.col("own") <= F.lit(caps["image"])))
    held = pictures.groupBy("img_id").agg(F.count(F.lit(1)).alias("_held"))
    web = rows.filter("origin = 'web'").join(held, "img_id", "left")
    web = web.filter((F.col("own") == 1) | (F.coalesce("_held", F.lit(0)) + F.col("_before") + F.col("own") <= F.lit(total))).drop("_held")
    rest = rows.filter(~searched).withColumn("nth", F.row_number().over(by)).filter(F.col("nth") <= limit[F.col("origin")]).drop("nth")
    few = pictures.unionByName(web).unionByName(rest).drop("_start", "_before", "own").withColumn("nth", F.row_number().over(by))
    return few.withColumn("place", F.row_number().over(Window.partitionBy("img_id").orderBy("origin_rank", "nth")))


def merged_resolution(entities: DataFrame, rows: DataFrame, pages: DataFrame, max_titles: int = 5) -> DataFrame:
    """Each entity with its titles and, in order, its pages (url, title, preview); entities without any stay."""
    some = top_per(rows.filter(F.coalesce(F.col("title"), F.lit("")) != ""), ["img_id", "id"], ["pos"], max_titles, "nth")
    titles = some.groupBy("img_id", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "title"))), lambda x: x["title"]).alias("titles"))
    seen = pages.groupBy("img_id", "id").agg(F.array_sort(F.collect_list(F.struct("pos", "url", "title", F.substring("content", 1, 200).alias("preview")))).alias("pages"))
    seen = seen.withColumn("pages", F.transform("pages", lambda p: F.struct(p["url"].alias("url"), p["title"].alias("title"), p["preview"].alias("preview"))))
    out = entities.join(titles, ["img_id", "id"], "left").join(seen, ["img_id", "id"], "left")
    none = F.array().cast("array<struct<url:string,title:string,preview:string>>")
    return out.withColumns({"titles": F.coalesce("titles", F.array().cast("array<string>")), "pages": F.coalesce("pages", none)})


def pair_queries(pairs: DataFrame, plans: DataFrame) -> DataFrame:
    """Search queries of entity pairs: the last plan of a pair (either order) decides; skipped pairs go, pairs without a
    usable plan are searched by both names."""
    lo, hi = F.least(F.lower("a_name"), F.lower("b_name")), F.greatest(F.lower("a_name"), F.lower("b_name"))
    keyed = pairs.withColumns({"lo": lo, "hi": hi})
    plo, phi = F.least(F.lower("entity_a"), F.lower("entity_b")), F.greatest(F.lower("entity_a"), F.lower("entity_b"))
    last = plans.groupBy("img_id", plo.alias("lo"), phi.alias("hi")).agg(F.max_by(F.struct("skip", "queries"), "ord").alias("plan"))
    both = keyed.join(last, ["img_id", "lo", "hi"], "left").filter(~F.coalesce("plan.skip", F.lit(False)))
    usable = F.filter(F.coalesce("plan.queries", F.array().cast("array<string>")), lambda q: trimmed(q) != "")
    queries = F.when(F.size(usable) > 0, usable).otherwise(F.array(F.concat("a_name", F.lit(" "), "b_name")))
    return both.select("img_id", "a_name", "b_name", F.posexplode(queries).alias("pos", "query"))
