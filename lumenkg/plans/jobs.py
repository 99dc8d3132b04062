"""The jobs end to end, on stored responses: images to entity documents, documents to question files.

    python -m lumenkg.plans.jobs enrich --images TABLE --responses TABLE --target DIR [--limit N] [--hold] [--tries N] [--view-search yes|no]
    python -m lumenkg.plans.jobs questions --documents DIR --responses TABLE --target DIR [--source DIR]
    python -m lumenkg.plans.jobs batch --source DIR[,DIR] --responses TABLE --target DIR [--limit N] [--content-keys] [--transitive]
    python -m lumenkg.plans.jobs pipeline --responses TABLE --target DIR [--source DIR] [--limit N]
    python -m lumenkg.plans.jobs bench --source DIR --responses TABLE --target DIR
    python -m lumenkg.plans.jobs compact --documents DIR

``batch`` takes the images of the first folder that has any through both jobs, ``pipeline`` those of ``images`` unless told
otherwise; ``bench`` takes three of each folder, anew.
Every run adds to the ledger of outcomes (``TARGET/ledger``), and takes only images that it doesn't settle: done, with too
little to go on, or failed ``--tries`` times. Requests without a response are written to ``work/requests``; with ``--hold``
their images wait for a run that finds the responses.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lumenkg.operators import chains as ch
from lumenkg.operators import crops as cr
from lumenkg.operators import entities as en
from lumenkg.operators import graph as gr
from lumenkg.operators import outcomes as oc
from lumenkg.operators import questions as qu
from lumenkg.operators import triples as tr
from lumenkg.operators.expansion import expand
from lumenkg.operators.lookup import TRACED
from lumenkg.operators.relational import cut
from lumenkg.sources import files, sinks

DETECTION = "struct<image_description string, entities array<struct<name string, type string, bbox array<double>>>>"
GROUPS = "struct<groups array<struct<canonical string, aliases array<string>>>>"
Save = Callable[[DataFrame, str], DataFrame]


def detections(images: DataFrame, answers: DataFrame) -> DataFrame:
    """Raw detections of ``images(img_id, width, height)`` from parsed answers; boxes must have four numbers."""
    rows = answers.select("img_id", F.posexplode("r.entities").alias("ord", "e"))
    rows = rows.join(images.select("img_id", F.col("width").alias("w"), F.col("height").alias("h")), "img_id").filter(F.size("e.bbox") == 4)
    box = {c: F.col("e.bbox")[k] for k, c in enumerate(("rx1", "ry1", "rx2", "ry2"))}
    name, kind = F.coalesce("e.name", F.lit("")), F.coalesce("e.type", F.lit("other"))
    rows = rows.withColumns({"name": name, "etype": kind, "confidence": F.lit(0.8), "level": F.lit("high"), **box})
    return rows.drop("e")


def enrich(images: DataFrame, responses: DataFrame, save: Save, least_entities: int = 3, view_search: bool | None = None, crop_keys: Callable[[DataFrame], DataFrame] | None = None, transitive: bool = False) -> dict[str, DataFrame]:
    """Entities, triples, documents, requests and outcomes of every image with at least ``least_entities`` entities.

    Entities are detected, boxed, numbered, located and resolved by searches; main, cross-entity and expansion triples are
    merged, normalised and aliased; pairs of anchors that no triple joins get a spatial one. A request without a stored
    response gives nothing; ``requests`` holds those to call, ``waiting`` their images. ``transitive`` follows chains of aliases
    to their end, ``crop_keys`` asks for views by what they show.
    """
    asked = ch.Asked(responses)
    path = F.col("path") if "path" in images.columns else F.lit(None).cast("string")
    answers = save(asked.answers(images.select("img_id", path.alias("payload")), "detect", DETECTION), "detections")
    detected = save(en.kept_entities(detections(images, answers)), "detected")
    kept = save(en.boxes_flagged(en.with_values(en.located(en.enough_entities(detected, least_entities)))), "entities")
    about = answers.select("img_id", F.col("r.image_description").alias("description"))
    known, discovered = ch.resolution(kept, asked, save, view_search, crop_keys=crop_keys)

    scored = save(en.expansion_seeds(known.withColumn("source", F.lit(""))), "seeds")
    tier1 = save(en.brand_dense_top(en.promoted(scored)), "tier1")
    stubs = discovered.select("img_id", "id", "name", (F.lit(1 << 20) + F.col("pos")).alias("ord"), F.lit("other").alias("etype"), F.lit("image_reverse_discovery").alias("source"))
    seeds = scored.unionByName(stubs, allowMissingColumns=True)
    main = asked.answers(save(ch.main_evidence(seeds), "evidence"), "triples", ch.TRIPLES)
    clean = save(ch.found_triples(main).withColumn("source", F.lit(None).cast("string")), "triples_clean")
    merged = [save(tr.merged(clean, ch.cross_entity(tier1, about, asked, save), strip=True), "triples_merged")]

    def keep(df: DataFrame, label: str) -> DataFrame:
        stored = save(df, f"expansion/{label}")
        if label.startswith("triples-"):
            merged.append(stored)
        return stored

    names = seeds.select("img_id", "name")
    grown = expand(merged[0], kept, ch.tail_search(asked, save, kept, lambda: merged[-1]), keep, searched=names)
    normal = save(tr.normalised(grown, kept), "triples_normal")
    candidates = save(tr.alias_candidates(kept, normal), "alias_candidates")
    listed = candidates.groupBy("img_id").agg(F.array_join(F.array_sort(F.collect_set("name")), "\n").alias("payload"))
    groups = asked.answers(listed, "aliases", GROUPS).select("img_id", F.posexplode("r.groups").alias("group_ord", "g"))
    groups = groups.select("img_id", "group_ord", F.col("g.canonical").alias("canonical"), F.explode("g.aliases").alias("alias"))
    aliases = save(tr.valid_aliases(groups, candidates), "aliases")
    if transitive:
        aliases = save(tr.closed_aliases(aliases, cut), "aliases_closed")
    aliased = tr.aliased(normal, aliases)
    anchors = save(en.core_anchors(kept), "anchors")  # named as before the aliases, like the graph and the spatial triples
    spatial = tr.spatial_fallback(en.spatial_triples(anchors), aliased)
    place = F.lit(1 << 50) + F.col("a_idx").cast("long") * (1 << 20) + F.col("b_idx")  # behind all others
    plain = {"tail_type": F.lit("OTHER"), "unit": F.lit(""), "normalized_value": F.struct(F.lit("").alias("raw"), F.lit(None).cast("double").alias("num"), F.lit("empty").alias("kind"))}
    spatial = spatial.select("img_id", place.alias("ord"), "head", "relation", "tail", "source").withColumns(plain)
    triples = save(aliased.unionByName(spatial, allowMissingColumns=True), "triples")
    left = save(tr.entities_without_aliases(known, aliases), "entities_final")
    asked.answers(save(gr.context_text(anchors, triples, about).withColumnRenamed("context", "payload"), "question_evidence"), "questions", "array<string>")
    heads = about.join(en.image_domains(kept), "img_id").join(images.select("img_id", path.alias("img_path")), "img_id")
    documents = sinks.entity_documents(heads, left, triples, anchors, kept).join(save(asked.search_results(), "search_results"), "img_id", "left")
    return {
        "entities": left, "anchors": anchors, "triples": triples, "documents": documents, "requests": asked.missing(), "waiting": asked.waiting(),
        "answers": answers, "detected": detected, "kept": kept,
    }


def parsed_records(responses: DataFrame, paths: DataFrame) -> DataFrame:
    """Numbered questions with the path of their image, of the images of ``paths(img_id, path)``."""
    raw = responses.filter("api = 'questions' and status = 'ok'").select(F.col("key").alias("img_id"), F.col("body").alias("raw"))
    return qu.numbered(qu.classified(qu.parsed_questions(raw.join(paths.select("img_id"), "img_id", "left_semi")))).join(paths, "img_id")


def question_records(responses: DataFrame, paths: DataFrame) -> DataFrame:
    """Final records from answers of the question model."""
    return qu.final_records(parsed_records(responses, paths), F.col("path"))


class Run:
    """One run of the jobs on a target folder: its ledger, its number and its stored responses."""

    def __init__(self, spark: SparkSession, responses: str, target: str, tries: int = 3):
        self.spark, self.target, self.tries, self.counts = spark, target, tries, {}
        self.responses = spark.read.schema(TRACED).parquet(responses)
        self.number = 1 + (self.ledger().agg(F.max("run")).first()[0] or 0)

    def ledger(self) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.target}/ledger")
        if path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.read.schema(oc.LEDGER).parquet(f"{self.target}/ledger")
        return self.spark.createDataFrame([], oc.LEDGER)

    def add(self, outcomes: DataFrame, began: float) -> None:
        """Add outcomes to the ledger, counted in the same pass; an image's seconds are its share of the time since ``began``."""
        seen = Observation()
        rows = outcomes.observe(seen, F.count(F.lit(1)).alias("images"), F.count_if(F.col("status") == "ok").alias("ok"))
        rows = self.save(rows, "outcomes")
        took = (time.time() - began) / max(seen.get["images"], 1)
        rows.withColumns({"run": F.lit(self.number).cast("long"), "seconds": F.lit(round(took, 3))}).write.mode("append").parquet(f"{self.target}/ledger")
        self.counts |= {f"{k}_{rows.first()['stage']}": v for k, v in seen.get.items()} if seen.get["images"] else {}

    def save(self, df: DataFrame, label: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.target}/work/{label}")
        return self.spark.read.parquet(f"{self.target}/work/{label}")

    def enrich(self, images: DataFrame, limit: int = 0, hold: bool = False, **how) -> None:
        """Documents of the images that the ledger doesn't settle, and their outcomes."""
        began = time.time()
        images = oc.unfinished(images, self.ledger(), "enrich", self.tries)
        if limit > 0:
            images = images.orderBy("img_id").limit(limit)
        images = self.save(images, "images")
        if images.isEmpty():
            return
        out = enrich(images, self.responses, self.save, **how)
        self.save(out["requests"], "requests")
        waiting = self.save(out["waiting"], "waiting") if hold else None
        documents = out["documents"].join(waiting, "img_id", "left_anti") if hold else out["documents"]
        sinks.write_documents(documents, f"{self.target}/documents", self.number)
        parts = "img_id string, entities array<string>, triples array<string>"
        done = sinks.latest_documents(self.spark, f"{self.target}/documents", parts).join(images.select("img_id"), "img_id", "left_semi")
        self.add(oc.enrich_outcomes(images, self.responses, out["answers"], out["detected"], out["kept"], done, waiting), began)

    def documents(self, root: str, source: str | None = None) -> DataFrame:
        """(img_id, img_path) of the documents under ``root``: a store of versions, or a folder of one JSON file each.

        Documents without a path get that of the image of their name under ``source``.
        """
        schema = "img_id string, img_path string"
        stored = sinks.latest_documents(self.spark, root, schema)
        if stored is None:
            stored = files.json_documents(self.spark, root, schema, files.SHADOW_SUFFIX).filter("img_id is not null").groupBy("img_id").agg(F.min("img_path").alias("img_path"))
        if not source:
            return stored
        at = files.image_paths(self.spark, source)
        folders = [r["folder"] for r in at.select(files.folder(F.col("path")).alias("folder")).distinct().orderBy("folder").collect()]  # a folder name per folder of images
        found = files.locate_images(stored.filter("img_path is null").select("img_id"), at, folders)
        return stored.join(found, "img_id", "left").select("img_id", F.coalesce("img_path", "path").alias("img_path"))

    def questions(self, documents: str, source: str | None = None) -> None:
        """Questions of the documents that the ledger doesn't settle, their outcomes, and the final files of all questions."""
        began = time.time()
        stored = self.documents(documents, source)
        todo = self.save(oc.unfinished(stored, self.ledger(), "questions", self.tries), "todo")
        made = self.save(parsed_records(self.responses, todo.select("img_id", F.col("img_path").alias("path"))), "questions")
        sinks.write_documents(sinks.question_documents(qu.final_records(made, F.col("path"))), f"{self.target}/by_image", self.number)
        self.add(oc.question_outcomes(todo, self.responses, made), began)
        every = sinks.latest_documents(self.spark, f"{self.target}/by_image", sinks.QUESTION_DOCUMENT)
        sinks.write_questions(sinks.records_of(every), self.target)

    def results(self, images: DataFrame) -> DataFrame:
        """A row per image of ``images(img_id, path)``: folder, outcome, counts and, where all went well, its questions."""
        told = images.select("img_id", files.folder(F.col("path")).alias("folder"), F.col("path").alias("img_path")).join(oc.image_results(self.ledger()), "img_id", "left")
        told = told.withColumn("status", F.coalesce("status", F.lit("step1_waiting")))
        asked = sinks.latest_documents(self.spark, f"{self.target}/by_image", sinks.QUESTION_DOCUMENT)
        return told if asked is None else told.join(asked.select("img_id", "questions"), "img_id", "left")


def sized(spark: SparkSession, paths: DataFrame, root: str) -> DataFrame:
    """``paths(img_id, path)`` under ``root`` with width and height; images that Spark doesn't decode stay without."""
    bare = lambda c: F.regexp_replace(c, "^file:/+", "/")
    sizes = files.image_sizes(spark, root).select(bare(F.col("path")).alias("_at"), "width", "height")
    return paths.withColumn("_at", bare(F.col("path"))).join(sizes, "_at", "left").drop("_at")


def batch(spark: SparkSession, paths: DataFrame, root: str, responses: str, target: str, tries: int = 3, content_keys: bool = False, **how) -> Run:
    """Both jobs over the images of ``paths`` under ``root``, and ``TARGET/summary``."""
    began, run = time.time(), Run(spark, responses, target, tries)
    images = run.save(sized(spark, paths, root), "sized")
    # two images of one name are one document: the first path stands for both
    one = images.groupBy("img_id").agg(F.min_by(F.struct("path", "width", "height"), "path").alias("x")).select("img_id", "x.*")
    if content_keys:
        how["crop_keys"] = lambda views: cr.crop_keys(cr.pictures(spark, root), views)
    run.enrich(one, **how)
    run.questions(f"{target}/documents")
    sinks.write_summary(run.results(images.select("img_id", "path")), f"{target}/summary", time.time() - began)
    return run


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=("enrich", "questions", "batch", "pipeline", "bench", "compact"))
    for name in ("images", "responses", "documents", "target", "source"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--limit", type=int, default=0)
    parser.add_argument("--tries", type=int, default=3)
    parser.add_argument("--per-folder", type=int, default=3)
    parser.add_argument("--view-search", choices=("yes", "no"))
    parser.add_argument("--content-keys", action="store_true", help="ask for views by a hash of their pixels")
    parser.add_argument("--transitive", action="store_true", help="follow chains of aliases to their end")
    parser.add_argument("--hold", action="store_true", help="leave images for a later run whose requests weren't all called")
    given = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    how = {"view_search": {"yes": True, "no": False}.get(given.view_search), "transitive": given.transitive}
    roots = (given.source or ("images" if given.job == "pipeline" else "")).split(",")
    if given.job == "compact":
        sinks.compact_documents(spark, given.documents)
    elif given.job == "questions":
        Run(spark, given.responses, given.target, given.tries).questions(given.documents, given.source)
    elif given.job == "enrich":
        Run(spark, given.responses, given.target, given.tries).enrich(spark.read.parquet(given.images), given.limit, given.hold, **how)
    elif given.job in ("batch", "pipeline"):
        found = files.first_image_paths(spark, roots, given.limit)
        if found is None:
            raise SystemExit(f"no images in {', '.join(roots)}")
        batch(spark, *found, given.responses, given.target, given.tries, given.content_keys, **how)
    else:  # earlier results don't count, so each run has a folder of its own
        target = f"{given.target}/bench-{int(time.time())}"
        batch(spark, files.sampled_image_paths(spark, given.source, given.per_folder).select("img_id", "path"), given.source, given.responses, target, given.tries, given.content_keys, **how)


if __name__ == "__main__":
    main()
