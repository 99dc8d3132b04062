"""Both jobs on stored responses."""

from __future__ import annotations

import hashlib
import json

from lumenkg.operators.lookup import RESPONSE
from lumenkg.plans import jobs
from lumenkg.sources import sinks

BOX = lambda k: [100 * k, 100, 100 * k + 60, 200 + k]
DETECTED = {"image_description": "a street", "entities": [{"name": n, "type": "brand", "bbox": BOX(k)} for k, n in enumerate(("Acme", "Acme Corp", "Globex", "Pizza Hut"))] + [{"name": "bad", "type": "x", "bbox": [1]}]}
FOUND = {"triples": [{"head": "Acme Corp", "relation": "founded_in", "tail": "1990", "tail_type": "time", "normalized_value": "1990"}, {"head": "Globex", "relation": "rival_of", "tail": "Pizza Hut"}]}
ALIASES = {"groups": [{"canonical": "Acme Corp", "aliases": ["Acme", "nobody"]}]}
ASKED = '```json\n[{"question": "When?", "answer": "1990", "tools": ["web_search", "code_interpreter"]}]\n```'


def searched(image):
    """Responses for one image whose "Globex" and "Pizza Hut" are pictured: searches, pages, a view, plans and triples."""
    web = lambda q: key(f'{{"_t": "serper_web", "n": 5, "q": "{q}"}}')
    page = lambda url: key(f'{{"_t": "jina", "max_chars": 2000, "url": "{url}"}}')
    hits = lambda *rows: json.dumps({"organic": [{"title": t, "link": u, "snippet": s} for t, u, s in rows]})
    found = lambda *rows: json.dumps({"triples": [dict(zip(("head", "relation", "tail"), r)) for r in rows]})
    return [
        ("serper_web", web("Acme"), hits(("Acme", "http://acme", "Acme makes anvils"), ("Video", "http://youtube.com/1", "no"))),
        ("serper_img", key('{"_t": "serper_img", "n": 5, "q": "Globex"}'), json.dumps({"images": [{"title": "Globex tower", "link": "http://globex"}]})),
        ("jina", page("http://globex"), "the tower"),
        ("serper_lens", f"{image}/E3/pad20", json.dumps({"organic": [{"title": "Hank Scorpio - boss", "link": "http://hank"}], "knowledgeGraph": {"title": "Globex"}})),
        ("canonical_names", image, json.dumps({"canonical_names": ["Hank Scorpio"]})),
        ("cross_plan", image, json.dumps({"search_plans": [{"entity_a": "globex", "entity_b": "ACME", "queries": [{"query": "acme globex deal"}]}, {"entity_a": "Acme", "entity_b": "Acme Corp", "skip": True}]})),
        ("serper_web", web("acme globex deal"), hits(("Deal", "http://deal", "Acme and Globex sign"))),
        ("jina", page("http://deal"), "signed in 1995"),
        ("cross_triples", image, found(("Acme", "partner_of", "Globex"), ("Acme Corp", "FOUNDED_IN", "1990"))),
        ("expand_plan_1", image, json.dumps({"queries": [{"entity": "1990", "query": "year 1990", "skip": False}]})),
        ("serper_web", web("year 1990"), hits(("1990", "http://year", "a year"))),
        ("expand_triples_1", image, found(("1990", "part_of", "nineties"))),
    ]


def key(text):
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def responses(spark, ids):
    rows = []
    for k in ids:
        rows += [("detect", k, json.dumps(DETECTED), "ok", 1), ("triples", k, "Sure: " + json.dumps(FOUND), "ok", 1), ("aliases", k, json.dumps(ALIASES), "ok", 1), ("questions", k, ASKED, "ok", 1)]
    return spark.createDataFrame([*rows, ("detect", "broken", "no json", "ok", 1), ("detect", "failed", None, "TimeoutError", 3)], RESPONSE)


def test_chains_of_an_image(spark, tmp_path):
    detected = {"image_description": "a street", "entities": [{"name": n, "type": k, "bbox": BOX(i)} for i, (n, k) in enumerate((("Acme", "brand"), ("Acme Corp", "brand"), ("Globex", "landmark")))]}
    rows = [("detect", "a", json.dumps(detected)), ("triples", "a", json.dumps(FOUND)), *searched("a")]
    stored = spark.createDataFrame([(*r, "ok", 1) for r in rows], RESPONSE)
    images = spark.createDataFrame([("a", 1000, 800, "x/a.png")], "img_id string, width int, height int, path string")

    def save(df, label):
        df.write.mode("overwrite").parquet(f"{tmp_path}/{label}")
        return spark.read.parquet(f"{tmp_path}/{label}")

    out = jobs.enrich(images, stored, save)
    doc = out["documents"].first().asDict(True)
    by = {e["name"]: e for e in doc["entities"]}
    assert doc["img_path"] == "x/a.png" and [e["name"] for e in doc["high_conf"]] == ["Acme", "Acme Corp", "Globex"]
    assert by["Globex"]["titles"] == ["Globex tower"] and by["Globex"]["pages"] == [{"url": "http://globex", "title": "Globex tower", "preview": "the tower"}]
    assert by["Globex"]["lens_titles"] == ["Hank Scorpio - boss"] and (by["Globex"]["lens_matches"], by["Globex"]["lens_panel"]) == (1, "Globex")
    assert [s["snippet"] for s in by["Acme"]["snippets"]] == ["Acme makes anvils", "no"] and by["Acme Corp"]["snippets"] is None
    found = spark.read.parquet(f"{tmp_path}/discoveries").first()
    assert (found["id"], found["name"], found["source_entity_id"]) == ("DE1", "Hank Scorpio", "E3")
    facts = [(t["head"], t["relation"], t["tail"], t["source"]) for t in doc["triples"] if t["source"] != "spatial"]
    # the founding is known already; the names meet the longest that holds them
    assert facts == [("Acme Corp", "founded_in", "1990", None), ("Globex", "rival_of", "Pizza Hut", None), ("Acme Corp", "partner_of", "Globex", "cross_entity"), ("1990", "part_of", "nineties", None)]
    areas = doc["local_artifacts"]["areas"]
    assert [a["id"] for a in areas] == ["E1", "E2", "E3"] and len(doc["local_artifacts"]["layout"]) == 3
    texts = {name: spark.read.parquet(f"{tmp_path}/{name}").first()["payload"] for name in ("evidence", "pair_evidence")}
    assert texts["evidence"] == (
        "- E1: Acme (类型=brand, 位置=" + by["Acme"]["location"] + ")\n- E2: Acme Corp (类型=brand, 位置=" + by["Acme Corp"]["location"] + ")\n"
        "- E3: Globex (类型=landmark, 位置=" + by["Globex"]["location"] + ") [图搜验证: Globex tower] [来源页: the tower]\n- DE1: Hank Scorpio (类型=other, 位置=)\n"
        '\n### Acme (E1)\n\n搜索词: "Acme" (目的: resolution 来源页, provenance: resolution)\n  [Acme] Acme makes anvils\n  [Video] no\n'
        "\n### Acme Corp (E2)\n"
        '\n### Globex (E3)\n\n搜索词: "Globex" (目的: resolution 来源页, provenance: resolution)\n  [Globex tower] Globex tower\n  [Hank Scorpio - boss] Hank Scorpio - boss\n\n  [深度读取: Globex tower]\n  the tower\n'
        "\n### Hank Scorpio (DE1)\n"
    )
    assert "[Deal] Acme and Globex sign" in texts["pair_evidence"] and "signed in 1995" in texts["pair_evidence"]
    asked = {(r["api"], r["payload"]) for r in out["requests"].collect()}
    assert ("serper_web", "Acme Corp") in asked and ("jina", "http://hank") in asked and not {a for a in asked if a[0] in ("detect", "cross_plan")}
    assert [r["img_id"] for r in out["waiting"].collect()] == ["a"] and {"aliases", "questions"} <= {a for a, _ in asked}


def test_jobs(spark, tmp_path):
    stored, images, target = str(tmp_path / "responses"), str(tmp_path / "images"), str(tmp_path / "out")
    responses(spark, ("a", "b")).write.parquet(stored)
    spark.createDataFrame([(k, 1000, 800) for k in ("a", "b", "broken", "failed")], "img_id string, width int, height int").write.parquet(images)
    run = ["enrich", "--images", images, "--responses", stored, "--target", target]
    jobs.main([*run, "--limit", "1"])
    assert [r["img_id"] for r in sinks.latest_documents(spark, target + "/documents").collect()] == ["a"]
    jobs.main(run)
    jobs.main(run)
    docs = {r["img_id"]: r for r in sinks.latest_documents(spark, target + "/documents").collect()}
    assert docs.keys() == {"a", "b"} and sinks.latest_documents(spark, target + "/documents").count() == 2
    doc = docs["b"]
    assert doc["description"] == "a street" and doc["domain"] == "food"
    assert [e["name"] for e in doc["entities"]] == ["Acme Corp", "Globex", "Pizza Hut"]
    facts = [(t["head"], t["relation"], t["tail"]) for t in doc["triples"] if t["source"] is None]
    assert facts == [("Acme Corp", "founded_in", "1990"), ("Globex", "rival_of", "Pizza Hut")]
    spatial = [(t["head"], t["tail"]) for t in doc["triples"] if t["source"] == "spatial"]
    assert len(spatial) == 5 and ("Globex", "Pizza Hut") not in spatial
    jobs.main(["questions", "--documents", target + "/documents", "--responses", stored, "--target", target + "/questions"])
    stats = spark.read.json(target + "/questions/question_stats").first()
    assert (stats["total_questions"], stats["hybrid"], stats["images_with_questions"]) == (2, 2, 2)
