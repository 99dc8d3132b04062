"""Outcomes of images, calls that must parse, versions of documents, and the batch and bench jobs."""

from __future__ import annotations

import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from lumenkg.operators import lookup
from lumenkg.operators import outcomes as oc
from lumenkg.operators import questions as qu
from lumenkg.operators.lookup import RESPONSE
from lumenkg.plans import jobs
from lumenkg.sources import files, sinks
from tests.engine.test_jobs import ALIASES, ASKED, BOX, DETECTED, FOUND, key, responses


def png(width, height, shade=lambda x, y: (x % 256, y % 256, 7)):
    """A small RGB picture."""
    rows = b"".join(b"\0" + bytes(c for x in range(width) for c in shade(x, y)) for y in range(height))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_every_image_has_an_outcome_and_settled_ones_rest(spark, tmp_path):
    stored, images, target = str(tmp_path / "responses"), str(tmp_path / "images"), str(tmp_path / "out")
    two = {"image_description": "few", "entities": DETECTED["entities"][:2]}
    responses(spark, ("a", "b")).unionByName(spark.createDataFrame([("detect", "few", json.dumps(two), "ok", 1), ("questions", "b", "no list", "ok", 1)], RESPONSE)).filter("not (api = 'questions' and key = 'b' and body like '```%')").write.parquet(stored)
    names = ("a", "b", "broken", "failed", "few", "later")
    spark.createDataFrame([(k, 1000, 800) for k in names], "img_id string, width int, height int").write.parquet(images)
    run = ["enrich", "--images", images, "--responses", stored, "--target", target, "--tries", "2"]
    for _ in range(3):
        jobs.main(run)
    ledger = spark.read.parquet(target + "/ledger")
    rows = {(r["img_id"], r["run"]): (r["status"], r["reason"]) for r in ledger.collect()}
    assert {k[0]: v for k, v in rows.items() if k[1] == 1} == {
        "a": ("ok", ""), "b": ("ok", ""), "broken": ("error", "detect: json_parse_failed"), "failed": ("error", "detect: TimeoutError"),
        "few": ("skip", "too few entities"), "later": ("waiting", "not called"),
    }
    tried = {n: sorted(k[1] for k in rows if k[0] == n) for n in names}
    assert tried == {"a": [1], "b": [1], "few": [1], "broken": [1, 2], "failed": [1, 2], "later": [1, 2, 3]}
    assert sorted(r["img_id"] for r in sinks.latest_documents(spark, target + "/documents").collect()) == ["a", "b"]

    jobs.main(["questions", "--documents", target + "/documents", "--responses", stored, "--target", target])
    results = {r["img_id"]: (r["status"], r["error"], r["n_questions"]) for r in oc.image_results(spark.read.parquet(target + "/ledger")).collect()}
    assert results["a"] == ("ok", None, 1) and results["b"] == ("step2_error", "step2: no questions generated", 0)
    assert results["few"] == ("step1_skip", "step1: too few entities", None) and results["later"][0] == "step1_waiting"
    summary = qu.run_summary(oc.image_results(spark.read.parquet(target + "/ledger"))).first()
    assert (summary["images"], summary["succeeded"], summary["failed"], summary["questions"]) == (6, 1, 5, 1)
    counts = {(r["stage"], r["status"]): r["images"] for r in oc.status_counts(spark.read.parquet(target + "/ledger")).groupBy("stage", "status").agg(F.sum("images").alias("images")).collect()}
    assert counts == {("enrich", "ok"): 2, ("enrich", "error"): 2, ("enrich", "skip"): 1, ("enrich", "waiting"): 1, ("questions", "ok"): 1, ("questions", "error"): 1}


def scripted(answers):
    """A client that gives the answers of each payload one after the other."""

    def client():
        left = {k: list(v) for k, v in answers.items()}

        def ask(api, payload):
            said = left[payload].pop(0)
            if isinstance(said, Exception):
                raise said
            return said

        return ask

    return client


def test_model_calls_are_repeated_until_they_parse(spark):
    junk, good = "I can't tell", 'Sure: {"a": {"b": 1}} ok'
    answers = {"third": [junk, "", good], "never": [junk, "{broken", "```json\nnope\n```"], "fails": [ValueError("x")] * 3, "list": ['{"q": 1', "[1, 2"] + ["here [1, 2]"], "page": ["plain text"]}
    asked = spark.createDataFrame([("detect", "third"), ("expand_plan_2", "never"), ("detect", "fails"), ("questions", "list"), ("jina", "page")], "api string, key string").withColumn("payload", F.col("key"))
    rows = {r["key"]: r for r in lookup.call_missing(asked, scripted(answers), callers=1).collect()}
    assert {k: (r["status"], r["attempts"]) for k, r in rows.items()} == {"third": ("ok", 3), "never": ("json_parse_failed", 3), "fails": ("ValueError: x", 3), "list": ("ok", 3), "page": ("ok", 1)}
    assert [t["status"] for t in rows["third"]["trace"]] == ["json_parse_failed", "empty_response", "ok"] and rows["third"]["body"] == good
    assert rows["never"]["body"] is None and [t["preview"] for t in rows["never"]["trace"]] == [junk, "{broken", "```json nope ```"]
    assert [(t["status"], t["error"]) for t in rows["fails"]["trace"]] == [("call_error", "ValueError: x")] * 3
    told = lookup.attempts(spark.createDataFrame([tuple(r) for r in rows.values()], lookup.TRACED))
    assert told.count() == 13 and told.filter("status = 'ok'").count() == 3


@pytest.mark.parametrize("raw", ['{"a": 1}', "```json\n{\"a\": 1}\n```", "```\n[1]\n``` thanks {\"b\": 2}", 'x {"a": {"b": 2}} }', '{"a": "}"}', "```json", "{", "", "null", "```\nnull\n```", "}{ {}", "[1]"])
def test_the_check_of_a_call_agrees_with_the_reader(spark, raw):
    from lumenkg.functions import strings as s

    row = spark.createDataFrame([(raw,)], "x string").select(s.extract_json(F.col("x")).alias("o"), s.extract_json_array(F.col("x")).alias("a")).first()
    assert lookup.holds_json(raw) == (row["o"] not in (None, "null")) and lookup.holds_array(raw) == (row["a"] not in (None, "null"))


def test_documents_have_versions(spark, tmp_path):
    root = str(tmp_path / "docs")
    frame = lambda rows: spark.createDataFrame(rows, "img_id string, n long, parts array<string>")
    assert sinks.latest_documents(spark, root) is None
    sinks.write_documents(frame([("a", 1, ["x"]), ("b", 1, None)]), root, 1)
    sinks.write_documents(frame([("a", 2, ["y", "z"]), ("c", 2, [])]), root, 2)
    content = lambda: sorted((r["img_id"], r["n"], r["parts"]) for r in sinks.latest_documents(spark, root, "img_id string, n long, parts array<string>").collect())
    want = [("a", 2, ["y", "z"]), ("b", 1, None), ("c", 2, [])]
    assert content() == want and sinks.generations(spark, root) == [0]
    sinks.compact_documents(spark, root)
    assert content() == want and sinks.generations(spark, root) == [1] and spark.read.json(root).count() == 3
    sinks.write_documents(frame([("b", 3, ["new"])]), root, 3)
    assert content()[1] == ("b", 3, ["new"])
    # a compaction that ended before it dropped the old generation
    spark.read.json(root).drop("gen").write.partitionBy("bucket").json(root + "/gen=2")
    assert content()[1] == ("b", 3, ["new"]) and len(content()) == 3
    jobs.main(["compact", "--documents", root])
    assert sinks.generations(spark, root) == [3] and spark.read.json(root).count() == 3


def picture_folder(root, names):
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(png(1000, 10) if not name.endswith("bad.png") else b"no picture")


def test_batch_and_bench(spark, tmp_path):
    source, stored, target = tmp_path / "pictures", str(tmp_path / "responses"), str(tmp_path / "out")
    picture_folder(source, ["x/a.png", "x/b.png", "x/bad.png", "x/later.png", "y/c.png"])
    (tmp_path / "empty").mkdir()
    responses(spark, ("a", "b", "c")).write.parquet(stored)
    jobs.main(["batch", "--source", f"{tmp_path}/none,{tmp_path}/empty,{source}", "--responses", stored, "--target", target])
    read = lambda root: [r.asDict(True) for r in spark.read.json(root + "/summary/results").collect()]
    rows = {r["img_id"]: r for r in read(target)}
    assert {k: r["status"] for k, r in rows.items()} == {"a": "ok", "b": "ok", "c": "ok", "bad": "step1_error", "later": "step1_waiting"}
    assert rows["bad"]["error"] == "step1: unreadable image" and rows["a"]["n_entities"] == 3 and rows["a"]["n_questions"] == 1
    assert rows["a"]["questions"][0]["answer"] == "1990" and rows["a"]["img_path"].endswith("x/a.png") and rows["a"]["folder"] == "x"
    totals = spark.read.json(target + "/summary/totals").first()
    assert (totals["total_images"], totals["success"], totals["failed"], totals["folders"], totals["total_questions"]) == (5, 3, 2, 2, 3) and totals["wall_time_sec"] > 0
    jobs.main(["bench", "--source", str(source), "--responses", stored, "--target", str(tmp_path / "bench"), "--per-folder", "2"])
    (made,) = (tmp_path / "bench").iterdir()
    assert [(r["folder"], r["img_id"]) for r in read(str(made))] == [("x", "a"), ("x", "b"), ("y", "c")]
    assert files.first_image_paths(spark, ["", str(tmp_path / "none"), str(tmp_path / "empty")]) is None
    with pytest.raises(SystemExit):
        jobs.main(["batch", "--source", str(tmp_path / "empty"), "--responses", stored, "--target", target])


def test_views_are_described_where_no_view_search_is_stored(spark, tmp_path):
    detected = {"image_description": "d", "entities": [{"name": n, "type": k, "bbox": BOX(i)} for i, (n, k) in enumerate((("Acme", "brand"), ("Globex", "landmark"), ("Hank", "person")))]}
    long = "a tall tower of glass with a big letter G on top " * 4
    image_key = lambda q, n: key(f'{{"_t": "serper_img", "n": {n}, "q": "{q}"}}')
    hits = [{"title": t, "link": f"http://{k}"} for k, t in enumerate(("Globex", "Globex Tower Springfield, the tallest building of them all - Wiki", "Third title"))]
    rows = [
        ("detect", "a", json.dumps(detected)), ("triples", "a", json.dumps(FOUND)), ("aliases", "a", json.dumps(ALIASES)), ("questions", "a", ASKED),
        ("describe", "a/E2/pad20", f" {long}"), ("describe", "a/E3/pad20", "too short"), ("serper_img", image_key(long[:100], 3), json.dumps({"images": hits})),
        ("canonical_names", "a", json.dumps({"canonical_names": ["Globex Tower"]})), ("jina", key('{"_t": "jina", "max_chars": 2000, "url": "http://1"}'), "page of the tower"),
    ]
    stored = spark.createDataFrame([(*r, "ok", 1) for r in rows], RESPONSE)
    images = spark.createDataFrame([("a", 1000, 800, "x/a.png")], "img_id string, width int, height int, path string")

    def save(df, label):
        df.write.mode("overwrite").parquet(f"{tmp_path}/{label}")
        return spark.read.parquet(f"{tmp_path}/{label}")

    out = jobs.enrich(images, stored, save)
    by = {e["name"]: e for e in out["documents"].first().asDict(True)["entities"]}
    assert by["Globex"]["view_provenance"] == "vlm_describe_workaround" and by["Globex"]["visual_desc"] == long.strip() and by["Acme"]["view_provenance"] is None
    assert by["Globex"]["candidates"] == [h["title"] for h in hits] and by["Hank"]["candidates"] is None and by["Globex"]["lens_matches"] is None
    names = spark.read.parquet(f"{tmp_path}/found_names").collect()
    assert [(r["source_entity_id"], r["name"]) for r in names] == [("E2", "Globex Tower Springfield, the tallest building of ".strip())] or [len(r["name"]) <= 50 for r in names] == [True]
    assert [r["url"] for r in spark.read.parquet(f"{tmp_path}/visits").filter("origin = 'discovery'").collect()] == ["http://1"]
    assert by["Globex"]["pages"][0]["preview"] == "page of the tower"
    asked = {r["api"] for r in out["requests"].collect()}
    assert "serper_lens" not in asked
    searched = jobs.enrich(images, stored, save, view_search=True)
    assert {"serper_lens"} <= {r["api"] for r in searched["requests"].collect()} and spark.read.parquet(f"{tmp_path}/described").count() == 0


def test_questions_of_plain_documents(spark, tmp_path):
    source, docs, stored, target = tmp_path / "pictures", tmp_path / "docs", str(tmp_path / "responses"), str(tmp_path / "out")
    picture_folder(source, ["x/a.png", "y/b.png"])
    docs.mkdir()
    for name in ("a", "b"):
        (docs / f"{name}.json").write_text(json.dumps({"img_id": name, "img_path": "given/b.png" if name == "b" else None, "entities": []}, indent=2))
    (docs / "a_randomwalk_shadow.json").write_text(json.dumps({"img_id": "shadow"}))
    (docs / "broken.json").write_text("{")
    responses(spark, ("a", "b")).write.parquet(stored)
    jobs.main(["questions", "--documents", str(docs), "--responses", stored, "--target", target, "--source", str(source)])
    rows = {r["image_id"]: r["image_path"] for r in spark.read.json(target + "/all_questions").collect()}
    assert rows.keys() == {"a", "b"} and rows["a"].endswith("pictures/x/a.png") and rows["b"] == "given/b.png"


def test_a_run_of_failures_alone(spark, tmp_path):
    stored, images, target = str(tmp_path / "responses"), str(tmp_path / "images"), str(tmp_path / "out")
    responses(spark, ()).write.parquet(stored)
    spark.createDataFrame([(k, 1000, 800) for k in ("broken", "failed")], "img_id string, width int, height int").write.parquet(images)
    jobs.main(["enrich", "--images", images, "--responses", stored, "--target", target])
    jobs.main(["questions", "--documents", target + "/documents", "--responses", stored, "--target", target])
    jobs.main(["compact", "--documents", target + "/documents"])
    assert {r["img_id"]: r["status"] for r in oc.image_results(spark.read.parquet(target + "/ledger")).collect()} == {"broken": "step1_error", "failed": "step1_error"}
    assert spark.read.json(target + "/question_stats").first()["total_questions"] == 0
