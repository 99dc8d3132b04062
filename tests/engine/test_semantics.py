"""Hand-worked cases, properties and plan shapes."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from lumenkg.functions import geometry as g
from lumenkg.functions import rules
from lumenkg.functions import strings as s
from lumenkg.operators import entities as en
from lumenkg.operators import evidence as ev
from lumenkg.operators import expansion, lookup
from lumenkg.operators import questions as qu
from lumenkg.operators import triples as tr
from lumenkg.plans import registry
from lumenkg.sources import files, sinks
from lumenkg.streaming import incremental

SF = "/root/testdata/sf0.001"
TRIPLE = "img_id string, ord long, head string, relation string, tail string, tail_type string, normalized_value string, unit string"


def one(spark, expression, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression.alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ('{"a": 1}', {"a": 1}), ('```json\n{"a": 1}\n```', {"a": 1}), ('It is {"a": {"b": 2}} indeed }', {"a": {"b": 2}}), ("```\n[1, 2]\n```", [1, 2]),
        ('{"a": 1', None), ("none", None), (None, None), ("```json", None), ('{"a": "}"}', None),
    ],
)
def test_json_from_model_answers(spark, raw, want):
    got = one(spark, s.extract_json(F.col("x")), raw)
    assert (json.loads(got) if got is not None else None) == want


def test_scalars(spark):
    got = {v: tuple(one(spark, s.scalar_value(F.col("x")), v)) for v in ("-12", "3.50", " ", None, "x1", " 7 ")}
    assert got == {"-12": ("-12", -12.0, "int"), "3.50": ("3.50", 3.5, "float"), " ": ("", None, "empty"), None: ("", None, "empty"), "x1": ("x1", None, "str"), " 7 ": ("7", 7.0, "int")}
    assert one(spark, s.numeric_labels(F.col("x")), "白色27号球衣 2024 12345") in ([2024], [27, 2024])
    assert one(spark, s.value_in(F.col("x")), "lens 50 MM f2") == "50 MM"
    key = one(spark, s.cache_key("jina", url=F.col("x"), max_chars=F.lit(2000)), 'http://a/"b"')
    import hashlib

    text = json.dumps({"_t": "jina", "max_chars": 2000, "url": 'http://a/"b"'}, sort_keys=True, ensure_ascii=False)
    assert key == hashlib.sha256(text.encode()).hexdigest()[:16]


def test_directions_and_ties(spark):
    case = lambda f, dx, dy: one(spark, f(F.lit(float(dx)), F.lit(float(dy))))
    assert case(g.layout_direction, 5, 5) == "below" and case(g.layout_direction, 0, 0) == "above"
    assert case(g.spatial_relation, 5, 5) == "located_left_of" and case(g.spatial_relation, 0, 0) == "located_right_of"
    assert [case(g.compass_direction, *d) for d in ((9, 0), (9, -9), (0, -9), (-9, 0), (0, 9), (1, 1))] == ["右方", "右上方", "上方", "左方", "下方", "右方"]


def test_boxes(spark):
    raw = spark.createDataFrame(
        [("i", 0, " Sign ", 0, 0, 1000, 1000), ("i", 1, "A", 1, 1, 9, 9), ("i", 2, "Cup", 100, 100, 90, 300), ("i", 3, "cup ", 1, 1, 9, 9), ("i", 4, "Edge", 1000, 990, 1200, 1200)],
        "img_id string, ord int, name string, rx1 int, ry1 int, rx2 int, ry2 int",
    ).selectExpr("*", "'object' etype", "1000 w", "500 h")
    kept = {r["name"]: r for r in en.kept_entities(raw).collect()}
    assert list(kept) == ["Cup", "Edge"] and [kept[n]["id"] for n in kept] == ["E1", "E2"]
    assert tuple(kept["Cup"]["bbox"]) == (100, 50, 101, 150) and kept["Edge"]["bbox"]["x2"] == 1000


def test_blank_heads_and_alias_chains(spark):
    names = spark.createDataFrame([("i", 0, "Denver"), ("i", 1, "Denver Nuggets"), ("i", 2, "Ball")], "img_id string, ord int, name string")
    rows = [("i", 1, "", "r", "Ball", "x", None, None), ("i", 2, "nuggets", "r", "1992", "TIME", "1992", None), ("i", 3, "Ball", "r", "ball", "x", None, None)]
    got = [(r["head"], r["tail"]) for r in tr.normalised(tr.sanitised(spark.createDataFrame(rows, TRIPLE)), names).orderBy("ord").collect()]
    assert got == [("Denver Nuggets", "Ball"), ("Denver Nuggets", "1992")]
    aliases = spark.createDataFrame([("i", "A", "B"), ("i", "B", "C")], "img_id string, alias string, canonical string")
    chain = spark.createDataFrame([("i", 1, "A", "r", "x", "x", None, None), ("i", 2, "A", "r", "B", "x", None, None)], TRIPLE)
    assert [(r["head"], r["tail"]) for r in tr.aliased(tr.sanitised(chain), aliases).orderBy("ord").collect()] == [("B", "x"), ("B", "C")]
    left = tr.entities_without_aliases(spark.createDataFrame([("i", "A"), ("i", "B"), ("i", "C")], "img_id string, name string"), aliases)
    assert [r["name"] for r in left.collect()] == ["C"]


def test_rules(spark):
    rows = spark.createDataFrame([(a, b) for a in rules.STRONG_RELATIONS[:6] for b in ("founder", "closed_in", "x y", "")], "a string, b string")
    v = lambda x, y: rules.relations_compatible(F.col(x), F.col(y), F.lit("TIME"))
    for r in rows.select(v("a", "b").alias("p"), v("b", "a").alias("q")).collect():
        assert (r["p"]["ok"], r["p"]["score"]) == (r["q"]["ok"], r["q"]["score"])
    profile = one(spark, rules.relation_profile(F.col("x"), F.lit("OTHER")), "a_b_c_d")
    assert profile["lexicalizability"] == 0.0 and profile["generic_penalty"] == 0.9
    assert one(spark, rules.question_category(F.array(F.lit("teleport")))) == "retrieval"
    levels = [one(spark, rules.question_difficulty(F.array_repeat(F.lit("ocr"), n))) for n in (0, 2, 3, 4, 5)]
    assert levels == ["easy", "easy", "medium", "medium", "hard"]
    assert one(spark, rules.visual_descriptor(F.lit("brand"), F.array(F.lit("invented")), F.lit("大幅画面上方"))) == "画面上方的电子品牌广告牌"


def test_fallback_properties(spark):
    rng = random.Random(3)
    kept = registry._kept(spark, SF)
    spatial = en.spatial_triples(kept)
    joined = spatial.filter(F.col("a_idx") == rng.randrange(1, 4))
    added = tr.spatial_fallback(spatial, joined)
    n = kept.groupBy("img_id").count().withColumn("most", F.expr("count * (count - 1) / 2"))
    assert added.groupBy("img_id").agg(F.count("*").alias("k")).join(n, "img_id").filter("k > most").count() == 0
    assert tr.unconnected_pairs(kept.select("img_id", "ord", "name"), added).join(added.select("img_id").distinct(), "img_id").count() <= spatial.count()


def test_questions(spark):
    raw = 'Here: [{"question": "q1", "tools": ["Code_Interpreter", "ocr"]}, {"question": ""}, {"question": "q2"}]'
    rows = spark.createDataFrame([("i", raw), ("j", '{"question": "only"}'), ("k", "nothing")], "img_id string, raw string")
    out = qu.numbered(qu.classified(qu.parsed_questions(rows))).orderBy("img_id", "ord").collect()
    assert [(r["img_id"], r["question_id"]) for r in out] == [("i", "hybrid_easy_01"), ("i", "retrieval_easy_01"), ("j", "retrieval_easy_01")]


def test_lookup_calls_each_key_once_and_survives_errors(spark, tmp_path):
    requests = spark.createDataFrame([(1, "web", "a", "A"), (2, "web", "a", "A"), (3, "web", "b", "bad"), (4, "web", "c", "C")], "n int, api string, key string, payload string")
    store = str(tmp_path / "responses")
    spark.createDataFrame([("web", "c", "stored", "ok", 1)], lookup.RESPONSE).write.parquet(store)

    def client():
        def ask(api, payload):
            if payload == "bad":
                raise ValueError("no")
            return f"{api}:{payload}"

        return ask

    got = {r["n"]: r["body"] for r in lookup.refresh(requests, store, client, callers=2).collect()}
    assert got == {1: "web:A", 2: "web:A", 3: None, 4: "stored"}
    rows = spark.read.parquet(store).collect()
    assert len(rows) == 3 and [(r["attempts"], r["status"]) for r in rows if r["key"] == "b"] == [(3, "ValueError: no")]


def test_expansion_stops(spark, tmp_path):
    triples = spark.createDataFrame([("i", k, "h", f"r{k}", f"tail{k}") for k in range(4)] + [("full", k, "h", f"r{k}", f"t{k}x") for k in range(40)], "img_id string, ord long, head string, relation string, tail string")
    names = spark.createDataFrame([("i", "tail0")], "img_id string, name string")
    asked = []

    def discover(tails, k):
        rows = tails.collect()
        asked.append({r["tail"] for r in rows})
        assert {r["img_id"] for r in rows} == {"i"}
        return tails.select("img_id", F.col("rank").cast("long").alias("ord"), F.col("tail").alias("head"), F.lit("next").alias("relation"), F.concat("tail", F.lit("_n")).alias("tail"))

    def save(df, label):
        df.write.parquet(str(tmp_path / label))
        return spark.read.parquet(str(tmp_path / label))

    out = expansion.expand(triples, names, discover, save)
    assert asked == [{"tail1", "tail2", "tail3"}, {"tail0", "tail1_n", "tail2_n", "tail3_n"}]
    assert out.filter("img_id = 'i'").count() == 11 and out.filter("img_id = 'full'").count() == 40


def test_sources_and_sinks(spark, tmp_path):
    for name in ("images/b.jpg", "images/sub/a.PNG", "images/sub/a.png", "try/b.png", "images/x.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    assert [r["img_id"] for r in files.image_paths(spark, str(tmp_path / "images")).collect()] == ["b", "a"]
    assert [r["img_id"] for r in files.image_paths(spark, str(tmp_path / "images"), recursive=False, limit=1).collect()] == ["b"]
    assert files.sampled_image_paths(spark, str(tmp_path), 1).count() == 3
    ids = spark.createDataFrame([("b",), ("zz",)], "img_id string")
    at = {r["img_id"]: r["path"] for r in files.locate_images(ids, files.image_paths(spark, str(tmp_path)), ["images", "try"]).collect()}
    assert at["b"].endswith("images/b.jpg") and at["zz"] is None
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/a.json").write_text('{"img_id": "a",\n "n": 1}')
    (tmp_path / "docs/b_shadow.json").write_text('{"img_id": "b"}')
    (tmp_path / "docs/c.json").write_text("{broken")
    assert [r["img_id"] for r in files.json_documents(spark, str(tmp_path / "docs"), "img_id string, n int", "_shadow.json").collect()] == ["a"]
    assert tuple(one(spark, files.bounded_size(F.lit(4096), F.lit(1000)))) == (2048, 500)
    records = qu.final_records(registry._numbered(spark, SF).withColumns({c: F.lit("t") for c in ("question", "answer", "reasoning")}), F.lit("p"))
    sinks.write_questions(records, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/by_category")).count() == records.count() == spark.read.json(str(tmp_path / "out/question_stats")).first()["total_questions"]


def test_incremental_runs_take_new_files_once(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    run = lambda: incremental.run_new_files(spark, str(tmp_path / "in"), events.schema, lambda b: b.groupBy("event_type").count(), str(tmp_path / "out"), str(tmp_path / "cp"))
    events.limit(100).write.parquet(str(tmp_path / "in"))
    run()
    run()
    events.limit(50).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("count")).first()[0] == 150
    assert incremental.event_windows(events).agg(F.sum("n")).first()[0] == events.count() == incremental.user_sessions(events).agg(F.sum("n")).first()[0]


def test_plans(spark):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for name in ("layout_relations", "triples_normalized", "comparable_pairs", "pairs_capped", "unconnected_pairs"):
        text = plan(registry.QUERIES[name](spark, SF))
        assert not any(x in text for x in ("NestedLoop", "Cartesian", "Python", "Pandas", "Arrow"))
        assert name != "pairs_capped" or "WindowGroupLimit" in text
    rows = registry.view(spark, SF, "page_rows")
    assert ev.readable(rows).count() < rows.count()
