"""Data sources, the SQL surface, alias chains and caps of the visit queue."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from lumenkg.operators import triples as tr
from lumenkg.operators.relational import cut
from lumenkg.plans import registry, sql
from lumenkg.sources import connectors, files

SF = "/root/testdata/sf0.001"


@pytest.fixture
def store(tmp_path):
    root = tmp_path / "cache"
    for api, n in (("serper_web", 5), ("jina", 3), ("serper_lens", 2)):
        (root / api).mkdir(parents=True)
        for k in range(n):
            (root / api / f"k{k}.json").write_text(json.dumps({"organic": [{"title": f"{api} {k}"}]}))
    (root / "jina/bad.json").write_text("{broken")
    return root


def test_stored_responses_open_only_what_is_asked(spark, store):
    connectors.register(spark)
    load = lambda: spark.read.format("stored_responses").load(str(store))
    rows = {(r["api"], r["key"]): r["status"] for r in load().collect()}
    assert len(rows) == 11 and rows["jina", "bad"] == "json_parse_failed" and rows["serper_web", "k4"] == "ok"
    (store / "serper_web/k0.json").chmod(0)  # a file that must not be opened
    (store / "serper_web/k1.json").unlink()
    (store / "serper_web/k1.json").symlink_to(store / "missing")
    assert load().filter("api = 'jina'").count() == 4 and load().filter("api in ('jina', 'serper_lens') and key = 'k1'").count() == 2
    reader = connectors.ResponseReader(str(store))
    left = list(reader.pushFilters([connectors.EqualTo(("api",), "jina"), connectors.In(("key",), ("k0", "k2")), connectors.EqualTo(("status",), "ok")]))
    parts = reader.partitions()
    assert [f.attribute for f in left] == [("status",)] and [p.api for p in parts] == ["jina"] and [p.split("/")[-1] for p in parts[0].paths] == ["k0.json", "k2.json"]
    plain = files.response_files(spark, str(store / "jina")).select("api", "key", "body", "status").collect()
    assert sorted(plain) == sorted(load().filter("api = 'jina'").select("api", "key", "body", "status").collect())
    assert spark.read.format("stored_responses").load(str(store / "nothing")).count() == 0


def test_stored_responses_as_a_stream_come_once(spark, store, tmp_path):
    connectors.register(spark)

    def run():
        stream = spark.readStream.format("stored_responses").load(str(store))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(once=True).start().awaitTermination()
        return sorted((r["api"], r["key"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert len(run()) == 11
    assert len(run()) == 11
    (store / "jina/late.json").write_text("{}")
    assert len(run()) == 12 == len(set(run()))


def test_image_folders(spark, tmp_path):
    connectors.register(spark)
    for name in ("a/1.png", "a/2.JPG", "a/x.txt", "b/3.webp", "top.png"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"xy")
    rows = spark.read.format("image_folders").load(str(tmp_path))
    assert sorted((r["folder"], r["img_id"], r["bytes"]) for r in rows.collect()) == [("a", "1", 2), ("a", "2", 2), ("b", "3", 2)]
    assert [r["img_id"] for r in rows.filter("folder = 'b'").collect()] == ["3"]


def test_views_and_functions_equal_the_operators(spark):
    view = lambda name: registry.view(spark, SF, name)
    names = sql.install(spark, view("geo_raw"), view("kg_ent"), view("kg_triples_raw"))
    assert {"kept_entities", "normalised_triples", "graph_stats"} <= set(names)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(spark.sql("select img_id, ord, id, name, etype, bbox.* from kept_entities")) == rows(registry.QUERIES["entities_kept"](spark, SF))
    assert rows(spark.table("graph_stats")) == rows(registry.QUERIES["graph_stats"](spark, SF))
    wanted = ["img_id", "ord", "head", "relation", "tail"]
    assert rows(spark.sql(f"select {', '.join(wanted)} from normalised_triples")) == rows(registry.QUERIES["triples_normalized"](spark, SF).select(*wanted))
    image = registry.QUERIES["graph_stats"](spark, SF).first()["img_id"]
    assert rows(spark.sql(f"select * from graph_stats_of('{image}')")) == rows(spark.table("graph_stats").filter(F.col("img_id") == image))
    joined = spark.sql("select k.img_id, s.score from (select distinct img_id from kept_entities) k join region_scores s on k.img_id = s.img_id")
    assert joined.count() > 0
    sql.relation_rules(spark, view("rel_rows"))
    bucket = registry.QUERIES["value_bucket"](spark, SF).join(view("rel_rows"), "event_id").select("relation", "kind", "bucket").distinct()
    assert rows(spark.sql("select relation, kind, value_bucket as bucket from relation_rules")) == rows(bucket)


def brute_closure(links):
    out = {}
    for a in links:
        seen, at = [], links[a]
        while at in links and at not in seen:
            seen.append(at)
            at = links[at]
        if at in links:  # a cycle
            at = min(seen[seen.index(at) :])
        if at != a:
            out[a] = at
    return out


def test_alias_chains_end_at_their_last_name(spark):
    rng = random.Random(4)
    cases = {"chain": {"A": "B", "B": "C"}, "cycle": {"b": "a", "a": "b", "z": "b"}, "long": {f"n{k:03d}": f"n{k + 1:03d}" for k in range(70)}}
    for k in range(30):
        names = [f"x{i}" for i in range(rng.randrange(2, 12))]
        cases[f"r{k}"] = {a: b for a in names for b in [rng.choice(names)] if a != b and rng.random() < 0.8}
    rows = [(img, a, b) for img, links in cases.items() for a, b in links.items()]
    got = {}
    for r in tr.closed_aliases(spark.createDataFrame(rows, "img_id string, alias string, canonical string"), cut).collect():
        got.setdefault(r["img_id"], {})[r["alias"]] = r["canonical"]
    want = {img: brute_closure(links) for img, links in cases.items()}
    assert got == {k: v for k, v in want.items() if v} and got["chain"] == {"A": "C", "B": "C"} and got["cycle"] == {"b": "a", "z": "a"}
    assert tr.closed_aliases(spark.createDataFrame([], "img_id string, alias string, canonical string"), cut).count() == 0


def test_visits_as_the_original_caps_them(spark):
    from lumenkg.operators import evidence as ev

    rng = random.Random(6)
    rows, want = [], {}
    for img in range(25):
        tasks, kinds = [], {}
        for origin, rank, n in (("image", 0, rng.randrange(0, 30)), ("web", 1, rng.randrange(0, 30)), ("discovery", 2, rng.randrange(0, 9)), ("lens", 3, rng.randrange(0, 12))):
            kinds[origin] = [(e, [f"{img}-{origin}-{e}-{u}" for u in range(rng.randrange(1, 4))]) for e in range(n)]
            rows += [(str(img), origin, rank, e, e * 10 + u, url) for e, urls in kinds[origin] for u, url in enumerate(urls)]
        for origin, cap in (("image", 20), ("web", 30)):
            for _, urls in kinds[origin]:
                for url in urls[:2]:
                    tasks.append(url)
                    if len(tasks) >= cap:
                        break
        tasks += [u for _, urls in kinds["discovery"] for u in urls][:5] + [u for _, urls in kinds["lens"] for u in urls][:8]
        want[str(img)] = tasks
    frame = spark.createDataFrame(rows, "img_id string, origin string, origin_rank int, id int, ord int, url string")
    got = {}
    for r in ev.visit_queue(frame, faithful=True).orderBy("img_id", "place").collect():
        got.setdefault(r["img_id"], []).append(r["url"])
    assert got == {k: v for k, v in want.items() if v}
