"""Stateful streams and pixel crops."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import functions as F

from lumenkg.operators import crops as cr
from lumenkg.operators.lookup import RESPONSE
from lumenkg.operators.relational import first_wins
from lumenkg.plans import jobs, registry
from lumenkg.streaming import incremental
from tests.engine.test_jobs import ALIASES, ASKED, FOUND
from tests.engine.test_outcomes import png

SF = "/root/testdata/sf0.001"


def test_triples_are_first_wins_across_batches_and_restarts(spark, tmp_path):
    incremental.use_state_store(spark)
    triples = registry._clean(spark, SF).select("img_id", "ord", "head", "relation", "tail").limit(60).persist()
    parts = [triples.filter("ord % 3 < 2"), triples.filter("ord % 3 > 0").withColumns({"head": F.upper("head"), "ord": F.col("ord") + 5}), triples]

    def run():
        stream = spark.readStream.schema(triples.schema).parquet(str(tmp_path / "in"))
        incremental.append_stream(incremental.first_triples(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
        return sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(*triples.columns).collect()))

    want = triples.limit(0)
    keys = ["img_id", F.lower("head"), F.lower("relation"), F.lower("tail")]
    for k, part in enumerate(parts):  # every run is a restart from the checkpoint
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ranked = want.withColumn("batch", F.lit(-1)).unionByName(part.withColumn("batch", F.lit(k)))
        want = spark.createDataFrame(first_wins(ranked, keys, ["batch", "ord"]).drop("batch").collect(), triples.schema)
        assert run() == sorted(map(tuple, want.collect()))


def test_requests_are_asked_once(spark, tmp_path):
    schema = "api string, key string, payload string, asked_at timestamp"
    rows = [("web", f"k{i % 4}", f"p{i}", None) for i in range(10)]

    def run():
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        incremental.append_stream(incremental.new_requests(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
        return sorted(r["key"] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    for k, want in ((0, 4), (1, 4), (2, 5)):
        more = [("web", "new", "p", None)] if k == 2 else []
        spark.createDataFrame(rows + more, schema).write.mode("append").parquet(str(tmp_path / "in"))
        assert len(run()) == want
    late = incremental.new_requests(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "1 hour")
    assert late.isStreaming and "asked_at" in late.columns


def test_crops_equal_slices_and_share_keys(spark, tmp_path):
    a = lambda x, y: (x * 3 % 256, y * 5 % 256, (x + y) % 256)
    (tmp_path / "a.png").write_bytes(png(60, 40, a))
    (tmp_path / "b.png").write_bytes(png(30, 30, lambda x, y: a(x + 10, y + 5)))
    (tmp_path / "c.png").write_bytes(b"no picture")
    views = spark.createDataFrame(
        [("a", "E1", "tight", 10, 5, 30, 25), ("a", "E2", "pad20", 0, 0, 99, 99), ("b", "E1", "tight", 0, 0, 20, 20), ("b", "E2", "tight", 1, 0, 21, 20), ("c", "E1", "tight", 0, 0, 9, 9)],
        "img_id string, id string, view string, x1 long, y1 long, x2 long, y2 long",
    )
    rows = {(r["img_id"], r["id"]): r for r in cr.crops(cr.pictures(spark, str(tmp_path)), views).collect()}
    whole = np.array([[a(x, y)[::-1] for x in range(60)] for y in range(40)], np.uint8)
    got = lambda k: np.frombuffer(rows[k]["pixels"], np.uint8).reshape(rows[k]["height"], rows[k]["width"], 3)
    assert set(rows) == {("a", "E1"), ("a", "E2"), ("b", "E1"), ("b", "E2")}
    assert (got(("a", "E1")) == whole[5:25, 10:30]).all() and (got(("a", "E2")) == whole).all()
    assert rows["a", "E1"]["crop"] == rows["b", "E1"]["crop"] != rows["b", "E2"]["crop"]


def test_equal_views_are_one_request(spark, tmp_path):
    shade = lambda x, y: (x // 8 % 256, y, 9)
    for name in ("a", "b"):
        (tmp_path / f"{name}.png").write_bytes(png(1000, 30, shade))
    detected = {"image_description": "d", "entities": [{"name": f"{n} tower", "type": "landmark", "bbox": [100 + 250 * k, 100, 200 + 250 * k, 900]} for k, n in enumerate(("one", "two", "three"))]}
    rows = [(api, k, body, "ok", 1) for k in ("a", "b") for api, body in (("detect", json.dumps(detected)), ("triples", json.dumps(FOUND)), ("aliases", json.dumps(ALIASES)), ("questions", ASKED))]
    images = spark.createDataFrame([(k, 1000, 30, f"{k}.png") for k in ("a", "b")], "img_id string, width int, height int, path string")

    def save(df, label):
        df.write.mode("overwrite").parquet(f"{tmp_path}/work/{label}")
        return spark.read.parquet(f"{tmp_path}/work/{label}")

    keyed = lambda views: cr.crop_keys(cr.pictures(spark, str(tmp_path)), views)
    out = jobs.enrich(images, spark.createDataFrame(rows, RESPONSE), save, view_search=True, crop_keys=keyed, transitive=True)
    asked = out["requests"].filter("api = 'serper_lens'").collect()
    assert len(asked) == 3 and all(len(r["key"]) == 16 for r in asked) and out["waiting"].count() == 2
