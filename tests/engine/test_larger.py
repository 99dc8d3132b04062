"""What only shows on tables larger than the given ones: numbers that repeat, long answers, many texts."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from lumenkg.plans import registry
from lumenkg.plans.fixtures import TABLES
from lumenkg.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def folder(tmp_path):
    """Gives a folder with the given tables; those handed over replace theirs."""

    def made(**tables) -> str:
        root = tmp_path / "sf"
        root.mkdir()
        for t in TABLES:
            if t in tables:
                tables[t].write.parquet(str(root / f"{t}.parquet"))
            else:
                os.symlink(f"{SF}/{t}.parquet", root / f"{t}.parquet")
        return str(root)

    return made


def equal_to_sql(spark, sf: str, name: str) -> int:
    """The number of rows, which are those of the SQL."""
    con = duckdb.connect()
    for t in TABLES:
        at = f"{sf}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{at}{'/*.parquet' if os.path.isdir(at) else ''}'")
    rows = con.execute(f"select * from ({ORACLES[name]})")
    names = [d[0] for d in rows.description]
    want = sorted(map(repr, rows.fetchall()))
    got = sorted(repr(tuple(r)) for r in registry.QUERIES[name](spark, sf).select(*names).collect())
    assert got == want
    return len(got)


def test_detected_boxes_with_numbers_that_repeat(spark, folder):
    """Image numbers of six digits share their first five, so an image's numbers repeat."""
    part = spark.read.parquet(f"{SF}/part.parquet")
    both = part.unionByName(part.withColumn("p_partkey", F.col("p_partkey") + 800_000)).filter("p_partkey < 40 or p_partkey < 800040 and p_partkey >= 800000")
    far = both.withColumn("p_partkey", F.when(F.col("p_partkey") < 800_000, F.col("p_partkey") + 80_000).otherwise(F.col("p_partkey")))
    assert equal_to_sql(spark, folder(part=far), "detected_boxes") == 60


def test_deep_read_urls_with_pages_that_changed(spark, folder):
    """A URL read twice, with another text each time."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    later = pages.withColumns({"page_id": F.col("page_id") + 4000, "html": F.concat(F.lit("later "), "html")})
    assert equal_to_sql(spark, folder(pages=pages.unionByName(later)), "deep_read_urls") == 2 * registry.deep_read_urls(spark, SF).count() > 0


def test_braces_of_long_answers(spark):
    """The plan steps over braces, not over every character, and reads a long answer once."""
    from lumenkg.functions import strings as s

    body = '{"triples": [' + ", ".join('{"head": "' + "x" * 50_000 + '"}' for _ in range(20)) + "]}"
    cases = [("Sure! " + body + " {} }", body), ("}{a}}", "{a}"), ("{{}", None), ("a}", None), ("", None), (None, None), ("é{b{c}}d", "{b{c}}")]
    rows = spark.createDataFrame([(k, raw) for k, (raw, _) in enumerate(cases)], "k int, raw string")
    got = rows.select("k", s.braced(F.col("raw")).alias("x")).orderBy("k").collect()
    assert [r["x"] for r in got] == [want for _, want in cases]
    plan = rows.select(s.extract_json(F.col("raw")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("aggregate(") == 2  # one scan for plain answers, one for fenced ones


def test_bench_rows_are_numbered_by_all_tasks(spark):
    """No window takes whole rows to one task: what it numbers are the tasks' totals."""
    assert equal_to_sql(spark, SF, "bench_rows") > 1000
    plan = registry.QUERIES["bench_rows"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    single = [line for line in plan.splitlines() if "Window [" in line and "row_number" in line]
    assert not single and "_n" in plan


def test_both_mentioned_with_items_that_repeat(spark, folder):
    """Items that come twice, names of one letter, and equal names; a document's pairs are counted without another shuffle of its names."""
    items = spark.createDataFrame([(1, "x y the z of"), (1, "x y the z of"), (2, "x y A z e"), (3, "x y in z in"), (4, "x y  z of"), (5, "x y der z es"), (6, "x")], "item_id long, text string")
    root = folder(benchmark=items)
    assert equal_to_sql(spark, root, "both_mentioned") > 100
    plan = registry.QUERIES["both_mentioned"](spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(doc_id" in line and "a#" in line]
