"""Image numbers of six digits share their first five, so an image's ``ord`` repeats and the SQL leaves its order open. The
engine's rows are then those of the SQL with ties ordered by the whole row, however the rows lie in the files."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from lumenkg.plans import registry
from lumenkg.plans.fixtures import TABLES
from lumenkg.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"
ROW = "ord, name, etype, w, h, rx1, ry1, rx2, ry2, confidence, level"
#: Orders of the SQL that leave ties, and how they are broken here.
DETECTIONS = (("lower(name) order by ord)", f"lower(name) order by {ROW})"), ("by img_id order by ord) as idx", f"by img_id order by {ROW}) as idx"))


def differing(spark, tmp_path, name: str, table: str, rows, key: str, ties) -> list[int]:
    """Rows that differ from the SQL with its ties broken, for ``rows`` stored by rising and by falling key."""
    sql = ORACLES[name]
    for open_, total in ties:
        assert sql.count(open_) >= 1
        sql = sql.replace(open_, total)
    out = []
    for way in (F.asc(key), F.desc(key)):
        root = tmp_path / f"{name}{len(out)}"
        root.mkdir()
        for t in TABLES:
            if t != table:
                os.symlink(f"{SF}/{t}.parquet", root / f"{t}.parquet")
        rows.coalesce(1).sortWithinPartitions(way).write.parquet(str(root / f"{table}.parquet"))
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from '{root}/{t}.parquet{'/*.parquet' if t == table else ''}'")
        found = con.execute(f"select * from ({sql})")
        names = [d[0] for d in found.description]
        want = set(found.fetchall())
        got = {tuple(r) for r in registry.QUERIES[name](spark, str(root)).select(*names).collect()}
        assert len(want) > 10
        out.append(len(want ^ got))
    return out


@pytest.fixture(scope="module")
def parts(spark):
    """The images 10000 to 10024 and 100000 to 100024, all numbered 10000 to 10024."""
    part = spark.read.parquet(f"{SF}/part.parquet")
    return part.withColumn("p_partkey", F.col("p_partkey") + 80_000).unionByName(part.withColumn("p_partkey", F.col("p_partkey") + 800_000))


@pytest.mark.parametrize("name", ["entities_kept", "bbox_areas", "area_extremum", "core_anchors", "direction_8way"])
def test_entities_of_numbers_that_repeat(spark, tmp_path, parts, name):
    assert differing(spark, tmp_path, name, "part", parts, "p_partkey", DETECTIONS) == [0, 0]


def test_outcomes_documents_and_lines_of_numbers_that_repeat(spark, tmp_path, parts):
    line = ("more), chr(10) order by ord)", "more), chr(10) order by ord, concat('- ', id, ': ', name))")
    for name, more in (("enrich_outcomes", ()), ("entity_documents", (("min_by(name, ord)", "min_by(name, idx)"),)), ("entity_lines", (line,))):
        assert differing(spark, tmp_path, name, "part", parts, "p_partkey", (*DETECTIONS, *more)) == [0, 0]


def test_discovered_names_of_numbers_that_repeat(spark, tmp_path, parts):
    places = (("lower(name) order by pos)", "lower(name) order by pos, name)"), ("by img_id order by pos)", "by img_id order by pos, name)"))
    assert differing(spark, tmp_path, "discovered_names", "part", parts, "p_partkey", (*DETECTIONS, *places)) == [0, 0]


def test_names_of_numbers_that_repeat(spark, tmp_path):
    """Every name holds the balances of its image: equally long names of one ``ord`` tie."""
    customer = spark.read.parquet(f"{SF}/customer.parquet").filter("c_custkey < 80").withColumns({"c_nationkey": F.lit(3), "c_acctbal": F.col("c_custkey") % 2 + 70})
    both = [customer.withColumn("c_custkey", F.col("c_custkey") + first) for first in (80_000, 800_000)]
    named = both[0].unionByName(both[1]).withColumn("c_name", F.concat(F.lit("Shop 70 71 #"), F.lpad((F.col("c_custkey") % 1009).cast("string"), 4, "0")))
    ties = (("order by length(k.name) desc, k.ord)", "order by length(k.name) desc, k.ord, k.name)"),)
    assert differing(spark, tmp_path, "cross_merge", "customer", named, "c_custkey", ties) == [0, 0]
