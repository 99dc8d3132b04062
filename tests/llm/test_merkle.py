import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lumenkg.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, k int, grp string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def grow(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def brute(rows):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t) if t is not None else None
    groups = {}
    for r in rows:
        r = (r[0], r[2], r[3], r[4], r[1])[:0] + r
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = grow([leaf_of(r) for r in groups[g]])
    top = grow([trees[g][-1][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            own, proof = leaf_of(r), ""
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                own = leaf_of((*r[:4], lower(r[4])))
            for levels, place in ((trees[g], i), (top, at)):
                for level in levels[:-1]:
                    lo = place // 8 * 8
                    left, right = "".join(level[lo:place]), "".join(level[place + 1 : lo + 8])
                    own, proof, place = H(left, own, right), proof + left + right, place // 8
            out.append((str(r[0]), leaf_of(r), trees[g][-1][0], top[-1][0], H(proof), own, own == top[-1][0]))
    return sorted(out)


def table(rng, n, langs):
    rows = [(i, rng.choice(["web", None]), rng.choice(langs), rng.choice([5, None, -3]), rng.choice(["Some Text", "small", None, "", "É ÀB", "x:1-"])) for i in range(n)]
    return [(*r, "a", 1, "g") for r in rows]


@pytest.mark.parametrize("n,langs", [(1, ["en"]), (8, ["en", None]), (9, ["en"]), (700, ["en", "en", "en", "de", None, "", "é", "z"]), (600, [f"l{i}" for i in range(90)])])
def test_manifest_equals_brute_force(spark, tmp_path, monkeypatch, n, langs):
    if n == 700:
        monkeypatch.setattr(merkle, "BROADCAST_PARTS", 0)
    rows = table(random.Random(n), n, langs)
    if n > 100:
        rows += [(None, "s", "en", 1, "Null Id", "", 0, ""), (None, None, None, None, None, None, None, None), rows[5], rows[5], (5, "other", rows[5][2], 1, "Tie", "", 0, ""), (n, "s", "en", 9, "Long Text " * 20_000, "", 0, "")]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in queries.op13_merkle_manifest(spark, str(tmp_path)).collect())
    assert got == brute(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op13_merkle_manifest(spark, str(tmp_path)).count() == 0


def test_verification_of_a_changed_table(spark):
    docs = spark.createDataFrame(table(random.Random(5), 100, ["a", "b"]), SCHEMA)
    rows = merkle.proofs(merkle.build(docs, FIELDS, "lang", "doc_id"))
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 7, "forged").otherwise(F.col("text"))).unionByName(docs.filter("doc_id = 1").withColumn("doc_id", F.lit(999).cast("long")))
    told = {r["id"]: r["verified"] for r in merkle.verify(rows, changed, FIELDS, "doc_id").collect()}
    assert [k for k, ok in told.items() if not ok] in ([7, 999], [999, 7]) and len(told) == 101
