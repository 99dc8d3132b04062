import numpy as np
from pyspark.sql import functions as F

from lumenkg.llm import posting_lists, queries


def brute(rows, k=20):
    sound = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8})
    ids, x = np.array([i for i, _ in sound]), np.array([v for _, v in sound], float)
    out = {}
    for i, v in zip(ids, x):
        if i % 20 == 0:
            s = x @ v
            out[i] = [(int(ids[j]), s[j]) for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
    return out


def rows_of(n, rng):
    centres = rng.normal(size=(5, 8))
    rows = [(i, [float(np.float32(c)) for c in centres[i % 5] + rng.normal(size=8) * 0.6]) for i in range(n)]
    same = rows[3][1]
    rows += [(n + i, same) for i in range(120)]
    return rows + [(None, same), (n + 200, None), (n + 220, [0.0] * 8), (n + 240, [float("nan")] * 8), (n + 260, [1.0] * 5), (n + 280, [None] * 8), rows[0], rows[20]]


def test_every_list_visited_is_exact(spark):
    rows = rows_of(700, np.random.default_rng(2))
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<float>, score double")
    everything = posting_lists.IndexOptions(list_size=40, shelf=3, probe_ratio=1e9, block=50)
    got = {}
    for r in posting_lists.search(df, F.col("vec_id") % 20 == 0, options=everything).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    want = brute(rows)
    assert got.keys() == want.keys()
    for q, hits in want.items():
        assert [(v, n) for v, _, n in got[q]] == [(v, k + 1) for k, (v, _) in enumerate(hits)]
        assert np.allclose([s for _, s, _ in got[q]], [s for _, s in hits], rtol=1e-12)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], schema)
    out = posting_lists.search(few, F.col("vec_id") % 20 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out] == [(0, 1, 1, 0.5), (0, 2, 2, 0.0)]
    assert posting_lists.search(few.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def shares(df, is_query):
    """(vectors scored by a query on the mean, copies a vector has on the mean), both as shares of all vectors."""
    _, members, postings, visits = posting_lists.index_tables(df, is_query)
    one = lambda t, name: t.select("class_id", F.explode("lists").alias("list")).withColumnRenamed("class_id", name)
    held = one(postings, "stored").groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    scored = one(visits, "asked").join(held, "list").agg(F.sum("n")).first()[0]
    n = members.select("class_id").distinct().count()
    return scored / visits.select("class_id").distinct().count() / n, one(postings, "stored").count() / n


def recall(df, got, is_query):
    table = df.toPandas()
    ids, x = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), float)
    hit = n = 0
    for q in ids[is_query(ids)]:
        s = x @ x[ids == q][0]
        want = [int(ids[j]) for j in np.lexsort((ids, -s)) if ids[j] != q][:20]
        hit, n = hit + len(got[q] & set(want)), n + len(want)
    return hit / n


def test_clustered_vectors_are_pruned(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 6000)] + 0.4 * rng.normal(size=(6000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    scored, copies = shares(df, F.col("vec_id") % 20 == 0)
    got = posting_lists.search(df, F.col("vec_id") % 20 == 0).toPandas().groupby("query_id")["vec_id"].apply(set)
    found = recall(df, got, lambda ids: ids % 20 == 0)
    print(f"clustered: {scored:.2f} of the vectors scored, {copies:.2f} copies, recall {found:.3f}")
    assert scored < 0.3 and copies > 1.02 and found >= 0.9 and (got.apply(len) == 20).all()


def test_recall_on_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = queries.op8_posting_lists(spark, "/root/testdata/sf0.1").toPandas().groupby("query_id")["vec_id"].apply(set)
    scored, copies = shares(df, F.col("vec_id") % 20 == 0)
    found = recall(df, got, lambda ids: ids % 20 == 0)
    print(f"given: {scored:.2f} of the vectors scored, {copies:.2f} copies, recall {found:.3f}")
    assert found >= 0.9 and scored < 1 and copies > 1


def test_an_id_with_several_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 2.0]), (1, [1.0, 0.5]), (2, [0.0, 1.0]), (3, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = posting_lists.search(df, F.col("vec_id") % 20 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out] == [(0, 1, 2, 2.0), (0, 2, 1, 1.0), (0, 3, 3, 1.0)]


def test_no_list_is_over_twice_the_mean(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16))
    crowd = np.minimum(rng.zipf(1.5, 6000) - 1, 39)
    x = centres[crowd] + 0.3 * rng.normal(size=(6000, 16))
    x[:300] = centres[0] + 1e-9 * rng.normal(size=(300, 16))  # no centroid tells these apart
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    _, members, postings, _ = posting_lists.index_tables(df, F.col("vec_id") % 20 == 0)
    sizes = [r["n"] for r in postings.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()]
    got = posting_lists.search(df, F.col("vec_id") % 20 == 0).toPandas().groupby("query_id")["vec_id"].apply(set)
    found = recall(df, got, lambda ids: ids % 20 == 0)
    print(f"skewed: {len(sizes)} lists of {min(sizes)} to {max(sizes)}, mean {np.mean(sizes):.1f}, recall {found:.3f}")
    assert max(sizes) <= 2 * np.mean(sizes) and found >= 0.9 and (got.apply(len) == 20).all()
    assert postings.select("class_id").distinct().count() == 6000
