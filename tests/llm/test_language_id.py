import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lumenkg.llm import language_id, queries

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    told = queries.op1_language_id(spark, SF).join(lang, "doc_id").filter("held_out")
    right, n = told.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right > 0.95


def test_lookups_equal_plain_convolution():
    rng = np.random.default_rng(0)
    x = rng.integers(0, language_id.CLASSES, (5, 40)).astype(np.int16)
    net = language_id.train(x, np.array([0, 1, 0, 1, 1]), ["a", "b"], language_id.TrainingBounds(window=40, epochs=2))
    plain = []
    for w, t in net.tables.items():
        a = sum(t[k][x[:, k : k + 40 - w + 1]] for k in range(w))
        plain.append(np.maximum(a.max(axis=1), 0))
    assert np.allclose(net.pooled(x), np.concatenate(plain, axis=1), atol=1e-4)


def test_edges(spark):
    rows = [(i, "the cat and the dog " * 5, "en", "x") for i in range(20)] + [(i + 50, "der hund und die katze " * 5, "de", "x") for i in range(20)]
    rows += [(100, None, "en", "x"), (101, "", None, "x"), (102, "12 !?", "de", "x"), (103, "und die katze " * 20000, None, "x"), (None, "the dog", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = {r["doc_id"]: r for r in language_id.predict(docs, language_id.fit(docs)).collect()}
    for k in (100, 101, 102):
        assert (out[k]["__li_lang"], out[k]["__li_score"]) == ("und", 0.0)
    assert out[103]["__li_lang"] == "de" and out[0]["__li_lang"] == "en" and out[0]["score"] == "x"
    assert all(0 <= r["__li_score"] <= 1 for r in out.values())
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id in (100, 101, 102)").count() == 0
    assert language_id.keep_identified(docs.limit(0)).count() == 0
    assert {r["__li_lang"] for r in language_id.predict(docs.withColumn("lang", F.lit(None).cast("string")), None).collect()} == {"und"}


def test_whole_text_scores_equal_plain_convolution():
    rng = np.random.default_rng(3)
    x = rng.integers(0, language_id.CLASSES, (6, 64)).astype(np.int16)
    net = language_id.train(x, np.array([0, 1, 2, 0, 1, 2]), ["a", "b", "c"], language_id.TrainingBounds(window=64, epochs=3))
    texts = ["short", "ünïcode слова и 字 " * 40, "x" * 64, "y" * 65, "The quick brown fox. " * 100, "é"]
    got, score = language_id._predicted(net, pa.array(texts))
    for k, text in enumerate(texts):
        data = text.encode()
        total, weight = np.zeros(3), 0
        for at in range(0, len(data), 64):
            symbols = np.zeros(64, int)
            part = data[at : at + 64]
            symbols[: len(part)] = [language_id.SYMBOL[b] for b in part]
            hot = np.eye(language_id.CLASSES)[symbols]
            pooled = []
            for w, table in net.tables.items():
                response = [[(hot[p : p + w] * table[:, :, f]).sum() for f in range(table.shape[2])] for p in range(64 - w + 1)]
                pooled.append(np.maximum(np.max(response, axis=0), 0))
            z = np.concatenate(pooled) @ net.dense + net.bias
            p = np.exp(z - z.max())
            total += p / p.sum() * len(part)
            weight += len(part)
        assert got[k] == net.languages[int(total.argmax())] and abs(score[k] - total.max() / weight) < 1e-4


def test_held_out_rows_are_never_learned_from(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs.write.parquet(str(tmp_path / "a/documents.parquet"))
    other = F.when(held, F.lit("zz")).otherwise(F.col("lang"))
    docs.withColumns({"lang": other, "source": F.lit("s")}).write.parquet(str(tmp_path / "b/documents.parquet"))
    told = [sorted(map(tuple, queries.op1_language_id(spark, str(tmp_path / k)).collect())) for k in "ab"]
    assert told[0] == told[1] and "zz" not in {r[2] for r in told[1]}
