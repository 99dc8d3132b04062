from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumenkg.llm import language_id, warc_archive, wavelet_store, workspace


class Cluster:
    """A session that looks like one on a cluster."""

    class conf:
        get = staticmethod(lambda name, default=None: {"spark.master": "spark://host:7077"}.get(name, default))


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.scratch_path(Cluster(), "x")


def test_a_setting_holds_inside_its_block_only(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    workspace.materialise(spark.range(9).groupBy((F.col("id") % 2).alias("k")).count(), "x")
    assert spark.conf.get(name, None) == before


def test_calls_of_one_stage_do_not_disturb_each_other(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 3 + "some other words here " * 1, "en", f"s{i % 2}") for i in range(6)], "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("text", F.concat_ws(" ", "text", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda x: F.concat(F.lit("w"), x * F.col("doc_id"))), " ")))
    a, b = (corpus_pipeline.STAGES[0][1](spark, docs, "") for _ in range(2))
    assert a.count() == b.count() == 5  # document 0 repeats one word


def test_stages_on_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(80))
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, ids string"
    rows = [(1, text, "en", "s", 9, "k", "x"), (1, text, "en", None, 9, None, None), (None, text.replace("word", "other"), "en", "s", 9, "k", "x"), (2, None, None, None, None, None, None), (3, "", "en", "s", 0, "", "")]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = workspace.materialise(stage(spark, docs, ""), "out")
            if name != "best_fit_packing":
                assert out.columns == docs.columns
            docs = out
        assert docs.count() == (2 if docs.count() else 0)


def test_every_language_is_learned_from_a_bounded_sample(spark):
    rows = [(i, f"tongue{k} " * 4, f"l{k:03d}") for k in range(70) for i in (1, 1, 1, k)]
    bounds = language_id.TrainingBounds(texts_per_language=2, epochs=1)
    net = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), bounds=bounds)
    assert net.languages == [f"l{k:03d}" for k in range(70)]


def test_shards_are_cut_by_their_running_total(spark, tmp_path):
    docs = spark.createDataFrame([(i, "several words of text " * 50) for i in range(30)], "doc_id long, text string").coalesce(1)
    wavelet_store.write_shards(docs, str(tmp_path / "w"), shard_tokens=500)
    assert max(r["n_docs"] for r in spark.read.parquet(str(tmp_path / "w")).select("n_docs").collect()) <= 3


def test_a_damaged_header_raises(spark, tmp_path):
    root = str(tmp_path / "a")
    warc_archive.write_archive(spark.createDataFrame([(1, "u", "body")], "page_id long, url string, html string"), root)
    heads = spark.read.parquet(root + "/headers").withColumn("header", F.encode(F.regexp_replace(F.decode("header", "UTF-8"), "sha1:.", "sha1:z"), "UTF-8"))
    heads.write.parquet(str(tmp_path / "b/headers"))
    spark.read.parquet(root + "/payloads").write.parquet(str(tmp_path / "b/payloads"))
    with pytest.raises(Exception, match="damaged record"):
        warc_archive.read_index(spark, str(tmp_path / "b")).collect()


def test_languages_of_rows_that_share_their_id_are_learned(spark):
    german = [(9, f"der hund und die katze {i} gehen " * 3, "de") for i in range(300)]
    english = [(i, f"the cat and the dog {i} are here " * 3, "en") for i in range(300)]
    schema = "doc_id long, text string, lang string"
    bounds = language_id.TrainingBounds(texts_per_language=20, epochs=2)
    for rows in (german + english, [(None, t, k) for _, t, k in german + english], [(9, "der hund und die katze", "de")] * 300 + english):
        net = language_id.fit(spark.createDataFrame(rows, schema), bounds=bounds)
        assert net.languages == ["de", "en"]


def test_results_that_wait_keep_their_tables(spark):
    text = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(i, text + f" {i}" * 2, "en", "s") for i in range(4)], "doc_id long, text string, lang string, source string")
    stages = [f for _, f in corpus_pipeline.STAGES]
    a, b = stages[0](spark, docs, ""), stages[0](spark, docs, "")
    first = workspace.materialise(a, "a")
    stages[1](spark, first, "")
    assert b.count() == 4

    def chain(_):
        done = docs
        for stage in stages[:3]:
            done = workspace.materialise(stage(spark, done, ""), "chain")
        return done.count()

    with ThreadPoolExecutor(2) as pool:
        assert len(set(pool.map(chain, range(2)))) == 1
