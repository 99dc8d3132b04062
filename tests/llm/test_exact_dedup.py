import hashlib
import random
import re

import pytest

from lumenkg.llm import exact_dedup as ed
from lumenkg.llm import queries

SCHEMA = "doc_id long, text string, digest string, row int, shard string"


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def key(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_filter_inserts_deletes_and_fills():
    rng, held, live = random.Random(1), ed.CuckooFilter(64), set()
    for step in range(3000):
        k = rng.randrange(400)
        if k in live:
            held.delete(key(k))
            live.remove(k)
        elif key(k) not in held and len(live) < 200:
            assert held.insert(key(k))
            live.add(k)
        assert all(key(x) in held for x in rng.sample(sorted(live), min(5, len(live))))
    assert sum(key(i) in held for i in range(10_000, 12_000)) < 20, "few false hits"
    assert ed.CuckooFilter(64, bytes(held.slots)).slots == held.slots


def test_index_resizes_from_its_keys_and_verifies_hits(monkeypatch):
    index = ed.CuckooIndex(ed.CuckooFilter(2))
    for i in range(500):
        assert index.find(key(i)) is None
        index.insert(key(i), [i])
    assert index.resizes >= 5 and all(index.find(key(i)) == [i] for i in range(500))
    for i in range(0, 500, 2):
        index.delete(key(i))
    assert index.size == 250 and [index.find(key(i)) is None for i in range(6)] == [True, False] * 3
    monkeypatch.setattr(ed.CuckooFilter, "places", lambda self, k: (1, 0, self.other(0, 1)))  # all fingerprints agree
    index = ed.CuckooIndex()
    for i in range(4):
        assert index.find(key(i)) is None
        index.insert(key(i), [i])
    assert index.false_hits == 3 and index.find(key(2)) == [2]


def rows(rng):
    texts = ["a b", "a  b", "a\tb\n", " a b", "", None, "\x0b", "x" * 200_000, "A b", "a b"]
    out = [(i, rng.choice(texts), "d", 1, "s") for i in range(300)]
    out += [(i, f"text {i % 40}", None, None, None) for i in range(300, 500)]
    return [*out, (None, "a b", "", 0, ""), (None, "only", "", 0, ""), (None, "only", "", 0, ""), (7, "same", "", 0, ""), (7, "same", "", 0, "")]


@pytest.mark.parametrize("task,shard,heavy", [(1 << 17, 1 << 18, 1000), (7, 20, 3)])
def test_classes_equal_brute_force(spark, tmp_path, monkeypatch, task, shard, heavy):
    for name, value in (("TASK_KEYS", task), ("SHARD_KEYS", shard), ("HEAVY_PART", heavy)):
        monkeypatch.setattr(ed, name, value)
    given = rows(random.Random(3))
    docs = spark.createDataFrame(given, SCHEMA).repartition(5)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_exact_dedup(spark, str(tmp_path)).collect()
    groups = {}
    for doc, text, *_ in given:
        groups.setdefault(norm(text), []).append(doc)
    want = sorted(
        (str(doc), str(min((x for x in groups[norm(t)] if x is not None), default=None)), len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for doc, t, *_ in given
    )
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in kept}) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    left = ed.drop_duplicates(spark.read.parquet(str(tmp_path / "documents.parquet")))
    assert left.columns == docs.columns and sorted(norm(r["text"]) for r in left.collect()) == sorted(groups)


def test_empty_and_string_ids(spark):
    assert ed.duplicate_classes(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([("b", "t"), ("a", "t "), ("c", "t\n")], "doc_id string, text string")
    assert {(r["id"], r["least_id"], r["rows"]) for r in ed.duplicate_classes(docs).collect()} == {("b", "b", 1), ("a", "a", 2), ("c", "a", 2)}


def test_index_lives_through_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ed, "SHARD_KEYS", 100)
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    first = frame([(i, f"text {i % 200}") for i in range(600)])
    index = ed.new_index(spark, 300, str(tmp_path / "index")).apply_changes(inserts=first)
    assert index.live().count() == 600 and index.filters().agg({"keys": "sum"}).first()[0] == 200
    told = {r["id"]: (r["hit"], r["known"]) for r in index.probe(frame([(1, "text  7"), (2, "new"), (3, None)])).collect()}
    assert told[1] == (True, True) and not told[2][1] and not told[3][1]
    # two of the three rows of text 7 go: it stays known; all rows of text 8 go: it doesn't
    index = index.apply_changes(deletes=frame([(7, ""), (207, ""), (8, ""), (208, ""), (408, "")]), inserts=frame([(700, "new")]))
    told = {r["id"]: r["known"] for r in index.probe(frame([(1, "text 7"), (2, "text 8"), (3, "new")])).collect()}
    assert told == {1: True, 2: False, 3: True} and index.filters().agg({"keys": "sum"}).first()[0] == 200
    before = {r["shard"]: r["buckets"] for r in index.filters().collect()}
    index = index.apply_changes(inserts=frame([(i, f"more {i}") for i in range(1000, 4000)]))
    after = {r["shard"]: (r["buckets"], r["resizes"], r["keys"]) for r in index.filters().collect()}
    assert all(after[s][0] > before[s] and after[s][1] > 0 for s in before) and sum(v[2] for v in after.values()) == 3200
    asked = frame([(i, f"more {i}") for i in range(1000, 4000, 50)] + [(0, "text 9"), (1, "text 8")])
    assert [r["id"] for r in index.probe(asked).collect() if not r["known"]] == [1]
    assert ed.new_index(spark, 0, str(tmp_path / "none")).probe(frame([(1, "x")])).first()["hit"] is False
