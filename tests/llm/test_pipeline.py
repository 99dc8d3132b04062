"""The stages on a small table, each held against a brute-force version of its own input."""

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lumenkg.llm import simhash
from tests.llm.test_quality_and_warc import brute_counts

SF = "/root/testdata/sf0.001"


def brute_keepers(rows):
    prints = {k: simhash.fingerprint(t) for k, t in rows.items()}
    part = {k: k for k in rows}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    ids = sorted(rows)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                lo, hi = sorted((root(a), root(b)))
                part[hi] = lo
    return {root(k) for k in ids}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        seen.append((name, docs, after))
        docs = after
    assert [n for n, _, _ in seen] == ["quality_rules", "language_id", "simhash_near_dedup", "substring_dedup", "best_fit_packing"]
    assert all(after.columns == columns for _, _, after in seen[:-1])
    text = lambda df: {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}

    before, after = text(seen[0][1]), text(seen[0][2])
    for k, t in before.items():
        n = brute_counts(t)
        if n["n_words"] < 50 or 100 * n["n_repeat_words"] > 50 * n["n_words"]:
            assert k not in after
        elif n["n_symbols"] == 0 and n["n_dup_lines"] == 0:
            assert after[k] == t
    assert text(seen[1][2]) == text(seen[1][1])  # every document here is in a language that was learned
    before, after = text(seen[2][1]), text(seen[2][2])
    assert after.keys() == brute_keepers(before)
    before, after = text(seen[3][1]), text(seen[3][2])
    windows = defaultdict(set)
    for k, t in after.items():
        words = re.split("[\x20\x09-\x0d]+", t.lower())
        for i in range(len(words) - 50):
            windows[tuple(words[i : i + 51])].add(k)
    assert not [w for w, ids in windows.items() if len(ids) > 1], "no passage of over 50 words is left in two documents"
    owners = defaultdict(set)
    for k, t in before.items():
        words = re.split("[\x20\x09-\x0d]+", t.lower())
        for i in range(len(words) - 9):
            owners[tuple(words[i : i + 10])].add(k)
    for k, t in before.items():
        words = re.split("[\x20\x09-\x0d]+", t.lower())
        if all(len(owners[tuple(words[i : i + 10])]) == 1 for i in range(len(words) - 9)):
            assert after[k] == t, "documents that share no ten words with others stay as they are"
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = seen[4][2].orderBy("doc_id", "piece").collect()
    filled = defaultdict(list)
    got = defaultdict(list)
    for r in pieces:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
        got[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
    for k, t in after.items():
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [0]
        assert got[k] == [(a, n, zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes())) for a, n, _ in got[k]] and sum(n for _, n, _ in got[k]) == len(ids)
    assert all(sum(n for _, n in v) <= 2048 for v in filled.values())
    assert len(filled) <= 1.05 * sum(n for v in filled.values() for _, n in v) / 2048 + 1
    assert seen[4][2].agg(F.count_distinct("doc_id")).first()[0] == len(after)
