import random

import xxhash
from pyspark.sql import functions as F

from lumenkg.llm import simhash


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    part = {k: k for k in prints}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                ra, rb = sorted((root(a), root(b)))
                part[rb] = ra
    return {k: root(k) for k in prints}


TEXTS = [None, "", " \n\t ", "One", "one two", "ONE TWO", "a b c d e", "É a b c d", "x " * 500, "a b c d e"]


def test_fingerprint_matches_definition():
    for t in TEXTS:
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_links_match_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(6)]
    values = {b for b in base}
    for b in base:  # dense balls around each centre, and chains
        for _ in range(40):
            values.add(b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
        c = b
        for _ in range(5):
            c ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            values.add(c)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    for small, task in ((2, 4096), (2, 3), (64, 4096)):
        monkeypatch.setattr(simhash, "SMALL_GROUP", small)
        monkeypatch.setattr(simhash, "TASK_GROUP", task)
        marked = spark.createDataFrame([(i, v) for i, v in enumerate(signed)], "doc_id long, __sh_fp long")
        got = {r["doc_id"]: r["__sh_component"] for r in simhash._with_components(marked, "doc_id").collect()}
        assert got == brute_components(dict(enumerate(values)))


def test_classes_and_keepers(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, "One", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    out = simhash.near_duplicate_classes(docs).collect()
    want = brute_components({i: brute_fingerprint(t) for i, t in enumerate(TEXTS)})
    assert len(out) == len(rows)
    assert all(r["__sh_component"] == want[r["doc_id"]] for r in out)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))
    assert simhash.near_duplicate_classes(docs.limit(0)).count() == 0
    assert simhash.keep_one_of_each(docs.limit(0)).count() == 0


def test_components_of_null_or_equal_ids_stay_apart(spark):
    texts = ["one two three four", "alpha beta gamma delta", "red green blue black", "north south east west"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[3])]
    kept = simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(0, texts[0]), (0, texts[1]), (7, texts[2]), (7, texts[3])])


def test_variants_are_never_broadcast(spark):
    """An exploded table looks as small to Spark as its input; 64 or 2,016 rows a fingerprint went through the driver."""
    prints = spark.range(300).select(F.xxhash64("id").alias("fp"))
    for made in (simhash._met_variants(prints), simhash._variant_stars(prints)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
