import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lumenkg.llm import queries, spelling

SCHEMA = "doc_id long, text string, n long, word string"


def distance_one(a, b):
    """Brute force: exactly one letter inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(rows, drop=199):
    total = Counter()
    for doc, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "\x7f" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                word = run[: h % len(run)] + run[h % len(run) + 1 :] if drop and h % drop == 0 else run
                if len(word) >= 6:
                    total[word] += 1
            run = ""
    return {w: n for w, n in total.items() if n >= 5}


def brute_variants(counts):
    out, forms = {}, {}
    for w in counts:
        near = [x for x in counts if distance_one(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
        out[w] = len(near)
    rows = set()
    for w in counts:
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.add((w, forms[w], root, counts[w], out[w], counts.get(forms[w])))
    return rows


def corpus(rng, n_docs):
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 8))) for _ in range(40)]
    base += ["".join(rng.sample("abcdef", 6)) for _ in range(60)]  # anagrams: one vector, many words
    rows = []
    for k in range(n_docs):
        words = []
        for _ in range(60):
            w = base[min(int(rng.paretovariate(0.6)) - 1, len(base) - 1)]
            if rng.random() < 0.3:
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abc") + w[i:], w[:i] + rng.choice("abcÿ") + w[i + 1 :]])
            words.append(rng.choice([w, w.upper() if w.isascii() else w, w.capitalize() if w.isascii() else w]))
        rows.append((k, rng.choice([" ", ", ", "1", "\n", "ł"]).join(words), 1, "x"))
    return rows + [(None, "abcdef " * 9, 2, None), (3, None, None, None), (4, "", 0, ""), (5, "z" * 70_000 + " " + "y" * 70_000, 1, "w"), (5, "abcdef", 1, "w"), (5, "abcdef", 1, "w")]


@pytest.mark.parametrize("cell,sample,direct,held", [(8192, 65536, 64, 1 << 18), (40, 65536, 0, 50), (30, 100, 4, 1 << 18)])
def test_variants_equal_brute_force(spark, tmp_path, monkeypatch, cell, sample, direct, held):
    for name, value in (("CELL", cell), ("SAMPLE", sample), ("DIRECT_PAIRS", direct), ("HELD_WORDS", held), ("LEAF", 4)):
        monkeypatch.setattr(spelling, name, value)
    rows = corpus(random.Random(cell), 400)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op11_spelling_variants(spark, str(tmp_path)).collect()]
    want = brute_variants(brute_counts([r[:2] for r in rows]))
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 150


def test_chains_of_forms_reach_their_last(spark):
    words = {"aaaaaa": 5, "aaaaab": 30, "aaaabb": 200, "aaabbb": 1500, "aabbbb": 9000, "zzzzzz": 7}
    docs = spark.createDataFrame([(1, " ".join(f"{w} " * n for w, n in words.items()))], "doc_id long, text string")
    got = {r["word"]: r for r in spelling.spelling_variants(docs).collect()}
    assert {w: r["root"] for w, r in got.items()} == {**{w: "aabbbb" for w in words}, "zzzzzz": "zzzzzz"}
    assert got["aaaaaa"]["form"] == "aaaaab" and got["zzzzzz"]["form"] is None
    groups = {r["root"]: r for r in spelling.variant_groups(spelling.spelling_variants(docs)).collect()}
    assert groups["aabbbb"]["n_words"] == 5 and groups["aabbbb"]["n_total"] == sum(words.values()) - 7 and groups["aabbbb"]["words"][0] == "aabbbb"


def test_ties_go_to_the_smallest_word(spark):
    docs = spark.createDataFrame([(1, "letters " * 5 + "ÿetters " * 30 + "betters " * 30)], "doc_id long, text string")
    got = {r["word"]: r["form"] for r in spelling.spelling_variants(docs).collect()}
    assert got["letters"] == "betters"


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0


def test_box_search_equals_brute_force():
    rng = np.random.default_rng(2)
    points = np.unique(rng.integers(0, 3, (400, 8)).astype(np.int16), axis=0)
    points = np.concatenate([points, np.zeros((len(points), spelling.LETTERS - 8), np.int16)], axis=1)
    for tight in (True, False):
        tree = spelling.KdTree(points, lambda k: k <= 5, tight)
        queries_ = points[::7]
        for falls, rises in ((1, 1), (0, 1)):
            seen = set()
            for _, a, b, rows in tree.reach(queries_, falls, rises):
                for q in rows:
                    for p in tree.order[a:b]:
                        d = points[p] - queries_[q]
                        if np.maximum(d, 0).sum() <= rises and np.maximum(-d, 0).sum() <= falls:
                            seen.add((q, p))
            want = {(q, p) for q in range(len(queries_)) for p in range(len(points)) if np.maximum(points[p] - queries_[q], 0).sum() <= rises and np.maximum(queries_[q] - points[p], 0).sum() <= falls}
            assert seen == want
        places = tree.place(points)
        for leaf, a, b, _ in tree.reach(points, 99, 99):
            assert (places[tree.order[a:b]] == leaf).all()
