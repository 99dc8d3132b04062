import random

import numpy as np

from lumenkg.llm import compact_windows as cw

OPTIONS = cw.WindowOptions()


def test_windows_cover_every_subsequence_once():
    rng = np.random.default_rng(0)
    for n in (0, 3, 10, 60, 150):
        v = rng.integers(0, 40, n).astype(np.uint64) << np.uint64(40)  # many ties
        bounds = np.array([0, n // 3, n])
        left, c, right = cw.compact_windows(v, bounds, 4)
        want = {(i, j, i + int(np.argmin(v[i : j + 1]))) for x, y in zip(bounds, bounds[1:]) for i in range(x, y) for j in range(i + 3, y)}
        got = [(i, j, k) for a, k, b in zip(left, c, right) for i in range(a, k + 1) for j in range(k, b + 1) if j - i >= 3]
        assert len(got) == len(set(got)) and set(got) == want


def test_least_shingles_are_those_of_all_windows():
    rng = np.random.default_rng(1)
    shingles = cw.mix(rng.integers(0, 1 << 62, 300).astype(np.uint64))
    shingles[40:60] = shingles[10:30]  # ties
    o = cw.WindowOptions(min_words=24, functions=3)
    t, bounds = o.min_shingles, np.array([0, 130, 140, 300])
    hashes = [cw.mix(shingles ^ cw.mix(np.uint64([k]))[0]) >> np.uint64(9) for k in (1, 2, 3)]
    starts = [s for x, y in zip(bounds, bounds[1:]) for s in range(x, y - t + 1)]
    least = [[s + int(np.argmin(h[s : s + t])) for s in starts] for h in hashes]
    place, first, last = cw.least_shingles(shingles, bounds, o)
    assert set(place) == {c for row in least for c in row} and len(set(place)) == len(place)
    want = dict(zip(starts, least[0]))
    got = {s: int(c) for c, a, b in zip(place, first, last) for s in range(a, b + 1)}
    assert got == want


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    prose = lambda n: [word() for _ in range(n)]
    passage, other, line, long = prose(55), prose(80), prose(9), prose(400)
    changed = list(passage)
    changed[27] = "edited"
    docs = {i: prose(120) + line + prose(90) for i in range(40)}
    docs[100] = prose(70) + passage + prose(60)
    docs[101] = prose(33) + passage + prose(61) + line
    docs[102] = passage
    docs[103] = prose(40) + changed + prose(50)
    docs[104] = other + prose(20)
    docs[105] = prose(200) + other + prose(10) + passage
    docs[106] = docs[107] = docs[5]
    docs[108] = long
    docs[109] = [w if i % 90 else "new" + w for i, w in enumerate(long)]
    rows = [(k, " ".join(v), "s") for k, v in docs.items()] + [(200, None, "s"), (201, "", "s"), (202, "short text", "s"), (203, "short text", "s"), (None, "a " * 60, "s")]
    return rows + [(100, " ".join(docs[100]), "s")], " ".join(passage), " ".join(other), line


def test_planted_passages(spark):
    rows, passage, other, line = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, first string")
    text = {k: t for k, t, _ in rows}
    found = cw.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in found} == {101, 102, 103, 105, 106, 107, 109}
    for r in found:
        assert r["similarity"] >= 0.8 and r["stop_word"] - r["first_word"] >= 50
        mine = text[r["doc_id"]].split()[r["first_word"] : r["stop_word"]]
        theirs = text[r["source_doc_id"]].split()[r["source_first_word"] : r["source_stop_word"]]
        a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (mine, theirs))
        assert abs(len(a & b) / len(a | b) - r["similarity"]) < 1e-9
    kept = cw.drop_repeated_passages(docs)
    assert kept.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    whole = " ".join(t for _, t in set(left) if t)
    assert whole.count(passage) == 1 and whole.count(other) == 1
    ids = [k for k, _ in left]
    assert not {102, 106, 107} & set(ids) and ids.count(100) == 2
    for k in [*range(5), *range(6, 40), 104, 108, 200, 201, 202, 203, None]:
        assert (k, text[k]) in left
    assert cw.drop_repeated_passages(docs.limit(0)).count() == 0 and cw.repeated_passages(docs.limit(0)).count() == 0


def test_long_texts_are_cut_into_overlapping_pieces(spark):
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    rows = [(1, " ".join(words[:977] + passage + words[977:])), (2, " ".join(passage))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = cw.repeated_passages(docs, options=cw.WindowOptions(segment=100)).collect()
    assert any((r["doc_id"], r["source_doc_id"], r["source_first_word"], r["source_stop_word"]) == (2, 1, 977, 1037) for r in found)


def words_of(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def test_passages_around_a_frequent_line_are_found(spark):
    rng = random.Random(11)
    line = words_of(rng, 45)
    rows = [(i, " ".join(words_of(rng, 60) + line + words_of(rng, 60))) for i in range(40)]
    want = set()
    for i in range(60):
        tail = words_of(rng, 5)
        rows += [(100 + 2 * i + k, " ".join(words_of(rng, 60) + line + tail + words_of(rng, 60))) for k in (0, 1)]
        want.add((101 + 2 * i, 100 + 2 * i))
    found = cw.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["source_doc_id"]) for r in found} == want
    assert all(r["similarity"] >= 0.8 and r["first_word"] <= 60 and r["stop_word"] >= 110 for r in found)


def test_repeats_within_a_document_meet_earlier_documents(spark):
    rng = random.Random(12)
    passage = words_of(rng, 60)
    first = [(1, " ".join(words_of(rng, 40) + passage + words_of(rng, 40)))]
    again = [(2, " ".join(words_of(rng, 70) + passage + words_of(rng, 70) + passage + words_of(rng, 30)))]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(first + again, 2), "doc_id long, text string")  # two tasks
    found = cw.repeated_passages(docs).collect()
    assert {(r["doc_id"], r["source_doc_id"]) for r in found} == {(2, 1)}
    cut = {w for r in found for w in range(r["first_word"], r["stop_word"])}
    assert cut >= {*range(70, 130), *range(200, 260)}
    left = " ".join(r["text"] for r in cw.drop_repeated_passages(docs).collect())
    assert left.count(" ".join(passage)) == 1


def test_near_passages_of_one_window_are_found(spark):
    rng, rows = random.Random(13), []
    for i in range(400):
        passage = words_of(rng, rng.randint(50, 60))
        edited = list(passage)
        edited[rng.randint(6, len(passage) - 7)] = "edited"
        rows += [(2 * i + k, words_of(rng, 50) + p + words_of(rng, 50)) for k, p in enumerate((passage, edited))]
    near = set()
    for (_, a), (k, b) in zip(rows[::2], rows[1::2]):  # brute force
        hashes = [cw.word_hashes(*cw.utf8_buffer(cw.pa.array([" ".join(x)])))[0] for x in (b, a)]
        near |= {(k, k - 1)} if cw.shared_blocks(*hashes, OPTIONS) else set()
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in rows], "doc_id long, text string")
    found = {(r["doc_id"], r["source_doc_id"]) for r in cw.repeated_passages(docs).collect()}
    print("recall", len(found & near), "of", len(near))
    assert len(near) > 390 and found <= near and len(found) >= 0.995 * len(near)


def test_an_insertion_splits_no_passage(spark):
    rng = random.Random(14)
    left, right, inserted = words_of(rng, 45), words_of(rng, 45), words_of(rng, 12)
    rows = [(1, " ".join(words_of(rng, 80) + left + right + words_of(rng, 80))), (2, " ".join(words_of(rng, 30) + left + inserted + right))]
    found = cw.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["source_doc_id"], r["first_word"], r["stop_word"]) for r in found} == {(2, 1, 30, 132)}
    assert all(abs(r["similarity"] - 82 / 102) < 1e-9 for r in found)


def words_of_table(spark, size):
    pdf = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text").toPandas().sort_values("doc_id")
    words, at = cw.word_hashes(*cw.utf8_buffer(cw.pa.array(pdf["text"].tolist())))
    return {int(k): words[a:b].astype(np.uint32).astype(np.uint64) for k, a, b in zip(pdf["doc_id"], at, at[1:])}


def test_every_equal_passage_of_a_table_is_found(spark):
    words = words_of_table(spark, "sf0.01")
    cover = {k: [] for k in words}
    for r in cw.repeated_passages(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect():
        cover[r["doc_id"]].append((r["first_word"], r["stop_word"]))
    seen, late = set(), 0
    for k, w in words.items():
        own = [w[s : s + 50].tobytes() for s in range(len(w) - 49)]
        for s, window in enumerate(own):
            if window in seen:
                late += 1
                assert any(a <= s and s + 50 <= b for a, b in cover[k]), (k, s)
        seen.update(own)
    assert late > 20_000


def test_near_passages_of_a_table_against_all_pairs(spark):
    words, found = words_of_table(spark, "sf0.001"), {}
    for r in cw.repeated_passages(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect():
        found.setdefault(r["doc_id"], set()).update(range(r["first_word"], r["stop_word"]))
    want, ids = {}, list(words)
    for i, k in enumerate(ids):
        for j in ids[:i]:
            for first, stop, *_ in cw.shared_blocks(words[k], words[j], OPTIONS):
                want.setdefault(k, set()).update(range(first, stop))
    total, held = sum(map(len, want.values())), sum(len(v & found.get(k, set())) for k, v in want.items())
    print("words in passages of all pairs", total, "of which found", held)
    assert total > 5_000 and held >= 0.99 * total and set(found) == set(want)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_verification_in_rounds_finds_the_same(spark, monkeypatch):
    """The words of all pairs lay on disk at once, in four copies; now a round's words follow the texts' size."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.filter("doc_id % 7 = 0"))  # rows that repeat
    rows = lambda: sorted(map(tuple, cw.repeated_passages(docs).collect()))
    words_of, seen = cw._words_of, []

    def counted(*args):
        out = words_of(*args)
        seen.append(sum(len(r["words"]) for r in out.collect()))
        return out

    monkeypatch.setattr(cw, "_words_of", counted)
    whole = rows()
    asked, held = sum(seen), docs.selectExpr("sum(octet_length(text))").first()[0]
    seen.clear()
    monkeypatch.setattr(cw, "ROUND_SHARE", asked / held / 4)
    assert rows() == whole
    assert len(seen) >= 4 and max(seen) <= 2 * cw.ROUND_SHARE * held


def test_starts_that_no_other_document_can_hold_are_not_asked(spark):
    """Every start of a run was hashed and shuffled, though two texts had only five words in common."""
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    lines, passage = [words(5) for _ in range(60)], words(60)
    texts = [[w for line in lines for w in words(20) + line] for _ in range(30)] + [words(80) + passage + words(80) for _ in range(2)]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "id long, text string")
    options = cw.WindowOptions()
    runs = cw._told_runs(cw._met_runs(docs, options))
    asked = cw._asked_runs(runs, options).collect()
    assert runs.filter("n > 0 and id < 30").count() and {r["id"] for r in asked} == {30, 31}
    starts = {(r["id"], s) for r in asked for s in range(r["first"], r["first"] + r["n"])}
    assert starts >= {(i, s) for i in (30, 31) for s in range(80, 80 + 60 - options.min_words + 1)}


def test_passages_are_not_broadcast(spark):
    docs = spark.createDataFrame([(i, "some words of a text") for i in range(4)], "doc_id long, text string")
    plan = plan_of(cw.drop_repeated_passages(docs))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
