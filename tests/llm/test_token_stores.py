import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lumenkg.llm import best_fit_packing, edit_token_counts, queries, tokenization, wavelet_store
from lumenkg.llm.tokenization import unit_encoder

WORD = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
BYTE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ROWS = [(5, "Hello there", "a"), (1, None, "b"), (3, "", "c"), (9, "ab cd " * 3000, "d"), (4, "one\ntwo", "e"), (3, "", "c"), (12, "x" * 9000, "f")]


def test_shard_queries():
    rng = random.Random(1)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = np.array([int(rng.paretovariate(0.7)) % 49408 for _ in range(n)], np.uint32)
        s = wavelet_store.WaveletShard(wavelet_store.build_shard(ids, [7, None], [n, 0]))
        assert s.decode().tolist() == ids.tolist() and s.doc_ids == [7, None]
        for at in rng.sample(range(n), min(n, 20)):
            assert s.access(at) == ids[at]
        for v in {*ids[:10].tolist(), 48000, 1 << 20}:
            where = np.flatnonzero(ids == v).tolist()
            assert s.count(v) == len(where) and s.occurrences(v)[:50] == where[:50]
            assert s.count(v, n // 3, n // 2) == sum(n // 3 <= w < n // 2 for w in where)


def test_store_round_trip(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, seq string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(queries.op2_wavelet_store(spark, str(tmp_path)).collect(), key=lambda r: (r["doc_id"], r["start"]))
    start = 0
    for r, (doc, text, _) in zip(got, sorted(ROWS, key=lambda x: x[0]), strict=True):
        ids = WORD.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    root = str(tmp_path / "shards")
    wavelet_store.write_shards(docs, root, shard_tokens=100)
    assert wavelet_store.count_token(spark, root, 2).first()["n"] == len(ROWS)
    wavelet_store.write_shards(docs.limit(0), str(tmp_path / "none"))
    assert wavelet_store.read_documents(spark, str(tmp_path / "none")).count() == 0


def test_plan_is_best_fit_decreasing():
    rng = random.Random(3)
    for capacity in (7, 50, 2048):
        counts = {rng.randint(1, capacity): rng.randint(1, 60) for _ in range(60)}
        counts[capacity] = 4
        rooms = []  # brute force
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                fit = min((r for r in rooms if r >= length), default=None)
                if fit is None:
                    rooms.append(capacity - length)
                else:
                    rooms[rooms.index(fit)] = fit - length
        filled, seen = defaultdict(list), defaultdict(list)
        for length, lo, hi, first, each, offset in best_fit_packing.plan_best_fit(counts, capacity):
            seen[length] += range(lo, hi)
            for rank in range(lo, hi):
                filled[first + (rank - lo) // each].append((offset + (rank - lo) % each * length, length))
        assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in counts.items()}
        for slots in filled.values():
            at = 0
            for offset, length in sorted(slots):
                assert offset == at
                at += length
            assert at <= capacity
        assert sorted(capacity - sum(x[1] for x in s) for s in filled.values()) == sorted(rooms)


def test_packing(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, part string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op5_best_fit_packing(spark, str(tmp_path)).collect()
    want = {}
    for doc, text, _ in ROWS:
        ids = BYTE.encode(text or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
            want.setdefault((doc, k, x, y - x, zlib.crc32(np.array(ids[x:y], "<u4").tobytes())), 0)
            want[(doc, k, x, y - x, zlib.crc32(np.array(ids[x:y], "<u4").tobytes()))] += 1
    have = defaultdict(int)
    sequences = defaultdict(list)
    for r in got:
        have[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert dict(have) == want
    for slots in sequences.values():
        assert [o for o, _ in sorted(slots)] == list(np.cumsum([0, *[n for _, n in sorted(slots)]])[:-1]) and sum(n for _, n in slots) <= 2048
    pieces = best_fit_packing.cut_pieces(docs)
    whole = best_fit_packing.packed_sequences(pieces, best_fit_packing.place_pieces(pieces.drop("ids"))).collect()
    assert len(whole) == len(sequences) and all(len(r["ids"]) <= 8192 for r in whole)
    empty = best_fit_packing.cut_pieces(docs.limit(0))
    assert best_fit_packing.place_pieces(empty).count() == 0


LINES = ["word", "12,34,x", "été", "3"]


def test_texts_of_many_lines_without_a_space(spark, tmp_path):
    rng = random.Random(8)
    texts = ["\n".join(rng.choice(LINES) for _ in range(100_000)), "\n".join(["word", "", " x", "a"] * 800), "\n" * 5000 + "a\n" * 5000, "a\n\nb\nc\n" * 900]
    for text in texts:
        assert np.frombuffer(unit_encoder("byte_bpe_50k.json", "spaced").encode(text.encode()), "<u4").tolist() == BYTE.encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    pieces = best_fit_packing.cut_pieces(docs).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in pieces} == {i: len(BYTE.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["n_tokens"] for r in queries.op7_edit_token_counts(spark, str(tmp_path)).collect()}
    assert got == {i: len(BYTE.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    tree = edit_token_counts.TokenTree.build(texts[0], lambda t: len(BYTE.encode(t, add_special_tokens=False).ids))
    assert len(tree.leaves) > 1000


def test_access_and_occurrences_equal_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(wavelet_store, "ACCESS_BLOCK", 100)
    rng = random.Random(4)
    words = ["the", "cat", "sat", "on", "a", "mat", "zebra", "of"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 60, 400]))), "x") for i in range(30)] + [(31, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    ids = {i: WORD.encode(t or "", add_special_tokens=False).ids + [2] for i, t, _ in rows}
    every = [(k, i) for i in sorted(ids) for k in ids[i]]
    got = sorted(map(tuple, queries.wavelet_access(spark, str(tmp_path)).collect()))
    assert got == sorted({(i, at, ids[i][at]) for i in ids for at in (0, len(ids[i]) // 2)})
    asked = list(range(2, 50_000, 1000))
    found = sorted((r["id"], r["place"], r["doc_id"]) for r in queries.wavelet_occurrences(spark, str(tmp_path)).collect())
    assert found == sorted((k, place, i) for place, (k, i) in enumerate(every) if k in asked) and len(found) >= 31
    root = str(tmp_path / "shards")
    wavelet_store.write_shards(docs, root, shard_tokens=150)
    common = max(set(k for k, _ in every), key=[k for k, _ in every].count)
    found = sorted((r["place"], r["doc_id"]) for r in wavelet_store.occurrences_of(spark, root, [common, 49_000, -1 & 0xFFFFF]).collect())
    assert found == [(place, i) for place, (k, i) in enumerate(every) if k == common] and len(found) > wavelet_store.MANY
    places = spark.createDataFrame([(0,), (0,), (len(every) - 1,), (len(every),), (-1,), (None,), (777,)], "place long")
    assert sorted(map(tuple, wavelet_store.access_ids(spark, root, places).collect())) == [(p, every[p][0]) for p in (0, 777, len(every) - 1)]
    wavelet_store.write_shards(docs.limit(0), str(tmp_path / "none"))
    assert wavelet_store.access_ids(spark, str(tmp_path / "none"), places).count() == 0 == wavelet_store.occurrences_of(spark, str(tmp_path / "none"), [2]).count()


def test_occurrences_of_a_full_shard_stay_columns():
    """A shard that one id fills: no Python object for each place, and the ids that the writer cached are given back."""
    import tracemalloc

    import pyarrow as pa

    n = 1 << 18
    file = wavelet_store.build_shard(np.full(n, 7, dtype=np.uint32), [5, None], [n - 3, 3])
    arrow = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("id", pa.int64()), ("at", pa.int64()), ("doc_id", pa.int64())])
    batch = pa.RecordBatch.from_pydict({"part": [1], "seq": [2], "file": [file], "asked": [None]})
    tokenization.unit_encoder("word_bpe_49k.json", "words").encode(b"some words")
    tracemalloc.start()
    (found,) = wavelet_store._shard_work(wavelet_store._occurrence_columns([3, 7, 1 << 20]), arrow)(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == n and found.slice(n - 4, 2).to_pylist() == [{"part": 1, "seq": 2, "id": 7, "at": n - 4 + k, "doc_id": d} for k, d in enumerate((5, None))]
    (none,) = wavelet_store._shard_work(wavelet_store._occurrence_columns([8]), arrow)(iter([batch]))
    assert none.num_rows == 0
    assert peak < 64 * n and tokenization.unit_encoder.cache_info().currsize == 0
