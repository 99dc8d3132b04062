import random

import public_tokenizers
from tokenizers import Tokenizer

from lumenkg.llm import edit_token_counts as et
from lumenkg.llm import queries
from lumenkg.llm.tokenization import inner_pairs

BYTE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
n_ids = lambda t: len(BYTE.encode(t or "", add_special_tokens=False).ids)


def test_random_edits_keep_the_count(monkeypatch):
    monkeypatch.setattr(et, "LEAF", 12)
    rng = random.Random(4)
    part = lambda n: "".join(rng.choice(["the ", "cat", " ", "\n", "é", " 12", "don't ", ",", "  ", "<|endoftext|>", " x", " "]) for _ in range(n))
    for _ in range(60):
        text = part(rng.randrange(0, 80))
        tree = et.TokenTree.build(text, n_ids)
        for _ in range(12):
            at, deleted, inserted = rng.randrange(len(text) + 3), rng.choice([0, 0, 1, 2, 30, 500]), part(rng.choice([0, 1, 3, 40]))
            tree.edit(at, deleted, inserted)
            at = min(at, len(text))
            text = text[:at] + inserted + text[at + deleted :]
            assert tree.text == text and tree.total == n_ids(text)
            assert tree.lengths.node[1] == len(text)


def test_only_touched_regions_are_encoded():
    tree = et.TokenTree.build("some plain words here " * 5000, n_ids)
    tree.edit(50_000, 5, "other")
    assert 0 < tree.encoded < 4 * et.LEAF and tree.total == n_ids(tree.text)


ROWS = [(1, None, "a"), (2, "", "b"), (3, "short", None), (4, "some words of text, more\n" * 400, "c"), (4, "some", "c"), (None, "x" * 3000, "d")]


def test_query_equals_full_encoding(spark, tmp_path):
    spark.createDataFrame(ROWS, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["n_tokens_edited"]) for r in queries.op7_edit_token_counts(spark, str(tmp_path)).collect())
    want = []
    for k, t, s in ROWS:
        t = t or ""
        new = t[: len(t) // 2] + t[:24] + t[len(t) // 2 + 40 :]
        want.append((k or 0, n_ids(t), n_ids(new + " " + (s or ""))))
    assert got == sorted(want)


def test_edits_from_a_table(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, ord string")
    trees = et.build_trees(docs)
    edits = spark.createDataFrame([(4, 2, 0, 4, "none"), (4, 1, 0, 0, "and "), (3, 1, None, None, None)], "doc_id long, ord int, at long, deleted long, inserted string")
    out = et.apply_edits(et.attach_edits(trees, edits)).collect()
    assert len(out) == len(ROWS)
    for r in out:
        want = "none" + (r["text"] or "") if r["doc_id"] == 4 else r["text"] or ""
        assert "".join(r["__et_leaves"]) == want and r["__et_n_tokens"] == n_ids(want)
    assert et.apply_edits(et.attach_edits(et.build_trees(docs.limit(0)), edits)).count() == 0


def test_edits_in_scripts_beyond_latin():
    russian = "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 520
    chinese = "天地玄黄，宇宙洪荒。日月盈昃，辰宿列张。寒来暑往，秋收冬藏。闰余成岁，律吕调阳。" * 760
    for text, inserted in ((russian, "новое слово"), (chinese, "新的词，")):
        assert len(text) >= 30_000 and "".join(et.cut_leaves(text)) == text and len(et.cut_leaves(text)) > 50
        tree = et.TokenTree.build(text, n_ids)
        nodes = tree.tokens.node
        for at in (15_000, 7, 29_990):
            tree.encoded = 0
            tree.edit(at, 3, inserted)
            text = text[:at] + inserted + text[at + 3 :]
            assert tree.encoded < 2_000 and tree.text == text and tree.total == n_ids(text)
        assert tree.tokens.node is nodes, "sums were updated on their paths"


def test_random_edits_in_all_scripts_keep_the_count(monkeypatch):
    monkeypatch.setattr(et, "LEAF", 6)
    rng = random.Random(9)
    atoms = ["слово", " ", "天", "。", "，", "'s", "「", "」", " é", "²", "١٢", "a", ".", "\n", "́", "ไทย", "　", " 'll", "’", "！", "x_"]
    part = lambda n: "".join(rng.choice(atoms) for _ in range(n))
    for _ in range(150):
        text = part(rng.randrange(0, 60))
        tree = et.TokenTree.build(text, n_ids)
        assert tree.total == n_ids(text)
        for _ in range(8):
            at, deleted, inserted = rng.randrange(len(text) + 3), rng.choice([0, 1, 2, 20]), part(rng.choice([0, 1, 3, 20]))
            tree.edit(at, deleted, inserted)
            at = min(at, len(text))
            text = text[:at] + inserted + text[at + deleted :]
            assert tree.text == text and tree.total == n_ids(text)


def test_text_without_punctuation_is_cut_by_the_vocabulary(monkeypatch):
    pairs = inner_pairs("byte_bpe_50k.json")
    rng = random.Random(3)
    for alphabet in ("天地玄黄宇宙洪荒日月盈昃辰宿列张", "กขคงจฉชซ", "сложныеслова"):
        text = "".join(rng.choice(alphabet) for _ in range(20_000))
        tree = et.TokenTree.build(text, n_ids, pairs)
        assert tree.total == n_ids(text)
        if alphabet[0] == "天":
            tree.edit(9_000, 3, "新词")
            assert tree.encoded < 2_000 and tree.total == n_ids(tree.text)
    monkeypatch.setattr(et, "LEAF", 3)
    atoms = ["天", "地", "玄", "カ", "タ", "ー", "ไ", "ท", "é", "ñ", "ъ", "a", " ", "\n", "1", "。"]
    for _ in range(150):
        text = "".join(rng.choice(atoms) for _ in range(rng.randrange(60)))
        tree = et.TokenTree.build(text, n_ids, pairs)
        assert tree.total == n_ids(text)
        for _ in range(5):
            at, deleted, inserted = rng.randrange(len(text) + 1), rng.choice([0, 1, 5]), "".join(rng.choice(atoms) for _ in range(rng.choice([0, 1, 4])))
            tree.edit(at, deleted, inserted)
            text = text[:at] + inserted + text[at + deleted :]
            assert tree.text == text and tree.total == n_ids(text)
