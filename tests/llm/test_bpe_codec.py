import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lumenkg.llm import queries
from lumenkg.llm.bpe_codec import BpeCodec, decode_ids, encode_texts
from lumenkg.llm.tokenization import UnitEncoder, utf8

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"
LIBRARY = {f: Tokenizer.from_file(public_tokenizers.path(f)) for f in (BYTE, WORD)}
CODEC, UNITS = BpeCodec(BYTE), {BYTE: UnitEncoder(BYTE, "spaced"), WORD: UnitEncoder(WORD, "words")}
TEXTS = [
    None, "", " ", "\n", "  a  b\n c \n\n d   e <|endoftext|> f  <|endoftext|>g<|startoftext|>", "a   b", "x\n \ny", " lead", "trail ",
    "a\tb \tc", "it's we'll 123 4five été ßtraße 日本語   x  y   z \x1c q", "𝕏 ‍👩‍👩‍👧", "ab" * 5000, "é ́x İ Σς",
]
ids = lambda b: np.frombuffer(b, "<u4").tolist()


def test_encoders_equal_the_library():
    for t in TEXTS:
        want = LIBRARY[BYTE].encode(t or "", add_special_tokens=False).ids
        assert ids(CODEC.encode(utf8(t))) == want
        assert CODEC.decode(CODEC.encode(utf8(t))) == LIBRARY[BYTE].decode(want, skip_special_tokens=False)
        for f, e in UNITS.items():
            assert ids(e.encode(utf8(t))) == LIBRARY[f].encode(t or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \nZa.,*#É\t\r\x0b\x0c\x1c\x85\xa0 　'sd.,<|>1aébΣ́日"), st.characters(codec="utf-8")), max_size=40))
def test_encoders_equal_the_library_on_any_text(t):
    want = LIBRARY[BYTE].encode(t, add_special_tokens=False).ids
    assert ids(CODEC.encode(utf8(t))) == want
    for f, e in UNITS.items():
        assert ids(e.encode(utf8(t))) == LIBRARY[f].encode(t, add_special_tokens=False).ids


def test_tables_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, "\n", "x")], "doc_id long, text string, ids string")
    out = decode_ids(encode_texts(docs)).collect()
    assert all(r["__bp_decoded"] == (r["text"] or "") and r["ids"] == "x" for r in out) and len(out) == len(TEXTS) + 1
    assert encode_texts(docs.limit(0)).count() == 0
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op9_bpe_codec(spark, str(tmp_path)).collect():
        want = LIBRARY[BYTE].encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((TEXTS[r["doc_id"]] or "").encode()).hexdigest()
