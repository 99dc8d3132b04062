"""Byte-level BPE encoding and decoding.

Encoding cuts a text into pieces and merges each piece's symbols with a
priority queue of (merge rank, position) over a doubly linked symbol list;
entries whose pair has changed since they were pushed are stale and skipped.
Decoding puts vocabulary strings one after the other. Vocabulary and merges
come from a public tokenizer file whose path is a parameter.

Defined results: null and empty texts have no ids and decode to an empty text;
special tokens in a text become their ids, as in the tokenizers library; a text
of one enormous piece takes n log n steps; repeated rows give equal rows; an
empty table an empty table; other columns pass through untouched (added columns
start with ``__bp_``).
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lumenkg.llm.tokenization import _SPACED, _WIDE_SPACE, byte_letters, utf8, vocabulary_path
from lumenkg.llm.workspace import bound_batches

#: Fixed value: the piece pattern of byte-level vocabularies of this family.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
MAX_CACHED = 500_000
P = "__bp_"
_DEAD = -1


class BpeCodec:
    def __init__(self, vocabulary: str):
        import regex

        with open(vocabulary_path(vocabulary), encoding="utf-8") as f:
            spec = json.load(f)
        letters, ids = byte_letters(), spec["model"]["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in word) for word, i in ids.items() if all(c in letters for c in word)}
        self.first = [0] * 256
        for letter, b in letters.items():
            self.first[b] = ids[letter]
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for at, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(ids[a] << 32 | ids[b], at)
            self.merged.append(ids[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.special_bytes = [s.encode() for s in self.special]
        self.pieces = regex.compile(PIECES)
        self.of_piece: dict[str, bytes] = {}
        self.of_unit: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """ids of one piece."""
        symbol = [self.first[b] for b in piece]
        n, rank, merged = len(symbol), self.rank, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            r = rank.get(symbol[i] << 32 | symbol[i + 1])
            if r is not None:
                queue.append(r << 32 | i)
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i, r = entry & 0xFFFFFFFF, entry >> 32
            j = after[i]
            if symbol[i] == _DEAD or j >= n or rank.get(symbol[i] << 32 | symbol[j]) != r:
                continue  # stale
            symbol[i], symbol[j] = merged[r], _DEAD
            k, p = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                s = rank.get(symbol[i] << 32 | symbol[k])
                if s is not None:
                    heappush(queue, s << 32 | i)
            if p >= 0:
                s = rank.get(symbol[p] << 32 | symbol[i])
                if s is not None:
                    heappush(queue, s << 32 | p)
        return [s for s in symbol if s != _DEAD]

    def _plain(self, text: str) -> bytes:
        """ids of text without special tokens."""
        known, out = self.of_piece, []
        for piece in self.pieces.findall(text):
            found = known.get(piece)
            if found is None:
                if len(known) >= MAX_CACHED:
                    known.clear()
                found = known[piece] = array("I", self.merge(piece.encode("utf-8"))).tobytes()
            out.append(found)
        return b"".join(out)

    def _whole(self, text: str) -> bytes:
        if self.cut_special is None:
            return self._plain(text)
        parts = self.cut_special.split(text)
        return b"".join(array("I", [self.special[x]]).tobytes() if x in self.special else self._plain(x) for x in parts)

    def encode(self, text: bytes) -> bytes:
        """ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        if any(s in text for s in self.special_bytes) or _SPACED.search(text) or any(s in text for s in _WIDE_SPACE):
            return self._whole(text.decode("utf-8"))
        known, out = self.of_unit, []
        first, *rest = text.split(b" ")
        for unit in (first, *[b" " + x for x in rest]):
            found = known.get(unit)
            if found is None:
                found = self._plain(unit.decode("utf-8"))
                if len(unit) <= 64:
                    if len(known) >= MAX_CACHED:
                        known.clear()
                    known[unit] = found
            out.append(found)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> BpeCodec:
    """One codec per worker process."""
    return BpeCodec(vocabulary)


def _mapped(df: DataFrame, source: str, target: str, kind, arrow_kind, vocabulary: str, drop: bool, apply) -> DataFrame:
    bound_batches(df.sparkSession)
    fields = [f for f in df.schema.fields if not (drop and f.name == source)]
    schema, names = T.StructType([*fields, T.StructField(target, kind)]), [f.name for f in fields]
    at, kept = df.columns.index(source), [i for i, c in enumerate(df.columns) if not (drop and c == source)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocabulary)
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                b = whole.slice(lo, 512)
                values = pa.array([apply(tool, v) for v in b.column(at).to_pylist()], arrow_kind)
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in kept], values], names=[*names, target])

    return df.mapInArrow(run, schema)


def encode_texts(
    df: DataFrame, vocabulary: str = "byte_bpe_50k.json", text_col: str = "text", ids_col: str = P + "ids", drop_text: bool = False
) -> DataFrame:
    """Add ``ids_col``: the ids of every whole text as little-endian unsigned 32-bit integers."""
    return _mapped(df, text_col, ids_col, T.BinaryType(), pa.binary(), vocabulary, drop_text, lambda tool, text: tool.encode(utf8(text)))


def decode_ids(
    df: DataFrame, vocabulary: str = "byte_bpe_50k.json", ids_col: str = P + "ids", text_col: str = P + "decoded", drop_ids: bool = False
) -> DataFrame:
    """Add ``text_col``: the text of every row's ids."""
    return _mapped(df, ids_col, text_col, T.StringType(), pa.string(), vocabulary, drop_ids, lambda tool, ids: tool.decode(ids or b""))
