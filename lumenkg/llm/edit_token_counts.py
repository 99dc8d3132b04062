"""Edit-aware token counts.

A document's text is kept as leaves that end at places where the tokenizer
always cuts (a space or line end between two letters, digits or printable ASCII
characters of any script, behind East Asian punctuation and before a letter, or
between two letters beyond ASCII whose bytes stand side by side in no token of
the vocabulary), with two segment trees over them: token counts and lengths. An edit finds its leaves in the
length tree, re-encodes the leaves it touches (more of them while their bounds
are no longer certain cuts), and updates sums on the paths to the root. The
root holds the count of the whole text.

Edits of a document apply in their order, each to the text left by those
before. Places and lengths are in characters; places beyond the text count as
its end.

Defined results: null text is empty; null or empty edits change nothing; a null
``inserted`` inserts nothing and null numbers are 0; repeated rows are counted
each for itself; very long texts have as many leaves as they need, but a run
without any certain cut (ASCII letters without white space) is one leaf, however long; an empty table gives an empty result; other columns pass
through untouched (added columns start with ``__et_``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenkg.llm.tokenization import inner_pairs, unit_encoder, utf8
from lumenkg.llm.workspace import bound_batches

P = "__et_"
LEAF = 256
#: Punctuation of scripts without spaces; it never joins the letter behind it.
_STOPS = "、。，！？；：」』）】》"
_CUT = re.compile(rf"(?<=[!-~\w])[ \n](?=[!-~\w])|(?<=[{_STOPS}])(?=[^\W_])|(?<=[^\W\d_\x00-\x7f])(?=[^\W\d_\x00-\x7f])")
Pairs = frozenset[tuple[int, int]] | None
#: A leaf that grew beyond so many times ``LEAF`` is cut again, with the trees built anew.
GROWN = 8
EDITS = T.ArrayType(T.StructType([T.StructField("at", T.LongType()), T.StructField("deleted", T.LongType()), T.StructField("inserted", T.StringType())]))


def _apart(left: str, right: str, pairs: Pairs) -> bool:
    """Are these letters beyond ASCII whose bytes stand side by side in no token?"""
    return pairs is not None and min(left, right) > "\x7f" and left.isalpha() and right.isalpha() and (left.encode()[-1], right.encode()[0]) not in pairs


def _cut_after(text: str, at: int, pairs: Pairs) -> int | None:
    """The first certain cut from ``at`` on."""
    for m in _CUT.finditer(text, at):
        k = m.start()
        if text[k] in " \n" or text[k - 1] in _STOPS or _apart(text[k - 1], text[k], pairs):
            return k
    return None


def cut_leaves(text: str, pairs: Pairs = None) -> list[str]:
    """Pieces of about ``LEAF`` characters whose token counts add up to the text's; ``pairs`` are the bytes that stand
    side by side in tokens, without them letters are never parted."""
    out, at = [], 0
    while len(text) - at > 2 * LEAF:
        cut = _cut_after(text, at + LEAF, pairs)
        if cut is None:
            break
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def certain(before: str, after: str, pairs: Pairs = None) -> bool:
    """Does the tokenizer always cut between two texts that stand side by side?"""
    if after[0] in " \n":
        return len(after) > 1 and all("!" <= c <= "~" or c.isalnum() for c in (before[-1], after[1]))
    return before[-1] in _STOPS and after[0].isalnum() or _apart(before[-1], after[0], pairs)


class SumTree:
    """Sums over a fixed number of leaves; node k has children 2k and 2k + 1, the root is node 1."""

    def __init__(self, values: list[int]):
        self.width = 1 << max(0, len(values) - 1).bit_length()
        self.node = [0] * self.width + values + [0] * (self.width - len(values))
        for k in range(self.width - 1, 0, -1):
            self.node[k] = self.node[2 * k] + self.node[2 * k + 1]

    @classmethod
    def of_nodes(cls, node: list[int]) -> SumTree:
        tree = cls.__new__(cls)
        tree.width, tree.node = len(node) // 2, node
        return tree

    def put(self, leaf: int, value: int) -> None:
        k, change = self.width + leaf, value - self.node[self.width + leaf]
        while k and change:
            self.node[k] += change
            k //= 2

    def find(self, place: int) -> tuple[int, int]:
        """(leaf, place within it) of a place before the total."""
        k = 1
        while k < self.width:
            k *= 2
            if place >= self.node[k]:
                place -= self.node[k]
                k += 1
        return k - self.width, place


class TokenTree:
    """Leaves of one text with their two sum trees; ``count`` gives the tokens of a string, ``pairs`` goes to ``cut_leaves``."""

    def __init__(self, leaves: list[str], tokens: SumTree, lengths: SumTree, count, pairs: Pairs = None):
        self.leaves, self.tokens, self.lengths, self.count, self.pairs, self.encoded = leaves, tokens, lengths, count, pairs, 0

    @classmethod
    def build(cls, text: str, count, pairs: Pairs = None) -> TokenTree:
        leaves = cut_leaves(text, pairs)
        return cls(leaves, SumTree([count(x) for x in leaves]), SumTree([len(x) for x in leaves]), count, pairs)

    @property
    def total(self) -> int:
        return self.tokens.node[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def edit(self, at: int, deleted: int, inserted: str) -> None:
        size = self.lengths.node[1]
        at = min(max(at, 0), size)
        end = min(at + max(deleted, 0), size)
        lo, off = self.lengths.find(at) if at < size else (len(self.leaves) - 1, len(self.leaves[-1]))
        hi, stop = self.lengths.find(end) if end < size else (len(self.leaves) - 1, len(self.leaves[-1]))
        new = self.leaves[lo][:off] + inserted + self.leaves[hi][stop:]
        while lo and not (len(new) > 1 and self._ends_sure(lo, new)):
            lo -= 1
            new = self.leaves[lo] + new
        while hi + 1 < len(self.leaves) and not (new and self._starts_sure(hi, new)):
            hi += 1
            new += self.leaves[hi]
        pieces = cut_leaves(new, self.pairs)
        fresh = [self.count(x) for x in pieces]
        self.encoded += len(new)
        room = hi + 1 - lo
        if len(pieces) > room and sum(map(len, pieces[room - 1 :])) <= GROWN * LEAF:
            pieces, fresh = [*pieces[: room - 1], "".join(pieces[room - 1 :])], [*fresh[: room - 1], sum(fresh[room - 1 :])]
        if len(pieces) <= room:
            for k in range(room):
                piece, n = (pieces[k], fresh[k]) if k < len(pieces) else ("", 0)
                self.leaves[lo + k] = piece
                self.tokens.put(lo + k, n)
                self.lengths.put(lo + k, len(piece))
            return
        counts = self.tokens.node[self.tokens.width : self.tokens.width + len(self.leaves)]
        self.leaves[lo : hi + 1], counts[lo : hi + 1] = pieces, fresh
        kept = [(x, n) for x, n in zip(self.leaves, counts) if x] or [("", 0)]
        self.leaves, counts = [x for x, _ in kept], [n for _, n in kept]
        self.tokens, self.lengths = SumTree(counts), SumTree([len(x) for x in self.leaves])

    def _ends_sure(self, lo: int, new: str) -> bool:
        """Is the bound between ``new`` and the last text before leaf ``lo`` a certain cut?"""
        while lo and not self.leaves[lo - 1]:
            lo -= 1
        return not lo or certain(self.leaves[lo - 1], new, self.pairs)

    def _starts_sure(self, hi: int, new: str) -> bool:
        while hi + 1 < len(self.leaves) and not self.leaves[hi + 1]:
            hi += 1
        return hi + 1 == len(self.leaves) or certain(new, self.leaves[hi + 1], self.pairs)


def _counter(vocabulary: str):
    encoder = unit_encoder(vocabulary, "spaced")
    return lambda text: len(encoder.encode(utf8(text))) // 4


_STATE = [
    T.StructField(P + "leaves", T.ArrayType(T.StringType())),
    T.StructField(P + "tokens", T.ArrayType(T.LongType())),
    T.StructField(P + "lengths", T.ArrayType(T.LongType())),
    T.StructField(P + "n_tokens", T.LongType()),
]
_ARROW = [pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]


def _row(tree: TokenTree) -> tuple:
    return tree.leaves, tree.tokens.node, tree.lengths.node, tree.total


def build_trees(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", text_col: str = "text", drop_text: bool = False) -> DataFrame:
    """Add the trees of every text and ``__et_n_tokens``, the count at their root."""
    bound_batches(docs.sparkSession)
    fields = [f for f in docs.schema.fields if not (drop_text and f.name == text_col)]
    kept, at = [docs.columns.index(f.name) for f in fields], docs.columns.index(text_col)
    schema = T.StructType([*fields, *_STATE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, pairs = _counter(vocabulary), inner_pairs(vocabulary)
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                rows = [_row(TokenTree.build(t or "", count, pairs)) for t in b.column(at).to_pylist()]
                state = [pa.array(list(c), k) for c, k in zip(zip(*rows), _ARROW)]
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in kept], *state], names=schema.names)

    return docs.mapInArrow(run, schema)


def attach_edits(trees: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Join ``edits`` (id, ord, at, deleted, inserted) to the trees as the column ``__et_edits``, in order."""
    step = F.struct("ord", "at", "deleted", "inserted")
    listed = F.transform(F.array_sort(F.collect_list(step)), lambda e: F.struct(e["at"].alias("at"), e["deleted"].alias("deleted"), e["inserted"].alias("inserted")))
    grouped = edits.groupBy(F.col(id_col).alias(P + "id")).agg(listed.cast(EDITS).alias(P + "edits"))
    return trees.join(grouped, F.col(id_col) == F.col(P + "id"), "left").drop(P + "id")


def apply_edits(trees: DataFrame, edits_col: str = P + "edits", vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Trees after their edits; adds ``__et_encoded``, the characters that were encoded again, and drops the edits."""
    state = [P + "leaves", P + "tokens", P + "lengths", P + "n_tokens"]
    fields = [f for f in trees.schema.fields if f.name not in (*state, edits_col)]
    schema = T.StructType([*fields, *_STATE, T.StructField(P + "encoded", T.LongType())])
    kept, places, at = [trees.columns.index(f.name) for f in fields], [trees.columns.index(c) for c in state[:3]], trees.columns.index(edits_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, pairs = _counter(vocabulary), inner_pairs(vocabulary)
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b, rows = whole.slice(lo, 256), []
                for leaves, tokens, lengths, edits in zip(*[b.column(i).to_pylist() for i in (*places, at)]):
                    tree = TokenTree(leaves, SumTree.of_nodes(tokens), SumTree.of_nodes(lengths), count, pairs)
                    for e in edits or ():
                        if e is not None:
                            tree.edit(e["at"] or 0, e["deleted"] or 0, e["inserted"] or "")
                    rows.append((*_row(tree), tree.encoded))
                new = [pa.array(list(c), k) for c, k in zip(zip(*rows), [*_ARROW, pa.int64()])]
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in kept], *new], names=schema.names)

    return trees.mapInArrow(run, schema)
