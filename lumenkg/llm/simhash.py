"""SimHash near-duplicate groups with deletion-variant signatures.

Texts are lower-cased (A-Z only), cut into words, and every three-word shingle
(repeats included) votes with its XXH64 (seed 42) on 64 bits; a bit is 1 if set
in over half of the hashes. Fingerprints at two or fewer differing bits link,
and links close into components.

Candidate search. A fingerprint is cut into two 32-bit segments, so of two
linked fingerprints one segment differs by at most one bit. Each segment is
indexed under its 32 one-wildcard variants (one bit deleted), variants meet by
equality, and full fingerprints are verified. Groups of equal variants up to
``SMALL_GROUP`` join directly. Groups up to ``TASK_GROUP`` are compared inside
one task, which hands on one link per member. The members of larger groups are
indexed under all two-wildcard variants of the whole fingerprint instead: any
two that share one differ by at most two bits, so linking each to the smallest
of its group gives the same components with rows in proportion to the members.

Defined results: null or blank text has fingerprint zero and links like any
other; texts of one or two words are one shingle; repeated rows share their
fingerprint; a null id is kept and never is a component's name unless all ids
of the component are null; an empty table gives an empty result; other columns
are ignored by ``near_duplicate_classes`` and kept by ``keep_one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenkg.llm.components import connected_components
from lumenkg.llm.tokenization import release_encoders
from lumenkg.llm.workspace import bound_batches, materialise

SMALL_GROUP = 16
TASK_GROUP = 4096
P = "__sh_"


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        joined, cut = b" ".join(words), [0]
        for w in words:
            cut.append(cut[-1] + len(w) + 1)
        shingles = [joined[a : b - 1] for a, b in zip(cut, cut[width:])]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, 42) for s in shingles), dtype=np.uint64, count=len(shingles))
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    bits = 2 * votes > len(hashes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text_col: str = "text", width: int = 3) -> DataFrame:
    """Add ``__sh_fp`` (the fingerprint as a signed long) to every row."""
    bound_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(P + "fp", T.LongType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for b in batches:
            prints = np.array([fingerprint(t, width) for t in b.column(at).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(prints, pa.int64())], names=[*b.schema.names, P + "fp"])

    return docs.mapInArrow(run, schema)


def _low32(c: Column) -> Column:
    return c.bitwiseAND(F.lit(0xFFFFFFFF))


def _segment_variants(prints: DataFrame) -> DataFrame:
    """(key, fp): 64 one-wildcard variants of the two segments of each fingerprint."""
    halves = F.array(_low32(F.shiftrightunsigned("fp", 32)), _low32(F.col("fp")))
    masks = F.array(*[F.lit(0xFFFFFFFF ^ (1 << i)) for i in range(32)])
    keys = F.flatten(
        F.transform(
            halves,
            lambda h, s: F.transform(masks, lambda m, i: h.bitwiseAND(m) + (s * 32 + i).cast("long") * F.lit(1 << 32)),
        )
    )
    return prints.select("fp", F.explode(keys).alias("key"))


def _pair_variants(prints: DataFrame) -> DataFrame:
    """(key, fp): the 2016 two-wildcard variants of whole fingerprints, each key tagged by its wildcards."""
    masks = [((1 << 64) - 1) ^ (1 << i) ^ (1 << j) for i, j in combinations(range(64), 2)]
    text = ",".join(str(m - (1 << 64) if m >> 63 else m) for m in masks)
    signed = F.split(F.lit(text), ",").cast("array<bigint>")  # one folded literal
    return prints.select("fp", F.posexplode(signed).alias("place", "mask")).select("fp", "place", F.col("fp").bitwiseAND(F.col("mask")).alias("rest"))


def _linked_within(prints: np.ndarray) -> np.ndarray:
    """For each fingerprint the place of the first one of its component within the array."""
    n = len(prints)
    label = np.arange(n)
    while True:
        least = label.copy()
        for at in range(0, n, 256):
            near = np.bitwise_count(prints[at : at + 256, None] ^ prints[None, :]) <= 2
            least[at : at + 256] = np.where(near, label[None, :], n).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _group_links(group: pa.Table) -> pa.Table:
    prints = np.sort(group["fp"].to_numpy())
    first = _linked_within(prints.view(np.uint64))
    moved = first != np.arange(len(prints))
    return pa.table({"a": prints[moved], "b": prints[first[moved]]})


def _met_variants(prints: DataFrame) -> DataFrame:
    """(key, fp, n): the segment variants that ``n`` > 1 fingerprints share.

    Spark takes an exploded table to be as small as what it came from, and would broadcast either side: 64 rows for each
    fingerprint. So this join, like that of the pair variants, is told to shuffle.
    """
    variants = _segment_variants(prints)
    groups = variants.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return variants.join(groups.hint("merge"), "key")


def _variant_stars(prints: DataFrame) -> DataFrame:
    """Links (a, b) of the fingerprints that share a pair variant, each to the smallest of them."""
    deep = _pair_variants(prints)
    least = deep.groupBy("place", "rest").agg(F.min("fp").alias("b"), F.max("fp").alias("most")).filter("b <> most")
    return deep.join(least.hint("merge"), ["place", "rest"]).filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def link_fingerprints(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct ``fp`` values whose components are those of all pairs at two or fewer differing bits."""
    members = materialise(_met_variants(prints), "variants")
    small = members.filter(F.col("n") <= SMALL_GROUP)
    left, right = small.select("key", F.col("fp").alias("a")), small.select("key", F.col("fp").alias("b"))
    near = (F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)
    pairs = left.join(right, "key").filter(near).select("a", "b").distinct()
    middle = members.filter((F.col("n") > SMALL_GROUP) & (F.col("n") <= TASK_GROUP)).select("key", "fp")
    forests = middle.groupBy("key").applyInArrow(_group_links, "a long, b long").distinct()
    crowded = members.filter(F.col("n") > TASK_GROUP).select("fp").distinct()
    return pairs.unionByName(forests).unionByName(_variant_stars(crowded))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``__sh_fp``, ``__sh_component``) per row; the component is the smallest id reachable."""
    marked = materialise(with_fingerprints(docs.select(id_col, text_col), text_col).select(id_col, P + "fp"), "prints")
    return _with_components(marked, id_col)


def _with_components(marked: DataFrame, id_col: str) -> DataFrame:
    return _with_parts(marked, id_col).drop(P + "part")


def _with_parts(marked: DataFrame, id_col: str) -> DataFrame:
    """``marked`` with ``__sh_part``, the smallest fingerprint of the component, and ``__sh_component``, its smallest id.

    Ids may be null or used twice, so only the part tells components apart.
    """
    classes = materialise(marked.groupBy(F.col(P + "fp").alias("fp")).agg(F.min(id_col).alias("least")), "classes")
    edges = materialise(link_fingerprints(classes.select("fp")), "links")
    parts = connected_components(edges)
    placed = classes.join(parts, classes["fp"] == parts["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("part")
    )
    names = placed.groupBy("part").agg(F.min("least").alias(P + "component"))
    lookup = placed.join(names, "part").select(F.col("fp").alias(P + "key"), F.col("part").alias(P + "part"), P + "component")
    return marked.join(lookup, F.col(P + "fp") == F.col(P + "key"), "left").drop(P + "key")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their component: its smallest id, one row of it where rows repeat."""
    row = F.monotonically_increasing_id().alias(P + "row")
    marked = materialise(with_fingerprints(docs, text_col).select("*", row), "prints")
    slim = marked.select(P + "row", id_col, P + "fp")
    classed = _with_parts(slim, id_col)
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(P + "row").alias("row")))
    kept = classed.groupBy(P + "part").agg(first.alias("first")).select(F.col("first.row").alias(P + "row"))
    return marked.join(kept, P + "row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
