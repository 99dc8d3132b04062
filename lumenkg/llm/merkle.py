"""Merkle manifest of a dataset by slot pivots.

Every row is a leaf: the hash of its fields. Leaves of a group (say, a language)
ascend by id; every ``FANOUT`` consecutive nodes become the hash of their
digests until one is left, the group's root, and the roots of the groups, in
order of the group, are hashed together in the same way.

A level is one aggregation: conditional aggregates spread the children of a
parent into ``FANOUT`` slot columns. Concatenating the columns and hashing gives
the parent; leaving out a child's own column gives its siblings. The runs of
each level are stored, so a proof is a chain of joins from the root downwards,
each on (group, parent) with at most ``FANOUT`` rows a key, whatever the sizes
of the groups. Nothing but the number of levels and of stored parts reaches the
driver.

Places within a group are counted without gathering it: rows are range-sorted by
(group, id, digest) over all tasks, and each task's rows get the number of rows
of their group in the tasks before.

Defined results: a null field counts as ``-``, a null group is a group and comes
first; null ids come first within theirs; rows of equal ids are ordered by their
digest, so repeated rows have the same digests in either order; an empty table
has no root and gives no rows; a lone leaf is its group's root, and a lone
group's root the dataset's; very long texts are hashed whole; other columns are
ignored unless named in ``carried``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenkg.llm.workspace import collected_paths, discard, materialise

FANOUT = 8
#: Up to so many (part, group) rows the places' offsets are broadcast, about 5 MB; beyond they are joined by a shuffle.
BROADCAST_PARTS = 50_000
SLOTS = [f"s{k}" for k in range(FANOUT)]


def encoded(value: Column) -> Column:
    """A field as hashed: ``-`` if null, else its UTF-8 byte count, a colon and its text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: list[Column]) -> Column:
    return digest(*map(encoded, fields))


def _group_key(group: Column) -> Column:
    """Groups as strings in their order, null first and a value of its own."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


@dataclass
class Manifest:
    """``leaf_runs`` holds the leaves by parent, ``group_levels`` and ``top_levels`` the runs of the levels above; ``tops``
    the root of each group with its depth and place, ``root`` one row."""

    leaf_runs: DataFrame
    group_levels: list[DataFrame]
    tops: DataFrame
    top_levels: list[DataFrame]
    root: DataFrame


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows(grp, ...)`` with ``k``, the place from 0 within ``grp`` by ``order``, and ``m``, the number of its rows."""
    ranged = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    stored = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()), "placed")
    stored = stored.withColumn("_part", F.shiftright("_at", 33).cast("int"))
    parts = stored.groupBy("_part", "grp").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("grp").orderBy("_part")  # one row per task that holds rows of the group
    before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("_part", "grp", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(Window.partitionBy("grp")).alias("m"))
    offsets = materialise(offsets, "offsets")
    if offsets.count() <= BROADCAST_PARTS:
        offsets = F.broadcast(offsets)
    return stored.join(offsets, ["_part", "grp"]).withColumn("k", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _runs(nodes: DataFrame, child: Column) -> DataFrame:
    """(grp, k, m, s0..): a row per parent with its children in slot columns; ``m`` stays the number of children's nodes."""
    slot = F.pmod(F.col("k"), F.lit(FANOUT))
    spread = [F.first(F.when(slot == j, child), ignorenulls=True).alias(c) for j, c in enumerate(SLOTS)]
    return nodes.groupBy("grp", F.floor(F.col("k") / FANOUT).alias("k")).agg(F.first("m").alias("m"), *spread)


def _depth(most: int | None) -> int:
    """Levels above ``most`` nodes."""
    levels = 0
    while most and most > 1:
        most, levels = -(-most // FANOUT), levels + 1
    return levels


def _parents(runs: DataFrame, slots: list[Column]) -> DataFrame:
    return runs.select("grp", "k", F.ceil(F.col("m") / FANOUT).cast("long").alias("m"), digest_of(slots).alias("digest"))


def digest_of(slots: list[Column]) -> Column:
    return F.sha2(F.concat_ws("", *slots), 256)


def _climb(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Stored runs of ``nodes(grp, k, m, digest)`` upwards, and (grp, digest, depth) of the node that each group ends in
    after ``depth`` levels."""
    ended = lambda level: nodes.filter("m = 1").select("grp", "digest", F.lit(level).alias("depth"))
    alone, runs = ended(0), []
    for level in range(levels):
        runs.append(materialise(_runs(nodes.filter("m > 1"), F.col("digest")), "runs"))
        nodes = _parents(runs[-1], [F.col(c) for c in SLOTS])
        alone = alone.unionByName(ended(level + 1))
    return runs, alone


def build(docs: DataFrame, fields: list[str], group_col: str, id_col: str, carried: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``carried`` names further columns of the rows that stay with their leaves.

    Rows are read once; afterwards only digests and carried columns move.
    """
    extra = carried or {}
    leaf = leaf_digest([F.col(c) for c in fields])
    leaves = docs.select(_group_key(F.col(group_col)).alias("grp"), F.col(id_col).alias("id"), F.unhex(leaf).alias("leaf"), *[c.alias(n) for n, c in extra.items()])
    with collected_paths() as spent:
        leaves = placed(materialise(leaves, "leaves"), ["id", "leaf"])
    leaf_runs = materialise(_runs(leaves, F.struct("id", "leaf", *extra)), "leaf-runs")
    discard(docs.sparkSession, spent)
    slots = [F.lower(F.hex(F.col(c)["leaf"])) for c in SLOTS]
    # a lone leaf is the root of its group: it isn't hashed again
    lone = F.col("m") == 1
    first = leaf_runs.select("grp", "k", F.ceil(F.col("m") / FANOUT).cast("long").alias("m"), F.when(lone, slots[0]).otherwise(digest_of(slots)).alias("digest"))
    most = leaf_runs.agg(F.max("m")).first()[0]
    runs, alone = _climb(first, max(0, _depth(most) - 1))
    tops = materialise(alone, "group-roots")
    with collected_paths() as spent:
        ranked = placed(tops.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest", "depth"), ["of"])
    ranked = materialise(ranked, "group-places")
    discard(docs.sparkSession, spent)
    top_runs, root = _climb(ranked.select("grp", "k", "m", "digest"), _depth(tops.count()))
    return Manifest(leaf_runs, runs, ranked, top_runs, materialise(root, "root"))


def _sides(slot: int, slots: list[Column]) -> Column:
    """struct(left, right): the siblings before and after a slot."""
    part = lambda own: F.concat_ws("", *own) if own else F.lit("")
    return F.struct(part(slots[:slot]).alias("left"), part(slots[slot + 1 :]).alias("right"))


SIDES = "array<struct<left:string,right:string>>"


def _descend(runs: list[DataFrame], ends: DataFrame) -> DataFrame:
    """Paths of the nodes below ``runs``: those of ``ends(grp, depth, path, ...)``, carried down to the lowest nodes.

    A path lists the siblings of each level, lowest first. A group joins at the level it ended in.
    """
    kept = [c for c in ends.columns if c not in ("grp", "path", "depth")]
    entering = lambda depth: ends.filter(F.col("depth") == depth).select("grp", F.lit(0).cast("long").alias("k"), "path", *kept)
    slots = [F.col(c) for c in SLOTS]
    child = lambda j: F.struct((F.col("k") * FANOUT + j).alias("k"), _sides(j, slots).alias("side"))
    children = F.filter(F.array(*[F.when(c.isNotNull(), child(j)) for j, c in enumerate(slots)]), lambda x: x.isNotNull())
    here = None
    for depth in range(len(runs), 0, -1):
        above = entering(depth) if here is None else here.unionByName(entering(depth))
        below = runs[depth - 1].join(above, ["grp", "k"]).select("grp", "path", *kept, F.explode(children).alias("x"))
        here = below.select("grp", "x.k", F.concat(F.array("x.side"), "path").alias("path"), *kept)
    return entering(0) if here is None else here.unionByName(entering(0))


def proofs(manifest: Manifest) -> DataFrame:
    """(id, leaf, carried columns, path, subroot, root): one row per leaf; ``path`` lists struct(left, right) of each level
    from the leaf to the root."""
    root = manifest.root.select("grp", "depth", F.col("digest").alias("root"), F.array().cast(SIDES).alias("path"))
    tops = _descend(manifest.top_levels, root).select("k", "path", "root")
    tops = manifest.tops.select("k", F.col("of").alias("grp"), F.col("digest").alias("subroot"), "depth").join(tops, "k").drop("k")
    parents = _descend(manifest.group_levels, tops)
    slots = [F.lower(F.hex(F.col(c)["leaf"])) for c in SLOTS]
    joined = manifest.leaf_runs.join(parents, ["grp", "k"])
    own = lambda j: F.when(F.col("m") == 1, F.array().cast(SIDES)).otherwise(F.array(_sides(j, slots)))
    rows = F.filter(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("row"), own(j).alias("side"))) for j, c in enumerate(SLOTS)]), lambda x: x.isNotNull())
    one = joined.select("subroot", "root", "path", F.explode(rows).alias("x"))
    return one.select("x.row.*", F.concat("x.side", "path").alias("path"), "subroot", "root").withColumn("leaf", F.lower(F.hex("leaf")))


def siblings_digest(path: Column) -> Column:
    """Hash of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of its path."""
    return F.aggregate(path, leaf, lambda at, x: F.sha2(F.concat(x["left"], at, x["right"]), 256))


def verify(proof_rows: DataFrame, candidates: DataFrame, fields: list[str], id_col: str) -> DataFrame:
    """(id, verified) of ``candidates``: whether a row's fields, folded with the stored path of its id, give the root.

    Ids must be unique in the manifest; a candidate whose id it doesn't hold isn't verified.
    """
    own = candidates.select(F.col(id_col).alias("id"), leaf_digest([F.col(c) for c in fields]).alias("candidate"))
    met = own.join(proof_rows.select("id", "path", "root"), "id", "left")
    return met.select("id", F.coalesce(folded(F.col("candidate"), F.col("path")) == F.col("root"), F.lit(False)).alias("verified"))
