"""Exact duplicates by a sharded cuckoo-filter index of live digests.

Texts are equal if they are identical after every run of U+0020, U+0009 to
U+000D became one space. A text is known by the SHA-256 of that form. The index
has shards by the digest's first bits. A shard holds

* a cuckoo filter of 16-bit fingerprints, two candidate buckets of four slots
  each, which supports insertion and deletion, and
* its bucketed content: the full digest, with length, of every live text, under
  the bucket that the filter gives it.

A filter miss proves a digest new; a hit is verified against the content of its
two buckets, so false positives cost a comparison and nothing else. A digest is
in the filter once, however many rows hold it; its fingerprint goes when its
last row goes. When an insertion finds no free slot within ``MAX_KICKS``
displacements, the filter is rebuilt at double size from the stored keys.

At scale: each task first dedupes its own rows with such an index and hands on
one entry per distinct text, so a text that makes up a third of all rows reaches
its shard as one entry per task. Shards grow in number with the rows. Rows meet
their class again through a join on the digest; the classes that hold more than
a ``HEAVY_PART``-th of all rows, of which there can be no more than
``HEAVY_PART``, are broadcast instead, so no key of the join is hot.

The index is a table per generation (one row per live row: shard, digest, id)
and one of filters (one row per shard); ``apply_changes`` reads one generation
and writes the next, so a failed run leaves the old one whole.

Defined results: a null text counts as empty; ids may be null or repeat, a null
id is the largest, and of rows of equal id one stays; rows are told apart by
their place, so repeated rows count each; very long texts are hashed whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenkg.llm.tokenization import release_encoders
from lumenkg.llm.workspace import bound_batches, materialise, scratch_path, write_table

SLOTS = 4
MAX_KICKS = 200
#: Distinct texts that a task's index holds before it hands them on and begins anew.
TASK_KEYS = 1 << 17
#: Live digests that a shard is meant to hold.
SHARD_KEYS = 1 << 16
HEAVY_PART = 1000
P = "__ed_"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


class CuckooFilter:
    """Fingerprints of 32-byte digests; a digest may be in it once."""

    def __init__(self, buckets: int = 64, slots: bytes | None = None, seed: int = 1):
        self.buckets = buckets  # a power of two
        self.slots = bytearray(slots) if slots else bytearray(buckets * SLOTS * 2)
        self.table = memoryview(self.slots).cast("H")
        self.seed = seed

    def places(self, key: bytes) -> tuple[int, int, int]:
        """(fingerprint, bucket, other bucket); the shard takes the first four bytes of the digest, these take others."""
        mark = int.from_bytes(key[8:10], "little") or 1
        here = int.from_bytes(key[16:24], "little") & (self.buckets - 1)
        return mark, here, self.other(here, mark)

    def other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) >> 3) & (self.buckets - 1)

    def _slot(self, bucket: int, mark: int) -> int:
        t, at = self.table, bucket * SLOTS
        for k in range(at, at + SLOTS):
            if t[k] == mark:
                return k
        return -1

    def __contains__(self, key: bytes) -> bool:
        mark, a, b = self.places(key)
        return self._slot(a, mark) >= 0 or self._slot(b, mark) >= 0

    def insert(self, key: bytes) -> bool:
        """False if no slot came free; then the fingerprint in hand is lost and the filter must be rebuilt."""
        mark, a, b = self.places(key)
        for bucket in (a, b):
            k = self._slot(bucket, 0)
            if k >= 0:
                self.table[k] = mark
                return True
        bucket = b
        for _ in range(MAX_KICKS):
            self.seed = self.seed * 1103515245 + 12345 & 0x7FFFFFFF
            k = bucket * SLOTS + (self.seed >> 16) % SLOTS
            mark, self.table[k] = self.table[k], mark
            bucket = self.other(bucket, mark)
            k = self._slot(bucket, 0)
            if k >= 0:
                self.table[k] = mark
                return True
        return False

    def delete(self, key: bytes) -> None:
        """``key`` must be in the filter."""
        mark, a, b = self.places(key)
        k = self._slot(a, mark)
        self.table[k if k >= 0 else self._slot(b, mark)] = 0


class CuckooIndex:
    """A filter over bucketed content: ``entry[digest]`` of every live digest, found through the buckets of the filter."""

    def __init__(self, filter: CuckooFilter | None = None):
        self.filter = filter or CuckooFilter()
        self.content: dict[int, dict[bytes, list]] = {}
        self.size = self.hits = self.false_hits = self.resizes = 0

    def _bucket(self, key: bytes) -> int:
        """Content is kept under the lower of a digest's two buckets, so a displaced fingerprint needn't move it."""
        _, a, b = self.filter.places(key)
        return min(a, b)

    def find(self, key: bytes) -> list | None:
        """The entry of a live digest. Only filter hits look at the content."""
        if key not in self.filter:
            return None
        self.hits += 1
        entry = self.content.get(self._bucket(key), {}).get(key)
        self.false_hits += entry is None
        return entry

    def insert(self, key: bytes, entry: list) -> None:
        """Add a digest that ``find`` didn't know."""
        self.content.setdefault(self._bucket(key), {})[key] = entry
        self.size += 1
        if not self.filter.insert(key):
            self._resize()

    def delete(self, key: bytes) -> None:
        """Forget a live digest."""
        bucket = self._bucket(key)
        del self.content[bucket][key]
        if not self.content[bucket]:
            del self.content[bucket]
        self.filter.delete(key)
        self.size -= 1

    def _resize(self) -> None:
        """Double the filter until all stored keys fit."""
        entries, buckets = list(self.entries()), self.filter.buckets
        done = False
        while not done:
            buckets *= 2
            self.resizes += 1
            self.filter = CuckooFilter(buckets)
            done = all(self.filter.insert(key) for key, _ in entries)
        self.content = {}
        for key, entry in entries:
            self.content.setdefault(self._bucket(key), {})[key] = entry

    def entries(self) -> Iterator[tuple[bytes, list]]:
        for bucket in self.content.values():
            yield from bucket.items()


def _least(a: tuple, b: tuple) -> tuple:
    return b if b < a else a


def _entries_of(id_type: pa.DataType):
    schema = pa.schema([("digest", pa.binary()), ("bytes", pa.int64()), ("least_id", id_type), ("least_row", pa.int64()), ("rows", pa.int64())])

    def table(index: CuckooIndex) -> pa.RecordBatch:
        rows = [(key, e[0], e[1][1], e[1][2], e[2]) for key, e in index.entries()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    def add(index: CuckooIndex, key: bytes, size: int, first: tuple, n: int) -> None:
        """One more entry: new, or verified against the content of a hit. Of equal digests the length must agree too."""
        entry = index.find(key)
        if entry is None:
            index.insert(key, [size, first, n])
        elif entry[0] != size:
            raise ValueError("two texts of different lengths share a SHA-256")
        else:
            entry[1], entry[2] = _least(entry[1], first), entry[2] + n

    return table, add


def _task_entries(id_type: pa.DataType):
    """One entry per distinct text of a task's rows(row, id, digest, bytes)."""
    table, add = _entries_of(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        index = CuckooIndex()
        for b in batches:
            for row, id_, key, size in zip(*[c.to_pylist() for c in b.columns]):
                add(index, key, size, (id_ is None, id_, row), 1)
                if index.size >= TASK_KEYS:
                    yield table(index)
                    index = CuckooIndex()
        yield table(index)

    return run


def _shard_entries(id_type: pa.DataType):
    """One entry per distinct digest of a shard's entries."""
    table, add = _entries_of(id_type)

    def run(group: pa.Table) -> pa.Table:
        index = CuckooIndex()
        columns = [group[c].to_pylist() for c in ("digest", "bytes", "least_id", "least_row", "rows")]
        for key, size, id_, row, n in zip(*columns):
            add(index, key, size, (id_ is None, id_, row), n)
        return pa.Table.from_batches([table(index)])

    return run


def _shard(digest: str, shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long"), F.lit(shards)).cast("int")


def hashed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored (row, id, digest, bytes) of every row."""
    text = normalised(F.col(text_col))
    return materialise(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("bytes")), "digests")


def _entry_type(kind: T.DataType) -> str:
    return f"digest binary, bytes long, least_id {kind.simpleString()}, least_row long, rows long"


def classes_of(rows: DataFrame, total: int) -> DataFrame:
    """Entries (digest, bytes, least_id, least_row, rows) of the stored ``rows(row, id, digest, bytes)``, one per distinct digest."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["id"].dataType
    shards = max(1, -(-total // SHARD_KEYS))
    by_task = rows.select("row", "id", "digest", "bytes").mapInArrow(_task_entries(to_arrow_type(kind)), _entry_type(kind))
    return by_task.groupBy(_shard("digest", shards).alias("shard")).applyInArrow(_shard_entries(to_arrow_type(kind)), _entry_type(kind))


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, digest, least_id, least_row, rows) of every row: its class's least id, that row, and the number of its rows."""
    bound_batches(docs.sparkSession)
    rows = hashed(docs, id_col, text_col)
    total = rows.count()
    found = materialise(classes_of(rows, total), "classes").select("digest", "least_id", "least_row", "rows")
    heavy = F.col("rows") > max(1, total // HEAVY_PART)
    few = F.broadcast(found.filter(heavy))  # at most HEAVY_PART rows
    slim = rows.select("row", "id", "digest")
    common = slim.join(few, "digest")
    rest = slim.join(F.broadcast(found.filter(heavy).select("digest")), "digest", "left_anti").join(found.filter(~heavy), "digest")
    return common.unionByName(rest)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts the one of the smallest id."""
    marked = materialise(docs.withColumn(P + "row", F.monotonically_increasing_id()), "marked")
    rows = marked.select(F.col(P + "row").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    text = normalised(F.col("text"))
    rows = materialise(rows.select("row", "id", F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("bytes")), "digests")
    kept = classes_of(rows, rows.count()).select(F.col("least_row").alias(P + "row"))
    return marked.join(kept, P + "row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


# The index that lives on: generations of live rows and filters.

LIVE = "shard int, digest binary, bytes long, id {id}"
FILTERS = "shard int, buckets int, keys long, resizes int, slots binary"


def _probe(group_key: tuple, filters: pa.Table, keys: pa.Table) -> pa.Table:
    """Which digests of a shard the filter may hold."""
    held = CuckooFilter(filters["buckets"][0].as_py(), filters["slots"][0].as_py()) if filters.num_rows else None
    asked = keys["digest"].to_pylist()
    return pa.table({"digest": pa.array(asked, pa.binary()), "hit": pa.array([held is not None and k in held for k in asked], pa.bool_())})


def _changed(group_key: tuple, filters: pa.Table, steps: pa.Table) -> pa.Table:
    """The filter of a shard after its changes; ``overflow`` if an insertion found no slot."""
    held = CuckooFilter(filters["buckets"][0].as_py(), filters["slots"][0].as_py()) if filters.num_rows else CuckooFilter()
    count, fits = filters["keys"][0].as_py() if filters.num_rows else 0, True
    resizes = filters["resizes"][0].as_py() if filters.num_rows else 0
    gone = steps.filter(pc.equal(steps["step"], -1))["digest"].to_pylist()
    new = steps.filter(pc.equal(steps["step"], 1))["digest"].to_pylist()
    for key in gone:
        held.delete(key)
    for key in new:
        fits = fits and held.insert(key)
    return pa.table({"shard": pa.array([group_key[0].as_py()], pa.int32()), "buckets": pa.array([held.buckets], pa.int32()), "keys": pa.array([count + len(new) - len(gone)], pa.int64()), "resizes": pa.array([resizes], pa.int32()), "slots": pa.array([bytes(held.slots)], pa.binary()), "overflow": pa.array([not fits])})


def _rebuilt(group_key: tuple, filters: pa.Table, keys: pa.Table) -> pa.Table:
    """A filter made anew from the stored keys of its shard, at double size until they fit."""
    buckets, stored = filters["buckets"][0].as_py(), keys["digest"].to_pylist()
    resizes, held = filters["resizes"][0].as_py(), None
    while held is None or not all(held.insert(k) for k in stored):
        buckets, resizes = buckets * 2, resizes + 1
        held = CuckooFilter(buckets)
    return pa.table({"shard": pa.array([group_key[0].as_py()], pa.int32()), "buckets": pa.array([buckets], pa.int32()), "keys": pa.array([len(stored)], pa.int64()), "resizes": pa.array([resizes], pa.int32()), "slots": pa.array([bytes(held.slots)], pa.binary())})


def _by_shard(left: DataFrame, right: DataFrame, work, schema: str) -> DataFrame:
    return left.groupBy("shard").cogroup(right.groupBy("shard")).applyInArrow(work, schema)


class DedupIndex:
    """A stored index of ``shards`` shards under ``root``; ``generation`` counts its changes."""

    def __init__(self, spark: SparkSession, root: str, shards: int, id_type: str = "bigint", generation: int = 0):
        self.spark, self.root, self.shards, self.id_type, self.generation = spark, root, shards, id_type, generation

    def _read(self, table: str, schema: str) -> DataFrame:
        if not self.generation:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/g{self.generation}/{table}")

    def live(self) -> DataFrame:
        """(shard, digest, bytes, id): a row per live row."""
        return self._read("live", LIVE.format(id=self.id_type))

    def filters(self) -> DataFrame:
        return self._read("filters", FILTERS)

    def probe(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(row, id, digest, hit, known) of ``docs``: whether the filter may hold its text, and whether the index does.

        Only the hits are looked up in the content.
        """
        rows = hashed(docs, id_col, text_col)
        keys = materialise(rows.select("digest").distinct().withColumn("shard", _shard("digest", self.shards)), "asked")
        hits = materialise(_by_shard(self.filters(), keys, _probe, "digest binary, hit boolean").filter("hit").select("digest"), "hits")
        held = self.live().join(hits, "digest", "left_semi").select("digest").distinct()
        marked = lambda df, name: df.select("digest", F.lit(True).alias(name))
        both = keys.select("digest").join(marked(hits, "hit"), "digest", "left").join(marked(held, "known"), "digest", "left")
        return rows.join(both.select("digest", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("hit", "known")]), "digest").select("row", "id", "digest", "hit", "known")

    def apply_changes(self, inserts: DataFrame | None = None, deletes: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DedupIndex:
        """The next generation: rows of ``deletes(id)`` are gone, then those of ``inserts`` (id and text) are live."""
        old, columns = self.live(), ["shard", "digest", "bytes", "id"]
        stay = old if deletes is None else old.join(deletes.select(F.col(id_col).alias("id")), "id", "left_anti")
        new = None
        if inserts is not None:
            new = hashed(inserts, id_col, text_col).withColumn("shard", _shard("digest", self.shards))
        path = f"{self.root}/g{self.generation + 1}"
        live = stay.select(*columns) if new is None else stay.select(*columns).unionByName(new.select(*columns))
        write_table(live, f"{path}/live")
        after = DedupIndex(self.spark, self.root, self.shards, self.id_type, self.generation + 1)
        # a digest enters with its first live row and goes with its last
        had, has = old.select("shard", "digest").distinct(), after.live().select("shard", "digest").distinct()
        steps = had.join(has, ["shard", "digest"], "left_anti").withColumn("step", F.lit(-1)).unionByName(has.join(had, ["shard", "digest"], "left_anti").withColumn("step", F.lit(1)))
        tried = materialise(_by_shard(self.filters(), steps, _changed, FILTERS + ", overflow boolean"), "filters")
        full = tried.filter("overflow").drop("overflow")
        keys = has.join(full.select("shard"), "shard", "left_semi")
        write_table(tried.filter("not overflow").drop("overflow").unionByName(_by_shard(full, keys, _rebuilt, FILTERS)), f"{path}/filters")
        return after


def new_index(spark: SparkSession, rows: int, root: str | None = None, id_type: str = "bigint") -> DedupIndex:
    """An empty index meant for about ``rows`` distinct texts."""
    return DedupIndex(spark, root or scratch_path(spark, "dedup-index"), max(1, -(-rows // SHARD_KEYS)), id_type)
