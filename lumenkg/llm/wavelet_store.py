"""Token ids in wavelet-matrix shards.

Documents in ascending id order are cut into shards of about ``shard_tokens``
ids. A shard is one self-contained compressed file: a document table and one
succinct bit plane per id bit (with the count of ones per 512 bits), most
significant plane first, each plane stably parting zeros before ones. One file
answers access, rank, counting, select and occurrence lookups. Shard files are
the ``file`` column of a Parquet dataset, so any store that Spark writes to
holds them.

Defined results: null text is empty (it still gets the end id); rows with a
null id come first; repeated ids keep all their rows, ordered by text hash; an
empty table gives no shards and reads back as an empty table; columns other
than id and text are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lumenkg.llm.tokenization import release_encoders, unit_encoder, utf8
from lumenkg.llm.workspace import bound_batches, write_table

_MAGIC = b"WMTX"
_HEAD = struct.Struct("<4sIQQI")
_PLANE = struct.Struct("<QQQ")
_BLOCK = 512
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)
#: Rows up to which the table of shard starts is broadcast; beyond it is joined by shuffle.
BROADCAST_SHARDS = 100_000
#: Ids to a block by which asked places find their shard.
ACCESS_BLOCK = 1 << 18
#: Occurrences of an id that are looked up one by one; more are looked up together.
MANY = 64


def _pack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def build_shard(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """One shard file."""
    planes = max(1, int(ids.max(initial=0)).bit_length())
    current = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    parts = []
    for p in range(planes - 1, -1, -1):
        bits = (current >> p) & 1 == 1
        packed = np.packbits(bits)
        blocks = np.add.reduceat(_ONES[packed].astype(np.uint16), np.arange(0, len(packed), _BLOCK // 8)) if len(packed) else np.zeros(0, np.uint16)
        parts.append((len(bits) - int(np.count_nonzero(bits)), _pack(packed.tobytes()), _pack(blocks.astype("<u2").tobytes())))
        current = np.concatenate([current[~bits], current[bits]])
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    table = known.tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(lengths, "<u8").tobytes()
    table = _pack(table)
    out = [_HEAD.pack(_MAGIC, planes, len(ids), len(doc_ids), len(table)), table]
    out += [_PLANE.pack(zeros, len(bits), len(blocks)) for zeros, bits, blocks in parts]
    out += [x for _, bits, blocks in parts for x in (bits, blocks)]
    return b"".join(out)


class WaveletShard:
    """Queries on one shard file; planes are unpacked when first needed."""

    def __init__(self, file: bytes):
        magic, self.planes, self.n, self.n_docs, table = _HEAD.unpack_from(file)
        if magic != _MAGIC:
            raise ValueError("not a wavelet shard")
        self._file, at = file, _HEAD.size
        docs, k = _unpack(file[at : at + table]), self.n_docs
        known = np.frombuffer(docs, np.uint8, k)
        self.doc_ids = [int(d) if ok else None for d, ok in zip(np.frombuffer(docs, "<i8", k, k), known)]
        self.lengths = np.frombuffer(docs, "<u8", k, 9 * k).astype(np.int64)
        at += table
        heads = [_PLANE.unpack_from(file, at + i * _PLANE.size) for i in range(self.planes)]
        at += self.planes * _PLANE.size
        self.zeros, self._places, self._open = [h[0] for h in heads], [], {}
        for _, bits, blocks in heads:
            self._places.append((at, at + bits, at + bits + blocks))
            at += bits + blocks

    def _plane(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(packed bits, ones before each block) of plane ``i`` from the top."""
        if i not in self._open:
            a, b, c = self._places[i]
            packed = np.frombuffer(_unpack(self._file[a:b]), np.uint8)
            blocks = np.frombuffer(_unpack(self._file[b:c]), "<u2").astype(np.int64)
            self._open[i] = packed, np.concatenate([[0], np.cumsum(blocks)])
        return self._open[i]

    def _rank1(self, i: int, at: int) -> int:
        packed, before = self._plane(i)
        block, byte = at // _BLOCK, at // 8
        ones = int(before[block]) + int(_ONES[packed[block * (_BLOCK // 8) : byte]].sum())
        return ones + (int(_ONES[packed[byte] >> (8 - at % 8)]) if at % 8 else 0)

    def _select(self, i: int, k: int, one: bool) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        packed, before = self._plane(i)
        have = before if one else np.minimum(np.arange(len(before)) * _BLOCK, self.n) - before
        block = int(np.searchsorted(have, k, side="right")) - 1
        bits = np.unpackbits(packed[block * (_BLOCK // 8) : (block + 1) * (_BLOCK // 8)])[: self.n - block * _BLOCK]
        return block * _BLOCK + int(np.flatnonzero(bits == one)[k - int(have[block])])

    def access(self, at: int) -> int:
        """The id at a place."""
        value = 0
        for i in range(self.planes):
            packed, _ = self._plane(i)
            bit, ones = packed[at // 8] >> (7 - at % 8) & 1, self._rank1(i, at)
            at = self.zeros[i] + ones if bit else at - ones
            value = value << 1 | int(bit)
        return value

    def _range(self, symbol: int, lo: int, hi: int) -> tuple[int, int]:
        if symbol >> self.planes:
            return 0, 0
        for i in range(self.planes):
            a, b = self._rank1(i, lo), self._rank1(i, hi)
            lo, hi = (self.zeros[i] + a, self.zeros[i] + b) if symbol >> (self.planes - 1 - i) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, symbol: int, lo: int = 0, hi: int | None = None) -> int:
        """How often an id occurs in places lo to hi - 1."""
        a, b = self._range(symbol, lo, self.n if hi is None else hi)
        return b - a

    def occurrences(self, symbol: int, lo: int = 0, hi: int | None = None) -> list[int]:
        """Ascending places of an id, found by select from the last plane up."""
        return self.places(symbol, lo, hi).tolist()

    def places(self, symbol: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """``occurrences`` as an array."""
        a, b = self._range(symbol, lo, self.n if hi is None else hi)
        if b - a > MANY:  # all at once, over the places of a plane's ones or zeros
            where = np.arange(a, b)
            for i in range(self.planes - 1, -1, -1):
                one = bool(symbol >> (self.planes - 1 - i) & 1)
                bits = np.unpackbits(self._plane(i)[0], count=self.n).view(bool)
                where = np.flatnonzero(bits == one)[where - self.zeros[i] if one else where]
            return where
        found = []
        for at in range(a, b):
            for i in range(self.planes - 1, -1, -1):
                one = bool(symbol >> (self.planes - 1 - i) & 1)
                at = self._select(i, at - self.zeros[i] if one else at, one)
            found.append(at)
        return np.array(found, dtype=np.int64)

    def decode(self) -> np.ndarray:
        """All ids in order, undoing the planes from the last."""
        current = np.zeros(self.n, dtype=np.uint32 if self.planes > 16 else np.uint16)
        for i in range(self.planes - 1, -1, -1):
            bits = np.unpackbits(self._plane(i)[0], count=self.n).view(bool)
            up = np.empty_like(current)
            up[~bits] = current[: self.zeros[i]]
            up[bits] = current[self.zeros[i] :] | current.dtype.type(1 << (self.planes - 1 - i))
            current = up
        return current.astype("<u4")


def _shard_rows(vocabulary: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), unit_encoder(vocabulary, "words")
        end, held, docs, lengths, seq, total = np.array([end_id], "<u4").tobytes(), [], [], [], 0, 0

        def flush():
            ids = np.frombuffer(b"".join(held), "<u4")
            file = build_shard(ids, docs, lengths)
            row = {"part": [part], "seq": [seq], "n_docs": [len(docs)], "n_tokens": [len(ids)], "file": [file]}
            return pa.RecordBatch.from_pydict(row, schema=arrow)

        arrow = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("file", pa.binary())])
        for b in batches:
            for doc, text in zip(b.column(0), b.column(1)):
                ids = encoder.encode(utf8(text.as_py())) + end
                held.append(ids)
                docs.append(doc.as_py())
                lengths.append(len(ids) // 4)
                total += lengths[-1]
                if total >= shard_tokens:
                    yield flush()
                    held, docs, lengths, seq, total = [], [], [], seq + 1, 0
        if docs:
            yield flush()

    return run


def write_shards(
    docs: DataFrame,
    root: str,
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = 2,
    shard_tokens: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode, order by id and write the shards; each task writes its own range of ids."""
    bound_batches(docs.sparkSession)
    tie = F.xxhash64("text")
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange("doc_id", tie)
        .sortWithinPartitions("doc_id", tie)
    )
    shards = ordered.mapInArrow(_shard_rows(vocabulary, end_id, shard_tokens), "part int, seq int, n_docs long, n_tokens long, file binary")
    write_table(shards, root, "none", **{"parquet.block.size": str(32 << 20)})


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release_encoders()
    for b in batches:
        for part, seq, file in zip(b.column(0), b.column(1), b.column(2)):
            shard = WaveletShard(file.as_py())
            ids, cut = shard.decode(), np.concatenate([[0], np.cumsum(shard.lengths)])
            k = shard.n_docs
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.as_py()] * k, pa.int32()), pa.array([seq.as_py()] * k, pa.int32()), pa.array(shard.doc_ids, pa.int64()),
                    pa.array(cut[:-1], pa.int64()), pa.array(shard.lengths, pa.int64()),
                    pa.array([ids[x:y].tobytes() for x, y in zip(cut, cut[1:])], pa.binary()),
                ],
                names=["part", "seq", "doc_id", "place", "n_tokens", "ids"],
            )


def _shard_starts(shards: DataFrame) -> DataFrame:
    """(part, seq, base): ids in all shards before; sums run within parts, then over the parts' totals."""
    sizes = shards.select("part", "seq", "n_tokens")
    before = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = totals.select("part", earlier.alias("earlier"))
    return sizes.withColumn("before", before).join(parts, "part").select("part", "seq", (F.col("earlier") + F.col("before")).alias("base"))


def read_documents(spark: SparkSession, root: str, columns: tuple = ()) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files; ``columns`` replaces ``ids`` by expressions of it."""
    shards = spark.read.parquet(root)
    rows = shards.select("part", "seq", "file").mapInArrow(_read_rows, "part int, seq int, doc_id long, place long, n_tokens long, ids binary")
    rows = rows.select("part", "seq", "doc_id", "place", "n_tokens", *(columns or ("ids",)))
    starts = _shard_starts(shards)
    if shards.select("part").count() <= BROADCAST_SHARDS:
        starts = F.broadcast(starts)
    joined = rows.join(starts, ["part", "seq"])
    return joined.withColumn("start", F.col("base") + F.col("place")).drop("part", "seq", "place", "base")


def _shard_spans(spark: SparkSession, root: str) -> DataFrame:
    """(part, seq, base, n_tokens): where each shard's ids lie in the whole store."""
    shards = spark.read.parquet(root)
    return _shard_starts(shards).join(shards.select("part", "seq", "n_tokens"), ["part", "seq"])


def _shard_work(work, arrow: pa.Schema):
    """Columns of ``work(shard, asked)`` behind the shard's numbers, a batch for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for b in batches:
            for part, seq, file, asked in zip(*b.columns):
                found = work(WaveletShard(file.as_py()), asked.as_py())
                numbers = [np.full(len(found[0]), x.as_py(), dtype=np.int32) for x in (part, seq)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((*numbers, *found), arrow)], schema=arrow)

    return run


def _per_shard(shards: DataFrame, work, schema: str) -> DataFrame:
    """``work(shard, asked)``, a list of columns, for each row ``shards(part, seq, file, asked)``, behind the shard's numbers."""
    schema = "part int, seq int, " + schema
    run = _shard_work(work, to_arrow_schema(StructType.fromDDL(schema)))
    return shards.select("part", "seq", "file", "asked").mapInArrow(run, schema)


def access_ids(spark: SparkSession, root: str, places: DataFrame) -> DataFrame:
    """(place, id) of the distinct ``places(place)`` of the whole store, by access on the planes of the shards that hold them.

    Null, negative places and those behind the last id give no row. Shards are found by the blocks of ``ACCESS_BLOCK`` ids
    that they touch, so the join is on equality; a shard is asked for at most as many places as it has ids.
    """
    spans, size = _shard_spans(spark, root).filter("n_tokens > 0"), F.lit(ACCESS_BLOCK)
    block = lambda place: F.floor(place / size)
    touched = spans.withColumn("block", F.explode(F.sequence(block(F.col("base")), block(F.col("base") + F.col("n_tokens") - 1))))
    asked = places.select(F.col("place").cast("long").alias("place")).filter("place >= 0").distinct().withColumn("block", block(F.col("place")))
    met = asked.join(touched, "block").filter((F.col("place") >= F.col("base")) & (F.col("place") < F.col("base") + F.col("n_tokens")))
    listed = met.groupBy("part", "seq", "base").agg(F.collect_list(F.col("place") - F.col("base")).alias("asked"))
    shards = spark.read.parquet(root).select("part", "seq", "file").join(listed.drop("base"), ["part", "seq"])
    found = _per_shard(shards, lambda shard, asked: [asked, list(map(shard.access, asked))], "at long, id long")
    return found.join(spans.select("part", "seq", "base"), ["part", "seq"]).select((F.col("base") + F.col("at")).alias("place"), "id")


def _occurrence_columns(wanted: list[int]):
    def work(shard: WaveletShard, _) -> list:
        held = [symbol for symbol in wanted if shard.count(symbol)]
        where = [shard.places(symbol) for symbol in held]
        at = np.concatenate([np.zeros(0, np.int64), *where])
        owner = np.searchsorted(np.cumsum(shard.lengths), at, side="right")
        return [np.repeat(np.array(held, dtype=np.int64), np.array(list(map(len, where)), dtype=np.int64)), at, pa.array(shard.doc_ids, pa.int64()).take(pa.array(owner))]

    return work


def occurrences_of(spark: SparkSession, root: str, ids: list[int]) -> DataFrame:
    """(id, place, doc_id): every place of the store that holds one of ``ids``, and the document it lies in.

    Each shard walks up its planes for the ids it holds, so the places of an id stay spread over the shards.
    """
    work = _occurrence_columns(sorted(set(ids)))
    shards = spark.read.parquet(root).withColumn("asked", F.lit(None).cast("int"))
    found = _per_shard(shards, work, "id long, at long, doc_id long")
    spans = _shard_spans(spark, root).select("part", "seq", "base")
    return found.join(spans, ["part", "seq"]).select("id", (F.col("base") + F.col("at")).alias("place"), "doc_id")


def count_token(spark: SparkSession, root: str, symbol: int) -> DataFrame:
    """One row: occurrences of an id in the whole store, counted on the planes without decoding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [WaveletShard(f.as_py()).count(symbol) for f in b.column(0)]}, schema=pa.schema([("n", pa.int64())]))

    return spark.read.parquet(root).select("file").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
