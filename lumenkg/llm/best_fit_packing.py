"""Best-fit packing planned on the histogram of lengths.

Each document's ids and an end id form pieces of at most ``capacity`` ids; only
longer documents are cut, the first piece taking the odd length. The plan is
best-fit decreasing over at most ``capacity`` length counts, so its size
depends on the capacity and not on the number of documents: intervals of ranks
within a length map to sequence numbers and offsets. Pieces get their rank
within their length from counts per task, then join the plan on it.

Defined results: null text is empty (one end id); repeated rows are packed each
for itself; null ids are kept; an empty table gives an empty result; columns
other than id and text are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenkg.llm.tokenization import unit_encoder, utf8
from lumenkg.llm.workspace import bound_batches, materialise

PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, nth long"
PLAN = "length long, lo long, hi long, first_sequence long, per_sequence long, first_offset long"


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Intervals (length, lo, hi, first_sequence, per_sequence, first_offset): the pieces of ranks lo to hi - 1
    fill sequences from ``first_sequence`` on, ``per_sequence`` in each, from ``first_offset`` on.

    The longest pieces come first; each goes to the open sequence with the least room that holds it.
    """
    rooms: list[int] = []
    open_: dict[int, list[tuple[int, int]]] = {}
    plan, fresh = [], 0

    def leave(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            else:
                room, first, n = capacity, fresh, -(-left // (capacity // length))
                fresh += n
            each = room // length
            full = min(n, left // each)
            if full:
                plan.append((length, rank, rank + full * each, first, each, capacity - room))
                leave(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            rest = left if full < n and left < each else 0
            if rest:
                plan.append((length, rank, rank + rest, first + full, rest, capacity - room))
                leave(room - rest * length, first + full, 1)
                rank, left = rank + rest, 0
            leave(room, first + full + bool(rest), n - full - bool(rest))
    return plan


def _piece_rows(vocabulary: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder, seen = TaskContext.get().partitionId(), unit_encoder(vocabulary, "spaced"), [0] * (capacity + 1)
        end = np.array([end_id], "<u4").tobytes()
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
        names = ["doc_id", "piece", "start", "length", "ids", "part", "nth"]
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                b, rows = whole.slice(lo, 512), []
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    ids = encoder.encode(utf8(text)) + end
                    n = len(ids) // 4
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for piece, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        rows.append((doc, piece, x, y - x, ids[4 * x : 4 * y], part, seen[y - x]))
                        seen[y - x] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def cut_pieces(
    docs: DataFrame,
    vocabulary: str = "byte_bpe_50k.json",
    end_id: int = 0,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The written table of pieces: ids, and with each its task (``part``) and rank among that task's pieces of its length (``nth``)."""
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return materialise(slim.mapInArrow(_piece_rows(vocabulary, end_id, capacity), PIECES), "pieces")


def place_pieces(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that carry ``length``, ``part`` and ``nth``."""
    spark = pieces.sparkSession
    counts = materialise(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    plan = spark.createDataFrame(plan_best_fit(totals, capacity), PLAN)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranks = counts.withColumn("base", F.coalesce(before, F.lit(0)))
    meet = (F.col("lo") < F.col("base") + F.col("n")) & (F.col("hi") > F.col("base"))
    slots = ranks.join(plan, "length").filter(meet).drop("n")
    rank = F.col("base") + F.col("nth")
    seat = rank - F.col("lo")
    placed = pieces.join(slots, ["length", "part"]).filter((rank >= F.col("lo")) & (rank < F.col("hi")))
    return placed.withColumns(
        {
            "sequence_id": F.col("first_sequence") + F.floor(seat / F.col("per_sequence")),
            "offset": F.col("first_offset") + seat % F.col("per_sequence") * F.col("length"),
        }
    ).drop("lo", "hi", "base", "first_sequence", "per_sequence", "first_offset")


def packed_sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, each at most ``capacity`` ids."""
    key = ["length", "part", "nth"]
    rows = pieces.select(*key, "ids").join(placed.select(*key, "sequence_id", "offset"), key)
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return rows.groupBy("sequence_id").agg(joined.alias("ids"))
