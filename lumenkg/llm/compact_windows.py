"""Substring near-duplicates by compact windows.

A text is a sequence of five-word shingles. For a hash function, all
subsequences of at least ``min_shingles`` shingles with the same min-hash form
compact windows (l, c, r): the nodes of the Cartesian tree over the hashes,
split at the least hash c. Texts whose windows have the same least shingle meet
by equality on it. They are searched in two ways:

* Equal passages. The windows of the first hash function that meet another text
  stand for runs of window starts; every start of such a run is joined on a hash
  of all its shingles with the earliest start that has the same. Two texts that
  share ``min_words`` words share the least shingle of them, so no equal passage
  is missed, whatever surrounds it and however frequent its lines are.
* Near passages. The windows of all hash functions whose least shingle lies in
  no passage yet are linked to the first text of their least shingle, and to the
  first of those with the same words on one side of it. Links of two texts along
  one alignment are joined as intervals, and each joined interval is verified on
  the shingles of both texts. A pair of windows at the similarity 0.8 shares the
  least shingle of one of four hash functions with probability 0.998.

Groups of a common shingle never meet whole: each task first links its own
members to its first one and hands on that one only, so a group has a row for
each of a task's flushes, and a text is the first for a flush's texts at most.

Texts that are whole copies of an earlier one come out as one passage.

Defined results: null, blank and short texts (under ``min_words`` words) have
no passages; A-Z count as a-z; an id names a document, so repeated rows are no
copies of each other, and all of them lose the passages that an earlier document
holds; rows with a null id have no passages; an empty table gives an empty
result; other columns are ignored by ``repeated_passages`` and kept by
``drop_repeated_passages``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenkg.llm.text import mix, shingle_hashes, utf8_buffer, word_hashes
from lumenkg.llm.tokenization import release_encoders
from lumenkg.llm.workspace import bound_batches, collected_paths, discard, materialise

P = "__cw_"
#: Of the bytes of all texts, how much the word hashes of one round of verification may take.
ROUND_SHARE = 0.5


@dataclass(frozen=True)
class WindowOptions:
    """Windows of ``min_words`` words cut into ``width``-word shingles under ``functions`` hash functions; ``side`` is how
    many shingles on one side of the least one tell its variants apart."""

    min_words: int = 50
    width: int = 5
    functions: int = 4
    side: int = 12
    similarity: float = 0.8
    segment: int = 1 << 17
    flush: int = 1 << 19

    @property
    def min_shingles(self) -> int:
        return self.min_words - self.width + 1

    @property
    def half(self) -> int:
        """A window holds so many shingles at least on one side of any of its shingles."""
        return (self.min_shingles - 1) // 2


def _placed(values: np.ndarray) -> np.ndarray:
    """Values with their place in the lowest bits, so that the first of equal ones is the least."""
    bits = np.uint64(len(values).bit_length())
    return (values >> bits) << bits | np.arange(len(values), dtype=np.uint64)


def _least_places(packed: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """Places that are the least of some ``least`` neighbours within one text, from minima over power-of-two spans.

    These are the nodes of the Cartesian trees that hold ``least`` places or more.
    """
    if len(packed) < least:
        return np.zeros(0, np.int64)
    span = 1
    now = packed
    while 2 * span <= least:
        now = np.minimum(now[: len(now) - span], now[span:])
        span *= 2
    if span < least:
        now = np.minimum(now[: len(now) - (least - span)], now[least - span :])
    inside = np.zeros(len(now), bool)
    for a, b in zip(bounds[:-1], bounds[1:]):
        inside[a : max(b - least + 1, a)] = True
    now = now[inside]
    now = now[np.concatenate([np.ones(min(len(now), 1), bool), now[1:] != now[:-1]])]  # neighbours mostly share their least
    return np.unique(now & np.uint64((1 << len(packed).bit_length()) - 1)).astype(np.int64)


def compact_windows(values: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) of every compact window of at least ``least`` places, over texts at ``bounds`` of one array.

    A node of the Cartesian tree holds ``least`` places only if it is the least
    of so many neighbours, and so do all nodes above it. The tree over these
    places alone therefore has the windows' bounds (ties at the first place). A
    stack holds its rightmost path; a node ends where a smaller one comes.
    """
    n = len(values)
    if n < least:
        return (np.zeros(0, np.int64),) * 3
    packed = _placed(values)
    places = _least_places(packed, bounds, least)
    cuts = np.searchsorted(places, bounds).tolist()
    value, place = packed[places].tolist(), places.tolist()
    left, right = [0] * len(place), [0] * len(place)
    for a, b, begin, end in zip(cuts, cuts[1:], bounds[:-1].tolist(), bounds[1:].tolist()):
        path: list[int] = []
        for i in range(a, b):
            v = value[i]
            while path and value[path[-1]] > v:
                right[path.pop()] = place[i] - 1
            left[i] = place[path[-1]] + 1 if path else begin
            path.append(i)
        for i in path:
            right[i] = end - 1
    return np.array(left, np.int64), places, np.array(right, np.int64)


def least_shingles(shingles: np.ndarray, bounds: np.ndarray, options: WindowOptions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first start, last start): places of the least shingles of all windows under all hash functions; for those of
    the first function the run of starts whose window has its least shingle there, for others an empty run."""
    t = options.min_shingles
    hashes = lambda number: mix(shingles ^ mix(np.uint64([number]))[0])
    left, c, right = compact_windows(hashes(1), bounds, t)
    others = [_least_places(_placed(hashes(k)), bounds, t) for k in range(2, options.functions + 1)]  # nodes without bounds
    every = np.unique(np.concatenate([c, *others]))
    first, last = np.zeros(len(every), np.int64), np.full(len(every), -1)
    at = np.searchsorted(every, c)
    first[at], last[at] = np.maximum(left, c - t + 1), np.minimum(c, right - t + 1)
    return every, first, last


def _text_pieces(column: pa.Array, options: WindowOptions) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(shingles, bounds, text of each piece, first word of each piece) for runs of texts of about ``segment`` shingles.

    Longer texts are cut into pieces that overlap by one window less a shingle, so every window lies whole in one piece.
    """
    data, offsets = utf8_buffer(column)
    w, t = options.width, options.min_shingles
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + 6 * options.segment, side="right")) - 1)
        words, first = word_hashes(data, offsets[at : end + 1])
        whole = shingle_hashes(words, w)
        lo, hi = first[:-1], np.maximum(first[1:] - w + 1, first[:-1])
        pieces = [(i, x, min(x + options.segment + t - 1, b)) for i, (a, b) in enumerate(zip(lo, hi)) for x in range(int(a), max(int(b) - t + 1, int(a)), options.segment)]
        if pieces:
            part = np.concatenate([whole[x:y] for _, x, y in pieces])
            bounds = np.concatenate([[0], np.cumsum([y - x for _, x, y in pieces])])
            yield part, bounds, np.array([at + i for i, _, _ in pieces]), np.array([x - first[i] for i, x, _ in pieces])
        at = end


def _firsts(keys: list[np.ndarray], doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, leader, link): rows sorted by key, document and place; the position of the first of each key; and whether a
    row links to it. Rows of the first's own document stay unlinked, so they meet earlier documents as it does."""
    order = np.lexsort((place, doc, *keys))
    lead = np.ones(len(order), bool)
    lead[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    leader = np.flatnonzero(lead)[np.cumsum(lead) - 1]
    return order, leader, doc[order] != doc[order][leader]


def _salts(link: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """0 for rows that still look for their first; linked rows get a number of their own, which spreads them."""
    return np.where(link, (mix(doc.view(np.uint64) + mix(place.astype(np.uint64))) >> np.uint64(33)).astype(np.int32) | 1, 0).astype(np.int32)


_ALONE, _MANY, _LINKED, _SAME = 0, 1, 2, 3
_RUNS = "key long, salt int, id long, at long, stretch long, sides long, kind int, rep_id long, rep_c int"


def _run_rows(options: WindowOptions):
    """The least shingles of every text with a hash of their run of windows (``stretch``), settled flush by flush.

    ``at`` holds the place (upper half), how far before it the run starts, and the run's length. ``kind`` tells whether a
    row is the first of its shingle in the flush (alone, or one of many), linked to the first, or has all the run's
    shingles in common with the text it is linked to. ``sides`` holds hashes of the half windows that end (upper half) and
    begin at the place.
    """
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
    names = ["key", "salt", "id", "at", "stretch", "sides", "kind", "rep_id", "rep_c"]
    t = options.min_shingles

    def settle(held: list) -> pa.RecordBatch:
        key, doc, c, run, stretch, sides = (np.concatenate(x) for x in zip(*held))
        order, leader, link = _firsts([key], doc, c)
        key, doc, c, run, stretch, sides = (x[order] for x in (key, doc, c, run, stretch, sides))
        met = np.zeros(len(key), bool)
        met[leader[link]] = True
        own = np.arange(len(key))
        some = np.flatnonzero(met[leader])  # rows of shingles that several texts of the flush hold
        by = some[np.lexsort((some, stretch[some], key[some]))]
        head = np.ones(len(by), bool)
        head[1:] = (key[by][1:] != key[by][:-1]) | (stretch[by][1:] != stretch[by][:-1])
        own[by] = by[np.flatnonzero(head)[np.cumsum(head) - 1]]
        same = (stretch != 0) & (doc != doc[own])
        rep = np.where(same, own, leader)
        kind = np.where(same, _SAME, np.where(link, _LINKED, np.where(met[leader], _MANY, _ALONE)))
        keep = np.lexsort((c, doc))  # neighbours share their id, which shuffles smaller
        values = [key.view(np.int64), _salts(link, doc, c), doc, c << np.int64(32) | run, stretch.view(np.int64), sides.view(np.int64), kind.astype(np.int32), doc[rep], c[rep].astype(np.int32)]
        gaps = {4: stretch == 0, 5: stretch == 0, 7: ~link, 8: ~link}
        columns = [pa.array(v[keep], k, mask=gaps[i][keep] if i in gaps else None) for i, (v, k) in enumerate(zip(values, kinds))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        held, n = [], 0
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                b = whole.slice(lo, 512)
                ids = b.column(0).to_numpy(zero_copy_only=False)
                for shingles, bounds, texts, words in _text_pieces(b.column(1), options):
                    c, first, last = least_shingles(shingles, bounds, options)
                    piece = np.searchsorted(bounds, c, side="right") - 1
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles))])
                    size = np.maximum(last - first + 1, 0)
                    end = np.where(size > 0, last + t, first + 1)
                    stretch = mix(sums[end] - sums[first] + mix(shingles[first]) + (shingles[end - 1] << np.uint64(1))) | np.uint64(1)
                    back = np.where(size > 0, c - first, 0)
                    left, right = sums[c + 1] - sums[np.maximum(c - options.half, 0)], sums[np.minimum(c + options.half + 1, len(shingles))] - sums[c]
                    sides = mix(left) >> np.uint64(32) << np.uint64(32) | mix(right) >> np.uint64(32)
                    held.append((shingles[c], ids[texts[piece]], c + words[piece] - bounds[piece], back << 16 | size, np.where(size > 0, stretch, np.uint64(0)), sides))
                    n += len(c)
                    if n >= options.flush:
                        yield settle(held)
                        held, n = [], 0
        if n:
            yield settle(held)

    return run


def _met_runs(texts: DataFrame, options: WindowOptions) -> DataFrame:
    """(key, id, c, first, n, stretch, sides, same, rep_id, rep_c): least shingles that several texts hold, each with an earlier
    text's if there is one; ``first`` and ``n`` give the run of windows of the first hash function, else ``n`` is 0."""
    runs = texts.select("id", "text").mapInArrow(_run_rows(options), _RUNS)
    group = Window.partitionBy("key", "salt")
    led = runs.withColumns({"lead": F.min(F.struct("id", "at")).over(group), "top": F.max("id").over(group)})
    led = led.filter((F.col("kind") > _ALONE) | (F.col("lead.id") < F.col("top")))
    c = F.shiftright("at", 32).cast("int")
    first = c - F.shiftright("at", 16).bitwiseAND(F.lit(0xFFFF)).cast("int")
    far = (F.col("kind") < _LINKED) & (F.col("lead.id") < F.col("id"))
    return led.select(
        "key", "id", c.alias("c"), first.alias("first"), F.col("at").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("n"), "stretch", "sides", (F.col("kind") == _SAME).alias("same"),
        F.coalesce("rep_id", F.when(far, F.col("lead.id"))).alias("rep_id"), F.coalesce("rep_c", F.when(far, F.shiftright("lead.at", 32).cast("int"))).alias("rep_c"),
    )


def _told_runs(runs: DataFrame) -> DataFrame:
    """``runs`` with ``from_id`` and ``from_start``: the earliest text that holds all the run's windows, and where."""
    lead = F.min(F.struct("id", "first")).over(Window.partitionBy("key", "stretch"))
    own = F.when(F.col("lead.id") < F.col("id"), F.col("lead"))
    plain = runs.filter("n > 0 and not same").withColumn("lead", lead).withColumn("from", own).drop("lead")
    near = F.struct(F.col("rep_id").alias("id"), (F.col("rep_c") - F.col("c") + F.col("first")).alias("first"))
    rest = runs.filter("n = 0 or same").withColumn("from", F.when(F.col("same"), near))
    return plain.unionByName(rest).select("*", F.col("from.id").alias("from_id"), F.col("from.first").alias("from_start")).drop("from")


def _asked_runs(runs: DataFrame, options: WindowOptions) -> DataFrame:
    """(id, first, n): the window starts that another document may hold too, of the runs that no earlier text holds as a
    whole (the first of equal runs stands for the others).

    A window holds half a window before its least shingle or behind it. So starts of which no other document has that half
    in common are left out; by chance alone, texts have many least shingles in common, but few halves.
    """
    left, right = F.shiftright("sides", 32), F.col("sides").bitwiseAND(F.lit(0xFFFFFFFF))
    met = lambda side: F.min("id").over(w := Window.partitionBy("key", side)) < F.max("id").over(w)
    rows = runs.filter("n > 0 and from_id is null").withColumns({"left": left, "right": right})
    rows = rows.withColumn("before", met("left")).withColumn("behind", met("right"))
    turn, stop = F.col("c") - options.half, F.col("first") + F.col("n")  # starts before ``turn`` hold the half before it
    begin = F.when(F.col("before"), F.col("first")).otherwise(F.greatest("first", turn))
    end = F.when(F.col("behind"), stop).otherwise(F.least(stop, turn))
    return rows.select("id", begin.alias("first"), (end - begin).alias("n")).filter("n > 0")


def _grouped_numbers(column: pa.Array, names: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(row of each element, the elements' fields) of a column of lists of structs of numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    owner, flat = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False)), column.flatten()
    return owner, [flat.field(n).to_numpy(zero_copy_only=False) for n in names]


_STARTS = "key long, mark long, id long, at long, rep_id long, rep_start int"
_WINDOW, _LEFT, _RIGHT = 0, 1, 2


def _start_rows(options: WindowOptions):
    """Window starts by a hash of the whole window, and least shingles by a hash of the shingles on either side.

    Starts that link to the flush's first come out as islands of ``n`` neighbours. Of all tables this one has the most rows,
    so its numbers are packed: ``mark`` holds the salt, the kind (two bits) and a second hash (lower half), ``at`` the start
    (upper half) and ``n``. What is random stands side by side, and so shuffles smaller.
    """
    t, names = options.min_shingles, ["key", "mark", "id", "at", "rep_id", "rep_start"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def hashed(sums: list[np.ndarray], shingles: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        total, other = (s[at + n] - s[at] for s in sums)
        ends = mix(shingles[at]) + (shingles[at + n - 1] << np.uint64(1))
        return mix(total + ends), mix(other ^ ends).astype(np.uint32)

    def settle(held: list) -> pa.RecordBatch:
        kind, key, check, doc, start = (np.concatenate(x) for x in zip(*held))
        order, leader, link = _firsts([check, key, kind], doc, start)
        kind, key, check, doc, start = kind[order], key[order], check[order], doc[order], start[order]
        rep, rep_start = doc[leader], start[leader]
        by = np.lexsort((start, start - rep_start, rep, doc, kind, link))
        kind, key, check, doc, start, rep, rep_start, link = (x[by] for x in (kind, key, check, doc, start, rep, rep_start, link))
        head = np.ones(len(by), bool)
        head[1:] = ~(link[1:] & link[:-1] & (kind[1:] == _WINDOW) & (kind[:-1] == _WINDOW) & (doc[1:] == doc[:-1]) & (rep[1:] == rep[:-1]) & (start[1:] == start[:-1] + 1) & (rep_start[1:] == rep_start[:-1] + 1))
        n = np.diff(np.append(np.flatnonzero(head), len(by)))
        kind, key, check, doc, start, rep, rep_start, link = (x[head] for x in (kind, key, check, doc, start, rep, rep_start, link))
        salt = _salts(link, doc, start).astype(np.uint64) & np.uint64(0x3FFFFFFF)
        mark = (salt << np.uint64(2) | kind.astype(np.uint64)) << np.uint64(32) | check.astype(np.uint64)
        values = [key.view(np.int64), mark.view(np.int64), doc, start.astype(np.int64) << np.int64(32) | n, rep, rep_start]
        columns = [pa.array(v.astype(k.to_pandas_dtype(), copy=False), k, mask=~link if i > 3 else None) for i, (v, k) in enumerate(zip(values, kinds))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for whole in batches:
            for lo in range(0, whole.num_rows, 128):
                b = whole.slice(lo, 128)
                ids = b.column(0).to_numpy()
                words, at = word_hashes(*utf8_buffer(b.column(1)))
                shingles = shingle_hashes(words, options.width)
                ends = np.maximum(at[1:] - options.width + 1, at[:-1])  # behind each text's last shingle
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(x))]) for x in (shingles, shingles ^ np.uint64(0x5851F42D4C957F2D))]
                owner, (c, first, sizes) = _grouped_numbers(b.column(2), ["c", "first", "n"])
                found, sizes, sided = [], sizes.astype(np.int64), c >= 0
                starts = np.repeat(at[owner] + first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                found.append((_WINDOW, np.unique(starts), 0, t))
                places, side = np.unique((at[owner] + c)[sided]), options.side
                mine = np.searchsorted(at, places, side="right") - 1
                found += [(_LEFT, places[places - side >= at[mine]], -side, side + 1), (_RIGHT, places[places + side < ends[mine]], 0, side + 1)]
                for kind, place, back, size in found:
                    key, check = hashed(sums, shingles, place + back, size)
                    own = np.searchsorted(at, place, side="right") - 1
                    held.append((np.full(len(place), kind, np.int32), key, check, ids[own], (place - at[own]).astype(np.int32)))
                    n += len(place)
                if n >= options.flush:
                    yield settle(held)
                    held, n = [], 0
        if n:
            yield settle(held)

    return run


def _start_links(runs: DataFrame, opened: DataFrame, texts: DataFrame, options: WindowOptions) -> DataFrame:
    """(kind, id, start, n, rep_id, rep_start): the starts of ``_asked_runs`` and the least shingles of ``opened``, linked to
    the earliest text that holds the same."""
    none = F.lit(-1)
    asked = materialise(_asked_runs(runs, options), "asked").select("id", none.alias("c"), "first", "n")
    asked = asked.unionByName(opened.select("id", "c", none.alias("first"), F.lit(0).alias("n")))
    asked = asked.groupBy("id").agg(F.collect_list(F.struct("c", "first", "n")).alias("runs"))
    starts = texts.join(asked.hint("merge"), "id").select("id", "text", "runs").mapInArrow(_start_rows(options), _STARTS)
    upper = lambda c: F.shiftright(c, 32).cast("int")
    lead = F.min(F.struct("id", "at")).over(Window.partitionBy("key", "mark"))
    near, far = (F.struct(i.alias("id"), c.alias("start")) for i, c in ((F.col("rep_id"), F.col("rep_start")), (F.col("lead.id"), upper("lead.at"))))
    linked = starts.withColumn("lead", lead).withColumn("rep", F.when(F.col("rep_id").isNotNull(), near).otherwise(far)).filter(F.col("rep.id") < F.col("id"))
    kind, n = F.shiftright("mark", 32).bitwiseAND(F.lit(3)).cast("int"), F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    return linked.select(kind.alias("kind"), "id", upper("at").alias("start"), n.alias("n"), F.col("rep.id").alias("rep_id"), F.col("rep.start").alias("rep_start"))


def _equal_passages(links: DataFrame, options: WindowOptions) -> DataFrame:
    """Links (id, start, n, rep_id, rep_start) of ``n`` neighbouring starts along one alignment, put together."""
    by = Window.partitionBy("id", "rep_id", "shift").orderBy("start")
    rows = links.withColumn("shift", F.col("start") - F.col("rep_start"))
    before = F.max(F.col("start") + F.col("n")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("cut", F.coalesce(F.col("start") > before, F.lit(True)).cast("int")).withColumn("part", F.sum("cut").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    first, stop = F.min("start"), F.max(F.col("start") + F.col("n")) - 1 + options.min_words
    found = rows.groupBy("id", "rep_id", "shift", "part").agg(first.alias("first"), stop.alias("stop"))
    return found.select(
        "id", "rep_id", "first", F.col("stop").cast("int").alias("stop"), (F.col("first") - F.col("shift")).alias("rep_first"),
        (F.col("stop") - F.col("shift")).cast("int").alias("rep_stop"), F.lit(1.0).alias("similarity"),
    )


def _open(rows: DataFrame, found: DataFrame, options: WindowOptions) -> DataFrame:
    """The rows (id, c, rep_id, rep_c) whose least shingle lies in no passage of ``found(id, first, stop)``."""
    none = lambda kind: F.lit(None).cast(kind)
    spans = found.select("id", F.col("first").alias("c"), "stop", none("long").alias("rep_id"), none("int").alias("rep_c"))
    both = rows.select("id", "c", none("int").alias("stop"), "rep_id", "rep_c").unionByName(spans)
    reach = F.max("stop").over(Window.partitionBy("id").orderBy("c").rangeBetween(Window.unboundedPreceding, 0))
    marked = both.withColumn("reach", reach).filter(F.col("stop").isNull())
    return marked.filter(F.col("reach").isNull() | (F.col("reach") < F.col("c") + options.width)).select("id", "c", "rep_id", "rep_c")


def _passage_pairs(links: DataFrame, options: WindowOptions, grid: int = 32) -> DataFrame:
    """(id, rep_id, part, first, stop, rep_first, rep_stop): stretches of words around links, joined along one alignment of
    two texts; bounds are multiples of ``grid``, so that several pairs ask for the same stretch of a text."""
    by = Window.partitionBy("id", "rep_id").orderBy("shift", "c")
    gap = (F.col("shift") - F.lag("shift").over(by) > 2 * options.width) | (F.col("c") - F.lag("c").over(by) > 2 * options.min_words)
    ordered = links.distinct().withColumn("shift", F.col("c") - F.col("rep_c")).withColumn("cut", F.coalesce(gap, F.lit(True)).cast("int"))
    ordered = ordered.withColumn("part", F.sum("cut").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    reach = 3 * options.min_words  # a window, and an insertion, to either side
    down = lambda c: F.greatest((F.floor((F.min(c) - reach) / grid) * grid).cast("int"), F.lit(0))
    up = lambda c: (F.ceil((F.max(c) + options.width + reach) / grid) * grid).cast("int")
    return ordered.groupBy("id", "rep_id", "part").agg(
        down("c").alias("first"), up("c").alias("stop"), down("rep_c").alias("rep_first"), up("rep_c").alias("rep_stop")
    )


_SIDE = ["first", "stop", "rep_id", "rep_first", "rep_stop"]
_SPANS = "id long, first int, stop int, rep_id long, rep_first int, rep_stop int, words binary"


def _span_rows(options: WindowOptions):
    """Each requested span with the 32-bit hashes of its words; a text is hashed once for all its spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 64):
                b = whole.slice(lo, 64)
                words, at = word_hashes(*utf8_buffer(b.column(1)))
                words = words.astype(np.uint32)
                owner, (first, stop) = _grouped_numbers(b.column(2), ["first", "stop"])
                asked = pa.array(b.column(2)).flatten()
                rows = [b.column(0).take(pa.array(owner)), *map(asked.field, _SIDE)]
                for x in range(0, len(owner), 4096):  # a long text may have many spans
                    mine = slice(x, x + 4096)
                    spans = [words[f + x : min(f + y, end)].tobytes() for f, end, x, y in zip(at[:-1][owner[mine]], at[1:][owner[mine]], first[mine], stop[mine])]
                    yield pa.RecordBatch.from_arrays([*(c[mine] for c in rows), pa.array(spans, pa.binary())], names=["id", *_SIDE, "words"])

    return run


def shared_blocks(a: np.ndarray, b: np.ndarray, options: WindowOptions) -> list[tuple[int, int, int, int, float]]:
    """(start, stop, start in b, stop in b, similarity) of the passages of at least ``min_words`` words that two runs of words share.

    Exact runs of shared shingles are joined as far as the Jaccard similarity of all shingles of both sides stays up,
    however long the gap between two of them; so an exact passage is found whatever surrounds it. Passages may overlap.
    """
    w = options.width
    x, y = shingle_hashes(a, w), shingle_hashes(b, w)
    if not len(x) or not len(y):
        return []
    order = np.argsort(y, kind="stable")
    low = np.searchsorted(y[order], x, side="left")
    hits = np.flatnonzero(y[order][np.minimum(low, len(y) - 1)] == x)
    if not len(hits) or hits[-1] - hits[0] + w < options.min_words:
        return []
    high = np.searchsorted(y[order], x, side="right")
    # of several equal shingles in b take the one nearest to the alignment of the unique ones
    unique = hits[high[hits] - low[hits] == 1]
    usual = int(np.median(order[low[unique]] - unique)) if len(unique) else 0
    there = order[low[hits]]
    for k in np.flatnonzero(high[hits] - low[hits] > 1):
        options_ = order[low[hits[k]] : high[hits[k]]]
        near = there[k - 1] - hits[k - 1] if k else usual
        there[k] = options_[np.argmin(np.abs(options_ - hits[k] - near))]
    breaks = np.flatnonzero((np.diff(hits) != 1) | (np.diff(there) != 1)) + 1
    runs = [(int(h[0]), int(h[-1]), int(t[0]), int(t[-1])) for h, t in zip(np.split(hits, breaks), np.split(there, breaks))]

    number = np.unique(np.concatenate([x, y]), return_inverse=True)[1]
    in_x, in_y, n_kinds = number[: len(x)], number[len(x) :], int(number.max()) + 1

    def similarity(run: tuple[int, int, int, int]) -> float:
        left, right = np.zeros(n_kinds, bool), np.zeros(n_kinds, bool)
        left[in_x[run[0] : run[1] + 1]] = True
        right[in_y[run[2] : run[3] + 1]] = True
        return np.count_nonzero(left & right) / np.count_nonzero(left | right)

    found, done = [], -1
    x0, x1, y0, y1 = (np.array(c) for c in zip(*runs))
    held = np.cumsum(x1 - x0 + 1)
    for i in range(len(runs)):
        # the farthest run that keeps the similarity up, by the number of shared places first
        both = held[i:] - held[i] + x1[i] - x0[i] + 1
        places = (x1[i:] - x0[i] + 1) + (y1[i:] - y0[i] + 1) - both
        ahead = (both >= options.similarity * places) & (y0[i:] > y1[i])
        ends = i + np.flatnonzero(ahead)
        far = i
        for j in ends[ends > done][::-1]:
            if similarity((x0[i], x1[j], y0[i], y1[j])) >= options.similarity:
                far = int(j)
                break
        while far + 1 < len(runs) and x0[far + 1] - x1[far] <= 2 * w and 0 < y0[far + 1] - y1[far] <= 2 * w:
            if similarity((x0[i], x1[far + 1], y0[i], y1[far + 1])) < options.similarity:
                break
            far += 1
        if far > done:
            found.append((int(x0[i]), int(x1[far]), int(y0[i]), int(y1[far])))
            done = far
    return [(i, j + w, k, m + w, similarity((i, j, k, m))) for i, j, k, m in found if j - i + w >= options.min_words]


def _flat_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words, bounds) of a column of packed 32-bit word hashes; null is no word."""
    column = column.fill_null(b"").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data.view(np.uint32).astype(np.uint64), (offsets - offsets[0]) // 4


def _could_share(left: np.ndarray, la: np.ndarray, right: np.ndarray, ra: np.ndarray, options: WindowOptions) -> np.ndarray:
    """Which pairs of word runs have shared shingles as far apart as a passage is long; the others share no passage.

    All pairs are looked up at once, each with its number mixed into its shingles.
    """
    w, n = options.width, len(la) - 1

    def keyed(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place = np.arange(max(len(words) - w + 1, 0))
        pair = np.searchsorted(at, place, side="right") - 1
        inside = place + w <= at[np.minimum(pair + 1, n)]
        shingles = shingle_hashes(words, w)[inside]
        return shingles ^ mix(pair[inside].astype(np.uint64) + np.uint64(1)), pair[inside], place[inside]

    (x, pair, place), (y, _, _) = keyed(left, la), keyed(right, ra)
    if not len(x) or not len(y):
        return np.zeros(n, bool)
    y = np.sort(y)
    hit = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
    pair, place = pair[hit], place[hit]
    first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    np.minimum.at(first, pair, place)
    np.maximum.at(last, pair, place)
    return (last >= 0) & (last - first + w >= options.min_words)


_FOUND = "id long, rep_id long, first int, stop int, rep_first int, rep_stop int, similarity double"


def _similarity_rows(options: WindowOptions):
    names = ["id", "rep_id", "first", "stop", "rep_first", "rep_stop", "similarity"]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b, rows = whole.slice(lo, 256), []
                (left, la), (right, ra) = _flat_words(b.column(4)), _flat_words(b.column(5))
                near = np.flatnonzero(_could_share(left, la, right, ra, options)).tolist()
                heads = b.select([0, 1, 2, 3]).take(pa.array(near, pa.int64())).to_pydict().values()
                for k, i, j, x, y in zip(near, *heads):
                    blocks = shared_blocks(left[la[k] : la[k + 1]], right[ra[k] : ra[k + 1]], options)
                    rows += [(i, j, x + a, x + c, y + d, y + e, s) for a, c, d, e, s in blocks]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(list(zip(*rows)) or [[]] * 7, kinds)], names=names)

    return run


def _rounds(pairs: DataFrame, texts: DataFrame) -> tuple[int, bool]:
    """In how many rounds ``pairs`` are verified, and whether ids repeat.

    A round's hashes take at most ``ROUND_SHARE`` of the bytes of the texts, however many pairs there are.
    """
    size = texts.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text").cast("long")).alias("bytes"))
    most, held = size.agg(F.max("rows"), F.sum("bytes")).first()
    words = lambda rows, a, b: rows.agg(F.coalesce(F.sum((F.col(b) - F.col(a)).cast("long")), F.lit(0))).first()[0]
    asked = words(pairs, "first", "stop") + words(pairs.select("rep_id", "rep_first", "rep_stop").distinct(), "rep_first", "rep_stop")
    return max(1, math.ceil(4 * asked / max(1, ROUND_SHARE * (held or 0)))), (most or 0) > 1


def _words_of(pairs: DataFrame, texts: DataFrame, options: WindowOptions, repeated: bool) -> DataFrame:
    """The written words of each pair's own side, and once each (``rep_id`` null) those of the spans they are held against."""
    theirs = pairs.select("rep_id", "rep_first", "rep_stop").distinct().toDF("id", "first", "stop")
    none = [F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in _SIDE[2:]]
    asked = pairs.select("id", *_SIDE).unionByName(theirs.select("id", "first", "stop", *none))
    asked = asked.groupBy("id").agg(F.collect_list(F.struct(*_SIDE)).alias("spans"))
    spans = texts.join(asked.hint("merge"), "id").select("id", "text", "spans").mapInArrow(_span_rows(options), _SPANS)
    return materialise(spans.dropDuplicates(["id", *_SIDE]) if repeated else spans, "spans")


def _verified(pairs: DataFrame, texts: DataFrame, options: WindowOptions) -> DataFrame:
    """The written passages that the written ``pairs`` share, trimmed to shared shingles and verified.

    That goes in rounds, each of which has all pairs of its part of the earlier spans, so what lies on disk at once follows
    the texts and not the pairs. In a round each text is shuffled and hashed once.
    """
    spark, key, done = texts.sparkSession, ["rep_id", "rep_first", "rep_stop"], []
    rounds, repeated = _rounds(pairs, texts)
    for k in range(rounds):
        with collected_paths() as used:
            spans = _words_of(pairs.filter(F.pmod(F.xxhash64(*key), F.lit(rounds)) == k), texts, options, repeated)
        theirs = spans.filter("rep_id is null").select(*[F.col(a).alias(b) for a, b in zip(["id", "first", "stop", "words"], [*key, "rep_words"])])
        both = spans.filter("rep_id is not null").join(theirs.hint("merge"), key)
        both = both.select("id", "rep_id", "first", "rep_first", "words", "rep_words")
        done.append(materialise(both.mapInArrow(_similarity_rows(options), _FOUND), "near"))
        discard(spark, used)
    return reduce(DataFrame.unionByName, done)


def find_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", options: WindowOptions = WindowOptions()) -> DataFrame:
    """(id, rep_id, first, stop, rep_first, rep_stop, similarity): verified passages of ``id`` that ``rep_id`` < ``id`` holds."""
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter("id is not null")
    with collected_paths() as used:
        met = materialise(_met_runs(texts, options), "met")
    with collected_paths() as spent:
        runs = materialise(_told_runs(met), "runs")
        discard(docs.sparkSession, used)
        whole = runs.filter("from_id is not null").select("id", F.col("first").alias("start"), "n", F.col("from_id").alias("rep_id"), F.col("from_start").alias("rep_start"))
        opened = materialise(_open(runs, _equal_passages(whole, options), options), "open")
        links = materialise(_start_links(runs, opened, texts, options), "links")
    equal = materialise(_equal_passages(whole.unionByName(links.filter(F.col("kind") == _WINDOW).drop("kind")), options), "equal")
    near = opened.filter("rep_id is not null")
    near = near.unionByName(links.filter(F.col("kind") != _WINDOW).select("id", F.col("start").alias("c"), "rep_id", F.col("rep_start").alias("rep_c")))
    pairs = materialise(_passage_pairs(_open(near, equal, options), options), "pairs")
    discard(docs.sparkSession, spent)
    with collected_paths() as used:
        near = _verified(pairs, texts, options)
    passages = materialise(equal.unionByName(near), "passages")
    discard(docs.sparkSession, used)
    return passages


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", options: WindowOptions = WindowOptions()) -> DataFrame:
    """(doc_id, source_doc_id, first_word, stop_word, source_first_word, source_stop_word, similarity): passages of
    ``doc_id`` that an earlier document holds."""
    long = lambda c, name: F.col(c).cast("long").alias(name)
    return find_passages(docs, id_col, text_col, options).select(
        F.col("id").alias("doc_id"), F.col("rep_id").alias("source_doc_id"), long("first", "first_word"), long("stop", "stop_word"),
        long("rep_first", "source_first_word"), long("rep_stop", "source_stop_word"), "similarity",
    )


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the words of the given spans and the white space after them."""
    data = text.encode("utf-8")
    words = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    out, at = [], 0
    for first, stop in sorted(spans):
        if first >= len(words):
            continue
        begin = words[first][0]
        if begin > at:
            out.append(data[at:begin])
        at = max(at, words[stop][0] if stop < len(words) else len(data))
    return b"".join([*out, data[at:]]).decode("utf-8")


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", options: WindowOptions = WindowOptions()) -> DataFrame:
    """``docs`` with every repeated passage cut from all documents but the earliest that holds it.

    Documents of which no word is left go.
    """
    found = find_passages(docs, id_col, text_col, options)
    spans = found.groupBy(F.col("id").alias(P + "id")).agg(F.collect_set(F.struct("first", "stop")).alias(P + "spans"))
    marked = docs.join(spans.hint("merge"), F.col(id_col).cast("long") == F.col(P + "id"), "left").select(*[F.col(f"`{c}`") for c in docs.columns], P + "spans")
    schema, names, at = T.StructType(docs.schema.fields), docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                b = whole.slice(lo, 512)
                texts, cuts = b.column(at), b.column(b.num_columns - 1).to_pylist()
                left = [t.as_py() if c is None else without_words(t.as_py(), [(x["first"], x["stop"]) for x in c]) for t, c in zip(texts, cuts)]
                keep = pa.array([c is None or bool(t.strip(" \t\n\x0b\x0c\r")) for t, c in zip(left, cuts)])
                columns = [*b.columns[:at], pa.array(left, texts.type), *b.columns[at + 1 : -1]]
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(keep)

    return marked.mapInArrow(run, schema)
