"""Spelling variants of a corpus' words by k-d trees over letter counts.

A word is a vector of letter counts (90 letters). One inserted, deleted or
replaced letter moves it by an L1 distance of at most two, and more exactly: of
words of one length, one count falls by one and one rises; towards a word longer
by one, one count rises and none falls. So near words are found by range
searches per pair of lengths (L, L) and (L, L + 1), and letter order is checked
afterwards.

Two trees work together. The upper tree of each length is split on a bounded
sample of the words (``SAMPLE``) and cuts the space into cells; its boxes are
unbounded outwards, so every word, sampled or not, lies in exactly one cell, and
as a query goes to every cell whose box lies in its range. Spark shuffles words
by cell. In a cell, a tree with tight boxes over the distinct vectors answers
all queries of the cell at once, box by box. Results don't depend on the sample;
it only decides how even the cells are. Cells hand on one row per word (count
of near words, best of them), never the pairs.

Near words are verified position by position; where many words share a vector
(anagrams), by building the changed words and looking them up, so the work is
linear in the words there.

Defined results: words of fewer than ``least_chars`` letters or ``least_count``
occurrences don't take part; a null or empty text has no words; a null id counts
as empty where ids decide which runs lose a letter; repeated rows count each;
very long runs are words like any other; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenkg.llm.tokenization import release_encoders
from lumenkg.llm.workspace import bound_batches, collected_paths, discard, materialise

#: Words that the upper trees are split on at most, and words that a cell is meant to hold.
SAMPLE = 65_536
CELL = 8_192
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 1 << 18
#: Distinct vectors in a leaf, and word pairs of two vectors that are compared one by one.
LEAF = 48
DIRECT_PAIRS = 64
LETTERS = 26 + 64


def _counted(min_chars: int, drop_one_in: int):
    """Occurrences of runs of letters, a task's words together; texts are searched as Latin-1, where a letter is one byte."""
    runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % min_chars)

    def of_text(doc: str, text: str, total: dict[bytes, int]) -> None:
        found = Counter(runs.findall(text.encode("latin-1", "replace").lower()))
        start = crc32(f"{doc}:".encode())
        for w, n in found.items():
            if drop_one_in:
                h = crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                if h % drop_one_in == 0:
                    at = h % len(w)
                    w = w[:at] + w[at + 1 :]
                    if len(w) < min_chars:
                        continue
            total[w] += n

    def table(total: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in total], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        total: dict[bytes, int] = defaultdict(int)
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                of_text("" if doc is None else doc, text.as_py() or "", total)
                if len(total) >= HELD_WORDS:
                    yield table(total)
                    total.clear()
        yield table(total)

    return run


def count_words(docs: DataFrame, least_chars: int = 6, least_count: int = 5, drop_one_in: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): lower-cased (A-Z) runs of letters A-Z, a-z, U+00C0 to U+00FF of at least ``least_chars`` letters.

    ``drop_one_in`` plants misspellings: a run whose crc32 of ``<id>:<run>`` it divides loses the letter at crc32 % length.
    """
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("string"), F.col(text_col))
    counts = slim.mapInArrow(_counted(least_chars, drop_one_in), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def letter_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, starts): letters as numbers below 90, all words in a row."""
    data = np.frombuffer("".join(words).encode("latin-1"), np.uint8).astype(np.int64)
    codes = np.where(data < 128, data - 97, data - 0xC0 + 26)
    return codes, np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])


def letter_counts(words: list[str]) -> np.ndarray:
    """One row of 90 counts per word."""
    codes, starts = letter_codes(words)
    owner = np.repeat(np.arange(len(words)), np.diff(starts))
    longest = max(map(len, words), default=0)
    flat = np.bincount(owner * LETTERS + codes, minlength=len(words) * LETTERS)
    return flat.reshape(-1, LETTERS).astype(np.int16 if longest < 1 << 15 else np.int32)


def _best_split(points: np.ndarray) -> tuple[int, int] | None:
    """(dimension, highest value of the left side) that halves the points best; None if all are equal."""
    at = np.floor(points.mean(axis=0)).astype(np.int64)
    left = (points <= at).mean(axis=0)
    left[left == 1] = 2
    dim = int(np.abs(left - 0.5).argmin())
    return None if left[dim] == 2 else (dim, int(at[dim]))


class KdTree:
    """Boxes over the rows of ``points``, halved until ``stop(number of rows)``; leaves hold runs of ``order``.

    ``tight`` boxes are those of the points; others are the half spaces of the splits and hold any vector.
    """

    def __init__(self, points: np.ndarray, stop, tight: bool = True):
        self.order = np.arange(len(points))
        self.lo, self.hi, self.span, self.kids, self.split = [], [], [], [], []
        low, high = np.zeros(points.shape[1], np.int32), np.full(points.shape[1], 1 << 30, np.int32)
        todo = [(0, len(points), low, high, -1, 0)]
        while todo:
            a, b, lo, hi, parent, side = todo.pop()
            rows = points[self.order[a:b]]
            me = len(self.span)
            self.lo.append(rows.min(axis=0) if tight and b > a else lo)
            self.hi.append(rows.max(axis=0) if tight and b > a else hi)
            self.span.append((a, b))
            self.kids.append([-1, -1])
            self.split.append((0, 0))
            if parent >= 0:
                self.kids[parent][side] = me
            cut = None if stop(b - a) else _best_split(rows)
            if cut is None:
                continue
            dim, top = cut
            self.split[me] = cut
            left = rows[:, dim] <= top
            own = self.order[a:b]
            self.order[a:b] = np.concatenate([own[left], own[~left]])
            mid = a + int(left.sum())
            lo_right, hi_left = lo.copy(), hi.copy()
            lo_right[dim], hi_left[dim] = top + 1, top
            todo += [(mid, b, lo_right, hi, me, 1), (a, mid, lo, hi_left, me, 0)]
        leaves = [k for k, x in enumerate(self.kids) if x[0] < 0]
        self.leaf_number = {node: k for k, node in enumerate(leaves)}

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """Number of the leaf that each vector lies in."""
        out, todo = np.zeros(len(vectors), np.int64), [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.kids[node][0] < 0:
                out[rows] = self.leaf_number[node]
                continue
            dim, top = self.split[node]
            left = vectors[rows, dim] <= top
            todo += [(self.kids[node][0], rows[left]), (self.kids[node][1], rows[~left])]
        return out

    def reach(self, queries: np.ndarray, falls: int, rises: int, ahead: bool = False) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(leaf number, first, end, rows of ``queries``): leaves whose box holds a vector with at most ``falls`` counts
        taken from the query and ``rises`` added. ``ahead``: queries are the points in ``order``, each meets later ones only."""
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, rows = todo.pop()
            a, b = self.span[node]
            if ahead:
                rows = rows[rows < b - 1]
            q = queries[rows]
            near = (np.maximum(q - self.hi[node], 0).sum(axis=1) <= falls) & (np.maximum(self.lo[node] - q, 0).sum(axis=1) <= rises)
            rows = rows[near]
            if not len(rows):
                continue
            if self.kids[node][0] < 0:
                yield self.leaf_number[node], a, b, rows
            else:
                todo += [(self.kids[node][1], rows), (self.kids[node][0], rows)]


def upper_trees(words: DataFrame, total: int) -> dict[int, KdTree]:
    """A tree per word length, split on at most ``SAMPLE`` words."""
    part = 1.0 if total <= SAMPLE else SAMPLE / total
    low = F.xxhash64("word").bitwiseAND(F.lit((1 << 52) - 1))
    some = words.select("word").filter(low <= F.lit(int(part * ((1 << 52) - 1)))).limit(2 * SAMPLE).toArrow()["word"].to_pylist()
    by: dict[int, list[str]] = defaultdict(list)
    for w in some:
        by[len(w)].append(w)
    return {n: KdTree(letter_counts(own), lambda k: k <= max(1, part * CELL), tight=False) for n, own in by.items()}


ROUTED = "length int, cell int, role int, word string, n long"
POINT, SAME, SHORTER = range(3)


def _routed(trees):
    """Each word as a point of its cell, and as a query of the cells that it may have near words in.

    Of two cells of a length only the first's words ask, so every pair of words meets in one cell.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_cell = KdTree(np.zeros((0, LETTERS), np.int16), lambda k: True, tight=False)
        for b in batches:
            words = b.column(0).to_pylist()
            lengths = np.array([len(w) for w in words], np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                vectors = letter_counts([words[i] for i in rows])
                tree, longer = trees.value.get(int(length), one_cell), trees.value.get(int(length) + 1, one_cell)
                own = tree.place(vectors)
                parts = [(int(length), POINT, own, rows)]
                for cell, _, _, near in tree.reach(vectors, 1, 1):
                    near = near[own[near] < cell]
                    parts.append((int(length), SAME, np.full(len(near), cell), rows[near]))
                for cell, _, _, near in longer.reach(vectors, 0, 1):
                    parts.append((int(length) + 1, SHORTER, np.full(len(near), cell), rows[near]))
                at = pa.array(np.concatenate([p[3] for p in parts]))
                column = lambda k: pa.array(np.concatenate([np.full(len(p[3]), p[k]) for p in parts]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [column(0), pa.array(np.concatenate([p[2] for p in parts]), pa.int32()), column(1), b.column(0).take(at), b.column(1).take(at)],
                    names=["length", "cell", "role", "word", "n"],
                )

    return run


def _same_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letter codes are one edit apart; ``b`` is as long or longer by one."""
    length = a.shape[1]
    front = a == b[:, :length]
    if b.shape[1] == length:
        return (~front).sum(axis=1) == 1
    back = a == b[:, 1:]
    prefix = np.logical_and.accumulate(front, axis=1).sum(axis=1)
    suffix = np.logical_and.accumulate(back[:, ::-1], axis=1).sum(axis=1)
    return prefix + suffix >= length


class _Words:
    """Words of one length: letter codes, and distinct vectors with the words of each."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = words, n
        self.codes = letter_codes(words)[0].reshape(len(words), -1).astype(np.uint8)
        counts = letter_counts(words)
        rows = np.ascontiguousarray(counts).view(np.dtype((np.void, counts.dtype.itemsize * LETTERS))).ravel()
        _, first, group = np.unique(rows, return_index=True, return_inverse=True)
        self.vectors = counts[first]
        self.members = np.argsort(group, kind="stable")
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=len(first)))])

    def of(self, vector: int) -> np.ndarray:
        return self.members[self.starts[vector] : self.starts[vector + 1]]


def _word_pairs(left: _Words, right: _Words, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words one edit apart among those of vector pairs (u of ``left``, v of ``right``)."""
    nu, nv = np.diff(left.starts)[u], np.diff(right.starts)[v]
    few = nu * nv <= DIRECT_PAIRS
    out_a, out_b = [], []
    size = (nu * nv)[few]
    for at in range(0, len(size), 1 << 14):
        uu, vv, k = u[few][at : at + (1 << 14)], v[few][at : at + (1 << 14)], size[at : at + (1 << 14)]
        nth = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        width = np.repeat(nv[few][at : at + (1 << 14)], k)
        a = left.members[np.repeat(left.starts[uu], k) + nth // width]
        b = right.members[np.repeat(right.starts[vv], k) + nth % width]
        good = _same_order(left.codes[a], right.codes[b])
        out_a.append(a[good])
        out_b.append(b[good])
    for x, y in zip(u[~few], v[~few]):  # many anagrams: build each changed word and look it up
        change = right.vectors[y].astype(np.int64) - left.vectors[x]
        gained, lost = int(change.argmax()), int(change.argmin())
        code = {left.codes[i].tobytes(): i for i in left.of(x)}
        for j in right.of(y):
            text, found = right.codes[j].tobytes(), set()
            for place in (p for p, c in enumerate(text) if c == gained):
                swap = bytes([lost]) if change[lost] < 0 else b""
                found.add(code.get(text[:place] + swap + text[place + 1 :], -1))
            found.discard(-1)
            out_a.append(np.fromiter(found, np.int64, len(found)))
            out_b.append(np.full(len(found), j))
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(out_a), join(out_b)


def _near_in_cell(points: _Words, tree: KdTree, asking: _Words | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (word of ``asking``, word of ``points``) one edit apart; without ``asking`` each pair of points once."""
    target = points.vectors[tree.order].astype(np.float32)
    norm = (target * target).sum(axis=1)
    own = asking is None
    queries = points.vectors[tree.order] if own else asking.vectors
    shorter = not own and asking.codes.shape[1] < points.codes.shape[1]
    floats, sizes = queries.astype(np.float32), (queries.astype(np.float32) ** 2).sum(axis=1)
    us, vs = [], []
    for _, a, b, rows in tree.reach(queries, 0 if shorter else 1, 1, ahead=own):
        # among vectors of these sums, an L1 distance of 1 or 2 is a squared distance of 1 or 2
        square = sizes[rows, None] + norm[None, a:b] - 2 * floats[rows] @ target[a:b].T
        hit_q, hit_p = np.nonzero(np.rint(square) == (1 if shorter else 2))
        u, v = rows[hit_q], hit_p + a
        if own:
            u, v = u[u < v], v[u < v]
        us.append(u)
        vs.append(v)
    if not us:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, v = np.concatenate(us), tree.order[np.concatenate(vs)]
    return _word_pairs(points if own else asking, points, tree.order[u] if own else u, v)


NEAR = "word string, n long, n_near long, best struct<least:bigint,word:string>"


def _search_cell(group: pa.Table) -> pa.Table:
    """One row per word of the cell: its near words there, and the best of them (largest n, then smallest word)."""
    role = group["role"].to_numpy()
    table = {k: group.filter(pa.array(role == k)).sort_by("word") for k in (POINT, SAME, SHORTER)}
    words = {k: t["word"].to_pylist() for k, t in table.items()}
    counts = {k: t["n"].to_numpy() for k, t in table.items()}
    near = {k: np.zeros(len(words[k]), np.int64) for k in words}
    best: dict[int, list] = {k: [None] * len(words[k]) for k in words}

    def note(role_a: int, a: np.ndarray, role_b: int, b: np.ndarray) -> None:
        """Words ``b`` are near to words ``a``; places ascend with the words, so ties go to the smaller place."""
        near[role_a] += np.bincount(a, minlength=len(near[role_a]))
        order = np.lexsort((b, -counts[role_b][b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else []
        for i in first:
            found = (-int(counts[role_b][b[i]]), words[role_b][b[i]])
            held = best[role_a][a[i]]
            best[role_a][a[i]] = found if held is None or found < held else held

    if words[POINT]:
        points = _Words(words[POINT], counts[POINT])
        tree = KdTree(points.vectors, lambda k: k <= LEAF)
        a, b = _near_in_cell(points, tree, None)
        note(POINT, np.concatenate([a, b]), POINT, np.concatenate([b, a]))
        for k in (SAME, SHORTER):
            if words[k]:
                a, b = _near_in_cell(points, tree, _Words(words[k], counts[k]))
                note(k, a, POINT, b)
                note(POINT, b, k, a)
    kept = [(w, int(n), int(m), x) for k in words for w, n, m, x in zip(words[k], counts[k], near[k], best[k]) if k == POINT or m]
    pair = pa.struct([("least", pa.int64()), ("word", pa.string())])
    return pa.table(
        {
            "word": pa.array([r[0] for r in kept], pa.string()), "n": pa.array([r[1] for r in kept], pa.int64()), "n_near": pa.array([r[2] for r in kept], pa.int64()),
            "best": pa.array([None if r[3] is None else {"least": r[3][0], "word": r[3][1]} for r in kept], pair),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best) of every word of the stored table ``words(word, n)``: the number of near words and
    struct(-n, word) of the best one."""
    spark = words.sparkSession
    trees = spark.sparkContext.broadcast(upper_trees(words, words.count()))  # at most 2 * SAMPLE words
    routed = words.mapInArrow(_routed(trees), ROUTED)
    found = routed.groupBy("length", "cell").applyInArrow(_search_cell, NEAR)
    return found.groupBy("word").agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def forms(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n): the form is the near word of largest n if that is at least ``ratio`` times n."""
    near = near_words(words)
    good = -F.col("best.least") >= ratio * F.col("n")
    return near.select("word", "n", "n_near", F.when(good, F.col("best.word")).alias("form"), F.when(good, -F.col("best.least")).alias("form_n"))


def with_roots(told: DataFrame, ratio: int = 5) -> DataFrame:
    """The stored table ``told`` with ``root``, the last form of each word.

    Forms grow by ``ratio``, so chains have at most log(largest n) steps; pointers double their reach in each round.
    """
    ends = told.filter("form is not null").agg(F.max("form_n").alias("most"), F.min("n").alias("least")).first()
    if ends["most"] is None:
        return told.withColumn("root", F.col("word"))
    steps = 1 + int(math.log(max(1.0, ends["most"] / max(ends["least"], 1))) / math.log(ratio))
    pointers = told.filter("form is not null").select("word", F.col("form").alias("root"))
    spent: list[str] = []
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        with collected_paths() as made:
            pointers = materialise(pointers, "roots")
        discard(told.sparkSession, spent)
        spent = made
        ahead = pointers.select(F.col("word").alias("root"), F.col("root").alias("next"))
        pointers = pointers.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return told.join(pointers, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame, least_chars: int = 6, least_count: int = 5, ratio: int = 5, drop_one_in: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the corpus; see ``count_words`` for the parameters."""
    with collected_paths() as spent:
        words = materialise(count_words(docs, least_chars, least_count, drop_one_in, id_col, text_col), "words")
    told = materialise(forms(words, ratio), "forms")
    discard(docs.sparkSession, spent)
    return with_roots(told, ratio).select("word", "form", "root", "n", "n_near", "form_n")


def variant_groups(variants: DataFrame) -> DataFrame:
    """(root, n_words, n_total, words): the words that lead to each root, most frequent first; a group holds at most the
    words one edit from another of it."""
    w = Window.partitionBy("root")
    place = F.row_number().over(w.orderBy(F.desc("n"), "word"))
    return variants.withColumn("place", place).groupBy("root").agg(
        F.count(F.lit(1)).alias("n_words"), F.sum("n").alias("n_total"), F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]).alias("words")
    )
